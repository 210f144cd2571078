"""Words of a lexicon within an edit distance, by a Levenshtein automaton run along the lexicon's trie.

The automaton of a word has a state for every number of its letters read and of edits made. It is run
along the trie: a state goes on by the word's next letter where the node has it, and, while an edit is left,
by a letter replaced, left out or added, or by two neighbouring letters in turned order. A branch ends where the
automaton has no way on, so only the part of the trie that it accepts is visited.
"""

#: How an entry was met: letter by letter, with one edit, with two letters turned.
AS_IS, EDITED, TURNED = 0, 1, 2


class Trie:
    """A lexicon of whole terms and of stems, which any ending may follow.

    Entries of ``long`` letters or more may be one edit away. Shorter ones of ``least`` letters or more must keep their
    first letter; a term of that length may be one edit away, a stem only have two letters turned, as too
    many words begin with something one edit from it. Still shorter entries must match as they are.
    """

    def __init__(self, terms: list[str], stems: list[str], long: int = 5, least: int = 4):
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[list[tuple[str, bool, tuple[int, ...], bool]]] = [[]]
        self.heads: dict[int, set[str]] = {}
        self.tails: dict[tuple[int | None, int], set[str]] = {}
        # Of short terms: the first letter with the second one, or with the last two, by the word's length.
        self.short: dict[int, tuple[set[str], set[str]]] = {}
        for entry, is_stem in [(t, False) for t in terms] + [(s, True) for s in stems]:
            n = len(entry)
            node = 0
            for letter in entry:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.ends.append([])
                node = self.children[node][letter]
            if n < least:
                ways = (AS_IS,)
            elif n < long and is_stem:
                ways = (AS_IS, TURNED)
            else:
                ways = (AS_IS, EDITED, TURNED)
            self.ends[node].append((entry, is_stem, ways, n < long))
            self._screen(entry, is_stem, ways, n < long)

    def _screen(self, entry: str, is_stem: bool, ways: tuple[int, ...], short: bool) -> None:
        """Note what a word near the entry has in common with it."""
        n = len(entry)
        half = n // 2
        if EDITED not in ways or short:
            starts = [entry]
            if TURNED in ways:
                starts += [entry[:k] + entry[k + 1] + entry[k] + entry[k + 2 :] for k in range(1, n - 1)]
            self.heads.setdefault(n, set()).update(starts)
            if EDITED in ways:
                for length in (n - 1, n, n + 1):
                    starts, ends = self.short.setdefault(length, (set(), set()))
                    starts.add(entry[:2])
                    ends.add(entry[0] + entry[-(n - 2) :])
            return
        # One edit leaves one half of an entry as it is, at the start or at the end; letters turned across the
        # middle leave the start but for its last letter.
        self.heads.setdefault(half, set()).update([entry[:half], entry[: half - 1] + entry[half]])
        self.tails.setdefault((half if is_stem else None, n - half), set()).add(entry[half:])

    def may_match(self, word: str) -> bool:
        """A quick test that passes every word that ``find`` finds something for."""
        for n, heads in self.heads.items():
            if word[:n] in heads:
                return True
        for (at, n), tails in self.tails.items():
            if at is None:
                if word[-n:] in tails:
                    return True
            elif any(word[k : k + n] in tails for k in (at - 1, at, at + 1) if k >= 0):
                return True
        if len(word) in self.short:
            starts, ends = self.short[len(word)]
            return word[:2] in starts or word[0] + word[-2:] in ends
        return False

    def find(self, word: str) -> tuple[str, bool, int] | None:
        """The nearest entry (entry, is a stem, edits), terms before stems; None if none is near enough."""
        if not word or not self.may_match(word):
            return None
        best: tuple[int, bool, str] | None = None
        n = len(word)
        # States of the automaton at trie nodes: letters of the word read, and the edit made.
        todo = [(0, 0, AS_IS)]
        while todo:
            node, i, way = todo.pop()
            children = self.children[node]
            for entry, is_stem, ways, keeps_first in self.ends[node]:
                met = way
                if not is_stem and i < n:
                    if way or n - i > 1:
                        continue
                    met = EDITED
                distance = int(met != AS_IS)
                if met in ways and not (distance and keeps_first and word[0] != entry[0]):
                    if best is None or (distance, is_stem, entry) < best:
                        best = distance, is_stem, entry
            if i < n and word[i] in children:
                todo.append((children[word[i]], i + 1, way))
            if not way:
                for letter, child in children.items():
                    todo.append((child, i, EDITED))
                    if i < n and letter != word[i]:
                        todo.append((child, i + 1, EDITED))
                if i < n:
                    todo.append((node, i + 1, EDITED))
                if i + 1 < n and word[i] != word[i + 1] and word[i + 1] in children:
                    turned = self.children[children[word[i + 1]]]
                    if word[i] in turned:
                        todo.append((turned[word[i]], i + 2, TURNED))
        return None if best is None else (best[2], best[1], best[0])
