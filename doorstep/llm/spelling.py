"""Groups of spelling variants: words one edit apart, found in a trie of letter-group counts.

The alphabet is dealt into ``GROUPS`` letter groups of about equal weight. A word's vector has its number of
letters of each group; the trie has a level per group, its branches the counts, its leaves the words. One
inserted letter raises one count by one, a replaced one raises one and lowers another (or none), so a
depth-first search may step once to a count one lower than the word's own (surplus) and once to a count one
higher (deficit). A deficit is allowed after a surplus only: so the longer word finds the shorter, and of two
words of one length the one with the first surplus finds the other, every pair once. Leaf words are
looked up by the half that one edit leaves alone and verified letter by letter. A level keeps its count
modulo 256; a leaf has words of one length.

The trie is spread over tasks by its first ``SHARD_LEVELS`` counts: a word is stored once and asks at the few
shards that its budget reaches, with what is left of it. A shard of more than ``BLOCK_WORDS`` words is
dealt into blocks, each with a trie of its own, and words ask at all of them.

Words are counted in the scan task and summed by Spark. A word's form is its near word of largest count if
that is at least twice its own, so forms grow along a chain and its root is reached by pointer jumping.

Nulls: a null text has no words; a null ``doc_id`` is empty in the checksum. Repeated rows count each. Empty tables
give no rows. Extra columns are ignored. Texts and words may be of any length.
"""

import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from doorstep.llm.tables import settled

LEAST_LENGTH, LEAST_COUNT = 5, 3
GROUPS = 16
SHARD_LEVELS = 2
BLOCK_WORDS = 50_000
#: Words that a scan task counts before it passes them on.
HELD_WORDS = 1 << 19
DAMAGE = 97

#: One byte per code point: basic and Latin-1 letters stay, A-Z in lower case, anything else is a space.
_LETTERS = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 192 else 32 for c in range(256)
)
COUNTS = "word string, n long"


def _runs(doc_id: int | None, text: str | None, damage: int | None) -> Iterator[tuple[bytes, int]]:
    """Runs of letters of one text that are long enough, in Latin-1, with their number."""
    found = Counter((text or "").encode("latin-1", "replace").translate(_LETTERS).split())
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in found.items():
        if len(run) < LEAST_LENGTH:
            continue
        if damage:
            h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
            if not h % damage:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
                if len(run) < LEAST_LENGTH:
                    continue
        yield run, n


def vocabulary(docs: DataFrame, least_count: int = LEAST_COUNT, damage: int | None = DAMAGE) -> DataFrame:
    """word and n of all words that are long and frequent enough; ``damage`` plants a deletion in one of so many."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}

        def passed_on() -> pa.RecordBatch:
            rows = [w.decode("latin-1") for w in held]
            return pa.record_batch([pa.array(rows, pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                for run, n in _runs(doc_id.as_py(), text.as_py(), damage):
                    held[run] = held.get(run, 0) + n
                if len(held) > HELD_WORDS:
                    yield passed_on()
                    held.clear()
        yield passed_on()

    counted = docs.select("doc_id", "text").mapInArrow(count, COUNTS)
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def letter_groups(words: DataFrame, groups: int = GROUPS) -> dict[str, int]:
    """Group of every letter, the letters dealt by falling number to the lightest group so far."""
    letters = words.select(F.explode(F.split("word", "")).alias("letter")).groupBy("letter").count().collect()
    weight = [0] * groups
    group = {}
    for row in sorted(letters, key=lambda r: (-r["count"], r["letter"])):
        lightest = min(range(groups), key=lambda g: (weight[g], g))
        group[row["letter"]] = lightest
        weight[lightest] += row["count"]
    return group


def near(a: str, b: str) -> bool:
    """Whether exactly one letter is replaced, or ``b`` is ``a`` without one letter."""
    at = 0
    for x, y in zip(a, b):
        if x != y:
            break
        at += 1
    if len(a) == len(b):
        return a != b and a[at + 1 :] == b[at + 1 :]
    return len(a) == len(b) + 1 and a[at + 1 :] == b[at:]


class Leaf:
    """Words of one vector and one length, by their halves: one edit leaves one half alone."""

    def __init__(self):
        self.heads: dict[str, list[tuple[str, int]]] = {}
        self.tails: dict[str, list[tuple[str, int]]] = {}

    def add(self, word: str, n: int) -> None:
        half = len(word) // 2
        self.heads.setdefault(word[:half], []).append((word, n))
        self.tails.setdefault(word[half:], []).append((word, n))


def halves(word: str, length: int) -> tuple[str, str]:
    """The halves that ``word`` would share with a near word of that length."""
    half = length // 2
    return word[:half], word[len(word) - (length - half) :]


#: What a search has spent of its budget.
NONE, SURPLUS, BOTH = range(3)


class Trie:
    """A level per byte of the vectors from ``level`` on; the last leads to leaves by word length."""

    def __init__(self, level: int):
        self.level, self.root = level, {}
        self.asked: tuple[int, bytes] = (-1, b"")
        self.fronts: list[list[tuple[dict, int]]] = []
        self.found: tuple = (None, None, None, [])

    def add(self, vector: bytes, word: str, n: int) -> None:
        node = self.root
        for count in vector[self.level :]:
            node = node.setdefault(count, {})
        leaf = node.get(len(word))
        if leaf is None:
            leaf = node[len(word)] = Leaf()
        leaf.add(word, n)

    def search(self, vector: bytes, spent: int) -> list[tuple[dict, int]]:
        """Ends of the paths within the budget, with what was spent on them.

        Words ask in the order of their vectors; what the last one shares with this one is not gone through again.
        """
        same = 0
        if self.asked[0] == spent:
            last, most = self.asked[1], len(vector)
            same = self.level
            while same < most and vector[same] == last[same]:
                same += 1
            same -= self.level
            del self.fronts[same + 1 :]
        else:
            self.fronts = [[(self.root, spent)]]
        self.asked = spent, vector
        for own in vector[self.level + same :]:
            lower, higher, front = own - 1 & 255, own + 1 & 255, []
            for node, used in self.fronts[-1]:
                if own in node:
                    front.append((node[own], used))
                if used == NONE:
                    if lower in node:
                        front.append((node[lower], SURPLUS))
                elif used == SURPLUS and higher in node:
                    front.append((node[higher], BOTH))
            self.fronts.append(front)
        return self.fronts[-1]

    def near(self, vector: bytes, spent: int, word: str) -> Iterator[tuple[str, int]]:
        """Near words that ``word`` is to find."""
        length = len(word)
        if self.found[:3] != (vector, spent, length):
            ends = self.search(vector, spent)
            leaves = [
                [(leaf, used) for node, used in ends if (used == SURPLUS) == less and (leaf := node.get(length - less))]
                for less in (False, True)
            ]
            self.found = vector, spent, length, leaves
        for less, leaves in enumerate(self.found[3]):
            head, tail = halves(word, length - less)
            for leaf, used in leaves:
                for entry in leaf.heads.get(head, ()):
                    if (used != NONE or entry[0] > word) and near(word, entry[0]):
                        yield entry
                for entry in leaf.tails.get(tail, ()):
                    if (used != NONE or entry[0] > word) and not entry[0].startswith(head) and near(word, entry[0]):
                        yield entry


def _shards(head: bytes) -> Iterator[tuple[bytes, int]]:
    """Shards that a word asks at, with what it has spent to get there."""
    yield head, NONE
    for i in range(len(head)):
        lower = bytearray(head)
        lower[i] = lower[i] - 1 & 255
        yield bytes(lower), SURPLUS
        for j in range(i + 1, len(head)):
            both = bytearray(lower)
            both[j] = both[j] + 1 & 255
            yield bytes(both), BOTH


PAIRS = "word string, n long, other string, other_n long"


def near_pairs(words: DataFrame, group: dict[str, int], block_words: int = BLOCK_WORDS) -> DataFrame:
    """Every pair of near words of (word, n) once, with both counts."""
    names = [chr(0x61 + g) for g in range(GROUPS)]
    naming = {ord(letter): names[g] for letter, g in group.items()}

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            named = [w.translate(naming) for w in batch.column(0).to_pylist()]
            rows = [bytes([w.count(g) & 255 for g in names]) for w in named]
            yield pa.record_batch([*batch.columns, pa.array(rows, pa.binary())], ["word", "n", "vector"])

    placed = settled(words.select("word", "n").mapInArrow(vectors, "word string, n long, vector binary"), "vectors")
    stored = placed.withColumn("shard", F.substring("vector", 1, SHARD_LEVELS))
    blocks = settled(
        stored.groupBy("shard").agg(F.ceil(F.count("*") / block_words).cast("int").alias("blocks")), "trie-blocks"
    )
    stored = stored.join(blocks, "shard").select(
        "shard", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int").alias("block"), F.lit(-1).alias("spent"),
        "vector", "word", "n",
    )

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            asked = [list(_shards(v[:SHARD_LEVELS])) for v in batch.column(2).to_pylist()]
            rows = [(i, *one) for i, many in enumerate(asked) for one in many]
            at = pa.array([r[0] for r in rows], pa.int64())
            shards, spent = pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.int32())
            word, n, vector = (c.take(at) for c in batch.columns)
            yield pa.record_batch([shards, spent, vector, word, n], ["shard", "spent", "vector", "word", "n"])

    asking = placed.mapInArrow(ask, "shard binary, spent int, vector binary, word string, n long").join(blocks, "shard")
    asking = asking.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, trie = None, Trie(SHARD_LEVELS)
        for batch in batches:
            out = []
            for shard, block, spent, vector, word, n in zip(*[c.to_pylist() for c in batch.columns]):
                if (shard, block) != place:
                    place, trie = (shard, block), Trie(SHARD_LEVELS)
                if spent < 0:
                    trie.add(vector, word, n)
                    continue
                out += [(word, n, *entry) for entry in trie.near(vector, spent, word)]
                if len(out) >= 1 << 14:
                    yield _pair_batch(out)
                    out = []
            if out:
                yield _pair_batch(out)

    rows = stored.unionByName(asking).repartition("shard", "block")
    ordered = rows.sortWithinPartitions("shard", "block", "spent", "vector")
    return ordered.select("shard", "block", "spent", "vector", "word", "n").mapInArrow(search, PAIRS)


def _pair_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.string(), pa.int64())
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["word", "n", "other", "other_n"])


def forms(words: DataFrame, pairs: DataFrame) -> DataFrame:
    """word, n, n_near, form and form_n."""
    turned = pairs.select(F.col("other").alias("word"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    both = pairs.select("word", "other", "other_n").unionByName(turned)
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form")))
    found = both.groupBy(F.col("word").alias("of")).agg(F.count("*").alias("n_near"), best.alias("best"))
    most = -F.col("best.less")
    taken = most >= 2 * F.col("n")
    return words.join(found, words["word"] == found["of"], "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(taken, F.col("best.form")).alias("form"),
        F.when(taken, most).alias("form_n"),
    )


def roots(found: DataFrame) -> DataFrame:
    """of and root of every word that has a form: each round jumps twice as far along the chains.

    A form's count is at least twice its word's, so chains are short and the rounds few.
    """
    reached = settled(found.where("form IS NOT NULL").select(F.col("word").alias("of"), F.col("form").alias("root")), "roots")
    while True:
        further = reached.select(F.col("of").alias("at"), F.col("root").alias("next"))
        jumped = settled(
            reached.join(further, reached["root"] == further["at"], "left").select(
                "of", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
            ),
            "roots",
        )
        reached = jumped.select("of", "root")
        if jumped.where("moved").isEmpty():
            return reached


def spelling_variants(docs: DataFrame, damage: int | None = DAMAGE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of the documents."""
    words = settled(vocabulary(docs, damage=damage), "vocabulary")
    pairs = near_pairs(words, letter_groups(words), block_words)
    found = settled(forms(words, pairs), "forms")
    ends = roots(found)
    return found.join(ends, found["word"] == ends["of"], "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
