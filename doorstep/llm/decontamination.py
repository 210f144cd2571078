"""Benchmark decontamination: every passage of every document queries a BM25 index of the test items.

The index holds the items, with question and answer together; a passage's words are the query. The number of
items, their mean length and the terms' frequencies are those of all distinct items. An item's scores are divided by its score against itself, so one threshold fits all items. Retrieval returns every
item at or above ``threshold``, and an exact check follows: ``min_overlap`` of the item's five-word
shingles must stand in the passage, and the same share of the question's and of the answer's words. Of a
question or answer of fewer than five words one word may differ, whatever share that is.

One altered word costs five shingles, so altered copies of short items are checked by their words as well: a
stretch of the passage that the item turns into by editing at most ``1 - min_overlap`` of its words (put in, left out
or replaced) holds it, if ``PART_OVERLAP`` of the question's and of the answer's words stand in that stretch; fewer than
five words may lack one. ``overlap`` is the larger of both shares. Items of fewer than five words must stand as they are.

Retrieval has two exact steps. A vectorised screen sums, for each passage and item, the scores of the
passage's rarer terms; the item's common terms can add ``SPARE`` at most, so a pair that stays below
``threshold - SPARE`` cannot reach the threshold. The few passages left are searched by block-max WAND
over postings ordered by item, whose blocks carry their highest score.

Passages are windows of 2 L words that start every L words, L being at least the longest item's words: any
copy of an item lies whole in some window. Items are indexed in blocks of bounded size, of about the same
length each; every block is searched by a scan of its own over all documents.

Nulls and texts without words match nothing. Repeated rows of a ``doc_id`` or ``item_id`` give one row
per pair of ids, with the highest score. Empty tables give no rows. Extra columns are ignored.
"""

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from doorstep.llm.tables import settled, words

K1, B = 1.2, 0.75
SHINGLE_WORDS = 5
#: Share of the question's and of the answer's words that an altered copy has at least.
PART_OVERLAP = 0.6
#: Score that an item's common terms, which the screen leaves out, add up to at most.
SPARE = 0.3
#: Items of one posting block.
POSTING_BLOCK = 16
#: Words of the items that one scan searches for; the items of a block go through the driver.
BLOCK_WORDS = 1 << 20
#: The shortest window step; items are grouped by length in steps of eight times.
LEAST_STEP = 64

_PUNCTUATION = bytes(32 if (c < 128 and not chr(c).isalnum()) else c for c in range(256))
_SENTENCE = re.compile(r"(?<=[.?!])\s+|\n+")


def terms(text: str | None) -> list[bytes]:
    """Lower-cased words; ASCII punctuation separates."""
    return (text or "").lower().encode().translate(_PUNCTUATION).split()


def question_and_answer(text: str | None) -> tuple[str, str]:
    """All sentences but the last, and the last; a single sentence is both."""
    parts = [p for p in _SENTENCE.split((text or "").strip()) if p]
    if len(parts) < 2:
        return (parts[0], parts[0]) if parts else ("", "")
    return " ".join(parts[:-1]), parts[-1]


@dataclass(frozen=True)
class Corpus:
    """What BM25 takes from all items: their number, their mean length and the items of every term."""

    n_items: int
    mean_words: float
    found: dict[bytes, int]


class ItemIndex:
    """A BM25 inverted index of items whose scores are shares of each item's own full score."""

    def __init__(self, items: list[tuple[int, str]], corpus: Corpus | None = None):
        """``corpus`` has the terms of ``items`` at least; without it, the items are all there are."""
        kept = [(i, terms(t), t) for i, t in items]
        kept = [x for x in kept if x[1]]
        self.ids = [i for i, _, _ in kept]
        self.words = [w for _, w, _ in kept]
        self.parts = [tuple(Counter(terms(p)) for p in question_and_answer(t)) for _, _, t in kept]
        self.shingles = [shingles(w) for w in self.words]
        self.step = max([LEAST_STEP, *map(len, self.words)])
        self._post(corpus or _corpus(self.words))

    def _post(self, corpus: Corpus) -> None:
        n, mean, found = corpus.n_items, corpus.mean_words, corpus.found
        self.terms = {t: k for k, t in enumerate(sorted({t for w in self.words for t in w}))}
        postings: list[list[tuple[int, float]]] = [[] for _ in self.terms]
        spare: list[list[int]] = []
        for item, w in enumerate(self.words):
            raw = {}
            for t, tf in Counter(w).items():
                idf = math.log(1 + (n - found[t] + 0.5) / (found[t] + 0.5))
                raw[t] = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(w) / mean))
            whole, common, left = sum(raw.values()), [], SPARE
            for t in sorted(raw, key=lambda t: (-found[t], t)):
                share = raw[t] / whole
                postings[self.terms[t]].append((item, share))
                if share <= left:
                    left -= share
                    common.append(self.terms[t])
            spare.append(common)
        self.items = [np.array([i for i, _ in p], np.int64) for p in postings]
        self.scores = [np.array([s for _, s in p]) for p in postings]
        self.tops = [max(s) for s in self.scores]
        self.block_tops = [
            [float(s[k : k + POSTING_BLOCK].max()) for k in range(0, len(s), POSTING_BLOCK)]
            for s in self.scores
        ]
        # Postings that the screen counts: those of an item's rarer terms, laid out term by term.
        common = [set(c) for c in spare]
        rare = [[(i, s) for i, s in p if t not in common[i]] for t, p in enumerate(postings)]
        self.rare_count = np.array([len(p) for p in rare] + [0], np.int64)
        self.rare_start = np.concatenate(([0], np.cumsum(self.rare_count)[:-1])).astype(np.int64)
        self.rare_item = np.array([i for p in rare for i, _ in p], np.int64)
        self.rare_score = np.array([s for p in rare for _, s in p])

    def search(self, query: set[int], threshold: float) -> list[tuple[int, float]]:
        """Every item whose score against the query's terms is at least ``threshold``: block-max WAND."""
        cursors = [[0, t] for t in query]
        found = []
        while True:
            cursors = [c for c in cursors if c[0] < len(self.items[c[1]])]
            cursors.sort(key=lambda c: self.items[c[1]][c[0]])
            total, pivot = 0.0, -1
            for k, (_, t) in enumerate(cursors):
                total += self.tops[t]
                if total >= threshold:
                    pivot = k
                    break
            if pivot < 0:
                return found
            item = self.items[cursors[pivot][1]][cursors[pivot][0]]
            while pivot + 1 < len(cursors) and self._at(cursors[pivot + 1]) == item:
                pivot += 1
            # The blocks in which the pivot would stand bound its score more closely.
            bound, reach = 0.0, None
            for c in cursors[: pivot + 1]:
                at = int(np.searchsorted(self.items[c[1]], item))
                block = at // POSTING_BLOCK
                if block < len(self.block_tops[c[1]]):
                    bound += self.block_tops[c[1]][block]
                    last = self.items[c[1]][min((block + 1) * POSTING_BLOCK, len(self.items[c[1]])) - 1]
                    reach = last if reach is None else min(reach, last)
            if bound < threshold:
                # No item up to the end of the nearest block can reach the threshold.
                nxt = max(item, reach if reach is not None else item) + 1
                if pivot + 1 < len(cursors):
                    nxt = min(nxt, self._at(cursors[pivot + 1]))
                nxt = max(nxt, item + 1)
                for c in cursors[: pivot + 1]:
                    c[0] = int(np.searchsorted(self.items[c[1]], nxt))
                continue
            score = 0.0
            for c in cursors[: pivot + 1]:
                c[0] = int(np.searchsorted(self.items[c[1]], item))
                if c[0] < len(self.items[c[1]]) and self._at(c) == item:
                    score += float(self.scores[c[1]][c[0]])
                    c[0] += 1
            if score >= threshold:
                found.append((int(item), score))

    def _at(self, cursor: list[int]) -> int:
        return self.items[cursor[1]][cursor[0]]

    def screen(self, ids: np.ndarray, half: np.ndarray, threshold: float) -> np.ndarray:
        """Passages that may hold an item: ``ids`` are term numbers (-1: none), ``half`` half-windows.

        Passage p is made of the half-windows p and p + 1.
        """
        count = self.rare_count[ids]
        at = np.flatnonzero(count)
        if not len(at):
            return at
        count = count[at]
        first = np.repeat(self.rare_start[ids[at]] - np.cumsum(count) + count, count)
        posting = first + np.arange(count.sum())
        where = np.repeat(half[at], count)
        total = len(self.rare_item)
        # A word counts once in a passage, so (passage, posting) pairs are made distinct.
        keys = np.unique(np.concatenate((where * total + posting, (where - 1) * total + posting)))
        passage, posting = keys // total, keys % total
        pair, group = np.unique(passage * len(self.ids) + self.rare_item[posting], return_inverse=True)
        scores = np.bincount(group, self.rare_score[posting])
        return np.unique(pair[scores >= threshold - SPARE - 1e-9] // len(self.ids))


def _corpus(items: list[list[bytes]]) -> Corpus:
    found = Counter(t for w in items for t in set(w))
    return Corpus(len(items), sum(map(len, items)) / max(len(items), 1), found)


def shingles(tokens: list[bytes]) -> set[bytes]:
    """Distinct shingles; a text of fewer words is one shingle."""
    n = max(1, len(tokens) - SHINGLE_WORDS + 1)
    return {b" ".join(tokens[i : i + SHINGLE_WORDS]) for i in range(n)}


def _share(part: Counter, seen: Counter) -> float:
    return sum((part & seen).values()) / max(1, part.total())


def _stands(part: Counter, seen: Counter, min_overlap: float) -> bool:
    """Whether enough of a question's or answer's words are there; a short one may lack one word."""
    there = (part & seen).total()
    short = part.total() < SHINGLE_WORDS and there >= part.total() - 1
    return short or _share(part, seen) >= min_overlap


def fewest_edits(item: list[bytes], tokens: list[bytes]) -> tuple[int, int]:
    """Word edits between the item and the stretch of ``tokens`` nearest to it, and where the first such stretch ends.

    Bit k of the two vectors tells whether the distance rises or falls from the item's first k words to its first
    k + 1, so a token costs a few operations on numbers of as many bits as the item has words.
    """
    places: dict[bytes, int] = {}
    for k, word in enumerate(item):
        places[word] = places.get(word, 0) | 1 << k
    every, last = (1 << len(item)) - 1, 1 << len(item) >> 1
    rises, falls, distance = every, 0, len(item)
    best, end = distance, 0
    for at, word in enumerate(tokens, 1):
        equal = places.get(word, 0)
        diagonal = (((equal & rises) + rises) ^ rises) | equal | falls
        up, down = falls | (every & ~(diagonal | rises)), rises & diagonal
        distance += bool(up & last) - bool(down & last)
        # A stretch may start at any token: the distance of no words is 0 everywhere.
        up, down = up << 1 & every, down << 1 & every
        rises, falls = down | (every & ~(equal | falls | up)), up & (equal | falls)
        if distance < best:
            best, end = distance, at
    return best, end


@dataclass(frozen=True)
class Match:
    item_id: int
    score: float
    overlap: float
    question_overlap: float
    answer_overlap: float


def matches(index: ItemIndex, texts: list[str | None], threshold: float, min_overlap: float):
    """(text's number, match) for every item found in every text; a text's best match of an item."""
    get, step = index.terms.get, index.step
    tokens = [terms(t) for t in texts]
    # One half-window of room between texts keeps a passage from reaching into the next text.
    rooms = [len(w) // step + 2 for w in tokens]
    starts = np.concatenate(([1], 1 + np.cumsum(rooms)))
    ids = np.array([get(t, -1) for w in tokens for t in w], np.int64)
    half = (
        np.concatenate([s + np.arange(len(w)) // step for s, w in zip(starts, tokens)])
        if len(ids)
        else ids
    )
    best: dict[tuple[int, int], Match] = {}
    for passage in index.screen(ids, half, threshold).tolist():
        # The first half-window of a text is also half of the passage before it.
        text = int(np.searchsorted(starts, passage, side="right")) - 1
        if passage + 1 in starts[text + 1 : text + 2]:
            text += 1
        at = (passage - int(starts[text])) * step
        window = tokens[text][max(0, at) : at + 2 * step]
        found = index.search({k for k in map(get, window) if k is not None}, threshold)
        if not found:
            continue
        wide = tokens[text][max(0, at - step) : at + 3 * step]
        stand, seen = shingles(wide), Counter(wide)
        for item, score in found:
            own = index.shingles[item]
            if len(index.words[item]) < SHINGLE_WORDS:
                joined = b" " + b" ".join(wide) + b" "
                overlap = float(b" " + b" ".join(index.words[item]) + b" " in joined)
            else:
                overlap = len(own & stand) / len(own)
            parts, held = index.parts[item], seen
            stands = overlap >= min_overlap and all(_stands(p, seen, min_overlap) for p in parts)
            if not stands and len(index.words[item]) >= SHINGLE_WORDS:
                n = len(index.words[item])
                edits, end = fewest_edits(index.words[item], wide)
                overlap, held = max(overlap, 1 - edits / n), Counter(wide[max(0, end - n - edits) : end])
                allowed = edits <= (1 - min_overlap) * n + 1e-9
                stands = allowed and all(_stands(p, held, PART_OVERLAP) for p in parts)
            if stands:
                asked, answered = (_share(p, held) for p in parts)
                match = Match(index.ids[item], score, overlap, asked, answered)
                key = text, match.item_id
                if key not in best or (match.overlap, match.score) > (best[key].overlap, best[key].score):
                    best[key] = match
    return best


SCHEMA = "doc_id long, item_id long, score double, overlap double, question_overlap double, answer_overlap double"


def contaminated(
    docs: DataFrame, items: DataFrame, threshold: float = 0.6, min_overlap: float = 0.8
) -> DataFrame:
    """A row per document and test item that it holds, with the retrieval score and the overlaps."""
    spark = docs.sparkSession
    n_words = F.size(words(F.col("text")))
    length_class = F.ceil(F.log(8.0, F.greatest(n_words, F.lit(LEAST_STEP)) / LEAST_STEP)).cast("int")
    sized = items.select("item_id", "text", n_words.alias("n"), length_class.alias("length")).where("n > 0")
    sized = settled(sized.dropDuplicates(["item_id", "text"]), "items")
    stats = settled(_term_counts(sized), "terms")
    whole = stats.where("term IS NULL").first()
    blocks = sized.groupBy("length").agg(F.sum("n").alias("n")).orderBy("length").collect()
    found = [spark.createDataFrame([], SCHEMA)]
    for block in blocks:
        n_parts = -(-block.n // BLOCK_WORDS)
        own = sized.where(F.col("length") == block.length)
        for part in range(n_parts):
            rows = own.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_parts)) == part)
            in_items = {bytes(r.term): r.items for r in _of_terms(stats, rows).collect()}
            corpus = Corpus(whole.items, whole.words / max(whole.items, 1), in_items)
            index = ItemIndex([(r.item_id, r.text) for r in rows.select("item_id", "text").collect()], corpus)
            found.append(_search(docs, index, threshold, min_overlap))
    pairs = reduce(DataFrame.union, found)
    best = F.max_by(F.struct(*[c for c in pairs.columns if c[-2:] != "id"]), F.struct("overlap", "score"))
    return pairs.groupBy("doc_id", "item_id").agg(best.alias("best")).select("doc_id", "item_id", "best.*")


def _term_counts(items: DataFrame) -> DataFrame:
    """Of every term: the items that hold it, and its words. The row of the null term is of all items."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, total, n_items = Counter(), Counter(), 0
            for text in batch.column(0):
                own = terms(text.as_py())
                held.update(set(own))
                total.update(own)
                n_items += bool(own)
            rows = [(t, n, total[t]) for t, n in held.items()] + [(None, n_items, total.total())]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), _COUNTS.types)], _COUNTS)

    counted = items.select("text").mapInArrow(count, "term binary, items long, words long")
    # A row of all items even where there are none.
    none = items.sparkSession.range(1).selectExpr("CAST(NULL AS binary) AS term", "0L AS items", "0L AS words")
    return counted.unionByName(none).groupBy("term").agg(F.sum("items").alias("items"), F.sum("words").alias("words"))


def _of_terms(stats: DataFrame, items: DataFrame) -> DataFrame:
    """The counts of the terms of some items."""
    own = _term_counts(items).where("term IS NOT NULL").select("term")
    return stats.join(own, "term", "left_semi")


def _search(docs: DataFrame, index: ItemIndex, threshold: float, min_overlap: float) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            for at in range(0, len(ids), 256):
                best = matches(shared.value, texts[at : at + 256].to_pylist(), threshold, min_overlap)
                if best:
                    rows = [
                        (ids[at + k], m.item_id, m.score, m.overlap, m.question_overlap, m.answer_overlap)
                        for (k, _), m in best.items()
                    ]
                    yield pa.record_batch([pa.array(c) for c in zip(*rows)], _ARROW)

    return docs.select("doc_id", "text").mapInArrow(scan, SCHEMA)


_COUNTS = pa.schema([("term", pa.binary()), ("items", pa.int64()), ("words", pa.int64())])
_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("item_id", pa.int64())]
    + [(n, pa.float64()) for n in ("score", "overlap", "question_overlap", "answer_overlap")]
)


def keep_clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that hold no test item, with their own columns.

    A row without ``doc_id`` cannot be told from others without one: if any of them holds an item, all go.
    """
    found = contaminated(docs, items).select("doc_id").distinct()
    return docs.join(found, docs["doc_id"].eqNullSafe(found["doc_id"]), "left_anti")
