"""Toxicity scores of whole texts: lexicon hits, misspellings included, judged by their context.

The lexicon is learned: words, and word stems with several endings, that are far more frequent in
toxic than in other labelled documents. A Levenshtein automaton along the lexicon's trie finds them in
other words within one edit, two neighbouring letters in turned order included. Every hit is looked at in a window of words: a hit inside quotation marks or
beside a word of reporting counts as quotation, one among other hits as abuse. A logistic model over the
hits gives the score.

Labels are learned from rows whose ``crc32(doc_id as text) % 5`` is not 0. Of those, a hash of the id draws
about ``SAMPLE_ROWS`` rows at most: three parts for the lexicon and for near words that are harmless, the
fourth for the model. Statistics of a text are over the whole text.

A null or empty text has no hits and gets the score of such texts. A null ``doc_id`` counts as the empty text
for the fold. Repeated rows each get a row; an empty table gives none; without labels of both kinds the
model is its prior and the lexicon is empty. Extra columns are ignored.
"""

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from doorstep.llm.levenshtein import Trie
from doorstep.llm.tables import settled

#: Bound on the labelled rows that the model is fitted on.
SAMPLE_ROWS = 20_000
LEAST_LOG_ODDS = 3.0
#: Toxic documents that an entry must stand in: at least so many, and such a share. The share alone bounds the lexicon,
#: to 250 entries for each distinct word that a toxic document has on average.
LEAST_DOCS, LEAST_SHARE = 4, 0.004
STEM_LENGTHS = range(4, 9)
STEM_ENDINGS = 4
WINDOW = 6
#: Words whose matches a Python worker keeps.
KEPT_WORDS = 300_000
REPORTING = frozenset(
    "said says say wrote writes called quoted quote quotes according claimed replied shouted reported term word "
    "words phrase insult slur".split()
)
QUOTES = '"“”„«»‹›'

_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
#: Per feature the prior weight: bias, then of exact hits, of stems, of near hits and of quoted hits (any,
#: log count each), and of hits beside hits.
FEATURES = ("bias", "exact", "exacts", "stem", "stems", "near", "nears", "quoted", "quoteds", "beside")
PRIOR = np.array([-3.0, 3.0, 1.0, 2.0, 1.0, 0.0, 0.0, 0.3, 0.2, 0.5])
#: What one edit takes off a hit.
MISSPELLED = 0.2
RIDGE = 0.05


def held_out() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 0


@dataclass
class Lexicon:
    terms: list[str] = field(default_factory=list)
    stems: list[str] = field(default_factory=list)
    harmless: frozenset[str] = frozenset()

    def __post_init__(self):
        self.trie = Trie(self.terms, self.stems)
        self.known: dict[str, tuple[str, bool, int] | None] = {}

    def __getstate__(self):
        return {"terms": self.terms, "stems": self.stems, "harmless": self.harmless}

    def __setstate__(self, state):
        self.__init__(**state)

    def match(self, raw: str) -> tuple[str, bool, int] | None:
        """The entry that a raw word holds; near words known to be harmless hold none."""
        try:
            return self.known[raw]
        except KeyError:
            pass
        word = _EDGE.sub("", raw).lower()
        found = self.trie.find(word)
        if found and found[2] and word in self.harmless:
            found = None
        if len(self.known) >= KEPT_WORDS:
            self.known.clear()
        self.known[raw] = found
        return found


def _tidy(raw: str) -> str:
    return _EDGE.sub("", raw).lower()


def features(text: str | None, lexicon: Lexicon) -> np.ndarray:
    """The features of one text, in the order of ``FEATURES``."""
    raw = (text or "").split()
    match, known = lexicon.match, lexicon.known
    hits = [(k, m) for k, w in enumerate(raw) if (m := known[w] if w in known else match(w))]
    count, most, beside, last = Counter(), Counter(), 0, -WINDOW - 1
    marks = _quote_marks(raw) if hits else []
    for k, (_, is_stem, edits) in hits:
        if _quoted(raw, k, marks):
            kinds = ["quoted"]
        else:
            # A misspelling has most of its entry's weight, and a weight of its own where labels tell.
            kinds = ["stem" if is_stem else "exact"] + ["near"] * edits
        for kind in kinds:
            strength = 1 - MISSPELLED * edits
            count[kind] += strength
            most[kind] = max(most[kind], strength)
        beside += k - last <= WINDOW
        last = k
    values = [1.0]
    for kind in ("exact", "stem", "near", "quoted"):
        values += [float(most[kind]), math.log1p(count[kind])]
    return np.array([*values, math.log1p(beside)])


def _quote_marks(raw: list[str]) -> list[int]:
    """Quotation marks up to and including each word."""
    total, marks = 0, []
    for w in raw:
        total += sum(w.count(q) for q in QUOTES) if not w.isalnum() else 0
        marks.append(total)
    return marks


def _quoted(raw: list[str], k: int, marks: list[int]) -> bool:
    """Inside an open pair of quotation marks, or in the window of a word of reporting."""
    before = marks[k - 1] if k else 0
    opened = before % 2 == 1 or raw[k][:1] in QUOTES
    closed = marks[-1] > before
    window = raw[max(0, k - WINDOW) : k + WINDOW + 1]
    return (opened and closed) or any(_tidy(w) in REPORTING for w in window)


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 40) -> np.ndarray:
    """Logistic weights by Newton's method, drawn to ``PRIOR``; those of hits stay at zero or above."""
    w = PRIOR.copy()
    if not len(y):
        return w
    ridge = RIDGE * np.eye(len(w))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + RIDGE * (w - PRIOR)
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + ridge, gradient)
        w = w - np.clip(step, -2, 2)
        # A hit never speaks against toxicity.
        w[1:] = np.maximum(w[1:], 0)
        if np.abs(step).max() < 1e-8:
            break
    return w


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """(text, toxic, part) of the labelled rows to learn from."""
    known = labels.where("toxic is not null and doc_id is not null").where(~held_out())
    known = known.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    every = max(1, -(-known.count() // rows))
    drawn = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0)
    # At most about SAMPLE_ROWS narrow rows, whatever the size of the tables.
    joined = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")
    part = F.pmod(F.xxhash64(F.lit("part"), "doc_id"), F.lit(4)).cast("int")
    return settled(joined.select("text", "toxic", part.alias("part")), "toxicity-sample")


def learn_lexicon(sample: DataFrame) -> Lexicon:
    """Terms and stems of three parts of the sample, and its harmless near words."""
    sample = sample.where("part > 0")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: tuple[Counter, Counter] = Counter(), Counter()
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen[toxic > 0].update({_tidy(w) for w in (text or "").split()})
            words = [w for w in seen[0] | seen[1] if w]
            yield pa.record_batch(
                [pa.array(words, pa.string()), *[pa.array([s[w] for w in words], pa.int64()) for s in (seen[1], seen[0])]],
                ["word", "toxic", "other"],
            )

    totals = sample.agg(F.sum(F.col("toxic")).alias("toxic"), F.count("*").alias("n")).first()
    n_toxic = totals.toxic or 0
    n_other = totals.n - n_toxic
    if not n_toxic or not n_other:
        return Lexicon()
    words = sample.select("text", "toxic").mapInArrow(count, "word string, toxic long, other long")
    words = settled(words.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")), "toxicity-words")
    odds = F.log((F.col("toxic") + 0.5) / (n_toxic + 1)) - F.log((F.col("other") + 0.5) / (n_other + 1))
    clear = (F.col("toxic") >= max(LEAST_DOCS, LEAST_SHARE * n_toxic)) & (odds >= LEAST_LOG_ODDS)

    def listed(df: DataFrame) -> list[str]:
        return sorted(r[0] for r in df.select(df.columns[0]).collect())

    terms = listed(words.where(clear & (F.length("word") > 2)))
    prefixes = F.filter(
        F.array(*[F.when(F.length("word") > n, F.substring("word", 1, n)) for n in STEM_LENGTHS]), lambda p: p.isNotNull()
    )
    stems = words.select(F.explode(prefixes).alias("stem"), "toxic", "other").groupBy("stem").agg(
        F.sum("toxic").alias("toxic"),
        F.sum("other").alias("other"),
        F.count_if(F.col("toxic") > 0).alias("endings"),
    )
    stems = listed(stems.where(clear & (F.col("endings") >= STEM_ENDINGS)))
    shortest: list[str] = []
    for stem in sorted(stems, key=lambda s: (len(s), s)):
        if not any(stem.startswith(s) for s in shortest):
            shortest.append(stem)
    # A term that is a stem with an ending is found by the stem; misspellings of it would be too near others.
    alone = [t for t in terms if not t.startswith(tuple(shortest))]
    lexicon = Lexicon(sorted(alone), shortest)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [w for w in batch.column(0).to_pylist() if (m := lexicon.match(w)) and m[2]]
            if found:
                yield pa.record_batch([pa.array(found)], ["word"])

    # Words of the bounded sample, and only those near an entry.
    harmless = words.where("other > 0").select("word").mapInArrow(near, "word string")
    return Lexicon(lexicon.terms, lexicon.stems, frozenset(listed(harmless)))


@dataclass
class Model:
    lexicon: Lexicon
    weights: np.ndarray

    def score(self, text: str | None) -> float:
        return float(1 / (1 + np.exp(-np.clip(features(text, self.lexicon) @ self.weights, -30, 30))))


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    sample = labelled_sample(docs, labels, rows)
    lexicon = learn_lexicon(sample)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Equal feature rows are counted in the task: texts without hits, most of all, are one row."""
        for batch in batches:
            seen: Counter = Counter()
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen[(*features(text, lexicon).tolist(), float(toxic > 0))] += 1
            yield pa.record_batch(
                [pa.array([list(k) for k in seen], pa.list_(pa.float64())), pa.array(list(seen.values()), pa.int64())],
                ["row", "n"],
            )

    cells = (
        sample.where("part = 0")
        .select("text", "toxic")
        .mapInArrow(measure, "row array<double>, n long")
        .groupBy("row")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    rows_of = np.array([c.row for c in sorted(cells) for _ in range(c.n)]).reshape(-1, len(FEATURES) + 1)
    return Model(lexicon, fit(rows_of[:, :-1], rows_of[:, -1]))


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                scores = [model.score(t.as_py()) for t in part.column(2)]
                yield pa.record_batch([*part.columns[:2], pa.array(scores, pa.float64())], ["doc_id", "held_out", "score"])

    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    scored = rows.mapInArrow(run, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
