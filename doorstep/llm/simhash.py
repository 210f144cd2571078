"""Near-duplicate groups of documents by SimHash and the generalised pigeonhole principle.

A document's fingerprint holds, bit by bit, the majority over the XXH64 hashes of its word shingles.
Fingerprints at ``max_bits`` or fewer differing bits link; a group is what links reach.

Equal fingerprints are one node from the start, so exact copies cost nothing. The 64 bits are dealt to
groups of correlated bits. If the thresholds t of m groups sum to ``max_bits - m + 1``, two
fingerprints within ``max_bits`` differ by at most t in some group, so it is enough to look up, for each
group, the keys within t of a fingerprint's own (t = -1: none), and to verify what is met. The number of
groups and the thresholds come from a dynamic programme over the estimated work.

Nulls and texts without words have fingerprint zero and link like any other. A null ``doc_id`` never
names a group; a group of such rows only has a null ``component_id``. Repeated rows each get a row.
Empty tables give empty results. Extra columns are ignored.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import combinations
from math import comb, inf

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from doorstep.llm.graph import components, forest
from doorstep.llm.tables import settled

BITS = 64
SEED = 42
SHINGLE_WORDS = 4
#: Shingles that are hashed before their bits are summed: bounds the memory that a long text takes.
CHUNK = 1 << 15
#: Cost of a looked-up key row relative to a verified candidate, and the most keys a fingerprint looks up in a group.
KEY_COST = 10.0
MOST_KEYS = 1 << 12


def fingerprint(text: str | None, width: int = SHINGLE_WORDS) -> int:
    """The fingerprint of one text as a signed long."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - width + 1)
    first, last = starts[:n].tolist(), ends[len(words) - n :].tolist()
    total = np.zeros(BITS, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, CHUNK):
        hashes = np.array(
            [digest(line[s:e], SEED) for s, e in zip(first[at : at + CHUNK], last[at : at + CHUNK])],
            dtype=">u8",
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1)
        total += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > n).view(">i8")[0])


@F.pandas_udf(T.LongType())
def _fingerprints(texts: pd.Series) -> pd.Series:
    return texts.map(fingerprint, na_action=None).astype("int64")


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) of every row."""
    return docs.select("doc_id", _fingerprints("text").alias("fp"))


@dataclass(frozen=True)
class Group:
    bits: tuple[int, ...]
    threshold: int


def bit_counts(prints: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and, for all pairs of bits, how many have both set; from all rows."""

    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            values = batch.column(0).to_numpy().astype(">i8")
            bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1).astype(np.float32)
            total += bits.T @ bits
            n += len(values)
        if n:
            cells = np.append(total.ravel(), n).astype(np.int64)
            yield pa.record_batch([np.arange(len(cells)), cells], ["cell", "n"])

    rows = (
        prints.select("fp").mapInArrow(gram, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    ).collect()
    cells = np.zeros(BITS * BITS + 1)
    for row in rows:
        cells[row["cell"]] = row["n"]
    return int(cells[-1]), cells[:-1].reshape(BITS, BITS)


def plan_groups(n: int, gram: np.ndarray, max_bits: int) -> list[Group]:
    """Bit groups with thresholds of the least estimated work over all rows' bit statistics.

    Fewer than two fingerprints have no links and need no groups.
    """
    if n < 2:
        return []
    share = np.diag(gram) / max(n, 1)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-9))
    related = np.abs(gram / max(n, 1) - np.outer(share, share)) / np.outer(spread, spread)
    differ = 2 * share * (1 - share)
    best: tuple[float, list[Group]] | None = None
    for m in range(1, max_bits + 2):
        parts = _correlated(related, m)
        table = [[_work(n, differ[list(bits)], t) for t in range(-1, max_bits + 1)] for bits in parts]
        cost, thresholds = _allocate(table, max_bits + 1)
        if best is None or cost < best[0]:
            best = cost, [Group(b, t) for b, t in zip(parts, thresholds) if t >= 0]
    return best[1]


def _correlated(related: np.ndarray, m: int) -> list[tuple[int, ...]]:
    """``m`` groups of about equal width, each grown by the bit most related to it so far."""
    left, parts = list(range(BITS)), []
    for k in range(m):
        width = len(left) // (m - k)
        part = [left.pop(0)]
        while len(part) < width:
            part.append(left.pop(int(np.argmax(related[np.ix_(left, part)].mean(axis=1)))))
        parts.append(tuple(sorted(part)))
    return parts


def _work(n: int, differ: np.ndarray, threshold: int) -> float:
    """Keys looked up and candidates met for one group, the bits taken as independent."""
    if threshold < 0:
        return 0.0
    distance = np.array([1.0])
    for p in differ:
        distance = np.convolve(distance, [1 - p, p])
    own_keys = sum(comb(len(differ), k) for k in range(threshold + 1))
    if own_keys > MOST_KEYS:
        return inf
    return KEY_COST * n * own_keys + n * n / 2 * float(distance[: threshold + 1].sum())


def _allocate(table: list[list[float]], units: int) -> tuple[float, list[int]]:
    """Least total of ``table[group][units of the group]`` with the units summing to ``units``."""
    best = {0: (0.0, [])}
    for row in table:
        nxt: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for more in range(min(len(row), units - used + 1)):
                found = cost + row[more], [*chosen, more - 1]
                if used + more not in nxt or found[0] < nxt[used + more][0]:
                    nxt[used + more] = found
        best = nxt
    return best[units]


def _mask(bits: tuple[int, ...]) -> int:
    """A signed long with ``bits`` set, bit 0 being the highest."""
    value = sum(1 << (BITS - 1 - b) for b in bits)
    return value - (1 << BITS) if value >> (BITS - 1) else value


def links(prints: DataFrame, max_bits: int) -> DataFrame:
    """Verified links (a, b) of distinct fingerprints, enough to connect whatever links connect."""
    groups = plan_groups(*bit_counts(prints), max_bits)
    if not groups:
        return prints.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    keys, probes = [], []
    for number, group in enumerate(groups):
        own = F.col("fp").bitwiseAND(F.lit(_mask(group.bits)))
        flips = [_mask(c) for k in range(group.threshold + 1) for c in combinations(group.bits, k)]
        keys.append(prints.select(F.lit(number).alias("part"), own.alias("key"), F.col("fp").alias("a")))
        flipped = [own.bitwiseXOR(F.lit(f)) for f in flips]
        probes.append(
            prints.select(
                F.lit(number).alias("part"), F.explode(F.array(*flipped)).alias("key"), F.col("fp").alias("b")
            )
        )
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    union = lambda dfs: reduce(DataFrame.union, dfs)
    keys, probes = union(keys), union(probes)
    met = keys.join(
        probes,
        (keys["part"] == probes["part"]) & (keys["key"] == probes["key"]) & (F.col("a") < F.col("b")) & near,
    )
    return forest(met)


def _hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def near_duplicates(docs: DataFrame, max_bits: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (least ``doc_id`` of the group) per row."""
    prints = settled(fingerprints(docs), "fingerprints")
    nodes = settled(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    labels = components(links(nodes, max_bits))
    labelled = nodes.join(labels, nodes["fp"] == labels["node"], "left").select(
        "fp", "least", F.coalesce("label", "fp").alias("label")
    )
    groups = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    members = labelled.select("fp", "label").join(groups, "label").select("fp", "component_id")
    return prints.join(members, "fp").select("doc_id", _hex(F.col("fp")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, max_bits: int = 4) -> DataFrame:
    """One document of each group, the one with the group's least ``doc_id``, with its own columns.

    Of rows that repeat that ``doc_id`` the first by text stays. Rows without a ``doc_id`` stay only
    where their whole group has none, one for each group.
    """
    found = near_duplicates(docs, max_bits)
    chosen = settled(found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))), "kept-one")
    named = chosen.where("doc_id IS NOT NULL").select("doc_id").distinct()
    kept = docs.join(named, docs["doc_id"] == named["doc_id"], "left_semi")
    return one_row_per_id(kept).unionByName(_nameless(docs, chosen))


def one_row_per_id(docs: DataFrame) -> DataFrame:
    """Of rows with the same ``doc_id``, the first by text."""
    rows = docs.select(F.struct("*").alias("row"))
    order = Window.partitionBy("row.doc_id").orderBy("row.text")
    return rows.withColumn("nth", F.row_number().over(order)).where("nth = 1").select("row.*")


def _nameless(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """One row for each fingerprint group without any ``doc_id``."""
    wanted = chosen.where("doc_id IS NULL").select("fingerprint").distinct()
    rows = docs.where("doc_id IS NULL").select(
        _hex(_fingerprints("text")).alias("fingerprint"), F.struct("*").alias("row")
    )
    rows = rows.join(wanted, "fingerprint")
    first = rows.groupBy("fingerprint").agg(F.min_by("row", F.to_json("row")).alias("row"))
    return first.select("row.*")
