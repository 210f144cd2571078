"""Repeated byte strings across a corpus, removed but for their first occurrence: prefix doubling on Spark.

A byte goes if a string of ``length`` bytes over it also starts earlier, in a smaller ``doc_id`` or earlier in
the same document; strings do not cross documents and are judged on the input.

Prefix doubling ranks positions by their first h bytes, then by pairs of ranks at h, 2h, 4h. Nearly all
positions of a corpus are unique after the first rank, so that rank is taken at sampled positions only. Every
window of ``length`` bytes elects the least-hashed ``ANCHOR``-byte string in it: equal windows elect equal
strings at equal offsets. The windows that elect one position are a stretch, and stretches stand for
all positions:

1. Spark sorts stretches by (rank of the anchor, rank of the whole stretch, place). Anchors that are unique end
   here. Of equal stretches all but the first are repeats as a whole. An anchor with different
   stretches leaves those, each once, to the next rounds.
2. For them the windows' ranks at 25 bytes are paired at the offset 25, reranked, and paired at 50,
   until unique or at the full length. Stretches of an anchor meet in one task; an anchor with more than ``HOT``
   different stretches goes through rounds of Spark sorts over all its windows instead.
3. Repeated windows are gathered by document and cut out.

The sort's key ends in the place, so a stretch that any number of documents share is spread over tasks; what
such a task cannot know from its own rows is settled by one row per task.

Ranks are 64-bit fingerprints of at most ``length`` bytes, compared within an anchor's own 64-bit rank.

A null or shorter text loses nothing. A null ``doc_id`` comes before all others; rows that share an id stand in
the order of a hash of their texts; rows that repeat id and text are one document, and each gets its result.
An empty table gives no rows. Extra columns are ignored.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from doorstep.llm.tables import settled

#: At least 64: the first rank within an anchor's round is of a quarter of it, 16 bytes or more.
LENGTH = 100
ANCHOR = 24
#: Different stretches of an anchor that one task compares at once; about 100 MB.
HOT = 1 << 14
#: Bytes of documents, and windows of stretches, that a task works on at a time.
BATCH_BYTES = 1 << 21
BATCH_WINDOWS = 1 << 18
#: Bits of a place within such a batch, below the bits of its hash.
PLACE_BITS = np.uint64(24)
NO_ID = -(1 << 63)

_rng = np.random.default_rng(2024)
_LETTERS = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FACTORS = [np.uint64(int(x) | 1) for x in _rng.integers(1 << 60, 1 << 63, 16)]

DOCUMENT = "ord long, uid long"
STRETCH = f"a long, s long, {DOCUMENT}, pos int, n int"
PIECE = f"kind int, piece int, {STRETCH}"
#: Kinds of rows of the sorted pass: a repeat, the first of several stretches, and what a task leaves open.
REPEAT, FIRST, HEAD, LAST = range(4)


def _join(x: np.ndarray, y: np.ndarray, offset: int, factor: np.uint64) -> np.ndarray:
    """Ranks of the strings at i and i + offset, paired."""
    n = len(y) - offset
    return x[:n] * factor + y[offset : offset + n]


def _scatter(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _powers(buffer: np.ndarray) -> list[np.ndarray]:
    """Ranks of 1, 2, 4, 8 and 16 bytes at every position, each from pairs of the one before."""
    ranks = [_LETTERS[buffer]]
    for k in range(4):
        ranks.append(_join(ranks[-1], ranks[-1], 1 << k, _FACTORS[k]))
    return ranks


def stretches(texts: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """Arrays (text's number, a, s, pos, n) of the texts' stretches: ``n`` windows from ``pos`` on."""
    sizes = np.array([len(t) for t in texts], np.int64)
    total = int(sizes.sum())
    buffer = np.frombuffer(b"".join(texts) + bytes(length), np.uint8)
    r1, _, r4, r8, r16 = _powers(buffer)
    short = _scatter(_join(r16, r8, 16, _FACTORS[4]))
    whole = _whole(r1, r4, r16, length)
    width = length - ANCHOR + 1
    places = np.arange(len(short), dtype=np.uint64)
    least = (short >> PLACE_BITS << PLACE_BITS) | places
    reach = 1
    while reach * 2 <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if reach < width:
        least = np.minimum(least[: -(width - reach)], least[width - reach :])
    least = least[:total]
    number = np.repeat(np.arange(len(texts)), sizes)
    begins = np.cumsum(sizes) - sizes
    at = np.arange(total)
    fits = at + length <= np.repeat(begins + sizes, sizes)
    new = fits.copy()
    new[1:] &= ~(fits[:-1] & (least[1:] == least[:-1]) & (number[1:] == number[:-1]))
    start = np.flatnonzero(new)
    n = np.bincount((np.cumsum(new) - 1)[fits], minlength=len(start)).astype(np.int64)
    anchor = (least[start] & ((np.uint64(1) << PLACE_BITS) - np.uint64(1))).astype(np.int64)
    # The first and the last window together hold all bytes of a stretch.
    s = whole[start] * _FACTORS[10] + whole[start + n - 1] * _FACTORS[11]
    s = _scatter(s + n.astype(np.uint64) * _FACTORS[12] + (anchor - start).astype(np.uint64) * _FACTORS[13])
    return number[start], short[anchor].view(np.int64), s.view(np.int64), start - begins[number[start]], n


def _whole(r1: np.ndarray, r4: np.ndarray, r16: np.ndarray, length: int) -> np.ndarray:
    """Ranks of ``length`` bytes, put together from 16, 4 and 1 bytes."""
    rank, done = r16, 16
    for size, part, factor in ((16, r16, 5), (4, r4, 6), (1, r1, 7)):
        while done + size <= length:
            rank, done = _join(rank, part, done, _FACTORS[factor]), done + size
    return rank


def _batches(rows: Iterator[tuple], size_of, limit: int) -> Iterator[list[tuple]]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += size_of(row)
        if size >= limit:
            yield held
            held, size = [], 0
    if held:
        yield held


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            yield from zip(*[c.to_pylist() for c in batch.slice(at, 256).columns])


def keyed(docs: DataFrame) -> DataFrame:
    """(ord, uid, doc_id, body): documents with the place of theirs in the order of the corpus."""
    body = F.coalesce("text", F.lit(""))
    uid = F.xxhash64("doc_id", body)
    return docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("ord"), uid.alias("uid"), "doc_id", body.alias("body"))


def sampled(docs: DataFrame, length: int) -> DataFrame:
    """The stretches of all documents."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        long_enough = (r for r in _rows(batches) if len(r[2]) >= length)
        for rows in _batches(long_enough, lambda r: len(r[2]), BATCH_BYTES):
            for part in _pieces(rows, length):
                number, a, s, pos, n = stretches([r[3] for r in part], length)
                ord_, uid, base = (np.array([r[k] for r in part], np.int64) for k in range(3))
                yield pa.record_batch(
                    [
                        pa.array(a),
                        pa.array(s),
                        pa.array(ord_[number]),
                        pa.array(uid[number]),
                        pa.array((pos + base[number]).astype(np.int32)),
                        pa.array(n.astype(np.int32)),
                    ],
                    ["a", "s", "ord", "uid", "pos", "n"],
                )

    return docs.select("ord", "uid", F.encode("body", "utf-8")).mapInArrow(scan, STRETCH)


def _pieces(rows: list[tuple], length: int) -> Iterator[list[tuple]]:
    """(ord, uid, base, bytes): documents too long for one batch in pieces that share ``length - 1`` bytes."""
    part, step = [], 4 * BATCH_BYTES
    for ord_, uid, text in rows:
        if len(text) <= step:
            part.append((ord_, uid, 0, text))
            continue
        for base in range(0, len(text) - length + 1, step):
            yield [(ord_, uid, base, text[base : base + step + length - 1])]
    if part:
        yield part


def sorted_pass(found: DataFrame) -> DataFrame:
    """Rows of the sorted stretches by kind; unique anchors give none."""
    order = ["a", "s", "ord", "uid", "pos"]
    ordered = found.repartitionByRange(*order).sortWithinPartitions(*order)
    names = ["a", "s", "ord", "uid", "pos", "n"]
    types = [pa.int64()] * 4 + [pa.int32()] * 2

    def emit(kind: int, piece: int, columns: list[np.ndarray]) -> pa.RecordBatch:
        k = len(columns[0])
        arrays = [pa.array(np.full(k, kind, np.int32)), pa.array(np.full(k, piece, np.int32))]
        return pa.record_batch([*arrays, *[pa.array(c, t) for c, t in zip(columns, types)]], ["kind", "piece", *names])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = TaskContext.get().partitionId()
        last = first = head = None
        # Whether the last first row has been given out, and whether it is the task's first row.
        given = False
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            before = [np.concatenate(([c[0] if last is None else last[k]], c[:-1])) for k, c in enumerate(rows)]
            new = (rows[0] != before[0]) | (rows[1] != before[1])
            same = ~new & (rows[2] == before[2]) & (rows[3] == before[3]) & (rows[4] == before[4])
            if last is None:
                new[0], same[0] = True, False
            repeats = ~new & ~same
            if repeats.any():
                # Of repeats only the place is needed.
                none = np.zeros(int(repeats.sum()), np.int64)
                yield emit(REPEAT, piece, [none, none, *[c[repeats] for c in rows[2:]]])
            firsts = [c[new] for c in rows]
            if len(firsts[0]):
                after = np.concatenate((firsts[0][1:] == firsts[0][:-1], [False]))
                prior = np.concatenate(([first is not None and first[0] == firsts[0][0]], after[:-1]))
                mixed = after | prior
                if prior[0] and not given:
                    yield emit(FIRST if first is not head else HEAD, piece, [np.array([x]) for x in first])
                    given = True
                if first is None:
                    # The task's first row: whether it is a first one depends on the task before.
                    head = [c[0] for c in firsts]
                    if mixed[0]:
                        yield emit(HEAD, piece, [np.array([x]) for x in head])
                    show = mixed.copy()
                    show[0] = False
                else:
                    show = mixed
                if show.any():
                    yield emit(FIRST, piece, [c[show] for c in firsts])
                given = bool(mixed[-1])
                first = head if first is None and len(mixed) == 1 else [c[-1] for c in firsts]
            last = [c[-1] for c in rows]
        if last is not None:
            # The task's first row, and its last first row with n negative where others of its anchor are known.
            yield emit(LAST, piece, [np.array([x]) for x in head])
            yield emit(LAST, piece, [np.array([x]) for x in [*first[:5], -1 if given else first[5]]])

    return settled(ordered.mapInArrow(scan, PIECE), "sorted-stretches")


def settle_edges(edges: list[tuple]) -> list[tuple]:
    """Rows (kind, a, s, ord, uid, pos, n) that the tasks' edges decide.

    ``edges`` are the rows of kind HEAD and LAST in order of piece: per task its first row, its last first row
    (n -1: its anchor has several stretches in the task), and HEAD if that holds for its first row.
    """
    by_piece: dict[int, list[tuple]] = {}
    for row in edges:
        by_piece.setdefault(row[1], []).append(row)
    out: list[tuple] = []
    last: tuple | None = None  # (a, s) of the last first row
    alone: tuple | None = None  # the only stretch so far of the last anchor

    def several() -> None:
        nonlocal alone
        if alone is not None:
            out.append((FIRST, *alone))
            alone = None

    for piece in sorted(by_piece):
        rows = by_piece[piece]
        head, tail = [r[2:] for r in rows if r[0] == LAST]
        if last is not None and head[:2] == last:
            # A place falls to one task only, so this is another one with the same stretch.
            out.append((REPEAT, *head))
        elif last is not None and head[0] == last[0]:
            several()
            out.append((FIRST, *head))
        else:
            alone = head
        if any(r[0] == HEAD for r in rows):
            several()
        if tail[0] != head[0]:
            alone = None if tail[5] < 0 else tail
        last = tail[:2]
    return out


def repeated_windows(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(ord, uid, pos, n): runs of ``n`` windows from ``pos`` on that also start earlier."""
    spark = docs.sparkSession
    rows = sorted_pass(sampled(docs, length))
    edges = [tuple(r) for r in rows.where(F.col("kind").isin(HEAD, LAST)).collect()]
    edges.sort(key=lambda r: (r[1], r[2], r[3], r[4], r[5], r[6]))
    decided = spark.createDataFrame([(k, 0, *r) for k, *r in settle_edges(edges)], PIECE)
    rows = rows.where(F.col("kind").isin(REPEAT, FIRST)).unionByName(decided)
    columns = ["ord", "uid", "pos", "n"]
    repeats = rows.where(F.col("kind") == REPEAT).select(columns)
    firsts = rows.where(F.col("kind") == FIRST).select("a", *columns)
    hot = firsts.groupBy("a").agg(F.count("*").alias("k")).where(F.col("k") > HOT).select("a")
    hot = settled(hot, "hot-anchors")
    if hot.isEmpty():
        return repeats.unionByName(_compare_few(_cut_stretches(docs, firsts, length), length))
    few = _cut_stretches(docs, firsts.join(hot, "a", "left_anti"), length)
    many = settled(_cut_stretches(docs, firsts.join(hot, "a"), length), "hot-stretches")
    return repeats.unionByName(_compare_few(few, length)).unionByName(_compare_hot(many, length))


def _compare_few(cut: DataFrame, length: int) -> DataFrame:
    """The repeats among the stretches of each anchor, which meet in one task."""
    near = cut.repartition("a").sortWithinPartitions("a")
    return near.mapInArrow(_compare(length), f"{DOCUMENT}, pos int, n int")


def _packed(docs: DataFrame) -> DataFrame:
    """(ord, uid, doc_id, packed): compressed texts, since they are shuffled."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                packed = [press.compress(t.as_buffer()) for t in part.column(3)]
                yield pa.record_batch([*part.columns[:3], pa.array(packed, pa.binary())], ["ord", "uid", "doc_id", "packed"])

    return docs.mapInArrow(pack, f"{DOCUMENT}, doc_id long, packed binary")


def _cut_stretches(docs: DataFrame, firsts: DataFrame, length: int) -> DataFrame:
    """The bytes of every stretch, with its anchor and place."""
    wanted = firsts.groupBy("ord", "uid").agg(F.collect_list(F.struct("a", "pos", "n")).alias("wanted"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = zstandard.ZstdDecompressor()
        for rows in _batches(_rows(batches), lambda r: len(r[2]), 1 << 18):
            out = []
            for ord_, uid, packed, wanted_ in rows:
                text = open_.decompress(packed)
                out += [(w["a"], ord_, uid, w["pos"], text[w["pos"] : w["pos"] + w["n"] + length - 1]) for w in wanted_]
            types = [pa.int64()] * 3 + [pa.int32(), pa.binary()]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), types)], ["a", "ord", "uid", "pos", "body"])

    joined = _packed(docs).join(wanted, ["ord", "uid"]).select("ord", "uid", "packed", "wanted")
    return joined.mapInArrow(cut, f"a long, {DOCUMENT}, pos int, body binary")


def first_windows(group: np.ndarray, bodies: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    """For stretches in the order of the corpus: (stretch, window) of each window that an earlier one of its group equals.

    Prefix doubling: ranks of a quarter of the length, paired at that offset, reranked, and paired again.
    """
    quarter = length // 4
    sizes = np.array([len(b) for b in bodies], np.int64)
    n = sizes - length + 1
    buffer = np.frombuffer(b"".join(bodies) + bytes(length), np.uint8)
    r1, _, r4, r8, r16 = _powers(buffer)
    ranks = _whole(r1, r4, r16, quarter)
    stretch = np.repeat(np.arange(len(bodies)), n)
    window = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    at = window + (np.cumsum(sizes) - sizes)[stretch]
    key = group[stretch].astype(np.uint64) * _FACTORS[14]
    # Positions at a half, then the whole; what is unique drops out between.
    for x, y in ((0, 1), (2, 3)):
        key = _scatter(key * _FACTORS[8] + ranks[at + x * quarter] * _FACTORS[9] + ranks[at + y * quarter])
        _, place, count = np.unique(key, return_inverse=True, return_counts=True)
        kept = count[place] > 1
        stretch, window, at, key = stretch[kept], window[kept], at[kept], key[kept]
    rest = length - 4 * quarter
    if rest:
        key = _scatter(key * _FACTORS[8] + _whole_tail(r1, at + 4 * quarter, rest))
    order = np.lexsort((window, stretch, key))
    later = np.concatenate(([False], key[order][1:] == key[order][:-1])) if len(order) else np.zeros(0, bool)
    chosen = np.sort(order[later])
    return stretch[chosen], window[chosen]


def _whole_tail(r1: np.ndarray, at: np.ndarray, rest: int) -> np.ndarray:
    """Ranks of the ``rest`` bytes that four quarters leave."""
    rank = np.zeros(len(at), np.uint64)
    for k in range(rest):
        rank = rank * _FACTORS[7] + r1[at + k]
    return rank


def _distinct_places(rows: list[tuple]) -> list[int]:
    """Numbers of the rows in the order of their places, one for each place and anchor."""
    order = sorted(range(len(rows)), key=lambda i: (*rows[i][1:4], rows[i][0]))
    return [i for k, i in enumerate(order) if not k or rows[i][:4] != rows[order[k - 1]][:4]]


def _compare(length: int):
    """The repeats among stretches sorted by anchor; whole anchors at a time."""

    def judge(rows: list[tuple]) -> pa.RecordBatch:
        # By place; a document that occurs twice stands once.
        rows = [rows[i] for i in _distinct_places(rows)]
        group = np.array([r[0] for r in rows], np.int64)
        stretch, window = first_windows(group, [r[4] for r in rows], length)
        new = np.ones(len(stretch), bool)
        new[1:] = (stretch[1:] != stretch[:-1]) | (window[1:] != window[:-1] + 1)
        start = np.flatnonzero(new)
        n = np.diff(np.append(start, len(stretch)))
        ord_, uid, pos = (np.array([r[k] for r in rows], np.int64)[stretch[start]] for k in (1, 2, 3))
        arrays = [pa.array(ord_), pa.array(uid), pa.array((pos + window[start]).astype(np.int32)), pa.array(n.astype(np.int32))]
        return pa.record_batch(arrays, ["ord", "uid", "pos", "n"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for row in _rows(batches):
            if size >= BATCH_WINDOWS and row[0] != held[-1][0]:
                yield judge(held)
                held, size = [], 0
            held.append(row)
            size += len(row[4]) - length + 1
        if held:
            yield judge(held)

    return scan


def _compare_hot(cut: DataFrame, length: int) -> DataFrame:
    """The repeats among all windows of stretches, by rounds of Spark sorts over rank pairs."""
    quarter = length // 4

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _batches(_rows(batches), lambda r: len(r[4]), 1 << 18):
            out = []
            for a, ord_, uid, pos, body in rows:
                for k in range(len(body) - length + 1):
                    ends = [k + quarter * q for q in range(4)] + [k + length]
                    out.append((a, ord_, uid, pos + k, *[body[i:j] for i, j in zip(ends, ends[1:])]))
            types = [pa.int64()] * 3 + [pa.int32()] + [pa.binary()] * 4
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), types)], ["a", "ord", "uid", "pos", "r0", "r1", "r2", "r3"])

    rows = cut.select("a", "ord", "uid", "pos", "body").mapInArrow(
        windows, f"a long, {DOCUMENT}, pos int, r0 binary, r1 binary, r2 binary, r3 binary"
    )
    # At a quarter's offset, then at a half's; windows whose pair is unique drop out.
    for left, right, to in (("r0", "r1", "r0"), ("r2", "r3", "r1")):
        rows = settled(_rerank(settled(rows, "hot-windows"), left, right, to), "hot-windows")
    firsts = rows.groupBy("a", "r0", "r1").agg(F.min(F.struct("ord", "uid", "pos")).alias("first"), F.count("*").alias("k"))
    repeats = rows.join(firsts.where("k > 1"), ["a", "r0", "r1"]).where(F.struct("ord", "uid", "pos") != F.col("first"))
    return repeats.select("ord", "uid", "pos", F.lit(1).alias("n"))


def _rerank(rows: DataFrame, left: str, right: str, to: str) -> DataFrame:
    """Rows whose pair of ranks is not unique, with the pair's rank in sorted order as ``to``."""
    keys = ["a", left, right]
    pairs = rows.groupBy(*keys).agg(F.count("*").alias("k")).where("k > 1")
    ranked = settled(pairs.sort(*keys).select(*keys, F.monotonically_increasing_id().alias("rank")), "rank-pairs")
    others = [c for c in rows.columns if c not in (left, right, to)]
    return rows.join(ranked, keys).select(*others, F.col("rank").alias(to))


def dedup(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the kept bytes of every document."""
    return _cut_out(docs, length, with_bytes=True)


def dedup_digests(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``dedup`` without the kept bytes."""
    return _cut_out(docs, length, with_bytes=False)


def _cut_out(docs: DataFrame, length: int, with_bytes: bool) -> DataFrame:
    own = keyed(docs)
    runs = repeated_windows(own, length)
    runs = runs.groupBy("ord", "uid").agg(F.collect_list(F.struct("pos", "n")).alias("runs"))
    joined = _packed(own).join(runs, ["ord", "uid"], "left").select("doc_id", "packed", "runs")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = zstandard.ZstdDecompressor()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                out = []
                for doc_id, packed, found in zip(*[part.column(k) for k in range(3)]):
                    text = open_.decompress(packed.as_buffer())
                    kept, n_spans = cut_runs(text, found, length)
                    row = (doc_id.as_py(), len(text), len(text) - len(kept), n_spans, hashlib.sha256(kept).hexdigest())
                    out.append((*row, kept) if with_bytes else row)
                types = [pa.int64()] * 4 + [pa.string(), pa.binary()]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), types)], list(names))

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    schema += ", kept binary" if with_bytes else ""
    names = [c.split()[0] for c in schema.split(", ")]
    return joined.mapInArrow(cut, schema)


def cut_runs(text: bytes, runs: pa.ListScalar, length: int) -> tuple[bytes, int]:
    """The bytes outside all windows of the runs, and the number of runs of bytes cut out."""
    if not runs.is_valid or not len(runs):
        return text, 0
    pos = runs.values.field("pos").to_numpy().astype(np.int64)
    n = runs.values.field("n").to_numpy()
    edges = np.zeros(len(text) + 1, np.int32)
    np.add.at(edges, pos, 1)
    np.add.at(edges, pos + n + length - 1, -1)
    gone = np.cumsum(edges[:-1]) > 0
    spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return np.frombuffer(text, np.uint8)[~gone].tobytes(), spans
