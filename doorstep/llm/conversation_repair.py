"""Repair of conversations: the cheapest edits that make the roles read ``(s?(ua)+)?``, by a grammar-compressed DP.

Rows are ordered by turn (nulls first). A row's first fault counts: ``blank`` (nothing but white space),
``duplicate`` (role and text seen earlier in the conversation) or ``truncated`` (ends without ``.!?``).
Edits are Keep (0), Rerole to user or assistant (2), Delete (3; blank and duplicate rows must go) and Insert
of an empty user or assistant message (2); a truncated row that stays costs 1. Among the cheapest edits
those whose initials come first in ASCII are taken.

* A row is one of nine symbols: its role's initial (s, u, a, or x for any other), in capitals if
  truncated, or d if it must go. Rows are sorted over the whole table, so a conversation of any size is spread
  over tasks; each task writes its part as pieces of at most ``PIECE_ROWS`` symbols.
* Re-Pair rounds replace the most frequent pairs of the distinct pieces by new symbols (rules).
* A symbol is a min-plus matrix between the states of the role pattern (start, after s, after u, after a). An entry is
  the least cost and its audit, a rope shared with the entries it is made of. A rule's matrix is the product
  of its two parts', worked out once, bottom-up; the product over a piece's few symbols is worked out once
  per distinct piece, for all conversations that have it.
* A conversation's pieces are joined in order. Its messages are then rewritten in one sorted pass.

An audit of n rows ends with the edit of its last row, so none of two audits between the same states is the
beginning of the other; that is why the least audit of a whole is made of the least audits of its parts.

Only the last step runs over a conversation in one task, row by row in bounded memory: its hash is one
SHA-256 chain, which cannot be split.

Nulls: a null role or text is one space; rows of a null ``conv_id`` are one conversation. Rows of one turn go
by the SHA-256 of role and text. A role without characters counts as x. Repeated rows are duplicates.
Extra columns are ignored. Empty tables give empty results.
"""

import hashlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from doorstep.llm.rope import Rope
from doorstep.llm.tables import SPACES, settled

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 2, 3, 2, 1
#: States of the role pattern, and those in which a conversation may end.
START, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (START, ASSISTANT)
#: The state that an inserted or reroled message leads to: the assistant after a user, else the user.
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
SPEAKER = {USER: "user", ASSISTANT: "assistant"}
ROLES = "sua"
LEGAL = {"su", "ua", "au"}
GONE = "d"

#: Symbols that a piece holds at most; Re-Pair rounds; a round takes pairs down to this share of its most frequent.
PIECE_ROWS = 4096
ROUNDS = 16
LEAST_SHARE = 0.2
#: Pairs that a round looks at, the most frequent first.
ROUND_PAIRS = 4096

Entry = tuple[int, Rope]
Matrix = list[list[Entry | None]]
Rules = list[tuple[int, int]]


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role and text with faults planted by a checksum of (conv_id, turn)."""
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.crc32(name.cast("binary")) % 20
    text, role = (F.coalesce(F.col(c), F.lit(" ")) for c in ("text", "role"))
    return (
        conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind"))
        .where("kind <> 0")
        .select(
            "conv_id",
            "turn",
            F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(F.col("kind") == 1, "")
            .when(F.col("kind") == 2, F.translate("text", ".!?", ""))
            .otherwise(F.col("text"))
            .alias("text"),
            F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy"),
        )
        .drop("copy")
    )


def _rows(conversations: DataFrame) -> DataFrame:
    """The four columns without null roles and texts, and the key that orders rows of one turn."""
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    whole = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    return rows.withColumn("key", F.unhex(F.sha2(whole, 256)))


def _turn_order() -> Column:
    return F.struct(F.col("turn").isNotNull(), "turn")


def _faults(rows: DataFrame) -> DataFrame:
    """Distinct rows of each turn with their number, and what is wrong with the first of them."""
    bare = F.rtrim(F.col("text"), F.lit(SPACES))
    slim = rows.select(
        "conv_id",
        "turn",
        "key",
        F.substring("role", 1, 1).alias("initial"),
        (bare == "").alias("blank"),
        (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("cut"),
    )
    counted = slim.groupBy("conv_id", "turn", "key", "initial", "blank", "cut").agg(F.count("*").alias("n"))
    first = counted.groupBy(F.col("conv_id").alias("of"), F.col("key").alias("same")).agg(
        F.min(_turn_order()).alias("first")
    )
    met = counted.join(first, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("key") == F.col("same")))
    return met.select(
        "conv_id", "turn", "key", "initial", "blank", "cut", (F.col("first") < _turn_order()).alias("later"), "n"
    )


PIECES = (
    "conv_id long, piece long, symbols string, first_initial string, last_initial string, illegal long, blank long, "
    "duplicate long, truncated long, min_turn long, max_turn long, turns long"
)


class _Piece:
    """Symbols and counts of a stretch of one conversation's rows."""

    def __init__(self, conv: int | None, number: int):
        self.conv, self.number, self.symbols = conv, number, []
        self.first = self.last = None
        self.illegal = self.blank = self.duplicate = self.truncated = self.turns = 0
        self.low = self.high = None

    def add(self, turn: int | None, initial: str, symbol: str, fault: str) -> None:
        if self.first is None:
            self.first = initial
        else:
            self.illegal += self.last + initial not in LEGAL
        self.last = initial
        self.symbols.append(symbol)
        if fault:
            setattr(self, fault, getattr(self, fault) + 1)
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high, self.turns = turn, self.turns + 1

    def row(self) -> tuple:
        return (
            self.conv, self.number, "".join(self.symbols), self.first, self.last, self.illegal, self.blank,
            self.duplicate, self.truncated, self.low, self.high, self.turns,
        )


def _arrow(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}
    fields = [f.strip().split(" ") for f in schema.split(",")]
    columns = zip(*rows) if rows else [[] for _ in fields]
    return pa.record_batch([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], [n for n, _ in fields])


def _symbol(initial: str, cut: bool) -> str:
    letter = initial if initial and initial in ROLES else "x"
    return letter.upper() if cut else letter


def pieces(faults: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """The conversations as pieces of symbols; ``piece`` grows along a conversation."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, number, piece = TaskContext.get().partitionId() << 40, 0, None
        for batch in batches:
            done = []
            for conv, turn, initial, blank, cut, later, n in zip(*[c.to_pylist() for c in batch.columns]):
                if piece is not None and piece.conv != conv:
                    done.append(piece.row())
                    piece = None
                for copy in range(n):
                    if piece is None or len(piece.symbols) == piece_rows:
                        if piece is not None:
                            done.append(piece.row())
                        piece, number = _Piece(conv, base + number), number + 1
                    fault = "blank" if blank else "duplicate" if later or copy else "truncated" if cut else ""
                    symbol = GONE if fault in ("blank", "duplicate") else _symbol(initial, cut)
                    piece.add(turn, initial, symbol, fault)
                    if len(done) >= 4096:
                        yield _arrow(done, PIECES)
                        done = []
            if done:
                yield _arrow(done, PIECES)
        if piece is not None:
            yield _arrow([piece.row()], PIECES)

    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("key").asc()]
    ordered = faults.repartitionByRange(*order).sortWithinPartitions(*order)
    return ordered.select("conv_id", "turn", "initial", "blank", "cut", "later", "n").mapInArrow(build, PIECES)


BASE_SYMBOLS = [*ROLES, "x", *ROLES.upper(), "X", GONE]
SEQUENCES = "symbols string, code array<long>"


def _replace(code: list[int], rules: dict[tuple[int, int], int]) -> list[int]:
    out: list[int] = []
    for x in code:
        new = rules.get((out[-1], x)) if out else None
        if new is None:
            out.append(x)
        else:
            out[-1] = new
    return out


def _pairs(code: list[int]) -> Iterator[tuple[int, int]]:
    """Neighbouring symbols; a run of one symbol gives the pairs that do not overlap."""
    at = 0
    while at + 1 < len(code):
        a, b = code[at], code[at + 1]
        yield a, b
        at += 2 if a == b and at + 2 < len(code) and code[at + 2] == a else 1


def choose_pairs(counts: list[tuple[int, int, int]]) -> Rules:
    """The most frequent pairs that share no symbol, so that replacing one changes no other's count."""
    counts = sorted((-n, a, b) for a, b, n in counts if n > 1)
    chosen, used = [], set()
    for n, a, b in counts:
        if -n < LEAST_SHARE * -counts[0][0]:
            break
        if a not in used and b not in used:
            chosen.append((a, b))
            used |= {a, b}
    return chosen


def grammar(symbols: DataFrame, rounds: int = ROUNDS) -> tuple[Rules, DataFrame]:
    """Re-Pair rules over the distinct ``symbols``, and every sequence in terms of them.

    Rule k is symbol ``len(BASE_SYMBOLS) + k``; its parts come before it. Only pair counts reach the driver.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {s: i for i, s in enumerate(BASE_SYMBOLS)}
        for batch in batches:
            rows = [(s, [number[c] for c in s]) for s in batch.column(0).to_pylist()]
            yield _arrow(rows, SEQUENCES)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for code in batch.column(0).to_pylist():
                found.update(_pairs(code))
        yield _arrow([(a, b, n) for (a, b), n in found.items()], "a long, b long, n long")

    rules: Rules = []
    codes = settled(symbols.select("symbols").distinct().mapInArrow(encode, SEQUENCES), "sequences")
    for _ in range(rounds):
        counts = codes.select("code").mapInArrow(count, "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))
        top = counts.where("n > 1").orderBy(F.desc("n"), "a", "b").limit(ROUND_PAIRS).collect()
        chosen = choose_pairs([tuple(r) for r in top])
        if not chosen:
            break
        first = len(BASE_SYMBOLS) + len(rules)
        batch_rules = {pair: first + k for k, pair in enumerate(chosen)}
        rules += chosen

        def replace(batches: Iterator[pa.RecordBatch], batch_rules=batch_rules) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = zip(*[c.to_pylist() for c in batch.columns])
                yield _arrow([(s, _replace(code, batch_rules)) for s, code in rows], SEQUENCES)

        codes = settled(codes.mapInArrow(replace, SEQUENCES), "sequences")
    return rules, codes


def symbol_matrix(symbol: str) -> Matrix:
    """Least cost and audit of one row, with the messages inserted before it, from state to state."""
    matrix: Matrix = [[None] * 4 for _ in range(4)]
    extra = TRUNCATED_COST if symbol.isupper() else 0
    own = symbol.lower()

    def offer(start: int, end: int, cost: int, audit: str) -> None:
        entry = cost, Rope.of(audit)
        if matrix[start][end] is None or entry < matrix[start][end]:
            matrix[start][end] = entry

    for start in range(4):
        at, cost, audit = start, 0, ""
        for _ in range(3):
            offer(start, at, cost + DELETE_COST, audit + DELETE)
            if own != GONE:
                offer(start, NEXT[at], cost + REROLE_COST + extra, audit + REROLE)
            if (own == "s" and at == START) or (own in "ua" and SPEAKER[NEXT[at]][0] == own):
                end = SYSTEM if own == "s" else NEXT[at]
                offer(start, end, cost + extra, audit + KEEP)
            at, cost, audit = NEXT[at], cost + INSERT_COST, audit + INSERT
    return matrix


def product(a: Matrix, b: Matrix) -> Matrix:
    """The min-plus product: rows of ``a``, then those of ``b``."""
    out: Matrix = [[None] * 4 for _ in range(4)]
    for i in range(4):
        for j in range(4):
            best = None
            for k in range(4):
                x, y = a[i][k], b[k][j]
                if x is None or y is None or (best is not None and x[0] + y[0] > best[0]):
                    continue
                entry = x[0] + y[0], x[1] + y[1]
                if best is None or entry < best:
                    best = entry
            out[i][j] = best
    return out


def rule_matrices(rules: Rules) -> list[Matrix]:
    """Matrices of all symbols, rules bottom-up."""
    matrices = [symbol_matrix(s) for s in BASE_SYMBOLS]
    for a, b in rules:
        matrices.append(product(matrices[a], matrices[b]))
    return matrices


TRANSFERS = "of string, costs array<long>, audits array<string>"


def transfers(codes: DataFrame, rules: Rules) -> DataFrame:
    """Costs and audits of every distinct piece for all pairs of states; null where no edits lead."""
    matrices = rule_matrices(rules)

    def evaluate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for symbols, code in zip(*[c.to_pylist() for c in batch.columns]):
                whole = matrices[code[0]]
                for symbol in code[1:]:
                    whole = product(whole, matrices[symbol])
                entries = [e for row in whole for e in row]
                rows.append((symbols, [e and e[0] for e in entries], [e and str(e[1]) for e in entries]))
            yield _arrow(rows, TRANSFERS)

    return codes.mapInArrow(evaluate, TRANSFERS)


SUMMARY = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


class _Whole:
    """The pieces of one conversation so far: counts, and the best way to every state."""

    def __init__(self, conv: int | None):
        self.conv = conv
        self.ways: list[Entry | None] = [(0, Rope.of("")), None, None, None]
        self.counts = [0, 0, 0]
        self.illegal = self.turns = 0
        self.low = self.high = self.last = None

    def add(self, first, last, illegal, blank, duplicate, truncated, low, high, turns, costs, audits) -> None:
        self.counts = [a + b for a, b in zip(self.counts, (blank, duplicate, truncated))]
        self.illegal += illegal + (self.last is not None and self.last + first not in LEGAL)
        self.last = last
        if low is not None:
            self.turns += turns - (low == self.high)
            self.low = low if self.low is None else self.low
            self.high = high
        ways: list[Entry | None] = [None] * 4
        for i, way in enumerate(self.ways):
            for j in range(4):
                if way is None or costs[4 * i + j] is None:
                    continue
                cost = way[0] + costs[4 * i + j]
                if ways[j] is not None and cost > ways[j][0]:
                    continue
                entry = cost, way[1] + Rope.of(audits[4 * i + j])
                if ways[j] is None or entry < ways[j]:
                    ways[j] = entry
        self.ways = ways

    def row(self) -> tuple:
        best = None
        for state, way in enumerate(self.ways):
            while way is not None and state not in ENDS:
                way, state = (way[0] + INSERT_COST, way[1] + Rope.of(INSERT)), NEXT[state]
            if way is not None and (best is None or way < best):
                best = way
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return self.conv, gaps, *self.counts, self.illegal, best[0], str(best[1])


def summaries(found: DataFrame, transfer: DataFrame) -> DataFrame:
    """Counts, cost and audit of every conversation from its pieces, which are met in order."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = None
        for batch in batches:
            done = []
            for conv, *row in zip(*[c.to_pylist() for c in batch.columns]):
                if whole is None or whole.conv != conv:
                    if whole is not None:
                        done.append(whole.row())
                    whole = _Whole(conv)
                whole.add(*row)
            if done:
                yield _arrow(done, SUMMARY)
        if whole is not None:
            yield _arrow([whole.row()], SUMMARY)

    met = found.join(transfer, found["symbols"] == transfer["of"])
    ordered = met.repartition("conv_id").sortWithinPartitions("conv_id", "piece")
    return ordered.select(
        "conv_id", "first_initial", "last_initial", "illegal", "blank", "duplicate", "truncated", "min_turn",
        "max_turn", "turns", "costs", "audits",
    ).mapInArrow(join, SUMMARY)


def summarise(conversations: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """gaps, fault counts, cost and audit of every conversation that has rows."""
    found = settled(pieces(_faults(_rows(conversations)), piece_rows), "pieces")
    rules, codes = grammar(found)
    return settled(summaries(found, transfers(codes, rules)), "conversations")


MESSAGES = "conv_id long, position long, edit string, role string, text string"


def repaired_messages(conversations: DataFrame, summary: DataFrame) -> DataFrame:
    """The messages that the audits leave, in order within each task: conv_id, position, edit, role and text.

    A conversation's audit comes first among its rows, so that a row is rewritten as it passes.
    """

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, audit, at, state, position = None, "", 0, START, 0
        out: list[tuple] = []

        def inserted() -> None:
            nonlocal at, state, position
            while at < len(audit) and audit[at] == INSERT:
                state = NEXT[state]
                out.append((conv, position, INSERT, SPEAKER[state], ""))
                at, position = at + 1, position + 1

        for batch in batches:
            for row_conv, header, role, text in zip(*[c.to_pylist() for c in batch.columns]):
                if header is not None:
                    inserted()
                    conv, audit, at, state, position = row_conv, header, 0, START, 0
                    continue
                inserted()
                edit, at = audit[at], at + 1
                if edit == DELETE:
                    continue
                if edit == REROLE:
                    state = NEXT[state]
                    role = SPEAKER[state]
                else:
                    state = SYSTEM if role[0] == "s" else NEXT[state]
                out.append((conv, position, edit, role, text))
                position += 1
                if len(out) >= 1024:
                    yield _arrow(out, MESSAGES)
                    out = []
            if out:
                yield _arrow(out, MESSAGES)
                out = []
        inserted()
        if out:
            yield _arrow(out, MESSAGES)

    heads = summary.select("conv_id", "audit", F.lit(None).cast("long").alias("turn"), *[
        F.lit(None).cast(kind).alias(c) for c, kind in (("key", "binary"), ("role", "string"), ("text", "string"))
    ])
    rows = _rows(conversations).select("conv_id", F.lit(None).cast("string").alias("audit"), "turn", "key", "role", "text")
    ordered = (
        heads.unionByName(rows)
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", F.col("audit").isNull(), F.col("turn").asc_nulls_first(), "key")
    )
    return ordered.select("conv_id", "audit", "role", "text").mapInArrow(rewrite, MESSAGES)


def message_digests(messages: DataFrame) -> DataFrame:
    """SHA-256 of every conversation's ``role:text`` lines; takes the rows of ``repaired_messages`` as they come."""
    schema = "of long, repaired_sha256 string"

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state = None, None
        for batch in batches:
            done = []
            for row_conv, position, role, text in zip(*[c.to_pylist() for c in batch.columns]):
                if position == 0:
                    if state is not None:
                        done.append((conv, state.hexdigest()))
                    conv, state = row_conv, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(f"{role}:{text}".encode())
            if done:
                yield _arrow(done, schema)
        if state is not None:
            yield _arrow([(conv, state.hexdigest())], schema)

    return messages.select("conv_id", "position", "role", "text").mapInArrow(digest, schema)


def repair(conversations: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Summary and digest of every conversation; ``ids`` (conv_id) names those that may have no rows."""
    ids = (conversations if ids is None else ids).select(F.col("conv_id").alias("id")).distinct()
    summary = summarise(conversations)
    digests = message_digests(repaired_messages(conversations, summary))
    counts = [c for c in summary.columns if c not in ("conv_id", "audit")]
    return (
        ids.join(summary, F.col("id").eqNullSafe(F.col("conv_id")), "left")
        .join(digests, F.col("id").eqNullSafe(F.col("of")), "left")
        .select(
            F.col("id").alias("conv_id"),
            *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
            F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
        )
    )
