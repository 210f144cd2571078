"""Mixing sources to target weights: Sainte-Laguë apportionment of equal-token blocks.

Sources share ``share`` times all words by weight; no target is above ``cap`` times its source's size, and
what is cut off goes to the other sources by weight. A source's documents are dealt to shards by a seeded
hash, so that a source of any size becomes pieces of bounded size. Blocks of ``block_words`` words are
given to sources, and each source's blocks to its shards, one at a time to the highest quotient
target / (2 k + 1), k being the blocks held so far. A shard's documents stand in seeded order, cut into
blocks; its quota takes every block as often as it goes round, and the rest as a run of blocks from a
seeded start.

The seat-by-seat rule is carried out by its equivalent: a party gets target / d rounded, with the one
divisor d at which the seats add up. Each round of Spark sums tries ``TRIES`` divisors.

A null text has size zero; a null source is a source of its own and comes last; rows that repeat a
``doc_id``, or have none, count one by one, and their texts and copy numbers spread them over the shards. Rows
that are equal in id, source and text are counted and told apart by a copy number only. Sources or tables without words take nothing. Extra columns are ignored.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from doorstep.llm.tables import settled, words

TRIES = 16
ROUNDS = 14
#: Equal rows that are numbered in one go.
COPIES = 4096


@dataclass(frozen=True)
class Mix:
    weights: tuple[int, ...] = (5, 2, 1)
    share: float = 1.5
    cap: float = 2.0
    block_words: int = 16
    shard_words: int = 1 << 22
    seed: int = 20


def source_targets(sizes: DataFrame, mix: Mix) -> DataFrame:
    """(source, source_size, target) from (source, source_size)."""
    ranked = _ranked(sizes)
    n = len(mix.weights)
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in mix.weights]), ((F.col("rank") % n) + 1).cast("int")
    )
    ranked = settled(
        ranked.withColumn("weight", weight).withColumn("most", mix.cap * F.col("source_size")), "sources"
    )
    total = ranked.agg(F.sum("source_size").alias("words")).first().words or 0
    level, capped = 0.0, -1
    while True:
        # Sources whose weighted share at this level is above their cap stay at the cap.
        above = F.col("weight") * level > F.col("most")
        seen = ranked.agg(
            F.sum(above.cast("long")).alias("capped"),
            F.sum(F.when(above, F.col("most")).otherwise(0.0)).alias("fixed"),
            F.sum(F.when(above, 0.0).otherwise(F.col("weight"))).alias("weights"),
        ).first()
        if not seen.weights or seen.capped == capped:
            break
        capped = seen.capped
        level = (mix.share * total - seen.fixed) / seen.weights
    target = F.when(above, F.col("most")).otherwise(F.col("weight") * level)
    return ranked.select("source", "source_size", "rank", target.alias("target"))


def _ranked(sizes: DataFrame) -> DataFrame:
    """Rank from 0 by code point, null last, through a range-partitioned sort."""
    order = [F.col("source").isNull(), F.col("source")]
    dealt = settled(
        sizes.repartitionByRange(*order).withColumn("piece", F.spark_partition_id()), "sources"
    )
    pieces = dealt.groupBy("piece").agg(F.count("*").alias("n")).orderBy("piece").collect()
    before, starts = 0, []
    for row in pieces:
        starts += [F.lit(row.piece), F.lit(before)]
        before += row.n
    start = F.create_map(*starts)[F.col("piece")] if starts else F.lit(0)
    within = F.row_number().over(Window.partitionBy("piece").orderBy(*order)) - 1
    return dealt.withColumn("rank", start + within).drop("piece")


def apportion(parties: DataFrame, seats: DataFrame) -> DataFrame:
    """Sainte-Laguë seats of each party of (group, party, target, most) from (group, seats): adds ``quota``.

    Parties of a group that stand exactly level for the last seats get them in the order of ``party``.
    """
    parties = settled(parties.join(seats, "group"), "parties")
    target, spare = F.col("target"), F.col("parties") / 2
    total = parties.groupBy("group").agg(
        F.first("seats").alias("seats"),
        F.sum("target").alias("all"),
        F.max("target").alias("top"),
        F.count("*").alias("parties"),
    )
    # Rounded sums are within half a seat per party of the exact ones, which brackets the divisor.
    bounds = total.select(
        "group",
        "seats",
        (F.col("all") / (F.col("seats") + spare)).alias("low"),
        F.when(F.col("seats") > spare, F.col("all") / (F.col("seats") - spare))
        .otherwise(2 * F.col("top") + 1)
        .alias("high"),
    ).where("all > 0")
    bounds = settled(bounds, "bounds")
    for _ in range(ROUNDS):
        step = (F.col("high") - F.col("low")) / TRIES
        tried = [F.col("low") + step * k for k in range(TRIES + 1)]
        sums = (
            parties.select("group", "target")
            .join(bounds, "group")
            .groupBy("group", "seats", "low", "high")
            .agg(F.array(*[F.sum(_rounded(target, d)) for d in tried]).alias("given"))
        )
        # The first divisor that gives fewer seats than there are; the one before gives enough.
        over = F.size(F.filter("given", lambda g: g >= F.col("seats")))
        over = F.greatest(F.least(over, F.lit(TRIES)), F.lit(1))
        low = F.col("low") + step * (over - 1)
        exact = F.get("given", over - 1) == F.col("seats")
        high = F.when(exact, low).otherwise(F.col("low") + step * over)
        bounds = settled(sums.select("group", "seats", low.alias("low"), high.alias("high")), "bounds")
        wide = bounds.where(F.col("high") - F.col("low") > 1e-12 * F.col("high"))
        if wide.isEmpty():
            break
    held = parties.drop("seats").join(bounds, "group", "left")
    sure, more = _rounded(target, F.col("high")), _rounded(target, F.col("low"))
    held = held.withColumn("sure", F.coalesce(sure, F.lit(0))).withColumn(
        "level", F.coalesce(more, F.lit(0)) > F.col("sure")
    )
    held = settled(held, "held")
    level = held.where("level")
    missing = held.groupBy("group").agg((F.first("seats") - F.sum("sure")).alias("missing"))
    turn = F.row_number().over(Window.partitionBy("group").orderBy("party"))
    last = level.withColumn("turn", turn).join(missing, "group").where(F.col("turn") <= F.col("missing"))
    last = last.select("group", "party", F.lit(1).alias("one_more"))
    quota = F.least(F.col("sure") + F.coalesce("one_more", F.lit(0)), F.col("most"))
    return held.join(last, ["group", "party"], "left").withColumn("quota", quota).drop(
        "seats", "low", "high", "sure", "level", "one_more"
    )


def _rounded(target: Column, divisor: Column) -> Column:
    return F.floor(target / divisor + 0.5)


#: What tells the rows of a source apart: id, hash of the text, copy number.
IDENTITY = ["doc_id", "of", "copy"]


def _numbered(counted: DataFrame) -> DataFrame:
    """The ``n`` equal rows that each row stands for, with their number ``copy``.

    They are numbered in pieces that are dealt to tasks, so that a row with very many copies is no one task's work.
    """
    n = F.col("n")
    pieces = counted.withColumn("piece", F.explode(F.sequence(F.lit(0), F.floor((n - 1) / COPIES))))
    first = F.col("piece") * COPIES
    last = F.least(first + COPIES, n) - 1
    dealt = pieces.repartition("doc_id", "of", "piece")
    return dealt.withColumn("copy", F.explode(F.sequence(first, last))).drop("piece")


def _dealt(docs: DataFrame, mix: Mix) -> tuple[DataFrame, DataFrame]:
    """The sources with their targets, and every row with its source's rank and its shard."""
    size = F.size(words(F.col("text"))).cast("long").alias("size")
    sized = docs.select("doc_id", "source", size, F.xxhash64("text").alias("of"))
    sized = settled(sized.groupBy("doc_id", "source", "size", "of").agg(F.count("*").alias("n")), "sizes")
    sources = sized.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    sources = settled(source_targets(sources, mix), "targets")
    sized = _numbered(sized)

    n_shards = F.greatest(F.ceil(F.col("source_size") / mix.shard_words), F.lit(1))
    dealt = sized.join(sources, sized["source"].eqNullSafe(sources["source"])).select(
        "doc_id",
        "size",
        sources["source"],
        "source_size",
        "target",
        "rank",
        *IDENTITY[1:],
        "n",
        F.pmod(F.xxhash64(F.lit(mix.seed), *IDENTITY), n_shards).alias("shard"),
    )
    return sources, settled(dealt, "dealt")


def _shards(dealt: DataFrame) -> DataFrame:
    return dealt.groupBy("rank", "shard").agg(
        F.sum("size").alias("shard_size"), F.first("source_size").alias("all"), F.first("target").alias("share")
    )


def shard_sizes(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """(source, shard, shard_size, n_rows) of every shard that the mix would order."""
    _, dealt = _dealt(docs, mix)
    return dealt.groupBy("source", "shard").agg(F.sum("size").alias("shard_size"), F.count("*").alias("n_rows"))


def plan(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """Per row: doc_id, size, source, source_size, target, rounds and the word runs taken once more; ``of`` is its
    text's hash, ``n`` the number of rows equal to it.

    ``runs`` holds (first, length) within the document's words; together with ``rounds`` whole
    passes they make ``taken``.
    """
    sources, dealt = _dealt(docs, mix)
    shards = _shards(dealt)
    shards = settled(
        shards.where("shard_size > 0").select(
            "rank",
            "shard",
            "shard_size",
            F.ceil(F.col("shard_size") / mix.block_words).alias("blocks"),
            (F.col("share") * F.col("shard_size") / F.col("all")).alias("target"),
        ),
        "shards",
    )
    seats = sources.agg(F.round(F.sum("target") / mix.block_words).cast("long").alias("n")).first().n or 0
    parties = sources.select(
        F.lit(0).alias("group"), F.col("rank").alias("party"), "target", F.lit(2**62).alias("most")
    )
    one = sources.sparkSession.range(1).select(F.lit(0).alias("group"), F.lit(seats).alias("seats"))
    quotas = apportion(parties, one).select(F.col("party").alias("group"), F.col("quota").alias("seats"))
    by_shard = shards.select(
        F.col("rank").alias("group"),
        F.col("shard").alias("party"),
        "target",
        (F.col("blocks") * int(mix.cap)).alias("most"),
        "blocks",
        "shard_size",
    )
    by_shard = apportion(by_shard, quotas)
    start = F.pmod(F.xxhash64(F.lit(mix.seed), "group", "party"), F.col("blocks"))
    by_shard = by_shard.select(
        F.col("group").alias("rank"),
        F.col("party").alias("shard"),
        "shard_size",
        F.floor(F.col("quota") / F.col("blocks")).alias("rounds"),
        (F.col("quota") % F.col("blocks") * mix.block_words).alias("run"),
        (start * mix.block_words).alias("run_start"),
        (F.col("blocks") * mix.block_words).alias("cycle"),
    )
    order = Window.partitionBy("rank", "shard").orderBy(
        F.xxhash64(F.lit(mix.seed), F.lit("order"), *IDENTITY), *IDENTITY, "size"
    )
    placed = (
        dealt.where("size > 0")
        .withColumn("ends", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("begins", F.col("ends") - F.col("size"))
    )
    placed = placed.join(by_shard, ["rank", "shard"]).withColumn("runs", _runs())
    return placed.select(_kept_columns("rounds", "runs")).unionByName(
        dealt.where("size = 0").select(
            _kept_columns(F.lit(0).cast("long").alias("rounds"), F.lit(None).cast(_RUNS).alias("runs"))
        )
    )


_RUNS = "array<struct<first:bigint,length:bigint>>"


def _kept_columns(*more) -> list:
    return [F.col(c) for c in ("doc_id", "size", "source", "source_size", "target", "of", "n")] + [
        F.col(c) if isinstance(c, str) else c for c in more
    ]


def _runs() -> Column:
    """Where the shard's run, which may go past its end and on from its start, meets the document."""
    begins, ends = F.col("begins"), F.col("ends")
    stop = F.col("run_start") + F.col("run")

    def meet(low: Column, high: Column) -> Column:
        first, last = F.greatest(low, begins), F.least(high, ends)
        return F.struct((first - begins).alias("first"), (last - first).alias("length"))

    both = F.array(
        meet(F.lit(0).cast("long"), stop - F.col("cycle")),
        meet(F.col("run_start"), F.least(stop, F.col("cycle"))),
    )
    return F.filter(both, lambda r: r["length"] > 0).cast(_RUNS)


def mix_sources(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """doc_id, size, source_size, target and ``taken`` (words, repeats counted) of every row."""
    more = F.aggregate(
        F.coalesce("runs", F.array().cast(_RUNS)), F.lit(0).cast("long"), lambda a, r: a + r["length"]
    )
    taken = F.col("rounds") * F.col("size") + more
    return plan(docs, mix).select("doc_id", "size", "source_size", "target", taken.alias("taken"))


def mixed_documents(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The mix as documents: a row for every whole pass over a document and one for every run of its words.

    A run keeps the text between its words; ``n_chars`` is counted anew. Rows that repeat a ``doc_id`` are known
    by their source and text. What rows equal in all three take goes to one of them, the one whose other
    columns come first.
    """
    taken = plan(docs, mix).where("rounds > 0 OR size(runs) > 0").select("doc_id", "source", "of", "n", "rounds", "runs")
    taken = settled(taken, "taken")
    several = taken.where("n > 1")
    columns = [c for c in docs.columns if c not in ("doc_id", "source", "text")]
    alike = docs.alias("d").join(several.alias("t"), _same_row(), "left_semi").groupBy("doc_id", "source", "text")
    alike = alike.agg(F.min(F.struct(F.lit(0).alias("0"), *columns)).alias("rest"))
    alike = alike.select("doc_id", "source", "text", *[F.col("rest")[c].alias(c) for c in columns]).select(docs.columns)
    return _taken_texts(docs, taken.where("n = 1")).unionByName(_taken_texts(alike, several))


def _same_row() -> Column:
    """A document ``d`` is what ``t`` was planned for."""
    same = [F.col(f"d.{c}").eqNullSafe(F.col(f"t.{c}")) for c in ("doc_id", "source")]
    return same[0] & same[1] & (F.xxhash64("d.text") == F.col("t.of"))


def _taken_texts(docs: DataFrame, taken: DataFrame) -> DataFrame:
    text, rounds, runs = F.col("d.text"), F.col("t.rounds"), F.col("t.runs")
    whole = F.array_repeat(text, rounds.cast("int"))
    # Each piece is a word and the white space after it.
    pieces = F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+[\x20\x09-\x0D]*)"), 1)
    parts = F.transform(
        runs,
        lambda r: F.array_join(
            F.slice(pieces, (r["first"] + 1).cast("int"), r["length"].cast("int")), ""
        ),
    )
    run_texts = F.when(F.size(runs) > 0, parts).otherwise(F.array().cast("array<string>"))
    texts = docs.alias("d").join(taken.alias("t"), _same_row()).select(
        *[F.col(f"d.`{c}`") for c in docs.columns if c not in ("text", "n_chars")],
        F.explode(F.concat(whole, run_texts)).alias("text"),
    )
    return texts.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)
