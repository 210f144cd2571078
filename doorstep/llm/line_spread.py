"""Cross-site boilerplate: lines that stand on many distinct sites are removed from every document.

A line's spread is its number of distinct sites. HyperLogLog sketches of the sites, one per line hash, merge
by aggregation; where the estimate is within ``band`` of the threshold the sites are counted exactly, so
the verdict does not hang on the sketch. The lines found are cut out of the texts, and what is counted as removed is
told by the texts before and after. Rows with the same id and text share what is cut.

A line is what newlines part, without white space at its ends; lines without a word are kept and not
counted. Lines are compared by their XXH64. A null text has no lines; null sites together are one site. A
repeated row counts by itself. An empty table gives no rows. Extra columns are ignored.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from doorstep.llm.tables import SPACES, settled


@dataclass(frozen=True)
class Spread:
    min_sites: int = 5
    #: Estimates within this share of the threshold are replaced by exact counts.
    band: float = 0.25
    #: Logarithm of a sketch's registers; its standard error is about 1.6 % at 12.
    log_registers: int = 12


def _lines(text: Column) -> Column:
    """The lines of a text without white space at their ends."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n")
    return F.transform(lines, lambda x: F.trim(x, F.lit(SPACES)))


def hashed_lines(docs: DataFrame) -> DataFrame:
    """A row per document: row (a number of its own), doc_id, its text's hash, site and its lines with a word as
    (h, chars, at), ``at`` being the place among all its lines."""
    lines = F.transform(_lines(F.col("text")), lambda x, i: F.struct(F.xxhash64(x).alias("h"), F.length(x).alias("chars"), i.alias("at")))
    lines = F.filter(lines, lambda x: x["chars"] > 0)
    return docs.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        F.xxhash64("text").alias("of"),
        F.coalesce("source", F.lit("\x00")).alias("site"),
        lines.alias("lines"),
    )


def boilerplate(hashed: DataFrame, spread: Spread = Spread()) -> DataFrame:
    """(h, sites, exact) of every line on at least ``min_sites`` sites."""
    seen = hashed.select("site", F.explode(F.array_distinct(F.col("lines.h"))).alias("h"))
    sketches = seen.groupBy("h").agg(F.hll_sketch_agg("site", spread.log_registers).alias("sketch"))
    estimates = sketches.select("h", F.hll_sketch_estimate("sketch").alias("sites"))
    # Estimates clearly below the threshold are settled by that.
    least = (1 - spread.band) * spread.min_sites
    estimates = settled(estimates.where(F.col("sites") >= least), "line-spread")
    near = F.abs(F.col("sites") - spread.min_sites) <= spread.band * spread.min_sites
    # Copies of a site collapse before they travel, so a line on very many documents stays small.
    close = estimates.where(near).select("h")
    counted = seen.join(close, "h").groupBy("h", "site").agg(F.lit(1).alias("one"))
    counted = counted.groupBy("h").agg(F.sum("one").alias("sites"))
    known = estimates.where(~near).select("h", "sites", F.lit(False).alias("exact"))
    known = known.unionByName(counted.select("h", "sites", F.lit(True).alias("exact")))
    return settled(known.where(F.col("sites") >= spread.min_sites), "boilerplate")


def _cut(docs: DataFrame, spread: Spread) -> DataFrame:
    """Per row: ``doc`` (its columns but the text), ``parts`` (all its lines) and ``cleaned``, the text without boilerplate."""
    hashed = settled(hashed_lines(docs), "hashed-lines")
    found = boilerplate(hashed, spread).select("h")
    gone = hashed.select("doc_id", "of", F.explode("lines").alias("line")).select("doc_id", "of", "line.h", "line.at").join(found, "h")
    gone = gone.groupBy(F.col("doc_id").alias("id"), F.col("of").alias("same")).agg(F.collect_set("at").alias("gone"))
    whole = docs.select(
        F.struct(*[c for c in docs.columns if c != "text"]).alias("doc"),
        F.split("text", "\n").alias("parts"),
        F.xxhash64("text").alias("of"),
    )
    met = whole.join(gone, F.col("doc.doc_id").eqNullSafe(F.col("id")) & (F.col("of") == F.col("same")), "left")
    # The places that stay by a hashed difference: linear however many lines a text has.
    places = F.array_except(F.sequence(F.lit(0), F.size("parts") - 1), F.col("gone"))
    kept = F.when(F.col("gone").isNull(), F.col("parts")).otherwise(F.transform(places, lambda p: F.get("parts", p)))
    return met.select("doc", "parts", F.array_join(kept, "\n").alias("cleaned"))


def line_counts(docs: DataFrame, spread: Spread = Spread()) -> DataFrame:
    """doc_id, n_lines, n_removed and removed_chars of every row, from its text before and after."""
    before = F.filter(_lines(F.array_join("parts", "\n")), lambda x: x != "")
    after = F.filter(_lines(F.col("cleaned")), lambda x: x != "")

    def chars(lines: Column) -> Column:
        return F.aggregate(lines, F.lit(0).cast("long"), lambda total, x: total + F.length(x))

    lines = _cut(docs, spread).select(F.col("doc.doc_id").alias("doc_id"), before.alias("before"), after.alias("after"))
    return lines.select(
        "doc_id",
        F.size("before").cast("long").alias("n_lines"),
        (F.size("before") - F.size("after")).cast("long").alias("n_removed"),
        (chars(F.col("before")) - chars(F.col("after"))).alias("removed_chars"),
    )


def clean_documents(docs: DataFrame, spread: Spread = Spread()) -> DataFrame:
    """The documents without boilerplate lines, with their own columns; ``n_chars`` is counted anew."""
    columns = {"text": F.col("cleaned"), "n_chars": F.length("cleaned").cast("long")}
    return _cut(docs, spread).select(*[columns.get(c, F.col("doc").getField(c)).alias(c) for c in docs.columns])
