"""Quality rules judged per host: failure rates shrunk by an empirical beta prior decide with the document.

Every document is measured by built-in functions in its scan task. Failures are summed by host, the
rates of small hosts are pulled towards the rate of all hosts, and each document gets its host's verdict:

* a host whose shrunk rate of any rule is above ``reject_rate`` loses all its documents;
* a host at or below ``trust_rate`` for a rule keeps documents that fail only that soft rule;
* any other host loses the documents that fail a soft rule, and keeps the rest.

A document that fails a base rule goes whatever its host says.

Nulls: a null text has no words; a null host is a host of its own. An empty table gives no rows.
Repeated rows are judged one by one. Extra columns are ignored.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from doorstep.llm.tables import SPACES, settled, words

SYMBOLS = "#*$%&|<>"
RULES = ("few_words", "repetitive", "symbols", "dup_lines")
SOFT_RULES = ("symbols", "dup_lines")
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class HostRules:
    min_words: int = 50
    repeat_percent: int = 50
    #: Soft rules: symbols per 100 words, repeated lines per 100 lines with a word.
    symbol_percent: int = 50
    dup_line_percent: int = 30
    reject_rate: float = 0.8
    trust_rate: float = 0.005


def _windows(tokens: Column, with_words: bool = False) -> Column:
    """Every three-word window as its hash, its words if asked for, and its position, sorted."""
    last = F.size(tokens) - 2

    def window(i: Column) -> Column:
        own = [tokens[i - 1], tokens[i], tokens[i + 1]]
        kept = [w.alias(f"w{k}") for k, w in enumerate(own)] if with_words else []
        return F.struct(F.xxhash64(*own).alias("hash"), *kept, i.alias("at"))

    windows = F.sort_array(F.transform(F.sequence(F.lit(1), last), window))
    # The filter keeps nothing; it gives the type.
    return F.when(last >= 2, windows).otherwise(
        F.filter(F.transform(F.array(F.lit(1)), lambda i: _no_window(i, with_words)), lambda _: F.lit(False))
    )


def _no_window(at: Column, with_words: bool) -> Column:
    kept = [F.lit("").alias(f"w{k}") for k in range(3)] if with_words else []
    return F.struct(F.lit(0).cast("long").alias("hash"), *kept, at.alias("at"))


def _equal_hashes(x: Column, y: Column) -> Column:
    return F.coalesce(x["hash"] == y["hash"], F.lit(False))


def _equal_words(tokens: Column, x: Column, y: Column) -> Column:
    pairs = [F.get(tokens, x["at"] + k) == F.get(tokens, y["at"] + k) for k in (-1, 0, 1)]
    return F.coalesce(pairs[0] & pairs[1] & pairs[2], F.lit(False))


def _repeated_starts(windows: Column, tokens: Column) -> Column:
    """Positions of the windows whose hash and words equal a neighbour's in the sorted array."""

    def same(x: Column, y: Column) -> Column:
        return _equal_hashes(x, y) & _equal_words(tokens, x, y)

    kept = F.filter(windows, lambda x, i: same(x, F.get(windows, i + 1)) | same(x, F.get(windows, i - 1)))
    return F.transform(kept, lambda x: x["at"])


def _clashes(windows: Column, tokens: Column) -> Column:
    """Whether neighbours have equal hashes but different words; equal windows may then stand apart."""

    def differ(x: Column, y: Column) -> Column:
        return _equal_hashes(x, y) & ~_equal_words(tokens, x, y)

    return F.size(F.filter(windows, lambda x, i: differ(x, F.get(windows, i + 1)))) > 0


def measure(docs: DataFrame) -> DataFrame:
    """doc_id, host and the five measures of every document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(F.col("body"), "\n"), lambda x: F.ltrim(x, F.lit(SPACES)) != "")
    starts = F.col("starts")
    covered = F.concat(starts, F.transform(starts, lambda p: p + 1), F.transform(starts, lambda p: p + 2))
    return (
        docs.select("doc_id", F.col("source").alias("host"), text.alias("body"))
        .withColumn("words", words(F.col("body")))
        .withColumn("lines", lines)
        .withColumn("windows", _windows(F.col("words")))
        # Only where a hash stands for two windows are they sorted by their words too.
        .withColumn(
            "windows_by_words",
            F.when(_clashes(F.col("windows"), F.col("words")), _windows(F.col("words"), with_words=True)),
        )
        .withColumn(
            "starts",
            F.when(
                F.col("windows_by_words").isNull(), _repeated_starts(F.col("windows"), F.col("words"))
            ).otherwise(_repeated_starts(F.col("windows_by_words"), F.col("words"))),
        )
        .select(
            "doc_id",
            "host",
            F.size("words").cast("long").alias("n_words"),
            F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
            (F.length("body") - F.length(F.translate("body", SYMBOLS, "")))
            .cast("long")
            .alias("n_symbols"),
            (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
            F.size(F.array_distinct(covered)).cast("long").alias("n_repeat_words"),
            F.size("lines").cast("long").alias("n_lines"),
        )
    )


def failures(measured: DataFrame, rules: HostRules) -> DataFrame:
    """One boolean per rule beside the measures."""
    return measured.withColumns(
        {
            "few_words": F.col("n_words") < rules.min_words,
            "repetitive": 100 * F.col("n_repeat_words") > rules.repeat_percent * F.col("n_words"),
            "symbols": 100 * F.col("n_symbols") > rules.symbol_percent * F.col("n_words"),
            "dup_lines": 100 * F.col("n_dup_lines") > rules.dup_line_percent * F.col("n_lines"),
        }
    )


def host_rates(failed: DataFrame) -> DataFrame:
    """Per host: documents, failures and the shrunk failure rate of every rule.

    The prior is a beta distribution by moments: its mean is the rate over all documents, its
    variance what the hosts' rates vary beyond sampling. Where they vary no more than that, all
    hosts get the common rate.
    """
    counts = failed.groupBy("host").agg(
        F.count("*").alias("n_docs"),
        *[F.sum(F.col(r).cast("long")).alias(f"{r}_failures") for r in RULES],
    )
    counts = settled(counts, "hosts")
    totals = counts.agg(
        F.count("*").alias("hosts"),
        F.coalesce(F.sum("n_docs"), F.lit(0)).alias("docs"),
        *[F.coalesce(F.sum(f"{r}_failures"), F.lit(0)).alias(r) for r in RULES],
    ).first()
    means = {r: totals[r] / max(totals["docs"], 1) for r in RULES}
    spreads = counts.agg(*[F.sum(_spread(r, means[r])).alias(r) for r in RULES]).first()
    rates = [
        _shrunk(r, means[r], _prior_weight(means[r], spreads[r], totals["hosts"], totals["docs"])).alias(
            f"{r}_rate"
        )
        for r in RULES
    ]
    return counts.select("host", "n_docs", *[f"{r}_failures" for r in RULES], *rates)


def _spread(rule: str, mean: float) -> Column:
    return F.col("n_docs") * F.pow(F.col(f"{rule}_failures") / F.col("n_docs") - mean, 2)


def _prior_weight(mean: float, spread: float | None, hosts: int, docs: int) -> float | None:
    """Documents that the prior counts for; none if the hosts' rates vary by sampling alone."""
    noise = mean * (1 - mean)
    variance = ((spread or 0.0) - noise * (hosts - 1)) / max(docs, 1)
    return max(noise / variance - 1, 0.0) if variance > 1e-12 else None


def _shrunk(rule: str, mean: float, weight: float | None) -> Column:
    if weight is None:
        return F.lit(mean)
    return (mean * weight + F.col(f"{rule}_failures")) / (weight + F.col("n_docs"))


def judge(docs: DataFrame, rules: HostRules = HostRules()) -> DataFrame:
    """doc_id, the five measures, ``base_failed``, ``kept`` and the host's rates."""
    failed = failures(settled(measure(docs), "host-quality"), rules)
    hosts = host_rates(failed)
    rejected = F.greatest(*[F.col(f"{r}_rate") for r in RULES]) > rules.reject_rate
    soft_failed = F.lit(False)
    for rule in SOFT_RULES:
        soft_failed = soft_failed | (F.col(rule) & (F.col(f"{rule}_rate") > rules.trust_rate))
    base_failed = F.col("few_words") | F.col("repetitive")
    hosts = hosts.select(F.col("host").alias("of"), *[f"{r}_rate" for r in RULES])
    return failed.join(hosts, F.col("host").eqNullSafe(F.col("of"))).select(
        "doc_id",
        *MEASURES,
        base_failed.alias("base_failed"),
        (~base_failed & ~rejected & ~soft_failed).alias("kept"),
    )


def keep_documents(docs: DataFrame, rules: HostRules = HostRules()) -> DataFrame:
    """The documents that pass, with their own columns.

    Verdicts meet the documents by ``doc_id``; where an id occurs more than once, all its rows must
    pass.
    """
    verdicts = judge(docs, rules).groupBy("doc_id").agg(F.bool_and("kept").alias("kept"))
    kept = verdicts.where("kept")
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["doc_id"]), "left_semi")
