"""The operators' queries by name, each over its whole table, and their SQL twins."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from doorstep.llm import (
    conversation_repair,
    decontamination,
    host_quality,
    html_extract,
    line_spread,
    mixing,
    pii,
    simhash,
    spelling,
    suffix_dedup,
    token_files,
    toxicity,
    warc,
)
from doorstep.llm.tables import documents, read

TOKENIZER = "word_bpe_49k.json"

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


@query
def op7_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The measures and the verdict of every document."""
    return host_quality.judge(documents(spark, sf_dir))


@query
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate group of every document."""
    return simhash.near_duplicates(documents(spark, sf_dir))


@query
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair of a document and a benchmark item that it holds."""
    return decontamination.contaminated(documents(spark, sf_dir), read(spark, sf_dir, "benchmark"))


@query
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    return mixing.mix_sources(documents(spark, sf_dir))


@query
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place, length and checksum in the token files."""
    return token_files.token_rows(documents(spark, sf_dir), public_tokenizers.path(TOKENIZER))


@query
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The record of every page, from archives written and read back."""
    return warc.page_records(read(spark, sf_dir, "pages"))


@query
def op9_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_extract.extract(read(spark, sf_dir, "pages"))


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity score of every document."""
    docs = documents(spark, sf_dir)
    return toxicity.score_documents(docs, toxicity.train(docs, read(spark, sf_dir, "labels")))


@query
def op4_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document, and how many of them are cross-site boilerplate."""
    return line_spread.line_counts(documents(spark, sf_dir))


@query
def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What repeats of 100-byte strings take from every document."""
    return suffix_dedup.dedup_digests(documents(spark, sf_dir))


@query
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and repaired text of every conversation after planted damage."""
    rows = read(spark, sf_dir, "conversations")
    return conversation_repair.repair(conversation_repair.damage(rows), ids=rows)


@query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near words, form and root of every word of the documents."""
    return spelling.spelling_variants(documents(spark, sf_dir))


@query
def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data and the terms that disclose it in every document."""
    return pii.personal_data(documents(spark, sf_dir))
