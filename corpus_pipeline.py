"""The corpus pipeline: each stage works on the documents that its predecessor kept."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from doorstep.llm.decontamination import keep_clean
from doorstep.llm.host_quality import keep_documents
from doorstep.llm.mixing import mixed_documents
from doorstep.llm.simhash import keep_one
from doorstep.llm.queries import TOKENIZER
from doorstep.llm.tables import DOCUMENT_COLUMNS, documents, read
from doorstep.llm.token_files import token_rows
from doorstep.session import scratch_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that pass the base rules and their host's verdict."""
    return keep_documents(docs).select(DOCUMENT_COLUMNS)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, the one with the least id."""
    return keep_one(docs).select(DOCUMENT_COLUMNS)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no benchmark item."""
    return keep_clean(docs, read(spark, sf_dir, "benchmark")).select(DOCUMENT_COLUMNS)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: whole documents once or twice, and runs of words of some."""
    return mixed_documents(docs).select(DOCUMENT_COLUMNS)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as token files; a row per document with its place in them."""
    return token_rows(docs, public_tokenizers.path(TOKENIZER))


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("simhash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("source mix", source_mix),
    ("token files", token_output),
]

#: No SQL twin: near-duplicate groups, retrieval and token files are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written as Parquet to the shared folder and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        result = stage(spark, docs, sf_dir)
        path = scratch_dir(spark, f"pipeline-{name.replace(' ', '-')}")
        result.write.parquet(path)
        docs = spark.read.schema(result.schema).parquet(path)
    return docs
