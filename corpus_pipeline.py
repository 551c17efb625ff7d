"""A corpus pipeline of five operators, each working on all that the one before it kept.

quality     documents that fail a base rule, or whose host is rejected, go
duplicates  one document of each group of near-duplicates stays
benchmark   documents that leak a benchmark item go
secrets     secrets are replaced in the texts; every document stays
packing     what is left is packed into training sequences (one row per piece)

Null texts count as empty and go at the first stage, null hosts are one host, repeated rows are each judged and one
stays; an empty table gives an empty result; further columns stay up to the last stage, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from seqloom.llm import common, decontamination, host_rules, packing, secret_scan, set_join


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return host_rules.keep(docs)


def duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return set_join.one_of_each(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.without_leaks(docs, common.table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = secret_scan.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [("quality", quality), ("duplicates", duplicates), ("benchmark", benchmark), ("secrets", secrets), ("packing", pack)]
#: SQL has no tokenizer; the pipeline is tested against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = common.cut(docs)
    return docs
