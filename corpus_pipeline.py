"""Corpus pipeline over ``documents``: language ID, line dedup, near-dedup,
decontamination, mixing. Each stage is stored and read back before the next.

Each function takes ``(spark, docs, sf_dir)``; all but the last return the
columns of ``documents``. Defined results: documents without a letter or
like no language go in the first stage; a document all of whose lines were later copies goes in the
second; one row of each SimHash component stays in the third; a null text
cannot pass the first stage. Empty input gives empty output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.llm import decontaminate, langid, lines, mixing, simhash
from kindred.llm.common import on_workers, small_batches, staged, table
from kindred.llm.queries import MIX

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without a letter and texts that are not like the language
    they are closest to (``langid.alike``, measured on all labelled rows). A null ``lang`` is set to the prediction; a given one stays."""
    labels, proto = langid.fit(docs)
    usual = langid.typical(docs, labels, proto)
    out = langid.predict(docs, labels, proto, usual=usual).where(F.col("lang_pred") != langid.UNDETERMINED)
    return out.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts later occurrences of three-line windows; a document that held
    nothing else goes."""
    out = lines.window_dedup(docs, size=3).where("n_removed = 0 OR trim(BOTH ' \\t\\r\\n' FROM kept) <> ''")
    return out.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.char_length("kept").cast("long"))
                          .otherwise(F.col("n_chars"))).withColumn("text", F.col("kept")).select(*COLUMNS)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays: the smallest id."""
    return simhash.one_of_each(docs, words=3, max_bits=3).select(*COLUMNS)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a 10-word window of a benchmark item go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"), window=10).select(*COLUMNS)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed corpus: a row for each document and epoch it is taken in."""
    return mixing.mix_rows(docs, MIX, COLUMNS)


STAGES = [("language_id", language_stage), ("line_dedup", line_stage), ("simhash_near_dedup", near_dedup_stage),
          ("benchmark_decontamination", decontamination_stage), ("mixing", mixing_stage)]

# The first stage (a trained classifier) cannot be put in SQL; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    on_workers(spark)
    docs = table(spark, sf_dir, "documents")
    with small_batches(spark):
        for name, stage in STAGES[:-1]:
            docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
