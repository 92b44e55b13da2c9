"""Corpus pipeline: documents through five operators of ``dimwright.llm``.

language ID      documents without a letter of text have no language and go
near-dedup       one document of each near-duplicate group stays: the one with the smallest id
decontamination  documents that hold a window of a benchmark item go
secrets          secrets inside the texts are replaced by a marker; no document goes
mixing           the documents taken into the weighted mix stay, with their copies and tokens

Each stage is a function of (spark, docs, sf_dir), reads every row its predecessor kept, and all but
the last return the columns of ``documents``.  ``run`` applies them to the whole table.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql.types import LongType, StringType, StructField  # noqa: E402

from dimwright.llm import contamination, langid, minhash, mixing, secret_scan  # noqa: E402
from dimwright.llm.common import add_columns, drop_saved, save_table, saved, table  # noqa: E402

#: near duplicates share four fifths of their five-word shingles
SHINGLE_WORDS, SIMILARITY = 5, (4, 5)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose predicted language is known."""
    found = langid.predict(docs.withColumn("__columns", F.struct(*docs.columns)), langid.train_on_documents(docs), keep=["__columns"])
    return found.filter(F.col("lang_pred") != F.lit(langid.UNKNOWN)).select("__columns.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group, decided per row: the smallest id; a row without an id only if its group has no id."""
    return minhash.one_of_each_group(docs, width=SHINGLE_WORDS, similarity=SIMILARITY)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any word inside a benchmark window."""
    found = contamination.find_contamination(docs.withColumn("__columns", F.struct(*docs.columns)), table(spark, sf_dir, "benchmark"),
                                             keep=["__columns"])
    return found.filter("n_hit = 0").select("__columns.*")


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a marker and ``n_chars`` following the text."""
    masked = add_columns(docs, ["text"], [StructField("__text", StringType()), StructField("__n", LongType())],
                         lambda: lambda texts: [(m, None if m is None else len(m)) for m in map(secret_scan.mask, texts)])
    return masked.select(*[F.col("__text").alias("text") if c == "text" else F.when(F.col("__text").eqNullSafe(F.col("text")), F.col("n_chars"))
                           .otherwise(F.col("__n")).alias("n_chars") if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row per document taken, with its place in the tree, copies and tokens."""
    return mixing.mix_sources(docs).filter("kept").drop("kept")


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("decontamination", decontamination), ("secrets", secrets),
          ("mix", mix)]

#: SQL cannot express the language and secret stages; tests/llm compares the pipeline with plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of ``documents``.  When a stage is saved, the folders of the stages before it go; the caller may drop
    the last ones (``common.drop_saved``) once the result is written."""
    docs = table(spark, sf_dir, "documents")
    before = set(saved())
    for name, stage in STAGES[:-1]:
        docs = save_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
        drop_saved(spark, [p for p in saved()[:-1] if p not in before])
    return STAGES[-1][1](spark, docs, sf_dir)
