"""A training-data pipeline of five stages over ``documents``; counted as part of the ``llm`` subpackage.

Each stage works on all rows that the one before kept, and its decisions take effect: language identification drops
texts without a language, near-deduplication keeps one document of each group, decontamination drops contaminated
documents, the secret scan replaces secrets in the texts, and packing lays the rest into sequences.

Every stage passes the columns of its input on unchanged, whatever their names (the secret scan rewrites text and
n_chars); the last returns pieces. An empty table passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skeinworks.llm import best_fit_packing, language_id, secret_scan, shingle_join, wu_manber
from skeinworks.llm.common import Scratch, dropped_scratch, numbered, small_batches, table

#: SQL has no cross-parsing, no Markov models and no tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def _held(docs: DataFrame) -> DataFrame:
    """Whole rows in one column, so that no name of theirs clashes with an operator's."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), "text")


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    found = language_id.identify(_held(docs), language_id.train(docs, F.lit(True)), ["_row", "text"])
    return found.where(F.col("lang_pred") != language_id.UNKNOWN).select("_row.*")


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group stays: that with the least id (rows without one come last), and of several such rows the first in the files.

    Rows are told apart by their places in the files, so repeated and null ids are rows like any other, and a text travels once.
    """
    small_batches(spark)
    rows = numbered(docs, Scratch(spark, "near-dedup"))
    places = rows.select("_row.doc_id", "_row.text", "_file", "_line")
    stay = shingle_join.near_duplicates(places, ["doc_id", "_file", "_line"]).where("first").select("_file", "_line")
    return rows.join(stay, ["_file", "_line"], "left_semi").select("_row.*")


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    found = wu_manber.decontaminate(_held(docs), table(spark, sf_dir, "benchmark"), ["_row", "text"])
    return found.where("not contaminated").select("_row.*")


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return secret_scan.redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return best_fit_packing.pack(docs)


STAGES = [
    ("language_id", language_stage),
    ("simhash_near_dedup", near_dedup_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("secret_scan", secret_stage),
    ("best_fit_packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again as the next one's input, and goes once that is written."""
    scratch, docs = Scratch(spark, "pipeline"), table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        before = set(scratch.names)
        with dropped_scratch():
            docs = scratch.write(stage(spark, docs, sf_dir), name)
        scratch.drop(*before)
    return docs
