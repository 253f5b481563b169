"""Corpus pipeline: toxicity filter, exact dedup, near-dedup, mixing, encoding.

``STAGES`` lists (name, function).  Each function takes (spark, docs, sf_dir)
and returns a DataFrame that is written as Parquet and read again as the next
one's ``docs``.  All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm.bpe import token_digests
from tarmac.llm.common import Scratch, free_names, table
from tarmac.llm.exact_dedup import drop_copies
from tarmac.llm.minhash_dedup import drop_near_duplicates
from tarmac.llm.mixing import mix, repeat_rows
from tarmac.llm.toxicity import score, training_rows
from tarmac.session import ensure_checkpoint_dir, ship_package


def _ready(spark: SparkSession) -> None:
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on labelled rows of ``docs``, does not call toxic."""
    _ready(spark)
    sample = training_rows(docs, table(spark, sf_dir, "labels"))
    value, toxic = free_names(docs, "score", "toxic")
    scored = score(docs, sample, docs.columns, score_col=value, predicted_col=toxic)
    return scored.filter(F.col(toxic) == 0).select(*docs.columns)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    _ready(spark)
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    _ready(spark)
    return drop_near_duplicates(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them."""
    _ready(spark)
    return repeat_rows(docs, mix(docs))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text."""
    _ready(spark)
    return token_digests(docs)


STAGES = [("toxicity", toxicity), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("mixing", mixing),
          ("encoding", encoding)]

#: the toxicity stage is a trained model, which SQL cannot express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each result is written to the shared folder and read again."""
    _ready(spark)
    docs, scratch = table(spark, sf_dir, "documents"), Scratch(spark, "pipeline")
    for name, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    return docs
