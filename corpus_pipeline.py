"""The corpus pipeline: documents in, a filtered, deduplicated and mixed corpus out.

Each stage takes (spark, docs, folder) and works on all rows that the one before kept. ``run`` writes
every stage to the shared folder and reads it again. The stages learn, match and search as SQL cannot,
so there is no statement; tests hold the functions of the stages against brute force, not the whole run.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ridewright.llm import decontamination, mixing, near_duplicates, quality, toxicity
from ridewright.llm.common import remainder, stored, table

ORACLE_SQL: str | None = None
KEPT_SHARE = 0.5  # of the clean tokens that the mixed corpus holds


def keep_good(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Rows that the quality discriminant accepts; it learns from the labelled two thirds."""
    stats = quality.document_statistics(docs)
    model = quality.fit(stats, table(spark, folder, "labels"), train=remainder("doc_id", 3) != 1)
    return quality.keep_good(docs, model)


def keep_clean(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Rows that the toxicity model accepts; it learns from the labelled four fifths."""
    model = toxicity.fit(docs, table(spark, folder, "labels"), train=remainder("doc_id", 5) != 0)
    return toxicity.keep_clean(docs, model)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One row of each group of near duplicates."""
    return near_duplicates.keep_one(docs)


def keep_unseen(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Rows that share no window with a benchmark text."""
    return decontamination.decontaminate(docs, table(spark, folder, "benchmark"))


def keep_mixed(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The sample of ``KEPT_SHARE`` of the tokens that follows the target weights, with its probability."""
    columns = docs.columns
    mixed = mixing.mix(docs, prefix="mix_", kept_share=KEPT_SHARE)
    return mixed.where("mix_kept").select(*(f"`{c}`" for c in columns), "mix_topic", "mix_n_tokens", "mix_probability")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", keep_good),
    ("toxicity", keep_clean),
    ("near-duplicates", keep_one_of_each),
    ("decontamination", keep_unseen),
    ("mixing", keep_mixed),
]


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, folder), name.replace(" ", "-"))
    return docs
