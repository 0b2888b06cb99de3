"""The registered query of each operator, over its whole table with production parameters."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridewright.llm import (
    context_tree,
    decontamination,
    extraction,
    fingerprints,
    importance,
    language,
    licences,
    mixing,
    near_duplicates,
    periodic,
    quality,
    toxicity,
    warc,
)
from ridewright.llm.common import remainder, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


def judged(scored: DataFrame, modulus: int, held: int) -> DataFrame:
    """doc_id, held_out, score and predicted of a two-class score."""
    return scored.withColumnRenamed("id", "doc_id").select(
        "doc_id",
        (remainder("doc_id", modulus) == held).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query
def op1_context_tree_scoring(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = context_tree.fit(docs, train=remainder("doc_id", 7) != 2)
    scored = context_tree.score(docs, model).withColumnRenamed("id", "doc_id")
    columns = ("n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")
    return scored.select("doc_id", (remainder("doc_id", 7) == 2).alias("held_out"), *columns)


@query
def op2_quality_discriminant(spark: SparkSession, folder: str) -> DataFrame:
    stats = quality.document_statistics(table(spark, folder, "documents"))
    model = quality.fit(stats, table(spark, folder, "labels"), train=remainder("doc_id", 3) != 1)
    return judged(quality.score_statistics(stats, model), 3, 1)


@query
def op3_mincut_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return extraction.extract(table(spark, folder, "pages")).select("page_id", "url", "text", "n_chars")


@query
def op4_language_spans(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = language.fit(docs, train=remainder("doc_id", 4) != 2)
    found = language.identify(docs, model, with_spans=False).withColumnRenamed("id", "doc_id")
    return found.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


@query
def op5_toxicity_deobfuscation(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    labels, train = table(spark, folder, "labels"), remainder("doc_id", 5) != 0
    model = toxicity.fit_evidence(toxicity.labelled(toxicity.texts_of(docs, "doc_id", "text"), labels, train=train))
    features = toxicity.document_features(docs, model)  # once for the curve and the scores
    model = toxicity.fit_curve(model, toxicity.labelled(features, labels, train=train))
    return judged(toxicity.score_features(features, model), 5, 0)


@query
def op6_target_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents").drop("n_chars"))
    return mixed.select(
        "doc_id", "source", "lang", "topic", "n_tokens", F.round("probability", 6).alias("probability"), "kept"
    )


@query
def op7_order_minhash(spark: SparkSession, folder: str) -> DataFrame:
    found = near_duplicates.classes(table(spark, folder, "documents"))
    return found.select(F.col("id").alias("doc_id"), "class_id")


@query
def op8_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    matched = decontamination.match_spans(docs, table(spark, folder, "benchmark"))
    found = decontamination.with_hits(matched.drop("text"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query
def op9_warc_normaliser(spark: SparkSession, folder: str) -> DataFrame:
    members, index = warc.archive(table(spark, folder, "pages"))
    return warc.read_back(index, members, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query
def op10_imatch_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    terms = fingerprints.lexicon(docs)
    return fingerprints.compare_with_next(docs, terms).withColumnRenamed("id", "doc_id")


@query
def op13_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = importance.fit(docs, table(spark, folder, "benchmark"))
    drawn = importance.draw(importance.weigh(docs, model)).withColumnRenamed("id", "doc_id")
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def repeated_end(key: object, words: list[bytes]) -> list[bytes]:
    """For a tenth of the ids, the words from some place on repeat those after that place."""
    h, n = zlib.crc32(b"" if key is None else str(key).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


@query
def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic.periodic_runs(table(spark, folder, "documents"), edit=repeated_end)
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    best = F.col("strongest")
    return found.select(
        F.col("id").alias("doc_id"),
        F.size("runs").cast("bigint").alias("n_runs"),
        *[best[c].alias(c) for c in ("start", "length", "period")],
        F.call_function("div", best["length"] * 1000, best["period"]).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op12_licence_automaton(spark: SparkSession, folder: str) -> DataFrame:
    found = licences.licences(table(spark, folder, "documents"))
    starts = F.col("phrases")["start"]
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    base = F.col("phrases")["label"]
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        F.size("phrases").cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.concat(base, F.col("spans")["label"])).alias("labels"),
        "score",
    )
