"""A stray category must not shrink the rest of the sample."""

import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", ".."))
import corpus_pipeline  # noqa: E402

from ridewright.llm import mixing  # noqa: E402


def rows(spark, stray):
    text = " ".join(["word"] * 100)
    big = [(i, text, "fr" if i % 4 == 0 else "en", "web" if i % 5 else "books") for i in range(2000)]
    return spark.createDataFrame(big + stray, "doc_id long, text string, lang string, source string")


STRAY = [[], [(9001, "word " * 5, "en", "stray")], [(9001, "word " * 5, None, "web")], [(9001, "word " * 5, None, None)]]


@pytest.mark.parametrize("stray", STRAY)
def test_the_kept_share_is_held_beside_a_stray_category(spark, stray):
    docs = rows(spark, stray)
    mixed = mixing.mix(docs, kept_share=0.5).cache()
    got = mixed.agg(F.sum(F.col("probability") * F.col("n_tokens")), F.sum("n_tokens"), F.max("probability")).first()
    assert got[0] == pytest.approx(0.5 * got[1], rel=1e-6) and got[2] <= 1 + 1e-9
    if stray:
        assert mixed.where("doc_id = 9001").first().probability == pytest.approx(1)
    kept = corpus_pipeline.keep_mixed(spark, docs, "").count()
    assert 900 < kept < 1100


def test_the_others_still_follow_the_targets(spark):
    cells = spark.sql(
        "select * from values ('a', 'x', 't', 100D), ('a', 'y', 't', 300D), ('b', 'x', 't', 400D), ('b', 'y', 't', 200D), "
        "('c', 'x', 't', 1D) as t(source, lang, topic, tokens)"
    )
    share = lambda **s: spark.createDataFrame(list(s.items()), "category string, share double")
    targets = {"source": share(a=0.6, b=0.3, c=0.1), "lang": share(x=0.5, y=0.5), "topic": share(t=1.0)}
    raked = mixing.rake(cells, targets, 40, budget=400.0)
    sums = {r[0]: r[1] for d in ("source", "lang") for r in raked.groupBy(d).agg(F.sum("weight")).collect()}
    assert sums == pytest.approx({"a": 266, "b": 133, "c": 1, "x": 200, "y": 200}, rel=1e-3)
    assert raked.where("weight > tokens").count() == 0


def test_all_is_kept_when_all_is_asked(spark):
    mixed = mixing.mix(rows(spark, STRAY[3]), kept_share=1.0)
    assert mixed.where("kept").count() == 2001
    assert mixing.mix(rows(spark, []).limit(0), kept_share=0.5).count() == 0
