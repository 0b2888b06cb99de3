"""Columns named like those that operators use inside, and session settings before and after."""

import pytest
from pyspark.sql import functions as F

from ridewright.llm import decontamination, importance, licences, mixing, near_duplicates, periodic

INSIDE = ["__digest", "__KEY", "__id", "__again", "__lang", "__source", "__topic", "__chance", "__spans", "__n_words", "key", "id", "bucket", "rank", "_at", "_in", "_part"]


@pytest.fixture
def named(odd_rows):
    return odd_rows.drop("key").withColumns({c: F.lit(c) for c in INSIDE})


def test_columns_stay(named):
    before = {tuple(r) for r in named.select(*INSIDE).distinct().collect()}
    benchmark = named.where("doc_id = 7").select(F.col("doc_id").alias("item_id"), "text")
    target = benchmark.select("text")
    for kept in (
        near_duplicates.keep_one(named),
        decontamination.decontaminate(named, benchmark),
        mixing.mix(named, prefix="mix_").select(*named.columns),
        importance.resample(named, target, min_words=1, percent=100),
    ):
        assert kept.columns == named.columns
        rows = kept.collect()
        assert rows and {tuple(r[c] for c in INSIDE) for r in rows} == before


def test_settings_stay(spark, odd_rows):
    before = dict(spark.conf.getAll)
    near_duplicates.keep_one(odd_rows).count()
    decontamination.decontaminate(odd_rows, odd_rows.limit(1).select(F.col("doc_id").alias("item_id"), "text")).count()
    mixing.mix(odd_rows).count()
    periodic.periodic_runs(odd_rows).count()
    licences.licences(odd_rows).count()
    importance.draw(importance.weigh(odd_rows, importance.fit(odd_rows, odd_rows))).count()
    after = dict(spark.conf.getAll)
    assert {k for k in after if after[k] != before.get(k)} <= {"spark.checkpoint.dir"}
