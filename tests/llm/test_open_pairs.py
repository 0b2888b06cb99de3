"""op7 brings few pairs to the alignment: one leader for each node of a crowd, and none that word counts rule out."""

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ridewright.llm import near_duplicates as nd


def texts_with_one_refrain(n):
    """Texts of other words before the same long refrain: folded counts leave them open, words tell them apart."""
    rng = random.Random(n)
    refrain = [b"is", b"onhe"] * 240
    return [[b"w%d" % rng.randrange(10**6) for _ in range(150)] + refrain for _ in range(n)]


def test_word_counts_rule_out_pairs_that_folded_counts_leave():
    words = texts_with_one_refrain(40)
    n = len(words)
    args = np.arange(n), np.arange(n), np.zeros(n), np.array([len(w) for w in words]), [nd.folded(w) for w in words], 0.8
    assert sum(len(a) for a, _ in nd.cross_pairs(*args)) == n * (n - 1) // 2
    assert not list(nd.cross_pairs(*args, [nd.bag_of(w) for w in words]))


def test_word_counts_lose_no_alike_pair():
    rng = random.Random(7)
    base = texts_with_one_refrain(1)[0] + [b"w%d" % rng.randrange(50) for _ in range(9000)]
    words = [base]
    for _ in range(12):
        words.append([w for w in words[-1] if rng.random() > 0.03])
    n = len(words)
    args = np.arange(n), np.arange(n), np.zeros(n), np.array([len(w) for w in words]), [nd.folded(w) for w in words], 0.8
    found = {p for a, b in nd.cross_pairs(*args, [nd.bag_of(w) for w in words]) for p in zip(a.tolist(), b.tolist(), strict=True)}
    apart = lambda a, b: len(a) - len(b)  # noqa: E731  only words were taken out
    alike = {(i, j) for j in range(n) for i in range(j) if apart(words[i], words[j]) <= 0.2 * len(words[i])}
    assert alike <= found and len(found) < n * (n - 1) // 2


def test_a_node_near_many_leaders_gives_one_pair():
    words = texts_with_one_refrain(30)
    names = ("crowd", "part", "node", "n_words", "fold")
    rows = [pa.array(c) for c in ([5] * 30, [0] * 30, range(30), [len(w) for w in words])]
    batch = pa.RecordBatch.from_arrays([*rows, pa.array([nd.folded(w) for w in words], pa.binary())], names=names)
    found = [r for out in nd._lead(0.8, nd.PART_NODES)(iter([batch])) for r in out.to_pylist()]
    assert len([r for r in found if r["a"] != r["b"]]) <= 29
    assert {r["a"] for r in found if r["a"] == r["b"]} == set(range(30))


def test_picked_is_the_join(spark):
    rows = spark.range(3000).select(F.sha2(F.col("id").cast("string"), 256).alias("key"), F.col("id").alias("text"))
    rows = rows.union(rows.where("text % 5 = 0")).union(spark.sql("select cast(null as string), 1L"))
    wanted = rows.where("text % 7 = 0").select("key").distinct()
    found = nd.picked(rows, wanted, "key").select("key", "text")
    assert sorted(found.collect()) == sorted(rows.join(wanted, "key").select("key", "text").collect())
    assert not nd.picked(rows, wanted.limit(0), "key").count()
