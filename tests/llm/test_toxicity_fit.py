"""Every labelled row teaches the toxicity model."""

import numpy as np
from pyspark.sql import functions as F

from ridewright.llm import toxicity


def test_all_labelled_rows_teach(spark):
    n = 40_500
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("ab").alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 10 == 0).cast("int").alias("toxic"))
    model = toxicity.fit(docs, labels)
    assert model.trigrams.sum() == 3 * n
    shares = toxicity.score(docs.limit(1), model).first().score
    assert abs(shares - 0.1) < 0.01


def test_the_curve_is_that_of_newtons_method_over_the_rows(spark):
    rng = np.random.default_rng(3)
    x = np.column_stack([np.ones(300), rng.random((300, 4))])
    y = (x @ [-1, 3, 0, 1, -2] + rng.normal(size=300) > 0).astype(int)
    seen = spark.createDataFrame([(int(b), a.tolist()) for a, b in zip(x, y, strict=True)], "y int, x array<double>")
    w = np.zeros(5)
    for _ in range(30):
        p = 1 / (1 + np.exp(-x @ w))
        w += np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(5), x.T @ (y - p) - 1e-2 * w)
    assert np.allclose(toxicity.logistic(seen), w, atol=1e-6)
    assert (toxicity.logistic(seen.limit(0)) == 0).all()
