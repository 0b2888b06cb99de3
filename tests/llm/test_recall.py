"""Texts near the limit of op7 meet and are joined, however their edits are spread."""

import random

import pytest

from ridewright.llm import near_duplicates


def edited(rng, words, n_edits):
    out = list(words)
    for i in rng.sample(range(len(words)), n_edits):
        out[i] = f"x{rng.randrange(10**6)}"
    return out


def prose(rng, n):
    return [f"w{rng.randrange(5000)}" for _ in range(n)]


def buckets(words):
    raw = [w.encode() for w in words]
    return set(near_duplicates.order_minhash(raw, 5, 64, 3)) | set(near_duplicates.scatter_minhash(raw))


@pytest.mark.parametrize("n", [5, 10, 20, 60, 95, 100, 200, 500])
@pytest.mark.parametrize("similarity", [0.8, 0.82, 0.85, 0.9])
def test_pairs_with_scattered_edits_share_a_bucket(n, similarity):
    rng = random.Random(n)
    met = 0
    for _ in range(60):
        one = prose(rng, n)
        met += bool(buckets(one) & buckets(edited(rng, one, int((1 - similarity) * n + 1e-9))))
    assert met >= 59


def test_an_edit_in_every_fifth_word_leaves_shared_buckets():
    rng = random.Random(1)
    for n in (100, 300):
        one = prose(rng, n)
        two = [w if i % 5 != 2 else f"y{i}" for i, w in enumerate(one)]
        assert buckets(one) & buckets(two)


def test_chains_near_the_limit_are_one_class(spark):
    rng = random.Random(5)
    texts = []
    for _ in range(4):
        words = prose(rng, 200)
        for _ in range(10):
            texts.append(" ".join(words))
            words = edited(rng, words, rng.randint(28, 34))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.id: r.class_id for r in near_duplicates.classes(docs).collect()}
    assert found == {i: i - i % 10 for i in range(40)}
