"""Classes of op7 are those of all links between texts that share a bucket."""

import random

import numpy as np
import pytest

from ridewright.llm import near_duplicates


def buckets(words):
    raw = [w.encode() for w in words]
    return set(near_duplicates.order_minhash(raw, 5, 64, 3)) | set(near_duplicates.scatter_minhash(raw))


def follower_and_later_text(seed):
    """A text, its follower without the last words, and a text near the follower only, in buckets of the first."""
    rng = random.Random(seed)
    one = [f"w{rng.randrange(10**6)}" for _ in range(25)]
    two = one[:-4]
    three = list(two)
    for i in rng.sample(range(len(two)), 4):
        three[i] = f"x{rng.randrange(10**6)}"
    return [one, two, three]


def classes_of(spark, texts):
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    return {r.id: r.class_id for r in near_duplicates.classes(docs).collect()}


def test_a_follower_is_linked_to_a_text_that_is_not_near_its_leader(spark):
    texts = [t for seed in (1401, 1959, 2876) for t in follower_and_later_text(seed)]
    for one, two, three in zip(texts[::3], texts[1::3], texts[2::3], strict=True):
        assert buckets(two) & buckets(three) <= buckets(one)
    assert classes_of(spark, texts) == {i: i - i % 3 for i in range(9)}


@pytest.mark.parametrize("part", [3, 4000])
def test_classes_are_those_of_all_pairs_in_a_bucket(spark, monkeypatch, part):
    monkeypatch.setattr(near_duplicates, "PART_NODES", part)
    monkeypatch.setattr(near_duplicates, "CROWD_ROWS", 7)
    rng = random.Random(part)
    texts = []
    for family in range(6):
        base = [f"f{family}w{rng.randrange(60)}" for _ in range(rng.choice([12, 30, 70]))]
        for _ in range(9):
            words = list(rng.choice([base, texts[-1]]) if texts and len(texts) % 9 else base)
            for _ in range(rng.randrange(1 + len(words) // 6)):
                words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
            texts.append(words[rng.randrange(3) : len(words) - rng.randrange(3)])
    label, met = list(range(len(texts))), [buckets(t) for t in texts]
    raw = [" ".join(t).encode() for t in texts]
    alike = lambda i, j: raw[i] == raw[j] or met[i] & met[j] and near_duplicates.similar(raw[i], raw[j], 0.8)
    links = [(i, j) for j in range(len(texts)) for i in range(j) if alike(i, j)]
    for _ in texts:
        for i, j in links:
            label[i] = label[j] = min(label[i], label[j])
    assert classes_of(spark, texts) == dict(enumerate(label))


def test_cross_pairs_are_those_that_counts_leave():
    rng = np.random.default_rng(1)
    words = [[b"%d" % w for w in rng.integers(0, 40, n)] for n in rng.integers(100, 170, 60)]
    folds, sizes = [near_duplicates.folded(w) for w in words], np.array([len(w) for w in words])
    labels, nodes = rng.integers(0, 3, 60), np.arange(60) * 10
    found = {p for a, b in near_duplicates.cross_pairs(nodes, labels, np.zeros(60), sizes, folds, 0.7) for p in zip(a.tolist(), b.tolist(), strict=True)}
    expected = set()
    for j in range(60):
        for i in range(j):
            leaders = near_duplicates.Leaders()
            leaders.add(i, int(sizes[i]), np.frombuffer(folds[i], np.uint8).astype(np.int16))
            near = leaders.near(int(sizes[j]), np.frombuffer(folds[j], np.uint8).astype(np.int16), 0.7)
            if near and labels[i] != labels[j]:
                expected.add((i * 10, j * 10))
    assert found == expected and found
