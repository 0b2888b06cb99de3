"""The second reading of crowds takes the nodes of near pairs only, and reads words of these alone."""

import random

import numpy as np
import pyarrow as pa

from ridewright.llm import near_duplicates as nd


def rows_of(texts, crowd=5):
    names = ("crowd", "part", "node", "n_words", "fold")
    n = len(texts)
    rows = [pa.array(c) for c in ([crowd] * n, [0] * n, range(n), [len(w) for w in texts])]
    return pa.RecordBatch.from_arrays([*rows, pa.array([nd.folded(w) for w in texts], pa.binary())], names=names)


def members(texts, part_nodes=nd.PART_NODES):
    found = [r for out in nd._lead(0.8, part_nodes)(iter([rows_of(texts)])) for r in out.to_pylist()]
    return {r["a"] for r in found if r["a"] == r["b"]}


def of_own_words(rng, n=120):
    return [b"w%d" % rng.randrange(10**6) for _ in range(n)]


def test_nodes_near_no_other_are_left_out_of_the_second_reading():
    rng = random.Random(1)
    base = of_own_words(rng, 600)
    alike = [[*base[:i], b"x%d" % i, *base[i + 1 :]] for i in range(4)]
    lone = [of_own_words(rng, 600) for _ in range(30)]
    assert members(alike + lone) == {0, 1, 2, 3}
    assert members(alike + lone, part_nodes=34) == set(range(34))  # pairs with other parts are open


def test_no_node_with_a_near_one_is_left_out():
    for seed in range(60):
        rng = random.Random(seed)
        texts = [of_own_words(rng, rng.choice([70, 120, 140])) for _ in range(6)]
        for _ in range(24):
            own = list(rng.choice(texts))
            for i in rng.sample(range(len(own)), rng.randrange(len(own) // 3)):
                own[i] = b"y%d" % rng.randrange(10**6)
            texts.append(own)
        rng.shuffle(texts)
        folds, sizes = nd._Folds([nd.folded(w) for w in texts]), np.array([len(w) for w in texts])
        near = set()
        for i in range(len(texts)):
            others = np.array([j for j in range(len(texts)) if j != i])
            limit = nd.allowed(np.maximum(sizes[others], sizes[i]), 0.8)
            if (folds.near(i, others, limit) & (np.abs(sizes[others] - sizes[i]) <= limit)).any():
                near.add(i)
        assert members(texts) == near


def test_words_are_counted_for_nodes_of_near_pairs_only():
    rng = random.Random(3)
    base, counted = of_own_words(rng, 600), []
    texts = [of_own_words(rng, 600) for _ in range(40)] + [base, [*base[:-1], b"x"]]

    def bag(i):
        counted.append(i)
        return nd.bag_of(texts[i])

    n = len(texts)
    args = np.arange(n), np.arange(n), np.zeros(n), np.array([len(w) for w in texts]), [nd.folded(w) for w in texts], 0.8
    found = [p for a, b in nd.cross_pairs(*args, bag) for p in zip(a.tolist(), b.tolist(), strict=True)]
    assert found == [(n - 2, n - 1)] and counted == [n - 2, n - 1]


def test_common_ends_are_no_work_for_the_alignment(monkeypatch):
    rng, tried = random.Random(4), []
    a = of_own_words(rng, 500)
    b = [*a[:200], *of_own_words(rng, 40), *a[240:]]
    real = nd.column_distance
    monkeypatch.setattr(nd, "column_distance", lambda x, y, limit: tried.append((len(x), len(y))) or real(x, y, limit))
    assert nd.edit_distance(a, b, 100) == 40 and tried == [(40, 40)]
