"""Periodic runs against comparison of every pair of words."""

import random

import pytest

from ridewright.llm import periodic


def plain_runs(words):
    n, found = len(words), {}
    for p in range(1, n // 4 + 1):
        i = 0
        while i < n - p:
            j = i
            while j < n - p and words[j] == words[j + p]:
                j += 1
            if j - i + p >= max(6, 4 * p):
                found.setdefault((i, j - i + p), p)
            i = max(j, i + 1)
    return sorted((start, length, p) for (start, length), p in found.items())


def some_text(rng):
    n = rng.choice([0, 1, 5, 6, 40, 300])
    words = [b"%d" % rng.randrange(rng.choice([1, 2, 3, 30])) for _ in range(n)]
    if n and rng.random() < 0.6:
        a, p = rng.randrange(n), rng.randint(1, 1 + n // 3)
        words = words[:a] + [words[a + i % min(p, n - a)] for i in range(n - a)]
    return words


def test_covers_give_every_difference():
    for v in (1, 2, 5, 16, 33, 64):
        cover = periodic.difference_cover(v).tolist()
        assert {(a - b) % v for a in cover for b in cover} == set(range(v))


@pytest.mark.parametrize("at_once", [40, 1 << 20])
def test_runs_of_random_texts(monkeypatch, at_once):
    monkeypatch.setattr(periodic, "AT_ONCE", at_once)
    rng = random.Random(5)
    for _ in range(120):
        texts = [some_text(rng) for _ in range(rng.randint(0, 6))]
        assert periodic.find_runs(texts) == [plain_runs(t) for t in texts]


def test_extensions_go_through_samples():
    rng = random.Random(2)
    words = [rng.randrange(2) for _ in range(40)] * 12
    words = periodic.np.array(words + [9])
    ext = periodic.Extensions(words, v=8)
    i = periodic.np.array([rng.randrange(480) for _ in range(300)])
    j = periodic.np.array([rng.randrange(480) for _ in range(300)])
    i, j = i[i != j], j[i != j]
    for a, b, n in zip(i.tolist(), j.tolist(), ext.between(i, j).tolist(), strict=True):
        k = 0
        while max(a, b) + k < len(words) and words[a + k] == words[b + k]:
            k += 1
        assert k == n


def test_collapse_and_strongest():
    words = b"a x y x y x y x y b b b b b b c".split()
    runs = periodic.find_runs([words])[0]
    assert runs == [(1, 8, 2), (9, 6, 1)]
    assert periodic.strongest(runs) == (9, 6, 1) and periodic.strongest([]) is None
    assert periodic.strongest([(0, 8, 2), (9, 12, 3)]) == (0, 8, 2)
    assert periodic.collapse(words, runs) == b"a x y b c"


def test_odd_rows(odd_rows, no_rows):
    assert periodic.periodic_runs(no_rows).count() == 0
    found = periodic.periodic_runs(odd_rows).collect()
    assert len(found) == odd_rows.count()
    by_text = {r.doc_id: r.text for r in odd_rows.collect()}
    for r in found:
        words = (by_text[r.id] or "").encode().split()
        assert r.n_words == len(words)
        if len(words) < 1000:
            assert [tuple(x) for x in r.runs] == plain_runs(words)
    assert {r.collapsed for r in found if r.id in (2, 3)} == {""}
    # 977 words and a filler after each repeat themselves through the longest text
    assert [tuple(x) for r in found if r.id == 6 for x in r.runs] == [(0, 60_000, 1954)]
