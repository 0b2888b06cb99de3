"""The second reading of crowds aligns a pair once and gives links, not pairs."""

import random

import numpy as np
import pyarrow as pa

from ridewright.llm import near_duplicates as nd

COLUMNS = ("crowd", "low", "high", "node", "label", "side", "n_words", "fold", "text", "crowds")


def read_again(texts, crowds, labels=None):
    """Links that the texts give, all of them in every one of the crowds."""
    rows = []
    for crowd in crowds:
        for node, words in enumerate(texts):
            label = labels[node] if labels else node
            rows.append((crowd, 0, 0, node, label, 0, len(words), nd.folded(words), b" ".join(words).decode(), list(crowds)))
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=COLUMNS)
    return [(r["a"], r["b"]) for out in nd._cross(0.8)(iter([batch])) for r in out.to_pylist()]


def shuffled_texts(n):
    """Texts of the same words, each in an order of its own: counts leave all pairs open, none is alike."""
    rng, words = random.Random(n), [b"w%d" % i for i in range(60)]
    return [rng.sample(words, len(words)) for _ in range(n)]


def test_pairs_that_are_not_alike_make_no_rows_and_are_aligned_once(monkeypatch):
    tried = []
    monkeypatch.setattr(nd, "similar", lambda a, b, s: tried.append((a, b)))
    texts, crowds = shuffled_texts(30), [5, 1 << 41, 77, 1 << 42, 9]
    assert read_again(texts, crowds) == []
    assert len(tried) == 30 * 29 // 2 == len(set(map(frozenset, tried)))


def test_links_of_a_crowd_are_fewer_than_its_classes():
    base = shuffled_texts(1)[0]
    texts = [[*base[:i], b"x%d" % i, *base[i + 1 :]] for i in range(40)]
    found = read_again(texts, [3])
    assert len(found) == 39
    labels = [i // 10 for i in range(40)]
    assert len(read_again(texts, [3], labels)) == 3


def test_every_pair_has_one_turn_among_the_crowds_it_shares():
    rng = random.Random(2)
    nodes = np.arange(25)
    crowds = [[c for c in range(12) if rng.random() < 0.5] for _ in nodes]
    turns = {}
    for crowd in range(12):
        here = np.array([n for n in nodes if crowd in crowds[n]])
        if not len(here):
            continue
        turn = nd._Turns(crowd, here, [crowds[n] for n in here])
        for i in range(len(here) - 1):
            others = np.arange(i + 1, len(here))
            for j in others[turn.of(i, others)]:
                turns.setdefault((int(here[i]), int(here[j])), []).append(crowd)
    shared = {(i, j) for i in range(25) for j in range(i + 1, 25) if set(crowds[i]) & set(crowds[j])}
    assert set(turns) == shared and all(len(t) == 1 for t in turns.values())
    assert len({t[0] for t in turns.values()}) > 6


def test_distances_by_columns_are_those_of_the_whole_table():
    rng = random.Random(8)
    for _ in range(300):
        a, b = ([b"%d" % rng.randrange(9) for _ in range(rng.randrange(70))] for _ in range(2))
        if rng.random() < 0.5:
            b = [w for w in a if rng.random() < 0.8] + b[: rng.randrange(8)]
        row = list(range(len(b) + 1))
        for i, x in enumerate(a):
            before, row = row, [i + 1]
            for j, y in enumerate(b):
                row.append(min(before[j] + (x != y), before[j + 1] + 1, row[j] + 1))
        for limit in (0, 5, 17, row[-1] - 1, row[-1], 80):
            expected = row[-1] if row[-1] <= limit else None
            assert nd.edit_distance(a, b, limit) == nd.column_distance(a, b, limit) == expected


def test_a_far_pair_costs_no_square_of_the_allowed_edits():
    rng = random.Random(4)
    a = [b"w%d" % rng.randrange(700) for _ in range(6000)]
    tried = []
    b = [w if rng.random() < 0.7 else b"x" for w in a]

    class Word(bytes):
        def __eq__(self, other):
            tried.append(1)
            return bytes.__eq__(self, other)

        __hash__ = bytes.__hash__

    assert nd.edit_distance([Word(w) for w in a], b, 1200) is None
    assert len(tried) < 100_000
