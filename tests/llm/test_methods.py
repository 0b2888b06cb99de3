"""The methods of the operators against brute force, without Spark."""

import gzip
import math
import random
from itertools import product

import numpy as np
import pytest

from ridewright.llm import context_tree, decontamination, extraction, fingerprints, language, near_duplicates, quality, toxicity, warc

random.seed(7)


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        fresh = [i]
        for j, y in enumerate(b, 1):
            fresh.append(min(row[j] + 1, fresh[-1] + 1, row[j - 1] + (x != y)))
        row = fresh
    return row[-1]


def test_banded_alignment_is_the_edit_distance():
    for _ in range(800):
        a, b = ([random.choice("abc") for _ in range(random.randint(0, 9))] for _ in range(2))
        limit, true = random.randint(0, 8), plain_distance(a, b)
        assert near_duplicates.edit_distance(a, b, limit) == (true if true <= limit else None)


def test_order_minhash_follows_order_and_repetition():
    words = [b"w%d" % i for i in range(300)]
    same = set(near_duplicates.order_minhash(words, 5, 64, 3))
    swapped = set(near_duplicates.order_minhash(words[150:] + words[:150], 5, 64, 3))
    edited = list(words)
    edited[40] = edited[200] = b"other"
    assert len(same & set(near_duplicates.order_minhash(edited, 5, 64, 3))) > 2 * len(same & swapped)
    assert near_duplicates.order_minhash([], 5, 64, 3) == []
    plain, labelled = near_duplicates.labelled_shingles([b"a"] * 9, 5)
    assert len(set(plain.tolist())) == 1 and len(set(labelled.tolist())) == 5


def naive_hits(items, words, window):
    found = set()
    for number, item in enumerate(items):
        n = min(window, len(item))
        for s in range(len(item) - n + 1 if item else 0):
            for p in range(len(words) - n + 1):
                if words[p : p + n] == item[s : s + n]:
                    found.add((number, s, p, n))
    return found


def test_suffix_array_finds_every_window():
    for _ in range(60):
        window = random.randint(1, 4)
        items = [[random.choice("abcd") for _ in range(random.randint(0, 7))] for _ in range(4)]
        words = [random.choice("abcdxy") for _ in range(60)]
        index = decontamination.TestIndex([(str(i), " ".join(t).encode()) for i, t in enumerate(items)], window)
        ids = np.array([index.vocabulary.get(w.encode(), 0) for w in words] + [0])
        at, item, start, size = decontamination.occurrences(index, ids)
        assert set(zip(item.tolist(), start.tolist(), at.tolist(), size.tolist())) == naive_hits(items, words, window)


def test_windows_merge_to_longest_matches():
    text = " ".join(f"t{i}" for i in range(30))
    index = decontamination.TestIndex([("q", text.encode())], 10)
    counts, spans = decontamination._search_shard(index, [f"a b {text} c".encode(), b"t1 t2", None])
    assert counts == [33, 2, 0]
    assert spans == {0: [{"item_id": "q", "item_start": 0, "doc_start": 2, "n_words": 30}]}


def naive_tree(sequence, depth, context=()):
    """Weighted log probability of a decision sequence [(context, bit)] by the recursive definition."""
    zeros, ones = sum(not b for _, b in sequence), sum(b for _, b in sequence)
    own = math.lgamma(zeros + 0.5) + math.lgamma(ones + 0.5) - math.lgamma(zeros + ones + 1) - math.log(math.pi)
    if depth == 0:
        return own
    below = sum(
        naive_tree([(c[:-1], b) for c, b in sequence if c[-1] == x], depth - 1) for x in sorted({c[-1] for c, _ in sequence})
    )
    return np.logaddexp(own, below) - math.log(2)


def test_tree_weights_are_those_of_the_definition():
    text = bytes(random.choice(b"ab") for _ in range(200))
    depth = 3
    buffer, begins, sizes = context_tree.padded([text], depth)
    grams = context_tree.grams_of(buffer, depth, len(buffer), depth)[: sizes[0]]
    keys, counts = np.unique(grams, return_counts=True)
    levels = context_tree.bottom_up(keys, counts.astype(float), depth, 0)
    first_bit = [(tuple(int(g) >> (8 * (d + 1)) & 255 for d in range(depth - 1, -1, -1)), int(g) >> 7 & 1) for g in grams]
    root = levels[-1]
    assert root.weighted[np.flatnonzero(root.keys == 1)[0]] == pytest.approx(naive_tree(first_bit, depth))
    assert context_tree.log_gamma(np.array([0.5, 3.0, 1e6])) == pytest.approx([math.lgamma(x) for x in (0.5, 3.0, 1e6)])


def test_bytes_after_a_context_sum_to_one():
    text = b"abracadabra " * 40
    depth, shards = 3, 4
    buffer, begins, sizes = context_tree.padded([text], depth)
    keys, counts = np.unique(context_tree.grams_of(buffer, depth, len(buffer), depth)[: sizes[0]], return_counts=True)
    nodes = context_tree.top_down(context_tree.bottom_up(keys, counts.astype(float), depth, 0), None, depth)
    lookup = context_tree.Lookup(nodes, keys)
    for context in (b"abr", b"zzz", b"\xff\xff\xff"):
        grams = (np.uint64(int.from_bytes(context, "big")) << np.uint64(8)) | np.arange(256, dtype=np.uint64)
        assert np.exp2(lookup.log2_bytes(grams)).sum() == pytest.approx(1, abs=1e-9)
        assert lookup._walk(grams) == pytest.approx(lookup.log2_bytes(grams))
    buffer, begins, sizes = context_tree.padded([text, b"", b"qqq"], depth)
    asked = context_tree.distinct_grams(buffer, begins, sizes, depth)
    answers = {s: lookup.log2_bytes(asked[at]) for s, at in context_tree.by_shard(asked, shards)}
    none = (np.empty(0, np.uint64), np.empty(0))
    whole = context_tree.score_block(buffer, begins, sizes, depth, shards, none, answers)
    assert whole[0] / len(text) > -0.5 and whole[2] / 3 < -4
    first = context_tree.grams_of(buffer, depth, len(buffer), depth)[: sizes[0]]
    assert whole[0] == pytest.approx(lookup.log2_bytes(first).sum())


@pytest.mark.parametrize("frequent", [1 << 20, 30, 0])
def test_sharded_scores_equal_the_whole_tree(spark, monkeypatch, frequent):
    monkeypatch.setattr(context_tree, "FREQUENT_GRAMS", frequent)
    texts = ["abracadabra " * 9, "", "the quiet river", "abra the river", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    depth, raw = 3, [(t or "").encode() for t in texts]
    learned = [context_tree.grams_of(*context_tree.padded([t], depth)[:1], depth, len(t) + 1 + depth, depth) for t in raw]
    keys, counts = np.unique(np.concatenate(learned), return_counts=True)
    nodes = context_tree.top_down(context_tree.bottom_up(keys, counts.astype(float), depth, 0), None, depth)
    lookup = context_tree.Lookup(nodes, keys)
    model = context_tree.fit(docs, depth=depth, shard_grams=20)
    assert model.shards > 1
    scores = {r.id: r.score for r in context_tree.score(docs, model).collect()}
    for i, grams in enumerate(learned):
        assert scores[i] == pytest.approx(lookup.log2_bytes(grams).sum() * math.log10(2), rel=1e-5)


def brute_cut(prices, edges):
    best = None
    for sides in product((False, True), repeat=len(prices)):
        cost = sum(max(0, p) if not s else max(0, -p) for p, s in zip(prices, sides))
        cost += sum(w for a, b, w in edges if sides[a] != sides[b])
        best = cost if best is None else min(best, cost)
    return best


def test_minimum_cut_is_minimal():
    for _ in range(60):
        n = random.randint(1, 8)
        prices = [random.uniform(-3, 3) for _ in range(n)]
        edges = [(a, b, random.uniform(0, 2)) for a in range(n) for b in range(a) if random.random() < 0.5]
        sides = extraction.minimum_cut(prices, edges)
        cost = sum(max(0, p) if not s else max(0, -p) for p, s in zip(prices, sides))
        cost += sum(w for a, b, w in edges if sides[a] != sides[b])
        assert cost == pytest.approx(brute_cut(prices, edges))


PAGE = """<!doctype html><html><head><title>Site</title><style>p{}</style><script>var a="</p>";</script></head><body>
<header><a href=/>Home</a></header><nav><ul><li><a href=a>One</a><li><a href=b>Two</a></ul></nav>
<div class="cookie-notice">We use cookies to make this site work for you and for others.</div>
<main><article><h1>River &amp; bridge</h1><p>The quiet river   bends <b>below</b> the&nbsp;old bridge.<p>Seven herons watch
the water.<br>It rises.<div class="ad">Buy now, cheap!</div><p>Short.</p></article>
<aside><p>Related reading that is long enough to look like an article on its own.</p></aside>
<section id="comments"><p>A reader comment that goes on and on about herons and bridges.</p></section></main>
<form><label>Mail</label><input></form><footer>&copy; Site. All rights reserved.</footer></body></html>"""


def test_article_is_told_from_the_rest():
    assert extraction.main_text(PAGE) == (
        "River & bridge\nThe quiet river bends below the old bridge.\nSeven herons watch the water. It rises.\nShort."
    )
    assert extraction.main_text(None) == extraction.main_text("") == extraction.main_text("<nav><a>x</a></nav>") == ""
    assert extraction.main_text("just text &lt; more") == "just text < more"


def test_disguised_words_are_spelled_out():
    counts = np.zeros((28, 28, 28))
    for word in ["idiot", "stupid", "trash", "river", "bridge", "water", "the", "tool"] * 50:
        marks = [0, 0, *map(toxicity.symbol, word), 0]
        for i in range(len(marks) - 2):
            counts[marks[i], marks[i + 1], marks[i + 2]] += 1
    reader = toxicity.Reader(toxicity.SpellingModel(counts), {"idiot$": 3.0, "stupid$": 3.0, "trash$": 3.0})
    assert reader.restore("You 1d10t, s.t.u.p.i.d stuuupid tr@sh near the river") == "you idiot stupid stupid trash near the river"
    assert "stupid" in reader.restore("so s t u p i d indeed")
    assert reader.features("an 1d10t".encode())[3] == 3.0 and reader.features(None)[3] == 0.0


def test_discriminant_is_the_gaussian_log_ratio():
    rng = np.random.default_rng(1)
    d = 3
    x = [rng.normal(size=(500, d)) @ rng.normal(size=(d, d)) + m for m in (0.0, 1.5)]
    model = quality.from_moments(
        np.array([500.0, 500.0]), np.array([v.sum(0) for v in x]), np.array([v.T @ v for v in x]), 0.0, 0.0
    )

    def density(point, v):
        mean, cov = v.mean(0), np.cov(v.T, bias=True) + quality.FLOOR * np.eye(d)
        z = point - mean
        return -0.5 * (z @ np.linalg.inv(cov) @ z + np.log(np.linalg.det(cov)))

    for point in rng.normal(size=(5, d)):
        assert model.log_ratio(point[None])[0] == pytest.approx(density(point, x[1]) - density(point, x[0]))


def test_viterbi_is_the_best_labelling():
    model = language.LanguageModel(["a", "b", "c"], np.zeros((language.SLOTS, 3)), np.ones((language.OTHER + 1, 3), bool))
    texts = [np.random.default_rng(i).normal(size=(n, 3)) for i, n in enumerate((5, 1, 4, 0, 5))]
    for scores, found in zip(texts, model.viterbi(texts, 0.7), strict=True):
        worth = lambda labels: sum(s[k] for s, k in zip(scores, labels)) - 0.7 * sum(a != b for a, b in zip(labels, labels[1:]))
        if len(scores):
            assert worth(found) == pytest.approx(max(map(worth, product(range(3), repeat=len(scores)))))


def test_fingerprints_depend_on_distinct_terms_only():
    printer = fingerprints.Fingerprinter([b"t%d" % i for i in range(400)])
    one = printer.signatures(" ".join(f"t{i}" for i in range(300)).encode())
    assert one == printer.signatures(" ".join(f"T{i}" for i in reversed(range(300))).encode() + b" t5 other")
    near = printer.signatures(" ".join(f"t{i}" for i in range(5, 305)).encode())
    far = printer.signatures(" ".join(f"t{i}" for i in range(200, 400)).encode())
    assert fingerprints.likeness(one, one) == 1.0
    assert fingerprints.likeness(one, near) > fingerprints.likeness(one, far)
    assert printer.signatures(b"x y") != printer.signatures(b"x z") and printer.signatures(None) == printer.signatures(b"")
    assert fingerprints.edited("abcdefgh", "XYZ") == "abcdefXY" and fingerprints.edited("abcdefgh", "") == "abcdef"


def test_streams_are_cut_into_records():
    records = [f"WARC/1.1\r\nContent-Length: {n}\r\n\r\n".encode() + b"\r\n\r\n"[:4] * 0 + b"x" * n + b"\r\n\r\n" for n in (0, 5, 70_000)]
    packed = gzip.compress(b"".join(records[:2])) + gzip.compress(records[2])
    data, found = bytearray(), []
    for piece in warc.inflate(memoryview(packed)):
        for i in range(0, len(piece), 1000):
            data += piece[i : i + 1000]
            found += warc.split_records(data)
    assert found == records and not data
    assert [gzip.decompress(warc.member(r)) for r in records] == records
