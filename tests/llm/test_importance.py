"""Importance resampling against plain counting."""

import hashlib
import math
import zlib
from collections import Counter

import pytest

from ridewright.llm import importance
from ridewright.llm.common import words_of


def features(text, min_n, max_n):
    words = words_of((text or "").encode())
    return [b" ".join(words[i : i + n]) for n in range(min_n, max_n + 1) for i in range(len(words) - n + 1)]


@pytest.mark.parametrize("runs", [(1, 1), (1, 3), (2, 2)])
@pytest.mark.parametrize("share", [1e-9, 0.02, 1.0])
def test_buckets_do_not_depend_on_the_head(odd_rows, runs, share):
    hashing = importance.head(odd_rows, min_n=runs[0], max_n=runs[1], buckets=97, share=share)
    plain = Counter(zlib.crc32(f) % 97 for r in odd_rows.collect() for f in features(r.text, *runs))
    assert importance.totals(odd_rows, hashing).tolist() == [plain[b] for b in range(97)]
    assert (len(hashing.words) > 50) == (share < 1e-3) and (not hashing.pairs or runs[1] > 1)


def test_weights_and_draw(spark, odd_rows):
    target = spark.createDataFrame([(1, "the morning water rise"), (2, None)], "item_id int, text string")
    model = importance.fit(odd_rows, target, importance.head(odd_rows, min_n=1, max_n=2))
    rows = odd_rows.collect()
    s = Counter(zlib.crc32(f) % 10_000 for r in rows for f in features(r.text, 1, 2))
    t = Counter(zlib.crc32(f) % 10_000 for f in features("the morning water rise", 1, 2))
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + 10_000) / ((s[b] + 1) * (t.total() + 10_000))))
    weighed = importance.weigh(odd_rows, model)
    expected = []
    for r in rows:
        fs = features(r.text, 1, 2)
        expected.append((str(r.doc_id), len(fs), sum(gain(zlib.crc32(f) % 10_000) for f in fs) // len(fs) if fs else 0))
    assert sorted((str(r.id), r.n_features, r.weight) for r in weighed.collect()) == sorted(expected)
    drawn = importance.draw(weighed, min_words=3, percent=50).collect()
    for r in drawn:
        h = int(hashlib.sha256(f"2024:{'' if r.id is None else r.id}".encode()).hexdigest()[:8], 16)
        assert r.score == r.weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
    fit = sorted((-r.score, r.id is None, r.id or 0) for r in drawn if r.n_words >= 3)
    ranked = sorted((r.rank, -r.score, r.id is None, r.id or 0) for r in drawn if r.rank is not None)
    assert ranked == [(i + 1, *x) for i, x in enumerate(fit[: len(fit) // 2])]
    kept = importance.resample(odd_rows, target, min_words=3, percent=50)
    assert kept.schema == odd_rows.schema and 0 < kept.count() < odd_rows.count()


def test_no_rows(spark, no_rows):
    target = spark.createDataFrame([], "item_id int, text string")
    drawn = importance.draw(importance.weigh(no_rows, importance.fit(no_rows, target)))
    assert drawn.columns == ["id", "n_words", "n_features", "weight", "score", "rank"] and drawn.count() == 0


def test_ranks_over_many_partitions(spark):
    rows = spark.range(3000).selectExpr("id", "20 + id % 2 as n_words", "20L as n_features", "id % 3 as weight")
    drawn = importance.draw(rows.repartition(7), min_words=21).where("rank is not null").orderBy("rank").collect()
    assert [r.rank for r in drawn] == list(range(1, 151))
    assert all((-a.score, a.id) < (-b.score, b.id) for a, b in zip(drawn, drawn[1:]))


def test_no_setting_is_changed(spark, odd_rows):
    before = dict(spark.conf.getAll)
    importance.weigh(odd_rows, importance.fit(odd_rows, odd_rows)).collect()
    after = dict(spark.conf.getAll)
    assert {k: v for k, v in after.items() if before.get(k) != v and k != "spark.checkpoint.dir"} == {}
