"""Every operator over odd rows and over no rows, and the registered queries on the smallest data."""

import hashlib
import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "tools"))
import compare  # noqa: E402

from ridewright.llm import context_tree, decontamination, extraction, fingerprints, language, mixing, near_duplicates, quality, toxicity, warc  # noqa: E402
from ridewright.llm.oracles import ORACLES  # noqa: E402

SMALL = "/root/testdata/sf0.001"


def labels(spark):
    return spark.sql("select * from values (1L, 1, 0), (7L, 1, 0), (5L, 0, 1), (6L, 0, 1), (null, 1, 1), (8L, null, 2) as t(doc_id, quality, toxic)")


@pytest.fixture(params=["odd", "none"])
def rows(request, odd_rows, no_rows):
    return odd_rows if request.param == "odd" else no_rows


def test_context_tree(rows):
    n = rows.count()
    model = context_tree.fit(rows, shard_grams=500, depth=3)
    found = context_tree.score(rows, model).collect()
    assert len(found) == n and all(r.score <= 0 and r.base_score <= 0 for r in found)
    assert {r.n_tokens for r in found if r.id in (2, 3)} <= {1}
    assert model.train_tokens == sum(r.n_tokens for r in found)


def test_quality(spark, rows):
    stats = quality.document_statistics(rows)
    model = quality.fit(stats, labels(spark))
    scores = quality.score_statistics(stats, model).collect()
    assert len(scores) == rows.count() and all(0 <= r.score <= 1 for r in scores)
    kept = quality.keep_good(rows, model)
    assert kept.schema == rows.schema and kept.count() == sum(r.score >= 0.5 for r in scores)


def test_extraction(spark):
    pages = spark.sql("select * from values (1L, 'u', '<p>a</p>', 'x'), (1L, 'u', null, 'x'), (2L, null, '', null) as t(page_id, url, html, text)")
    assert sorted((r.page_id, r.text, r.n_chars) for r in extraction.extract(pages).collect()) == [(1, "", 0), (1, "a", 1), (2, "", 0)]
    assert extraction.extract(pages.limit(0)).count() == 0


def test_language(rows):
    found = language.identify(rows, language.fit(rows)).collect()
    assert len(found) == rows.count()
    picked = {r.id: r.lang_pred for r in found}
    if picked:
        assert picked[2] == picked[3] == picked[5] == "und" and picked[7] == "fr" and picked[1] == "en"
    assert all(sum(s.n_words for s in r.spans) > 0 or r.lang_pred == "und" for r in found)


def test_toxicity(spark, rows):
    model = toxicity.fit(rows, labels(spark))
    scores = toxicity.score(rows, model).collect()
    assert len(scores) == rows.count() and all(0 <= r.score <= 1 for r in scores)
    assert toxicity.keep_clean(rows, model).schema == rows.schema
    assert toxicity.restore(rows, model, out="key").count() == rows.count()


def test_mixing(rows):
    mixed = mixing.mix(rows).collect()
    assert len(mixed) == rows.count() and all(0 <= r.probability <= 1 for r in mixed)
    assert not any(r.kept for r in mixed if not r.n_tokens)


def test_raking_reaches_given_targets(spark):
    cells = spark.sql("select * from values ('a', 'x', 't', 10D), ('a', 'y', 't', 30D), ('b', 'x', 't', 40D), ('b', 'y', 't', 20D) as t(source, lang, topic, tokens)")
    share = lambda **s: spark.createDataFrame(list(s.items()), "category string, share double")
    raked = mixing.rake(cells, {"source": share(a=3.0, b=1.0, gone=9.0), "lang": share(x=0.5, y=0.5), "topic": share(t=1.0)})
    sums = {r[0]: r[1] for d in ("source", "lang") for r in raked.groupBy(d).agg(F.sum("weight")).collect()}
    assert sums == pytest.approx({"a": 75, "b": 25, "x": 50, "y": 50}, rel=1e-4)


def test_near_duplicates(rows):
    found = near_duplicates.classes(rows).collect()
    assert len(found) == rows.count()
    named = {}
    for r in found:
        named.setdefault(r.id, set()).add(r.class_id)
    if named:
        assert named[1] == named[None] == {1} and named[2] == named[3] == {2} and named[5] == {5}
    kept = near_duplicates.keep_one(rows)
    assert kept.schema == rows.schema
    assert sorted(r.doc_id for r in kept.collect()) == ([1, 2, 5, 6, 7, 8] if named else [])


def test_a_large_bucket_is_cut_into_parts(spark, monkeypatch):
    monkeypatch.setattr(near_duplicates, "PART_NODES", 4)
    base = [f"w{i}" for i in range(60)]
    texts = [" ".join(base[:j] + [f"x{j}"] + base[j + 1 :]) for j in range(0, 60, 3)] + [" ".join(f"u{k}v{i}" for i in range(40)) for k in range(5)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.id: r.class_id for r in near_duplicates.classes(docs).collect()}
    assert found == {i: 0 if i < 20 else i for i in range(25)}


def test_decontamination(spark, rows):
    benchmark = spark.sql(
        "select * from values (1L, 'bends below the old stone bridge while seven herons watch the morning'), (2L, 'le chien court'), "
        "(null, null), (3L, ''), (2L, 'le chien court') as t(item_id, text)"
    )
    found = decontamination.with_hits(decontamination.match_spans(rows, benchmark, block_chars=20)).collect()
    assert len(found) == rows.count()
    hits = {r.doc_id: (r.n_words, r.n_hit, r.items) for r in found}
    if hits:
        assert hits[1] == (19, 12, ["1"]) and hits[8] == (3, 3, ["2"]) and hits[2] == hits[3] == hits[5] == (0, 0, [])
    kept = decontamination.decontaminate(rows, benchmark)
    assert kept.schema == rows.schema and sorted(r.doc_id for r in kept.collect()) == ([2, 3, 5, 6, 7] if hits else [])


def test_warc_round_trip(spark, folder):
    pages = spark.sql(
        "select * from values (1L, 'u\\r\\nx', 'é', 0), (2L, null, 'é', 0), (2L, 'v', 'é', 0), (3L, 'w', null, 0), (4L, 'w', '', 0), (null, 'w', '', 0), "
        "(9L, 'w', 'WARC/1.1\\r\\n\\r\\n\\r\\n\\r\\n', 0) as t(page_id, url, html, length)"
    )
    members, index = warc.archive(pages, folder=folder)
    found = warc.read_back(index, members).collect()
    kinds = sorted((r.page_id or 0, r.record_type, r.refers_to, r.payload_bytes) for r in found)
    assert kinds == [(0, "revisit", 4, 0), (1, "revisit", 2, 2), (2, "response", None, 2), (2, "response", None, 2), (3, "revisit", 4, 0), (4, "response", None, 0), (9, "response", None, 16)]
    assert {bytes(r.payload) for r in found if r.page_id == 9} == {b"WARC/1.1\r\n\r\n\r\n\r\n"}
    assert next(r for r in found if r.page_id == 4).payload_digest == "3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ"


def test_warc_of_nothing(spark, folder):
    members, index = warc.archive(spark.sql("select 1L page_id, 'u' url, 'x' html").limit(0), folder=folder)
    assert warc.read_back(index, members).count() == 0


def test_fingerprints(rows):
    found = fingerprints.compare_with_next(rows, fingerprints.lexicon(rows)).collect()
    texts = sorted(((r.doc_id is not None, r.doc_id or 0, r.text or "") for r in rows.select("doc_id", "text").collect()))
    expected = sorted(
        hashlib.sha256(fingerprints.edited(a[2], b[2]).encode()).hexdigest() for a, b in zip(texts, texts[1:] + texts[:1])
    )
    assert sorted(r.edited_sha256 for r in found) == expected
    assert fingerprints.fingerprints(rows, [], out="key").count() == rows.count()


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_against_its_statement(spark, name):
    good, note = compare.compare(spark, compare.connect(SMALL), SMALL, name)
    assert good, note
