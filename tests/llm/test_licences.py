"""Licence scans against plain search, for the functions and for the registered query."""

import random

import pytest

from ridewright.llm import licences
from ridewright.llm.common import words_of
from ridewright.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def plain_matches(scanner, words):
    found = {}
    for n in range(len(scanner.notices)):
        notice, longest = scanner.words[n], []
        for e in range(len(words)):
            sizes = []
            for q in range(len(notice)):
                k = 0
                while k <= min(e, q) and words[e - k] == notice[q - k]:
                    k += 1
                sizes.append(k)
            longest.append((max(sizes, default=0), sizes))
        for e, (k, sizes) in enumerate(longest):
            if k >= scanner.least and (e + 1 == len(words) or longest[e + 1][0] != k + 1):
                found.setdefault(n, []).extend((e, q, k) for q, size in enumerate(sizes) if size == k)
    return found


def plain_places(scanner, words):
    phrases = scanner.words[len(scanner.notices) :]
    return sorted((p, i) for p, ws in enumerate(phrases) for i in range(len(words) - len(ws) + 1) if words[i : i + len(ws)] == ws)


def test_matching_statistics():
    rng = random.Random(3)
    for _ in range(250):
        letters = "abcd"[: rng.choice([1, 2, 4])]
        some = lambda n: " ".join(rng.choice(letters) for _ in range(n))  # noqa: E731,B023
        notices = [("x", some(rng.randint(1, 12))) for _ in range(rng.randint(1, 4))]
        scanner = licences.Scanner(notices, [("p", some(2)), ("q", some(3))], least=rng.choice([1, 2, 3]))
        words = (some(rng.randint(0, 25)) + " other " + some(9)).encode().split()
        named, matches = scanner.read(words)
        assert {n: sorted(m) for n, m in matches.items()} == {n: sorted(m) for n, m in plain_matches(scanner, words).items()}
        assert sorted(named) == plain_places(scanner, words)


def best_chain(matches, gap):
    """Most words covered by any chain, trying all."""
    best = 0

    def extend(last, total):
        nonlocal best
        best = max(best, total)
        for end, place, size in matches:
            if last is None:
                extend((end, place), size)
            elif last[0] < end and last[1] < place and end - size - gap <= last[0] and place - size - gap <= last[1]:
                extend((end, place), total + min(size, end - last[0], place - last[1]))

    extend(None, 0)
    return best


def test_chains_cover_most():
    rng = random.Random(4)
    scanner = licences.Scanner([("x", "a")], [], gap=2)
    for _ in range(200):
        matches = sorted((rng.randrange(4, 16), rng.randrange(4, 16), rng.randint(1, 4)) for _ in range(rng.randint(0, 6)))
        assert max((c[2] for c in scanner.chains(matches)), default=0) == best_chain(matches, 2)


def test_a_changed_notice_is_covered(spark):
    notice = licences.NOTICES[0][1]
    rows = [
        (1, "Intro words. " + notice.replace("the Software", "the Program", 2) + " More words."),
        (2, "Free words about software and permission to read."),
        (3, "x " + notice + " y " + notice),
        (4, "All  rights\nreserved, ALL RIGHTS RESERVED"),
    ]
    found = {r.id: r for r in licences.licences(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    assert [s.label for s in found[1].spans] == ["mit"] and found[1].score > 0.95
    assert (found[1].spans[0].start, found[1].spans[0].end) == (2, 2 + len(words_of(notice.encode())) - 1)
    assert not found[2].spans and found[2].score < 0.5
    assert [s.share for s in found[3].spans if s.notice == 0] == [1.0, 1.0]
    assert [(p.label, p.start) for p in found[4].phrases] == [("reserved", 0), ("reserved", 3)] and found[4].score == 1.0


def test_odd_rows(odd_rows, no_rows):
    assert licences.licences(no_rows).count() == 0
    found = licences.licences(odd_rows).collect()
    assert len(found) == odd_rows.count() and all(0 <= r.score <= 1 for r in found)
    assert {(r.n_words, r.score) for r in found if r.id in (2, 3)} == {(0, 0.0)}


def test_query(spark):
    docs = {r.doc_id: words_of((r.text or "").encode()) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = QUERIES["op12_licence_automaton"](spark, SMALL).collect()
    assert len(rows) == len(docs)
    scanner = licences.Scanner()
    labels = [label for label, _ in licences.PHRASES]
    for r in rows:
        words = docs[r.doc_id]
        places = plain_places(scanner, words)
        starts = [i for _, i in places]
        base = {labels[p] for p, _ in places}
        assert (r.n_words, r.n_base) == (len(words), len(places))
        assert (r.first_word, r.last_word) == (min(starts, default=None), max(starts, default=None))
        assert r.base_labels == ",".join(sorted(base)) and base <= set(r.labels.split(","))
        text = b" ".join(words)
        assert ("mit" in r.labels.split(",")) == (b"released under the mit license" in text)
        assert ("apache-2.0" in r.labels.split(",")) == (b"licensed under the apache license version 2 0" in text)
        assert (r.score == pytest.approx(1)) == bool(r.labels)
