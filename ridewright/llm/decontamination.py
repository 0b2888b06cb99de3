"""Benchmark decontamination: suffix arrays over training words, searched for every test suffix.

The documents of a partition are cut into shards of bounded size. Each shard gets a suffix array
over its words; every test suffix is looked up in it by binary search, which yields all places where
a window of the test text occurs. Windows that continue one another on the same diagonal are merged,
so that the longest verbatim matches come out with their places in both texts.

Words that occur in no test text split a shard into runs. A run shorter than the shortest window
cannot hold a match and is left out of the array, which changes no result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridewright.llm.common import free_name, map_batches, raw_texts, words_of

WINDOW = 10
SHARD_WORDS = 2_000_000
BLOCK_CHARS = 32 << 20

SPAN = T.StructType(
    [
        T.StructField("item_id", T.StringType()),
        T.StructField("item_start", T.IntegerType()),
        T.StructField("doc_start", T.IntegerType()),
        T.StructField("n_words", T.IntegerType()),
    ]
)
SPANS = T.ArrayType(SPAN)
ARROW_SPANS = pa.list_(
    pa.struct(
        [("item_id", pa.string()), ("item_start", pa.int32()), ("doc_start", pa.int32()), ("n_words", pa.int32())]
    )
)


class TestIndex:
    """Distinct windows of a block of test texts, as rows of word numbers."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        places: dict[tuple[int, ...], list[tuple[int, int]]] = {}
        self.item_ids = [name for name, _ in items]
        for number, (_, text) in enumerate(items):
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            if not ids:
                continue
            for start in range(max(1, len(ids) - window + 1)):
                places.setdefault(tuple(ids[start : start + window]), []).append((number, start))
        keys = sorted(places)
        self.lengths = np.array([len(k) for k in keys], np.int64)
        self.rows = np.zeros((len(keys), window), np.int64)
        for i, key in enumerate(keys):
            self.rows[i, : len(key)] = key
        counts = np.array([len(places[k]) for k in keys], np.int64)
        self.first = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        flat = [p for k in keys for p in places[k]]
        self.items = np.array([p[0] for p in flat], np.int64)
        self.starts = np.array([p[1] for p in flat], np.int64)
        self.shortest = int(self.lengths.min()) if len(keys) else 0


def suffix_array(words: np.ndarray, depth: int) -> np.ndarray:
    """Start positions in the order of their first ``depth`` words, by prefix doubling."""
    n, rank, width = len(words), words.astype(np.int64), 1
    order = np.argsort(rank, kind="stable")
    while width < depth:
        ahead = np.zeros(n, np.int64)
        ahead[: max(0, n - width)] = rank[width:]
        key = rank * (int(rank.max(initial=0)) + 1) + ahead
        order = np.argsort(key, kind="stable")
        fresh = np.ones(n, np.int64)
        fresh[1:] = key[order][1:] != key[order][:-1]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(fresh)
        width *= 2
    return order


def search(words: np.ndarray, order: np.ndarray, rows: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of words the range of ``order`` whose suffixes begin with it."""
    padded = np.concatenate([words, np.zeros(rows.shape[1] + 1, words.dtype)])

    def bound(upper: bool) -> np.ndarray:
        low, high = np.zeros(len(rows), np.int64), np.full(len(rows), len(order), np.int64)
        while (open_ := low < high).any():
            middle = (low + high) // 2
            at = order[np.minimum(middle, len(order) - 1)]
            sign = np.zeros(len(rows), np.int64)
            for j in range(rows.shape[1]):
                undecided = (sign == 0) & (j < lengths)
                if not undecided.any():
                    break
                sign = np.where(undecided, np.sign(padded[at + j] - rows[:, j]), sign)
            right = open_ & ((sign <= 0) if upper else (sign < 0))
            low = np.where(right, middle + 1, low)
            high = np.where(open_ & ~right, middle, high)
        return low

    return bound(False), bound(True)


def occurrences(index: TestIndex, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All (place, item, place in item, words) at which a window occurs in a shard; 0 splits runs."""
    none = (np.empty(0, np.int64),) * 4
    if not index.shortest or not len(words):
        return none
    inside = np.concatenate([[0], (words > 0).astype(np.int8), [0]])
    step = np.diff(inside)
    begins, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    long = ends - begins >= index.shortest
    begins, ends = begins[long], ends[long]
    if not len(begins):
        return none
    sizes = ends - begins + 1
    offsets = np.cumsum(sizes) - sizes
    place = np.arange(int(sizes.sum())) - np.repeat(offsets, sizes) + np.repeat(begins, sizes)
    kept = np.where(place < np.repeat(ends, sizes), np.append(words, 0)[place], 0)
    order = suffix_array(kept, index.rows.shape[1])
    low, high = search(kept, order, index.rows, index.lengths)
    hits = high - low
    found = np.flatnonzero(hits)
    if not len(found):
        return none
    which = np.repeat(found, hits[found])
    within = np.arange(len(which)) - np.repeat(np.cumsum(hits[found]) - hits[found], hits[found])
    at = place[order[low[which] + within]]
    copies = index.first[which + 1] - index.first[which]
    number = np.arange(int(copies.sum())) - np.repeat(np.cumsum(copies) - copies, copies)
    entry = np.repeat(index.first[which], copies) + number
    return np.repeat(at, copies), index.items[entry], index.starts[entry], np.repeat(index.lengths[which], copies)


def longest(doc: np.ndarray, at: np.ndarray, item: np.ndarray, start: np.ndarray, size: np.ndarray) -> list[np.ndarray]:
    """Merge windows that continue one another in the same document, item and diagonal."""
    if not len(doc):
        return [doc] * 5
    order = np.lexsort((start, at - start, item, doc))
    doc, at, item, start, size = (x[order] for x in (doc, at, item, start, size))
    fresh = np.ones(len(doc), bool)
    fresh[1:] = (
        (doc[1:] != doc[:-1])
        | (item[1:] != item[:-1])
        | (at[1:] - start[1:] != at[:-1] - start[:-1])
        | (start[1:] != start[:-1] + 1)
    )
    heads = np.flatnonzero(fresh)
    tails = np.append(heads[1:], len(doc)) - 1
    return [doc[heads], at[heads], item[heads], start[heads], start[tails] + size[tails] - start[heads]]


def covered(spans: list[dict]) -> int:
    """Words inside at least one span."""
    total = end = 0
    for begin, stop in sorted((s["doc_start"], s["doc_start"] + s["n_words"]) for s in spans):
        total += max(0, stop - max(begin, end))
        end = max(end, stop)
    return total


def _search_shard(index: TestIndex, texts: list[bytes | None]) -> tuple[list[int], dict[int, list[dict]]]:
    counts, parts, get = [], [], index.vocabulary.get
    for raw in texts:
        words = words_of(raw)
        counts.append(len(words))
        parts.append(np.fromiter(map(get, words, repeat(0)), np.int64, len(words)))
        parts.append(np.zeros(1, np.int64))
    at, item, start, size = occurrences(index, np.concatenate(parts))
    heads = np.cumsum(np.array(counts) + 1) - np.array(counts) - 1
    doc = np.searchsorted(heads, at, side="right") - 1
    spans: dict[int, list[dict]] = {}
    for d, a, i, s, n in zip(*(x.tolist() for x in longest(doc, at - heads[doc], item, start, size)), strict=True):
        spans.setdefault(d, []).append({"item_id": index.item_ids[i], "item_start": s, "doc_start": a, "n_words": n})
    return counts, spans


def _pass(shared, text_name: str, n_name: str, spans_name: str):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, held, words = TestIndex(*shared.value), [], 0
        for batch in batches:
            held.append(batch)
            words += batch.column(text_name).nbytes // 5
            if words >= SHARD_WORDS:
                yield from _flush(index, held)
                held, words = [], 0
        if held:
            yield from _flush(index, held)

    def _flush(index: TestIndex, held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, spans = _search_shard(index, [t for b in held for t in raw_texts(b.column(text_name))])
        at = 0
        for batch in held:
            n = batch.num_rows
            before = batch.column(spans_name).to_pylist()
            column = [(before[i] or []) + spans.get(at + i, []) for i in range(n)]
            arrays = {name: batch.column(name) for name in batch.schema.names}
            arrays[n_name] = pa.array(counts[at : at + n], pa.int64())
            arrays[spans_name] = pa.array(column, ARROW_SPANS)
            at += n
            yield pa.RecordBatch.from_pydict(arrays)

    return step


def test_blocks(benchmark: DataFrame, item_col: str, text_col: str, block_chars: int) -> Iterator[list[tuple[str, bytes]]]:
    """The test texts in blocks of about ``block_chars``: what is sent to the tasks at once is bounded."""
    texts = benchmark.select(
        F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), F.col(text_col).alias("text")
    ).where(F.col("text").isNotNull())
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // block_chars)
    for k in range(n):
        rows = texts.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k).collect() if n > 1 else texts.collect()
        yield sorted((r.item, r.text.encode("utf-8", "surrogatepass")) for r in rows)


def match_spans(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_chars: int = BLOCK_CHARS,
    n_words_name: str = "n_words",
    spans_name: str = "spans",
) -> DataFrame:
    """Every row of ``docs`` with its number of words and its longest verbatim matches.

    A match is a maximal run of words that a document shares with a test text on one diagonal, made of
    windows of ``window`` words; a test text with fewer words (but not none) is one window. Null
    and empty texts have no words; a null item id is written as the empty text. Repeated rows are
    answered one by one. Columns of ``docs`` named like the two results are replaced.
    """
    spark = docs.sparkSession
    out = docs.drop(n_words_name, spans_name).withColumns(
        {n_words_name: F.lit(0).cast("long"), spans_name: F.array().cast(SPANS)}
    )
    blocks = list(test_blocks(benchmark, item_col, item_text_col, block_chars)) or [[]]
    for items in blocks:
        shared = spark.sparkContext.broadcast((items, window))
        out = map_batches(out, _pass(shared, text_col, n_words_name, spans_name), out.schema)
    return out


def with_hits(matched: DataFrame, spans_name: str = "spans") -> DataFrame:
    """Add n_hit (words inside a match) and items (distinct item ids in text order)."""
    ordered = F.array_sort(
        F.transform(F.col(spans_name), lambda s: F.struct(s.doc_start.alias("a"), (s.doc_start + s.n_words).alias("z")))
    )
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
    total = F.aggregate(
        ordered,
        start,
        lambda acc, s: F.struct(
            (acc.n + F.greatest(F.lit(0), s.z - F.greatest(s.a, acc.end))).cast("long").alias("n"),
            F.greatest(acc.end, s.z).alias("end"),
        ),
        lambda acc: acc.n,
    )
    return matched.withColumns(
        {"n_hit": total, "items": F.array_sort(F.array_distinct(F.transform(F.col(spans_name), lambda s: s.item_id)))}
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns unchanged, that share no window with a test text."""
    spans, n_words = free_name(docs.columns, "__spans"), free_name(docs.columns, "__n_words")
    matched = match_spans(docs, benchmark, text_col=text_col, n_words_name=n_words, spans_name=spans, **options)
    return matched.where(F.size(spans) == 0).select([F.col(f"`{c}`") for c in docs.columns])
