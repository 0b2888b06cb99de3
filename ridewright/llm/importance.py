"""Importance resampling towards a target distribution over hashed word runs.

Every run of ``min_n`` to ``max_n`` words is a feature; its bucket is the crc32 of its bytes. The counts of the
buckets over all documents and over all target texts are exact. To hash cheaply, the vocabulary is split in a
head and a tail: the CRC states of the words, and of the pairs of words, that make up at least ``HEAD_SHARE``
of all are broadcast; every other feature goes through crc32 itself, continued from the state of the words
before it. Head or tail changes the speed of a feature, never its bucket, so all totals are exact.

Null texts have no words. Empty tables give totals of nought. Repeated rows are counted, weighed and drawn one
by one; among rows of equal score and id the smaller counts go first. A null id is hashed as the empty text and
comes after the others. Other columns of the tables are not looked at, whatever their names. Every text is held
whole by one task, with a number for each of its features.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridewright.llm.common import map_batches, raw_texts, stored, words_of

BUCKETS = 10_000
HEAD_SHARE = 2.0**-17  # so at most 2^17 words and 2^17 pairs are broadcast,
HEAD_BYTES = 64  # none of them longer than this
FLUSH_TERMS = 200_000
SEED = 2024
MIN_WORDS = 20
PERCENT = 10

TERMS = T.StructType([T.StructField("term", T.BinaryType()), T.StructField("n", T.LongType())])
TOTALS = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("n", T.LongType())])


@dataclass
class Hashing:
    """Feature hashing with known states for the head; the rest is hashed directly."""

    buckets: int
    min_n: int
    max_n: int
    words: dict[bytes, int] = field(default_factory=dict)
    pairs: dict[tuple[bytes, bytes], int] = field(default_factory=dict)

    def states(self, words: list[bytes]) -> Iterator[list[int]]:
        """CRC states of the runs of one word, of two words, and so on, by first word."""
        known, crc = self.words.get, zlib.crc32
        states = []
        for w in words:
            state = known(w)
            states.append(crc(w) if state is None else state)
        yield states
        pair = self.pairs.get
        for n in range(2, self.max_n + 1):
            longer = []
            for i in range(len(words) - n + 1):
                state = pair((words[i], words[i + 1])) if n == 2 else None
                longer.append(crc(b" " + words[i + n - 1], states[i]) if state is None else state)
            states = longer
            yield states

    def features(self, words: list[bytes]) -> np.ndarray:
        """The bucket of every feature of a text."""
        runs = [s for n, s in enumerate(self.states(words), 1) if n >= self.min_n]
        return np.concatenate([np.array(s, np.int64) for s in runs]) % self.buckets


@dataclass
class Importance:
    """Bucket totals of source and target, and the gain in thousandths of each bucket."""

    hashing: Hashing
    source: np.ndarray
    target: np.ndarray
    gains: np.ndarray


def _terms(of: Callable[[list[bytes]], Iterable[bytes]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Counts of terms by task; the counter is emptied whenever it holds FLUSH_TERMS."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def rows() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["term", "n"]
            )
            seen.clear()
            return out

        for batch in batches:
            for raw in raw_texts(batch.column("text")):
                seen.update(of(words_of(raw)))
                if len(seen) > FLUSH_TERMS:
                    yield rows()
        yield rows()

    return step


def _frequent(texts: DataFrame, of: Callable[[list[bytes]], Iterable[bytes]], share: float) -> list[bytes]:
    """Terms that are at least ``share`` of all, by exact counts: no more than 1 / share."""
    counts = stored(map_batches(texts, _terms(of), TERMS).groupBy("term").agg(F.sum("n").alias("n")), "terms")
    total = counts.agg(F.sum("n").alias("n")).first().n or 0
    often = counts.where((F.col("n") >= max(2.0, share * total)) & (F.octet_length("term") <= HEAD_BYTES))
    return [bytes(r.term) for r in often.collect()]


def head(
    docs: DataFrame,
    *,
    min_n: int = 1,
    max_n: int = 1,
    buckets: int = BUCKETS,
    share: float = HEAD_SHARE,
    text_col: str = "text",
) -> Hashing:
    """The hashing of ``docs`` with the states of its frequent words, and of pairs of them if runs are longer."""
    texts = docs.select(F.col(text_col).alias("text"))
    words = {w: zlib.crc32(w) for w in _frequent(texts, lambda ws: ws, share)}
    hashing = Hashing(buckets, min_n, max_n, words)
    if max_n > 1 and words:
        shared = docs.sparkSession.sparkContext.broadcast(words)

        def pairs(ws: list[bytes]) -> list[bytes]:
            known = [w in shared.value for w in ws]
            return [b" ".join(ws[i : i + 2]) for i in range(len(ws) - 1) if known[i] and known[i + 1]]

        for term in _frequent(texts, pairs, share):
            a, b = term.split(b" ")
            hashing.pairs[a, b] = zlib.crc32(term)
    return hashing


def totals(texts: DataFrame, hashing: Hashing, *, text_col: str = "text") -> np.ndarray:
    """Exact number of features in each bucket; a task hands on one row a bucket at most."""
    shared = texts.sparkSession.sparkContext.broadcast(hashing)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        sums = np.zeros(own.buckets, np.int64)
        for batch in batches:
            for raw in raw_texts(batch.column("text")):
                if raw:
                    sums += np.bincount(own.features(words_of(raw)), minlength=own.buckets)
        used = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(sums[used], pa.int64())], ["bucket", "n"])

    rows = map_batches(texts.select(F.col(text_col).alias("text")), step, TOTALS)
    out = np.zeros(hashing.buckets, np.int64)
    for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # one row a bucket
        out[r.bucket] = r.n
    return out


def gains_of(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of target to source, one added to every bucket, rounded down."""
    all_source, all_target = float(source.sum() + len(source)), float(target.sum() + len(target))
    ratios = ((t + 1.0) * all_source / ((s + 1.0) * all_target) for s, t in zip(source.tolist(), target.tolist(), strict=True))
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], np.int64)


def fit(docs: DataFrame, target: DataFrame, hashing: Hashing | None = None, *, text_col: str = "text") -> Importance:
    hashing = hashing or head(docs, text_col=text_col)
    source, wanted = totals(docs, hashing, text_col=text_col), totals(target, hashing, text_col=text_col)
    return Importance(hashing, source, wanted, gains_of(source, wanted))


class _WordGains(dict):
    """Gain of a word: the head is filled in, a tail word is hashed whenever it is met."""

    def __init__(self, model: Importance):
        super().__init__((w, int(model.gains[state % model.hashing.buckets])) for w, state in model.hashing.words.items())
        self.gains, self.buckets = model.gains.tolist(), model.hashing.buckets

    def __missing__(self, word: bytes) -> int:
        return self.gains[zlib.crc32(word) % self.buckets]


def weigh(docs: DataFrame, model: Importance, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_features, weight) of every whole text; the weight is the mean gain, rounded down, 0 for none."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    numbers = ["n_words", "n_features", "weight"]

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        single = own.hashing.min_n == own.hashing.max_n == 1
        by_word = _WordGains(own) if single else None
        for batch in batches:
            found: list[tuple[int, int, int]] = []
            for raw in raw_texts(batch.column("text")):
                words = words_of(raw)
                if by_word is not None:
                    n, gain = len(words), sum(map(by_word.__getitem__, words))
                else:
                    features = own.hashing.features(words)
                    n, gain = len(features), int(own.gains[features].sum())
                found.append((len(words), n, gain // n if n else 0))
            columns = [pa.array([f[i] for f in found], pa.int64()) for i in range(3)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], ["id", *numbers])

    return map_batches(rows, step, T.StructType([rows.schema["id"], *(T.StructField(c, T.LongType()) for c in numbers)]))


def draw(weighed: DataFrame, *, seed: int = SEED, min_words: int = MIN_WORDS, percent: int = PERCENT) -> DataFrame:
    """Add score and rank: the ``percent`` of the texts of at least ``min_words`` with the highest scores.

    The score is the weight plus a Gumbel term from the id, so the draw is one without replacement. Ranks come
    from one sort by ranges: a partition numbers its rows, and starts after the rows of those before it.
    """
    spark = weighed.sparkSession
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    h = F.conv(F.left(F.sha2(key, 256), F.lit(8)), 16, 10).cast("bigint")
    gumbel = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("bigint")
    scored = weighed.withColumn("score", F.col("weight") + gumbel).withColumn("_in", F.col("n_words") >= min_words)
    order = [F.desc("_in"), F.desc("score"), F.asc_nulls_last("id"), "n_features", "weight", "_place"]
    # the place of a row only splits repeated rows over partitions
    placed = scored.withColumn("_place", F.monotonically_increasing_id())
    numbered = placed.repartitionByRange(*order).sortWithinPartitions(*order).drop("_place")
    ranked = stored(numbered.withColumn("_at", F.monotonically_increasing_id()), "ranked")
    # Spark numbers rows as partition * 2^33 + row; a partition gives one row here
    parts = ranked.groupBy(F.shiftright("_at", 33).alias("_part")).agg(F.count("*").alias("n"), F.count_if("_in").alias("fit"))
    before, offsets, eligible = 0, [], 0
    for r in sorted(parts.collect()):
        offsets.append((r._part, before))
        before, eligible = before + r.n, eligible + r.fit
    drawn = percent * eligible // 100
    starts = F.broadcast(spark.createDataFrame(offsets, "_part bigint, _before bigint"))
    place = F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    joined = ranked.withColumn("_part", F.shiftright("_at", 33)).join(starts, "_part")
    return joined.withColumn("rank", F.when(F.col("_in") & (place <= drawn), place)).drop("_part", "_before", "_at", "_in")


def resample(docs: DataFrame, target: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **how: int) -> DataFrame:
    """The rows of ``docs`` whose id is drawn, all columns as they are; several rows of one id come together."""
    model = fit(docs, target, text_col=text_col)
    drawn = draw(weigh(docs, model, id_col=id_col, text_col=text_col), **how).where("rank is not null")
    ids = drawn.select(F.col("id").alias("__drawn_id")).distinct()
    return docs.join(ids, docs[id_col].eqNullSafe(ids["__drawn_id"]), "left_semi")
