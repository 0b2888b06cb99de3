"""I-Match document fingerprints over several randomised lexicon subsets.

Terms whose document frequency lies in a band form the lexicon. Each subset of it keeps a term with
a fixed probability, decided by a hash of the term. A document's distinct terms that are in a subset are
sorted and hashed; the fingerprint lists one hash per subset. Subsets come in several rates, so that
short and long documents alike have subsets that hold only a few of their terms: those survive edits.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridewright.llm.common import map_batches, raw_texts, words_of

LEAST_SHARE, MOST_SHARE = 0.001, 0.2  # of all documents: the frequency band of the lexicon
RATES = (1, 2, 3, 4, 5, 6, 7, 8)  # a subset of rate r keeps each term with probability 2**-r
PER_RATE = 8
EMPTY = "-" * 8
ODD = np.uint64(0x9E3779B97F4A7C15)
FLUSH_TERMS = 500_000
RANGES_PER_PARTITION = 4


def term_counts(docs: DataFrame, text_col: str) -> DataFrame:
    """(term, df): in how many documents a term occurs, summed per task before the shuffle."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for raw in raw_texts(batch.column(0)):
                seen.update(set(words_of(raw)))
            if len(seen) > FLUSH_TERMS:
                yield rows(seen)
                seen.clear()
        yield rows(seen)

    def rows(seen: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(
            {"term": pa.array(list(seen), pa.binary()), "df": pa.array(list(seen.values()), pa.int64())}
        )

    schema = T.StructType([T.StructField("term", T.BinaryType()), T.StructField("df", T.LongType())])
    return map_batches(docs.select(text_col), step, schema).groupBy("term").agg(F.sum("df").alias("df"))


def lexicon(docs: DataFrame, *, text_col: str = "text", least: float = LEAST_SHARE, most: float = MOST_SHARE) -> list[bytes]:
    """The terms of the band, sorted. At most (mean distinct terms per document) / ``least`` terms can reach it."""
    n = docs.count()
    counts = term_counts(docs, text_col).where((F.col("df") >= max(2, least * n)) & (F.col("df") <= max(2, most * n)))
    return sorted(bytes(r.term) for r in counts.select("term").collect())


class Fingerprinter:
    """Membership of each lexicon term in each subset, as one bit mask per term."""

    def __init__(self, terms: list[bytes]):
        self.rates = np.repeat(RATES, PER_RATE)
        self.index = {t: i for i, t in enumerate(terms)}
        self.codes = np.zeros(len(terms) + 1, np.uint64)
        self.masks = np.zeros((len(terms) + 1, len(self.rates)), bool)
        for i, term in enumerate(terms):
            # One byte decides a subset: its lowest r bits are all zero with probability 2**-r.
            draw = hashlib.blake2b(term, digest_size=64).digest()
            self.codes[i] = int.from_bytes(hashlib.blake2b(term, digest_size=8, key=b"code").digest(), "little")
            self.masks[i] = (np.frombuffer(draw, np.uint8)[: len(self.rates)] & ((1 << self.rates) - 1)) == 0

    def signatures(self, raw: bytes | None) -> list[str]:
        """One hash per subset; ``EMPTY`` where the document has no term of the subset."""
        words = set(words_of(raw))
        get = self.index.get
        kept = np.array(sorted(i for i in map(get, words) if i is not None), np.int64)
        if not len(kept):
            # Nothing in the lexicon: all distinct terms (of a text without words: the text) stand in.
            whole = b" ".join(sorted(words)) or (raw or b"")
            return [hashlib.blake2b(whole, digest_size=4, key=b"whole").hexdigest()] * len(self.rates)
        inside = self.masks[kept]
        rank = np.cumsum(inside, axis=0, dtype=np.uint64)
        mixed = (self.codes[kept][:, None] ^ (rank * ODD)) * ODD
        mixed = (mixed ^ (mixed >> np.uint64(29))) * ODD
        total = np.where(inside, mixed ^ (mixed >> np.uint64(32)), np.uint64(0)).sum(axis=0, dtype=np.uint64)
        used = rank[-1] > 0
        return [f"{v >> 32:08x}" if u else EMPTY for v, u in zip(total.tolist(), used.tolist(), strict=True)]


@lru_cache(maxsize=1)
def printer_of(terms: tuple[bytes, ...]) -> Fingerprinter:
    return Fingerprinter(list(terms))


def likeness(one: list[str], two: list[str]) -> float:
    """The largest share, over the rates, of equal hashes among the subsets that either document has terms of.

    A rate counts if at least half of its subsets are used; if none does, all subsets count together. Equal
    lists give 1.
    """
    if one == two:
        return 1.0
    shares, equal_all, used_all = [], 0, 0
    for at in range(0, len(one), PER_RATE):
        used = [(a, b) for a, b in zip(one[at : at + PER_RATE], two[at : at + PER_RATE]) if a != EMPTY or b != EMPTY]
        equal = sum(a == b for a, b in used)
        equal_all, used_all = equal_all + equal, used_all + len(used)
        if 2 * len(used) >= PER_RATE:
            shares.append(equal / len(used))
    return max(shares, default=equal_all / used_all if used_all else 0.0)


def edited(text: str, following: str) -> str:
    """The last quarter of the code points replaced by as many (or all) of the beginning of ``following``."""
    cut = len(text) // 4
    return text[: len(text) - cut] + following[:cut]


ARROW_RESULT = pa.schema(
    [
        ("id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
    ]
)
RESULT = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("edited_sha256", T.StringType()),
        T.StructField("fingerprint", T.StringType()),
        T.StructField("edited_fingerprint", T.StringType()),
        T.StructField("near_edited", T.DoubleType()),
        T.StructField("near_next", T.DoubleType()),
    ]
)


def fingerprints(docs: DataFrame, terms: list[bytes], *, text_col: str = "text", out: str = "fingerprint") -> DataFrame:
    """Every row of ``docs`` with its fingerprint; null counts as empty, an equally named column is replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(tuple(terms))
    base = docs.drop(out)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        printer = printer_of(shared.value)
        for batch in batches:
            values = ["".join(printer.signatures(t)) for t in raw_texts(batch.column(text_col))]
            keep = {c: batch.column(c) for c in batch.schema.names}
            yield pa.RecordBatch.from_pydict({**keep, out: pa.array(values, pa.string())})

    return map_batches(base, step, T.StructType([*base.schema.fields, T.StructField(out, T.StringType())]))


def compare_with_next(docs: DataFrame, terms: list[bytes], *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint every text and its edited text, and hold them against the next document's.

    Documents follow one another by id (null first), repeated ids by text; after the last comes the
    first. They are dealt into ranges of ids; the first document of each range is also sent to the
    range before it, so each range has the successor of its last document, and no order is built in
    one task. Null texts count as empty; a table of one row is its own successor.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ranges = RANGES_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = sorted(set(rows.approxQuantile("id", [i / ranges for i in range(1, ranges)], 0.2 / ranges)))
    bounds = F.array([F.lit(int(c)) for c in cuts]).cast("array<bigint>")
    rows = rows.withColumn("part", F.coalesce(F.size(F.filter(bounds, lambda c: c <= F.col("id"))), F.lit(0)))
    rows = rows.withColumn("part", F.when(F.col("id").isNull(), -1).otherwise(F.col("part")))
    least = sorted((r.part, r.id) for r in rows.groupBy("part").agg(F.min("id").alias("id")).collect())  # one per range
    before = {p: least[i - 1][0] for i, (p, _) in enumerate(least)}
    none = F.col("id").isNull() if least and least[0][1] is None else F.lit(False)
    first = rows.where(none | F.col("id").isin([i for _, i in least if i is not None]))
    first = first.groupBy("part", "id").agg(F.min("text").alias("text"))
    place = F.element_at(F.create_map([F.lit(x) for pair in before.items() for x in pair] or [F.lit(0), F.lit(0)]), F.col("part"))
    tails = first.select("id", "text", place.alias("part"), F.lit(True).alias("extra"))
    both = rows.withColumn("extra", F.lit(False)).unionByName(tails)
    dealt = both.repartition("part").sortWithinPartitions("part", "extra", F.asc_nulls_first("id"), "text")
    shared = spark.sparkContext.broadcast(tuple(terms))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        printer, last = printer_of(shared.value), None
        for batch in batches:
            out = []
            columns = (batch.column(c).to_pylist() for c in ("id", "text", "extra"))
            for number, text, extra in zip(*columns, strict=True):
                own = printer.signatures(text.encode())
                if last is not None:
                    changed = edited(last[1], text)
                    other = printer.signatures(changed.encode())
                    out.append(
                        {
                            "id": last[0],
                            "n_chars": len(last[1]),
                            "edited_sha256": hashlib.sha256(changed.encode()).hexdigest(),
                            "fingerprint": "".join(last[2]),
                            "edited_fingerprint": "".join(other),
                            "near_edited": likeness(last[2], other),
                            "near_next": likeness(last[2], own),
                        }
                    )
                last = None if extra else (number, text, own)
            yield pa.RecordBatch.from_pylist(out, schema=ARROW_RESULT)

    return map_batches(dealt.select("id", "text", "extra"), step, RESULT)
