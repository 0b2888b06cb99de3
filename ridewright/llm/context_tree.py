"""Code lengths by context-tree weighting over bytes.

A byte is eight binary decisions. For each decision node the preceding 0..DEPTH bytes are the contexts, each
with a Krichevsky-Trofimov estimate from its counts of zeros and ones. Every context weighs its own
estimate against the product of its longer contexts; the weights follow from the counts alone, so the
tree is built from summed counts: first bottom-up for the weighted probabilities, then top-down for the
mixture at each context.

Subtrees below two context bytes are independent and are built side by side, shard by shard; above them
there are at most 256 x 255 + 255 nodes, which every task gets. Nothing of the tree is dropped and no task
holds more of it than one shard, so the model grows with the corpus: their number follows the number of
distinct byte strings learned. Texts are scored in blocks: code lengths of the most frequent byte strings,
at most ``FREQUENT_GRAMS``, are known everywhere; a block asks the shards for those of its other distinct
strings and adds all up by text.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ridewright.llm.common import map_batches, raw_texts, stored

DEPTH = 5
SHARD_GRAMS = 100_000
TEXT_BLOCK = 8 << 20  # bytes of text that ask together
BLOCK = 2_000_000
FLUSH_GRAMS = 1_500_000
FLUSH_WORDS = 400_000
FREQUENT_WORDS = 1 << 17
FREQUENT_GRAMS = 1 << 20
BORDER = 0xFF  # never occurs in UTF-8: stands before the beginning and closes a text
END = b"\n"  # never inside a token: the end of a text in the token counts
SPREAD = 2654435761
U = np.uint64


def shard_of(grams: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each gram, by its two nearest context bytes; :func:`shard_column` says the same."""
    return ((grams >> U(8) & U(0xFFFF)) * U(SPREAD) >> U(16)) % U(shards)


def shard_column(gram: str, shards: int) -> Column:
    near = F.shiftright(gram, 8).bitwiseAND(F.lit(0xFFFF))
    return F.shiftright(near * F.lit(SPREAD), 16) % F.lit(shards)


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series after moving the argument up by eight."""
    low = np.ones_like(x)
    for i in range(8):
        low *= x + i
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + series - np.log(low)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of a sequence with these counts."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0) - math.log(math.pi)


def summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order and the sums of the values over each."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    heads = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, np.int64)
    return (keys[heads], *(np.add.reduceat(v[order], heads) if len(heads) else v[:0] for v in values))


@dataclass
class Level:
    """Decision nodes of one context length: key, counts, weight of the own estimate, log weighted probability."""

    keys: np.ndarray
    zeros: np.ndarray
    ones: np.ndarray
    own: np.ndarray
    weighted: np.ndarray

    @property
    def estimate(self) -> np.ndarray:
        return (self.ones + 0.5) / (self.zeros + self.ones + 1.0)


def bits_of(grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(node, zeros, ones) of the deepest contexts; a node is context bytes << 8 | bits read behind a one."""
    keys, zeros, ones = [], [], []
    byte, context = grams & U(255), grams >> U(8) << U(8)
    for k in range(8):
        bit = (byte >> U(7 - k) & U(1)).astype(np.float64)
        keys.append(context | U(1 << k) | byte >> U(8 - k))
        ones.append(counts * bit)
        zeros.append(counts * (1 - bit))
    return summed(np.concatenate(keys), np.concatenate(zeros), np.concatenate(ones))


def shorter(keys: np.ndarray, depth: int) -> np.ndarray:
    """The same decision with the farthest of ``depth`` context bytes forgotten."""
    return keys & U((1 << 8 * depth) - 1)


def weigh(keys: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray | None) -> Level:
    """A level from its counts and the summed log probabilities of its longer contexts."""
    own = log_kt(zeros, ones)
    if below is None:
        return Level(keys, zeros, ones, np.ones(len(keys)), own)
    both = np.logaddexp(own, below)
    return Level(keys, zeros, ones, np.exp(own - both), both - math.log(2))


def bottom_up(grams: np.ndarray, counts: np.ndarray, depth: int, least: int) -> list[Level]:
    """Levels from ``depth`` up to ``least`` context bytes."""
    levels = [weigh(*bits_of(grams, counts), None)]
    for d in range(depth, least, -1):
        low = levels[-1]
        keys, zeros, ones, below = summed(shorter(low.keys, d), low.zeros, low.ones, low.weighted)
        levels.append(weigh(keys, zeros, ones, below))
    return levels


def top_down(levels: list[Level], base: tuple[np.ndarray, np.ndarray, np.ndarray] | None, depth: int) -> list[tuple]:
    """Per level, shortest context first: (depth, keys, observations, probability of a one, mixed so far, left).

    The probability at a context mixes the estimates of all contexts up to it; ``base`` holds keys, the mixed
    part and the weight left of the level above the first.
    """
    out, d = [], depth - len(levels) + 1
    for level in reversed(levels):
        if base is None:
            mixed, left = np.zeros(len(level.keys)), np.ones(len(level.keys))
        else:
            at = np.searchsorted(base[0], shorter(level.keys, d))
            mixed, left = base[1][at], base[2][at]
        chance = mixed + left * level.estimate
        base = (level.keys, mixed + left * level.own * level.estimate, left * (1 - level.own))
        out.append((d, level.keys, level.zeros + level.ones, chance, base[1], base[2]))
        d += 1
    return out


def padded(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts in one buffer between borders, with where each begins and its length with the closing border."""
    border = bytes([BORDER]) * depth
    lengths = np.array([len(t) for t in texts], np.int64)
    begins = np.cumsum(lengths + depth) - lengths
    return np.frombuffer(border + border.join(texts) + border, np.uint8), begins, lengths + 1


def grams_of(buffer: np.ndarray, begin: int, end: int, depth: int) -> np.ndarray:
    """The byte at each place with its ``depth`` predecessors, the byte lowest."""
    out = np.zeros(end - begin, U)
    for back in range(depth, -1, -1):
        out = out << U(8) | buffer[begin - back : end - back]
    return out


def counted_places(begins: np.ndarray, sizes: np.ndarray, n: int) -> np.ndarray:
    """Whether each place of a buffer belongs to a text or its closing border."""
    marks = np.zeros(n + 1, np.int8)
    np.add.at(marks, begins, 1)
    np.add.at(marks, begins + sizes, -1)
    return np.cumsum(marks[:n]) > 0


def tokens_of(raw: bytes) -> list[bytes]:
    """Lower-case A-Z, split at white space, one end token."""
    return [*raw.lower().split(), END]


COUNTS = T.StructType(
    [T.StructField("gram", T.LongType()), T.StructField("word", T.BinaryType()), T.StructField("n", T.LongType())]
)


def _count(depth: int):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter = Counter()
        grams, counts = np.empty(0, U), np.empty(0, np.int64)
        held: list[bytes] = []

        def count_held() -> None:
            nonlocal grams, counts
            buffer, begins, sizes = padded(held, depth)
            inside = counted_places(begins, sizes, len(buffer))
            for at in range(depth, len(buffer), BLOCK):
                end = min(at + BLOCK, len(buffer))
                found, n = np.unique(grams_of(buffer, at, end, depth)[inside[at:end]], return_counts=True)
                grams, counts = summed(np.concatenate([grams, found]), np.concatenate([counts, n]))
            held.clear()

        def out() -> Iterator[pa.RecordBatch]:
            nonlocal grams, counts
            n, m = len(grams), len(words)
            yield pa.RecordBatch.from_pydict(
                {
                    "gram": pa.array(grams.astype(np.int64)),
                    "word": pa.nulls(n, pa.binary()),
                    "n": pa.array(counts),
                }
            )
            yield pa.RecordBatch.from_pydict(
                {
                    "gram": pa.nulls(m, pa.int64()),
                    "word": pa.array(list(words), pa.binary()),
                    "n": pa.array(list(words.values()), pa.int64()),
                }
            )
            words.clear()
            grams, counts = grams[:0], counts[:0]

        size = 0
        for batch in batches:
            for raw in raw_texts(batch.column(0)):
                raw = raw or b""
                words.update(tokens_of(raw))
                held.append(raw)
                size += len(raw) + depth
                if size >= BLOCK:
                    count_held()
                    size = 0
            if len(words) > FLUSH_WORDS or len(grams) > FLUSH_GRAMS:
                yield from out()
        if held:
            count_held()
        yield from out()

    return step


TREE = T.StructType(
    [
        T.StructField("shard", T.LongType()),
        T.StructField("grams", T.BinaryType()),
        T.StructField("counts", T.BinaryType()),
    ]
)
LEVEL = T.StructType(
    [T.StructField("key", T.LongType()), *(T.StructField(c, T.DoubleType()) for c in ("zeros", "ones", "weighted"))]
)


def _packed(shards: int):
    """Counted grams as rows of (shard, grams, counts), at most ``BLOCK`` grams a row."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, counts = _gathered(batches)
        for shard, mine in by_shard(grams, shards):
            for at in range(0, len(mine), BLOCK):
                part = mine[at : at + BLOCK]
                yield pa.RecordBatch.from_pydict(
                    {
                        "shard": pa.array([shard], pa.int64()),
                        "grams": pa.array([grams[part].tobytes()], pa.binary()),
                        "counts": pa.array([counts[part].tobytes()], pa.binary()),
                    }
                )

    return step


def by_shard(grams: np.ndarray, shards: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each shard that occurs with the places of its grams, in ascending order of both."""
    own = shard_of(grams, shards)
    order = np.argsort(own, kind="stable")
    heads = np.flatnonzero(np.diff(own[order], prepend=U(shards)))
    for places in np.split(order, heads[1:]) if len(order) else ():
        yield int(own[places[0]]), places


def _subtrees(depth: int):
    """Counts of each row's grams to the level of two context bytes: (key, zeros, ones, weighted)."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for grams, counts in _shards(batches):
            level = bottom_up(grams, counts, depth, 2)[-1]
            values = (level.keys.astype(np.int64), level.zeros, level.ones, level.weighted)
            yield pa.RecordBatch.from_pydict({n: pa.array(v) for n, v in zip(LEVEL.names, values, strict=True)})

    return step


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Grams and counts of each shard of rows that are sorted by shard."""
    here, grams, counts = None, [], []
    for batch in batches:
        for row in batch.to_pylist():
            if row["shard"] != here and grams:
                yield np.concatenate(grams), np.concatenate(counts)
                grams, counts = [], []
            here = row["shard"]
            grams.append(np.frombuffer(row["grams"], U))
            counts.append(np.frombuffer(row["counts"], np.float64))
    if grams:
        yield np.concatenate(grams), np.concatenate(counts)


def _gathered(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray]:
    parts = [(b.column("gram").to_numpy().astype(U), b.column("n").to_numpy().astype(np.float64)) for b in batches]
    if not parts:
        return np.empty(0, U), np.empty(0)
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def _frequent(depth: int, shared, least: int):
    """The grams seen ``least`` times or more with their code lengths, as two byte strings per shard."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for grams, counts in _shards(batches):
            often = np.sort(grams[counts >= least])
            if len(often):
                bits = Lookup(nodes_of(shared.value, grams, counts, depth), often).ready
                yield pa.RecordBatch.from_pydict(
                    {"grams": pa.array([often.tobytes()], pa.binary()), "bits": pa.array([bits.tobytes()], pa.binary())}
                )

    return step


def nodes_of(upper: list[tuple], grams: np.ndarray, counts: np.ndarray, depth: int) -> list[tuple]:
    """All nodes that a shard's grams can meet."""
    if not len(grams):
        return upper
    return [*upper, *top_down(bottom_up(grams, counts, depth, 2), (upper[-1][1], *upper[-1][4:]), depth)]


class Lookup:
    """Code lengths from the nodes of :func:`top_down`; ``grams`` are those learned, whose lengths are kept ready."""

    def __init__(self, nodes: list[tuple], grams: np.ndarray) -> None:
        self.nodes = [(d, keys, chance) for d, keys, _, chance, _, _ in sorted(nodes, key=lambda x: -x[0])]
        self.grams = np.sort(grams)
        self.ready = self._walk(self.grams)

    def log2_bytes(self, grams: np.ndarray) -> np.ndarray:
        """log2 probability of the lowest byte of each gram after the others."""
        at, hit = found(self.grams, grams)
        total = np.empty(len(grams))
        total[hit] = self.ready[at[hit]]
        total[~hit] = self._walk(grams[~hit])
        return total

    def _walk(self, grams: np.ndarray) -> np.ndarray:
        """Bit by bit: the longest context that has been seen predicts; without any a bit has 1/2."""
        total, byte = np.zeros(len(grams)), grams & U(255)
        for k in range(8):
            node = U(1 << k) | byte >> U(8 - k)
            chance, open_ = np.full(len(grams), 0.5), np.arange(len(grams))
            for d, keys, chances in self.nodes:
                at, hit = found(keys, shorter(grams[open_] >> U(8) << U(8), d + 1) | node[open_])
                chance[open_[hit]] = chances[at[hit]]
                open_ = open_[~hit]
                if not len(open_):
                    break
            bit = (byte >> U(7 - k) & U(1)).astype(bool)
            total += np.log2(np.clip(np.where(bit, chance, 1 - chance), 1e-12, 1.0))
        return total


def found(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the wanted in sorted keys and whether they are there."""
    at = np.searchsorted(keys, wanted)
    if not len(keys):
        return at, np.zeros(len(wanted), bool)
    at[at == len(keys)] = 0
    return at, keys[at] == wanted


@dataclass
class ContextTree:
    """The counted grams by shard, the nodes above the shards and, for the yardstick, the training tokens."""

    depth: int
    shards: int
    tree: DataFrame
    upper: list[tuple]
    often: np.ndarray
    often_bits: np.ndarray
    vocabulary: DataFrame
    train_tokens: int
    distinct_tokens: int
    frequent: dict[bytes, int]


def fit(
    docs: DataFrame,
    *,
    train: Column | None = None,
    text_col: str = "text",
    depth: int = DEPTH,
    shard_grams: int = SHARD_GRAMS,
) -> ContextTree:
    """Learn from the texts of the rows for which ``train`` holds; null counts as empty, ends are learned too.

    ``depth`` is 2 to 7 context bytes. An empty table gives a model in which every bit has probability 1/2.
    """
    rows = (docs.where(train) if train is not None else docs).select(text_col)
    counted = stored(
        map_batches(rows, _count(depth), COUNTS).groupBy("gram", "word").agg(F.sum("n").alias("n")), "counts"
    )
    grams = counted.where("gram is not null").select("gram", "n")
    shards = max(1, math.ceil(grams.count() / shard_grams))
    dealt = grams.repartition(shards, shard_column("gram", shards))
    tree = stored(map_batches(dealt, _packed(shards), TREE, rows=1 << 16), "tree")
    kept = tree.repartition(shards, "shard").sortWithinPartitions("shard")
    upper = map_batches(kept, _subtrees(depth), LEVEL).groupBy(F.col("key").bitwiseAND(F.lit(0xFFFF)).alias("key"))
    top = upper.agg(*(F.sum(c).alias(c) for c in ("zeros", "ones", "weighted"))).collect()  # at most 256 x 255 rows
    columns = (np.array([r[c] for r in top], np.float64) for c in ("zeros", "ones", "weighted"))
    keys, zeros, ones, below = summed(np.array([r.key for r in top], U), *columns)
    one = weigh(keys, zeros, ones, below)
    none = weigh(*summed(shorter(one.keys, 1), one.zeros, one.ones, one.weighted))
    words = counted.where("word is not null").select("word", "n")
    size = words.agg(F.count("*").alias("v"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    frequent = words.orderBy(F.desc("n"), "word").limit(FREQUENT_WORDS).collect()
    upper = top_down([one, none], None, 1)
    often, bits = frequent_grams(grams, kept, depth, upper)
    known = {bytes(r.word): r.n for r in frequent}
    return ContextTree(depth, shards, tree, upper, often, bits, words, size["n"], size["v"], known)


def frequent_grams(grams: DataFrame, tree: DataFrame, depth: int, upper: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent grams in order and their code lengths; all grams of equal counts, at most ``FREQUENT_GRAMS``."""
    spark = grams.sparkSession
    step = F.floor(F.log2("n") * 16)  # at most 64 x 16 rows
    total, least = 0, None
    for r in grams.groupBy(step.alias("s")).agg(F.count("*").alias("k"), F.min("n").alias("n")).orderBy(F.desc("s")).collect():
        total += r.k
        if total > FREQUENT_GRAMS:
            break
        least = r.n
    if least is None:
        return np.empty(0, U), np.empty(0)
    schema = T.StructType([T.StructField(c, T.BinaryType()) for c in ("grams", "bits")])
    rows = map_batches(tree, _frequent(depth, spark.sparkContext.broadcast(upper), least), schema).collect()
    keys = np.concatenate([np.frombuffer(r.grams, U) for r in rows])
    order = np.argsort(keys)
    return keys[order], np.concatenate([np.frombuffer(r.bits) for r in rows])[order]


def packed_ranks(grams: np.ndarray) -> bytes:
    """Ascending grams as compressed differences, byte planes apart."""
    planes = np.diff(grams, prepend=U(0)).view(np.uint8).reshape(-1, 8).T
    return zlib.compress(planes.tobytes(), 1)


def unpacked_ranks(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(raw), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(U).ravel(), dtype=U)


def _blocks(depth: int, shards: int, block: int, shared):
    """Texts in blocks of about ``block`` bytes, with the distinct grams that they ask of each shard."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, number = TaskContext.get().partitionId() << 32, 0
        ids, texts, size, kind = [], [], 0, None

        def out() -> pa.RecordBatch:
            buffer, begins, sizes = padded(texts, depth)
            grams = distinct_grams(buffer, begins, sizes, depth)
            grams = grams[~found(shared.value[0], grams)[1]]
            asked = [{"shard": s, "grams": packed_ranks(grams[at])} for s, at in by_shard(grams, shards)]
            return pa.RecordBatch.from_pydict(
                {
                    "block": pa.array([place + number], pa.int64()),
                    "ids": pa.array([ids], pa.list_(kind)),
                    "buffer": pa.array([zlib.compress(buffer.tobytes(), 1)], pa.binary()),
                    "begins": pa.array([begins], pa.list_(pa.int64())),
                    "sizes": pa.array([sizes], pa.list_(pa.int64())),
                    "asked": pa.array([asked], ARROW_ASKED),
                }
            )

        for batch in batches:
            kind = batch.column("id").type
            for one, raw in zip(batch.column("id").to_pylist(), raw_texts(batch.column("text")), strict=True):
                ids.append(one)
                texts.append(raw or b"")
                size += len(texts[-1]) + depth
                if size >= block:
                    yield out()
                    ids, texts, size, number = [], [], 0, number + 1
        if texts:
            yield out()

    return step


def distinct_grams(buffer: np.ndarray, begins: np.ndarray, sizes: np.ndarray, depth: int) -> np.ndarray:
    inside, pieces = counted_places(begins, sizes, len(buffer)), [np.empty(0, U)]
    for at in range(depth, len(buffer), BLOCK):
        end = min(at + BLOCK, len(buffer))
        pieces.append(distinct(grams_of(buffer, at, end, depth)[inside[at:end]]))
    return distinct(np.concatenate(pieces))


def distinct(grams: np.ndarray) -> np.ndarray:
    """As ``np.unique``, which is several times slower on numbers of 64 bits."""
    grams = np.sort(grams)
    return grams[np.append(True, grams[1:] != grams[:-1])[: len(grams)]]


def _answers(depth: int, shared):
    """Rows sorted by shard, its counted grams first: the code lengths that each block asked for, in its order."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, grams, counts, lookup = None, [], [], None
        for batch in batches:
            blocks, bits = [], []
            for row in batch.to_pylist():
                if row["shard"] != here:
                    here, grams, counts, lookup = row["shard"], [], [], None
                if row["block"] is None:
                    grams.append(np.frombuffer(row["grams"], U))
                    counts.append(np.frombuffer(row["counts"], np.float64))
                    continue
                if lookup is None:
                    learned = np.concatenate([np.empty(0, U), *grams])
                    nodes = nodes_of(shared.value, learned, np.concatenate([np.empty(0), *counts]), depth)
                    lookup = Lookup(nodes, learned)
                    grams, counts = [], []
                blocks.append(row["block"])
                bits.append({"shard": here, "bits": lookup.log2_bytes(unpacked_ranks(row["grams"])).astype(np.float32).tobytes()})
            yield pa.RecordBatch.from_pydict(
                {"block": pa.array(blocks, pa.int64()), "answer": pa.array(bits, ARROW_ANSWER)}
            )

    return step


def _score(depth: int, shared, id_type: pa.DataType):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, shards, often = shared.value
        logs = {w: math.log10(n + 1) for w, n in words.items()}
        known = logs.keys()
        for batch in batches:
            for row in batch.to_pylist():
                raw = zlib.decompress(row["buffer"])
                buffer = np.frombuffer(raw, np.uint8)
                begins, sizes = np.array(row["begins"], np.int64), np.array(row["sizes"], np.int64)
                answers = {a["shard"]: np.frombuffer(a["bits"], np.float32) for a in row["answers"] or ()}
                texts = [raw[b : b + n - 1] for b, n in zip(row["begins"], row["sizes"], strict=True)]
                n_tokens, n_known, base, rare = [], [], [], []
                for raw in texts:
                    seen = Counter(tokens_of(raw))
                    common = seen.keys() & known
                    n_tokens.append(seen.total())
                    n_known.append(sum(map(seen.__getitem__, common)))
                    base.append(math.fsum(logs[w] * seen[w] for w in common))
                    rare.append([(w, n) for w, n in seen.items() if w not in known])
                yield pa.RecordBatch.from_pydict(
                    {
                        "block": pa.array([row["block"]] * len(texts), pa.int64()),
                        "place": pa.array(np.arange(len(texts))),
                        "id": pa.array(row["ids"], id_type),
                        "n_bytes": pa.array(sizes - 1),
                        "n_tokens": pa.array(n_tokens, pa.int64()),
                        "n_known": pa.array(n_known, pa.int64()),
                        "base": pa.array(base, pa.float64()),
                        "bits": pa.array(score_block(buffer, begins, sizes, depth, shards, often, answers)),
                        "rare": pa.array([[{"word": w, "n": n} for w, n in x] for x in rare], ARROW_RARE),
                    }
                )

    return step


ARROW_ASKED = pa.list_(pa.struct([("shard", pa.int64()), ("grams", pa.binary())]))
ARROW_ANSWER = pa.struct([("shard", pa.int64()), ("bits", pa.binary())])
ANSWER = T.StructType([T.StructField("shard", T.LongType()), T.StructField("bits", T.BinaryType())])
ASKED = T.ArrayType(T.StructType([T.StructField("shard", T.LongType()), T.StructField("grams", T.BinaryType())]))
ARROW_RARE = pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())]))
RARE = T.ArrayType(T.StructType([T.StructField("word", T.BinaryType()), T.StructField("n", T.LongType())]))


def score_block(
    buffer: np.ndarray,
    begins: np.ndarray,
    sizes: np.ndarray,
    depth: int,
    shards: int,
    often: tuple[np.ndarray, np.ndarray],
    answers: dict[int, np.ndarray],
) -> np.ndarray:
    """log2 probability of each text and its end from frequent grams and the shards' answers.

    Each piece is sorted once; of its places only the ranks, four bytes a byte, are held until all pieces are read.
    """
    inside, pieces = counted_places(begins, sizes, len(buffer)), []
    for at in range(depth, len(buffer), BLOCK):
        end = min(at + BLOCK, len(buffer))
        own, ranks = ranked(grams_of(buffer, at, end, depth)[inside[at:end]])
        pieces.append((at, end, own, ranks))
    grams = distinct(np.concatenate([np.empty(0, U), *(own for _, _, own, _ in pieces)]))
    bits = np.empty(len(grams))
    places, hit = found(often[0], grams)
    bits[hit] = often[1][places[hit]]
    rest = np.flatnonzero(~hit)
    for shard, mine in by_shard(grams[rest], shards):
        bits[rest[mine]] = answers[shard]
    out = np.zeros(len(begins))
    for at, end, own, ranks in pieces:
        value = np.zeros(end - at + 1)
        value[1:][inside[at:end]] = bits[np.searchsorted(grams, own)][ranks]
        value = np.cumsum(value)
        low, high = np.clip(begins, at, end) - at, np.clip(begins + sizes, at, end) - at
        out += value[high] - value[low]
    return out


def ranked(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct grams in order, and for each place which of them it holds."""
    order = np.argsort(grams)
    fresh = grams[order]
    heads = np.append(True, fresh[1:] != fresh[:-1])[: len(fresh)]
    ranks = np.empty(len(grams), np.int32)
    ranks[order] = np.cumsum(heads, dtype=np.int32) - 1
    return fresh[heads], ranks


def score(docs: DataFrame, model: ContextTree, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte) of every whole text.

    score is the log10 probability of the text with its end under the context tree, bits_per_byte its code
    length per byte (of an empty text: per one byte). base_score is the add-one unigram yardstick. Words
    outside the frequent list meet their counts in a join. Null counts as empty; repeated rows are
    answered one by one.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    lists = [T.StructField(c, T.ArrayType(T.LongType())) for c in ("begins", "sizes")]
    schema = T.StructType(
        [
            T.StructField("block", T.LongType()),
            T.StructField("ids", T.ArrayType(rows.schema["id"].dataType)),
            T.StructField("buffer", T.BinaryType()),
            *lists,
            T.StructField("asked", ASKED),
        ]
    )
    often = spark.sparkContext.broadcast((model.often, model.often_bits))
    blocks = stored(map_batches(rows, _blocks(model.depth, model.shards, TEXT_BLOCK, often), schema), "blocks")
    asked = blocks.select("block", F.explode("asked").alias("a")).select("a.shard", "block", "a.grams", F.lit(None).cast("binary").alias("counts"))
    both = model.tree.select("shard", F.lit(None).cast("long").alias("block"), "grams", "counts").unionByName(asked)
    both = both.repartition(model.shards, "shard").sortWithinPartitions("shard", F.col("block").asc_nulls_first())
    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("answer", ANSWER)])
    answers = map_batches(both, _answers(model.depth, spark.sparkContext.broadcast(model.upper)), schema)
    answers = answers.groupBy("block").agg(F.collect_list("answer").alias("answers"))  # one per shard
    shared = spark.sparkContext.broadcast((model.frequent, model.shards, (model.often, model.often_bits)))
    longs = [T.StructField(c, T.LongType()) for c in ("n_bytes", "n_tokens", "n_known")]
    doubles = [T.StructField(c, T.DoubleType()) for c in ("base", "bits")]
    schema = T.StructType(
        [
            T.StructField("block", T.LongType()),
            T.StructField("place", T.LongType()),
            T.StructField("id", rows.schema["id"].dataType),
            *longs,
            *doubles,
            T.StructField("rare", RARE),
        ]
    )
    step = _score(model.depth, shared, to_arrow_type(rows.schema["id"].dataType))
    answered = blocks.drop("asked").join(answers, "block", "left")
    scored = stored(map_batches(answered, step, schema, rows=4), "scores")
    met = scored.select("block", "place", F.explode("rare").alias("r")).select("block", "place", F.col("r.word").alias("word"), F.col("r.n").alias("k"))
    met = met.join(model.vocabulary, "word").groupBy("block", "place")
    met = met.agg(F.sum("k").alias("more"), F.sum(F.col("k") * F.log10(F.col("n") + 1)).alias("part"))
    out = scored.drop("rare").join(met, ["block", "place"], "left")
    below = math.log10(model.train_tokens + model.distinct_tokens + 1)
    base = F.col("base") + F.coalesce("part", F.lit(0.0)) - F.col("n_tokens") * F.lit(below)
    return out.select(
        "id",
        "n_bytes",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more", F.lit(0))).cast("long").alias("n_known"),
        F.lit(model.train_tokens).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        (F.col("bits") * F.lit(math.log10(2))).alias("score"),
        (-F.col("bits") / F.greatest(F.col("n_bytes"), F.lit(1))).alias("bits_per_byte"),
    )
