"""Near duplicates by Order MinHash, verified by banded alignment.

Every text becomes its sequence of k-word shingles, each labelled with the number of its occurrence.
For each of ``bands`` hash functions the few shingles of least value are taken and kept in the order
of the text: two texts agree on that only if they share the shingles and their order, which follows
their edit similarity, not just the overlap of their sets. Texts that agree in a band meet in a bucket.
A scattered edit destroys k shingles, so texts near the limit seldom agree there; every text therefore also
gets bands of two ordered shingles of three words, and one under ``SMALL_TEXT`` words bands of three ordered
words.

Equal texts are one node. A bucket is read by length and falls into crowds at gaps that the allowed edits do
not span. A crowd is read in order, and a node is paired with one leader whose folded word counts are near
enough for the allowed edits; a node near no leader becomes one. The counts give a lower bound of the edits,
so no pair that passes the alignment is lost to them. A pair is aligned inside the band of diagonals that the
allowed edits leave. A node whose counts are near a leader's only just becomes a leader too. Crowds with
followers or nodes near several leaders, whose nodes are not all joined by then, are read again: all their pairs
of nodes of different classes whose counts are near enough, folded and almost exact, are aligned there, so no link
inside a bucket is lost. A pair that meets in many crowds is aligned in one of them, and a crowd gives only the
links that join two of its classes, fewer than it has nodes. Large crowds are cut into parts, read again two parts
at a time, so that a bucket with a third of all nodes is not one task's work.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridewright.llm.common import free_name, map_batches, raw_texts, stored, words_of
from ridewright.llm.components import components

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 64
PER_BAND = 3
SHORT_TEXT, SHORT_BANDS = 64, 16  # short texts also get bands of one shingle each
SCATTER_SHINGLE, SCATTER_BANDS, SCATTER_PER_BAND = 3, 64, 2  # for edits spread over the text
SMALL_TEXT, WORD_BANDS, WORDS_PER_BAND = 96, 32, 3  # texts with few shingles also get bands of words
PART_NODES = 4_000
PART_WORDS = 1 << 22  # of the texts that a task aligns in a part of a crowd
LEAST_FOLD, GREATEST_FOLD = 32, 1024  # places of the folded word counts, a quarter of the words between these
SURE = 0.9  # of the allowed edits: counts this near make no further leader
BAG_PLACES = 4096  # places of the word counts that crowds are read with again
BAG_ROWS = 1024  # rows of these that are compared at once
FEW_EDITS = 16  # alignments follow diagonals up to these
KEPT_TEXTS, KEPT_BYTES = 64, 1 << 16  # texts whose words a task keeps between alignments, and their size at most
FILTER_BITS = 25  # at most, of the map of wanted rows: 1,024 rows of 4 KB
MIX = np.uint64(0x9E3779B97F4A7C15)
BLOCK = 1 << 21
CROWD_ROWS = 10_000  # rows of small columns that a step handles at once


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def multipliers(bands: int) -> np.ndarray:
    """Odd 32-bit multipliers, one per band."""
    return ((mix(np.arange(1, bands + 1, dtype=np.uint64) * MIX) >> np.uint64(32)) | np.uint64(1)).astype(np.uint32)


def labelled_shingles(words: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles in text order, plain and labelled with their occurrence number."""
    codes = np.fromiter(map(crc32, words), np.uint64, len(words))
    n = max(1, len(words) - k + 1)
    plain = np.zeros(n, np.uint64)
    for j in range(min(k, len(words))):
        plain = mix(plain * MIX + codes[j : j + n] + np.uint64(j + 1))
    order = np.argsort(plain, kind="stable")
    ranked = plain[order]
    fresh = np.ones(n, bool)
    fresh[1:] = ranked[1:] != ranked[:-1]
    heads = np.flatnonzero(fresh)
    occurrence = np.empty(n, np.uint64)
    occurrence[order] = np.arange(n) - heads[np.cumsum(fresh) - 1]
    return plain, mix(plain + occurrence * MIX)


def folded(words: list[bytes]) -> bytes:
    """Word counts folded to a power of two of places, each at most 255."""
    size = LEAST_FOLD
    while size < GREATEST_FOLD and 4 * size < len(words):
        size *= 2
    places = np.fromiter(map(crc32, words), np.int64, len(words)) & (size - 1)
    return np.minimum(np.bincount(places, minlength=size), 255).astype(np.uint8).tobytes()


def bag_of(words: list[bytes]) -> bytes:
    """Word counts in BAG_PLACES places, those above zero only: their places, then the counts."""
    places = np.fromiter(map(crc32, words), np.int64, len(words)) & (BAG_PLACES - 1)
    held, counts = np.unique(places, return_counts=True)
    return np.concatenate([held, np.minimum(counts, 32767)]).astype(np.int16).tobytes()


def grams_of(codes: np.ndarray, q: int) -> np.ndarray:
    """Hashes of the runs of ``q`` words, given the codes of the words."""
    codes = codes.astype(np.uint64)
    n = max(0, len(codes) - q + 1)
    found = np.zeros(n, np.uint64)
    for j in range(q):
        found = mix(found * MIX + codes[j : j + n] + np.uint64(j + 1))
    return found


def halved(fold: np.ndarray) -> np.ndarray:
    """The same counts in half as many places."""
    half = fold.shape[-1] // 2
    return fold[..., :half] + fold[..., half:]


def ordered_minima(labelled: np.ndarray, bands: int, per_band: int, first: int = 0) -> list[np.ndarray]:
    """For each band a hash of its shingles of least value in text order; ``first`` numbers the bands."""
    n, keys, take = len(labelled), (labelled >> np.uint64(32)).astype(np.uint32), min(per_band, len(labelled))
    factors, values = multipliers(bands), []
    rows = max(1, BLOCK // n)
    for at in range(0, bands, rows):
        ranks = factors[at : at + rows, None] * keys[None, :]
        line, places = np.arange(len(ranks)), np.empty((len(ranks), take), np.int64)
        for j in range(take):
            places[:, j] = ranks.argmin(axis=1)
            ranks[line, places[:, j]] = np.uint32(0xFFFFFFFF)
        places.sort(axis=1)
        value = np.arange(first + at, first + at + len(ranks), dtype=np.uint64)
        for j in range(take):
            value = mix(value * MIX + labelled[places[:, j]])
        values.append(value)
    return values


def order_minhash(words: list[bytes], k: int, bands: int, per_band: int) -> list[int]:
    """The bucket of each band; none for a text without words."""
    if not words:
        return []
    _, labelled = labelled_shingles(words, k)
    values = ordered_minima(labelled, bands, per_band)
    if len(labelled) < SHORT_TEXT:
        keys = (labelled >> np.uint64(32)).astype(np.uint32)
        least = (multipliers(SHORT_BANDS)[:, None] * keys[None, :]).argmin(axis=1)
        values.append(mix(labelled[least] + np.arange(1, SHORT_BANDS + 1, dtype=np.uint64) * MIX))
    return np.concatenate(values).view(np.int64).tolist()


def scatter_minhash(words: list[bytes]) -> list[int]:
    """The buckets in which texts near the limit meet, however their edits are spread."""
    if not words:
        return []
    values = ordered_minima(labelled_shingles(words, SCATTER_SHINGLE)[1], SCATTER_BANDS, SCATTER_PER_BAND, 1 << 32)
    if len(words) < SMALL_TEXT:
        values += ordered_minima(labelled_shingles(words, 1)[1], WORD_BANDS, WORDS_PER_BAND, 1 << 33)
    return np.concatenate(values).view(np.int64).tolist()


def edit_distance(a: list[bytes], b: list[bytes], limit: int) -> int | None:
    """Word edit distance if it is at most ``limit``, else None.

    Words that both begin or end with are passed over, which leaves the distance as it is. Up to FEW_EDITS the diagonals inside the band are followed; beyond, the columns are computed as whole numbers of
    a bit for each word, whose time grows with the lengths and not with the square of the limit.
    """
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > limit:
        return None
    first, last = 0, 0
    while first < len(a) and a[first] == b[first]:
        first += 1
    while last < len(a) - first and a[-1 - last] == b[-1 - last]:
        last += 1
    a, b = a[first : len(a) - last], b[first : len(b) - last]
    n, m = len(a), len(b)
    few = min(limit, FEW_EDITS)
    goal, far = m - n, {}
    for e in range(few + 1):
        fresh = {}
        rest = few - e  # edits left: a diagonal farther than that from the goal cannot reach it
        for k in range(max(-e, goal - rest), min(e, goal + rest) + 1):
            x = max(far.get(k, -1) + 1, far.get(k - 1, -1), far.get(k + 1, -2) + 1) if e else 0
            x = min(x, n, m - k)
            if x < 0 or x + k < 0:
                continue
            y = x + k
            while x < n and y < m and a[x] == b[y]:
                x += 1
                y += 1
            if k == goal and x >= n:
                return e
            fresh[k] = x
        far = fresh
    return column_distance(a, b, limit) if few < limit else None


def column_distance(a: list[bytes], b: list[bytes], limit: int) -> int | None:
    """The distance of :func:`edit_distance` by columns: bit i tells how it steps at word i of ``a``."""
    if not a:
        return len(b) if len(b) <= limit else None
    at: dict[bytes, int] = {}
    for i, word in enumerate(a):
        at[word] = at.get(word, 0) | (1 << i)
    full, last = (1 << len(a)) - 1, 1 << (len(a) - 1)
    up, down, edits = full, 0, len(a)
    for left, word in zip(range(len(b) - 1, -1, -1), b, strict=True):
        same = at.get(word, 0)
        across = (((same & up) + up) ^ up) | same
        more, less = down | (full & ~(across | up)), up & across
        edits += 1 if more & last else -1 if less & last else 0
        if edits - left > limit:  # a column changes the distance by one at most
            return None
        more, less, same = (more << 1) | 1, less << 1, same | down
        up, down = full & (less | ~(same | more)), full & more & same
    return edits if edits <= limit else None


@lru_cache(KEPT_TEXTS)
def _read(text: bytes | None) -> tuple[list[bytes], np.ndarray]:
    """The words of a text and their codes; a text that is compared with many others is read once."""
    words = words_of(text)
    return words, np.fromiter(map(crc32, words), np.int64, len(words))


def similar(one: bytes | None, two: bytes | None, similarity: float) -> bool:
    """Whether 1 - edits / longer length reaches ``similarity``; texts without words are not alike."""
    (a, a_codes), (b, b_codes) = (
        _read(t) if len(t or b"") <= KEPT_BYTES else _read.__wrapped__(t) for t in (one, two)
    )
    longer = max(len(a), len(b))
    if not a or not b:
        return False
    limit = int((1 - similarity) * longer + 1e-9)
    if longer - min(len(a), len(b)) > limit:
        return False
    fold = [np.bincount(x & 4095, minlength=4096) for x in (a_codes, b_codes)]
    apart = fold[0] - fold[1]
    if max(apart[apart > 0].sum(), -apart[apart < 0].sum()) > limit:  # each edit changes one word at most
        return False
    for q in (2, 3):  # each edit changes q runs of q words at most
        runs = [np.bincount((grams_of(x, q) & np.uint64(4095)).astype(np.int64), minlength=4096) for x in (a_codes, b_codes)]
        apart = runs[0] - runs[1]
        if max(apart[apart > 0].sum(), -apart[apart < 0].sum()) > q * limit:
            return False
    return edit_distance(a, b, limit) is not None


def allowed(longer, similarity: float):
    """Edits that texts of this length (a number or a column of numbers) may differ by."""
    return np.floor((1 - similarity) * longer + 1e-9)


def _sketches(k: int, bands: int, per_band: int):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [words_of(t) for t in raw_texts(batch.column("text"))]
            yield pa.RecordBatch.from_pydict(
                {
                    "key": batch.column("key"),
                    "n_words": pa.array([len(w) for w in texts], pa.int64()),
                    "fold": pa.array([folded(w) for w in texts], pa.binary()),
                    "buckets": pa.array([order_minhash(w, k, bands, per_band) + scatter_minhash(w) for w in texts], pa.list_(pa.int64())),
                }
            )

    return step


SKETCH = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("n_words", T.LongType()),
        T.StructField("fold", T.BinaryType()),
        T.StructField("buckets", T.ArrayType(T.LongType())),
    ]
)
CROWD = T.StructType(
    [T.StructField("crowd", T.LongType()), T.StructField("part", T.LongType()), T.StructField("node", T.LongType())]
)
LED = T.StructType(
    [
        T.StructField("crowd", T.LongType()),
        T.StructField("a", T.LongType()),
        T.StructField("b", T.LongType()),
        T.StructField("sure", T.BooleanType()),
    ]
)
PAIR = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


class _SameFold:
    """Leaders with one number of places: keys, lengths and folded counts in arrays that grow."""

    def __init__(self, places: int) -> None:
        self.n, self.keys = 0, []
        self.sizes = np.empty(8, np.int64)
        self.folds, self.halves = np.empty((8, places), np.int16), np.empty((8, places // 2), np.int16)

    def add(self, key: int, size: int, fold: np.ndarray) -> None:
        if self.n == len(self.sizes):
            self.sizes = np.resize(self.sizes, 2 * self.n)
            self.folds = np.resize(self.folds, (2 * self.n, self.folds.shape[1]))
            self.halves = np.resize(self.halves, (2 * self.n, self.halves.shape[1]))
        self.sizes[self.n], self.folds[self.n], self.halves[self.n] = size, fold, halved(fold)
        self.keys.append(key)
        self.n += 1

    def near(self, size: int, fold: np.ndarray, folds: np.ndarray, similarity: float) -> list[tuple[int, bool]]:
        sizes = self.sizes[: self.n]
        limit = allowed(np.maximum(sizes, size), similarity)
        close = np.flatnonzero(np.abs(sizes - size) <= limit)
        if not len(close):
            return []
        apart = folds[close] - fold
        most = np.maximum(np.maximum(apart, 0).sum(axis=1), np.maximum(-apart, 0).sum(axis=1))
        return [
            (self.keys[i], bool(sure))
            for i, may, sure in zip(close, most <= limit[close], most <= SURE * limit[close], strict=True)
            if may
        ]


class Leaders:
    """The leaders of one bucket, by the number of places of their folded counts."""

    def __init__(self) -> None:
        self.by_places: dict[int, _SameFold] = {}

    def add(self, key: int, size: int, fold: np.ndarray) -> None:
        self.by_places.setdefault(len(fold), _SameFold(len(fold))).add(key, size, fold)

    def near(self, size: int, fold: np.ndarray, similarity: float) -> list[tuple[int, bool]]:
        """Leaders that may be within the allowed edits of a node, and whether the counts are near enough.

        Counts of different numbers of places are compared in the smaller one.
        """
        found = []
        for places, group in self.by_places.items():
            mine, theirs = fold, group.folds if places <= len(fold) else group.halves
            while len(mine) > places:
                mine = halved(mine)
            while theirs.shape[1] > len(mine):
                theirs = halved(theirs)
            found += group.near(size, mine, theirs, similarity)
        return found


def _crowds(similarity: float, part_nodes: int):
    """Rows sorted by (bucket, n_words, node) to those that have company: (crowd, part, node).

    A crowd is a stretch of a bucket in which each length is within the allowed edits of the one before;
    texts of two crowds of a bucket are never alike.
    """

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 40
        held = tuple(np.empty(0, np.int64) for _ in range(3))  # the last row, which the next one may keep company
        crowd, place, met = 0, 0, False  # its crowd, its place there, and whether the row before is near
        for batch in chain(batches, [None]):
            if batch is None:
                rows = held
            else:
                columns = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("bucket", "n_words", "node"))
                rows = tuple(np.concatenate([h, c]) for h, c in zip(held, columns, strict=True))
            bucket, size, node = rows
            n = len(node)
            if not n:
                continue
            near = np.empty(n + 1, bool)
            near[0], near[n] = met, False
            near[1:n] = (bucket[1:] == bucket[:-1]) & (size[1:] - size[:-1] <= allowed(size[1:], similarity))
            first = np.flatnonzero(~near[:n])
            stretch = np.cumsum(~near[:n])
            start = np.concatenate([[-place], first])[stretch]
            done = n if batch is None else n - 1
            places, crowds = np.arange(n) - start, base + crowd + stretch
            keep = np.flatnonzero((near[:n] | near[1:])[:done])
            yield pa.RecordBatch.from_pydict(
                {
                    "crowd": pa.array(crowds[keep], pa.int64()),
                    "part": pa.array(places[keep] // part_nodes, pa.int64()),
                    "node": pa.array(node[keep], pa.int64()),
                }
            )
            held = tuple(r[-1:] for r in rows)
            # the held row is the first of the next round: its own step into its crowd is counted again there
            met = bool(near[n - 1])
            crowd, place = int(crowds[-1] - base) - (not met), int(places[-1]) if met else 0

    return step


def _apart(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Least number of edits between texts of these folded counts, row by row."""
    apart = one - two
    return np.maximum(np.maximum(apart, 0).sum(axis=1), np.maximum(-apart, 0).sum(axis=1))


def _unfolded(folds: list[bytes], places: int) -> np.ndarray:
    """Folded counts of one number of places or more as rows of ``places`` numbers."""
    out = np.empty((len(folds), places), np.int16)
    sizes = np.array([len(f) for f in folds])
    for size in set(sizes.tolist()):
        at = np.flatnonzero(sizes == size)
        rows = np.frombuffer(b"".join(folds[i] for i in at), np.uint8).reshape(len(at), size).astype(np.int16)
        while rows.shape[1] > places:
            rows = halved(rows)
        out[at] = rows
    return out


def _twos(first: np.ndarray, sizes: np.ndarray, folds: list[bytes], similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Whether the rows ``first`` may be, and surely are, near the rows behind them."""
    limit = allowed(np.maximum(sizes[first], sizes[first + 1]), similarity)
    apart = np.abs(sizes[first] - sizes[first + 1]).astype(np.float64)
    open_ = np.flatnonzero(apart <= limit)
    places = np.array([min(len(folds[i]), len(folds[i + 1])) for i in first[open_]], np.int64)
    for size in set(places.tolist()):
        at = open_[places == size]
        one, two = ([folds[i + j] for i in first[at]] for j in (0, 1))
        apart[at] = _apart(_unfolded(one, size), _unfolded(two, size))
    return apart <= limit, apart <= SURE * limit


def _lead(similarity: float, part_nodes: int):
    """Rows sorted by (crowd, part, node) to pairs (leader, node, sure): for each node its least sure leader, or else
    the least near one.

    Of a part in which a node follows or is near several leaders, the nodes come out too whose counts are near those of
    another, each paired with itself; of a full or later part all nodes. Sure says that a node leads. All pairs of other
    parts whose counts are near come out.
    """

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, leaders, followers, members, met, more = None, Leaders(), Leaders(), [], set(), False
        out: tuple[list[int], list[int], list[int], list[bool]] = ([], [], [], [])

        def close() -> None:
            whole = here is not None and (here[1] or len(members) >= part_nodes)
            if whole:
                kept = members
            elif more and len(members) > 2:
                # a leader that is near no leader may still be near one's follower
                kept = [m for m in members if m[0] in met or followers.near(m[2], unfold(m[3]), similarity)]
            if whole or (more and len(members) > 2 and len(kept) > 2):
                for node, leads, _, _ in kept:
                    put(here[0], node, node, leads)

        def unfold(fold: bytes) -> np.ndarray:
            return np.frombuffer(fold, np.uint8).astype(np.int16)

        def put(*row) -> None:
            for column, value in zip(out, row, strict=True):
                column.append(value)

        for batch in batches:
            folds = batch.column("fold").to_pylist()
            crowd, part, node, size = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("crowd", "part", "node", "n_words"))
            n = len(node)
            start = np.ones(n + 1, bool)
            start[1:n] = (crowd[1:] != crowd[:-1]) | (part[1:] != part[:-1])
            heads = np.flatnonzero(start)
            # whole parts of two nodes, which the ends of the batch cannot be part of
            twos = heads[:-1][(np.diff(heads) == 2) & (heads[:-1] > 0) & (heads[1:] < n) & (part[heads[:-1]] == 0)]
            if part_nodes > 2 and len(twos):
                may, sure = _twos(twos, size, folds, similarity)
                for i, s in zip(twos[may].tolist(), sure[may].tolist(), strict=True):
                    put(int(crowd[i]), int(node[i]), int(node[i + 1]), s)
                rest = np.ones(n, bool)
                rest[twos] = rest[twos + 1] = False
                rest = np.flatnonzero(rest)
            else:
                rest = np.arange(n)
            for i, c, p, key, words in zip(
                rest.tolist(), crowd[rest].tolist(), part[rest].tolist(), node[rest].tolist(), size[rest].tolist(), strict=True
            ):
                if (c, p) != here:
                    close()
                    here, leaders, followers, members, met, more = (c, p), Leaders(), Leaders(), [], set(), False
                fold = unfold(folds[i])
                found = leaders.near(words, fold, similarity)
                follows = any(sure for _, sure in found)
                (followers if follows else leaders).add(key, words, fold)
                more |= follows or len(found) > 1
                members.append((key, not follows, words, folds[i]))
                if found:
                    met.add(key)
                    met.update(a for a, _ in found)
                    put(c, min(a for a, sure in found if sure == follows), key, follows)
            yield pa.RecordBatch.from_arrays([pa.array(c, f) for c, f in zip(out, LED_ARROW, strict=True)], names=LED.names)
            for column in out:
                column.clear()
        close()
        yield pa.RecordBatch.from_arrays([pa.array(c, f) for c, f in zip(out, LED_ARROW, strict=True)], names=LED.names)

    return step


LED_ARROW = (pa.int64(), pa.int64(), pa.int64(), pa.bool_())


class _Folds:
    """Folded counts of some nodes at every number of places that occurs."""

    def __init__(self, folds: list[bytes]) -> None:
        self.places = np.array([len(f) for f in folds])
        self.levels = {}
        for size in set(self.places.tolist()):
            self.levels[size] = np.zeros((len(folds), size), np.int16)
            at = np.flatnonzero(self.places >= size)
            self.levels[size][at] = _unfolded([folds[i] for i in at], size)

    def near(self, i: int, others: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """Those of the others whose counts differ from those of ``i`` by their limit at most."""
        common, keep = np.minimum(self.places[others], self.places[i]), np.zeros(len(others), bool)
        for size in set(common.tolist()):
            at = np.flatnonzero(common == size)
            keep[at] = _apart(self.levels[size][others[at]], self.levels[size][i]) <= limit[at]
        return keep


class _Bags:
    """The counts of :func:`bag_of` of some nodes, read when they are first compared; ``bag`` gives those of a node."""

    def __init__(self, nodes: int, bag: Callable[[int], bytes]) -> None:
        self.bag, self.held = bag, {}
        self.rows, self.total = np.zeros((nodes, BAG_PLACES), np.int16), np.zeros(nodes, np.int64)

    def read(self, i: int) -> None:
        if i not in self.held:
            places, counts = np.frombuffer(self.bag(i), np.int16).reshape(2, -1)
            self.held[i], self.rows[i, places], self.total[i] = places, counts, counts.sum(dtype=np.int64)

    def near(self, i: int, others: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """Those of the others whose counts differ from those of ``i`` by their limit at most."""
        for j in (i, *others.tolist()):
            self.read(j)
        shared, held = np.zeros(len(others), np.int64), self.held[i]
        for lo in range(0, len(others), BAG_ROWS):
            theirs = self.rows[np.ix_(others[lo : lo + BAG_ROWS], held)]
            shared[lo : lo + BAG_ROWS] = np.minimum(theirs, self.rows[i, held]).sum(axis=1, dtype=np.int64)
        return np.maximum(self.total[others], self.total[i]) - shared <= limit


class _Turns:
    """Which of the crowds that two nodes share is the one to align them; ``crowds`` are those of each node.

    It is the shared crowd of least hash with the first node's number, so pairs are spread over their crowds.
    """

    def __init__(self, crowd: int, nodes: np.ndarray, crowds: list[list[int]]) -> None:
        flat = np.fromiter(chain.from_iterable(crowds), np.int64, sum(map(len, crowds)))
        self.names, at = np.unique(flat, return_inverse=True)
        self.held = np.zeros((len(nodes), len(self.names)), bool)
        self.held[np.repeat(np.arange(len(nodes)), [len(c) for c in crowds]), at] = True
        self.here, self.nodes = int(np.searchsorted(self.names, crowd)), nodes

    def of(self, i: int, others: np.ndarray) -> np.ndarray:
        """Whether the crowd at hand is the one for ``i`` and each of the others, all behind it."""
        own = np.flatnonzero(self.held[i])
        value = mix(self.names[own].astype(np.uint64) * MIX + np.uint64(self.nodes[i]))
        sooner = own[value < value[np.searchsorted(own, self.here)]]
        return ~self.held[np.ix_(others, sooner)].any(axis=1)


def cross_pairs(
    nodes: np.ndarray,
    labels: np.ndarray,
    sides: np.ndarray,
    sizes: np.ndarray,
    folds: list[bytes],
    similarity: float,
    bags: list[bytes] | Callable[[int], bytes] | None = None,
    turns: _Turns | None = None,
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of nodes of different labels whose counts are near enough, of different sides if there are two.

    Each edit changes one word at most in the folded counts and in the bags, so neither loses a pair that is alike.
    With ``turns``, for which the nodes have to ascend, pairs of other crowds are left out.
    """
    words, exact = _Folds(folds), None
    two = len(set(sides.tolist())) > 1
    for i in range(len(nodes) - 1):
        open_ = labels[i + 1 :] != labels[i]
        if two:
            open_ &= sides[i + 1 :] != sides[i]
        at = i + 1 + np.flatnonzero(open_)
        limit = allowed(np.maximum(sizes[at], sizes[i]), similarity)
        keep = np.abs(sizes[at] - sizes[i]) <= limit
        at, limit = at[keep], limit[keep]
        if turns is not None and len(at):
            keep = turns.of(i, at)
            at, limit = at[keep], limit[keep]
        keep = words.near(i, at, limit)
        at, limit = at[keep], limit[keep]
        if len(at) and bags is not None:
            exact = exact or _Bags(len(nodes), bags if callable(bags) else bags.__getitem__)
            at = at[exact.near(i, at, limit)]
        if len(at):
            yield np.minimum(nodes[at], nodes[i]), np.maximum(nodes[at], nodes[i])


def _cross(similarity: float):
    """Rows sorted by (crowd, low, high) to links (a, b) between labels of each such group, fewer than its rows.

    Pairs of :func:`cross_pairs` whose labels are not joined yet by links of the group are aligned.
    """

    def links(crowd: int, rows: list[list]) -> pa.RecordBatch:
        rows.sort(key=lambda r: r[0])
        node, label, side, size = (np.array([r[k] for r in rows], np.int64) for k in range(4))
        texts = [r[5] for r in rows]
        at = {n: i for i, n in enumerate(node.tolist())}
        turns = _Turns(crowd, node, [r[6] for r in rows])
        bags = lambda i: bag_of(words_of(texts[i]))  # noqa: E731  of nodes that need them
        root = {x: x for x in label.tolist()}
        found: tuple[list[int], list[int]] = ([], [])

        def joined(x: int) -> int:
            while root[x] != x:
                root[x] = x = root[root[x]]
            return x

        for one, two in cross_pairs(node, label, side, size, [r[4] for r in rows], similarity, bags, turns):
            for a, b in zip(one.tolist(), two.tolist(), strict=True):
                i, j = at[a], at[b]
                x, y = joined(int(label[i])), joined(int(label[j]))
                if x != y and similar(texts[i], texts[j], similarity):
                    root[max(x, y)] = min(x, y)
                    found[0].append(int(label[i]))
                    found[1].append(int(label[j]))
        return pa.RecordBatch.from_arrays([pa.array(f, pa.int64()) for f in found], names=PAIR.names)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, rows = None, []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("crowd", "low", "high", "node", "label", "side", "n_words", "fold")]
            columns += [raw_texts(batch.column("text")), batch.column("crowds").to_pylist()]
            for crowd, low, high, *row in zip(*columns, strict=True):
                if (crowd, low, high) != here:
                    if rows:
                        yield links(here[0], rows)
                    here, rows = (crowd, low, high), []
                rows.append(row)
        if rows:
            yield links(here[0], rows)

    return step


def _verdicts(similarity: float):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = raw_texts(batch.column("one")), raw_texts(batch.column("two"))
            same = [similar(x, y, similarity) for x, y in zip(one, two, strict=True)]
            yield pa.RecordBatch.from_pydict({"a": batch.column("a"), "b": batch.column("b")}).filter(pa.array(same, pa.bool_()))

    return step


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, key, text): the key is the digest of the whole text, null counting as empty."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), F.unhex(F.md5(text)).alias("key"), text.alias("text"))


def picked(rows: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """The join of rows with the distinct keys of the stored table ``wanted``; few other rows are shuffled.

    Rows are large and most of them are not wanted: a map with 16 bits for each wanted key, and FILTER_BITS as its
    exponent at most, passes those whose hash is that of a wanted key. The join decides.
    """
    bits = min(FILTER_BITS, max(15, (16 * wanted.count()).bit_length()))
    place = F.pmod(F.xxhash64(key), F.lit(1 << bits)) + 1  # bitmap positions count from one in each bucket
    held = wanted.groupBy(F.bitmap_bucket_number(place).alias("__bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("__map")
    )
    at = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring("__map", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    passed = rows.withColumn("__bucket", F.bitmap_bucket_number(place)).join(F.broadcast(held), "__bucket")
    passed = passed.where(F.getbit(byte, F.pmod(at, F.lit(8)).cast("int")) == 1)
    return passed.drop("__bucket", "__map").join(wanted.hint("merge"), key)


def verify(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) that the alignment finds alike. Only texts of these pairs are shuffled."""
    pairs = stored(pairs.select("a", "b"), "tried")
    ends = stored(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), "ends")
    own = stored(picked(texts, ends, "node"), "own")
    with_one = pairs.join(own.select(F.col("node").alias("a"), F.col("text").alias("one")).hint("merge"), "a")
    with_two = with_one.join(own.select(F.col("node").alias("b"), F.col("text").alias("two")).hint("merge"), "b")
    return stored(map_batches(with_two.select("a", "b", "one", "two"), _verdicts(similarity), PAIR), "links")


def labelled(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs with the component labels of both ends; a node without links is its own component."""
    for end in ("a", "b"):
        own = labels.select(F.col("node").alias(end), F.col("label").alias(f"label_{end}"))
        pairs = pairs.join(own, end, "left").withColumn(f"label_{end}", F.coalesce(f"label_{end}", end))
    return pairs


def some(rows: DataFrame) -> bool:
    return bool(rows.limit(1).count())


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels (node, label) after links between labels (a, b) are added."""
    joined = components(links)
    last = joined.select(F.col("node").alias("label"), F.col("label").alias("root"))
    old = labels.join(last, "label", "left").select("node", F.coalesce("root", "label").alias("label"))
    return stored(old.unionByName(joined.join(labels, "node", "left_anti")), "labels")


def joined_by(labels: DataFrame, pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Labels after the alignment of all pairs whose ends they do not join yet, one of each two classes first."""
    low, high = F.least("label_a", "label_b").alias("low"), F.greatest("label_a", "label_b").alias("high")
    first = F.row_number().over(Window.partitionBy("low", "high").orderBy("a", "b")) == 1
    pairs = labelled(pairs, labels).where("label_a <> label_b").select("a", "b", low, high)
    pairs = stored(pairs.withColumn("first", first), "apart")
    for chosen in (pairs.where("first"), pairs.where("not first")):
        tried = labelled(chosen.select("a", "b"), labels).where("label_a <> label_b")
        if not some(tried):
            continue
        links = verify(tried, texts, similarity)
        if some(links):
            found = labelled(links, labels)
            labels = merged(labels, found.select(F.col("label_a").alias("a"), F.col("label_b").alias("b")))
    return labels


def groups(
    rows: DataFrame,
    *,
    k: int = SHINGLE,
    similarity: float = SIMILARITY,
    bands: int = BANDS,
    per_band: int = PER_BAND,
) -> DataFrame:
    """(node, label) of the keys of :func:`keyed` rows that are linked to another text.

    Labels are those of all links between texts that share a bucket. Every node is first aligned with its least
    leader; other pairs are aligned only if their ends are not joined by then, which leaves the components as
    they are. Inside, nodes are numbers, which the shuffles carry in fewer bytes than digests.
    """
    sketched = map_batches(rows.select("key", "text"), _sketches(k, bands, per_band), SKETCH)
    once = sketched.groupBy("key").agg(*(F.any_value(c).alias(c) for c in ("n_words", "fold", "buckets")))
    nodes = stored(once.withColumn("node", F.monotonically_increasing_id()), "sketches")
    counts, names = nodes.select("node", "n_words", "fold"), nodes.select("node", "key")
    placed = nodes.select(F.explode("buckets").alias("bucket"), "n_words", "node")
    placed = placed.repartition("bucket").sortWithinPartitions("bucket", "n_words", "node")
    crowds = stored(map_batches(placed, _crowds(similarity, PART_NODES), CROWD, rows=CROWD_ROWS), "crowds")

    def lead(members: DataFrame) -> DataFrame:
        full = members.join(counts.hint("merge"), "node")  # the counts grow with the texts
        full = full.repartition("crowd", "part").sortWithinPartitions("crowd", "part", "node")
        return stored(map_batches(full, _lead(similarity, PART_NODES), LED, rows=CROWD_ROWS), "leaders")

    met = lead(crowds)
    pairs = met.where("a <> b").select("a", "b")
    large = stored(crowds.where("part > 0").select("crowd").distinct(), "large")
    if some(large):
        heads = met.where("a <> b and sure").join(large, "crowd", "left_semi").select("crowd", F.col("a").alias("node")).distinct()
        pairs = pairs.unionByName(lead(heads.withColumn("part", F.lit(0).cast("long"))).where("a <> b").select("a", "b"))
    first = F.row_number().over(Window.partitionBy("b").orderBy("a")) == 1
    pairs = stored(pairs.distinct().withColumn("nearest", first), "pairs")

    def texts_of(ends: DataFrame) -> DataFrame:
        wanted = stored(names.join(ends.distinct(), "node", "left_semi"), "ends")
        return stored(picked(rows.select("key", "text"), wanted, "key").dropDuplicates(["node"]).select("node", "text"), "texts")

    texts = texts_of(pairs.select(F.col("a").alias("node")).union(pairs.select("b")))
    labels = components(verify(pairs.where("nearest"), texts, similarity))
    labels = joined_by(labels, pairs.where("not nearest"), texts, similarity)

    sized = counts.select("node", "n_words").join(labels, "node", "left").select("node", "n_words", F.coalesce("label", "node").alias("label"))
    members = stored(met.where("a = b").select("crowd", F.col("a").alias("node")).join(sized, "node"), "members")
    size = members.groupBy("crowd").agg(
        F.count("*").alias("n"), F.sum("n_words").alias("words"), F.min("label").alias("l"), F.max("label").alias("m")
    )
    parts = F.greatest(F.ceil(F.col("n") / PART_NODES), F.ceil(F.col("words") / PART_WORDS), F.lit(1)).alias("parts")
    open_ = stored(members.join(size.where("l <> m").select("crowd", parts), "crowd"), "open")
    if some(open_):
        own = open_.groupBy("node").agg(F.collect_list("crowd").alias("crowds")).join(counts, "node")
        words = stored(own.join(texts_of(open_.select("node")), "node"), "words")
        sided = open_.withColumn("side", F.pmod(F.xxhash64("node"), "parts"))
        met_by = sided.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
        met_by = met_by.select("crowd", "node", "label", "side", F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"))
        full = met_by.join(words.hint("merge"), "node").repartition("crowd", "low", "high").sortWithinPartitions("crowd", "low", "high")
        crossed = stored(map_batches(full, _cross(similarity), PAIR).distinct(), "crossed")
        if some(crossed):
            labels = merged(labels, crossed)
    named = labels.join(names, "node").select(F.col("key").alias("node"), F.col("label").alias("root"))
    roots = names.select(F.col("node").alias("root"), F.col("key").alias("label"))
    return stored(named.join(roots, "root").select("node", "label"), "groups")


def classes(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(id, key, class_id) of every document: class_id is the least id of its near duplicates.

    Classes are the connected components of verified links and equal texts. Equal texts, also null and
    empty ones (null counts as empty), are always one class, texts without words are alike only if
    equal, and texts under five words have one shingle. Null ids are passed over for class_id, which is
    null only if all ids of a class are.
    """
    rows = keyed(docs, id_col, text_col)
    label = groups(rows, **options)
    named = rows.select("id", "key").join(label, F.col("key") == F.col("node"), "left")
    named = named.select("id", "key", F.coalesce("label", "key").alias("label"))
    heads = named.groupBy("label").agg(F.min("id").alias("class_id"))
    return named.join(heads, "label").select("id", "key", "class_id", "label")


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of each class, all columns unchanged: the least id, among equal ids the least text digest.

    Rows with both equal ids and equal texts count as repetitions; any one of them stays.
    """
    found = stored(classes(docs, id_col=id_col, text_col=text_col, **options), "classes")
    counted = found.groupBy("label", "id", "key").count()
    order = F.struct(F.col("id").isNull().alias("none"), "id", "key", "count")
    kept = counted.groupBy("label").agg(F.min(order).alias("m"))
    key, own, again_, digest = (free_name(docs.columns, n) for n in ("__key", "__id", "__again", "__digest"))
    kept = kept.select(F.col("m.key").alias(key), F.col("m.id").alias(own), (F.col("m.count") > 1).alias(again_))
    named = docs.withColumn(digest, F.unhex(F.md5(F.coalesce(F.col(text_col), F.lit("")))))
    chosen = named.join(kept, (F.col(digest) == F.col(key)) & F.col(id_col).eqNullSafe(F.col(own)))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    once = chosen.where(~F.col(again_)).select(columns)
    again = chosen.where(F.col(again_)).dropDuplicates([key]).select(columns)
    return once.unionByName(again)
