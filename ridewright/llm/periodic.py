"""Runs of words that repeat periodically, by longest common extensions over a difference cover.

A run is a stretch of consecutive words with smallest period q, at least ``EXPONENT`` * q and ``LEAST`` words
long, that no neighbouring word extends with that period. Every position of a grid of step 3 p asks how far the
text agrees with itself p words on, to the right and to the left: a run of four periods holds such a position.
The grids of all p together have n log n positions. Most extensions end within a few words and are settled by
comparing them. For the others, suffixes are sorted only at positions sampled by a difference cover: any two
positions reach sampled ones by the same step of less than ``COVER`` words, and from there a range minimum over
the common prefixes of neighbouring sorted suffixes tells the rest.

Null and empty texts have no words and no runs. Equal texts give equal results; repeated rows and ids are
answered one by one. Other columns are not looked at. Texts are taken together as one array with a different
separator after each, up to BATCH_BYTES; a longer text is handled alone and whole, in about 200 bytes a word.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridewright.llm.common import map_batches, raw_texts

EXPONENT = 4
LEAST = 6
COVER = 64
FEW = 4  # words compared before suffixes are sorted
AT_ONCE = 1 << 20  # extensions asked for together


def difference_cover(v: int) -> np.ndarray:
    """Residues modulo v whose differences give every residue: r small ones and the multiples of r."""
    r = int(np.ceil(np.sqrt(v)))
    return np.unique(np.concatenate([np.arange(r), np.arange(0, v + r, r) % v]))


class Extensions:
    """How far two suffixes of ``words`` agree. The last word occurs once, so that no suffix begins another."""

    def __init__(self, words: np.ndarray, v: int = COVER):
        self.v, self.size = v, len(words)
        self.cover = difference_cover(v)
        blocks = self.size // v + 1
        # two more blocks of words that occur nowhere else
        fill = np.arange(blocks * v + v - self.size, dtype=np.int64) + int(words.max(initial=0)) + 1
        self.words = np.concatenate([words.astype(np.int64), fill])
        self.place = np.full(v, -1)
        self.place[self.cover] = np.arange(len(self.cover))
        # for each difference, the residue that the first of two positions has to reach
        self.reach = np.zeros(v, np.int64)
        for x in self.cover[::-1]:
            self.reach[(x - self.cover) % v] = x
        self._sort((np.arange(blocks)[:, None] * v + self.cover).ravel())

    def _sort(self, at: np.ndarray) -> None:
        """Rank the sampled suffixes and keep the minima of common prefixes of neighbours."""
        v, n, step = self.v, len(at), len(self.cover)
        small = np.unique(self.words, return_inverse=True)[1]
        kind = np.uint16 if small.max() < 1 << 16 else np.uint32
        # rows of words as bytes: any order of words will do, if it is one order
        blocks = np.lib.stride_tricks.sliding_window_view(small.astype(kind), v)[at]
        rank = np.unique(np.ascontiguousarray(blocks).view(f"S{v * blocks.itemsize}").ravel(), return_inverse=True)[1]
        del blocks
        ranks, jump = [rank], step
        while rank.max() < n - 1:
            key = rank * (n + 1)
            key[: n - jump] += rank[jump:] + 1
            rank = np.unique(key, return_inverse=True)[1]
            ranks.append(rank)
            jump *= 2
        self.rank = rank
        order = np.argsort(rank)
        a, b = order[:-1].copy(), order[1:].copy()
        shared = np.zeros(n - 1, np.int64)
        for level in range(len(ranks) - 1, -1, -1):
            known = ranks[level]
            inside = np.flatnonzero(np.maximum(a, b) < n)
            same = inside[known[a[inside]] == known[b[inside]]]
            shared[same] += v << level
            a[same] += step << level
            b[same] += step << level
        inside = np.flatnonzero(np.maximum(a, b) < n)
        x, y = at[a[inside]], at[b[inside]]
        for t in range(v):
            same = self.words[x + t] == self.words[y + t]
            inside, x, y = inside[same], x[same], y[same]
            if not len(inside):
                break
            shared[inside] += 1
        self.minima = [shared.astype(np.int32)]
        width = 1
        while 2 * width <= len(shared):
            last = self.minima[-1]
            self.minima.append(np.minimum(last[:-width], last[width:]))
            width *= 2

    def _sampled(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Common prefixes of suffixes at sampled positions: the least between their ranks."""
        step = len(self.cover)
        a = self.rank[i // self.v * step + self.place[i % self.v]]
        b = self.rank[j // self.v * step + self.place[j % self.v]]
        low, high = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        out = np.empty(len(i), np.int64)
        for k in np.unique(level):
            at = level == k
            table = self.minima[k]
            out[at] = np.minimum(table[low[at]], table[high[at] - (1 << int(k))])
        return out

    def between(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Number of equal words from positions i and j on; i and j differ."""
        out = np.zeros(len(i), np.int64)
        wait = (self.reach[(i - j) % self.v] - i) % self.v
        alive = np.arange(len(i))
        t = 0
        while len(alive):
            there = wait[alive] == t
            here = alive[there]
            out[here] = t + self._sampled(i[here] + t, j[here] + t)
            alive = alive[~there]
            same = self.words[i[alive] + t] == self.words[j[alive] + t]
            out[alive[~same]] = t
            alive = alive[same]
            t += 1
        return out


class _Texts:
    """The words of several texts as numbers in one array, a different separator after each."""

    def __init__(self, texts: list[list[bytes]]):
        known: dict[bytes, int] = {}
        number = known.setdefault
        self.sizes = np.array([len(t) for t in texts], np.int64)
        flat = [number(w, len(known)) for t in texts for w in t]
        ends = np.cumsum(self.sizes + 1)
        self.starts = ends - self.sizes - 1
        self.words = np.empty(int(ends[-1]) if len(ends) else 0, np.int64)
        self.owner = np.repeat(np.arange(len(texts)), self.sizes + 1)
        inner = np.ones(len(self.words), bool)
        inner[ends - 1] = False
        self.words[inner] = flat
        self.words[~inner] = len(known) + np.arange(len(texts))
        self.both: tuple[Extensions, Extensions] | None = None

    def few(self, a: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Equal words to the right and left of (a, a + p), compared one by one, and whether both sides ended."""
        right, left = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
        open_ended = np.zeros(len(a), bool)
        last = len(self.words) - 1
        for count, sign, begin in ((right, 1, 0), (left, -1, -1)):
            alive = np.arange(len(a))
            for t in range(FEW):
                x = a[alive] + begin + sign * t
                y = x + p[alive]
                inside = (x >= 0) & (y <= last)
                same = inside.copy()
                same[inside] = self.words[x[inside]] == self.words[y[inside]]
                alive = alive[same]
                count[alive] += 1
            open_ended[alive] = True
        return right, left, ~open_ended

    def far(self, a: np.ndarray, p: np.ndarray, whole: bool) -> tuple[np.ndarray, np.ndarray]:
        """The same by sorted samples, of all texts or only of those that hold the positions."""
        shift = np.zeros(len(self.sizes), np.int64)
        if self.both is None:
            words = self.words
            if not whole:
                used = np.zeros(len(self.sizes), bool)
                used[self.owner[a]] = True
                words = words[used[self.owner]]
                kept = np.cumsum(np.where(used, self.sizes + 1, 0)) - (self.sizes + 1)
                shift = self.starts - kept
            both = Extensions(words), Extensions(words[::-1])
            if whole:
                self.both = both
        else:
            both = self.both
        size = both[0].size
        x = a - shift[self.owner[a]]
        right = both[0].between(x, x + p)
        # to the left of the first word of all there is nothing
        left = np.zeros(len(a), np.int64)
        inner = x > 0
        left[inner] = both[1].between(size - x[inner], size - x[inner] - p[inner])
        return right, left

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(text, start, length, period) of all runs, by text, start and period."""
        found: list[tuple[np.ndarray, ...]] = []
        waiting: list[tuple[np.ndarray, np.ndarray]] = []
        held = 0

        def keep(a: np.ndarray, p: np.ndarray, right: np.ndarray, left: np.ndarray) -> None:
            length = right + left + p
            good = length >= np.maximum(LEAST, EXPONENT * p)
            a, p, left, length = a[good], p[good], left[good], length[good]
            found.append(_least_period(a - left, length, p))

        def settle(whole: bool) -> None:
            nonlocal held
            if not waiting:
                return
            a, p = (np.concatenate(c) for c in zip(*waiting, strict=True))
            waiting.clear()
            held = 0
            if not len(a):
                return
            right, left, ended = self.few(a, p)
            keep(a[ended], p[ended], right[ended], left[ended])
            a, p = a[~ended], p[~ended]
            if len(a):
                keep(a, p, *self.far(a, p, whole))

        longest = int(self.sizes.max(initial=0)) // EXPONENT
        for p in range(1, longest + 1):
            a = np.flatnonzero(self.words[:-p:3 * p] == self.words[p :: 3 * p][: -(-(len(self.words) - p) // (3 * p))]) * (3 * p)
            if len(a):
                mine = self.owner[a]
                a = a[(mine == self.owner[a + p]) & (self.sizes[mine] >= EXPONENT * p)]
                waiting.append((a, np.full(len(a), p)))
                held += len(a)
                if held >= AT_ONCE:
                    settle(whole=True)
        settle(whole=False)
        start, length, period = (np.concatenate(c) if found else np.zeros(0, np.int64) for c in zip(*found or [((),) * 3], strict=True))
        start, length, period = _least_period(start.astype(np.int64), length.astype(np.int64), period.astype(np.int64))
        text = self.owner[start] if len(start) else start
        order = np.lexsort((period, start))
        return text[order], (start - self.starts[text])[order] if len(text) else start, length[order], period[order]


def _least_period(start: np.ndarray, length: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, ...]:
    """One row for each stretch, with its smallest period; multiples of it find the same stretch."""
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    first = np.ones(len(start), bool)
    first[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    return start[first], length[first], period[first]


def find_runs(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of each text, by start and period."""
    text, *numbers = _Texts(texts).runs()
    rows = list(zip(*(c.tolist() for c in numbers), strict=True))
    ends = np.searchsorted(text, np.arange(len(texts) + 1))
    return [rows[lo:hi] for lo, hi in zip(ends[:-1], ends[1:], strict=True)]


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of greatest length / period, compared exactly; the first by start, then period, among equals."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that are in the first period of every run that holds them, joined by one space."""
    if not runs:
        return b" ".join(words)
    depth = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    kept = np.flatnonzero(np.cumsum(depth[:-1]) == 0)
    return b" ".join([words[i] for i in kept.tolist()])


RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
ARROW_RUN = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])


def periodic_runs(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    edit: Callable[[object, list[bytes]], list[bytes]] | None = None,
) -> DataFrame:
    """(id, n_words, runs, strongest, collapsed) of every whole text.

    ``edit`` may give other words for the id and words of a text; the search then sees those.

    ``runs`` are (start, length, period) in words, by start and period; ``strongest`` is the one that repeats most
    often, null if there is none; ``collapsed`` is the text without the repetitions, words joined by one space.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = T.StructType(
        [
            rows.schema["id"],
            T.StructField("n_words", T.LongType()),
            T.StructField("runs", T.ArrayType(RUN)),
            T.StructField("strongest", RUN),
            T.StructField("collapsed", T.StringType()),
        ]
    )

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [raw.split() if raw else [] for raw in raw_texts(batch.column("text"))]
            if edit is not None:
                words = [edit(i, w) for i, w in zip(batch.column("id").to_pylist(), words, strict=True)]
            runs = find_runs(words)
            named = lambda run: run and dict(zip(("start", "length", "period"), run, strict=True))
            columns = [
                batch.column("id"),
                pa.array([len(w) for w in words], pa.int64()),
                pa.array([[named(r) for r in rs] for rs in runs], pa.list_(ARROW_RUN)),
                pa.array([named(strongest(rs)) for rs in runs], ARROW_RUN),
                pa.array([collapse(w, rs) for w, rs in zip(words, runs, strict=True)], pa.binary()).cast(pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return map_batches(rows, step, schema)
