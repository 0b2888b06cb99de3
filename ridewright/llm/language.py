"""Language of whole texts, and of spans in mixed texts.

The scripts of a word's letters narrow the languages that may have written it. The rest are scored by
hashed letter n-grams of the word. A Viterbi pass over the words, in which changing the language costs a
penalty, labels each word; runs of equal labels are the spans, and the language with most letters is that
of the document.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridewright.llm.common import map_batches, raw_texts

SLOTS = 1 << 16  # the model holds this many weights per language, whatever the corpus
SIZES = (1, 2, 3, 4)
PENALTY = 6.0
MIN_SCRIPT_SHARE = 0.001
SMOOTHING = 0.5
CACHE_WORDS = 400_000
FLUSH_WORDS = 300_000
UNKNOWN = "und"

# Unicode ranges of letters by script; letters outside all of them count as other.
SCRIPTS = (
    ("latin", ((0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A))),
    ("greek", ((0x370, 0x3FF), (0x1F00, 0x1FFF))),
    ("cyrillic", ((0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F))),
    ("armenian", ((0x530, 0x58F),)),
    ("hebrew", ((0x590, 0x5FF), (0xFB1D, 0xFB4F))),
    ("arabic", ((0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF))),
    ("indic", ((0x900, 0xDFF),)),
    ("southeast", ((0xE00, 0xEFF), (0x1000, 0x109F), (0x1780, 0x17FF))),
    ("georgian", ((0x10A0, 0x10FF), (0x1C90, 0x1CBF))),
    ("hangul", ((0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF))),
    ("kana", ((0x3040, 0x30FF), (0x31F0, 0x31FF), (0xFF66, 0xFF9D))),
    ("han", ((0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF))),
)
OTHER = len(SCRIPTS)
WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")


def script_of(word: str) -> int:
    """The script of a word's first letter."""
    code = ord(word[0])
    for number, (_, ranges) in enumerate(SCRIPTS):
        if any(low <= code <= high for low, high in ranges):
            return number
    return OTHER


def slots(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of all words with their borders marked: (slot, number of the word)."""
    codes = [np.frombuffer(f" {w} ".encode("utf-32-le"), np.uint32) for w in words]
    lengths = np.array([len(c) for c in codes], np.int64)
    flat = np.concatenate(codes).astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), lengths)
    out, owners = [], []
    for size in SIZES:
        if len(flat) < size:
            continue
        n = len(flat) - size + 1
        value = np.full(n, size, np.uint64)
        for j in range(size):
            value = value * np.uint64(0x100000001B3) + flat[j : j + n]
        inside = owner[:n] == owner[size - 1 :]
        value = (value ^ (value >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        out.append((value >> np.uint64(48)).astype(np.int64)[inside])
        owners.append(owner[:n][inside])
    return np.concatenate(out), np.concatenate(owners)


@dataclass
class LanguageModel:
    """Log weights per slot and language, and which languages use each script."""

    languages: list[str]
    weights: np.ndarray
    allowed: np.ndarray
    rows: dict[str, int] = field(default_factory=dict)
    scores: np.ndarray | None = None

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Score of each word in each language; languages that do not use its script are ruled out.

        A word in a script that no language uses scores equally in all.
        """
        new = list({w: None for w in words if w not in self.rows})
        if self.scores is None or len(self.rows) + len(new) > CACHE_WORDS:
            self.rows, self.scores, new = {}, np.empty((0, len(self.languages))), list(dict.fromkeys(words))
        if new:
            slot, owner = slots(new)
            fresh = np.zeros((len(new), len(self.languages)))
            for i in range(len(self.languages)):
                fresh[:, i] = np.bincount(owner, self.weights[slot, i], len(new))
            fresh /= np.bincount(owner, minlength=len(new))[:, None]
            fresh *= np.minimum(np.array([len(w) for w in new]), 8)[:, None]
            may = self.allowed[[script_of(w) for w in new]]
            fresh = np.where(may, fresh, np.where(may.any(axis=1, keepdims=True), -50.0, 0.0))
            for w in new:
                self.rows[w] = len(self.rows)
            self.scores = np.concatenate([self.scores, fresh])
        return self.scores[[self.rows[w] for w in words]]

    def viterbi(self, scores: list[np.ndarray], penalty: float) -> list[np.ndarray]:
        """The best labelling of each text's words, all texts of the batch advanced together."""
        order = sorted(range(len(scores)), key=lambda i: -len(scores[i]))
        lengths = np.array([len(scores[i]) for i in order])
        n, width = int(lengths.max(initial=0)), len(self.languages)
        starts = np.concatenate([[0], np.cumsum(lengths)])[:-1]
        flat = np.concatenate([scores[i] for i in order]) if n else np.empty((0, width))
        stays = np.ones(flat.shape, bool)
        heads = np.zeros(len(flat), np.int16)
        value = np.zeros((len(order), width))
        for t in range(n):
            alive = int(np.searchsorted(-lengths, -t, side="left"))
            at, here = starts[:alive] + t, value[:alive]
            best = here.argmax(axis=1)
            top = here[np.arange(alive), best][:, None] - penalty
            heads[at], stays[at] = best, here >= top
            value[:alive] = np.maximum(here, top) + flat[at]
        labels = np.zeros(len(flat), np.int16)
        current = value.argmax(axis=1)
        for t in range(n - 1, -1, -1):
            alive = int(np.searchsorted(-lengths, -t, side="left"))
            at = starts[:alive] + t
            labels[at] = current[:alive]
            stay = stays[at, current[:alive]]
            current[:alive] = np.where(stay, current[:alive], heads[at])
        out: list[np.ndarray] = [labels[:0]] * len(scores)
        for k, i in enumerate(order):
            out[i] = labels[starts[k] : starts[k] + lengths[k]]
        return out


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Weight of each slot and script per language, summed per task."""
    seen: dict[str, Counter] = {}

    def rows() -> pa.RecordBatch:
        parts = []
        for lang, words in seen.items():
            if not words:
                continue
            names, counts = list(words), np.array(list(words.values()), np.float64)
            slot, owner = slots(names)
            sums = np.bincount(slot, np.sqrt(counts)[owner], SLOTS)
            scripts = np.bincount([script_of(w) for w in names], counts, OTHER + 1)
            found, used = np.flatnonzero(sums), np.flatnonzero(scripts)
            parts.append((lang, np.concatenate([found, -1 - used]), np.concatenate([sums[found], scripts[used]])))
        seen.clear()
        return pa.RecordBatch.from_pydict(
            {
                "lang": pa.array([p[0] for p in parts for _ in range(len(p[1]))], pa.string()),
                "slot": pa.array(np.concatenate([p[1] for p in parts]) if parts else [], pa.int64()),
                "n": pa.array(np.concatenate([p[2] for p in parts]) if parts else [], pa.float64()),
            }
        )

    for batch in batches:
        for raw, lang in zip(raw_texts(batch.column("text")), batch.column("lang").to_pylist(), strict=True):
            seen.setdefault(lang, Counter()).update(WORD.findall((raw or b"").decode("utf-8", "replace").lower()))
        if sum(map(len, seen.values())) > FLUSH_WORDS:
            yield rows()
    yield rows()


def fit(
    docs: DataFrame,
    *,
    train: Column | None = None,
    text_col: str = "text",
    lang_col: str = "lang",
) -> LanguageModel:
    """Learn slot weights and scripts from the texts whose language is not null.

    The model is a table of ``SLOTS`` weights per language. A word weighs the square root of its count in a
    batch of texts, so that repeated junk does not drown the rest.
    """
    rows = docs.where(train) if train is not None else docs
    rows = rows.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")).where("lang is not null")
    schema = T.StructType(
        [T.StructField("lang", T.StringType()), T.StructField("slot", T.LongType()), T.StructField("n", T.DoubleType())]
    )
    found = map_batches(rows, _count, schema).groupBy("lang", "slot").agg(F.sum("n").alias("n")).collect()
    languages = sorted({r.lang for r in found})
    counts, scripts = np.zeros((SLOTS, len(languages))), np.zeros((OTHER + 1, len(languages)))
    place = {x: i for i, x in enumerate(languages)}
    for r in found:
        if r.slot >= 0:
            counts[r.slot, place[r.lang]] = r.n
        else:
            scripts[-1 - r.slot, place[r.lang]] = r.n
    total = counts.sum(axis=0, keepdims=True)
    weights = np.log((counts + SMOOTHING) / (total + SMOOTHING * SLOTS))
    allowed = scripts / np.maximum(1.0, scripts.sum(axis=0, keepdims=True)) >= MIN_SCRIPT_SHARE
    return LanguageModel(languages, weights, allowed)


SPANS = T.ArrayType(
    T.StructType(
        [
            T.StructField("lang", T.StringType()),
            T.StructField("first_word", T.IntegerType()),
            T.StructField("n_words", T.IntegerType()),
        ]
    )
)
ARROW_SPANS = pa.list_(pa.struct([("lang", pa.string()), ("first_word", pa.int32()), ("n_words", pa.int32())]))


def identify(
    docs: DataFrame,
    model: LanguageModel,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    penalty: float = PENALTY,
    with_spans: bool = True,
) -> DataFrame:
    """(id, lang_pred, score, spans) of every whole text.

    Words are runs of letters. lang_pred is the language with most letters, the first by name among equals;
    score is its share of the letters. A null text, one without letters, and any text under a model
    without languages gets ``und`` with score 0 and no spans. Repeated rows are answered one by one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    fields = [rows.schema["id"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    if with_spans:
        fields.append(T.StructField("spans", SPANS))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = LanguageModel(shared.value.languages, shared.value.weights, shared.value.allowed)
        for batch in batches:
            words = [WORD.findall(t.decode("utf-8", "replace").lower()) if t else [] for t in raw_texts(batch.column("text"))]
            if not own.languages:
                words = [[] for _ in words]
            flat = [w for ws in words for w in ws]
            scores = own.word_scores(flat) if flat else np.empty((0, len(own.languages)))
            labels = own.viterbi(np.split(scores, np.cumsum([len(ws) for ws in words])[:-1]), penalty)
            picked, shares, spans = [], [], []
            for ws, ls in zip(words, labels, strict=True):
                if not ws:
                    picked.append(UNKNOWN)
                    shares.append(0.0)
                    spans.append([])
                    continue
                letters = np.bincount(ls, [len(w) for w in ws], len(own.languages))
                picked.append(own.languages[int(letters.argmax())])
                shares.append(float(letters.max() / letters.sum()))
                heads = np.flatnonzero(np.diff(ls, prepend=-1))
                sizes = np.diff(np.append(heads, len(ls)))
                spans.append(
                    [
                        {"lang": own.languages[ls[h]], "first_word": int(h), "n_words": int(n)}
                        for h, n in zip(heads, sizes, strict=True)
                    ]
                    if with_spans
                    else []
                )
            columns = {"id": batch.column("id"), "lang_pred": pa.array(picked, pa.string()), "score": pa.array(shares, pa.float64())}
            if with_spans:
                columns["spans"] = pa.array(spans, ARROW_SPANS)
            yield pa.RecordBatch.from_pydict(columns)

    return map_batches(rows, step, T.StructType(fields))
