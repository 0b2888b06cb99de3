"""Toxicity by noisy-channel deobfuscation.

A token that looks disguised (a look-alike sign next to a letter on either side, separators inside a word,
letters repeated, single letters set apart by any white space) becomes a lattice of what each sign may
stand for; signs at its edges may also be dropped, and letters set apart may form several words. A Viterbi
search under a character trigram model finds the likeliest spellings, of which one with evidence goes
first. Edge signs alone change a token only if they become letters, and a letter doubled only if that gives
more evidence. The words of the restored text are then scored with learned evidence, and a logistic curve turns a document's
evidence into a probability.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridewright.llm.common import map_batches, raw_texts, stored

MIN_SUPPORT = 5
MIN_G2 = 25.0
MAX_LEXICON = 50_000
STEMS = (3, 5, 7)
CACHE_TOKENS = 300_000
FLUSH_KEYS = 500_000
N_FEATURES = 5
UNITS = float(1 << 32)

# The letters that a sign may stand for.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¡": "i",
}
SEPARATORS = ".-_*~,'`^​­"
EDGE = ".,;:!?\"'()[]{}<>|*#$%&~-_/\\=+`^"
LEAD = 4  # signs before a word that are read one by one; of longer rows all are read or these
SIGN_COST, DROP_COST, REPEAT_COST = -0.7, -0.3, -0.5

SUSPECT = re.compile(
    r"[^\W\d_][\d@$!|+(<€£¡.\-_*~,'`^​­]+[^\W_]|[\d@$!|+(<€£¡][^\W\d_]|([^\W\d_])\1\1"
)
SIGN = "[" + re.escape("".join(LOOKALIKES)) + "]"
WEAK = re.compile(rf"[^\W\d_]{SIGN}|{SIGN}[^\W\d_]")
DOUBLED = re.compile(r"([^\W\d_])\1")
REPEATED = re.compile(r"(.)\1+")
TRIPLED = re.compile(r"([^\W\d_])\1\1")
QUIET = "".join(c for c in EDGE if c not in LOOKALIKES)
EDGES = EDGE + "".join(LOOKALIKES)
APART = rf"(?:[^\W_]|{SIGN})"
SPACED = re.compile(rf"(?<!\S){APART}\s+(?:{APART}\s+){{2,}}{APART}(?!\S)")


def symbol(c: str) -> int:
    """Letters a-z are 1..26, any other letter 27; 0 is the border of a word."""
    return ord(c) - 96 if "a" <= c <= "z" else 27


class SpellingModel:
    """Character trigrams over words, smoothed by add-0.1 and a share of the bigrams."""

    def __init__(self, counts: np.ndarray):
        bigrams = counts.sum(axis=0)
        low = (bigrams + 0.1) / (bigrams.sum(axis=1, keepdims=True) + 2.8)
        high = (counts + 2 * low[None]) / (counts.sum(axis=2, keepdims=True) + 2)
        self.logp = np.log(high).tolist()

    def spellings(self, token: str, borders: bool = False) -> list[tuple[float, str]]:
        """The likeliest spelling under the channel for each pair of last letters.

        Signs behind the last letter may be dropped; with ``borders`` words may end inside.
        """
        groups = [(m.group(0)[0], len(m.group(0))) for m in re.finditer(r"(.)\1*", token, re.S)]
        beams: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
        logp = self.logp
        tail = max((i for i, (c, _) in enumerate(groups) if c.isalpha()), default=len(groups))
        for at, (c, run) in enumerate(groups):
            options: list[tuple[str, float]] = []
            letters = LOOKALIKES.get(c, "")
            if c.isalpha():
                options += [(c, 0.0 if run == 1 else REPEAT_COST), (c + c, 0.0 if run == 2 else REPEAT_COST)][: 1 + (run > 1)]
            for x in letters:
                options += [(x, SIGN_COST), (x + x, SIGN_COST)][: 1 + (run > 1)]
            if c in SEPARATORS or not options or at > tail:
                options.append(("", DROP_COST))
            if borders:
                options += [(x[0] + " " + x[1], cost) for x, cost in options if len(x) == 2]
                options += [(x + " ", cost) for x, cost in options if x]
            fresh: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for (a, b), (score, text) in beams.items():
                for piece, cost in options:
                    total, p, q = score + cost, a, b
                    for x in piece:
                        s = 0 if x == " " else symbol(x)
                        total += logp[p][q][s]
                        p, q = (q, s) if s else (0, 0)
                    old = fresh.get((p, q))
                    if old is None or total > old[0]:
                        fresh[p, q] = (total, (text, piece))
            beams = fresh
        found = []
        for (a, b), (score, text) in beams.items():
            pieces = []
            while text is not None:
                text, piece = text
                pieces.append(piece)
            ended = borders and (a, b) == (0, 0)
            found.append((score if ended else score + logp[a][b][0], "".join(reversed(pieces)).strip()))
        return found

    def decode(self, token: str, borders: bool = False) -> str:
        """The likeliest spelling of a token under the channel."""
        return max(self.spellings(token, borders))[1]


def thinned(word: str) -> str:
    """A word with every letter repeated in a row written once."""
    return REPEATED.sub(r"\1", word)


@dataclass
class Reader:
    """Restores texts and sums evidence; keeps a bounded cache of tokens."""

    spelling: SpellingModel
    lexicon: dict[str, float]
    seen: dict[str, str] = field(default_factory=dict)
    weighed: set[str] = field(default_factory=set)
    worth: dict[str, tuple[str, float]] = field(default_factory=dict)  # of the weighed tokens with evidence

    def __post_init__(self) -> None:
        self.thin = {thinned(w.rstrip("$")) for w in self.lexicon}
        self.longest = max(map(len, self.thin), default=0)
        self.starts = {w[:3] for w in self.thin}
        self.heads = {w.rstrip("$")[:3] for w in self.lexicon}

    def plain(self, token: str) -> str:
        """A token without edge signs, restored where it looks disguised."""
        found = self.seen.get(token)
        if found is None:
            found, core = token.strip(EDGE), token.strip(QUIET)
            if core.isalpha():
                # letters alone are suspect only where one stands three times
                if DOUBLED.search(core) and TRIPLED.search(core):
                    found = self.likeliest(core)
            elif SUSPECT.search(found) or SUSPECT.search(token.rstrip(".,;:?\"')")):
                found = self.likeliest(core)
            elif WEAK.search(core):
                word = self.likeliest(core)
                dropped = thinned(word) == thinned(core.strip(EDGES))
                if not dropped or self.evidence(word) > self.evidence(found):
                    found = word
            if DOUBLED.search(found) and self.may_be_thinned(found):
                word = self.spelling.decode(found)
                if self.evidence(word) > self.evidence(found):
                    found = word
            if len(self.seen) >= CACHE_TOKENS:
                self.seen.clear()
            self.seen[token] = found
        return found

    def likeliest(self, core: str) -> str:
        """The spelling with most evidence, then the likeliest by letter, with edge signs read or dropped."""
        lead = len(core) - len(core.lstrip(EDGES))
        forms = {core, *(core[i:] for i in range(max(0, lead - LEAD), lead + 1))} - {""}
        spelled = [(score / (len(word) + 1), word) for form in forms for score, word in self.spelling.spellings(form)]
        return max((self.lexicon.get(word + "$", 0.0), score, word) for score, word in spelled)[2]

    def may_be_thinned(self, word: str) -> bool:
        thin = thinned(word)
        if thin[:3] not in self.starts and thin[:2] not in self.starts and thin[:1] not in self.starts:
            return False
        return any(thin[:n] in self.thin for n in range(1, min(len(thin), self.longest) + 1))

    def apart(self, letters: str) -> str:
        """The words that letters set apart spell."""
        return self.spelling.decode(re.sub(r"\s+", "", letters), borders=True)

    def restore(self, text: str) -> str:
        """The text in lower case with single spaces, disguised words spelled out."""
        text = SPACED.sub(lambda m: self.apart(m.group(0)), text.lower())
        return " ".join(self.plain(t) for t in text.split())

    def evidence(self, word: str) -> float:
        if word[:3] not in self.heads:
            return 0.0
        get = self.lexicon.get
        best = get(word + "$", 0.0)
        for n in STEMS:
            if len(word) < n:
                break
            best = max(best, get(word[:n], 0.0))
        return best

    def weigh(self, tokens: set[str]) -> None:
        """Keep the restored words of new tokens that have evidence."""
        if len(self.weighed) >= CACHE_TOKENS:
            self.weighed.clear()
            self.worth.clear()
        heads = self.heads
        for token in tokens - self.weighed:
            core = token.strip(QUIET)
            if core[:3] not in heads and core.isalpha():
                if not DOUBLED.search(core) or not TRIPLED.search(core) and not self.may_be_thinned(core):
                    continue  # letters alone that stand as they are, without evidence
            word = self.plain(token)
            value = self.evidence(word)
            if value:
                self.worth[token] = (word, value)
        self.weighed |= tokens

    def features(self, raw: bytes | None) -> tuple[float, ...]:
        """Evidence of the distinct words of the restored whole text."""
        text = raw.decode("utf-8", "replace").lower() if raw else ""
        tokens, words = set(text.split()), {}
        self.weigh(tokens)
        for token in tokens & self.worth.keys():
            word, value = self.worth[token]
            words[word] = value
        for m in SPACED.finditer(text):
            for word in self.apart(m.group(0)).split():
                words[word] = max(words.get(word, 0.0), self.evidence(word))
            joined = self.spelling.decode(re.sub(r"\s+", "", m.group(0)))
            words.setdefault(joined, max(self.evidence(w) for w in (joined, joined[1:], joined[:-1])))
        total = math.fsum(words.values())
        return (
            1.0,
            math.log1p(total),
            total / math.sqrt(len(tokens) + 4),
            max(words.values(), default=0.0),
            math.log1p(len(tokens)),
        )


@dataclass
class Toxicity:
    trigrams: np.ndarray
    lexicon: dict[str, float]
    weights: np.ndarray

    def reader(self) -> Reader:
        return Reader(SpellingModel(self.trigrams), self.lexicon)

    def score(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(features @ self.weights, -40, 40)))


class _Forms(dict):
    """The word and the stems that a raw token counts for."""

    def __missing__(self, token: str) -> tuple[str, ...]:
        if len(self) >= CACHE_TOKENS:
            self.clear()
        word = token.strip(EDGE)
        found = self[token] = (word + "$", *(word[:n] for n in STEMS if len(word) >= n))
        return found


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents per stem and class, and letter trigrams of the words, summed per task."""
    found: tuple[Counter, Counter] = (Counter(), Counter())
    spelled: Counter = Counter()
    forms = _Forms()

    def rows() -> pa.RecordBatch:
        keys = list(found[0].keys() | found[1].keys())
        words: Counter = Counter()
        for token, n in spelled.items():
            word = token.strip(EDGE)
            if word.isalpha():
                words[word] += n
        grams: Counter = Counter()
        for word, n in words.items():
            marks = [0, 0, *map(symbol, word), 0]
            for i in range(len(marks) - 2):
                grams[f"\t{marks[i] * 784 + marks[i + 1] * 28 + marks[i + 2]}"] += n
        names = keys + list(grams)
        clean = [found[0][k] for k in keys] + list(grams.values())
        toxic = [found[1][k] for k in keys] + [0] * len(grams)
        for c in (*found, spelled):
            c.clear()
        return pa.RecordBatch.from_pydict(
            {"key": pa.array(names, pa.string()), "clean": pa.array(clean, pa.int64()), "toxic": pa.array(toxic, pa.int64())}
        )

    for batch in batches:
        for raw, label in zip(raw_texts(batch.column("text")), batch.column("y").to_pylist(), strict=True):
            tokens = (raw or b"").decode("utf-8", "replace").lower().split()
            found[label].update(set().union(*map(forms.__getitem__, set(tokens))))
            found[label]["\tdocuments"] += 1
            spelled.update(tokens)
        if len(found[0]) + len(found[1]) + len(spelled) > FLUSH_KEYS:
            yield rows()
    yield rows()


def _evidence(counts: DataFrame, min_support: int, min_g2: float, max_lexicon: int) -> dict[str, float]:
    """Log odds of the stems that toxic documents hold significantly more often."""
    totals = counts.where(F.col("key") == "\tdocuments").first()
    if totals is None or not totals.toxic or not totals.clean:
        return {}
    a, b = F.col("toxic").cast("double"), F.col("clean").cast("double")
    n1, n0 = float(totals.toxic), float(totals.clean)
    share = (a + b) / (n1 + n0)
    part = lambda k, n, p: F.when(k > 0, k * F.log(k / (n * p))).otherwise(0.0)
    g2 = 2 * (part(a, n1, share) + part(b, n0, share) + part(n1 - a, n1, 1 - share) + part(n0 - b, n0, 1 - share))
    odds = F.log((a + 0.5) / (n1 + 1)) - F.log((b + 0.5) / (n0 + 1))
    rows = (
        counts.where(~F.col("key").startswith("\t") & (a >= min_support))
        .select("key", odds.alias("w"), g2.alias("g2"))
        .where((F.col("g2") >= min_g2) & (F.col("w") > 0))
        .orderBy(F.desc("g2"), "key")
        .limit(max_lexicon)
        .collect()
    )
    return {r.key: r.w for r in rows}


def _moments(w: np.ndarray):
    """Gradient and curvature sums of the rows (y, x) of a task in whole units of 1 / UNITS: exact in any order."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(N_FEATURES + N_FEATURES * N_FEATURES, np.int64)
        for batch in batches:
            x = np.array(batch.column("x").to_pylist(), np.float64).reshape(-1, N_FEATURES)
            y = batch.column("y").to_numpy(zero_copy_only=False)
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            curved = (x[:, :, None] * x[:, None, :]).reshape(len(x), -1) * (p * (1 - p))[:, None]
            terms = np.concatenate([x * (y - p)[:, None], curved], axis=1)
            sums += np.rint(terms * UNITS).astype(np.int64).sum(axis=0)
        yield pa.RecordBatch.from_pydict({"sums": pa.array([sums.tolist()], pa.list_(pa.int64()))})

    return step


def logistic(seen: DataFrame, ridge: float = 1e-2, steps: int = 30) -> np.ndarray:
    """Newton's method for a ridge-penalised logistic curve over all rows (y, x) of a stored table.

    Every step is one pass that sends a row of sums per task to the driver.
    """
    w, schema = np.zeros(N_FEATURES), T.StructType([T.StructField("sums", T.ArrayType(T.LongType()))])
    for _ in range(steps):
        parts = [r.sums for r in map_batches(seen, _moments(w), schema).collect()]
        if not parts:
            break
        total = np.array([sum(column) / UNITS for column in zip(*parts, strict=True)])
        hessian = total[N_FEATURES:].reshape(N_FEATURES, N_FEATURES) + ridge * np.eye(N_FEATURES)
        step = np.linalg.solve(hessian, total[:N_FEATURES] - ridge * w)
        w += step
        if np.abs(step).max() < 1e-7:
            break
    return w


def labelled(
    rows: DataFrame, labels: DataFrame, *, train: Column | None = None, id_col: str = "doc_id", label_col: str = "toxic"
) -> DataFrame:
    """Rows (id, ...) with the label y of all labels that teach.

    Null ids and labels other than 0 and 1 teach nothing; equal ids count each. Labels grow with the
    documents, so they are never broadcast.
    """
    chosen = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
    chosen = chosen.where(train) if train is not None else chosen
    chosen = chosen.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
    return rows.join(chosen.hint("merge"), "id")


def texts_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))


def fit_evidence(
    rows: DataFrame, *, min_support: int = MIN_SUPPORT, min_g2: float = MIN_G2, max_lexicon: int = MAX_LEXICON
) -> Toxicity:
    """Spelling and evidence from all rows (text, y), without the curve; counts are summed by task and by Spark."""
    schema = T.StructType([T.StructField("key", T.StringType()), *(T.StructField(c, T.LongType()) for c in ("clean", "toxic"))])
    counts = map_batches(rows.select("text", "y"), _count, schema).groupBy("key").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")
    )
    counts = stored(counts.where((F.col("toxic") >= min_support) | F.col("key").startswith("\t")), "evidence")
    trigrams = np.zeros(28 * 28 * 28)
    for r in counts.where(F.col("key").rlike("^\t[0-9]+$")).collect():
        trigrams[int(r.key[1:])] = r.clean
    return Toxicity(trigrams.reshape(28, 28, 28), _evidence(counts, min_support, min_g2, max_lexicon), np.zeros(N_FEATURES))


def fit_curve(model: Toxicity, seen: DataFrame) -> Toxicity:
    """The model with the curve learned from all rows (y, x)."""
    return Toxicity(model.trigrams, model.lexicon, logistic(stored(seen.select("y", "x"), "labelled")))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    train: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    **options,
) -> Toxicity:
    """Learn spelling, evidence and the logistic curve from all labelled rows.

    Without both classes every document scores by the prior alone.
    """
    rows = labelled(texts_of(docs, id_col, text_col), labels, train=train, id_col=id_col, label_col=label_col)
    rows = stored(rows, "labelled-texts")
    model = fit_evidence(rows, **options)
    return fit_curve(model, _features(rows, model))


def document_features(docs: DataFrame, model: Toxicity, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, x): the features of every whole text, written once to the shared folder."""
    return stored(_features(texts_of(docs, id_col, text_col), model), "features")


def score_features(features: DataFrame, model: Toxicity) -> DataFrame:
    """(id, score) for rows of :func:`document_features`."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column("x").to_pylist(), np.float64).reshape(-1, N_FEATURES)
            yield pa.RecordBatch.from_pydict({"id": batch.column("id"), "score": pa.array(model.score(x))})

    return map_batches(features, step, T.StructType([features.schema["id"], T.StructField("score", T.DoubleType())]))


def _features(rows: DataFrame, model: Toxicity) -> DataFrame:
    """Replace the column text by x, the features of the restored text."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = model.reader()
        for batch in batches:
            x = [reader.features(t) for t in raw_texts(batch.column("text"))]
            keep = {c: batch.column(c) for c in batch.schema.names if c != "text"}
            yield pa.RecordBatch.from_pydict({**keep, "x": pa.array(x, pa.list_(pa.float64()))})

    kept = [f for f in rows.schema.fields if f.name != "text"]
    return map_batches(rows, step, T.StructType([*kept, T.StructField("x", T.ArrayType(T.DoubleType()))]))


def score(docs: DataFrame, model: Toxicity, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every whole text; null and empty texts score by the prior and their lack of words."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = model.reader()
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"id": batch.column("id"), "score": pa.array(_scores(reader, model, batch, "text"))})

    rows = texts_of(docs, id_col, text_col)
    return map_batches(rows, step, T.StructType([rows.schema["id"], T.StructField("score", T.DoubleType())]))


def _scores(reader: Reader, model: Toxicity, batch: pa.RecordBatch, name: str) -> np.ndarray:
    x = [reader.features(t) for t in raw_texts(batch.column(name))]
    return model.score(np.array(x, np.float64).reshape(-1, N_FEATURES))


def keep_clean(docs: DataFrame, model: Toxicity, *, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows, all columns unchanged, whose text scores below ``threshold``."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = model.reader()
        for batch in batches:
            yield batch.filter(pa.array(_scores(reader, model, batch, text_col) < threshold))

    return map_batches(docs, step, docs.schema)


def restore(docs: DataFrame, model: Toxicity, *, text_col: str = "text", out: str = "restored") -> DataFrame:
    """Every row with the restored text beside it; null stays null, an equally named column is replaced."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = model.reader()
        for batch in batches:
            texts = [None if t is None else reader.restore(t) for t in batch.column(text_col).to_pylist()]
            keep = {c: batch.column(c) for c in batch.schema.names}
            yield pa.RecordBatch.from_pydict({**keep, out: pa.array(texts, pa.string())})

    base = docs.drop(out)
    return map_batches(base, step, T.StructType([*base.schema.fields, T.StructField(out, T.StringType())]))
