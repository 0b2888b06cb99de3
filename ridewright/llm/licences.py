"""Licence scan by a generalised suffix automaton over the words of licence notices.

A text is read word by word. For every notice, the longest run of words that ends here and occurs in it follows
from the state of the automaton and its suffix links. Runs of at least ``LEAST`` words that cannot be continued
are the long matches; those of one notice, in the order of both text and notice and with gaps of at most ``GAP``
words, are chained so that they cover most of the notice. A chain that covers ``SHARE`` of its notice, or
``WORDS`` of its words, is a span with the notice's label. Phrases that name a licence by themselves are found in
the same pass at every place where they stand.

Null and empty texts have no words, spans or labels. Repeated rows and ids are answered one by one; other columns
are not looked at. Of chains that cover equally many words the one that ends first goes first. A very long text is
held whole by one task; the work grows with its length, since a match looks back no further than its gap.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridewright.llm.common import map_batches, raw_texts, words_of
from ridewright.llm.licence_texts import NOTICES, PHRASES

LEAST = 3
GAP = 12
SHARE = 0.8
WORDS = 40

Match = tuple[int, int, int]  # last word in the text, last word in the notice, words


class Automaton:
    """All runs of words of several sequences: a state for each set of places where runs end alike."""

    def __init__(self, sequences: Sequence[Sequence[bytes]]):
        self.steps: list[dict[bytes, int]] = [{}]
        self.link: list[int] = [-1]
        self.longest: list[int] = [0]
        self.ends: list[set[tuple[int, int]]] = [set()]
        for n, words in enumerate(sequences):
            last = 0
            for at, word in enumerate(words):
                last = self._append(last, word)
                self.ends[last].add((n, at))
        for state in sorted(range(1, len(self.link)), key=lambda s: -self.longest[s]):
            self.ends[self.link[state]] |= self.ends[state]
        self.vocabulary = frozenset(w for words in sequences for w in words)

    def _state(self, longest: int, steps: dict[bytes, int], link: int) -> int:
        self.steps.append(steps)
        self.link.append(link)
        self.longest.append(longest)
        self.ends.append(set())
        return len(self.link) - 1

    def _split(self, before: int, word: bytes) -> int:
        """The state reached from ``before`` by ``word``, holding nothing longer than that."""
        there = self.steps[before][word]
        if self.longest[there] == self.longest[before] + 1:
            return there
        part = self._state(self.longest[before] + 1, dict(self.steps[there]), self.link[there])
        self.link[there] = part
        while before >= 0 and self.steps[before].get(word) == there:
            self.steps[before][word] = part
            before = self.link[before]
        return part

    def _append(self, last: int, word: bytes) -> int:
        if word in self.steps[last]:
            return self._split(last, word)
        new = self._state(self.longest[last] + 1, {}, 0)
        while last >= 0 and word not in self.steps[last]:
            self.steps[last][word] = new
            last = self.link[last]
        if last >= 0:
            self.link[new] = self._split(last, word)
        return new

    def suffixes(self, state: int) -> Iterator[int]:
        """The state and those of its shorter runs, down to single words."""
        while state > 0:
            yield state
            state = self.link[state]

    def advance(self, state: int, length: int, word: bytes) -> tuple[int, int]:
        """The longest run that ends with ``word``, from the longest one before it."""
        while word not in self.steps[state]:
            state = self.link[state]
            if state < 0:
                return 0, 0
            length = self.longest[state]
        return self.steps[state][word], length + 1


@dataclass
class Scanner:
    """The automaton of notices and phrases, with what each of its states tells."""

    notices: Sequence[tuple[str, str]] = field(default_factory=lambda: NOTICES)
    phrases: Sequence[tuple[str, str]] = field(default_factory=lambda: PHRASES)
    least: int = LEAST
    gap: int = GAP

    def __post_init__(self) -> None:
        self.words = [words_of(text.encode()) for _, text in [*self.notices, *self.phrases]]
        self.automaton = Automaton(self.words)
        first_phrase = len(self.notices)
        self.phrases_at: list[tuple[tuple[int, int], ...]] = []
        self.notices_at: list[dict[int, tuple[int, list[int]]]] = []
        for state in range(len(self.automaton.link)):
            named, matched = [], {}
            for shorter in self.automaton.suffixes(state):
                longest = self.automaton.longest[shorter]
                for n, at in sorted(self.automaton.ends[shorter]):
                    if n >= first_phrase:
                        size = len(self.words[n])
                        if at == size - 1 and self.automaton.longest[self.automaton.link[shorter]] < size <= longest:
                            named.append((n - first_phrase, size))
                    elif longest >= self.least and matched.get(n, (longest,))[0] == longest:
                        matched.setdefault(n, (longest, []))[1].append(at)
            self.phrases_at.append(tuple(named))
            self.notices_at.append(matched)

    def read(self, words: list[bytes]) -> tuple[list[tuple[int, int]], dict[int, list[Match]]]:
        """(phrase, first word) of every place of a phrase, and the long matches of each notice."""
        known = self.automaton.vocabulary
        named: list[tuple[int, int]] = []
        matches: dict[int, list[Match]] = {}
        before: dict[int, tuple[int, list[int]]] = {}
        state = length = 0

        def ended(at: int, now: dict[int, tuple[int, list[int]]]) -> None:
            for n, (size, places) in before.items():
                if n not in now or now[n][0] != size + 1:
                    matches.setdefault(n, []).extend((at, place, size) for place in places)

        for at, word in enumerate(words):
            if word not in known:
                if before:
                    ended(at - 1, {})
                    before = {}
                state = length = 0
                continue
            state, length = self.automaton.advance(state, length, word)
            for phrase, size in self.phrases_at[state]:
                if size <= length:
                    named.append((phrase, at - size + 1))
            if length >= self.least or before:
                now = {n: (min(size, length), places) for n, (size, places) in self.notices_at[state].items() if min(size, length) >= self.least}
                ended(at - 1, now)
                before = now
        ended(len(words) - 1, {})
        return named, matches

    def chains(self, matches: list[Match]) -> list[tuple[int, int, int]]:
        """(first word, last word, words covered) of disjoint chains, the one that covers most first."""
        covered: list[int] = []
        prior: list[int] = []
        for k, (end, place, size) in enumerate(matches):
            best, link = size, -1
            for j in range(k - 1, -1, -1):
                end_j, place_j, _ = matches[j]
                if end_j < end - size - self.gap:
                    break
                if end_j < end and place - size - self.gap <= place_j < place:
                    total = covered[j] + min(size, end - end_j, place - place_j)
                    if total > best:
                        best, link = total, j
            covered.append(best)
            prior.append(link)
        used = [False] * len(matches)
        found = []
        for k in sorted(range(len(matches)), key=lambda k: -covered[k]):
            if used[k]:
                continue
            j = k
            while True:
                used[j] = True
                if prior[j] < 0 or used[prior[j]]:
                    break
                j = prior[j]
            cut = covered[prior[j]] if prior[j] >= 0 else 0
            end, _, size = matches[j]
            begin = max(end - size + 1, matches[prior[j]][0] + 1 if prior[j] >= 0 else 0)
            found.append((begin, matches[k][0], covered[k] - cut))
        return found

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], list[tuple[int, int, int, int]], float]:
        """Places of phrases, (notice, first word, last word, words covered) of all chains, and the greatest share."""
        named, matches = self.read(words)
        chains = [(n, *c) for n, ms in matches.items() for c in self.chains(ms)]
        best = max((c[3] / len(self.words[c[0]]) for c in chains), default=0.0)
        return named, sorted(chains, key=lambda c: (c[1], c[0], c[2])), 1.0 if named else best


PHRASE = T.StructType([T.StructField("label", T.StringType()), T.StructField("start", T.LongType())])
SPAN = T.StructType(
    [
        T.StructField("label", T.StringType()),
        T.StructField("notice", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType()),
        T.StructField("covered", T.LongType()),
        T.StructField("share", T.DoubleType()),
    ]
)
ARROW_PHRASE = pa.struct([("label", pa.string()), ("start", pa.int64())])
ARROW_SPAN = pa.struct(
    [("label", pa.string()), ("notice", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("covered", pa.int64()), ("share", pa.float64())]
)


def licences(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    notices: Sequence[tuple[str, str]] = NOTICES,
    phrases: Sequence[tuple[str, str]] = PHRASES,
    share: float = SHARE,
    least_words: int = WORDS,
) -> DataFrame:
    """(id, n_words, phrases, spans, score) of every whole text.

    ``phrases``: label and first word of every place; ``spans``: the covered stretches with their notice, ends
    inclusive, by first word. ``score`` is the greatest covered share of a notice, 1 where a phrase stands.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = T.StructType(
        [
            rows.schema["id"],
            T.StructField("n_words", T.LongType()),
            T.StructField("phrases", T.ArrayType(PHRASE)),
            T.StructField("spans", T.ArrayType(SPAN)),
            T.StructField("score", T.DoubleType()),
        ]
    )

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(notices, phrases)

        def spans(chains: list[tuple[int, int, int, int]]) -> Iterator[dict]:
            for n, start, end, covered in chains:
                part = covered / len(scanner.words[n])
                if part >= share or covered >= least_words:
                    yield {"label": notices[n][0], "notice": n, "start": start, "end": end, "covered": covered, "share": part}

        for batch in batches:
            sizes, named, covered, scores = [], [], [], []
            for raw in raw_texts(batch.column("text")):
                words = words_of(raw)
                places, chains, score = scanner.scan(words)
                sizes.append(len(words))
                named.append([{"label": phrases[p][0], "start": at} for p, at in places])
                covered.append(list(spans(chains)))
                scores.append(score)
            columns = [
                batch.column("id"),
                pa.array(sizes, pa.int64()),
                pa.array(named, pa.list_(ARROW_PHRASE)),
                pa.array(covered, pa.list_(ARROW_SPAN)),
                pa.array(scores, pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return map_batches(rows, step, schema)
