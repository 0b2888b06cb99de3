"""Disguises at the edges of words, doubled letters and words of letters set apart."""

import numpy as np
import pytest

from ridewright.llm import toxicity

WORDS = "idiot stupid trash shit ass fuck you are as a an river bridge water letter the tool chapter is such see good class this"


@pytest.fixture(scope="module")
def reader():
    counts = np.zeros((28, 28, 28))
    for word in WORDS.split() * 50:
        marks = [0, 0, *map(toxicity.symbol, word), 0]
        for i in range(len(marks) - 2):
            counts[marks[i], marks[i + 1], marks[i + 2]] += 1
    lexicon = {w + "$": 3.0 for w in ("idiot", "stupid", "trash", "shit", "ass", "fuck")}
    return toxicity.Reader(toxicity.SpellingModel(counts), lexicon)


@pytest.mark.parametrize(
    "token, word",
    [("idio7", "idiot"), ("shi7", "shit"), ("a$$", "ass"), ("as$", "ass"), ("shi+", "shit"), ("shi+!", "shit"), ("fuuck", "fuck"),
     ("(a$$)", "ass"), ("1d10t!", "idiot"), ("$tupid", "stupid"), ("ass", "ass"), ("iddiot", "idiot"), ("bridg3", "bridge")],
)
def test_edges_and_doubled_letters_are_read(reader, token, word):
    assert reader.restore(token) == word
    assert (reader.features(token.encode())[3] == 3.0) == (word != "bridge")


@pytest.mark.parametrize("token", ["river!", "(river", "letter", "good", "class!", "see", "water+", "chapter1", "tool|", "as!", "a!"])
def test_plain_words_stay(reader, token):
    assert reader.restore(token) == token.strip(toxicity.EDGE)
    assert reader.features(token.encode())[3] == 0.0


@pytest.mark.parametrize("gap", [" ", "  ", "\t", "\n", " \n"])
def test_letters_set_apart_form_words(reader, gap):
    assert reader.restore(gap.join("youidiot")) == "you idiot"
    assert reader.restore(gap.join("stupididiot")) == "stupid idiot"
    assert reader.restore(gap.join("isstup1d")) == "is stupid"
    two, one = (reader.features(gap.join(t).encode()) for t in ("stupididiot", "youidiot"))
    assert one[3] == two[3] == 3.0 and two[1] > one[1]
