"""op5 reads tokens of letters that stand as they are without a search for spellings, to the same evidence."""

import numpy as np
import pytest

from ridewright.llm import toxicity

LEXICON = {"grolk$": 2.0, "fna": 1.0, "o$": 0.5, "zappo$": 1.5}


def reader():
    return toxicity.Toxicity(np.ones((28, 28, 28)), LEXICON, np.zeros(toxicity.N_FEATURES)).reader()


def test_plain_tokens_without_evidence_are_not_restored(monkeypatch):
    read, restored = reader(), []
    monkeypatch.setattr(read, "plain", lambda t: restored.append(t) or t)
    read.weigh({"the", "river,", "letter", "grolk", "gr0lk", "zapppo"})
    assert set(restored) == {"grolk", "gr0lk", "zapppo"}


@pytest.mark.parametrize("token", ["the", "grolk", '"grolk,', "fnatic", "fnaa", "zappo", "zapo", "oo", "o", "gr0lk", "letter", "ß.", "été", "...", "!o!"])
def test_weights_are_those_of_the_restored_token(token):
    read, other = reader(), reader()
    read.weigh({token})
    word = other.plain(token)
    value = other.evidence(word)
    assert read.worth.get(token) == ((word, value) if value else None)


def test_words_that_thin_to_a_start_of_evidence_are_found():
    read = reader()
    for word in ("grollk", "ffna", "zapo", "zappo", "letter", "oo", "b", "", "gg"):
        thin = toxicity.thinned(word)
        assert read.may_be_thinned(word) == any(thin[:n] in read.thin for n in range(1, len(thin) + 1))
