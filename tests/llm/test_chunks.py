"""Each distinct chunk is spelled once, and ids are those of plain library calls."""

from array import array

import pytest

from ticketloom.llm.tokens import Encoder, vocabulary

TEXTS = ["Une maison, une maison. Une maison", "", "été 2024: one\ntwo one", " lead", "two  spaces", "x", "a\n\nb a's 12,5 ... été,", "Σίσυφος ἀρχή один один"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_chunks_are_numbered_and_spelled_once(monkeypatch, name):
    asked, real = [], Encoder._one
    monkeypatch.setattr(Encoder, "_one", lambda self, piece: asked.append(piece) or real(self, piece))
    coder = Encoder(vocabulary(name))
    want = [array("I", coder.tokenizer.encode(t, add_special_tokens=False).ids).tobytes() for t in TEXTS]
    assert coder.ids(TEXTS) == want
    assert len(asked) == len(set(asked)) > 0
    before = len(asked)
    monkeypatch.setattr(Encoder, "LIMIT", 0)  # generations change and keep what is asked for
    assert coder.ids(TEXTS) == want and coder.ids(TEXTS[::-1]) == want[::-1] and len(asked) == before
    assert coder.ids([]) == []


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_words_are_spelled_together(monkeypatch, name):
    """Not one call of the library for each; marks of the vocabularies in a text are told apart."""
    text = " ".join(f"w{'abcdefghij'[i % 10]}{'ßéüÀø'[i % 5] if i % 3 else 'Q'}{'xyz' * (i % 7)}, v\n{'Ab' * (i % 11 + 1)}" for i in range(1000)) + " Ā Ġ Āb Ġe a\0b \0 ÷x </w> o</w>"
    monkeypatch.setattr(Encoder, "_word", None)
    coder = Encoder(vocabulary(name))
    assert coder.ids([text, text[:50]]) == [array("I", coder.tokenizer.encode(t, add_special_tokens=False).ids).tobytes() for t in (text, text[:50])]
