"""Windows of passages as they are added, and words of texts hashed without splitting."""

import random

import pyarrow as pa

from ticketloom.llm import substring_dedup, words


def _smallest(docs, at, width):
    runs = [{tuple(d[x : x + width]) for x in range(len(d) - width + 1)} for d in docs]
    return [min(k for k, r in enumerate(runs) if tuple(docs[at][x : x + width]) in r) for x in range(len(docs[at]) - width + 1)]


def test_windows_are_known_when_they_are_added():
    draw = random.Random(3)
    for _ in range(500):
        width, k = draw.randrange(1, 5), draw.choice([2, 3, 5])
        docs = [[draw.randrange(k) for _ in range(draw.randrange(14))] for _ in range(draw.randrange(1, 9))]
        automaton = substring_dedup.SuffixAutomaton()
        assert [automaton.add(d, i, width) for i, d in enumerate(docs)] == [_smallest(docs, i, width) for i in range(len(docs))]


def test_an_automaton_holds_the_passages_of_one_anchor(monkeypatch):
    """Passages of other anchors can share no window, so their words need not be in the same automaton."""
    made, real = [], substring_dedup.SuffixAutomaton
    monkeypatch.setattr(substring_dedup, "SuffixAutomaton", lambda: made.append(real()) or made[-1])
    group = pa.table({"anchor": [2, 1, 2], "print": [7, 8, 9], "at": [0, 0, 0], "doc_id": [5, 6, 4], "part": pa.array([b"a b c", b"x y", b"b c d"], pa.binary())})
    out = substring_dedup._through_automaton(2)(group)
    assert out["firsts"].to_pylist() == [[5, 4], [6], [4, 4]]
    assert max(len(a.length) for a in made) < 10 and sum(len(a.length) > 1 for a in made) == 2


def test_words_are_hashed_by_their_bytes(monkeypatch):
    draw = random.Random(5)
    for at_once in (1 << 20, 16):
        monkeypatch.setattr(words, "_AT_ONCE", at_once)
        for _ in range(200):
            texts = [bytes(draw.choice(b"ab \n\t\x0b\x85\x00") for _ in range(draw.randrange(60))) for _ in range(draw.randrange(6))]
            sizes, joined, begins, ends, hashes = words.hashed_words(texts)
            split = [x for t in texts for x in t.split()]
            assert sizes == [len(t.split()) for t in texts]
            assert [joined[a:z] for a, z in zip(begins, ends, strict=True)] == split
            known = dict(zip(split, hashes.tolist(), strict=True))
            assert [known[w] for w in split] == hashes.tolist() and len(set(known.values())) == len(known)
