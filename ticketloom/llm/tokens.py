"""Token ids of whole texts with the tokenizers library, spelling each distinct piece once.

Both vocabularies merge only inside pre-tokens, and a pre-token never reaches over a chunk border
as cut here, so ids of a text are the ids of its chunks in order; a chunk of letters and other
characters is cut further into its pre-tokens. Pieces repeat, so a worker remembers them, up to a
bound, in two generations: what is not asked for while the younger one fills is forgotten. Texts in
which a cut could change pre-tokens, or that may hold a special token, are encoded whole.

``special_as_text``: the library by default turns the string of a special token in a text into that
token's id. With this flag such a string is ordinary text.
"""

from __future__ import annotations

import gc
import os
import re
import sys
import unicodedata
from array import array

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex

from ticketloom.llm.words import REMEMBERED, only

assert sys.byteorder == "little" and array("I").itemsize == 4
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

_OTHER_SPACE = re.compile(r"[\x1c-\x1f\x85\xa0  -     　]")
_PIECE = regex.compile(r"\p{L}+|\p{N}+|\n|[^\s\p{L}\p{N}]+")
#: Chunks with these are left whole: contractions, marks that compose with a letter, letters whose
#: lower case depends on what follows or is no letter, two line ends in a row, any other white space.
_UNCUT = regex.compile(r"['\p{M}İΣ]|\n\n|^\n|\n$|[^\S\n]")
#: Most chunks: ASCII without apostrophes, lines apart by single line ends.
_PLAIN = re.compile(r"[!-&(-~]+(?:\n[!-&(-~]+)*")
_PLAIN_PIECE = re.compile(r"[A-Za-z]+|[0-9]+|\n|[!-/:-@\[-`{-~]+")
_STOPS = (".", ",", "!", "?", ";", ":")
_DIGIT = regex.compile(r"\p{N}|\s")
_INNER_SPACE = regex.compile(r"^\s+$|\S\s")


def byte_level_text(text: str) -> str | None:
    """A text whose chunks are what stands between spaces; each but the first goes with the space before it. A
    run of white space goes into pre-tokens as (all but the last) + (the last), so a cut inside a longer run, or
    at the end of the text, would be wrong: None then."""
    if "  " in text or "\n " in text or text.endswith(" ") or "\t" in text or "\r" in text or "\x0b" in text or "\x0c" in text:
        return None
    if not text.isascii() and _OTHER_SPACE.search(text) or text.isascii() and ("\x1c" in text or "\x1d" in text or "\x1e" in text or "\x1f" in text):
        return None
    return text


def spaced_text(text: str) -> str:
    """For vocabularies that drop white space: chunks stand between spaces and line ends."""
    return text.replace("\n", " ")


def pieces(chunk: str) -> list[str]:
    """The pre-tokens of a chunk in both vocabularies, or the chunk itself where that is not sure: a vocabulary
    that normalises first may take letters apart, and their marks go with what follows."""
    if chunk.isascii():
        if _PLAIN.fullmatch(chunk):
            return _PLAIN_PIECE.findall(chunk)
    elif not unicodedata.is_normalized("NFC", chunk):
        return [chunk]
    if chunk[-1:] in _STOPS and (word := chunk[:-1]).isalpha() and "İ" not in word and "Σ" not in word:
        return [word, chunk[-1]]
    return [chunk] if _UNCUT.search(chunk) else _PIECE.findall(chunk) or [chunk]


def _byte_letters() -> dict[int, int]:
    """Byte-level vocabularies write each byte as a character: printable ones of Latin-1 as themselves, the
    others as the characters from 256 on, in order."""
    others = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174)]
    return {b: 256 + k for k, b in enumerate(others)}


_BYTE_LETTERS = _byte_letters()

#: vocabulary file: (how texts are cut, what precedes each chunk but the first, what can stand
#: between pieces that are spelled in one call, pieces for which it cannot, are letters made small)
CHUNKS = {
    "byte_bpe_50k.json": (byte_level_text, " ", "\n", _INNER_SPACE, False),
    "word_bpe_49k.json": (spaced_text, "", " 0 ", _DIGIT, True),
}


class Encoder:
    """ids of texts as little-endian unsigned 32-bit bytes."""

    #: Pieces of one generation; two are remembered. Pieces spelled in one call of the library.
    LIMIT, JOINED = 200_000, 400
    #: Words spelled in one call; longer strings take the library longer.
    WORDS = 100
    #: Characters of texts that are cut at a time.
    AT_ONCE = 3 << 20

    def __init__(self, path: str, special_as_text: bool = False):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        self.chunks, self.lead, self.between, self.apart, self.small = CHUNKS.get(os.path.basename(path), (lambda text: None, "", "", None, False))
        self.model = self.tokenizer.model
        self.marks = [] if special_as_text else sorted({t.content for t in self.tokenizer.get_added_tokens_decoder().values()})
        self.begins = sorted({m[:2] for m in self.marks})
        self.between_id = self.tokenizer.encode(self.between.strip(" "), add_special_tokens=False).ids[0] if self.between else 0
        self.bare = Tokenizer(self.model)  # the model without what a whole text needs around it
        if self.small:  # a word is what stands between marks, and its last token says that it ends it
            self.bare.pre_tokenizer = pre_tokenizers.CharDelimiterSplit("Ġ")
            vocabulary = self.tokenizer.get_vocab()
            self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
            self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        elif self.between:
            self.mark = self.tokenizer.token_to_id("Ā")  # of the byte 0, which merges with nothing
        self.known: dict[str, bytes] = {}  # chunks that follow their lead; behind a space: pieces that follow nothing
        self.older: dict[str, bytes] = {}

    def _encoded(self, parts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)]

    def _word(self, piece: str) -> bytes:
        """The ids of one pre-token of Latin letters, a space before it or not: normalised as the library
        does, it goes to the library's model alone, without what a whole text needs around it."""
        if self.small:
            piece = (piece if piece.isascii() else unicodedata.normalize("NFC", piece)).lower()
        spelled = piece.replace(" ", "Ġ") if piece.isascii() else piece.encode().decode("latin-1").translate(_BYTE_LETTERS)
        return array("I", [t.id for t in self.model.tokenize(spelled)]).tobytes()

    def _words(self, words: list[str]) -> list[bytes]:
        """``_word`` of each, many in one call of the model."""
        out: list[bytes] = []
        groups = [words[k : k + self.WORDS] for k in range(0, len(words), self.WORDS)]
        if self.small:
            joined = [" ".join(g) for g in groups]
            joined = [(x if x.isascii() else unicodedata.normalize("NFC", x)).lower() for x in joined]
        else:
            joined = ["\0".join(g) for g in groups]
        spelled = [x.replace(" ", "Ġ").replace("\0", "Ā") if x.isascii() else x.encode().decode("latin-1").translate(_BYTE_LETTERS) for x in joined]
        for group, e in zip(groups, self.bare.encode_batch_fast(spelled, add_special_tokens=False), strict=True):
            ids = np.array(e.ids, np.uint32)
            if self.small:
                ends = np.flatnonzero(self.ends[ids]) + 1
                starts = [0, *ends[:-1].tolist()]
            else:
                ends = np.append(np.flatnonzero(ids == self.mark), len(ids))
                starts = [0, *(ends[:-1] + 1).tolist()]
            if len(ends) != len(group):  # not told apart
                out += map(self._word, group)
                continue
            whole = ids.tobytes()
            out += [whole[4 * a : 4 * z] for a, z in zip(starts, ends.tolist(), strict=True)]
        return out

    def _spell(self, parts: list[str]) -> list[bytes]:
        """The ids of each piece: words by themselves, other pieces many in one text, with a token between
        them that none of them holds."""
        out: list[bytes] = [b""] * len(parts)
        alone, rest = [], []
        for i, p in enumerate(parts):
            word = p[1:] if p[:1] == " " else p
            if word.isalpha() and (word.isascii() or max(word) < "\u0250" and "İ" not in word):
                out[i] = self._word(p)
            elif not p or self.apart.search(p):
                alone.append(i)
            else:
                rest.append(i)
        for i, ids in zip(alone, self._encoded([parts[i] for i in alone]), strict=True):
            out[i] = ids
        groups = [rest[k : k + self.JOINED] for k in range(0, len(rest), self.JOINED)]
        for group, e in zip(groups, self.tokenizer.encode_batch_fast([self.between.join([parts[i] for i in g]) for g in groups], add_special_tokens=False), strict=True):
            ids, mark = e.ids, self.between_id
            if ids.count(mark) != len(group) - 1:  # not told apart
                for i, one in zip(group, self._encoded([parts[i] for i in group]), strict=True):
                    out[i] = one
                continue
            whole, at = array("I", ids).tobytes(), 0
            for i in group[:-1]:
                end = ids.index(mark, at)
                out[i] = whole[4 * at : 4 * end]
                at = end + 1
            out[group[-1]] = whole[4 * at :]
        return out

    def _one(self, piece: str) -> bytes:
        """The ids of one piece, which stands by itself."""
        word = piece[1:] if piece[:1] == " " else piece
        if word.isalpha() and (word.isascii() or max(word) < "\u0250" and "İ" not in word):
            return self._word(piece)
        return array("I", self.tokenizer.encode(piece, add_special_tokens=False).ids).tobytes() if piece else b""

    def _look_up(self, chunks: list[str]) -> list[bytes]:
        """The ids of different chunks. What this generation has not seen is taken from the one before, or cut
        into pieces; what no generation knows of these is spelled at once."""
        known, older, words, others, cut = self.known, self.older, {}, {}, []
        out = list(map(known.get, chunks))
        if None not in out:
            return out

        def ask(key: str, piece: str, lead: str) -> None:
            if piece.isalpha() and (piece.isascii() or max(piece) < "\u0250" and "İ" not in piece):
                words[key] = lead + piece
            else:
                others[key] = lead + piece

        for chunk, ids in zip(chunks, out, strict=True):
            if ids is not None:
                continue
            ids = older.pop(chunk, None)
            if ids is not None:
                known[chunk] = ids
                continue
            if chunk.isalpha() and "İ" not in chunk or len(parts := pieces(chunk)) == 1:
                ask(chunk, chunk, self.lead)
                continue
            keys = [parts[0], *[" " + p for p in parts[1:]]]  # a mark that no chunk starts with
            cut.append((chunk, keys))
            for key, piece in zip(keys, parts, strict=True):
                if key in known or key in words or key in others:
                    continue
                ids = older.pop(key, None)
                if ids is not None:
                    known[key] = ids
                else:
                    ask(key, piece, "" if key is not piece else self.lead)
        for key, piece in others.items():
            known[key] = self._one(piece)
        known.update(zip(words, self._words(list(words.values())), strict=True))
        for chunk, keys in cut:
            known[chunk] = b"".join([known[k] for k in keys])
        return list(map(known.__getitem__, chunks))

    def _cut(self, text: str) -> str | None:
        if any(b in text for b in self.begins) and any(m in text.lower() for m in self.marks):
            return None
        return self.chunks(text)

    def ids(self, texts: list[str]) -> list[bytes]:
        """Nothing here makes reference cycles; looking for them among millions of pieces takes long."""
        collecting = gc.isenabled()
        gc.disable()
        try:
            out, part, held = [], [], 0
            for t in texts:
                if part and held + len(t) > self.AT_ONCE:
                    out += self._ids(part)
                    part, held = [], 0
                part.append(t)
                held += len(t)
            return out + self._ids(part)
        finally:
            if collecting:
                gc.enable()

    def _ids(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > self.LIMIT:
            self.older.clear()
            self.known, self.older = self.older, self.known
        cut = [self._cut(t) for t in texts]
        joined = iter(self._joined([c for c in cut if c is not None]))
        whole = iter(self._encoded([t for t, c in zip(texts, cut, strict=True) if c is None]))
        return [next(whole if c is None else joined) for c in cut]

    def _joined(self, texts: list[str]) -> list[bytes]:
        """The ids of texts that may be cut at spaces: Arrow cuts them and numbers their distinct chunks, each of
        which is looked up once, and puts the ids together."""
        if not texts:
            return []
        split = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        chunks, ends = split.flatten(), split.offsets.to_numpy().astype(np.int64)
        first = ends[:-1] if self.lead else ends[:0]
        inner = np.ones(len(chunks), bool)
        inner[first] = False
        numbered = chunks.filter(pa.array(inner)).dictionary_encode()
        spelled = self._look_up(numbered.dictionary.to_numpy(zero_copy_only=False).tolist())
        at = np.empty(len(chunks), np.int64)
        at[inner] = numbered.indices.to_numpy()
        at[first] = np.arange(len(spelled), len(spelled) + len(first))
        spelled += self._spell(chunks.take(pa.array(first)).to_pylist())
        ids = pa.array(spelled, pa.large_binary()).take(pa.array(at))
        places = np.frombuffer(ids.buffers()[1], np.int64, len(at) + 1)[ends].tolist()
        data = memoryview(ids.buffers()[2]) if ids.buffers()[2] is not None else memoryview(b"")
        return [data[a:z].tobytes() for a, z in zip(places, places[1:], strict=False)]


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, special_as_text: bool = False) -> Encoder:
    """One for each worker and vocabulary."""
    key = (path, special_as_text)
    if key not in _ENCODERS:
        found = _ENCODERS[key] = Encoder(path, special_as_text)
        REMEMBERED.extend([found.known, found.older])
    only(_ENCODERS[key].known, _ENCODERS[key].older)
    return _ENCODERS[key]


def vocabulary(name: str) -> str:
    return public_tokenizers.path(name)
