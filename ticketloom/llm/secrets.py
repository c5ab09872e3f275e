"""Secret scan with structural confirmation.

Plain patterns (assignments, access ids, hex runs) give base spans. On top of them, base64 and hex
candidates are decoded and reported only if their bytes parse: a DER SEQUENCE whose nested lengths
fit exactly, at any depth, and whose items are a private key's, an OpenSSH key container parsed to its end, a PEM block around such
bytes or around an encrypted key, or a signed token whose header is a JSON object naming an algorithm
other than none. A candidate's own header tells its length, so it is found also behind a path or letters,
before other text, and broken over lines (real line ends or their escapes); no more of the text is read than
that length, and only if the first bytes can be a key's. Public keys are no secrets.

Cases: null text is empty text; repeated rows are scanned each by itself; whole texts, no prefixes; JSON
nested too deep to parse is no header;
an empty table gives an empty result; other columns are ignored by ``find_secrets`` and kept by
``redact``.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.session import bounded_batches, table

#: In the order in which kinds are listed where spans start together.
KINDS = ("assign", "access", "hex", "pem", "der", "openssh", "jwt")

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
_ASSIGN_HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY)-----((?:[^-]|-(?!----))+)-----END \1-----")
#: Where base64 of a DER SEQUENCE (its first byte is 0x30) can start, also behind other letters.
_DER_START = re.compile(r"M(?=[A-P])")
_LETTERS = re.compile(r"[A-Za-z0-9+/_-]+")
#: What may break base64 over lines: line ends, or their escapes.
_BREAK = re.compile(r"(?:\r?\n|\\r?\\n|\\n)[ \t]*")
_HEX_ANY = re.compile(r"[0-9A-Fa-f]{32,}")
_HEX_START = re.compile("(?=30)")
#: Three parts of a signed token; possessive, so that a long run of letters is read once.
_TOKEN = re.compile(r"(?<![A-Za-z0-9_-])([A-Za-z0-9_-]++)\.[A-Za-z0-9_-]{2,}+\.[A-Za-z0-9_-]++")
_CONTAINER = b"openssh-key-v1\0"
_CONTAINER_BASE64 = base64.b64encode(_CONTAINER).decode()  # 15 bytes, so 20 whole letters


def _from_base64(text: str) -> bytes:
    try:
        body = text.rstrip("=").replace("-", "+").replace("_", "/")
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (ValueError, binascii.Error):
        return b""


def _header(data: bytes, at: int) -> tuple[int, int] | None:
    """(start, size) of the content of the DER item at a place; None if there is no whole header."""
    if at + 2 > len(data):
        return None
    size, at = data[at + 1], at + 2
    if size & 0x80:
        n = size & 0x7F
        if not 1 <= n <= 4 or at + n > len(data):
            return None
        size, at = int.from_bytes(data[at : at + n], "big"), at + n
        if size < 0x80:
            return None
    return at, size


def der_items(data: bytes) -> list[tuple[int, bytes]] | None:
    """(tag, content) of consecutive DER items that fill data exactly, or None; SEQUENCEs have to be filled
    as well, at any depth. Every header is read once."""
    items, inside = [], [(0, len(data))]
    while inside:
        at, end = inside.pop()
        top = not at and end == len(data) and not items
        while at < end:
            head = _header(data, at)
            if head is None or sum(head) > end:
                return None
            if data[at] == 0x30:
                inside.append((head[0], sum(head)))
            if top:
                items.append((data[at], data[head[0] : sum(head)]))
            at = sum(head)
    return items


def der_size(head: bytes) -> int:
    """Bytes of the SEQUENCE that starts here, its header included; 0 if none does."""
    found = _header(head, 0) if head[:1] == b"0" else None
    return sum(found) if found else 0


def _fits_so_far(data: bytes, size: int) -> bool:
    """Whether data can be the start of ``size`` bytes of nested items: none is longer than what holds it."""
    inside = [(0, size)]
    while inside:
        at, end = inside.pop()
        while at < min(end, len(data)):
            head = _header(data, at)
            if head is None and at + 6 > len(data):
                break  # not whole yet
            if head is None or sum(head) > end:
                return False
            if data[at] == 0x30:
                inside.append((head[0], sum(head)))
            at = sum(head)
    return True


def _may_be_key(head: bytes) -> bool:
    """Whether the first bytes of a SEQUENCE can be a private key's: a small version INTEGER with an INTEGER,
    OCTET STRING or SEQUENCE behind it, or an algorithm SEQUENCE with an OBJECT IDENTIFIER."""
    at = _header(head, 0)[0]
    if head[at : at + 1] == b"0":
        inner = _header(head, at)
        return inner is not None and head[inner[0] : inner[0] + 1] == b"\x06"
    if head[at : at + 1] != b"\x02" or at + 1 >= len(head) or head[at + 1] not in (1, 2):
        return False
    return head[at + 2 + head[at + 1] :][:1] in (b"\x02", b"\x04", b"0")


def is_key_der(data: bytes) -> bool:
    """A SEQUENCE that fills data and is a private key: a version INTEGER with two INTEGERs at least, with an
    OCTET STRING, or with an algorithm and an OCTET STRING; or an encrypted one, an algorithm before an OCTET
    STRING. An algorithm is a SEQUENCE that starts with an OBJECT IDENTIFIER."""
    if len(data) < 16 or data[0] != 0x30:
        return False
    top = der_items(data)
    if top is None or len(top) != 1:
        return False
    inner = der_items(top[0][1]) or []
    tags = [tag for tag, _ in inner]

    def algorithm(k: int) -> bool:
        return inner[k][1][:1] == b"\x06"

    if tags == [0x30, 0x04]:
        return algorithm(0)
    if tags[:1] != [0x02] or len(inner[0][1]) > 2:
        return False
    return tags[:3] == [0x02] * 3 or tags[:2] == [0x02, 0x04] or (tags[:3] == [0x02, 0x30, 0x04] and algorithm(1))


def container_size(data: bytes) -> int:
    """Bytes of the OpenSSH key container that data starts with: cipher, kdf, kdf options, number of keys,
    that many public keys, and the private block, each with its length; 0 if there is no whole one. The
    cipher and the kdf are printable names, and keys and block are not empty."""
    if not data.startswith(_CONTAINER):
        return 0
    at, fields, left = len(_CONTAINER), 0, 4  # fields still to come, the count of keys apart
    while left:
        if at + 4 > len(data):
            return 0
        size, at = int.from_bytes(data[at : at + 4], "big"), at + 4
        if fields == 3:
            if not 1 <= size <= len(data):
                return 0
            left, fields = size + 1, fields + 1
            continue
        if at + size > len(data) or (fields != 2 and not size) or (fields < 2 and not (data[at : at + size].isascii() and data[at : at + size].decode().isprintable())):
            return 0
        at, fields, left = at + size, fields + 1, left - 1
    return at


def is_signed_header(text: str) -> bool:
    try:
        header = json.loads(_from_base64(text))
    except (ValueError, RecursionError):
        return False
    return isinstance(header, dict) and isinstance(header.get("alg"), str) and header["alg"].lower() not in ("", "none")


def is_key_block(body: str) -> bool:
    """What stands in a PEM block: header lines, then base64 of a key, or of whole cipher blocks."""
    lines = [x.strip() for x in re.split(r"\r?\n|\\r?\\n|\\n", body)]
    heads = [x for x in lines if ":" in x]
    data = _from_base64("".join("".join(x for x in lines if ":" not in x).split()))
    if any(x.startswith("Proc-Type:") and "ENCRYPTED" in x for x in heads):
        return len(data) >= 16 and len(data) % 8 == 0
    return is_key_der(data) or 0 < container_size(data) == len(data)


def _letters(text: str, at: int, need: int) -> tuple[str, int]:
    """Up to ``need`` base64 letters from a place on, over line ends, and where they end. No more of the text
    is read."""
    out: list[str] = []
    while need > 0:
        if run := _LETTERS.match(text, at, at + need):
            out.append(run[0])
            need, end = need - len(run[0]), run.end()
            if need <= 0 or not (gap := _BREAK.match(text, end)):
                return "".join(out), end
            at = gap.end()
        elif out and (gap := _BREAK.match(text, at)):
            at = gap.end()
        else:
            break
    return "".join(out), at


def _padded(text: str, at: int) -> int:
    while at < len(text) and text[at] == "=":
        at += 1
    return at


def _der_end(text: str, start: int) -> int | None:
    """Where the base64 of a key that starts here ends, None if there is no key."""
    head = _from_base64(_letters(text, start, 24)[0])
    size = der_size(head)
    need, have = -(-4 * size // 3), 24
    if size < 16 or start + need > len(text) or not _may_be_key(head):
        return None
    while True:  # four times as much each time, as long as what is there can be the start of such a SEQUENCE
        have = min(have, need)
        found, at = _letters(text, start, have)
        data = _from_base64(found if have == need else found[: have // 4 * 4])
        if len(found) < have or not _fits_so_far(data, size):
            return None
        if have == need:
            return _padded(text, at) if is_key_der(data[:size]) else None
        have *= 4


def _hex_key_end(run: str, start: int) -> int | None:
    """The same for hex, in a run of hex digits."""
    head = bytes.fromhex(run[start : start + 36][: (len(run) - start) // 2 * 2])
    size = der_size(head)
    if size < 16 or start + 2 * size > len(run) or not _may_be_key(head):
        return None
    return start + 2 * size if is_key_der(bytes.fromhex(run[start : start + 2 * size])) else None


def _container_end(text: str, start: int) -> int | None:
    """Where the base64 of an OpenSSH container ends; twice as many letters are read until it is whole."""
    need = 512
    while True:
        found, at = _letters(text, start, need)
        data = _from_base64(found[: len(found) - (len(found) % 4 == 1)])
        if size := container_size(data):
            return _padded(text, _letters(text, start, -(-4 * size // 3))[1])
        if len(found) < need:
            return None
        need *= 2


def _signed_tokens(text: str) -> Iterator[tuple[int, int]]:
    for m in _TOKEN.finditer(text):
        at = m[1].find("eyJ")  # what stands before it is no part of the token
        while at >= 0:
            if b":" in _from_base64(m[1][at : at + 400]) and is_signed_header(m[1][at:]):
                yield m.start() + at, m.end()
                break
            at = m[1].find("eyJ", at + 1)


def secret_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) in code points, by start, then kind as listed."""
    found: list[tuple[int, str, int]] = []
    low = text.lower()
    if any(h in low for h in _ASSIGN_HINTS):
        found += [(m.start(), "assign", m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), "access", m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    runs = list(_HEX.finditer(text))
    found += [(m.start(), "hex", m.end()) for m in runs]
    if "PRIVATE KEY-----" in text:
        found += [(m.start(), "pem", m.end()) for m in _PEM.finditer(text) if is_key_block(m[2])]
    at = text.find(_CONTAINER_BASE64)
    while at >= 0:
        if (end := _container_end(text, at)) is not None:
            found.append((at, "openssh", end))
        at = text.find(_CONTAINER_BASE64, end or at + 1)
    done = 0  # what is inside a key is no other key
    for m in _DER_START.finditer(text):
        if m.start() >= done and (end := _der_end(text, m.start())) is not None:
            found.append((m.start(), "der", end))
            done = end
    if "30" in text:
        for m in _HEX_ANY.finditer(text):
            done = 0
            for k in _HEX_START.finditer(m[0]):
                if k.start() >= done and (end := _hex_key_end(m[0], k.start())) is not None:
                    found.append((m.start() + k.start(), "der", m.start() + end))
                    done = end
    if "eyJ" in text:
        found += [(a, "jwt", z) for a, z in _signed_tokens(text)]
    return sorted(set(found), key=lambda x: (x[0], KINDS.index(x[1]), x[2]))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]))
    for batch in batches:
        spans = [[{"kind": k, "start": a, "stop": z} for a, k, z in secret_spans(t or "")] for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], ["doc_id", "spans"])


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans array<struct<kind, start, stop>>) for every row of docs."""
    bounded_batches(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    id_type = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(_scan, f"doc_id {id_type}, spans array<struct<kind:string,start:int,stop:int>>")


def redact(docs: DataFrame, text_col: str = "text", size_col: str = "n_chars", mark: str = "[secret]") -> DataFrame:
    """docs with each stretch covered by spans replaced by a mark; size_col, if there, follows."""
    bounded_batches(docs.sparkSession)
    at = docs.columns.index(text_col)
    size_at = docs.columns.index(size_col) if size_col in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, columns = batch.column(at).to_pylist(), list(batch.columns)
            changed = {}
            for i, text in enumerate(texts):
                if spans := secret_spans(text or ""):
                    out, done = [], 0
                    for start, _, stop in spans:
                        if start >= done:
                            out += [text[done:start], mark]
                        done = max(done, stop)
                    changed[i] = "".join(out) + text[done:]
            if changed:
                columns[at] = pa.array([changed.get(i, t) for i, t in enumerate(texts)], columns[at].type)
                if size_at is not None:
                    sizes = columns[size_at].to_pylist()
                    columns[size_at] = pa.array([len(changed[i]) if i in changed else n for i, n in enumerate(sizes)], columns[size_at].type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return docs.mapInArrow(run, docs.schema)


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digest columns of every document's spans."""
    found = find_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")

    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents stay, their secrets are replaced."""
    return redact(docs)
