"""Conversation structure repair: the cheapest edits that give a legal sequence of roles.

A legal sequence of role initials is ``(s?(ua)+)?``. Keep costs 0, Rerole (to user or assistant) 3, Delete 4,
Insert (an empty user or assistant turn) 3; a truncated turn that stays adds 3; blank and duplicate turns have
to go. Of equally cheap edits, those whose initials come first in ASCII order.

The automaton has four states: start, behind s, behind u, behind a. A turn is a symbol (role class and
fault), and a symbol is a 4 x 4 matrix of least costs. Equal turns are counted before anything is shuffled,
equal consecutive symbols are collapsed into runs, and a run of any length costs a few min-plus products with
cached binary powers of its matrix. Costs run backwards; then choices are unrolled forwards.

No conversation has to fit a task. Turns get gapless ordinals and are cut into segments of ``segment``
turns, which may hold many conversations or a piece of one. A piece is first reduced to its matrix; the matrices
of one conversation (a row for each segment) give each piece the costs behind it; then each piece is unrolled
for each state it may be entered in, and the pieces are strung together. Duplicates are found by an aggregation
over (conversation, role, SHA-256 of the text). Texts are shuffled once, to be streamed in order past the edits.
What a conversation's answer itself holds, its audit and the digest of its text, is one cell and one stream.

Cases: rows go by turn, nulls first, then by role and the text's SHA-256; a null role or text is one space, so
such a text is blank; a role is judged by its first character, an empty one is illegal everywhere; a null
conv_id is a conversation of its own; repeated rows are duplicates; very long texts are streamed; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ticketloom.functions.columns import with_ordinal
from ticketloom.session import bounded_batches, release, table, written

_BLANKS = " \t\n\x0b\x0c\r"
START, AFTER_S, AFTER_U, AFTER_A = range(4)
#: state -> {role initial: next state}
NEXT = {START: {"s": AFTER_S, "u": AFTER_U}, AFTER_S: {"u": AFTER_U}, AFTER_U: {"a": AFTER_A}, AFTER_A: {"u": AFTER_U}}
#: state -> role of an inserted or rerolled turn
NEEDED = {START: "user", AFTER_S: "user", AFTER_U: "assistant", AFTER_A: "user"}
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Symbols: 0-3 are s, u, a and any other role, 4-7 the same truncated, 8 a turn that has to go.
GONE = 8
_FAR = np.int64(1) << 60


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Min-plus product of a matrix and a matrix or vector."""
    return np.minimum((a[:, :, None] + b[None, :, :]).min(axis=1) if b.ndim == 2 else (a + b).min(axis=1), _FAR)


@cache
def _inserts() -> np.ndarray:
    """Least costs from state to state by insertions alone."""
    one = np.full((4, 4), _FAR)
    np.fill_diagonal(one, 0)
    for s, role in NEEDED.items():
        one[s, NEXT[s][role[0]]] = INSERT
    return _times(_times(one, one), one)


def _moves(symbol: int, state: int) -> dict[str, tuple[int, int]]:
    """letter -> (cost, next state) for a turn met in a state, without insertions."""
    moves = {"D": (DELETE, state)}
    if symbol != GONE:
        more = TRUNCATED * (symbol >= 4)
        if (own := "sua?"[symbol % 4]) in NEXT[state]:
            moves["K"] = (more, NEXT[state][own])
        moves["R"] = (REROLE + more, NEXT[state][NEEDED[state][0]])
    return moves


@cache
def power(symbol: int, k: int = 0) -> np.ndarray:
    """Least costs from state to state over 2^k turns of one symbol, insertions before each included."""
    if k:
        return _times(power(symbol, k - 1), power(symbol, k - 1))
    step = np.full((4, 4), _FAR)
    for s in range(4):
        for cost, t in _moves(symbol, s).values():
            step[s, t] = min(step[s, t], cost)
    return _times(_inserts(), step)


def over_run(symbol: int, n: int, behind: np.ndarray) -> np.ndarray:
    """Costs before a run of n turns, given those behind it (a vector, or a matrix)."""
    k = 0
    while n:
        if n & 1:
            behind = _times(power(symbol, k), behind)
        n, k = n >> 1, k + 1
    return behind


@cache
def at_end() -> np.ndarray:
    """Costs behind the last turn: insertions up to a legal end."""
    return np.minimum(_inserts()[:, START], _inserts()[:, AFTER_A])


def runs_of(symbols: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """(symbol, n), equal neighbours collapsed."""
    return [(s, sum(n for _, n in same)) for s, same in groupby(symbols, key=lambda x: x[0])]


def matrix_of(runs: list[tuple[int, int]]) -> np.ndarray:
    out = np.where(np.eye(4, dtype=bool), 0, _FAR)
    for symbol, n in reversed(runs):
        out = over_run(symbol, n, out)
    return out


def unrolled(runs: list[tuple[int, int]], behind: np.ndarray, state: int, last: bool) -> tuple[str, int, int]:
    """(letters, cost, state at the end) of the best edits over runs entered in a state."""
    costs = [behind]
    for symbol, n in reversed(runs):
        costs.append(over_run(symbol, n, costs[-1]))
    costs.reverse()
    total, letters = int(costs[0][state]), []
    for k, (symbol, n) in enumerate(runs):
        if symbol == GONE:  # nothing before a deletion is better than what can follow it
            letters.append("D" * n)
            continue
        steps = [costs[k + 1].tolist()]  # costs before each turn of the run, from its end
        for _ in range(n - 1):
            steps.append(_times(power(symbol), np.array(steps[-1])).tolist())
        steps.append(costs[k].tolist())
        while len(steps) > 1:
            here, after = steps[-1], steps[-2]
            moves = _moves(symbol, state)
            moves["I"] = (INSERT, NEXT[state][NEEDED[state][0]])
            for letter in sorted(moves):
                cost, t = moves[letter]
                if cost + (here if letter == "I" else after)[t] == here[state]:
                    letters.append(letter)
                    state = t
                    if letter != "I":
                        steps.pop()
                    break
    if last:
        while state not in (START, AFTER_A):
            letters.append("I")
            state = NEXT[state][NEEDED[state][0]]
    return "".join(letters), total - int(behind[state]) if not last else total, state


def _edges_of(names: list[str]):
    """Of a segment, the matrices of the conversations that may go on in another one."""

    def run(group: pa.Table) -> pa.Table:
        pieces = _pieces(group)
        open_ = pieces if len(pieces) == 1 else [pieces[0], pieces[-1]]
        at = pa.array([p.start for p in open_])
        symbols, counts = group.column("symbol").to_numpy(), group.column("n").to_numpy()
        found = [matrix_of(_piece_runs(symbols, counts, p)).reshape(-1).tolist() for p in open_]
        return pa.table([group.column("conv_id").take(at), group.column("segment").take(at), pa.array(found, pa.list_(pa.int64()))], names)

    return run


def _pieces(group: pa.Table) -> list[slice]:
    """Stretches of rows, ordered by place, that belong to one conversation."""
    ids, out, begin = group.column("conv_id").to_pylist(), [], 0
    for k in range(1, len(ids) + 1):
        if k == len(ids) or ids[k] != ids[begin]:
            out.append(slice(begin, k))
            begin = k
    return out


def _piece_runs(symbols: np.ndarray, counts: np.ndarray, piece: slice) -> list[tuple[int, int]]:
    """Rows stand for n equal turns; of those that need not go, only the first stays."""
    each: list[tuple[int, int]] = []
    for s, n in zip(symbols[piece].tolist(), counts[piece].tolist(), strict=True):
        each += [(s, n)] if s == GONE else [(s, 1), (GONE, n - 1)] if n > 1 else [(s, 1)]
    return runs_of(each)


def _tails(names: list[str]):
    """For each segment of a conversation the costs behind it, from the matrices of later ones."""

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("segment")
        behind, out = at_end(), []
        for m in reversed(group.column("costs").to_pylist()):
            out.append(behind.tolist())
            behind = _times(np.array(m).reshape(4, 4), behind)
        n = len(out)
        return pa.table([group.column("conv_id"), group.column("segment"), pa.array(out[::-1], pa.list_(pa.int64())), pa.array([k == 0 for k in range(n)]), pa.array([k == n - 1 for k in range(n)])], names)

    return run


_LEGAL = {"su", "ua", "au"}


def _unrolled_segment(names: list[str]):
    def run(group: pa.Table, tails: pa.Table) -> pa.Table:
        group = group.sort_by("place")
        known = {r["conv_id"]: r for r in tails.to_pylist()}
        ids, symbols, counts = group.column("conv_id").to_pylist(), group.column("symbol").to_numpy(), group.column("n").to_numpy()
        initials, turns = group.column("initial").to_pylist(), group.column("turn").to_pylist()
        pieces, rows = _pieces(group), []
        for p in pieces:
            tail = known.get(ids[p.start]) or {"behind": at_end(), "is_first": True, "is_last": True}
            runs = _piece_runs(symbols, counts, p)
            entered = [START] if tail["is_first"] else range(4)
            found = [unrolled(runs, np.array(tail["behind"]), s, tail["is_last"]) for s in entered]
            own = initials[p]
            met = [t for t in turns[p] if t is not None]
            illegal = sum(a + b not in _LEGAL for a, b in zip(own, own[1:], strict=False)) + int((counts[p] - 1).sum())
            rows.append(([f[0] for f in found], [f[1] for f in found], [f[2] for f in found], illegal, own[0], own[-1], len(set(met)), met[0] if met else None, met[-1] if met else None))
        at = pa.array([p.start for p in pieces])
        kinds = [pa.list_(pa.string()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
        return pa.table([group.column("conv_id").take(at), group.column("segment").take(at), *[pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]], names)

    return run


def _role(c: Column | str) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(" "))


def _symbols(turns: DataFrame, segment: int) -> DataFrame:
    """(conv_id, segment, place, turn, initial, symbol, n, fault): distinct turns in order."""
    ending = F.rtrim(F.col("text"), F.lit(_BLANKS))
    mark = F.substring(ending, -1, 1)
    ends = F.when(ending == "", "blank").when(~mark.isin(".", "!", "?"), "truncated").otherwise("")
    light = turns.select("conv_id", "turn", "role", F.unhex(F.sha2("text", 256)).alias("digest"), ends.alias("ends"))
    counted = light.groupBy("conv_id", "turn", "role", "digest").agg(F.first("ends").alias("ends"), F.count(F.lit(1)).alias("n"))
    placed = with_ordinal(counted, ["conv_id", "turn", "role", "digest"], "place")
    firsts = placed.groupBy("conv_id", "role", "digest").agg(F.min("place").alias("place")).select("place", F.lit(True).alias("is_first"))
    marked = placed.join(firsts, "place", "left")
    fault = F.when(F.col("ends") == "blank", "blank").when(F.col("is_first").isNull(), "duplicate").otherwise(F.col("ends"))
    initial = F.substring("role", 1, 1)
    role = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    symbol = F.when(F.col("fault").isin("blank", "duplicate"), GONE).otherwise(role + F.when(F.col("fault") == "truncated", 4).otherwise(0))
    out = marked.withColumn("fault", fault).select("conv_id", F.floor(F.col("place") / segment).alias("segment"), "place", "turn", initial.alias("initial"), symbol.alias("symbol"), "n", "fault")
    return written(out, "turn-symbols")


def plan_repair(turns: DataFrame, segment: int = 1 << 16) -> DataFrame:
    """turns(conv_id, turn, role, text, no nulls in the last two) -> a row for each conversation: conv_id,
    gaps, blank, duplicate, truncated, illegal, cost, audit (the edits' initials in order)."""
    bounded_batches(turns.sparkSession)
    symbols = _symbols(turns, segment)
    id_field = symbols.schema["conv_id"]

    def kind(ddl: str) -> StructType:
        return StructType([id_field, StructField("segment", symbols.schema["segment"].dataType), *StructType.fromDDL(ddl).fields])

    in_edges, in_tails = kind("costs array<long>"), kind("behind array<long>, is_first boolean, is_last boolean")
    pieces = kind("audits array<string>, costs array<long>, exits array<int>, illegal long, first_initial string, last_initial string, turns long, first_turn long, last_turn long")
    sorted_edges = _edges_of(in_edges.names)
    edges = symbols.select("conv_id", "segment", "place", "symbol", "n").groupBy("segment").applyInArrow(lambda g: sorted_edges(g.sort_by("place")), in_edges)
    tails = written(edges.groupBy("conv_id").applyInArrow(_tails(in_tails.names), in_tails), "turn-tails")
    found = symbols.drop("fault").groupBy("segment").cogroup(tails.groupBy("segment")).applyInArrow(_unrolled_segment(pieces.names), pieces)

    # pieces of a conversation, strung together
    listed = found.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("segment", *[c for c in pieces.names[2:]]))).alias("pieces"))
    acc_type = "struct<state:int,audit:string,cost:bigint,illegal:bigint,initial:string,turns:bigint,turn:bigint,first:bigint>"
    start = F.struct(F.lit(START).alias("state"), F.lit("").alias("audit"), F.lit(0).alias("cost"), F.lit(0).alias("illegal"), F.lit(None).alias("initial"), F.lit(0).alias("turns"), F.lit(None).alias("turn"), F.lit(None).alias("first")).cast(acc_type)

    def string_on(acc: Column, x: Column) -> Column:
        border = F.coalesce((~F.concat(acc["initial"], x["first_initial"]).isin(*sorted(_LEGAL))).cast("long"), F.lit(0))
        return F.struct(
            F.get(x["exits"], acc["state"]).alias("state"),
            F.concat(acc["audit"], F.get(x["audits"], acc["state"])).alias("audit"),
            (acc["cost"] + F.get(x["costs"], acc["state"])).alias("cost"),
            (acc["illegal"] + x["illegal"] + border).alias("illegal"),
            x["last_initial"].alias("initial"),
            (acc["turns"] + x["turns"] - F.coalesce((acc["turn"] == x["first_turn"]).cast("long"), F.lit(0))).alias("turns"),
            F.coalesce(x["last_turn"], acc["turn"]).alias("turn"),
            F.coalesce(acc["first"], x["first_turn"]).alias("first"),
        ).cast(acc_type)

    strung = listed.select("conv_id", F.aggregate("pieces", start, string_on).alias("a"))
    own = lambda f: F.col("fault") == f
    repeats = F.when(own("duplicate"), F.col("n")).when(~own("blank"), F.col("n") - 1).otherwise(0)
    faults = symbols.groupBy("conv_id").agg(F.sum(F.when(own("blank"), F.col("n")).otherwise(0)).alias("blank"), F.sum(repeats).alias("duplicate"), F.sum(own("truncated").cast("long")).alias("truncated"))
    faults = faults.withColumnRenamed("conv_id", "of")
    gaps = F.coalesce(F.col("a.turn") - F.col("a.first") + 1 - F.col("a.turns"), F.lit(0))
    joined = strung.join(faults, strung["conv_id"].eqNullSafe(faults["of"]))
    out = written(joined.select("conv_id", gaps.alias("gaps"), "blank", "duplicate", "truncated", "a.illegal", "a.cost", "a.audit"), "turn-plans")
    release(symbols, tails)
    return out


def _streamed(names: list[str]):
    """Rows (conv_id, audit, role, text), a conversation's audit before its turns -> its turns after repair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audit, at, state, place = "", 0, START, 0
        for batch in batches:
            owner, rows = [], []

            def insert(k: int) -> None:
                """The turns to be inserted at this point."""
                nonlocal at, state, place
                while at < len(audit) and audit[at] == "I":
                    owner.append(k)
                    rows.append((place, "insert", NEEDED[state], ""))
                    at, state, place = at + 1, NEXT[state][NEEDED[state][0]], place + 1

            ids, audits, roles, texts = (batch.column(k).to_pylist() for k in range(4))
            for k in range(len(ids)):
                if audits[k] is not None:
                    audit, at, state, place = audits[k], 0, START, 0
                    insert(k)
                    continue
                letter, at = audit[at], at + 1
                if letter != "D":
                    role = roles[k] if letter == "K" else NEEDED[state]
                    owner.append(k)
                    rows.append((place, "keep" if letter == "K" else "rerole", role, texts[k]))
                    state, place = NEXT[state][role[0]], place + 1
                insert(k)
            kinds = [pa.int64(), pa.string(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owner, pa.int64())), *[pa.array([r[c] for r in rows], kind) for c, kind in enumerate(kinds)]], names)

    return run


def repaired_turns(turns: DataFrame, plans: DataFrame) -> DataFrame:
    """(conv_id, place, edit, role, text) after repair, the turns of a conversation in order and in one
    partition; edit is keep, rerole or insert."""
    bounded_batches(turns.sparkSession)
    keys = turns.select("conv_id", F.lit(None).cast("string").alias("audit"), "role", "text", "turn", F.unhex(F.sha2("text", 256)).alias("digest"))
    heads = plans.select("conv_id", "audit", *[F.lit(None).cast(keys.schema[c].dataType).alias(c) for c in ("role", "text", "turn", "digest")])
    # within a conversation the audit is first: it alone is not null
    order = ["conv_id", F.col("audit").isNull(), "turn", "role", "digest"]
    ready = heads.unionByName(keys).repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "audit", "role", "text")
    kind = StructType([turns.schema["conv_id"], *StructType.fromDDL("place long, edit string, role string, text string").fields])
    return ready.mapInArrow(_streamed(kind.names), kind)


def _digested(names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, last, digest = None, None, None
        for batch in batches:
            ids, places, roles, texts = (batch.column(c).to_pylist() for c in ("conv_id", "place", "role", "text"))
            closed = []
            for k in range(len(ids)):
                if places[k] == 0:
                    if digest is not None:
                        closed.append((now, digest.hexdigest()))
                    now, digest = ids[k], hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{roles[k]}:{texts[k]}".encode())
            last = batch.schema.field("conv_id").type
            if closed:
                yield pa.RecordBatch.from_arrays([pa.array([c[0] for c in closed], last), pa.array([c[1] for c in closed])], names)
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], last), pa.array([digest.hexdigest()])], names)

    return run


def damaged(conversations: DataFrame) -> DataFrame:
    """The contract's damage, by CRC-32 of ``conv_id:turn`` modulo 20: (conv_id, turn, role, text)."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), _role("role").alias("role"), _role("text").alias("text"), (F.crc32(key.cast("binary")) % 20).alias("k")).filter("k != 0")
    text = F.when(F.col("k") == 1, "").when(F.col("k") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("k") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.array_repeat(F.lit(1), F.when(F.col("k") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def op13_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return repair_report(conversations.select("conv_id").distinct(), damaged(conversations))


def repair_report(every: DataFrame, turns: DataFrame, **options) -> DataFrame:
    """Plans and the digest of the repaired text for every conv_id."""
    plans = plan_repair(turns, **options)
    kind = StructType([turns.schema["conv_id"], *StructType.fromDDL("repaired_sha256 string").fields])
    digests = repaired_turns(turns, plans).mapInArrow(_digested(kind.names), kind).withColumnRenamed("conv_id", "of_digest")
    named = plans.withColumnRenamed("conv_id", "of_plan")
    joined = every.join(named, every["conv_id"].eqNullSafe(named["of_plan"]), "left").join(digests, every["conv_id"].eqNullSafe(digests["of_digest"]), "left")
    zeros = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return joined.select("conv_id", *zeros, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))


#: The contract: CRC-32 bit by bit, then a walk over the turns that keeps the best edits for each state.
OP13_SQL = r"""
WITH RECURSIVE named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations
), crc(key, j, c) AS (
  SELECT DISTINCT key, 0, 4294967295::BIGINT FROM named
  UNION ALL
  SELECT key, j + 1, CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END
  FROM (SELECT key, j, CASE WHEN j % 8 = 0 THEN xor(c, ascii(key[j // 8 + 1])::BIGINT) ELSE c END AS x FROM crc WHERE j < 8 * length(key))
), hurt AS (
  SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role, CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, k
  FROM (SELECT named.*, xor(c, 4294967295) % 20 AS k FROM named JOIN crc ON crc.key = named.key AND j = 8 * length(crc.key)) WHERE k <> 0
), turns AS (
  SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i
  FROM (SELECT * FROM hurt UNION ALL SELECT * FROM hurt WHERE k = 3)
), judged AS (
  SELECT *, role[1] AS initial, lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) AS before,
    CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
      WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault
  FROM turns
), steps(s, c, role, t) AS (
  VALUES (0, 's', NULL, 1), (0, 'u', 'user', 2), (1, 'u', 'user', 2), (2, 'a', 'assistant', 3), (3, 'u', 'user', 2)
), added(s, letters, cost, lines, t) AS (
  SELECT DISTINCT s, '', 0, '', s FROM steps
  UNION ALL SELECT s, 'I', 3, chr(10) || role || ':', t FROM steps WHERE role IS NOT NULL
  UNION ALL SELECT a.s, 'II', 6, chr(10) || a.role || ':' || chr(10) || b.role || ':', b.t FROM steps a JOIN steps b ON b.s = a.t WHERE a.role IS NOT NULL AND b.role IS NOT NULL
), walk(conv_id, i, s, best) AS (
  SELECT DISTINCT conv_id, 0::BIGINT, 0, struct_pack(cost := 0, audit := '', lines := '') FROM judged
  UNION ALL
  SELECT conv_id, i, t, min(best) FROM (
    SELECT j.conv_id, j.i, CASE e WHEN 'D' THEN a.t ELSE m.t END AS t,
      struct_pack(cost := w.best.cost + a.cost + CASE e WHEN 'D' THEN 4 WHEN 'K' THEN 0 ELSE 3 END + CASE WHEN e <> 'D' AND fault = 'truncated' THEN 3 ELSE 0 END,
        audit := w.best.audit || a.letters || e,
        lines := w.best.lines || a.lines || CASE e WHEN 'D' THEN '' WHEN 'K' THEN chr(10) || j.role || ':' || j.text ELSE chr(10) || m.role || ':' || j.text END) AS best
    FROM walk w JOIN judged j ON j.conv_id IS NOT DISTINCT FROM w.conv_id AND j.i = w.i + 1 JOIN added a ON a.s = w.s CROSS JOIN (VALUES ('D'), ('K'), ('R')) x(e)
    LEFT JOIN steps m ON m.s = a.t AND ((e = 'K' AND m.c = j.initial) OR (e = 'R' AND m.role IS NOT NULL))
    WHERE e = 'D' OR (fault NOT IN ('blank', 'duplicate') AND m.t IS NOT NULL)
  ) GROUP BY conv_id, i, t
), closed AS (
  SELECT w.conv_id, min(struct_pack(cost := w.best.cost + a.cost, audit := w.best.audit || a.letters, lines := w.best.lines || a.lines)) AS best
  FROM walk w JOIN (SELECT conv_id, max(i) AS n FROM judged GROUP BY conv_id) l ON l.conv_id IS NOT DISTINCT FROM w.conv_id AND w.i = l.n JOIN added a ON a.s = w.s AND a.t IN (0, 3) GROUP BY w.conv_id
), counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id
)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  coalesce(best.cost, 0)::BIGINT AS cost, coalesce(best.audit, '') AS audit, sha256(coalesce(best.lines[2:], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN closed b ON b.conv_id IS NOT DISTINCT FROM o.conv_id
"""
