"""Structure repair against SQL, a plain walk, and all edit scripts of short conversations."""

import hashlib
import heapq
import random
import re
import zlib

import pytest

from tests.compare import connection, same
from ticketloom.llm import conversations, queries

CHAR = re.compile(r"[^\x20\x09-\x0D]")
ROLES = {"u": "user", "a": "assistant"}


def faults(rows):
    """rows (turn, role, text) in order -> the first fault of each."""
    seen, out = set(), []
    for _, role, text in rows:
        shown = CHAR.findall(text)
        out.append("blank" if not shown else "duplicate" if (role, text) in seen else "" if shown[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(rows):
    """(cost, audit, lines) by a search over (row, role initials so far collapsed to the last), cheapest and
    ASCII-least first; nothing is shared with the operator's matrices."""
    marks = faults(rows)
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, last, lines = heapq.heappop(heap)
        if (i, last) in done:
            continue
        done.add((i, last))
        if i == len(rows) and last in ("", "a"):
            return cost, audit, lines
        after = {"": "su", "s": "u", "u": "a", "a": "u"}[last]
        for r in after.replace("s", ""):
            heapq.heappush(heap, (cost + 3, audit + "I", i, r, (*lines, f"{ROLES[r]}:")))
        if i < len(rows):
            _, role, text = rows[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, last, lines))
            if marks[i] not in ("blank", "duplicate"):
                more = 3 * (marks[i] == "truncated")
                if role[:1] and role[:1] in after:
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, role[0], (*lines, f"{role}:{text}")))
                for r in after.replace("s", ""):
                    heapq.heappush(heap, (cost + 3 + more, audit + "R", i + 1, r, (*lines, f"{ROLES[r]}:{text}")))


def expected(table):
    """The contract over rows (conv_id, turn, role, text)."""
    held = {conv: [] for conv, *_ in table}
    for conv, turn, role, text in table:
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if k:
            text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
            held[conv] += [(turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    out = set()
    for conv, rows in held.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        turns = [t for t, *_ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        marks = faults(rows)
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
        cost, audit, lines = cheapest(rows)
        out.add((conv, gaps, *[marks.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return out


def reported(spark, table, segment=1 << 16):
    df = spark.createDataFrame([(*r, "x", 3) for r in table], "conv_id long, turn long, role string, text string, audit string, place int")
    return set(map(tuple, conversations.repair_report(df.select("conv_id").distinct(), conversations.damaged(df), segment=segment).collect()))


def made(seed, conversations_, longest):
    rng = random.Random(seed)
    rows = []
    for conv in range(conversations_):
        for _ in range(rng.randint(1, longest)):
            text = rng.choice(["Yes.", "No!", "cut off", "", " \t", "ok?  ", "Yes.", f"t{rng.randint(0, 99)}.", "ünï…", None])
            rows.append((conv if conv % 11 else None, rng.choice([*range(longest), None]), rng.choice(["user", "assistant", "system", "user", "assistant", "tool", "", None, "Ux"]), text))
    return rows


def test_contract(spark, sf):
    same(queries.QUERIES["op13_structure_repair"](spark, sf), connection(sf), conversations.OP13_SQL)


@pytest.mark.parametrize("segment", [1 << 16, 3, 1])
def test_odd_conversations_in_segments(spark, segment):
    table = made(segment, 60, 12)
    assert reported(spark, table, segment) == expected(table)


def test_one_conversation_with_a_third_of_all_rows(spark):
    table = made(5, 40, 10) + [(7, t, "user" if t % 3 else "assistant", "same." if t % 5 else f"text {t}") for t in range(150)] + [(8, 4, "user", "copy.")] * 150
    assert reported(spark, table, 16) == expected(table)


def test_sql_on_odd_rows(spark, tmp_path):
    import duckdb

    table = made(9, 50, 9)
    df = spark.createDataFrame(table, "conv_id long, turn long, role string, text string")
    con = duckdb.connect()
    con.register("conversations", df.toPandas().astype({"conv_id": "Int64", "turn": "Int64"}))
    got = set(con.execute(f"SELECT conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 FROM ({conversations.OP13_SQL})").fetchall())
    assert got == expected(table)


def test_no_rows(spark):
    assert reported(spark, []) == set()
    alone = next(k for k in range(99) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    assert reported(spark, [(alone, 0, "user", "x.")]) == {(alone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())}


def test_runs_equal_single_steps():
    rng = random.Random(1)
    for _ in range(300):
        symbols = [rng.choice([0, 1, 2, 3, 5, 6, 8, 1, 1, 2, 8, 8]) for _ in range(rng.randint(0, 25))]
        rows = [(k, {0: "system", 1: "user", 2: "assistant", 3: "tool"}[s % 4] if s != 8 else "user", "" if s == 8 else f"t{k}" + ("" if s >= 4 else ".")) for k, s in enumerate(symbols)]
        letters, cost, _ = conversations.unrolled(conversations.runs_of([(s, 1) for s in symbols]), conversations.at_end(), 0, True)
        assert (cost, letters) == cheapest(rows)[:2]


def test_repaired_turns_are_legal(spark):
    table = made(3, 50, 14)
    df = conversations.damaged(spark.createDataFrame(table, "conv_id long, turn long, role string, text string"))
    rows = conversations.repaired_turns(df, conversations.plan_repair(df)).collect()
    by = {}
    for r in rows:
        by.setdefault(r["conv_id"], []).append((r["place"], r["role"], r["text"], r["edit"]))
    for found in by.values():
        assert [f[0] for f in found] == list(range(len(found))) and re.fullmatch("s?(ua)+", "".join(f[1][0] for f in found))
        assert all((f[3] == "insert") == (f[2] == "") for f in found)
