"""The training-data operations against brute force, on the driver's small tables and on edge cases."""

import base64
import hashlib
import json
import math
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.compare import connection, same
from ticketloom.llm import decontamination, language_id, near_dedup, packing, quality, queries, revisits, secrets, substring_dedup, token_files, tokens, toxicity
from ticketloom.session import new_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def texts(spark, sf):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, blanks, repeated rows and ids, a very long text, and columns with clashing names."""
    long = " ".join(f"w{k % 977} x{k}" for k in range(30_000))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one two"), (4, "one two"), (5, long), (6, long + " tail"), (None, "no id at all"), (7, "ünïcode “quotes” 😀  double  spaces \n"), (8, "One TWO")]
    return spark.createDataFrame([(i, t, "en", "s", 0, 0.5, "x", True, 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, score double, node string, kept boolean, key int")


@pytest.fixture(scope="module")
def none(odd):
    return odd.limit(0)


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def shingles(text):
    w = WORD.findall(lowered(text or ""))
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def components(texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    where, root = {}, {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in sorted(sets):
        met = Counter(j for s in sets[i] for j in where.get(s, ()))
        for j, n in met.items():
            if 100 * n >= 75 * (len(sets[i]) + len(sets[j]) - n):
                a, b = sorted((find(i), find(j)))
                root[b] = a
        for s in sets[i]:
            where.setdefault(s, []).append(i)
    return sets, {i: find(i) for i in sets}


def test_near_duplicates(spark, sf, texts):
    rows = queries.QUERIES["op3_near_duplicates"](spark, sf).collect()
    sets, want = components(texts)
    assert {r["doc_id"]: r["component_id"] for r in rows} == want
    assert all(r["n_shingles"] == len(sets[r["doc_id"]]) and r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)


def near_copies(seed, n, edits, words=120, spread=40):
    rng = np.random.default_rng(seed)
    texts = {}
    for i in range(n):
        w = [f"b{k}" for k in range(words)]
        for at in rng.integers(0, words, rng.integers(0, edits)):
            w[at] = f"e{rng.integers(0, spread)}"
        texts[i] = " ".join(w)
    return texts


@pytest.mark.parametrize(("n", "edits", "block"), [(150, 9, 32), (120, 14, 16), (90, 30, 8)])
def test_near_duplicates_in_crowded_buckets(spark, n, edits, block):
    texts = near_copies(3, n, edits)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for short in (256, block, 1):
        got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(df, block=block, short=short).collect()}
        assert got == components(texts)[1]


@pytest.mark.parametrize("short", [256, 5])
def test_near_duplicates_that_share_a_template_and_passages(spark, short):
    """Most pairs resemble each other by a half; some reach the threshold by their passages, some just so."""
    rng, texts = np.random.default_rng(6), {}
    for i in range(260):
        parts = [f"t{k}" for k in range(120)]
        for p in rng.choice(14, 4, replace=False):
            parts += [f"p{p}w{j}" for j in range(rng.integers(24, 27))]
        texts[i] = " ".join(parts + [f"o{i}"] * int(rng.integers(0, 3)))
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(df, short=short).collect()}
    want = components(texts)[1]
    assert got == want and 1 < len(set(want.values())) < 260


def test_intermediates_go(spark, tmp_path, odd):
    import os

    from ticketloom.session import shared_folder

    folder = shared_folder(spark)
    for name, run in {"near-components": lambda: near_dedup.near_duplicates(spark.createDataFrame(list(near_copies(4, 60, 20).items()), "doc_id long, text string"), block=8, short=4), "leaks": lambda: decontamination.contaminated(odd, odd.select(F.col("doc_id").alias("item_id"), "text"))}.items():
        before = set(os.listdir(folder))
        run().count()
        assert {x.rsplit("-", 1)[0] for x in set(os.listdir(folder)) - before} <= {name}


def test_near_duplicates_of_two_thousand_alike(spark):
    texts = near_copies(8, 2000, 7, words=150, spread=4000)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(df).collect()}
    assert got == components(texts)[1]


@pytest.mark.parametrize("two_sides", [False, True])
def test_forest_of_a_block(two_sides):
    import pyarrow as pa

    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, 40).astype(np.uint64)) for _ in range(30)]
    sides = [k % 2 for k in range(30)] if two_sides else [2] * 30
    homes = [bytes([k // 2 * 2]) for k in range(30)]
    group = pa.table({"node": [bytes([i]) for i in range(30)], "node_in": homes, "side": sides, "hashes": [s.tobytes() for s in sets]})
    out = near_dedup._forest(40, columns=16)(group)

    def parts(pairs):
        root = {h: h for h in homes}
        for a, b in pairs:
            ra, rb = root[homes[a]], root[homes[b]]
            root = {k: ra if v == rb else v for k, v in root.items()}
        return {frozenset(k for k in root if root[k] == r) for r in root.values()}

    got = [(a[0], b[0]) for a, b in zip(out["a"].to_pylist(), out["b"].to_pylist(), strict=True)]
    want = [(i, j) for i in range(30) for j in range(30) if (sides[i] != sides[j] or not two_sides) and i != j and 100 * len(np.intersect1d(sets[i], sets[j])) >= 40 * len(np.union1d(sets[i], sets[j]))]
    assert set(got) <= set(want) and parts(got) == parts(want) and 0 < len(got) < 15


def test_sketches_estimate_similarity_and_fill():
    rng = np.random.default_rng(5)
    a = rng.integers(0, 1 << 63, 400).astype(np.uint64)
    b = np.concatenate([a[:320], rng.integers(0, 1 << 63, 80).astype(np.uint64)])
    sk = near_dedup.fast_sketches([a, b, a[:1]], 128)
    assert (sk != np.iinfo(np.uint64).max).all()
    assert abs((sk[0] == sk[1]).mean() - 320 / 480) < 0.2


def test_near_duplicates_odd_rows(odd, none):
    rows = near_dedup.near_duplicates(odd).collect()
    got = [(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in rows]
    assert (1, 0, 1, True) in got and (3, 0, 3, True) in got and (8, 1, 4, False) in got and (6, 59997, 5, False) in got
    assert got.count((4, 1, 4, True)) == 2 and (None, 1, None, False) in got
    assert near_dedup.near_duplicates(none).count() == 0


def test_one_row_of_each_component_stays(spark, none):
    words = lambda k: " ".join(f"{k}w{j}" for j in range(30))
    rows = [(None, words("a")), (None, words("b")), (None, words("b")), (1, words("b") + " end"), (2, words("c")), (2, words("c")), (3, words("d")), (3, words("e")), (4, words("d")), (None, words("f")), (None, words("f")), (5, None), (5, ""), (6, ""), (None, ""), (None, None)]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, node int").repartition(3)
    out = near_dedup.keep_one_of_each(spark, df, "")
    got = Counter((r["doc_id"], r["text"]) for r in out.collect() if r["text"])
    assert got == Counter([(None, words("a")), (1, words("b") + " end"), (2, words("c")), (3, words("d")), (3, words("e")), (None, words("f"))])
    assert Counter(r["doc_id"] for r in out.collect() if not r["text"]) == Counter([5, 6, None]) and out.columns == df.columns
    assert near_dedup.keep_one_of_each(spark, none, "").count() == 0


def brute_repeats(texts):
    first = {}
    words = {i: WORD.findall(t or "") for i, t in texts.items()}
    for i in sorted(words):
        for k in range(len(words[i]) - 12):
            first.setdefault(tuple(words[i][k : k + 13]), i)
    out = {}
    for i, w in words.items():
        gone = [False] * len(w)
        for k in range(len(w) - 12):
            if first[tuple(w[k : k + 13])] < i:
                gone[k : k + 13] = [True] * 13
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out[i] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def test_substring_dedup(spark, sf, texts):
    rows = queries.QUERIES["op4_substring_dedup"](spark, sf).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in rows} == brute_repeats(texts)


def test_substring_dedup_windows_that_the_owner_lacks(spark):
    rng = np.random.default_rng(2)
    passages = [[f"p{k}_{j}" for j in range(18)] for k in range(3)]
    texts = {}
    for i in range(60):
        w = [f"d{i}_{k}" for k in range(10)]
        p = passages[i % 3]
        cut = int(rng.integers(0, 6))
        mid = p[cut : cut + 13 + int(rng.integers(0, 6))]
        texts[i] = " ".join(w + mid + [f"t{rng.integers(0, 3)}"] * 3 + mid[:5] + w)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for shard_words in (1 << 17, 600):  # the anchors of the passages are hot, then not
        got = substring_dedup.remove_repeats(df, shard_words=shard_words).collect()
        assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got} == brute_repeats(texts)


def test_suffix_automaton_keeps_first_documents():
    a = substring_dedup.SuffixAutomaton()
    a.add([1, 2, 3, 4], 5)
    a.add([9, 2, 3, 4, 7], 8)
    assert a.earliest([2, 3, 4], 3) == [5] and a.earliest([3, 4, 7], 3) == [8] and a.earliest([4, 4, 7], 3) == [None]
    assert a.earliest([0, 1, 2, 3, 4, 7, 2, 3, 4], 3) == [None, 5, 5, 8, None, None, 5] and a.earliest([2, 3], 3) == []


def test_substring_dedup_odd_rows(odd, none):
    rows = [(r["doc_id"], r["n_words"], r["n_removed"]) for r in substring_dedup.remove_repeats(odd).collect()]
    assert (6, 60001, 60000) in rows and (5, 60000, 0) in rows and (1, 0, 0) in rows and rows.count((4, 2, 0)) == 2 and (None, 4, 0) in rows
    assert substring_dedup.remove_repeats(none).count() == 0


def test_decontamination(spark, sf, texts):
    flat = lambda t: " " + " ".join(re.findall(r"\w+", (t or "").lower())) + " "
    items = {r["item_id"]: flat(r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    want = {(i, b) for i, t in texts.items() for b, bt in items.items() if bt in flat(t)}
    got = {(r["doc_id"], r["item_id"]) for r in queries.QUERIES["op1_decontamination"](spark, sf).collect()}
    assert got == want


def test_decontamination_slots(spark, odd, none):
    bench = spark.createDataFrame([(1, "A train leaves Paris at 7 and another train leaves Paris at 9 so how long do they travel before they meet"), (2, None)], "item_id long, text string")
    docs = spark.createDataFrame(
        [
            (1, "x y z. A train leaves Rome at 3 and another train leaves Rome at 5 so how long do they travel before they meet? yes"),
            (2, "A train leaves Paris at 7 and another train leaves Paris at 9, so how long do they travel before they meet"),
            (3, "A train leaves Rome at 3 and another train leaves Bonn at 3 so how long do they travel before they meet"),
            (4, "Trains leave and meet"),
            (None, "A train leaves Paris at 7 and another train leaves Paris at 9 so how long do they travel before they meet"),
        ],
        "doc_id long, text string",
    )
    got = {(r["doc_id"], r["item_id"], r["reparameterised"]) for r in decontamination.contaminated(docs, bench).collect()}
    assert got == {(1, 1, True), (2, 1, False)}
    assert {(r["doc_id"], r["item_id"]) for r in decontamination.contaminated(docs, bench, block=3).collect()} == {(1, 1), (2, 1)}
    assert decontamination.contaminated(odd, bench).count() == 0 and decontamination.contaminated(none, bench).count() == 0
    assert decontamination.contaminated(docs, bench.limit(0)).count() == 0


def test_decontamination_judges_each_occurrence(spark):
    item = "A train leaves Paris at 7 and another train leaves Paris at 9 so how long do they travel before they meet"
    rome, stray = item.replace("Paris", "Rome"), "another train leaves Bonn at 2 so how long do they all wait"
    far = " and then some other words follow here until the page ends. " * 3
    bad = "A train leaves Rome at 3 and another train leaves Bonn at 3 so how long do they travel before they meet"
    texts = {1: item + far + rome, 2: rome + far + item.replace("Paris", "Oslo"), 3: stray + far + item, 4: stray + far + rome, 5: bad + far + bad, 6: rome.replace("and another", "and then another") + far + stray}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = {(r["doc_id"], r["reparameterised"]) for r in decontamination.contaminated(docs, bench).collect()}
    assert got == {(1, False), (2, True), (3, False), (4, True), (6, True)}


def test_decontamination_finds_every_item_reparameterised(spark, sf):
    """Each benchmark item with its numbers and names changed, alone and beside the original."""
    from ticketloom.session import table

    names = {"Paris": "Oslo", "Anna": "Tom"}
    items = [(r["item_id"], r["text"]) for r in table(spark, sf, "benchmark").collect()]
    # the benchmark has hardly a slot of its own, so each item gets a question with two numbers and a name
    items = [(i, f"{t} If Anna walks {3 + i} km to Paris in {50 + i} minutes, how fast is she?") for i, t in items]

    def other(text):
        text = re.sub(r"\d+", lambda m: str(int(m[0]) * 7 + 1), text)
        return re.sub("|".join(names), lambda m: names[m[0]], text)

    fill = "then they went on and talked of other things for a while. "
    docs = [(2 * i, f"Some words come first. {other(t)} {fill}") for i, t in items] + [(2 * i + 1, f"{fill}{t} {fill}{other(t)} {fill}") for i, t in items]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontamination.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()
    got = {(r["doc_id"], r["item_id"]): r["reparameterised"] for r in found}
    assert {(2 * i, i) for i, _ in items} | {(2 * i + 1, i) for i, _ in items} <= set(got)
    assert all(got[2 * i, i] and not got[2 * i + 1, i] for i, _ in items)


def test_decontamination_with_windows_that_all_items_share(spark):
    shared = "choose the one right answer among the four given below and explain your choice in a few words"
    items = [(k, f"{shared} {' '.join(f'q{k}x{j}' for j in range(30))}") for k in range(40)]
    docs = [(k, f"{shared} d{k} e{k}") for k in range(50)] + [(100 + k, f"so {items[k][1]} and so on") for k in range(40)]
    got = decontamination.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(100 + k, k) for k in range(40)}


def test_contaminated_rows_go_whatever_their_id(spark, sf, odd, none):
    item = spark.read.parquet(f"{sf}/benchmark.parquet").first()["text"]
    rows = [(None, f"so. {item} and"), (None, "clean words only"), (1, item), (1, "other clean words"), (2, None), (2, ""), (3, "x y"), (3, "x y")]
    df = spark.createDataFrame([(i, t, 5) for i, t in rows], "doc_id long, text string, row int")
    out = decontamination.drop_contaminated(spark, df, sf)
    assert Counter((r["doc_id"], r["text"]) for r in out.collect()) == Counter(rows[k] for k in (1, 3, 4, 5, 6, 7)) and out.columns == df.columns
    assert decontamination.drop_contaminated(spark, odd, sf).count() == odd.count() and decontamination.drop_contaminated(spark, none, sf).count() == 0


def test_decontamination_of_items_dense_in_slots(spark):
    items = {1: "Anna gave Ben 3 apples and Carl 4 pears", 2: "Solve 3 x + 5 y = 17", 3: "12 7", 4: "Add 3 to 4, then 5 to 6, then 7 to 8, then 9 to 10, then 11 to 12 and tell Ben, Carl and Dora"}
    texts = {
        1: f"He said that {items[1]} and more. {items[2]}?",
        2: "so. Tom gave Sue 5 apples and Max 8 pears today",
        3: "well, solve 4 x + 2 y = 10 now",
        4: "Tom gave Sue 5 apples and Sue 8 pears today",
        5: f"x {items[4]} and the sum 12 7",
        6: "y. Add 1 to 2, then 13 to 14, then 15 to 16, then 17 to 18, then 19 to 20 and tell Max, Sue and Tom",
        7: "3 5 17 4 9 Ben Carl 12 8",
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    want = {(1, 1, False), (1, 2, False), (2, 1, True), (3, 2, True), (5, 4, False), (5, 3, False), (6, 4, True)}
    for block in (1 << 21, 4):
        got = {(r["doc_id"], r["item_id"], r["reparameterised"]) for r in decontamination.contaminated(docs, bench, block=block).collect()}
        assert got == want


def test_quality_counts(spark, sf, texts):
    rows = {r["doc_id"]: r for r in queries.QUERIES["op2_weak_supervision"](spark, sf).collect()}
    for i, t in texts.items():
        w = WORD.findall(t)
        tri = list(zip(w, w[1:], w[2:], strict=False))
        seen, covered, lines, dup = Counter(tri), set(), set(), 0
        for k, x in enumerate(tri):
            if seen[x] > 1:
                covered |= {k, k + 1, k + 2}
        for line in t.split("\n"):
            if WORD.search(line):
                dup += line in lines
                lines.add(line)
        r = rows[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(covered))
        assert r["base_failed"] == (len(w) < 50 or 100 * len(covered) > 50 * len(w)) and (not r["base_failed"] or not r["kept"])


def test_quality_follows_labels(spark):
    sf = "/root/testdata/sf0.01"
    judged = queries.QUERIES["op2_weak_supervision"](spark, sf).filter("not base_failed").join(spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality"), "doc_id").collect()
    assert sum(r["kept"] == (r["quality"] == 1) for r in judged) >= 0.95 * len(judged)


def test_estimate_recovers_rates():
    rng = np.random.default_rng(0)
    n = 20_000
    good = rng.random(n) < 0.8
    # votes bad with this rate among bad and among good documents, abstains in a fifth
    truth = [(0.9, 0.01), (0.6, 0.005), (0.5, 0.0)]
    votes = [np.where(rng.random(n) < 0.2, 0, np.where(rng.random(n) < np.where(good, g, b), -1, 1)) for b, g in truth]
    prior, rates = quality.estimate(sorted(Counter(zip(*(v.tolist() for v in votes), strict=True)).items()), 3)
    assert abs(prior - 0.8) < 0.05
    assert all(abs(r[-1][1] - b) < 0.08 and abs(r[-1][0] - g) < 0.01 for r, (b, g) in zip(rates, truth, strict=True))


def test_quality_odd_rows(odd, none):
    rows = quality.judge_quality(odd).collect()
    assert len(rows) == odd.count() and all(r["base_failed"] for r in rows if r["n_words"] < 50)
    assert quality.judge_quality(none).count() == 0


def test_toxicity_held_out_and_grammar(spark, sf):
    rows = queries.QUERIES["op5_toxicity"](spark, sf).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    g = toxicity.Grammar({"idiot": 1.0})
    plain, aimed, negated, told = (sum(g.clauses(t)) for t in ("such an idiot here", "you are such an idiot", "he is not an idiot", "she said he is an idiot"))
    assert aimed > plain > negated and plain > told and g.clauses("nice weather. good day") == []
    assert sum(g.clauses("i will kill you")) > 0 and sum(g.clauses("i kill time")) == 0
    assert g.score(None) == g.score("") < 0.5


def plain_clauses(g, text):
    """Clause scores by looking around each match, without any automaton."""
    clauses, now = [], []
    for raw in text.lower().split():
        now.append(raw)
        if raw.endswith((".", "!", "?", ";", ":")):
            clauses.append(now)
            now = []
    out = []
    for clause in [*clauses, now]:
        bare = [w.strip(toxicity._EDGE) for w in clause]
        kinds = [toxicity.INSULT if g.insult_weight(w) else toxicity.THREAT if w in g.threats else toxicity.WORD_CLASS.get(w, toxicity.OTHER) for w in bare]
        score, match = 0.0, False
        for i, (w, c) in enumerate(zip(bare, kinds, strict=True)):
            if c not in (toxicity.INSULT, toxicity.THREAT):
                continue
            match = True
            weight = g.insult_weight(w) or g.threats.get(w, 1.0)
            weight *= (0.15 if toxicity.NEGATION in kinds[max(0, i - 3) : i] else 1.0) * (0.5 if toxicity.REPORT in kinds[:i] else 1.0)
            if c == toxicity.INSULT:
                score += weight * (1.5 if toxicity.TARGET in kinds[:i] else 1.0)
            elif toxicity.TARGET in kinds:
                score += weight
        if match:
            out.append(score)
    return out


def test_toxicity_scores_against_plain_rules():
    rng = np.random.default_rng(6)
    g = toxicity.Grammar({"idiot": 1.0, "fool": 0.4}, {"blux": 0.7}, {"burn": 0.6})
    pool = "idiot fool bluxed kill burn you them not never said called and so. well; go! kill. you? the day".split()
    for _ in range(400):
        text = " ".join(rng.choice(pool, int(rng.integers(0, 40))))
        assert np.allclose(g.clauses(text), plain_clauses(g, text))


def test_transducers_compose():
    t = toxicity
    assert [w for _, w in t.negation().run([t.NEGATION, t.OTHER, t.INSULT, t.OTHER, t.INSULT])] == [1.0, 0.15, 0.15, 0.15, 1.0]
    assert [x for x, _ in t.addressed().run([t.THREAT, t.OTHER, t.TARGET, t.THREAT])] == [t.WAIT, t.NOTHING, t.RELEASE, t.MATCH]
    both = t.compose(t.negation(), t.reported())
    rng = np.random.default_rng(0)
    for _ in range(50):
        symbols = rng.integers(0, 6, 12).tolist()
        first = t.negation().run(symbols)
        second = t.reported().run([x for x, _ in first])
        assert both.run(symbols) == [(x, v * w) for (_, v), (x, w) in zip(first, second, strict=True)]


def test_toxicity_of_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    scored = queries.QUERIES["op5_toxicity"](spark, sf).filter("held_out").join(spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic"), "doc_id").collect()
    toxic, clean = ([r["score"] for r in scored if r["toxic"] == y] for y in (1, 0))
    assert toxic and clean and np.mean([(a > b) + 0.5 * (a == b) for a in toxic for b in clean]) >= 0.94  # 0.948: some toxic documents hold no word that was seen in training
    assert sum(r["predicted"] == r["toxic"] for r in scored) >= 0.95 * len(scored)


def test_toxicity_learns_threats(spark):
    """A word that is harmless by itself and goes with the label where somebody is addressed."""
    rng = np.random.default_rng(7)
    filler = [f"w{k}" for k in range(200)]
    rows = []
    for i in range(900):
        w = " ".join(rng.choice(filler, 30))
        kind = i % 9
        end = {0: "i will zorch you.", 1: "we will zorch wood.", 2: "i will thank you dear.", 3: "i will rest."}.get(kind, "the end.")
        rows.append((i, f"{w}. {end} {w}", int(kind == 0)))
    rows += [(900 + i, f"{' '.join(rng.choice(filler, 9))}. we zorch iron.", 0) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    g = toxicity.fit_grammar(df.select("doc_id", "text"), df.select("doc_id", "toxic").filter("doc_id % 5 <> 1"))
    assert "zorch" in g.threats
    assert all((g.score(t) >= 0.5) == bool(y) for _, t, y in rows)


def test_toxicity_learns_words_and_beginnings(spark):
    rng = np.random.default_rng(4)
    filler = [f"w{k}" for k in range(300)]
    rows = []
    for i in range(800):
        w = list(rng.choice(filler, 40))
        bad = i % 8 == 0
        if bad:
            for _ in range(4):
                w[int(rng.integers(0, 40))] = ["zorgish", f"blux{rng.integers(0, 50)}q"][int(rng.integers(0, 2))]
        rows.append((i, " ".join(w), int(bad)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    g = toxicity.fit_grammar(df.select("doc_id", "text"), df.select("doc_id", "toxic").filter("doc_id % 4 <> 1"))
    scored = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(df, g).collect()}
    assert all((scored[i] >= 0.5) == bool(y) for i, _, y in rows)
    assert toxicity.reject_toxic(df, g).count() == 700


def test_toxicity_odd_rows(spark, odd, none):
    g = toxicity.fit_grammar(odd.select("doc_id", "text"), spark.createDataFrame([], "doc_id long, toxic int"))
    assert toxicity.score_toxicity(odd, g).count() == odd.count() and toxicity.score_toxicity(none, g).count() == 0
    assert toxicity.reject_toxic(odd, g).columns == odd.columns


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_queries_match_sql(spark, sf, name):
    same(queries.QUERIES[name](spark, sf), connection(sf), queries.ORACLE_SQL[name])


def test_revisits_edge_cases(spark):
    schema = "record_id long, url string, captured timestamp, kind string, etag string, last_modified string, digest string, headers map<string,string>, body string, extra int"
    at = lambda m: f"2024-01-01 00:{m:02d}:00"
    rows = [
        (1, "http://A.example/x/", at(1), "response", '"a"', None, "d", {"ETag": '"a"', "Server": "s"}, "one", 0),
        (2, "https://a.example:443/x", at(5), "response", '"b"', None, "e", {"ETag": '"b"'}, "two", 0),
        (3, "http://www.a.example/x#f", at(5), "revisit", 'W/"b"', None, None, {"Date": "now", "Server": "t"}, None, 0),
        (4, "http://a.example/x", at(3), "revisit", '"b"', None, None, {}, None, 0),
        (5, "http://a.example/x", at(0), "revisit", '"a"', None, None, {}, None, 0),
        (6, None, at(3), "revisit", None, None, None, None, None, 0),
        (7, "http://a.example/x", at(9), "revisit", None, None, "e", None, None, 0),
        (8, "http://m.a.example/x", at(9), "revisit", None, None, "e", None, None, 0),
        (9, "http://a.example/x", None, "revisit", '"b"', None, None, None, None, 0),
        (10, "http://a.example/x", None, "response", '"z"', None, "e", None, "never", 0),
        (2, "https://a.example:443/x", at(5), "response", '"b"', None, "e", {"ETag": '"b"'}, "two", 0),
    ]
    df = spark.createDataFrame(rows, schema.replace("timestamp", "string")).withColumn("captured", F.col("captured").cast("timestamp"))
    for slot in (60, 3600):
        rows = revisits.resolve_revisits(df, slot).collect()
        got = {r["record_id"]: r for r in rows}
        assert len(rows) == len(got)
        assert {k: (r["base_id"], r["status"]) for k, r in got.items()} == {3: (2, "resolved"), 4: (1, "changed"), 5: (None, "no_response"), 6: (None, "no_response"), 7: (2, "resolved"), 8: (None, "no_response"), 9: (None, "no_response")}
        assert got[3]["headers"] == {"etag": '"b"', "date": "now"} and got[3]["body"] == "two" and got[7]["headers"] == {"etag": '"b"'}
    assert revisits.resolve_revisits(df.limit(0)).count() == 0


def test_revisits_without_url_match_nothing(spark):
    rows = [(1, None, 60, "response", "d", "one"), (2, None, 90, "revisit", "d", None), (3, None, 95, "revisit", "e", None), (4, None, 4000, "revisit", "d", None), (5, "http://a/x", 50, "response", "d", "two"), (6, "http://a/x", 99, "revisit", "d", None)]
    df = spark.createDataFrame(rows, "record_id long, url string, captured long, kind string, digest string, body string").select(
        "*", *(F.lit(None).cast("string").alias(c) for c in ("etag", "last_modified")), F.lit(None).cast("map<string,string>").alias("headers")
    ).withColumn("captured", F.timestamp_seconds("captured"))
    got = {r["record_id"]: (r["base_id"], r["status"], r["body"]) for r in revisits.resolve_revisits(df).collect()}
    assert got == {k: (None, "no_response", None) for k in (2, 3, 4)} | {6: (5, "resolved", "two")}


def encoded(name, texts, end):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokens.vocabulary(name))
    return [np.array([*e.ids, end], "<u4") for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_chunked_ids_are_whole_ids(name, texts):
    odd = ["a\n b", "x\n\ny", "  lead", "trail \n", " . ,a.", "don't stop's.", "a,b.c", "é,\nÉa.", "tab\tx", "\n", "", "a\n", "\na b", "q \n r", "1,2. 3.", "x y z", "###,\nfoo...", "<|endoftext|> x", "é, a.́"]
    rng = np.random.default_rng(0)
    alphabet = list("aé .,\n\t1'#ßΣ ") + ["the", " of", " ", "İ"]
    odd += ["".join(rng.choice(alphabet, 12)) for _ in range(500)]
    sample = odd + list(texts.values())[:80]
    got = tokens.Encoder(tokens.vocabulary(name)).ids(sample)
    for text, ids, want in zip(sample, got, encoded(name, sample, 0), strict=True):
        assert ids == want[:-1].tobytes(), text


def check_packing(rows, texts_in_order):
    want = Counter()
    for i, ids in texts_in_order:
        for k, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at : at + 4096]
            want[(i, k, at, len(part), zlib.crc32(part.tobytes()))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    return len(by), math.ceil(sum(len(ids) for _, ids in texts_in_order) / 4096)


def test_packing(spark, sf, texts):
    rows = queries.QUERIES["op7_best_fit_packing"](spark, sf).collect()
    ids = sorted(texts)
    used, least = check_packing(rows, list(zip(ids, encoded("word_bpe_49k.json", [texts[i] for i in ids], 1), strict=True)))
    assert used <= least + 1


def test_packing_odd_rows(odd, none):
    source = [(r["doc_id"], r["text"]) for r in odd.collect()]
    check_packing(packing.pack_documents(odd, bucket=3).collect(), list(zip([i for i, _ in source], encoded("word_bpe_49k.json", [t for _, t in source], 1), strict=True)))
    assert packing.pack_documents(none).count() == 0


def test_local_search_empties_bins():
    lengths = [6, 4, 5, 5, 3, 7, 2, 8]
    scattered = [[0], [1], [2], [3], [4], [5], [6], [7]]
    bins = packing.LocalSearch(scattered, lengths, 10).run()
    assert sorted(i for b in bins for i in b) == list(range(8)) and all(sum(lengths[i] for i in b) <= 10 for b in bins)
    assert len(bins) == 4
    # 5+5+? needs a swap: moves alone cannot empty a bin
    start = [[0, 1], [2, 3], [4]]
    sizes = [6, 2, 5, 3, 4]
    assert len(packing.LocalSearch(start, sizes, 10).run()) == 2


def test_local_search_ends_when_nothing_helps():
    lengths = np.random.default_rng(0).integers(900, 1801, 1500).tolist()
    start = packing.best_fit(lengths, 4096)
    bins = packing.LocalSearch(start, lengths, 4096).run()
    assert sorted(i for b in bins for i in b) == list(range(1500)) and all(sum(lengths[i] for i in b) <= 4096 for b in bins)
    assert math.ceil(sum(lengths) / 4096) < len(bins) < len(start)
    fill = [sum(lengths[i] for i in b) for b in bins]
    for s, b in enumerate(bins):
        outs = {lengths[i] for i in b} | {lengths[i] + lengths[j] for i in b for j in b if i < j}
        for t, other in enumerate(bins):
            for back in {0, *(lengths[i] for i in other)} if t != s and fill[s] < 4096 else ():
                assert not any(0 < out - back <= 4096 - fill[t] and fill[t] - fill[s] + out - back > 0 for out in outs)


def test_packing_buckets_are_sized_by_tokens(spark):
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.lit("a few short words").alias("text"))
    assert packing.pack_documents(docs, bucket=64).select("sequence_id").distinct().count() == 1


def test_language_id(spark, sf):
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.QUERIES["op8_language_id"](spark, sf).collect()
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.95 * len(held)


def test_language_id_odd_rows(spark, odd, none):
    model = language_id.fit_languages(spark.createDataFrame([(1, "aaaa bbbb", "x"), (2, "cccc dddd", "y"), (3, None, "z")], "doc_id long, text string, lang string"))
    assert model.languages == ["x", "y"]
    got = {r["doc_id"]: r for r in language_id.identify_languages(spark.createDataFrame([(1, "123"), (2, None), (3, "aabb"), (4, "cd")], "doc_id long, text string"), model).collect()}
    assert [got[k]["lang_pred"] for k in (1, 2, 3, 4)] == ["und", "und", "x", "y"] and got[1]["score"] == 0.0
    assert language_id.identify_languages(odd, model).count() == odd.count() and language_id.identify_languages(none, model).count() == 0
    empty = language_id.fit_languages(none.select("doc_id", "text", "lang"))
    assert {r["lang_pred"] for r in language_id.identify_languages(odd, empty).collect()} == {"und"}


def test_language_scores_against_plain_counts(spark, sf, texts, monkeypatch):
    """Held-out scores and verdicts are those of a naive Bayes written with dictionaries."""
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = {r["doc_id"]: r for r in queries.QUERIES["op8_language_id"](spark, sf).collect()}
    buckets = 1 << 15

    def grams(text):
        padded = [ord(c) for c in f" {text}  ".lower()]
        out = []
        for k in range(len(padded) - 2):
            acc = 0
            for c in padded[k : k + 3]:
                acc = (acc ^ c) * 0x9E3779B1 & 0xFFFFFFFF
                acc ^= acc >> 15
                out.append((acc * 0x9E3779B1 & 0xFFFFFFFF) >> 17)
        return out

    learned = {i: t for i, t in texts.items() if t and lang[i] and zlib.crc32(str(i).encode()) % 4 != 2}
    names = sorted({lang[i] for i in learned})
    counts = {x: Counter() for x in names}
    for i, t in learned.items():
        counts[lang[i]].update(grams(t))
    sizes = {x: sum(c.values()) + 0.1 * buckets for x, c in counts.items()}
    share = Counter(lang[i] for i in learned)
    for i in list(texts)[:60]:
        z = [math.log(share[x] / len(learned)) + sum(math.log((counts[x][g] + 0.1) / sizes[x]) for g in grams(texts[i])) for x in names]
        assert rows[i]["lang_pred"] == names[int(np.argmax(z))]
        assert abs(rows[i]["score"] - 1 / sum(math.exp(v - max(z)) for v in z)) < 0.02

    # a long text in segments scores as in one
    model = language_id.LanguageModel(names, np.log(np.random.default_rng(0).random((buckets, len(names))) + 0.1).astype(np.float32), np.zeros(len(names)))
    long = [" ".join(texts.values())[:50_000], "short one", ""]
    whole = model.score(long)
    monkeypatch.setattr(language_id, "_HELD", 4096)
    parts = model.score(long)
    assert whole[0] == parts[0] and np.allclose(whole[1], parts[1])


def test_token_files_round_trip(spark, sf, texts):
    rows = {r["doc_id"]: r for r in queries.QUERIES["op9_token_files"](spark, sf).collect()}
    ids = sorted(texts)
    at = 0
    for i, want in zip(ids, encoded("byte_bpe_50k.json", [texts[i] for i in ids], 0), strict=True):
        assert (rows[i]["start"], rows[i]["n_tokens"], rows[i]["ids_crc32"]) == (at, len(want), zlib.crc32(want.tobytes()))
        at += len(want)


def test_token_files_many_shards_and_single_documents(spark, sf, texts):
    path = new_path(spark, "tokens")
    token_files.write_token_files(spark.read.parquet(f"{sf}/documents.parquet"), path, bucket_docs=30, shard_bytes=4000)
    rows = token_files.read_token_files(spark, path).orderBy("start").collect()
    assert [r["doc_id"] for r in rows] == sorted(texts)
    one = token_files.read_document(spark, path, 17).collect()
    assert len(one) == 1 and one[0]["ids"] == rows[17]["ids"]
    assert token_files.read_document(spark, path, None).count() == token_files.read_document(spark, path, -5).count() == 0
    assert spark.read.parquet(f"{path}/dictionary").first()["dictionary"] == hashlib.sha256(spark.read.parquet(f"{path}/dictionary").first()["content"]).hexdigest()


def test_token_files_odd_rows(spark, odd, none):
    path = new_path(spark, "tokens")
    token_files.write_token_files(odd, path)
    rows = token_files.read_token_files(spark, path).orderBy("start").collect()
    assert token_files.read_document(spark, path, 4).count() == 2 and token_files.read_document(spark, path, None).first()["ids"] == rows[0]["ids"]
    assert len(rows) == odd.count() and rows[0]["doc_id"] is None and all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(rows, rows[1:], strict=False))
    path = new_path(spark, "tokens")
    token_files.write_token_files(none, path)
    assert token_files.read_token_files(spark, path).count() == 0


def test_token_files_spread_one_id(spark):
    path = new_path(spark, "tokens")
    docs = spark.range(200).select(F.when(F.col("id") > 60, F.col("id") % 2).alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    token_files.write_token_files(docs, path, bucket_docs=20)
    assert spark.read.parquet(f"{path}/shards").filter("last_doc = 1").select("bucket").distinct().count() > 2
    rows = token_files.read_token_files(spark, path).orderBy("start").collect()
    assert [r["doc_id"] for r in rows] == [None] * 61 + [0] * 69 + [1] * 70 and all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(rows, rows[1:], strict=False))


def test_special_tokens_can_be_text():
    from tokenizers import Tokenizer

    path, text = tokens.vocabulary("byte_bpe_50k.json"), "x <|endoftext|> y"
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    assert tokens.Encoder(path, special_as_text=True).ids([text])[0] == np.array(t.encode(text, add_special_tokens=False).ids, "<u4").tobytes() != tokens.Encoder(path).ids([text])[0]


def der(tag, content):
    n = len(content)
    size = bytes([n]) if n < 128 else bytes([0x80 | len(b := n.to_bytes((n.bit_length() + 7) // 8, "big"))]) + b
    return bytes([tag]) + size + content


def openssh(cipher=b"none", kdf=b"none", keys=1):
    block = lambda b: len(b).to_bytes(4, "big") + b
    return b"openssh-key-v1\0" + block(cipher) + block(kdf) + block(b"") + keys.to_bytes(4, "big") + block(b"p" * 51) * keys + block(b"s" * 136)


def test_key_containers_are_parsed_to_their_ends():
    spans = lambda t: [(t[a:z], k) for a, k, z in secrets.secret_spans(t) if k != "hex"]
    for keys in (1, 2, 3):
        one = base64.b64encode(openssh(b"aes256-ctr", b"bcrypt", keys)).decode()
        broken = "\\n".join(one[k : k + 70] for k in range(0, len(one), 70))
        assert spans(f"x{one}") == spans(f"x{one}y z") == [(one, "openssh")] and spans(f"{broken} {one}") == [(broken, "openssh"), (one, "openssh")]
        assert spans(one[:-8]) == [] and spans(one[:20]) == []
    assert spans("b3BlbnNzaC1rZXktdjEAAAAA") == [] and spans(base64.b64encode(openssh(b"\n", b"none")).decode()) == []
    assert spans(base64.b64encode(b"openssh-key-v1\0" + b"\xff" * 300).decode()) == []


def test_keys_stand_anywhere():
    key = der(0x30, der(2, b"\0") + der(2, bytes(range(1, 128)) + b"x" * 40) + der(2, b"\1\0\1"))
    b64, spans = base64.b64encode(key).decode(), lambda t: [(t[a:z], k) for a, k, z in secrets.secret_spans(t) if k == "der"]
    for before in ("", "a", "ab", "Mab", "/x9", "MIIE"):
        assert spans(before + b64 + "\n") == [(b64, "der")]
    assert spans(b64 + b64) == [(b64, "der")] * 2
    for before in ("0", "30", "3030", "abcdef1", "30820001"):
        assert spans(before + key.hex() + "0" * 9) == [(key.hex(), "der")]
    deep = der(2, b"\1")
    for _ in range(40):
        deep = der(0x30, deep)
    nested = der(0x30, der(2, b"\0") + der(0x30, der(6, b"\x2b\x65\x70") + deep) + der(4, b"k" * 32))
    assert spans(base64.b64encode(nested).decode().rstrip("=") + " ")[0][1] == "der"
    request = der(0x30, der(2, b"\0") + der(0x30, der(0x31, b"")) + der(0x30, der(0x30, der(6, b"\x2a")) + der(3, b"k" * 60)) + der(0xA0, b""))
    assert spans(base64.b64encode(request).decode()) == []


def test_hostile_texts_take_linear_time():
    rng = np.random.default_rng(8)
    plain = base64.b64encode(rng.bytes(7_500_000)).decode()
    texts = [
        plain,
        "\n".join(plain[k : k + 76] for k in range(0, len(plain), 76)),
        "MIIEabcdefgh\n" * 80_000,
        "eyJ" * 300_000,
        "eyJ" * 3000 + ".ab.cd",
        "30" * 500_000,
        "-----BEGIN PRIVATE KEY-----" * 40_000,
        "MIL//wIBAAQC" * 80_000,
    ]
    for t in texts:
        began = time.process_time()
        secrets.secret_spans(t)
        assert time.process_time() - began < 12, t[:30]
    nest = base64.urlsafe_b64encode(b'{"alg":' + b"[" * 200_000).decode().rstrip("=")
    assert secrets.secret_spans(f"{nest}.ab.cd") == [] and secrets.der_items(b"\x30\x80" * 9000) is None


def test_secret_structures():
    key = der(0x30, der(2, b"\0") + der(2, bytes(range(1, 128)) + b"x" * 40) + der(2, b"\1\0\1"))
    spki = der(0x30, der(0x30, der(6, b"\x2a\x86\x48\x86\xf7\x0d\x01\x01\x01") + der(5, b"")) + der(3, b"\0" + b"k" * 60))
    token = ".".join(base64.urlsafe_b64encode(x).decode().rstrip("=") for x in (json.dumps({"alg": "HS256"}).encode(), b'{"sub":1}', b"sig" * 9))
    b64 = base64.b64encode(key).decode()
    pem = f"-----BEGIN RSA PRIVATE KEY-----\n{b64[:64]}\n{b64[64:]}\n-----END RSA PRIVATE KEY-----"
    ssh = base64.b64encode(openssh()).decode()
    kinds = lambda t: [k for _, k, _ in secrets.secret_spans(t)]
    assert kinds(f"x {b64} y") == ["der"] and kinds(f"x {base64.b64encode(spki).decode()} y") == []
    assert kinds(f"path/key/{b64}/more {b64[:50]}") == ["der"] and kinds(f"{b64[:64]}\n  {b64[64:128]}\\n{b64[128:]} y") == ["der"]
    x = f"a {b64[:60]}\r\n{b64[60:]}, b"
    assert [x[a:z] for a, _, z in secrets.secret_spans(x)] == [x[2:-3]]
    eddsa = der(0x30, der(2, b"\0") + der(0x30, der(6, b"\x2b\x65\x70")) + der(4, der(4, bytes(range(32)))))
    locked = der(0x30, der(0x30, der(6, b"\x2a\x86\x48") + der(0x30, b"")) + der(4, b"c" * 40))
    for k in (eddsa, locked):
        assert kinds(base64.b64encode(k).decode()) == kinds(base64.urlsafe_b64encode(k).decode().rstrip("=")) == kinds(k.hex() + "zz")[-1:] == ["der"]
    none = ".".join(base64.urlsafe_b64encode(x).decode().rstrip("=") for x in (json.dumps({"alg": "none"}).encode(), b'{"sub":1}', b"sig" * 9))
    assert kinds(none) == kinds(token.rsplit(".", 1)[0] + ".") == []
    armour = "-----BEGIN RSA PRIVATE KEY-----{0}Proc-Type: 4,ENCRYPTED{0}DEK-Info: AES-128-CBC,00{0}{0}{1}{0}-----END RSA PRIVATE KEY-----"
    assert all(kinds(armour.format(x, base64.b64encode(b"c" * 64).decode())) == ["pem"] for x in ("\n", "\r\n", "\\n"))
    assert kinds("-----BEGIN PRIVATE KEY-----" + base64.b64encode(b"c" * 64).decode() + "-----END PRIVATE KEY-----") == []
    assert "pem" in kinds(pem.replace("\n", "\\n"))
    assert "pem" in kinds(pem) and kinds(f"a {ssh}") == ["openssh"] and kinds(f"t {token} u") == ["jwt"]
    assert "der" in kinds(key.hex().upper())
    assert kinds("x " + base64.b64encode(b"0" + bytes(60)).decode()) == [] and kinds("eyJhbGciO.not.signed") == []
    assert kinds("token=token:abcdefg secret: abc password=\"hunter22\"") == ["assign"]


def test_secret_scan(spark, sf, texts):
    rows = {r["doc_id"]: r for r in queries.QUERIES["op10_secret_scan"](spark, sf).collect()}
    rx = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
    for i, t in texts.items():
        base = [(m.start(), 0, "assign", m.end()) for m in rx.finditer(t) if len(m[1]) >= 6]
        base += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        base += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        text = ",".join(f"{k}:{a}:{z}" for a, _, k, z in sorted(base))
        assert rows[i]["base_sha256"] == hashlib.sha256(text.encode()).hexdigest() and set(text.split(",")) - {""} <= set(rows[i]["spans"].split(","))


def test_secret_odd_rows(spark, odd, none):
    assert secrets.find_secrets(odd).count() == odd.count() and secrets.find_secrets(none).count() == 0
    df = spark.createDataFrame([(1, "a 😀 token = \"abcdef123\" b", 25, "k"), (2, None, 0, "k")], "doc_id long, text string, n_chars long, kept string")
    rows = {r["doc_id"]: r for r in secrets.redact(df).collect()}
    assert rows[1]["text"] == 'a 😀 [secret]" b' and rows[1]["n_chars"] == len(rows[1]["text"]) and rows[2]["text"] is None


def test_pipeline(spark, sf, texts):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, inputs = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        inputs[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
        path = new_path(spark, f"test-{name}")
        stage(spark, docs, sf).write.parquet(path)
        docs = spark.read.parquet(path)
        if name != "packing":
            assert docs.columns == columns
    _, roots = components(inputs["near_dedup"])
    assert set(inputs["decontamination"]) == {i for i, r in roots.items() if i == r}
    assert set(inputs["packing"]) == set(inputs["secrets"]) <= set(inputs["decontamination"])
    assert not any(re.search(r"[0-9a-f]{24,}", t) for t in inputs["packing"].values())
    final = docs.collect()
    assert {r["doc_id"] for r in final} == set(inputs["packing"])
    order = sorted(inputs["packing"])
    check_packing(final, list(zip(order, encoded("word_bpe_49k.json", [inputs["packing"][i] for i in order], 1), strict=True)))


def test_pipeline_run_and_odd_rows(spark, sf, odd, none):
    import corpus_pipeline

    rows = corpus_pipeline.run(spark, sf).collect()
    assert rows and {"doc_id", "piece", "sequence_id", "offset", "length"} <= set(rows[0].asDict())
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, odd, sf)
        assert stage(spark, none, sf).count() == 0
        if name == "packing":
            assert {r["doc_id"] for r in out.collect()} == {None, *range(1, 9)}
        else:
            assert out.columns == odd.columns and {r["doc_id"] for r in out.collect()} >= {None, 1, 4, 5, 7}


def test_ids_of_letters_that_normalisation_takes_apart():
    """Chunks over many scripts, with marks, presentation forms and punctuation, against plain library calls."""
    rng = np.random.default_rng(12)
    letters = "aZé0 9.,!?;:'\"()-\n" + "ड़ढ़बपक़ि्" + "שּשׁאבּתּ" + "Å̊éñẛ̣" + "힣ᄀ가각" + "İΣσς" + "ﬁ½²" + "中文字。、" + "абвй" + "عربيﷺ" + "ไทย" + "😀‍́"
    sample = ["".join(rng.choice(list(letters), rng.integers(1, 24))) for _ in range(100_000)]
    sample += ["बड़,", "(बड़)", "पढ़.", "שּ,", "́a", "a ́b", "ड़" * 50 + "."]
    from tokenizers import Tokenizer

    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        path = tokens.vocabulary(name)
        want = [np.array(e.ids, "<u4").tobytes() for e in Tokenizer.from_file(path).encode_batch_fast(sample, add_special_tokens=False)]
        assert tokens.Encoder(path).ids(sample) == want


def test_revisits_with_clashing_headers_and_queries(spark):
    ddl = "record_id long, url string, captured timestamp, kind string, etag string, last_modified string, digest string, headers map<string,string>, body string"
    t = lambda n: __import__("datetime").datetime(2024, 1, 1, 0, n)
    rows = [
        (1, "http://a/y?u=/", t(1), "response", "e", None, "d", {"Set-Cookie": "1", "set-cookie": "2", "ETag": "x"}, "slash"),
        (2, "http://a/y/", t(2), "response", "e", None, "d", {"A": None, "a": "low"}, "bare"),
        (3, "http://a/y?u=", t(5), "revisit", "e", None, "d", {"DATE": "1", "Date": "2", "date": "3"}, None),
        (4, "http://www.a/y", t(6), "revisit", "e", None, "d", {"DATE": "1", "Date": "2", "date": "3"}, None),
        (5, "http://a/y?u=/", t(7), "revisit", "e", None, "d", {}, None),
        (6, "http://a/y?u=/", t(8), "revisit", "e", None, "d", None, None),
    ]
    got = {r["record_id"]: r for r in revisits.resolve_revisits(spark.createDataFrame(rows, ddl)).collect()}
    assert got[3]["status"] == "no_response" and got[4]["body"] == "bare" and got[5]["body"] == got[6]["body"] == "slash"
    assert got[4]["headers"] == {"a": "low", "date": "3"} and got[5]["headers"] == {"set-cookie": "2", "etag": "x"}


def test_sample_is_bounded_by_rows(spark, tmp_path):
    docs = spark.createDataFrame([(k % 4, f"text {k} you fool") for k in range(900)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(4)], "doc_id long, toxic int")
    seen = []
    real = toxicity.written

    def spy(df, name):
        out = real(df, name)
        if name == "toxicity-sample":
            seen.append(out.count())
        return out

    toxicity.written = spy
    try:
        toxicity.fit_grammar(docs, labels, sample_rows=10)
    finally:
        toxicity.written = real
    assert seen == [4]


def test_a_document_with_the_whole_benchmark(spark):
    items = spark.createDataFrame([(k, f"what is the sum of {k} and {k + 3} if item number {k} costs {k} coins in the town of q{k}z") for k in range(60)], "item_id long, text string")
    docs = spark.createDataFrame([(i, "\n".join(r["text"] for r in items.collect())) for i in range(3)], "doc_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontamination.contaminated(docs, items).collect()}
    assert found == {(i, k) for i in range(3) for k in range(60)}
