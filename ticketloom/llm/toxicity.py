"""Toxicity by a weighted finite-state pattern grammar.

Words become classes: insult, threat, target, negation, report, or other; a class carries a mark
if a clause ends after the word. Three small weighted transducers read the classes of a clause and are
composed into one (``compose``):

- ``negation``: within three words after a negation, what follows weighs little;
- ``reported``: after a word of reporting, the rest of the clause weighs half;
- ``addressed``: an insult weighs more once somebody is addressed; a threat weighs only with a target,
  before it or after it (until then its weight waits).

A clause's score is the sum of its weighted matches. Only clauses with an insult or a threat are read.
A document is scored by a logistic function of its total and of its best clause.

Insults are learned from labelled rows: whole words and word beginnings of 4 to 7 letters whose
documents are toxic far more often than others, chosen greedily so that each toxic document is
covered up to three times, which leaves out words that only come along. Threats are learned from the
toxic documents that no insult covers: words that go with toxic labels where their clause has a target,
but not by themselves. At most ``sample_rows`` labelled documents of each label are used (smallest id
hash); that is the only bound.

Cases: null, empty and blank texts have no clause and get the base score; without labels the built-in
lists alone are used; very long texts are scored whole, clause by clause; repeated rows and null ids are
scored as they come; an empty table gives an empty result; other columns are ignored (``reject_toxic`` keeps them).
"""

from __future__ import annotations

import math
import string
from collections import Counter
from collections.abc import Hashable, Iterable, Iterator
from dataclasses import dataclass, field
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.session import bounded_batches, table, written

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)

#: Closed word classes of the four languages of the corpus, and insults that need no learning.
LISTS = {
    THREAT: "kill hurt destroy punch stab beat umbringen töten schlagen verprügeln tuer frapper matar golpear",
    TARGET: "you your you're u they them he she du dich dir ihr euch sie tu te toi vous ils tú usted vosotros ellos",
    NEGATION: "not never no isn't aren't don't nicht nie kein keine pas jamais non nunca jamás",
    REPORT: "said says called calls wrote quoted quote claimed sagte schrieb nannte disait écrit appelé dijo escribió llamó",
    INSULT: "idiot moron imbecile scumbag dumbass",
}
WORD_CLASS = {w: c for c, words in LISTS.items() for w in words.split()}

_EDGE = string.punctuation + "«»“”„‚‘’¡¿…"
_ENDS = (".", "!", "?", ";", ":")


@dataclass(frozen=True)
class Transducer:
    """Deterministic and weighted: (state, symbol) -> (next state, output symbol, weight)."""

    start: Hashable
    step: dict[tuple[Hashable, Hashable], tuple[Hashable, Hashable, float]]

    def run(self, symbols: Iterable[Hashable]) -> list[tuple[Hashable, float]]:
        state, out = self.start, []
        for symbol in symbols:
            state, given, weight = self.step[state, symbol]
            out.append((given, weight))
        return out


def compose(first: Transducer, second: Transducer) -> Transducer:
    """Reads what first reads and gives what second makes of first's output; weights are multiplied.
    Only states that can be reached are made."""
    symbols = {c for _, c in first.step}
    start = (first.start, second.start)
    step, todo, seen = {}, [start], {start}
    while todo:
        here = todo.pop()
        for c in symbols:
            to, between, weight = first.step[here[0], c]
            after, given, more = second.step[here[1], between]
            step[here, c] = ((to, after), given, weight * more)
            if (to, after) not in seen:
                seen.add((to, after))
                todo.append((to, after))
    return Transducer(start, step)


#: What the grammar tells of a word: nothing, a match, a match that waits for a target, that target.
NOTHING, MATCH, WAIT, RELEASE = range(4)


def negation(reach: int = 3, weight: float = 0.15) -> Transducer:
    """Passes classes on; the ``reach`` words after a negation weigh little."""
    return Transducer(0, {(left, c): (reach if c == NEGATION else max(left - 1, 0), c, weight if left else 1.0) for left in range(reach + 1) for c in range(6)})


def reported(weight: float = 0.5) -> Transducer:
    """Passes classes on; what comes after a word of reporting weighs less."""
    return Transducer(False, {(told, c): (told or c == REPORT, c, weight if told else 1.0) for told in (False, True) for c in range(6)})


def addressed(weight: float = 1.5) -> Transducer:
    """Classes to matches; states are (somebody is addressed, a threat waits)."""
    step = {}
    for seen, waits in product((False, True), repeat=2):
        for c in range(6):
            if c == TARGET:
                step[(seen, waits), c] = ((True, False), RELEASE if waits else NOTHING, 1.0)
            elif c == INSULT:
                step[(seen, waits), c] = ((seen, waits), MATCH, weight if seen else 1.0)
            elif c == THREAT:
                step[(seen, waits), c] = ((seen, waits or not seen), MATCH if seen else WAIT, 1.0)
            else:
                step[(seen, waits), c] = ((seen, waits), NOTHING, 1.0)
    return Transducer((False, False), step)


GRAMMAR = compose(compose(negation(), reported()), addressed())


def _tables(machine: Transducer) -> tuple[list[list[int]], list[list[int]], list[list[float]]]:
    """The transducer with numbered states, the start first: next states, outputs, weights by [state][class]."""
    number = {machine.start: 0}
    for state, _ in machine.step:
        number.setdefault(state, len(number))
    rows = [[machine.step[state, c] for c in range(6)] for state in number]
    return [[number[x[0]] for x in r] for r in rows], [[x[1] for x in r] for r in rows], [[x[2] for x in r] for r in rows]


STEP, GIVEN, WEIGHT = _tables(GRAMMAR)


@dataclass
class Grammar:
    """Insult words and beginnings and threat words with weights, and the logistic function on top."""

    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    threats: dict[str, float] = field(default_factory=dict)
    bias: float = -2.5
    by_total: float = 1.5
    by_best: float = 1.5

    def __post_init__(self) -> None:
        self._codes: dict[str, int] = {}
        self._weights: dict[str, float] = {}

    def insult_weight(self, word: str) -> float:
        found = self.words.get(word, 0.0)
        for k in range(4, min(len(word), 7) + 1):
            found = max(found, self.stems.get(word[:k], 0.0))
        return found

    def _code(self, raw: str) -> int:
        """Twice the class, plus one if a clause ends here."""
        word = raw.strip(_EDGE)
        weight = self.insult_weight(word)
        c = INSULT if weight else THREAT if word in self.threats else WORD_CLASS.get(word, OTHER)
        if c in (INSULT, THREAT):
            self._weights[raw] = weight or self.threats.get(word, 1.0)
        if len(self._codes) > 200_000:
            self._codes.clear()
        code = self._codes[raw] = 2 * c + raw.endswith(_ENDS)
        return code

    def clauses(self, text: str) -> list[float]:
        """Scores of the clauses that hold an insult or a threat."""
        words, known = text.lower().split(), self._codes
        try:
            codes = bytes(map(known.__getitem__, words))
        except KeyError:
            codes = bytes([known[w] if w in known else self._code(w) for w in words])
        hits = codes.translate(None, b"\0\1\6\7\x08\x09\x0a\x0b")  # what is left: insults and threats
        if not hits:
            return []
        out, start, n = [], 0, len(codes)
        marks = [i for i, c in enumerate(codes) if c >> 1 in (INSULT, THREAT)]
        at = 0
        while at < len(marks):
            start = marks[at]
            while start and not codes[start - 1] & 1:
                start -= 1
            i, state, score, waiting = start, 0, 0.0, 0.0
            while i < n:
                c = codes[i] >> 1
                given = GIVEN[state][c]
                if given == RELEASE:
                    score, waiting = score + waiting, 0.0
                elif given:
                    weight = WEIGHT[state][c] * self._weights.get(words[i], 1.0)
                    if given == MATCH:
                        score += weight
                    else:
                        waiting += weight
                state = STEP[state][c]
                i += 1
                if codes[i - 1] & 1:
                    break
            out.append(score)
            while at < len(marks) and marks[at] < i:
                at += 1
        return out

    def measures(self, text: str | None) -> tuple[float, float]:
        found = self.clauses(text or "")
        return (math.log1p(sum(found)), min(max(found), 3.0)) if found else (0.0, 0.0)

    def score(self, text: str | None) -> float:
        total, best = self.measures(text)
        return 1 / (1 + math.exp(-(self.bias + self.by_total * total + self.by_best * best)))


def beginnings(text: str) -> set[str]:
    """Whole words (marked $) and beginnings of 4 to 7 letters, as features of a document; words
    whose clause has a target once more, marked @."""
    raw = text.lower().split()
    bare = [w.strip(_EDGE) for w in raw]
    words = set(bare)
    out = {w + "$" for w in words if len(w) >= 2}
    for k in (4, 5, 6, 7):
        out.update({w[:k] for w in words if len(w) >= k})
    start = 0
    for i, w in enumerate(raw):
        if w.endswith(_ENDS) or i == len(raw) - 1:
            clause = bare[start : i + 1]
            if any(WORD_CLASS.get(x) == TARGET for x in clause):
                out.update(f"@{x}$" for x in clause if len(x) >= 2)
            start = i + 1
    return out


def _feature_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    toxic, clean = Counter(), Counter()

    def out() -> pa.RecordBatch:
        names = list(toxic.keys() | clean.keys())
        return pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array([toxic[x] for x in names], pa.int64()), pa.array([clean[x] for x in names], pa.int64())], ["feature", "pos", "neg"]
        )

    for batch in batches:
        for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            (toxic if y else clean).update(beginnings(text or ""))
        if len(toxic) + len(clean) > 500_000:
            yield out()
            toxic.clear()
            clean.clear()
    yield out()


def _with_features(wanted: set[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(wanted & beginnings(t or "")) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.string())), batch.column(1)], ["features", "y"])

    return run


def _measured(grammar: Grammar):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [grammar.measures(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.float64()), pa.array([r[1] for r in rows], pa.float64()), batch.column(1)], ["total", "best", "y"])

    return run


def _choose(rows: list[tuple[list[str], int]], odds: dict[str, float], least: int, cover: int = 3) -> list[str]:
    """Greedy cover: the feature that adds most to toxic documents covered fewer than ``cover``
    times, less what it takes from clean ones, until that is below ``least``."""
    docs = [set(f) for f, y in rows if y]
    times = [0] * len(docs)
    of: dict[str, list[int]] = {}
    for i, f in enumerate(docs):
        for x in f:
            of.setdefault(x, []).append(i)
    clean = Counter(x for f, y in rows if not y for x in f)
    chosen: list[str] = []
    while of:
        gain = {x: sum(times[i] < cover for i in at) - 3 * clean[x] for x, at in of.items()}
        best = max(gain, key=lambda x: (gain[x], odds[x], -len(x), x))
        if gain[best] < least:
            break
        chosen.append(best)
        for i in of.pop(best):
            times[i] += 1
        of = {x: at for x, at in of.items() if not (x.startswith(best) or best.rstrip("$").startswith(x.rstrip("$")))}
    return chosen


def _fit_logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50, ridge: float = 1e-2) -> np.ndarray:
    a = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(a.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = (a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(len(w))
        d = np.linalg.solve(h, a.T @ (y - p) - ridge * w)
        w += d
        if np.abs(d).max() < 1e-8:
            break
    return w


def fit_grammar(docs: DataFrame, labels: DataFrame, sample_rows: int = 8000) -> Grammar:
    """Learn insults, threats and the logistic function from docs(doc_id, text) and labels(doc_id,
    toxic). Everything that reaches the driver is of at most 2 * sample_rows documents: of an id that
    several rows share, the row with the least hash of its text counts."""
    bounded_batches(docs.sparkSession)
    known = labels.filter("toxic is not null and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("toxic") > 0).cast("int").alias("y"))
    known = known.groupBy("doc_id").agg(F.max("y").alias("y"))
    parts = [known.filter(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows) for y in (0, 1)]
    drawn = parts[0].unionByName(parts[1])  # at most 2 * sample_rows ids
    # hashes travel through the aggregation, texts only of rows that were chosen
    met = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("hash"), "text").join(F.broadcast(drawn), "doc_id")
    ids = met.groupBy("doc_id").agg(F.min("hash").alias("hash"))
    chosen_rows = met.join(F.broadcast(ids), ["doc_id", "hash"]).groupBy("doc_id").agg(F.first("text").alias("text"), F.first("y").alias("y"))
    sample = written(chosen_rows.select("text", "y"), "toxicity-sample")
    sizes = {r["y"]: r["count"] for r in sample.groupBy("y").count().collect()}
    pos, neg = sizes.get(1, 0), sizes.get(0, 0)
    seeds = {w: 1.0 for w in LISTS[INSULT].split()}
    if pos < 5 or neg < 5:
        return Grammar(seeds)
    least = max(4, round(0.006 * pos))
    log_odds = F.log((F.col("pos") + 0.5) / (pos + 1)) - F.log((F.col("neg") + 0.5) / (neg + 1))
    counts = sample.mapInArrow(_feature_counts, "feature string, pos long, neg long").groupBy("feature").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    found = counts.filter(F.col("pos") >= least).withColumn("odds", log_odds).filter("odds >= 3").collect()
    odds = {r["feature"]: r["odds"] for r in found}
    rows = [(r["features"], r["y"]) for r in sample.mapInArrow(_with_features(set(odds)), "features array<string>, y int").filter(F.size("features") > 0).collect()]
    chosen = _choose([([x for x in f if x[0] != "@"], y) for f, y in rows], odds, least)
    # what insults leave: words that tell only with a target in their clause
    told = {x for x in odds if x[0] == "@" and x[1:] not in odds}
    bare = [([x for x in f if x in told], y) for f, y in rows if not (y and not set(chosen).isdisjoint(f))]
    threats = _choose(bare, odds, least)
    top = max((odds[x] for x in chosen + threats), default=1.0)
    words = seeds | {x[:-1]: odds[x] / top for x in chosen if x.endswith("$")}
    stems = {x: odds[x] / top for x in chosen if not x.endswith("$")}
    learned = (words, stems, {x[1:-1]: odds[x] / top for x in threats})
    drawn_rows = sample.mapInArrow(_measured(Grammar(*learned)), "total double, best double, y int").toArrow()
    x = np.column_stack([drawn_rows["total"].to_numpy(), drawn_rows["best"].to_numpy()])
    w = _fit_logistic(x, drawn_rows["y"].to_numpy().astype(float))
    return Grammar(*learned, *map(float, w))


def _scored(grammar: Grammar):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [grammar.score(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return run


def score_toxicity(docs: DataFrame, grammar: Grammar, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) for every row of docs."""
    bounded_batches(docs.sparkSession)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(_scored(grammar), "doc_id long, score double")


def reject_toxic(docs: DataFrame, grammar: Grammar, text_col: str = "text", limit: float = 0.5) -> DataFrame:
    """docs, with all its columns, without rows that score at or above the limit."""
    bounded_batches(docs.sparkSession)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([grammar.score(t) < limit for t in batch.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def fold(modulus: int) -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(modulus))


def _trained(spark: SparkSession, docs: DataFrame, sf_dir: str) -> Grammar:
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return fit_grammar(source, table(spark, sf_dir, "labels").filter(fold(5) != 0))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score_toxicity(docs, _trained(spark, docs, sf_dir))
    return scored.select("doc_id", F.coalesce(fold(5) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that the grammar scores as toxic go."""
    return reject_toxic(docs, _trained(spark, docs, sf_dir))
