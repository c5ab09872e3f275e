"""Quality by weak supervision, in DataFrame functions only.

Rules vote good (1), bad (-1) or abstain (0) from counts of the whole text. The frequencies of vote
patterns (at most 3 to the number of rules, whatever the corpus) are all that expectation-
maximisation needs. Documents that fail the base counts are left out of them, else their kind would
make up the class of bad ones. It estimates each rule's vote rates among good and bad documents and the share
of good ones. The posterior of a document is then a sum of log-ratios, a Spark expression.

Cases: null text is empty text; no words means no votes from ratios and ``base_failed``; repeated
rows each count; null ids are kept; an empty table gives an empty result (the prior rates are used);
other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.session import table, written

#: White space of the word definition, as a Java character class body.
_WS = r"\x20\x09-\x0D"

#: name: (measure, bad from this value on, good up to this value)
RULES: dict[str, tuple[str, float, float]] = {
    "symbols": ("n_symbols / greatest(word_chars, 1)", 0.05, 0.01),
    "repeats": ("n_repeat_words / greatest(n_words, 1)", 0.30, 0.08),
    "lines": ("n_dup_lines / greatest(n_lines, 1)", 0.34, 0.05),
    "capitals": ("n_capitals / greatest(word_chars, 1)", 0.30, 0.10),
    "shouts": ("n_shouts / greatest(n_words, 1)", 0.20, 0.02),
    "variety": ("1 - n_distinct / greatest(n_words, 1)", 0.80, 0.65),
    "digits": ("n_digits / greatest(word_chars, 1)", 0.25, 0.05),
    "length": ("abs(word_chars / greatest(n_words, 1) - 6.5)", 5.0, 2.5),
}


def text_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of each whole text."""
    text = F.col("text")

    def without(chars: str) -> Column:
        return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("long")

    split = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).select(
        "doc_id",
        "text",
        F.array_remove(F.split(text, f"[{_WS}]+"), "").alias("words"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{_WS}]")).alias("lines"),
    )
    measured = split.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        without("#*$%&|<>").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").cast("long").alias("n_lines"),
        F.length(F.regexp_replace(text, r"[^\p{Lu}]+", "")).cast("long").alias("n_capitals"),
        without("!").alias("n_shouts"),
        without("0123456789").alias("n_digits"),
        F.size(F.array_distinct("words")).cast("long").alias("n_distinct"),
        F.when(
            F.size("words") >= 3,
            F.transform(F.sequence(F.lit(1), F.size("words") - 2), lambda i: F.xxhash64(F.element_at("words", i), F.element_at("words", i + 1), F.element_at("words", i + 2))),
        )
        .otherwise(F.array().cast("array<bigint>"))
        .alias("windows"),
    )
    # sorted by (hash, place), equal windows are neighbours; then the places that they cover
    ordered = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def repeated(s: Column) -> Column:
        last = F.size(s) - 1

        def place(e: Column, k: Column) -> Column:
            before = F.when(k > 0, F.get(s, k - 1)["h"] == e["h"]).otherwise(False)
            after = F.when(k < last, F.get(s, k + 1)["h"] == e["h"]).otherwise(False)
            return F.when(before | after, e["i"])

        return F.sort_array(F.filter(F.transform(s, place), lambda i: i.isNotNull()))

    start = F.struct(F.lit(-3).alias("last"), F.lit(0).alias("covered"))
    covered = F.aggregate(
        F.element_at(F.transform(F.array(ordered), repeated), 1),
        start,
        lambda acc, i: F.struct(i.alias("last"), (acc["covered"] + F.least(F.lit(3), i - acc["last"])).alias("covered")),
        lambda acc: acc["covered"],
    )
    some = F.size(F.array_distinct("windows")) < F.size("windows")
    return measured.withColumn("n_repeat_words", F.when(some, covered).otherwise(0).cast("long")).drop("windows")


def votes() -> dict[str, Column]:
    return {
        name: F.when(F.col("n_words") == 0, 0).when(F.expr(measure) >= bad, -1).when(F.expr(measure) <= good, 1).otherwise(0)
        for name, (measure, bad, good) in RULES.items()
    }


def estimate(
    patterns: list[tuple[tuple[int, ...], int]], rules: int, rounds: int = 200, prior: float = 0.85, most_false: float = 0.02
) -> tuple[float, list[dict[int, tuple[float, float]]]]:
    """(share of good documents, for each rule: vote -> (rate among good, rate among bad)) from the
    frequencies of vote patterns. Rates are those among votes cast: abstaining is no evidence. A rule
    is taken to call at most ``most_false`` of the good documents bad, which keeps the two classes
    from changing places or splitting along something else."""
    rates = [{1: (0.998, 0.85), 0: (1.0, 1.0), -1: (0.002, 0.15)} for _ in range(rules)]
    for _ in range(rounds):
        cast = [[0.0, 0.0, 0.0, 0.0] for _ in range(rules)]  # good: all, bad ones; bad: all, bad ones
        n_good = n_bad = 1.0
        for pattern, n in patterns:
            z = math.log(prior / (1 - prior)) + sum(math.log(rates[k][v][0] / rates[k][v][1]) for k, v in enumerate(pattern))
            p = n / (1 + math.exp(-max(min(z, 500.0), -500.0)))
            n_good, n_bad = n_good + p, n_bad + n - p
            for k, v in enumerate(pattern):
                if v:
                    cast[k][0] += p
                    cast[k][1] += p * (v < 0)
                    cast[k][2] += n - p
                    cast[k][3] += (n - p) * (v < 0)
        new = []
        for all_good, wrong, all_bad, right in cast:
            g = min((wrong + 0.002) / (all_good + 1), most_false)
            b = min(max((right + 0.15) / (all_bad + 1), g), 0.98)
            new.append({1: (1 - g, 1 - b), 0: (1.0, 1.0), -1: (g, b)})
        moved = max((abs(new[k][-1][i] - rates[k][-1][i]) for k in range(rules) for i in (0, 1)), default=0)
        rates, prior = new, n_good / (n_good + n_bad)
        if moved < 1e-9:
            break
    return prior, rates


def judge_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5) -> DataFrame:
    """Counts, votes and posterior quality probability of every row of docs, and the verdict."""
    names = list(RULES)
    counted = written(text_counts(docs, id_col, text_col), "quality-counts")
    voted = counted.withColumns({f"vote_{n}": v for n, v in votes().items()})
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    seen = voted.filter(~failed).groupBy([f"vote_{n}" for n in names]).agg(F.count(F.lit(1)).alias("n")).collect()
    prior, rates = estimate(sorted((tuple(r[f"vote_{n}"] for n in names), r["n"]) for r in seen), len(names))
    z: Column = F.lit(math.log(prior / (1 - prior)))
    for name, rate in zip(names, rates, strict=True):
        weight = {v: math.log(rate[v][0] / rate[v][1]) for v in rate}
        vote = F.col(f"vote_{name}")
        z = z + F.when(vote == 1, weight[1]).when(vote == -1, weight[-1]).otherwise(weight[0])
    return (
        voted.withColumn("p_good", 1 / (1 + F.exp(-z)))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= least))
        .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "p_good", *[f"vote_{n}" for n in names])
    )


def op2_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_quality(table(spark, sf_dir, "documents"))
