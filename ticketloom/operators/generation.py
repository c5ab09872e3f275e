"""Questions and concepts for chapters, with user-supplied batch callables."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.functions.columns import first_wins
from ticketloom.functions.text import pack_chunks
from ticketloom.operators.windows import allocate_quota, limit_per_group, ranked, split_quota_over_chunks
from ticketloom.session import bounded_batches, new_path, written


def _with_texts(chunks: DataFrame, quotas: DataFrame) -> DataFrame:
    """Chunks with their quota. Quotas are shared out over sizes alone, so texts are shuffled once."""
    return chunks.join(quotas.select("doc", "chunk", "quota"), ["doc", "chunk"])


def generate_qa(chapters: DataFrame, qa_fn: Callable[[str, int], list[dict]], per_chapter: int = 30, per_document: int | None = None, max_tokens: int = 3500) -> DataFrame:
    """chapters(source_file, chapter, content, token_estimate) -> (source_file, chapter, question,
    answer). Long chapters are chunked and share their quota; questions are distinct by folded text. The
    answers are written, so each chunk reaches the model once."""
    bounded_batches(chapters.sparkSession)
    quota = allocate_quota(chapters.filter("content != ''"), "source_file", "chapter", "token_estimate", per_chapter, per_document).filter("quota > 0")
    keyed = quota.withColumn("doc", F.concat_ws("\u0001", "source_file", F.col("chapter").cast("string")))
    chunks = written(pack_chunks(keyed, "doc", "content", max_tokens).select("doc", F.col("chunk_ord").alias("chunk"), "content", "tokens"), "texts")
    sizes = chunks.select("doc", "chunk", "tokens").join(keyed.select("doc", F.col("quota").alias("n")), "doc")
    shared = _with_texts(chunks, split_quota_over_chunks(sizes).filter("quota > 0"))

    def run(parts):
        for pdf in parts:
            rows = [(d, c, k, x["question"], x["answer"]) for d, c, t, n in zip(pdf["doc"], pdf["chunk"], pdf["content"], pdf["quota"], strict=True) for k, x in enumerate(qa_fn(t, int(n))[: int(n)])]
            yield pd.DataFrame(rows, columns=["doc", "chunk", "k", "question", "answer"])

    items = written(shared.select("doc", "chunk", "content", "quota").mapInPandas(run, "doc string, chunk long, k long, question string, answer string"), "questions")
    distinct = first_wins(items, ["doc", F.lower(F.btrim("question"))], ["chunk", "k"])
    clamped = limit_per_group(distinct.join(keyed.select("doc", "source_file", "chapter", "quota"), "doc"), ["doc"], per_chapter, ["chunk", "k"])
    return clamped.select("source_file", "chapter", "question", "answer")


def extract_concepts(chapters: DataFrame, concept_fn: Callable[[str, int], list[dict]], max_concepts: int = 50, max_tokens: int = 3500) -> DataFrame:
    """chapters(source_file, chapter, content) -> (source_file, chapter, concept_id, title, summary,
    importance). Long chapters are chunked, the budget is split over chunks by size (at least one each),
    titles are distinct by folded text, first chunk first. The answers are written, so each chunk reaches the
    model once."""
    bounded_batches(chapters.sparkSession)
    keyed = chapters.filter(F.coalesce(F.btrim("content"), F.lit("")) != "").withColumn("doc", F.concat_ws("\u0001", "source_file", F.col("chapter").cast("string")))
    chunks = written(pack_chunks(keyed, "doc", "content", max_tokens).select("doc", F.col("chunk_ord").alias("chunk"), "content", "tokens"), "texts")
    sizes = chunks.select("doc", "chunk", "tokens", F.lit(max_concepts).cast("long").alias("n"))
    shared = _with_texts(chunks, split_quota_over_chunks(sizes, floor=1))

    def run(parts):
        for pdf in parts:
            rows = [(d, c, k, x["title"].strip(), x.get("summary") or "", int(x.get("importance", 2))) for d, c, t, n in zip(pdf["doc"], pdf["chunk"], pdf["content"], pdf["quota"], strict=True) for k, x in enumerate(concept_fn(t, int(n))[: int(n)]) if (x.get("title") or "").strip()]
            yield pd.DataFrame(rows, columns=["doc", "chunk", "k", "title", "summary", "importance"])

    items = written(shared.select("doc", "chunk", "content", "quota").mapInPandas(run, "doc string, chunk long, k long, title string, summary string, importance int"), "concepts")
    distinct = first_wins(items, ["doc", F.lower(F.col("title"))], ["chunk", "k"])
    numbered = ranked(distinct, ["doc"], ["chunk", "k"], "_rank").filter(F.col("_rank") <= max_concepts)
    return numbered.join(keyed.select("doc", "source_file", "chapter"), "doc").select("source_file", F.col("chapter").cast("long").alias("chapter"), F.concat(F.lit("c"), F.col("_rank").cast("string")).alias("concept_id"), "title", "summary", "importance")


def _once(folder: str, name: str, df: DataFrame) -> DataFrame:
    """A table of a run that is written once: a run that goes on reads what it wrote before."""
    spark, path = df.sparkSession, f"{folder}/{name}"
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_ASKED = "source_file string, chapter long, round int, k long, question string, answer string, covers array<string>, folded string"


def generate_until_covered(
    chapters: DataFrame,
    concept_fn: Callable[[str, int], list[dict]],
    qa_fn: Callable[[str, list[tuple[str, str]], int], list[dict]],
    threshold: float = 0.85,
    max_concepts: int = 50,
    rounds: int = 8,
    cap: int = 60,
    max_tokens: int = 3500,
    state: str | None = None,
) -> DataFrame:
    """For each chapter: its concepts (``extract_concepts``), then questions until the covered share reaches
    the threshold, nothing new comes, or the cap is met: (source_file, chapter, question, answer, covers,
    coverage).

    A round asks for all chapters at once that still need it: open concepts are those that no answer covers, an
    anti-join. Concepts and the answers of each round are written to the folder ``state`` (a new one, if not
    given), so a run that fails goes on with the round that failed, and no request is repeated that was answered."""
    spark = chapters.sparkSession
    bounded_batches(spark)
    folder = state or new_path(spark, "covering")
    key = ["source_file", "chapter"]
    concepts = _once(folder, "concepts", extract_concepts(chapters, concept_fn, max_concepts, max_tokens))
    texts = chapters.select("source_file", F.col("chapter").cast("long").alias("chapter"), F.coalesce("content", F.lit("")).alias("content"))
    totals = concepts.groupBy(*key).agg(F.count(F.lit(1)).alias("total"))
    asked = spark.createDataFrame([], _ASKED)

    def run(parts):
        for pdf in parts:
            rows = [(s, c, r, k, x["question"], x["answer"], list(x.get("covers", [])), x["question"].casefold()) for s, c, t, n, r, found in zip(pdf["source_file"], pdf["chapter"], pdf["content"], pdf["ask"], pdf["round"], pdf["open"], strict=True) for k, x in enumerate(qa_fn(t, [(o["concept_id"], o["title"]) for o in found], int(n))[: int(n)])]
            yield pd.DataFrame(rows, columns=["source_file", "chapter", "round", "k", "question", "answer", "covers", "folded"])

    def standing() -> tuple[DataFrame, DataFrame]:
        """(open concepts, chapters with total, n_open and n_asked)."""
        covered = asked.select(*key, F.explode("covers").alias("concept_id")).distinct()
        left = concepts.join(covered, [*key, "concept_id"], "left_anti")
        counts = left.groupBy(*key).agg(F.count(F.lit(1)).alias("n_open"))
        done = asked.groupBy(*key).agg(F.count(F.lit(1)).alias("n_asked"), F.max("round").alias("last"))
        now = totals.join(counts, key, "left").join(done, key, "left").fillna({"n_open": 0, "n_asked": 0, "last": -1})
        return left, now.withColumn("coverage", 1 - F.col("n_open") / F.col("total"))

    for r in range(rounds):
        left, now = standing()
        # a chapter whose last round brought nothing new is done
        todo = now.filter((F.col("coverage") < threshold) & (F.col("n_asked") < cap) & (F.col("last") == r - 1))
        ask = F.least(F.greatest(F.lit(3), F.bround(F.col("n_open") / 3, 0)), cap - F.col("n_asked")).cast("long")
        first = limit_per_group(left, key, 20, [F.desc("importance"), F.desc("title")]).groupBy(*key).agg(F.collect_list(F.struct("importance", "title", "concept_id")).alias("open"))
        listed = F.reverse(F.array_sort("open"))
        ready = texts.join(todo.select(*key, ask.alias("ask")), key).join(first, key).select(*key, "content", "ask", F.lit(r).alias("round"), listed.alias("open"))
        answers = _once(folder, f"answers-{r}", ready.mapInPandas(run, _ASKED))
        new = _once(folder, f"questions-{r}", answers.join(asked.select(*key, "folded").distinct(), [*key, "folded"], "left_anti").select(asked.columns))
        if new.isEmpty():
            break
        asked = asked.unionByName(new)
    share = standing()[1].select(*key, "coverage")
    return asked.join(share, key).select(*key, "question", "answer", "covers", "coverage")
