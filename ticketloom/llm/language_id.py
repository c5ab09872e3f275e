"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased; n-grams of 1 to 3 characters are hashed to ``buckets`` features. Counts per
language come from Spark over at most ``sample_rows`` labelled documents of each language (those
with the smallest id hash); the log-probability matrix, buckets x languages of float32 and so of
a size fixed by parameters, goes to the tasks, which score batches of whole texts in numpy:
gather each n-gram's row, add up within each document. Texts are scored in segments of a bounded
number of code points, whose sums are added up, so a very long text needs no more memory than others.

Cases: null texts and texts without a letter are ``und`` with score 0; ties go to the language that
sorts first; with nothing to learn from, every text is ``und``; repeated rows and null ids are
scored as they come; very long texts count whole; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.session import bounded_batches, table

_PRIME = np.uint32(0x9E3779B1)


#: Numbers (code points times languages) that are held at a time.
_HELD = 1 << 22


def segments(text: str, most: int) -> Iterator[str]:
    """Stretches of a text, a space before and two behind it, that overlap by the two code points which
    only end n-grams of the stretch before."""
    padded = f" {text}  "
    for at in range(0, len(padded) - 2, most):
        yield padded[at : at + most + 2]


def _codes(parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all stretches and the bounds of each."""
    lowered = [np.frombuffer(t.lower().encode("utf-32-le", "replace"), "<u4") for t in parts]
    bounds = np.cumsum([0, *(len(p) for p in lowered)])
    return (np.concatenate(lowered) if lowered else np.zeros(0, np.uint32)), bounds


def _grouped(texts: list[str], most: int) -> Iterator[tuple[list[int], list[str]]]:
    """(numbers of the texts, stretches) of about ``most`` code points at a time."""
    owners: list[int] = []
    parts: list[str] = []
    held = 0
    for i, text in enumerate(texts):
        for part in segments(text, most):
            owners.append(i)
            parts.append(part)
            held += len(part)
            if held >= most:
                yield owners, parts
                owners, parts, held = [], [], 0
    if parts:
        yield owners, parts


def _features(codes: np.ndarray, buckets: int) -> list[np.ndarray]:
    """Features of the n-grams that start at each code point (all but the last two)."""
    shift = np.uint32(32 - int(buckets).bit_length() + 1)
    out, acc = [], np.zeros(max(len(codes) - 2, 0), np.uint32)
    for n in range(3):
        acc = (acc ^ codes[n : len(codes) - 2 + n]) * _PRIME
        acc = acc ^ (acc >> np.uint32(15))
        out.append(((acc * _PRIME) >> shift).astype(np.int32))
    return out


@dataclass
class LanguageModel:
    languages: list[str]
    weights: np.ndarray  # buckets x languages
    prior: np.ndarray

    def score(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        n = len(texts)
        if not self.languages or not n:
            return ["und"] * n, np.zeros(n)
        sums = np.zeros((n, len(self.languages)))
        for owners, parts in _grouped(texts, max(1024, _HELD // len(self.languages))):
            codes, bounds = _codes(parts)
            total = np.zeros((len(codes), len(self.languages)), np.float32)
            for feature in _features(codes, len(self.weights)):
                total[: len(feature)] += self.weights[feature]
            total[(bounds[1:, None] - np.array([1, 2])).ravel()] = 0  # n-grams that reach out of the stretch
            np.add.at(sums, owners, np.add.reduceat(total, bounds[:-1], axis=0, dtype=np.float64))
        sums += self.prior
        best = sums.argmax(axis=1)
        shown = np.exp(sums - sums.max(axis=1, keepdims=True))
        return [self.languages[i] for i in best], shown.max(axis=1) / shown.sum(axis=1)


def _counts(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lang in set(langs):
                mine = totals.setdefault(lang, np.zeros(buckets, np.int64))
                for _, parts in _grouped([t for t, x in zip(texts, langs, strict=True) if x == lang], _HELD // 4):
                    codes, bounds = _codes(parts)
                    keep = np.ones(max(len(codes) - 2, 0), bool)
                    cut = (bounds[1:, None] - np.array([1, 2])).ravel()
                    keep[cut[cut < len(keep)]] = False
                    for feature in _features(codes, buckets):
                        mine += np.bincount(feature[keep], minlength=buckets)
        for lang, mine in totals.items():
            at = np.flatnonzero(mine)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(mine[at])], ["lang", "feature", "n"])

    return run


def fit_languages(labelled: DataFrame, buckets: int = 1 << 15, sample_rows: int = 4000, max_languages: int = 256, smoothing: float = 0.1) -> LanguageModel:
    """Fit on (doc_id, text, lang). The driver gets one count for each used feature of each
    language, at most buckets x max_languages; more languages than that are an error."""
    bounded_batches(labelled.sparkSession)
    rows = labelled.filter("text is not null and lang is not null")
    priors = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(max_languages + 1).collect()}
    if len(priors) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    languages = sorted(priors)
    if not languages:
        return LanguageModel([], np.zeros((buckets, 0), np.float32), np.zeros(0))
    # a share of id hashes that leaves about sample_rows rows of each language
    share = F.create_map(*[F.lit(x) for lang in languages for x in (lang, min(1.0, sample_rows / priors[lang]))])
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / float(1 << 20)
    sample = rows.filter(draw < share[F.col("lang")]).select("text", "lang")
    summed = sample.mapInArrow(_counts(buckets), "lang string, feature int, n long").groupBy("lang", "feature").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros((buckets, len(languages)))
    place = {lang: i for i, lang in enumerate(languages)}
    if len(summed):
        counts[summed["feature"].to_numpy(), [place[x] for x in summed["lang"].to_pylist()]] = summed["n"].to_numpy()
    weights = np.log(counts + smoothing) - np.log((counts + smoothing).sum(axis=0))
    total = np.array([priors[x] for x in languages], float)
    return LanguageModel(languages, weights.astype(np.float32), np.log(total / total.sum()))


def _scored(model: LanguageModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            names, scores = ["und"] * len(texts), np.zeros(len(texts))
            at = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))]
            found, values = model.score([texts[k] for k in at])
            for k, name, value in zip(at, found, values.tolist(), strict=True):
                names[k], scores[k] = name, value
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores)], ["doc_id", "lang_pred", "score"])

    return run


def identify_languages(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) for every row of docs."""
    bounded_batches(docs.sparkSession)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(_scored(model), "doc_id long, lang_pred string, score double")


def fold(modulus: int) -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(modulus))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_languages(docs.filter(fold(4) != 2).select("doc_id", "text", "lang"))
    found = identify_languages(docs, model)
    return found.select("doc_id", F.coalesce(fold(4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")
