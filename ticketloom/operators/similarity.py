"""Similarity join over vectors, review pairs, and duplicate clusters."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, GroupedData, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from ticketloom.functions.columns import with_ordinal
from ticketloom.operators.graph import connected_components
from ticketloom.operators.windows import pick_representative
from ticketloom.session import bounded_batches, release, ship, written


#: Vectors of a block take at most this many bytes in a task: as doubles, or what is not zero and its places.
BLOCK_BYTES = 32 << 20
#: As many blocks a table that fits into fewer is dealt into, for enough tasks (78).
BLOCKS = 12
#: Numbers that a task holds at a time, and rows that it sends at a time.
_TILE, _ROWS = 1 << 22, 1 << 16
#: Rows on the two sides that are compared at a time, at most; groups of features whose lengths bound a score.
_LEFT, _RIGHT, _GROUPS = 512, 4096, 96


def _rows_of(i: np.ndarray, j: np.ndarray, score: np.ndarray | None, kind: str | None = None) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(i), _ROWS):
        cut = slice(at, at + _ROWS)
        n = len(i[cut])
        values = pa.nulls(n, pa.float64()) if score is None else pa.array(score[cut], pa.float64())
        columns = [pa.array(np.minimum(i[cut], j[cut]), pa.int64()), pa.array(np.maximum(i[cut], j[cut]), pa.int64()), values]
        names = ["i", "j", "score"]
        if kind is not None:
            columns, names = [*columns, pa.array([kind] * n, pa.string())], [*names, "kind"]
        yield pa.RecordBatch.from_arrays(columns, names)


def _true(flags: np.ndarray) -> np.ndarray:
    """Places of the few flags that are set, eight looked at together."""
    n = len(flags) // 8 * 8
    some = np.flatnonzero(flags[:n].view(np.uint64))
    at = (some[:, None] * 8 + np.arange(8)).ravel()
    return np.concatenate([at[flags[at]], n + np.flatnonzero(flags[n:])])


class _Block:
    """A pair of blocks in a task: unit vectors, and which rows are on which side. Vectors that are mostly zeros come
    as places and values, and are made whole for some rows at a time."""

    def __init__(self, batches: Iterator[pa.RecordBatch]):
        group = pa.Table.from_batches(list(batches)).combine_chunks()
        self.own = group["ord"].to_numpy()
        side = group["side"].to_numpy()
        self.left, self.right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
        self.same = bool((side == 2).any())
        values = group["vector"].combine_chunks()
        self.sparse = "places" in group.column_names
        self.values = values.flatten().to_numpy(zero_copy_only=False)
        if self.sparse:
            self.places = group["places"].combine_chunks().flatten().to_numpy()
            self.sizes = pc.list_value_length(values).to_numpy().astype(np.int64)
            self.starts = np.cumsum(self.sizes) - self.sizes
            self.width = 64 * (int(self.places.max(initial=0)) // 64 + 1)  # zeros behind the last place count for nothing
            self._measure()
        else:
            v = self.values.reshape(len(self.own), -1).astype(np.float64)
            norm = np.sqrt(np.einsum("ij,ij->i", v, v))[:, None]
            self.vectors, self.width = np.divide(v, norm, out=np.zeros_like(v), where=norm > 0), max(1, v.shape[1])

    def _entries(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of what is not zero in some rows, the number of the row among these, and where it is kept."""
        n = self.sizes[rows]
        row = np.repeat(np.arange(len(rows)), n)
        return row, np.arange(len(row)) + np.repeat(self.starts[rows] - (np.cumsum(n) - n), n)

    def _measure(self) -> None:
        """Norms, and the length of each row in each group of features. The product of two rows is at most that of
        their lengths, summed over the groups. Features with much of all rows go to different groups."""
        step, n = max(1, _TILE // self.width), len(self.own)
        self.norm, weight = np.ones(n), np.zeros(self.width)
        for at in range(0, n, step):
            rows = np.arange(at, min(n, at + step))
            v = self.whole(rows)
            self.norm[rows] = np.sqrt(np.einsum("ij,ij->i", v, v))
            _, where = self._entries(rows)
            weight += np.bincount(self.places[where], self.values[where].astype(np.float64) ** 2, self.width)
        group = np.empty(self.width, np.int64)
        group[np.argsort(-weight, kind="stable")] = np.arange(self.width) % _GROUPS
        self.lengths = np.empty((n, _GROUPS), np.float32)
        for at in range(0, n, step):
            rows = np.arange(at, min(n, at + step))
            row, where = self._entries(rows)
            norm = self.norm[rows][row]
            u = np.divide(self.values[where], norm, out=np.zeros(len(row)), where=norm > 0)
            self.lengths[rows] = np.sqrt(np.bincount(row * _GROUPS + group[self.places[where]], u * u, len(rows) * _GROUPS)).reshape(-1, _GROUPS)

    def whole(self, rows: np.ndarray, kind: type = np.float64) -> np.ndarray:
        """Unit vectors of some rows."""
        if not self.sparse:
            return self.vectors[rows].astype(kind, copy=False)
        out = np.zeros((len(rows), self.width), kind)
        row, where = self._entries(rows)
        norm = self.norm[rows][row]
        out[row, self.places[where]] = np.divide(self.values[where], norm, out=np.zeros(len(row)), where=norm > 0)
        return out

    def near(self, least: float, wanted: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows (a, b) that may score ``least`` or more, each pair once, and of these what ``wanted`` leaves: it is asked
        again after one pair of each row on the right, and of each on the left. Every pair is looked at, sparse rows by
        their lengths first, which few pass. Single precision finds them, with what its sums can be wrong by;
        ``scores`` decides."""
        least = np.float32(least - 1e-6 - 1.2e-7 * self.width)
        columns = max(1, min(_RIGHT, _TILE // self.width))
        step = max(1, min(_LEFT, _TILE // max(columns, self.width)))
        room, flags = np.empty(step * columns, np.float32), np.empty(step * columns, bool)

        def reached(x: np.ndarray, y: np.ndarray) -> np.ndarray:
            n = len(x) * y.shape[1]
            product = np.matmul(x, y, out=room[:n].reshape(len(x), -1))
            return _true(np.greater_equal(product.ravel(), least, out=flags[:n]))

        for at in range(0, len(self.right), columns):
            right, other = self.right[at : at + columns], None
            n = len(right)
            if self.sparse:
                bound = np.ascontiguousarray(self.lengths[right].T)
            for to in range(0, min(at + n, len(self.left)) if self.same else len(self.left), step):
                left = self.left[to : to + step]
                bounded = self.sparse
                if bounded:
                    found = reached(self.lengths[left], bound)
                    bounded = len(found) <= len(left) * n >> 4  # else too many to be looked at one by one
                if not bounded:
                    other = np.ascontiguousarray(self.whole(right, np.float32).T) if other is None else other
                    found = reached(self.whole(left, np.float32), other)
                a, b = found // n, found % n
                once = a + to < b + at if self.same else slice(None)
                a, b = left[a[once]], right[b[once]]
                if self.same:
                    once = self.own[a] != self.own[b]
                    a, b = a[once], b[once]
                for side in (None,) if wanted is None else (1, 0, None):
                    if wanted is not None:
                        keep = wanted(a, b)
                        a, b = a[keep], b[keep]
                    now = np.zeros(len(a), bool)
                    now[slice(None) if side is None else np.unique((a, b)[side], return_index=True)[1]] = True
                    x, y, a, b = a[now], b[now], a[~now], b[~now]
                    if bounded and len(x):
                        keep = self._products(x, y, np.float32) >= least
                        x, y = x[keep], y[keep]
                    if len(x):
                        yield x, y

    def _products(self, a: np.ndarray, b: np.ndarray, kind: type) -> np.ndarray:
        out, step = np.empty(len(a), kind), max(1, _TILE // (4 * self.width))
        for at in range(0, len(a), step):
            cut = slice(at, at + step)
            if self.sparse:  # a row is made whole once for all its pairs
                (i, x), (j, y) = (np.unique(rows[cut], return_inverse=True) for rows in (a, b))
                out[cut] = np.einsum("ij,ij->i", self.whole(i, kind)[x], self.whole(j, kind)[y])
            else:
                out[cut] = np.einsum("ij,ij->i", self.whole(a[cut], kind), self.whole(b[cut], kind))
        return out

    def scores(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return self._products(a, b, np.float64)


def _block_scores(t_low: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block(batches)
        for a, b in block.near(t_low):
            s = block.scores(a, b)
            good = s >= t_low
            yield from _rows_of(block.own[a[good]], block.own[b[good]], s[good])

    return run


def _joined(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Roots after the edges (a, b); the root of a component is its least row."""
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return root
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root = root[root]


def _best(i: np.ndarray, j: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The best j of each i, ties to the smallest j."""
    order = np.lexsort((j, -s, i))
    i, j, s = i[order], j[order], s[order]
    first = np.ones(len(i), bool)
    first[1:] = i[1:] != i[:-1]
    return i[first], j[first], s[first]


def _block_links(t_low: float, t_merge: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block(batches)
        own, root = block.own, np.arange(len(block.own))
        best: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        # without review pairs, rows that are linked already need no score
        for a, b in block.near(t_low, (lambda a, b: root[a] != root[b]) if t_low >= t_merge else None):
            s = block.scores(a, b)
            merge = s >= t_merge
            root = _joined(root, a[merge], b[merge])
            review = (s >= t_low) & ~merge
            if review.any():
                a, b = own[a[review]], own[b[review]]
                best.append(_best(np.minimum(a, b), np.maximum(a, b), s[review]))
                if sum(len(x[0]) for x in best[1:]) > 4 * len(own):
                    best = [_best(*(np.concatenate(x) for x in zip(*best, strict=True)))]
        linked = np.flatnonzero(root != np.arange(len(own)))
        yield from _rows_of(own[root[linked]], own[linked], None, "link")
        if best:
            yield from _rows_of(*_best(*(np.concatenate(x) for x in zip(*best, strict=True))), "review")

    return run


def unit(c):
    """A unit vector; a zero vector stays zero."""
    norm = F.sqrt(F.aggregate(c, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))
    return F.transform(c, lambda x: F.when(norm > 0, x.cast("double") / norm).otherwise(F.lit(0.0)))


def similarity_pairs(vectors: DataFrame, t_low: float, t_merge: float, block: int = 2000, mode: str = "exact", ord_col: str = "ord", vector_col: str = "embedding") -> DataFrame:
    """(i, j, score, kind 'merge'|'review') for i < j with dot product of unit vectors >= t_low.

    ``exact``: rows are dealt into blocks, each pair of blocks is one matrix product in one task
    (``_dealt``); scores never leave the task unless they reach t_low, and pairs are sent as they are found.
    ``index``: for sparse vectors, an inverted index with residual norms (``_index_pairs``), exact as
    well. ``lsh``: random projections give candidates, the exact score decides.
    """
    if mode == "exact":
        return _kinds(_dealt(vectors, block, ord_col, vector_col).applyInArrow(_block_scores(t_low), "i long, j long, score double"), t_merge)
    ship(vectors.sparkSession)
    # the norm is a column of its own, so that it is computed once for each row
    norm = F.sqrt(F.aggregate(F.col("v"), F.lit(0.0), lambda acc, x: acc + x * x))
    rows = vectors.select(F.col(ord_col).cast("long").alias("ord"), F.transform(F.col(vector_col), lambda x: x.cast("double")).alias("v")).withColumn("norm", norm)
    rows = rows.select("ord", F.transform("v", lambda x: F.when(F.col("norm") > 0, x / F.col("norm")).otherwise(F.lit(0.0))).alias("vector"))
    return _kinds(_lsh_pairs(rows, t_low) if mode == "lsh" else _index_pairs(rows, t_low), t_merge)


def similarity_links(vectors: DataFrame, t_low: float, t_merge: float, block: int = 2000, ord_col: str = "ord", vector_col: str = "embedding", at_once: bool = False) -> DataFrame:
    """What clusters and review pairs need of all pairs, at most three rows for each row and pair of blocks
    however many pairs there are: (i, j, null, 'link'), which connect the same rows as all pairs with a score >=
    t_merge, and (i, j, score, 'review'), the best below of each i from a pair of blocks, ties to the smallest j.
    Where t_low is t_merge there are links only. Every pair is compared.

    More than ``BLOCKS`` blocks are compared in rounds, each written before the next, so that at most twice as many
    copies of a row as that are on disk at a time. ``at_once`` leaves all to one job that runs when it is read."""
    rows, blocks = _blocked(vectors, block, ord_col, vector_col)
    each = blocks if at_once else BLOCKS
    rounds = [_paired(rows, blocks, at, min(at + each, blocks)).applyInArrow(_block_links(t_low, t_merge), "i long, j long, score double, kind string") for at in range(0, blocks, each)]
    return rounds[0] if len(rounds) == 1 else reduce(DataFrame.unionByName, [written(x, "links-of-round") for x in rounds])


def _dealt(vectors: DataFrame, block: int, ord_col: str, vector_col: str) -> GroupedData:
    """Rows by all pairs of blocks."""
    rows, blocks = _blocked(vectors, block, ord_col, vector_col)
    return _paired(rows, blocks, 0, blocks)


def _blocked(vectors: DataFrame, block: int, ord_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """Rows with their block ``b``, and the number of blocks. A row is copied once for each block, so there are few and
    large ones: at least ``block`` rows for each of ``BLOCKS``, and ``BLOCK_BYTES`` at most. Of vectors that are mostly
    zeros only the rest is sent."""
    bounded_batches(vectors.sparkSession)
    single = isinstance(vectors.schema[vector_col].dataType.elementType, FloatType)
    rows = vectors.select(F.col(ord_col).cast("long").alias("ord"), F.col(vector_col).cast("array<float>" if single else "array<double>").alias("vector")).filter("vector is not null")
    full = lambda x: x.isNull() | (x != 0)
    n, width, filled = rows.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("vector")), F.lit(0)), F.coalesce(F.sum(F.size(F.filter("vector", full))), F.lit(0))).first()
    number, place = (4 if single else 8), (2 if width <= 1 << 15 else 4)
    sparse = 2 * filled * (number + place) < n * width * number
    if sparse:
        places = F.array_compact(F.transform("vector", lambda x, i: F.when(full(x), i.cast("short" if place == 2 else "int"))))
        rows = rows.select("ord", places.alias("places"), F.filter("vector", full).alias("vector"))
    blocks = max(1, min(BLOCKS, math.ceil(n / block)), math.ceil((filled * (number + place) if sparse else n * width * 8) / BLOCK_BYTES))
    return rows.withColumn("b", F.pmod(F.xxhash64("ord"), F.lit(blocks)).cast("int")), blocks


def _paired(rows: DataFrame, blocks: int, first: int, end: int) -> GroupedData:
    """Rows by those pairs of blocks whose greater one is from ``first`` to before ``end``."""
    other = F.explode(F.sequence(F.when(F.col("b") < first, first).otherwise(0), F.lit(end - 1)))
    p, q = F.least("b", "o"), F.greatest("b", "o")
    before, count = first * (first + 1) // 2, end * (end + 1) // 2 - first * (first + 1) // 2
    pair = (F.floor(q * (q + 1) / 2) + p - before).cast("int")  # from 0, without gaps
    side = F.when(F.col("b") == F.col("o"), 2).when(F.col("b") < F.col("o"), 0).otherwise(1)
    copies = rows.filter(F.col("b") < end).withColumn("o", other).select(pair.alias("pair"), side.alias("side"), *[c for c in rows.columns if c != "b"])
    # by number and not by hash, so that each pair of blocks is a task of its own
    return copies.repartitionById(min(count, 2000), "pair").groupBy("pair")


def _index_pairs(rows: DataFrame, t_low: float) -> DataFrame:
    """All pairs of unit vectors with a dot product of at least t_low > 0.

    Features are ordered by the number of vectors that have them, rare ones first. What two vectors have in
    common from their first common feature on is at most the product of their norms from there on, so only
    postings whose residual norm reaches t_low are kept, and only those meet whose product of residual norms
    does. Of the candidates the exact score decides. A feature that most vectors have comes last, where
    little of a vector is left: it brings nobody together unless there is nothing rarer."""
    if t_low <= 0:
        raise ValueError("the index finds pairs above a positive threshold only")
    least = t_low - 1e-9  # sums of squares in another order
    rows = written(rows, "index-vectors")
    entries = rows.select("ord", F.posexplode("vector").alias("feature", "x")).filter("x != 0")
    seen = written(entries.groupBy("feature").agg(F.count(F.lit(1)).alias("seen")), "index-features")  # a row for each feature
    rest = Window.partitionBy("ord").orderBy("seen", "feature").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    postings = entries.join(seen.filter("seen > 1"), "feature").withColumn("rest", F.sqrt(F.sum(F.col("x") * F.col("x")).over(rest)))
    postings = written(postings.filter(F.col("rest") >= least).select("feature", "ord", "rest"), "index-postings")
    a, b = postings.alias("a"), postings.alias("b")
    met = a.join(b, "feature").filter((F.col("a.ord") < F.col("b.ord")) & (F.col("a.rest") * F.col("b.rest") >= least))
    pairs = written(met.select(F.col("a.ord").alias("i"), F.col("b.ord").alias("j")).distinct(), "index-pairs")
    scored = pairs.join(rows.select(F.col("ord").alias("i"), F.col("vector").alias("u")), "i").join(rows.select(F.col("ord").alias("j"), F.col("vector").alias("w")), "j")
    dot = F.aggregate(F.zip_with("u", "w", lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)
    out = written(scored.select("i", "j", dot.alias("score")).filter(F.col("score") >= t_low), "index-scores")
    release(rows, seen, postings, pairs)
    return out


def _kinds(pairs: DataFrame, t_merge: float) -> DataFrame:
    return pairs.withColumn("kind", F.when(F.col("score") >= t_merge, "merge").otherwise("review"))


def _lsh_pairs(rows: DataFrame, t_low: float) -> DataFrame:
    from pyspark.ml.feature import BucketedRandomProjectionLSH
    from pyspark.ml.functions import array_to_vector

    features = rows.withColumn("features", array_to_vector("vector"))
    model = BucketedRandomProjectionLSH(inputCol="features", outputCol="hashes", bucketLength=1.0, numHashTables=8, seed=7).fit(features)
    near = model.approxSimilarityJoin(features, features, math.sqrt(2 - 2 * t_low) + 1e-9, "distance")
    dot = F.aggregate(F.zip_with("datasetA.vector", "datasetB.vector", lambda a, b: a * b), F.lit(0.0), lambda acc, x: acc + x)
    return near.filter("datasetA.ord < datasetB.ord").select(F.col("datasetA.ord").alias("i"), F.col("datasetB.ord").alias("j"), dot.alias("score")).filter(F.col("score") >= t_low).distinct()


def review_pairs(pairs: DataFrame, tickets: DataFrame, max_pairs: int | None = None) -> DataFrame:
    """For each i its best j in the review zone (ties to the smallest j), with ids and subjects. Of pairs all or those
    of ``similarity_links`` are taken."""
    best = pairs.filter("kind = 'review'").groupBy("i").agg(F.max_by(F.struct("j", "score"), F.struct("score", (-F.col("j")).alias("n"))).alias("b"))
    best = best.select("i", F.col("b.j").alias("j"), F.round("b.score", 4).alias("similarity"))
    if max_pairs is not None:
        best = best.orderBy("i").limit(max_pairs)
    named = lambda x: tickets.select(F.col("ord").alias(x), F.col("ticket_id").alias(f"ticket_id_{x}"), F.substring(F.coalesce("subject", F.lit("")), 1, 120).alias(f"subject_{x}"))
    return best.join(named("i"), "i").join(named("j"), "j").select("i", "j", F.col("ticket_id_i").alias("ticket_id_A"), F.col("ticket_id_j").alias("ticket_id_B"), "similarity", F.col("subject_i").alias("subject_A"), F.col("subject_j").alias("subject_B"))


def cluster_duplicates(tickets: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """tickets(ord, ticket_id, date, subject, problem, solution) and edges(i, j), all of them or such that
    connect the same tickets (``similarity_links``) -> (clusters, canonical). Clusters are numbered by smallest member; singletons are clusters."""
    labels = connected_components(edges.select(F.col("i").alias("a"), F.col("j").alias("b")))
    placed = tickets.join(labels.select(F.col("node").alias("ord"), "component"), "ord", "left").withColumn("root", F.coalesce("component", "ord")).drop("component")
    placed = written(placed, "placed")
    roots = with_ordinal(placed.filter("ord = root").select("root"), ["root"], "cluster_id")
    members = placed.join(roots, "root").drop("root")
    picked = pick_representative(members)
    packed = F.array_sort(F.collect_list(F.struct("ord", F.col("ticket_id").cast("string").alias("id"))))
    clusters = members.groupBy("cluster_id").agg(packed.alias("m"), F.count(F.lit(1)).alias("size")).join(picked, "cluster_id")
    clusters = clusters.select(
        "cluster_id",
        F.col("representative_ord").alias("representative_index"),
        F.transform("m", lambda x: x["ord"]).alias("member_indices"),
        F.transform("m", lambda x: x["id"]).alias("member_ticket_ids"),
        "size",
    )
    canonical = clusters.join(tickets, clusters.representative_index == tickets.ord).select(
        "cluster_id", "ord", "ticket_id", "date", "subject", "problem", "solution", F.filter("member_ticket_ids", lambda x: x != F.col("ticket_id").cast("string")).alias("duplicates"), "size"
    )
    return clusters, canonical


def embed_texts(texts: DataFrame, id_col: str = "ord", text_col: str = "text", features: int = 1 << 9) -> DataFrame:
    """Local embeddings: hashed words, inverse document frequency, unit length; ``features`` floats a row."""
    from pyspark.ml.feature import IDF, HashingTF, Normalizer
    from pyspark.ml.functions import vector_to_array

    words = texts.select(id_col, F.filter(F.split(F.lower(F.coalesce(text_col, F.lit(""))), r"\W+"), lambda w: w != "").alias("words"))
    counted = HashingTF(inputCol="words", outputCol="tf", numFeatures=features).transform(words)
    weighted = IDF(inputCol="tf", outputCol="idf").fit(counted).transform(counted)
    return Normalizer(inputCol="idf", outputCol="v").transform(weighted).select(id_col, vector_to_array("v", "float32").alias("embedding"))


def embed_with(texts: DataFrame, fn, batch: int = 64, id_col: str = "ord", text_col: str = "text") -> DataFrame:
    """(id, embedding) from fn(list of texts) -> list of vectors; another number of vectors than of
    texts is an error."""
    ship(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, found = b.column(0), []
            values = [t or "" for t in b.column(1).to_pylist()]
            for at in range(0, len(values), batch):
                part = fn(values[at : at + batch])
                if len(part) != len(values[at : at + batch]):
                    raise ValueError(f"{len(part)} vectors for {len(values[at : at + batch])} texts")
                found += [list(map(float, v)) for v in part]
            yield pa.RecordBatch.from_arrays([ids, pa.array(found, pa.list_(pa.float64()))], [id_col, "embedding"])

    return texts.select(F.col(id_col).cast("long").alias(id_col), text_col).mapInArrow(run, f"{id_col} long, embedding array<double>")
