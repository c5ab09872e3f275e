"""MinHash near-duplicates by fast similarity sketching, banding and exact verification.

Sketch (Dahlgaard, Knudsen, Thorup, "Fast Similarity Sketching", 2017): in round i every element
of a set is hashed to one of ``t`` bins with a value that starts with i; a bin keeps its minimum.
Rounds go on until each bin is filled. After ``t`` rounds, round ``t + b`` puts all elements into
bin b, so no bin stays empty. Coordinates of two sets agree with probability J and, unlike
one-permutation schemes with empty bins, with MinHash's concentration bounds.

``bands`` bands of ``rows`` coordinates give candidates; at J = 0.75 and 32 x 4 a pair is missed
with probability (1 - 0.75^4)^32 < 6e-6. Candidates are confirmed on full sets.

No bucket is gathered and no bucket's pairs are emitted. Documents with the same set form one class.
In each bucket the class with the smallest document is the pivot; first each class is compared with
the pivot it shares most bands with, then with its other pivots. Pairs inside one component cannot
change a component, so they need no comparison; after each step new links are reduced to components
and those merged. Classes that more than a quarter of their shingles have to themselves can have no
link. What is left is joined exactly by a prefix filter: shingles are ordered by the number of classes that have
them, and two sets at the threshold share one of the rarest n - ceil(0.75 n) + 1 of each. Of classes that meet in
such a shingle only those are compared whose sizes, and whose common rare shingles, leave room for enough
others. So what many classes share (a template, a licence) brings nobody together, and the work follows the
rare shingles. Where a rare shingle still has more than ``short`` classes of several components, these are a
crowd: in ``dealings`` rounds each crowd is dealt anew into blocks of ``block`` classes (less if their sets are
large) and each block returns a spanning forest of its own, never more links than classes; then classes
outside the largest component of their crowd are compared with all of it, block by block. Only that last
step can grow faster than the input, with crowds whose rarest quarter many others have as well.

Cases: null or blank text has no words, an empty set, n_shingles 0 and its own component; fewer
than ``width`` words make one shingle; repeated rows are members of one class; a null doc_id is
kept and never the smallest; an empty table gives an empty result; other columns are ignored. The
pipeline stage goes by rows: of each component one row stays, also if its ids are null or repeated.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ticketloom.llm.words import HASHES, mix, only, rolling, text_bytes, word_hashes
from ticketloom.operators.graph import connected_components
from ticketloom.session import IdFilter, bounded_batches, release, table, written

_SEED = np.uint64(0xD1B54A32D192ED03)


def shingle_set(text: bytes | None, width: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the word shingles of one text."""
    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = word_hashes(words)
    if len(words) < width:
        return mix(rolling(hashes, len(words)) ^ np.uint64(len(words)))
    return np.unique(rolling(hashes, width))


def fast_sketches(sets: list[np.ndarray], t: int = 128) -> np.ndarray:
    """The sketch of each non-empty set, as a row of t values."""
    n = len(sets)
    out = np.full(n * t, np.iinfo(np.uint64).max, np.uint64)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    elements = np.concatenate(sets) if n else np.zeros(0, np.uint64)
    empty = out[-1:].copy() if n else None
    low, seeds = np.uint64(0xFFFFFFFF), np.arange(1, 2 * t + 1, dtype=np.uint64) * _SEED
    for i in range(2 * t):
        if i:
            open_docs = (out.reshape(n, t) == empty).any(axis=1) if n else np.zeros(0, bool)
            if not open_docs.any():
                break
            keep = open_docs[owner]
            owner, elements = owner[keep], elements[keep]
        h = mix(elements ^ seeds[i])
        value = (np.uint64(i) << np.uint64(32)) | (h & low)
        bins = ((h >> np.uint64(32)) * np.uint64(t)) >> np.uint64(32) if i < t else np.full(len(h), i - t, np.uint64)
        np.minimum.at(out, owner * t + bins.astype(np.int64), value)
    return out.reshape(n, t)


def band_keys(sketches: np.ndarray, bands: int, rows: int) -> np.ndarray:
    parts = sketches[:, : bands * rows].reshape(len(sketches), bands, rows)
    acc = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * _SEED, parts.shape[:2]).copy()
    for k in range(rows):
        acc = mix(acc ^ parts[:, :, k]) + acc
    return acc.view(np.int64)


def _content(text: str) -> list[Column]:
    """A text as two 64-bit hashes."""
    return [F.xxhash64(text).alias("content"), F.xxhash64(F.lit(1), text).alias("again")]


def _node(hashes: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(hashes.tobytes())


def _sketched(width: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only(HASHES)
        for batch in batches:
            sets = [shingle_set(x, width) for x in text_bytes(batch.column(1))]
            full = [i for i, s in enumerate(sets) if len(s)]
            keys = band_keys(fast_sketches([sets[i] for i in full], bands * rows), bands, rows)
            bounds = np.zeros(len(sets) + 1, np.int32)
            bounds[1:][full] = bands
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    batch.column(3),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_node(s) if len(s) else None for s in sets], pa.binary()),
                    pa.ListArray.from_arrays(np.cumsum(bounds, dtype=np.int32), keys.reshape(-1)),
                ],
                ["doc_id", "content", "again", "n_shingles", "node", "keys"],
            )

    return run


def _sets_of(wanted: IdFilter, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only(HASHES)
        for batch in batches:
            batch = batch.filter(pa.array(wanted.has(batch.column(2).to_numpy())))
            sets = [s for x in text_bytes(batch.column(1)) if len(s := shingle_set(x, width))]
            yield pa.RecordBatch.from_arrays([pa.array([_node(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())], ["node", "hashes"])

    return run


def _elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [np.frombuffer(x, np.int64) for x in batch.column(1).to_pylist()]
        owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(0, np.int64), *sets])), batch.column(0).take(pa.array(owner))], ["element", "node"])


def _compare(threshold: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                if 100 * min(len(a), len(b)) < threshold * max(len(a), len(b)):  # cannot reach the threshold
                    linked.append(False)
                    continue
                both = np.concatenate([a, b])
                both.sort(kind="stable")
                n = int((both[1:] == both[:-1]).sum())
                linked.append(100 * n >= threshold * (len(both) - n))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(linked, pa.bool_())], ["a", "b", "linked"])

    return run


def _forest(threshold: int, columns: int = 4096):
    """Classes of side 0 and of side 1 (or all with all: side 2) -> a spanning forest of the links
    between their components. Intersections are products of incidence matrices, ``columns`` shingles at
    a time."""

    def run(group: pa.Table) -> pa.Table:
        nodes, homes, sides = (group[c].to_pylist() for c in ("node", "node_in", "side"))
        sets = [np.frombuffer(x, np.uint64) for x in group["hashes"].to_pylist()]
        sizes = np.array([len(x) for x in sets], np.int64)
        elements = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), sizes)
        _, place, seen = np.unique(elements, return_inverse=True, return_counts=True)
        common = np.cumsum(seen > 1) - 1  # columns of shingles that two classes have
        keep = seen[place] > 1
        owner, place = owner[keep], common[place[keep]]
        order = np.argsort(place, kind="stable")
        owner, place = owner[order], place[order]
        left = np.array([i for i, side in enumerate(sides) if side != 1], np.int64)
        right = np.array([i for i, side in enumerate(sides) if side != 0], np.int64)
        shared = np.zeros((len(left), len(right)), np.float32)
        for at in range(0, int(place[-1]) + 1 if len(place) else 0, columns):
            lo, hi = np.searchsorted(place, [at, at + columns])
            part = np.zeros((len(sets), columns), np.float32)
            part[owner[lo:hi], place[lo:hi] - at] = 1
            shared += part[left] @ part[right].T
        total = sizes[left][:, None] + sizes[right][None, :] - shared
        root = {h: h for h in homes}

        def find(x: bytes) -> bytes:
            while root[x] != x:
                root[x] = x = root[root[x]]
            return x

        a, b = [], []
        for i, j in zip(*np.nonzero(100 * shared >= threshold * total), strict=True):
            x, y = find(homes[left[i]]), find(homes[right[j]])
            if x != y:
                root[y] = x
                a.append(nodes[left[i]])
                b.append(nodes[right[j]])
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

    return run


def _with_component(df: DataFrame, col: str, labels: DataFrame) -> DataFrame:
    own = labels.select(F.col("node").alias(col), F.col("component").alias("found"))
    return df.join(own, col, "left").withColumn(f"{col}_in", F.coalesce("found", col)).drop("found")


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """labels (node, component) after more links (a, b); only components meet in the graph. What was written
    of both before goes."""
    ends = _with_component(_with_component(links.select("a", "b"), "a", labels), "b", labels).filter("a_in != b_in")
    ends = written(ends.select(F.col("a_in").alias("a"), F.col("b_in").alias("b")).distinct(), "near-ends")
    release(links)
    if ends.isEmpty():
        release(ends)
        return labels
    roots = connected_components(ends)
    release(ends)
    moved = labels.join(roots.select(F.col("node").alias("component"), F.col("component").alias("root")), "component", "left").select("node", F.coalesce("root", "component").alias("component"))
    out = written(moved.unionByName(roots.join(labels, "node", "left_anti")), "near-labels")
    release(roots, labels)
    return out


def _still_open(df: DataFrame) -> DataFrame:
    """Rows of the keys that hold several components."""
    keys = df.groupBy("key").agg(F.min("node_in").alias("lo"), F.max("node_in").alias("hi")).filter("lo != hi").select("key")
    return df.join(keys, "key", "left_semi")


def _viable(apart: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """(node, hashes) of the classes in apart that can have a link: a shingle that no other class there
    has cannot be shared, so n - n_alone bounds the intersection."""
    here = written(apart.select("node").distinct().join(sets, "node"), "near-open-sets")
    alone = here.mapInArrow(_elements, "element long, node binary").groupBy("element").agg(F.count(F.lit(1)).alias("n"), F.first("node").alias("node")).filter("n = 1")
    alone = alone.groupBy("node").agg(F.count(F.lit(1)).alias("n_alone"))
    n = F.expr("octet_length(hashes) div 8")
    out = written(here.join(alone, "node", "left").filter(100 * (n - F.coalesce("n_alone", F.lit(0))) >= threshold * n).select("node", "hashes"), "near-viable")
    release(here)
    return out


_LINKS = "a binary, b binary"


def _prefix_length(threshold: int) -> Column:
    return F.col("n") - F.ceil(F.col("n") * threshold / 100) + 1


def _prefixes(here: DataFrame, labels: DataFrame, threshold: int) -> DataFrame:
    """(element, seen, node, node_in, n): the rarest shingles of each class, as many as a link needs, that
    another class has too; seen is the number of classes that have the shingle."""
    n = F.expr("octet_length(hashes) div 8")
    elements = written(here.mapInArrow(_elements, "element long, node binary"), "near-elements")
    seen = written(elements.groupBy("element").agg(F.count(F.lit(1)).alias("seen")).filter("seen > 1"), "near-seen")
    shared = elements.join(seen, "element")
    sizes = here.select("node", n.cast("long").alias("n"))
    order = Window.partitionBy("node").orderBy("seen", "element")
    ranked = shared.select("node", "element", "seen", F.row_number().over(order).alias("k"))
    n_shared = shared.groupBy("node").agg(F.count(F.lit(1)).alias("n_shared"))
    sized = _with_component(sizes.join(n_shared, "node"), "node", labels)
    placed = ranked.join(sized, "node").withColumn("place", F.col("k") + F.col("n") - F.col("n_shared"))
    out = placed.filter(F.col("place") <= _prefix_length(threshold))
    out = written(out.select("element", "seen", "node", "node_in", "n"), "near-prefixes")
    release(elements, seen)
    return out


def _met_in_prefix(prefixes: DataFrame, threshold: int, short: int) -> tuple[DataFrame, DataFrame]:
    """(pairs (a, b) of classes that meet in a rare shingle of at most ``short`` classes and may have a link,
    rows (key, node) of the shingles with more).

    Shingles of the same classes (those of one passage) meet as one, with their number as weight. What two classes
    have in common is in both prefixes, or behind the end of the prefix that ends first: so the common weight
    and the rest of that class bound the intersection."""
    digests = [F.bit_xor(F.xxhash64(F.lit(k), "node")).alias(f"digest{k}") for k in (1, 2)]
    lists = prefixes.groupBy("element").agg(F.count(F.lit(1)).alias("m"), F.min("node_in").alias("lo"), F.max("node_in").alias("hi"), F.first("seen").alias("seen"), *digests)
    lists = written(lists.filter("lo != hi").select("element", "seen", "m", "digest1", "digest2"), "near-lists")
    same = lists.groupBy("m", "digest1", "digest2").agg(F.min(F.struct("seen", "element"))["element"].alias("element"), F.count(F.lit(1)).alias("weight"))
    same = written(same.select("element", "weight", "m"), "near-alike")
    long = lists.filter(F.col("m") > short).select("element", F.lit(1).alias("is_long"))
    ends = prefixes.join(long, "element", "left").groupBy("node").agg(F.max(F.struct("seen", "element")).alias("last"), F.count("is_long").alias("n_long"))
    few = prefixes.join(same.filter(F.col("m") <= short).select("element", "weight"), "element").join(ends, "node")
    few = written(few.select("element", "weight", "node", "node_in", "n", "last", "n_long", (F.col("n") - _prefix_length(threshold)).alias("rest")), "near-few")
    a, b = few.alias("a"), few.alias("b")
    met = a.join(b, "element").filter((F.col("a.node") < F.col("b.node")) & (F.col("a.node_in") != F.col("b.node_in")) & (100 * F.least("a.n", "b.n") >= threshold * F.greatest("a.n", "b.n")))
    rest = F.when(F.col("a.last") < F.col("b.last"), F.col("a.rest")).when(F.col("a.last") > F.col("b.last"), F.col("b.rest")).otherwise(F.least("a.rest", "b.rest"))
    met = met.select(F.col("a.node").alias("a"), F.col("b.node").alias("b"), "a.weight", (F.least("a.n_long", "b.n_long") + rest).alias("more"), (F.col("a.n") + F.col("b.n")).alias("total"))
    pairs = met.groupBy("a", "b").agg(F.sum("weight").alias("weight"), F.first("more").alias("more"), F.first("total").alias("total"))
    pairs = written(pairs.filter((100 + threshold) * (F.col("weight") + F.col("more")) >= threshold * F.col("total")).select("a", "b"), "near-met")
    many = written(prefixes.join(same.filter(F.col("m") > short).select("element"), "element").select(F.col("element").alias("key"), "node"), "near-many")
    release(lists, same, few)
    return pairs, many


def _crowd_links(apart: DataFrame, here: DataFrame, labels: DataFrame, threshold: int, block: int, block_bytes: int, dealings: int) -> DataFrame:
    """labels after all links between the classes (key, node, node_in) of buckets that still hold several
    components; here has their sets."""
    hubs = apart.groupBy("key").agg(F.min("node").alias("hub"))
    found = connected_components(apart.join(hubs, "key").select(F.col("node").alias("a"), F.col("hub").alias("b")))
    crowd = found.select("node", F.col("component").alias("crowd"))
    blocks = F.ceil(F.greatest(F.count(F.lit(1)) / block, F.sum(F.octet_length("hashes")) / block_bytes)).cast("int")
    sized = crowd.join(here, "node")
    sized = written(sized.join(sized.groupBy("crowd").agg(blocks.alias("blocks")), "crowd"), "near-crowds")
    release(found)
    for deal in range(dealings):
        dealt = _with_component(sized, "node", labels).withColumn("own", F.pmod(F.xxhash64("node", F.lit(deal)), F.col("blocks")))
        if deal:
            dealt = dealt.filter("blocks > 1")  # of the others all is known
        dealt = dealt.select("crowd", "own", F.lit(2).alias("side"), "node", "node_in", "hashes")
        labels = _merged(labels, written(dealt.groupBy("crowd", "own").applyInArrow(_forest(threshold), _LINKS), "near-dealt"))
    placed = written(_with_component(sized.filter("blocks > 1").select("crowd", "node", "blocks"), "node", labels), "near-placed")
    homes = placed.groupBy("crowd", "node_in").agg(F.count(F.lit(1)).alias("n")).groupBy("crowd").agg(F.max(F.struct("n", "node_in")).alias("home"))
    stray = written(placed.join(homes, "crowd").filter(F.col("node_in") != F.col("home.node_in")).select("crowd", "node", "node_in", "blocks"), "near-stray")
    if stray.isEmpty():
        release(sized, placed, stray)
        return labels
    strays, stray = stray, stray.join(here, "node")
    counts = stray.groupBy("crowd").agg(blocks.alias("stray_blocks"))
    asked = stray.join(counts, "crowd").withColumn("p", F.pmod(F.xxhash64("node"), F.col("stray_blocks")))
    asked = asked.select("crowd", "p", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks").cast("long") - 1)).alias("q"), F.lit(0).alias("side"), "node", "node_in", "hashes")
    all_there = placed.join(counts, "crowd").join(here, "node").withColumn("q", F.pmod(F.xxhash64("node"), F.col("blocks")))
    all_there = all_there.select("crowd", F.explode(F.sequence(F.lit(0).cast("long"), F.col("stray_blocks").cast("long") - 1)).alias("p"), "q", F.lit(1).alias("side"), "node", "node_in", "hashes")
    more = asked.unionByName(all_there).groupBy("crowd", "p", "q").applyInArrow(_forest(threshold), _LINKS)
    labels = _merged(labels, written(more, "near-last"))
    release(sized, placed, strays)
    return labels


def _components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 5,
    threshold: int = 75,
    bands: int = 32,
    rows: int = 4,
    block: int = 256,
    block_bytes: int = 16 << 20,
    dealings: int = 2,
    short: int = 256,
) -> DataFrame:
    """(doc_id, content, again, n_shingles, component, component_id) for every row of docs; threshold in
    percent. ``content`` and ``again`` are hashes of the text; ``component`` is null for empty sets."""
    spark = docs.sparkSession
    bounded_batches(spark)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sketched = written(
        source.select("*", *_content("text")).mapInArrow(_sketched(width, bands, rows), "doc_id long, content long, again long, n_shingles long, node binary, keys array<long>"), "near-sketches"
    )
    # classes of equal sets; keys are the same for all members
    classes = written(sketched.filter("node is not null").groupBy("node").agg(F.min("doc_id").alias("first_doc"), F.first("keys").alias("keys")), "near-classes")
    in_bands = classes.select("node", "first_doc", F.explode("keys").alias("key"))
    crowded = in_bands.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("first_doc", "node")).alias("pivot")).filter("n > 1")
    crowded = written(crowded.select("key", F.col("pivot.node").alias("pivot")), "near-crowded")  # written, so that the join can split a hot key
    members = written(in_bands.join(crowded, "key").select("key", "node", "pivot"), "near-members")
    pairs = written(members.filter("node != pivot").groupBy(F.col("node").alias("a"), F.col("pivot").alias("b")).agg(F.count(F.lit(1)).alias("n")), "near-pairs")
    # the full sets of the classes in crowded buckets, of one document each
    involved = written(members.select("node").distinct().join(classes.select("node", "first_doc"), "node"), "near-involved")
    wanted = IdFilter.of(involved, "first_doc", involved.count())
    sets = written(
        source.select("doc_id", "text", wanted.slot("doc_id").alias("slot"))
        .mapInArrow(_sets_of(wanted, width), "node binary, hashes binary")
        .dropDuplicates(["node"])
        .join(involved.select("node"), "node", "left_semi"),
        "near-sets",
    )

    def linked(todo: DataFrame) -> DataFrame:
        left = todo.join(sets.select(F.col("node").alias("a"), F.col("hashes").alias("x")), "a")
        both = left.join(sets.select(F.col("node").alias("b"), F.col("hashes").alias("y")), "b")
        return written(both.select("a", "b", "x", "y").mapInArrow(_compare(threshold), "a binary, b binary, linked boolean").filter("linked").select("a", "b"), "near-linked")

    best = pairs.groupBy("a").agg(F.max(F.struct("n", "b")).alias("best")).select("a", F.col("best.b").alias("b"))
    first = linked(best)
    labels = connected_components(first)
    release(first)
    rest = pairs.select("a", "b").join(best, ["a", "b"], "left_anti")
    rest = _with_component(_with_component(rest, "a", labels), "b", labels).filter("a_in != b_in").select("a", "b")
    rest = written(rest, "near-rest")
    if not rest.isEmpty():
        labels = _merged(labels, linked(rest))
    release(crowded, pairs, involved, rest)

    apart = written(_still_open(_with_component(members.select("key", "node"), "node", labels)), "near-open")
    if not apart.isEmpty():
        here = _viable(apart, sets, threshold)
        prefixes = _prefixes(here, labels, threshold)
        met, many = _met_in_prefix(prefixes, threshold, short)
        release(prefixes)
        if not met.isEmpty():
            labels = _merged(labels, linked(met))
        crowded = written(_still_open(_with_component(many, "node", labels)), "near-apart")
        if not crowded.isEmpty():
            labels = _crowd_links(crowded, here, labels, threshold, block, block_bytes, dealings)
        release(here, met, many, crowded)
    release(apart)
    release(members, sets)

    homes = _with_component(classes.select("node", "first_doc"), "node", labels)
    smallest = homes.groupBy("node_in").agg(F.min("first_doc").alias("component_id"))
    found = homes.join(smallest, "node_in").select("node", F.col("node_in").alias("component"), "component_id")
    out = sketched.select("doc_id", "content", "again", "n_shingles", "node").join(found, "node", "left")
    component_id = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    out = written(out.select("doc_id", "content", "again", "n_shingles", "component", component_id.alias("component_id")), "near-components")
    release(sketched, classes, labels)
    return out


def near_duplicates(docs: DataFrame, *args, **options) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of docs; parameters as of _components."""
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept")
    return _components(docs, *args, **options).select("doc_id", "n_shingles", "component_id", kept)


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each component one row stays, the one with the smallest id; null ids come
    last, and among rows of one id the text with the smallest hash. Empty texts are a component for
    each id, null included."""
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "content", "again")
    first = _components(docs).groupBy("component", F.when(F.col("component").isNull(), F.col("doc_id")).alias("blank")).agg(F.min(row).alias("row"))
    chosen = written(first.select(F.col("row.doc_id").alias("_id"), F.col("row.content").alias("_content"), F.col("row.again").alias("_again")), "near-chosen")
    content, again = _content("text")
    keyed = docs.select("*", F.col("doc_id").cast("long").alias("_id"), content.alias("_content"), again.alias("_again"))
    same = keyed["_id"].eqNullSafe(chosen["_id"]) & (keyed["_content"] == chosen["_content"]) & (keyed["_again"] == chosen["_again"])
    return keyed.join(chosen, same, "left_semi").dropDuplicates(["_id", "_content", "_again"]).select(docs.columns)


#: The contract: all pairs of sets that share a shingle, and a walk over the links.
OP3_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(words) >= 5 THEN list_transform(range(1, len(words) - 3), lambda k: array_to_string(list_slice(words, k, k + 4), ' '))
    WHEN len(words) > 0 THEN [array_to_string(words, ' ') || ' '] ELSE [] END) AS shingles FROM w
), sets AS (
  SELECT min(doc_id) AS doc_id, shingles, len(shingles) AS n FROM (SELECT doc_id, list_sort(shingles) AS shingles FROM s) GROUP BY shingles
), e AS (
  SELECT doc_id, n, unnest(shingles) AS shingle FROM sets
), met AS (
  SELECT a.doc_id AS a, b.doc_id AS b, a.n + b.n AS total, count(*) AS shared FROM e a JOIN e b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2, 3
), links AS (
  SELECT a, b FROM met WHERE 100 * shared >= 75 * (total - shared)
), ends AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), walk(node, label) AS (
  SELECT doc_id, doc_id FROM sets WHERE n > 0 UNION SELECT ends.b, walk.label FROM walk JOIN ends ON ends.a = walk.node
), roots AS (
  SELECT node, min(label) AS root FROM walk GROUP BY node
), named AS (
  SELECT s.doc_id, len(s.shingles) AS n, CASE WHEN len(s.shingles) = 0 THEN s.doc_id ELSE roots.root END AS component_id
  FROM s LEFT JOIN sets ON sets.shingles = list_sort(s.shingles) LEFT JOIN roots ON roots.node = sets.doc_id
)
SELECT doc_id, n::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM named
"""
