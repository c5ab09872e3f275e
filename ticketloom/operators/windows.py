"""Ranking, first-wins, quotas, batches and limits."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ticketloom.functions.columns import first_wins, with_ordinal
from ticketloom.session import bounded_batches, release, written

__all__ = ["first_wins", "with_ordinal"]


def limit_per_group(df: DataFrame, group: list[str], n: int, order: list) -> DataFrame:
    """The first n rows of each group; Spark limits groups before the shuffle as well."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def pick_representative(members: DataFrame) -> DataFrame:
    """Of members(cluster_id, ord, subject, problem, solution): the one with the longest solution; the
    longest problem if all solutions are empty, else the longest subject; ties to the smallest ord.
    One aggregation with map-side combine, no window over a cluster."""
    size = lambda c: F.length(F.coalesce(F.col(c), F.lit("")))
    best = lambda c: F.max(F.struct(size(c).alias("n"), (-F.col("ord")).alias("neg"))).alias(c)
    top = members.groupBy("cluster_id").agg(best("solution"), best("problem"), best("subject"))
    picked = F.when(F.col("solution.n") > 0, -F.col("solution.neg")).when(F.col("problem.n") > 0, -F.col("problem.neg")).otherwise(-F.col("subject.neg"))
    return top.select("cluster_id", picked.alias("representative_ord"))


def group_samples(df: DataFrame, group: str, groups: int, n: int, order: str) -> DataFrame:
    """The first n rows of each of the largest groups; ties between groups by first appearance. Rows without
    a group are a group."""
    counts = df.groupBy(group).agg(F.count(F.lit(1)).alias("group_size"), F.min(order).alias("_first"))
    largest = counts.orderBy(F.desc("group_size"), "_first").limit(groups)
    largest = F.broadcast(largest.select(F.col(group).alias("_group"), "group_size"))  # as many rows as groups are asked for
    return limit_per_group(df.join(largest, df[group].eqNullSafe(largest["_group"])).drop("_group"), [group], n, [order])


def assign_batches(df: DataFrame, size: int, order: list[str]) -> DataFrame:
    """Consecutive batches in order, with the file name of each; batches of one are named after their
    ticket, if there are ticket_id and subject."""
    if size < 1:
        raise ValueError("batch size below 1")
    n = with_ordinal(df, order, "position", start=1)
    batch = (F.floor((F.col("position") - 1) / size) + 1).cast("long")
    total = n.agg(F.max("position").alias("_total"))
    ends = F.least(batch * size, F.col("_total"))
    named = n.withColumn("batch", batch).join(F.broadcast(total))
    if size == 1 and {"ticket_id", "subject"} <= set(df.columns):
        return named.withColumn("file_name", F.concat(F.lit("ticket_"), F.col("ticket_id").cast("string"), F.lit("_"), safe_subject(F.col("subject")), F.lit(".docx"))).drop("_total")
    return named.withColumn("file_name", F.format_string("tickets_%04d-%04d_batch_%03d.docx", (F.col("batch") - 1) * size + 1, ends, F.col("batch"))).drop("_total")


def safe_subject(c: Column) -> Column:
    """A subject as part of a file name: reserved characters become "_", 50 characters at most."""
    return F.substring(F.regexp_replace(F.coalesce(c, F.lit("")), r'[<>:"/\\|?*]', "_"), 1, 50)


def safe_file_name(name: Column, doc_id: Column, ext: Column) -> Column:
    """Letters, digits, blank, full stop, underscore and hyphen of a name; document_<id>.<ext> if nothing
    is left."""
    kept = F.btrim(F.regexp_replace(F.coalesce(name, F.lit("")), r"[^\p{L}\p{N} ._-]", ""))
    spare = F.concat(F.lit("document_"), doc_id.cast("string"), F.lit("."), F.regexp_replace(F.coalesce(ext, F.lit("")), r"^\.", ""))
    return F.when(kept == "", spare).otherwise(kept)


def strip_prefix(c: Column, prefix: str) -> Column:
    """If an id starts with the prefix, it loses every occurrence of it."""
    return F.when(c.startswith(prefix), F.replace(c, F.lit(prefix), F.lit(""))).otherwise(c)


def ranked(df: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """Adds the rank of each row within its group, from 1. Groups are not gathered: ranks are differences
    of global ordinals, so a group with a third of all rows is spread like any other."""
    placed = with_ordinal(df, [*group, *order], "_place")
    firsts = placed.groupBy(*group).agg(F.min("_place").alias("_first"))
    return placed.join(firsts, group).withColumn(name, F.col("_place") - F.col("_first") + 1).drop("_place", "_first")


def allocate_quota(df: DataFrame, group: str, index: str, tokens: str, per_chapter: int, per_document: int | None = None, tokens_per_question: int = 350) -> DataFrame:
    """Questions for each chapter: half-even tokens / 350 within [0, per_chapter]; above the cap
    of the document scaled down by largest remainder, remainder ties to the larger index. Sums are
    aggregations with map-side combine, ranks come from ordinals; no document is gathered."""
    base = df.withColumn("base", F.greatest(F.lit(0), F.least(F.lit(per_chapter), F.bround(F.col(tokens) / tokens_per_question, 0).cast("long"))))
    if per_document is None:
        return base.withColumn("quota", F.col("base"))
    base = written(base, "quota")
    sums = base.groupBy(group).agg(F.sum("base").alias("_sum")).filter(F.col("_sum") > per_document)
    within = base.join(sums.select(group), group, "left_anti").withColumn("quota", F.col("base").cast("long"))
    share = F.col("base") * F.lit(per_document) / F.col("_sum")
    over = base.join(sums, group).withColumn("_floor", F.floor(share)).withColumn("_neg", -F.round(share - F.col("_floor"), 9)).withColumn("_back", -F.col(index))
    left = over.groupBy(group).agg((F.lit(per_document) - F.sum("_floor")).alias("_left"))
    rows = ranked(over, [group], ["_neg", "_back"], "_rank").join(left, group)
    scaled = rows.withColumn("quota", (F.col("_floor") + (F.col("_rank") <= F.col("_left")).cast("int")).cast("long"))
    return within.unionByName(scaled.select(within.columns))


def split_quota_over_chunks(df: DataFrame, n_col: str = "n", floor: int = 0, crowded: int = 1 << 16) -> DataFrame:
    """chunks(doc, chunk, tokens, n) -> ``quota``: max(1, half-even share), then one up or down in turn
    from the first chunk until the sum is n. The budget is at least floor * chunks. Going down, each turn
    takes one from every chunk above the floor: the number of whole turns is found from the sizes of
    levels, not by walking over chunks. Documents of at most ``crowded`` chunks are shuffled once and take
    windows; larger ones, of which there are few, are spread by ordinals."""
    base = written(df.filter("doc is not null"), "chunks")
    hot = written(base.groupBy("doc").agg(F.count(F.lit(1)).alias("_k")).filter(F.col("_k") > crowded).select("doc"), "crowded-documents")
    if hot.isEmpty():
        return _split_by_windows(base, n_col, floor).select(*df.columns, "quota")
    few = _split_by_windows(base.join(F.broadcast(hot), "doc", "left_anti"), n_col, floor)
    many = _split_by_ordinals(written(base.join(F.broadcast(hot), "doc", "left_semi"), "chunks"), n_col, floor)
    return few.select(*df.columns, "quota").unionByName(many.select(*df.columns, "quota"))


def _split_by_windows(base: DataFrame, n_col: str, floor: int) -> DataFrame:
    whole = Window.partitionBy("doc")
    in_turn = whole.orderBy("chunk").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    levels = whole.orderBy("_high").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    share = F.greatest(F.lit(1), F.bround(F.col(n_col) * F.col("tokens") / F.col("_tokens"), 0).cast("long"))
    rows = base.withColumn("_k", F.count(F.lit(1)).over(whole)).withColumn("_tokens", F.sum("tokens").over(whole)).withColumn("_share", share)
    rows = rows.withColumn("_high", F.col("_share") - floor).withColumn("_missing", F.greatest(F.max(n_col).over(whole), floor * F.col("_k")) - F.sum("_share").over(whole))
    # so many turns as a chunk has above the floor take _full from all chunks
    rows = rows.withColumn("_below", F.count(F.lit(1)).over(levels)).withColumn("_full", F.sum("_high").over(levels) + (F.col("_k") - F.col("_below")) * F.col("_high"))
    rows = rows.withColumn("_last", F.max(F.when(F.col("_full") <= -F.col("_missing"), F.struct("_high", "_full", "_below"))).over(whole))
    none = F.lit(0).cast("long")
    high, full, open_ = F.coalesce("_last._high", none), F.coalesce("_last._full", none), F.col("_k") - F.coalesce("_last._below", none)
    more = F.when(open_ > 0, F.floor((-F.col("_missing") - full) / open_)).otherwise(none)
    rows = rows.withColumn("_turns", (high + more).cast("long")).withColumn("_rest", (-F.col("_missing") - full - more * open_).cast("long"))
    still = F.col("_high") > F.col("_turns")
    rows = rows.withColumn("_i", F.row_number().over(whole.orderBy("chunk"))).withColumn("_turn", F.sum(still.cast("int")).over(in_turn))
    up = F.col("_share") + F.floor(F.col("_missing") / F.col("_k")) + (F.col("_i") <= F.pmod(F.col("_missing"), F.col("_k"))).cast("int")
    down = F.col("_share") - F.least("_high", "_turns") - (still & (F.col("_turn") <= F.col("_rest"))).cast("int")
    return rows.withColumn("quota", F.when(F.col("_missing") >= 0, up).otherwise(down).cast("long"))


def _split_by_ordinals(base: DataFrame, n_col: str, floor: int) -> DataFrame:
    """The same without a task that gets all chunks of a document."""
    columns = base.columns
    sums = base.groupBy("doc").agg(F.sum("tokens").alias("_tokens"), F.count(F.lit(1)).alias("_k"))
    share = F.greatest(F.lit(1), F.bround(F.col(n_col) * F.col("tokens") / F.col("_tokens"), 0).cast("long"))
    shares = written(ranked(base.join(sums, "doc").withColumn("_share", share), ["doc"], ["chunk"], "_i"), "shares")
    budget = shares.groupBy("doc").agg((F.greatest(F.max(n_col), floor * F.max("_k")) - F.sum("_share")).alias("_missing"))
    rows = shares.join(budget, "doc")
    up = F.col("_share") + F.floor(F.col("_missing") / F.col("_k")) + (F.col("_i") <= F.pmod(F.col("_missing"), F.col("_k"))).cast("int")

    # t turns take sum(least(share - floor, t)); the last full turn is the largest t that does not take too much
    kinds = rows.filter("_missing < 0").groupBy("doc", (F.col("_share") - floor).alias("_high")).agg(F.count(F.lit(1)).alias("_n"), (-F.max("_missing")).alias("_over"))
    packed = kinds.groupBy("doc").agg(F.max("_over").alias("_over"), F.array_sort(F.collect_list(F.struct("_high", "_n"))).alias("_levels"))
    start = F.struct(F.lit(0).cast("long").alias("turns"), F.col("_over").alias("rest"), F.aggregate("_levels", F.lit(0).cast("long"), lambda acc, x: acc + x["_n"]).alias("open"))

    def turn(acc: Column, x: Column) -> Column:
        most = F.when(acc["open"] > 0, F.floor(acc["rest"] / acc["open"])).otherwise(0)
        t = F.least(x["_high"] - acc["turns"], most)
        on = F.when(t == x["_high"] - acc["turns"], acc["open"] - x["_n"]).otherwise(acc["open"])
        return F.struct((acc["turns"] + t).cast("long").alias("turns"), (acc["rest"] - t * acc["open"]).cast("long").alias("rest"), on.cast("long").alias("open"))

    done = packed.select("doc", F.aggregate("_levels", start, turn).alias("_t"))
    down = rows.filter("_missing < 0").join(done, "doc")
    still = down.filter(F.col("_share") - floor > F.col("_t.turns"))
    extra = ranked(still.select("doc", "chunk", "_i"), ["doc"], ["_i"], "_turn").drop("_i")
    lowered = down.join(extra, ["doc", "chunk"], "left")
    taken = F.least(F.col("_share") - floor, F.col("_t.turns")) + F.coalesce((F.col("_turn") <= F.col("_t.rest")).cast("int"), F.lit(0))
    out = rows.filter("_missing >= 0").withColumn("quota", up.cast("long")).select(*columns, "quota")
    return out.unionByName(lowered.withColumn("quota", (F.col("_share") - taken).cast("long")).select(*columns, "quota"))


def _roots(named: DataFrame, stem: Column, ext: Column) -> DataFrame:
    """(_where, _name, _root) of the names that a repeated name can reach: a name's forebears are what is left
    when numbers go from the end of its stem one by one, itself included; its root is the shortest one that
    is repeated in the folder. Other names meet nobody."""
    names = named.filter("_name is not null").groupBy("_where", "_name").agg(F.count(F.lit(1)).alias("_n"))
    names = written(names.withColumn("_stem", stem).withColumn("_ext", ext), "name-counts")
    numbers = F.regexp_extract("_stem", r"((?:_\d+)+)$", 1)
    base = F.expr("left(_stem, length(_stem) - length(_tail))")
    cut = names.withColumn("_tail", numbers).withColumn("_base", base).withColumn("_parts", F.filter(F.split("_tail", "_"), lambda p: p != ""))
    forebear = lambda k: F.concat("_base", F.array_join(F.transform(F.slice("_parts", 1, k), lambda p: F.concat(F.lit("_"), p)), ""), "_ext")
    each = cut.select("_where", "_name", F.explode(F.transform(F.sequence(F.lit(0), F.size("_parts")), lambda k: F.struct(k.alias("k"), forebear(k).alias("name")))).alias("f"))
    repeated = names.filter("_n > 1").select("_where", F.col("_name").alias("_root"))
    met = each.select("_where", "_name", "f.k", F.col("f.name").alias("_root")).join(repeated, ["_where", "_root"])
    out = written(met.groupBy("_where", "_name").agg(F.min_by("_root", "k").alias("_root")), "name-roots")
    release(names)
    return out


def number_collisions(df: DataFrame, name_col: str = "name", order: str = "ord", folder: str | None = None) -> DataFrame:
    """Adds ``final_name``: rows in order take their name if it is free in the folder, else the first free
    one of stem_1.ext, stem_2.ext ... A null name stays null.

    A name can only be in the way of a repeated one whose numbers lead to it (``_roots``); all others stay as
    they are, however many share a stem. Where all rows of a family have one name, its numbers are ranks, counted
    without gathering the family in a task; families of a repeated name and numbered ones go through one by
    one.
    """
    bounded_batches(df.sparkSession)
    where = F.col(folder).cast("string") if folder else F.lit("")
    stem, ext = F.regexp_extract("_name", r"^(.*?)(\.[^.]*)?$", 1), F.regexp_extract("_name", r"^(.*?)(\.[^.]*)?$", 2)
    named = written(df.withColumn("_where", F.coalesce(where, F.lit(""))).withColumn("_name", F.col(name_col).cast("string")), "names")
    roots = _roots(named, stem, ext)
    rooted = named.join(roots, ["_where", "_name"], "left")
    free = rooted.filter("_root is null").withColumn("final_name", F.col("_name"))
    family = rooted.filter("_root is not null").withColumn("_family", F.struct("_where", "_root"))
    mixed = roots.groupBy(F.struct("_where", "_root").alias("_family")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("_family", F.lit(True).alias("_mixed"))
    marked = family.join(mixed, "_family", "left")
    plain = ranked(marked.filter("_mixed is null"), ["_family"], [order], "_rank")
    final = F.when(F.col("_rank") == 1, F.col("_name")).otherwise(F.concat(stem, F.lit("_"), (F.col("_rank") - 1).cast("string"), ext))
    plain = free.select(*df.columns, "final_name").unionByName(plain.withColumn("final_name", final).select(*df.columns, "final_name"))

    columns = df.columns

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by(order)
        taken: set[str] = set()
        tried: dict[str, int] = {}
        out: list[str | None] = []
        for name in group["_name"].to_pylist():
            if name in taken:
                head, dot, tail = name.rpartition(".")
                head, tail = (head, dot + tail) if dot else (name, "")
                i = tried.get(name, 0) + 1
                while f"{head}_{i}{tail}" in taken:
                    i += 1
                tried[name] = i
                name = f"{head}_{i}{tail}"
            taken.add(name)
            out.append(name)
        return group.select(columns).append_column("final_name", pa.array(out, pa.string()))

    rest = marked.filter("_mixed").select(*df.columns, "_name", "_family")
    rest = rest.groupBy("_family").applyInArrow(run, StructType([*df.schema.fields, StructField("final_name", StringType())]))
    return plain.select(*df.columns, "final_name").unionByName(rest)


def keep_newest(df: DataFrame, n: int, order: list) -> DataFrame:
    """The n newest rows; the rest is what a clean-up deletes."""
    return df.orderBy(*order).limit(n)


def canonical_order(df: DataFrame) -> DataFrame:
    return df.orderBy(F.desc("size"), F.coalesce("date", F.lit("")), "cluster_id")


def newest_first(df: DataFrame, id_col: str = "ticket_id") -> DataFrame:
    """Numeric ids descending; other ids count as -1, in input order."""
    return df.orderBy(F.desc(F.coalesce(F.expr(f"try_cast(`{id_col}` as bigint)"), F.lit(-1))), "ord")
