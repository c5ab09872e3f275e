"""Graph operators: connected components and bounded-depth reachability."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ticketloom.session import release, written


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 50) -> DataFrame:
    """(node, component) for every node of an edge; component is the smallest node reachable.

    Minimum-label hooking with pointer jumping. Each round is two joins on node keys and two
    aggregations with map-side combine; labels are written to the shared folder after each round,
    so the plan stays short and lost executors cost no recomputation of earlier rounds. Nulls and
    self loops: an edge with a null end is ignored, a self loop makes a component of one. Rounds grow with
    the logarithm of the longest path; more than ``max_rounds`` are an error, never a partial result.
    """
    links = written(
        edges.filter(F.col(a).isNotNull() & F.col(b).isNotNull())
        .select(F.explode(F.array(F.struct(F.col(a).alias("s"), F.col(b).alias("t")), F.struct(F.col(b).alias("s"), F.col(a).alias("t")))).alias("e"))
        .select("e.s", "e.t")
        .distinct(),
        "cc-links",
    )
    labels = written(links.groupBy(F.col("s").alias("node")).agg(F.least(F.min("t"), F.first("s")).alias("component")), "cc-labels")
    before = labels
    for _ in range(max_rounds):
        heard = links.join(labels, links.t == labels.node).groupBy(F.col("s").alias("node")).agg(F.min("component").alias("heard"))
        met = labels.join(heard, "node", "left").select("node", "component", F.least("component", "heard").alias("near"))
        roots = labels.select(F.col("node").alias("near"), F.col("component").alias("root"))
        step = met.join(roots, "near", "left").select("node", F.col("component").alias("old"), F.least("near", F.coalesce("root", "near")).alias("component"))
        seen = Observation()  # counted while the labels are written
        new = written(step.observe(seen, F.count(F.when(F.col("old") != F.col("component"), 1)).alias("changed")), "cc-labels")
        done = not seen.get["changed"]
        release(before)
        before, labels = new, new.select("node", "component")
        labels._written_path = new._written_path  # so that release() knows it
        if done:
            release(links)
            return labels
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
