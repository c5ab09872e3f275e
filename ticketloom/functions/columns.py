"""Column helpers shared by operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def filled(c: Column | str) -> Column:
    """Null for the empty string too."""
    return F.nullif(F.col(c) if isinstance(c, str) else c, F.lit(""))


def held(df: DataFrame, keys: list[str], **columns: Column) -> DataFrame:
    """keys and computed columns, each computed once for a row. Without this the optimizer may put an
    expression into every place that reads it, also inside a lambda, once for each element."""
    row = F.explode(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))).alias("_held")
    return df.select(*keys, row).select(*keys, "_held.*")


def with_ordinal(df: DataFrame, order: list[str], name: str = "ord", start: int = 0, slots: int | None = None) -> DataFrame:
    """A gapless global ordinal in the given order, without gathering all rows in one task.

    Rows are range-partitioned; each partition is numbered by itself and shifted by the sizes of the
    partitions before it. Only the partition sizes (``slots`` rows, spark.sql.shuffle.partitions if not
    given) meet in one place.
    """
    from pyspark.sql import Window

    from ticketloom.session import written

    slots = slots or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = written(df.repartitionByRange(slots, *order).withColumn("_ordinal_slot", F.spark_partition_id()), "ordinal")
    sizes = ranged.groupBy("_ordinal_slot").agg(F.count(F.lit(1)).alias("_ordinal_n"))
    before = Window.orderBy("_ordinal_slot").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("_ordinal_slot", F.coalesce(F.sum("_ordinal_n").over(before), F.lit(0)).alias("_ordinal_before"))
    place = Window.partitionBy("_ordinal_slot").orderBy(*order)
    numbered = ranged.withColumn("_ordinal_k", F.row_number().over(place)).join(F.broadcast(shifts), "_ordinal_slot")
    return numbered.withColumn(name, F.col("_ordinal_before") + F.col("_ordinal_k") - 1 + start).drop("_ordinal_slot", "_ordinal_k", "_ordinal_before")


def first_wins(df: DataFrame, keys: list[str | Column], order: list[str | Column]) -> DataFrame:
    """The first row of each key in the given order. Uses min_by of the whole row, so that a hot key
    is combined before the shuffle."""
    named = [(k if isinstance(k, Column) else F.col(k)).alias(f"_key{i}") for i, k in enumerate(keys)]
    rank = F.struct(*[(o if isinstance(o, Column) else F.col(o)).alias(f"_o{i}") for i, o in enumerate(order)])
    row = F.struct(*[F.col(c) for c in df.columns])
    return df.groupBy(*named).agg(F.min_by(row, rank).alias("_row")).select("_row.*")
