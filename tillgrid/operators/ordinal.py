"""Gapless row numbers by a distributed prefix sum."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillgrid.operators.joins import lookup_join
from tillgrid.session import written

# Rows of a partition are counted in the lower bits of Spark's row ids.
WITHIN_PARTITION = (1 << 33) - 1


def _shifts(counts: DataFrame, groups: list[str]) -> DataFrame:
    """``_part, [_group,] _shift``: what to add to a row's place in its partition."""
    if groups:
        before = Window.partitionBy("_group").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        shift = F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")
        return counts.select("_part", "_group", shift.alias("_shift"))
    # One row per partition: the driver adds them up, no task sees the whole table.
    rows = sorted((r["_part"], r["_rows"]) for r in counts.collect())
    sums = accumulate((n for _, n in rows), initial=0)
    return counts.sparkSession.createDataFrame([(part, s) for (part, _), s in zip(rows, sums)], "_part int, _shift bigint")


def number_rows(df: DataFrame, groups: list[str], order: str | Column | list[str | Column], name: str = "ordinal", start: int = 0,
                kept: bool = False) -> DataFrame:
    """Number the rows of each group in ``order``, without gaps.

    The rows are dealt into ranges of group and order and written down with
    their place in their partition. A row's number is that place, shifted by the
    rows of its group in the partitions before: one small row per partition and
    group. The order may be sparse and of any type that sorts, a hot group is
    spread over many ranges, and null groups count as a group of their own.
    Rows that are equal in group and order stay in one range, so the order
    should tell rows apart; rows it does not tell apart get any of their
    numbers.

    The input is computed once. ``kept`` says that it is a stored table already
    and may be read twice (for the bounds of the ranges and for the rows).
    """
    by = [F.col(g) for g in groups] + [F.col(o) if isinstance(o, str) else o for o in (order if isinstance(order, list) else [order])]
    source = df if kept else written(df, "numbering")
    count = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    columns = {"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id().bitwiseAND(F.lit(WITHIN_PARTITION))}
    if groups:
        columns["_group"] = F.struct(*groups)  # not null, also where a group's key is
    placed = written(source.repartitionByRange(count, *by).sortWithinPartitions(*by).withColumns(columns), "numbered")
    keys = ["_part", "_group"] if groups else ["_part"]
    counts = placed.groupBy(*keys).agg(F.count("*").alias("_rows"), F.min("_at").alias("_first"))
    numbered = lookup_join(placed, _shifts(counts, groups), keys, "inner")
    return numbered.withColumn(name, F.col("_at") + F.col("_shift") + F.lit(start)).drop("_part", "_at", "_group", "_shift")
