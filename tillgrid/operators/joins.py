"""Lookup joins that hold for a dimension and a hot key of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A side is broadcast only after a look at it showed no more rows and bytes than this.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 64 << 20
# A key is spread when it holds at least this share of the rows and this many of them.
HOT_SHARE = 1 / 256
HOT_ROWS = 1_000_000
SALTS = 64


def fits_broadcast(dim: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Count the side's rows and (as JSON text) bytes, reading no more than ``max_rows + 1`` of its rows."""
    if max_rows <= 0:
        return False
    # Sizes alone come together: each partition gives up to the limit.
    size = F.octet_length(F.to_json(F.struct("*"))).cast("bigint").alias("_size")
    rows, found = dim.select(size).limit(max_rows + 1).agg(F.count("*"), F.coalesce(F.sum("_size"), F.lit(0))).first()
    return rows <= max_rows and found <= max_bytes


def small_join(facts: DataFrame, dim: DataFrame, on: str | list[str], how: str = "left", max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Like ``lookup_join`` for facts that are unique on their key, which thus has no hot values."""
    return facts.join(F.broadcast(dim) if fits_broadcast(dim, max_rows) else dim, on, how)


def lookup_join(facts: DataFrame, dim: DataFrame, on: str | list[str], how: str = "left",
                max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Equi join of facts to a dimension that is unique on the key (or a semi/anti filter).

    Small dimensions are broadcast, so the facts are not shuffled. Beyond the
    checked size both sides are shuffled, hot keys spread over many tasks.
    ``max_rows=0`` leaves the check out where counting the side is a job of its
    own size.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if fits_broadcast(dim, max_rows):
        return facts.join(F.broadcast(dim), keys, how)
    return spread_join(facts, dim, keys, how)


def hot_keys(facts: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Hashes of the keys that hold a large share of the rows, at most ``1 / HOT_SHARE`` of them.

    They come from a mergeable top-k sketch over the key columns alone. The
    result steers only the spreading: an estimate that is off changes no row.
    """
    most = int(1 / HOT_SHARE)
    sketch = facts.select(F.xxhash64(*keys).alias("_join_hash")).agg(
        F.expr(f"approx_top_k(_join_hash, {most}, {most * 16})").alias("_top"), F.count("*").alias("_rows")
    )
    return (
        sketch.select(F.explode("_top").alias("_item"), "_rows")
        .where((F.col("_item.count") >= hot_rows) & (F.col("_item.count") >= F.col("_rows") * HOT_SHARE))
        .select(F.col("_item.item").alias("_join_hash"), F.lit(True).alias("_join_hot"))
    )


def spread_join(facts: DataFrame, dim: DataFrame, keys: list[str], how: str = "left",
                hot_rows: int = HOT_ROWS, salts: int = SALTS) -> DataFrame:
    """Shuffle join whose hot keys are salted.

    Rows of a hot key go to ``salts`` places by a hash of the row, and only the
    few dimension rows of hot keys are repeated that often. A hash, unlike a
    random number, sends a row to the same place when its task runs again. Rows
    that are equal in every column stay together; Spark's skew join splits
    those. Without hot keys it is a plain shuffle join.
    """
    found = hot_keys(facts, keys, hot_rows).collect()
    if not found:
        return facts.join(dim, keys, how)
    hot = F.broadcast(facts.sparkSession.createDataFrame(found, "_join_hash bigint, _join_hot boolean"))
    is_hot = F.col("_join_hot")
    salt = F.when(is_hot, F.pmod(F.xxhash64(*facts.columns), F.lit(salts)).cast("int")).otherwise(F.lit(0))
    every_salt = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))

    def salted(side: DataFrame, value: Column) -> DataFrame:
        marked = side.withColumn("_join_hash", F.xxhash64(*keys)).join(hot, "_join_hash", "left")
        return marked.withColumn("_join_salt", value).drop("_join_hash", "_join_hot")

    joined = salted(facts, salt).join(salted(dim, F.explode(every_salt)), [*keys, "_join_salt"], how)
    return joined.drop("_join_salt")
