"""Sharding by longest processing time: groups that must stay together, the largest first, each to the least loaded shard.

Equal texts are a group and stay in one shard; a shard's load is the bytes of
its texts and 8 for each. The law is ``bytes``: sizes near equal, as far as the
groups allow.

The heap takes items in descending size. A group larger than 1 / (shards *
``PIECES``) of all bytes is an item of its own; there are fewer of those than
shards * ``PIECES``, whatever the data. The groups below that size are dealt by
hash into that many bundles, each an item too. So the heap sees at most
2 * shards * ``PIECES`` items, which is all that comes to the driver and is sent
back, and what is left out of balance is about the size of the last bundles:
some 1 / ``PIECES`` of a shard. A group that holds more than a shard's share of
bytes cannot be split; it fills a shard alone, and the others share the rest.

Rows are hashed once and stored without their texts. Sizes of groups are sums
that combine before the shuffle, shards come by joins of the bounded items, and
places in a shard by a distributed prefix sum, so a group of any number of rows
is never in one task.

Null texts have no bytes and count as equal to empty ones. Rows that repeat a
document keep together and get a place each; null doc_ids come first in their
shard. An empty table gives no rows. Columns beyond doc_id and text are not
looked at. Texts whose 128-bit hashes were equal would share a shard.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillgrid.llm.common import stored
from tillgrid.operators.ordinal import number_rows

SHARDS, PIECES, ROW_BYTES = 24, 512, 8
GROUP = ["h1", "h2"]


def text_bytes() -> Column:
    return F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")


def group_of() -> list[Column]:
    """The two halves of a text's hash."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2")]


def longest_first(items: list[tuple[int, tuple]], shards: int) -> dict[tuple, int]:
    """Item to shard: in descending size (then by name) to the shard with the least load (then the first)."""
    loads = [(0, shard) for shard in range(shards)]
    out = {}
    for size, item in sorted(items, key=lambda i: (-i[0], i[1])):
        load, shard = loads[0]
        out[item] = shard
        heapq.heapreplace(loads, (load + size, shard))
    return out


@dataclass(frozen=True)
class Plan:
    """Shards of the large groups (h1, h2) and of the bundles of small ones; both bounded by shards * pieces rows."""

    large: DataFrame
    bundles: DataFrame
    count: int  # of bundles


def plan(rows: DataFrame, shards: int = SHARDS, pieces: int = PIECES) -> Plan:
    """Deal the groups of ``rows`` (h1, h2, size) to shards."""
    spark, most = rows.sparkSession, shards * pieces
    groups = stored(rows.groupBy(*GROUP).agg(F.sum("size").alias("size")), "shard-groups")
    least = (groups.agg(F.sum("size")).first()[0] or 0) / most
    bundle = F.pmod("h1", F.lit(most))
    # Fewer than `most` groups can be larger than one of `most` equal parts, and there are at most `most` bundles.
    large = [(r["size"], (0, r["h1"], r["h2"])) for r in groups.where(F.col("size") > least).collect()]
    small = groups.where(F.col("size") <= least).groupBy(bundle.alias("bundle")).agg(F.sum("size").alias("size")).collect()
    dealt = longest_first(large + [(r["size"], (1, r["bundle"], 0)) for r in small], shards)
    return Plan(
        spark.createDataFrame([(*item[1:], shard) for item, shard in dealt.items() if item[0] == 0], "h1 long, h2 long, own int"),
        spark.createDataFrame([(item[1], shard) for item, shard in dealt.items() if item[0] == 1], "bundle long, shared int"),
        most,
    )


def place(rows: DataFrame, dealt: Plan) -> DataFrame:
    """Add ``shard`` to rows that have h1 and h2."""
    found = rows.join(F.broadcast(dealt.large), GROUP, "left").withColumn("bundle", F.pmod("h1", F.lit(dealt.count)))
    found = found.join(F.broadcast(dealt.bundles), "bundle", "left")
    return found.withColumn("shard", F.coalesce("own", "shared")).drop("bundle", "own", "shared")


def assign(docs: DataFrame, shards: int = SHARDS, pieces: int = PIECES) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard``; slots ascend by doc_id in their shard."""
    rows = stored(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), (text_bytes() + ROW_BYTES).alias("size"),
            F.crc32(F.coalesce(F.col("text"), F.lit(""))).alias("text_crc32"), *group_of(), F.monotonically_increasing_id().alias("row"),
        ),
        "shard-rows",
    )
    placed = place(rows, plan(rows, shards, pieces))
    # Bundles and groups come by broadcast of stored tables, so the rows may be read twice.
    numbered = number_rows(placed, ["shard"], [F.col("doc_id").asc_nulls_first(), F.col("row")], "slot", kept=True)
    return numbered.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, pieces: int = PIECES) -> None:
    """Write documents, all their columns kept, as one folder per shard; large shards are cut into several files."""
    sized = docs.select(*group_of(), (text_bytes() + ROW_BYTES).alias("size"))
    kept = docs.select(F.struct(*docs.columns).alias("kept"), "text").select("kept", *group_of())
    placed = place(kept, plan(sized, shards, pieces)).select("kept.*", F.col("shard").alias("_shard"))
    placed.hint("rebalance", "_shard").write.partitionBy("_shard").parquet(path)
