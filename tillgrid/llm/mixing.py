"""Mixing sources to target weights by entropy balancing.

Every document gets a rate, the expected number of its copies. Among all rates
that give each source its target of tokens, those nearest to one copy each (in
relative entropy) are exponentially tilted by the document's size: with at most
``CAP`` copies, rate = min(CAP, exp(lambda * size / scale)). The lambdas solve a
convex dual. Its Newton steps run as aggregations over the table of distinct
sizes per source; as a document belongs to one source, the Hessian is diagonal
and every source takes its own step, kept in a bracket so that it cannot leave
the side where the solution lies. What is known of a source, its lambda and its
bracket, is a row of a table that each step joins and writes anew, so nothing of
the size of the number of sources comes to the driver or into one task. Sources
that do not settle are an error.

Rates are then rounded to whole copies. A source's documents are dealt into
buckets by a hash, however large the source is; in a bucket they are taken from
the largest to the smallest and each is rounded so as to undo the error made so
far, so the error left is about the size of the smallest documents. Buckets and
order depend on the rows alone, so a rerun gives the same copies.

Null and blank texts have size 0: rate and copies are 1, and they add no tokens.
A null source is a source of its own, last in order. A mix of empty sources has
targets of 0. Rows that repeat a document are counted each and get equal copies.
"""

from __future__ import annotations

from math import ceil, floor

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillgrid.llm.common import WORD, stored
from tillgrid.operators.joins import fits_broadcast
from tillgrid.operators.ordinal import number_rows

WEIGHTS = (5.0, 2.0, 1.0)
CAP = 3
STEPS, TOLERANCE = 200, 1e-9
BUCKET_ROWS = 20_000
STEEPEST, MOST_EXPONENT = 1e12, 50.0
MOST_SOURCES = 10_000  # beyond so many sources their tables are joined by shuffle


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """source, sid, source_size, weight, target; one row per source.

    Sources in order of their code points, null last, take the weights in turn
    and share all tokens by them. Where a share is above ``cap`` times the
    source's size it stops there, and the rest is shared anew by weight among
    the others until none is above. A step is one aggregate over the sources.
    """
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    given = F.array(*map(F.lit, weights))
    numbered = number_rows(sums, [], F.col("source").asc_nulls_last(), "sid", start=0)
    table = stored(numbered.withColumn("weight", F.element_at(given, (F.col("sid") % len(weights) + 1).cast("int"))), "mix-sources")
    limit = F.col("source_size") * F.lit(float(cap))
    total = float(table.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0])
    rate, capped = 0.0, -1
    while True:
        # at this rate per weight some sources are full; the others share what those leave
        full = limit <= F.col("weight") * F.lit(rate)
        row = table.agg(F.count_if(full), F.sum(F.when(full, limit).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).first()
        if row[0] == capped or not row[2]:
            break
        capped, rate = row[0], (total - row[1]) / row[2]
    return table.withColumn("target", F.least(limit, F.col("weight") * F.lit(rate)))


def tilts(sizes: DataFrame, targets: DataFrame, cap: float = CAP) -> DataFrame:
    """sid, lam, scale for every source with tokens: rate = least(cap, exp(lam * size / scale)).

    Newton's method on the dual. Its data are the distinct sizes per source
    with their counts. A step reads the table of sources, adds up the tokens
    taken and their slope for those that are open, and writes the table of the
    next step; the driver learns how many are still open. A source is settled
    when it meets its target, or when its bracket holds no number in between.
    """
    bins = stored(
        sizes.where("size > 0").groupBy("sid", "size").agg(F.sum("same").alias("n")).join(
            small(targets.select("sid", "target")), "sid"
        ),
        "mix-sizes",
    )
    everything = F.sum(F.col("size") * F.col("n"))
    start = bins.groupBy("sid").agg(everything.alias("all"), F.sum("n").alias("n"), F.first("target").alias("target"))
    full, none = F.col("target") >= cap * F.col("all"), F.col("target") <= 0
    state = stored(
        start.select(
            "sid", F.when(full, STEEPEST).when(none, -STEEPEST).otherwise(0.0).alias("lam"), (F.col("all") / F.col("n")).alias("scale"),
            F.lit(-STEEPEST).alias("low"), F.lit(STEEPEST).alias("high"), (~full & ~none).alias("open"),
        ),
        "mix-tilts",
    )
    x = F.col("size") / F.col("scale")
    free = F.exp(F.least(F.col("lam") * x, F.lit(MOST_EXPONENT)))
    rate = F.least(free, F.lit(float(cap)))
    known = ["lam", "scale", "low", "high", "target"]
    miss = F.col("target") - F.col("taken")
    met = F.abs(miss) <= F.lit(TOLERANCE) * F.col("target") + F.lit(1e-6)
    newton = F.col("lam") + F.when(F.col("slope") > 0, miss / F.col("slope"))
    reach = 1 + 8 * F.abs(F.col("lam"))  # a step goes no further, so that none has to be halved back from the bracket's ends
    near, far = F.greatest("low", F.col("lam") - reach), F.least("high", F.col("lam") + reach)
    for _ in range(STEPS):
        left = state.where("open")
        if left.isEmpty():
            return state.select("sid", "lam", "scale")
        sums = bins.join(small(left.drop("open")), "sid").groupBy("sid").agg(
            F.sum(F.col("n") * F.col("size") * rate).alias("taken"),
            F.sum(F.when(free < cap, F.col("n") * F.col("size") * x * rate).otherwise(0.0)).alias("slope"),
            *[F.first(c).alias(c) for c in known],
        )
        narrowed = sums.withColumns({"low": F.when(miss > 0, F.col("lam")).otherwise(F.col("low")), "high": F.when(miss > 0, F.col("high")).otherwise(F.col("lam"))})
        stepped = narrowed.withColumn("step", F.when((newton > near) & (newton < far), newton).otherwise((near + far) / 2))
        done = met | (F.col("step") == F.col("lam")) | (F.col("step") <= F.col("low")) | (F.col("step") >= F.col("high"))
        after = stepped.select("sid", F.when(done, F.col("lam")).otherwise(F.col("step")).alias("lam"), "scale", "low", "high", (~done).alias("open"))
        state = stored(after.unionByName(state.where("not open")), "mix-tilts")
    raise RuntimeError(f"the rates of {state.where('open').count()} sources did not settle in {STEPS} steps")


ROUNDED = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("sid", pa.int64()), ("size", pa.int64()), ("same", pa.int64()), ("rate", pa.float64()), ("copies", pa.int32())])


def rounded(bucket: pa.Table) -> pa.Table:
    """Copies for one bucket: from the largest document down, each rounding undoes the error made so far."""
    rows = bucket.sort_by([("size", "descending"), ("row", "ascending")])
    error, copies = 0.0, []
    for size, same, rate in zip(*(rows.column(c).to_pylist() for c in ("size", "same", "rate"))):
        n = round(rate + error / (size * same)) if size else 1
        n = min(max(n, floor(rate)), ceil(rate))
        error += (rate - n) * size * same
        copies.append(n)
    return rows.select(ROUNDED.names[:-1]).append_column("copies", pa.array(copies, pa.int32())).cast(ROUNDED)


def keyed(docs: DataFrame) -> DataFrame:
    """row (a hash of what the mix knows of a row), doc_id, source, size, same (how many rows are equal in these)."""
    row = F.xxhash64(F.col("doc_id").cast("long"), F.col("source").cast("string"), F.xxhash64("text"))
    rows = docs.select(row.alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), n_words(F.col("text")).alias("size"))
    return rows.groupBy("row", "doc_id", "source", "size").agg(F.count("*").alias("same"))


def small(df: DataFrame) -> DataFrame:
    """Broadcast a table of one row per source if a count shows it to be small."""
    return F.broadcast(df) if fits_broadcast(df, MOST_SOURCES) else df


def mixed(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """row, doc_id, size, same, source_size, target, rate, copies for every distinct row of ``keyed``.

    The texts are read once; what follows works on ids and sizes.
    """
    sizes = stored(keyed(docs), "mix-documents")
    targets = stored(source_targets(sizes.select("source", (F.col("size") * F.col("same")).alias("size")), weights, cap), "mix-targets")
    joined = sizes.join(small(targets.select(F.col("source").alias("_source"), "sid")), sizes.source.eqNullSafe(F.col("_source"))).drop("_source")
    lams = tilts(joined, targets, cap)
    counts = joined.groupBy("sid").agg(F.count("*").alias("_n"))
    tilt = F.least(F.exp(F.least(F.col("lam") * F.col("size") / F.col("scale"), F.lit(MOST_EXPONENT))), F.lit(float(cap)))
    dealt = joined.join(small(lams), "sid", "left").join(small(counts), "sid").select(
        "row", "doc_id", "sid", "size", "same", F.when(F.col("size") > 0, F.coalesce(tilt, F.lit(0.0))).otherwise(1.0).alias("rate"),
        F.pmod("row", F.ceil(F.col("_n") / BUCKET_ROWS).cast("long")).alias("bucket"),
    )
    copies = dealt.groupBy("sid", "bucket").applyInArrow(rounded, "row long, doc_id long, sid long, size long, same long, rate double, copies int")
    return copies.join(small(targets.select("sid", "source_size", "target")), "sid")


def report(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies, rate of every row of docs."""
    rows = mixed(docs, weights, cap)
    return rows.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies", "rate",
        F.explode(F.sequence(F.lit(1), "same")).alias("_same"),
    ).drop("_same")


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """The mix itself: every row of docs as often as its copies, with the columns of docs.

    The join's other side holds hashes and copies; the texts are dealt out once.
    """
    copies = mixed(docs, weights, cap).select(F.col("row").alias("_row"), F.col("copies").alias("_copies"))
    row = F.xxhash64(F.col("doc_id").cast("long"), F.col("source").cast("string"), F.xxhash64("text"))
    joined = docs.withColumn("_row", row).join(copies.where("_copies > 0"), "_row")
    return joined.withColumn("_copy", F.explode(F.sequence(F.lit(1), "_copies"))).select(*docs.columns)
