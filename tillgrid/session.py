"""Session helpers: a local session for tests and the bench, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the jobs rely on. They are all Spark SQL runtime settings, so
# a cluster session can take them as they are; sizes are left to the cluster.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def local_session(cores: int | str = 8, app: str = "tillgrid", memory: str = "16g") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores))
    )
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: the one that ``spark.checkpoint.dir`` names.

    A local session, whose executors are the driver, may do without one and gets
    a temporary folder; a cluster must name it.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    if not context.getCheckpointDir():
        context.setCheckpointDir(base)
    return base.rstrip("/")


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder below the shared folder."""
    return f"{shared_dir(spark)}/tillgrid-{purpose}-{uuid.uuid4().hex}"


LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


@contextmanager
def listing(spark: SparkSession) -> Iterator[None]:
    """Folders and files are listed by some tasks per core; Spark's default is a task for each of them, up to 10,000."""
    before = spark.conf.get(LISTING_TASKS)
    spark.conf.set(LISTING_TASKS, str(min(int(before), max(32, 4 * spark.sparkContext.defaultParallelism))))
    try:
        yield
    finally:
        spark.conf.set(LISTING_TASKS, before)


# Intermediate tables are written once and read soon: less disk matters more than the last bit of time.
SCRATCH_CODEC = "zstd"


def settle(df: DataFrame) -> DataFrame:
    """Compute a small result once and cut its lineage, in storage that outlives executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, purpose: str) -> DataFrame:
    """Write an intermediate table once to the shared folder and read it back: lineage ends, columns can be pruned."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.option("compression", SCRATCH_CODEC).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
