"""Landed JSON: pages of workplaces and KPI report payloads, one JSON text per row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillgrid.operators.joins import small_join
from tillgrid.operators.ordinal import number_rows

PAGE_SIZE = 500
PAGE_SCHEMA = "data array<struct<name: string, id: bigint>>"


def read_json_texts(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """``file_name, file_path, payload``: each landed response is one file."""
    scan = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", "true").text(path, wholetext=True)
    return scan.select(F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.file_path").alias("file_path"), F.col("value").alias("payload"))


def read_pages(spark: SparkSession, path: str, pattern: str = r"(\d+)\.json$", glob: str = "*.json") -> DataFrame:
    """``page, payload`` of landed pages; by default the number at the end of a file's path is its page."""
    texts = read_json_texts(spark, path, glob)
    return texts.select(F.regexp_extract("file_path", pattern, 1).try_cast("bigint").alias("page"), "payload")


def read_kpi_reports(spark: SparkSession, path: str, pattern: str = r"^(\d+)_(\d{4}-\d{2}-\d{2})") -> DataFrame:
    """``workplace_id, report_date, payload`` of landed KPI responses named ``{workplace}_{day}….json``.

    Of several responses for a workplace and day the one with the greatest name
    counts.
    """
    texts = read_json_texts(spark, path)
    named = texts.select(
        F.regexp_extract("file_name", pattern, 1).try_cast("bigint").alias("workplace_id"),
        F.try_to_date(F.regexp_extract("file_name", pattern, 2)).alias("report_date"), "file_name", "payload",
    ).where("workplace_id is not null and report_date is not null")
    return named.groupBy("workplace_id", "report_date").agg(F.max_by("payload", "file_name").alias("payload"))


def workplace_rows(pages: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """``seq, name, id`` of all pages ``(page, payload)``; ``seq`` is the place in the whole list."""
    entries = pages.select("page", F.from_json("payload", PAGE_SCHEMA)["data"].alias("data"))
    # Outer, so that no filter on the array makes Spark parse the payload twice.
    rows = entries.select("page", F.posexplode_outer("data").alias("at", "entry")).where(F.col("at").isNotNull())
    return rows.select(
        (F.col("page") * page_size + F.col("at")).alias("seq"), F.col("entry.name").alias("name"),
        F.col("entry.id").alias("id"),
    )


def page_sizes(pages: DataFrame) -> DataFrame:
    entries = F.from_json("payload", PAGE_SCHEMA)["data"]
    return pages.select("page", F.coalesce(F.size(entries), F.lit(0)).alias("entries"))


def pages_complete(pages: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """One row: how many pages and entries there are, and whether the list is whole.

    It is whole when only the last page is short and no page is missing or there twice.
    """
    return page_sizes(pages).agg(
        F.count("*").alias("pages"),
        F.sum("entries").alias("entries"),
        (
            (F.max_by("entries", "page") < page_size)
            & (F.max("page") + 1 == F.count("*"))
            & (F.count_distinct("page") == F.count("*"))
            & (F.count_if(F.col("entries") < page_size) == 1)
        ).alias("complete"),
    )


def page_gaps(pages: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """``kind, first_page, last_page``: ranges of pages that are ``missing``, pages that are there ``double`` or came ``short``.

    Gaps and islands: pages in order less their gapless number have the same
    value as long as no page is missing, so each value is an island, and what it
    grows by from one island to the next is missing between the two. Pages count
    from 0; a page is short if it is not full and not the last.
    """
    sizes = page_sizes(pages).where(F.col("page").isNotNull()).groupBy("page").agg(F.count("*").alias("times"), F.min("entries").alias("entries"))
    numbered = number_rows(sizes, [], "page")
    islands = numbered.groupBy((F.col("page") - F.col("ordinal")).alias("lost")).agg(F.min("page").alias("first"))
    placed = number_rows(islands, [], "lost", "at")
    before = placed.select((F.col("at") + 1).alias("at"), F.col("lost").alias("lost_before"))
    new = F.col("lost") - F.coalesce("lost_before", F.lit(0))
    missing = small_join(placed, before, "at").where(new > 0).select(
        F.lit("missing").alias("kind"), (F.col("first") - new).alias("first_page"), (F.col("first") - 1).alias("last_page")
    )
    last = sizes.agg(F.max("page")).first()[0]
    odd = sizes.select(
        "page", F.explode(F.array_compact(F.array(
            F.when(F.col("times") > 1, "double"), F.when((F.col("entries") < page_size) & (F.col("page") != F.lit(last)), "short"),
        ))).alias("kind"),
    )
    return missing.unionByName(odd.select("kind", F.col("page").alias("first_page"), F.col("page").alias("last_page")))
