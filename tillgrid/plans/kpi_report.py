"""KPI run: requests by code and day, resolved to workplaces and joined with the landed payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillgrid.operators.joins import BROADCAST_ROWS, lookup_join
from tillgrid.operators.kpi import kpi_extract, kpi_flatten, with_entry
from tillgrid.operators.locations import resolve_cascade


def resolved_codes(codes: DataFrame, workplaces: DataFrame) -> DataFrame:
    """Code mapping with the ``workplace_id`` of each code; null where the portal has none."""
    return resolve_cascade(codes, workplaces).drop("matched_by")


def reports_of_codes(reports: DataFrame, codes: DataFrame) -> DataFrame:
    """Payload rows ``(workplace_id, report_date, …)`` with the code they belong to."""
    known = codes.where(F.col("workplace_id").isNotNull()).select("workplace_id", "code", "label", "pos_name")
    return lookup_join(reports, known, "workplace_id", "inner")


def kpi_report(reports: DataFrame, codes: DataFrame, workplaces: DataFrame) -> DataFrame:
    """The wide KPI row of every code and day that has a report."""
    known = resolved_codes(codes, workplaces)
    return kpi_flatten(kpi_extract(reports_of_codes(reports, known)))


def kpi_status(requests: DataFrame, codes: DataFrame, workplaces: DataFrame, reports: DataFrame,
               max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Outcome of each requested ``(code, report_date)``: ``ok`` and the reason where it is not.

    A code outside the mapping, a name the portal does not know and an empty or
    missing report all count as failed.
    """
    last = codes.groupBy("code").agg(F.max_by(F.struct(*[c for c in codes.columns if c != "code"]), "ordinal").alias("_c")).select("code", "_c.*")
    known = resolved_codes(last, workplaces).select("code", "workplace_id").withColumn("_known", F.lit(True))
    landed = (
        with_entry(kpi_extract(reports))
        .select("workplace_id", "report_date")
        .distinct()
        .withColumn("_landed", F.lit(True))
    )
    found = lookup_join(requests, known, "code", "left", max_rows)
    # Reports are as many as requests, so no broadcast check is made for them.
    found = lookup_join(found, landed, ["workplace_id", "report_date"], "left", 0)
    reason = (
        F.when(F.col("_known").isNull(), "unknown code")
        .when(F.col("workplace_id").isNull(), "workplace not found")
        .when(F.col("_landed").isNull(), "empty report")
    )
    return found.withColumn("reason", reason).select(
        *requests.columns, "workplace_id", F.col("reason").isNull().alias("ok"),
        F.coalesce("reason", F.lit("")).alias("reason"),
    )
