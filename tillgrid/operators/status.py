"""Run status, counts, digest and audit records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillgrid.functions.numbers import thousands
from tillgrid.functions.text import clip, pad

# Marks and texts of a digest.
OK_MARK, NO_DATA_MARK, FAILED_MARK = "✅", "–", "❌"
ERROR_CHARS = 40
LABEL_CHARS = 45

def status_of(ok: Column, no_data: Column) -> Column:
    return F.when(ok, "ok").when(no_data, "no_data").otherwise("failed")


def run_status(results: DataFrame) -> DataFrame:
    return results.withColumn("status", status_of(F.col("ok"), F.col("no_data")))


def _count_columns() -> list[Column]:
    status = F.col("status")
    return [
        F.count_if(status == "ok").alias("succeeded"),
        F.count_if(status == "no_data").alias("no_data"),
        F.count_if(status == "failed").alias("failed"),
        F.count("*").alias("total"),
        F.coalesce(F.bool_or("ok"), F.lit(False)).alias("success"),
    ]


def status_counts(results: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Counts by outcome and the verdict; over everything or for each key."""
    return run_status(results).groupBy(*(keys or [])).agg(*_count_columns())


def ok_counts(results: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Two-way counts of the KPI run."""
    return results.groupBy(*(keys or [])).agg(
        F.count_if("ok").alias("ok"), F.count_if(~F.col("ok")).alias("fail"), F.count("*").alias("total")
    )


def failed_list(results: DataFrame) -> DataFrame:
    return run_status(results).where("status = 'failed'").select("stage", "pos_name", "error")


def _first_date() -> Column:
    given = F.col("business_date") != ""
    first = F.min_by(F.when(given, F.col("business_date")), F.when(given, F.col("ordinal")))
    return F.coalesce(first, F.lit("")).alias("report_date")


def report_date(results: DataFrame) -> DataFrame:
    """Date of a run: the first one given in location order, '' if none."""
    return results.agg(_first_date())


def status_text(error: Column | None = None) -> Column:
    error = F.coalesce(F.col("error") if error is None else error, F.lit(""))
    return (
        F.when(F.col("ok"), F.concat(F.lit(f"{OK_MARK}  "), thousands(F.col("row_count")), F.lit(" rows")))
        .when(F.col("no_data"), F.lit(f"{NO_DATA_MARK}  no data"))
        .otherwise(F.concat(F.lit(f"{FAILED_MARK}  "), clip(error, ERROR_CHARS)))
    )


def digest_lines(results: DataFrame) -> DataFrame:
    """One digest line per location, in label order."""
    name = pad(clip(F.col("label"), LABEL_CHARS), LABEL_CHARS)
    lines = results.select("label", "ordinal", F.concat(name, F.lit("  "), status_text()).alias("line"))
    return lines.orderBy("label", "ordinal")


def run_summary(results: DataFrame) -> DataFrame:
    """One row: the counts, the verdict and the date of a run."""
    return run_status(results).agg(*_count_columns(), _first_date())


def digest_head(results: DataFrame, run_id: str, title: str = "Daily Run Summary") -> DataFrame:
    """The lines above the location lines, in order: ``position, line``."""
    facts = run_summary(results)
    rule = F.lit("─" * 60)
    lines = F.array(
        F.concat(F.lit(f"{title} — "), "report_date"),
        F.lit(f"Run ID: {run_id}"),
        F.lit(""),
        F.concat(F.lit(f"  {OK_MARK}  Succeeded : "), "succeeded"),
        F.concat(F.lit(f"  {NO_DATA_MARK}   No data   : "), "no_data"),
        F.concat(F.lit(f"  {FAILED_MARK}  Failed    : "), "failed"),
        F.concat(F.lit("  Total         : "), "total"),
        F.lit(""),
        rule,
        F.lit(f"{'Location':<45} {'Rows':>6}  Status"),
        rule,
    )
    return facts.select(F.posexplode(lines).alias("position", "line"))


def kpi_digest_lines(results: DataFrame) -> DataFrame:
    """KPI digest: mark, code and label, in run order. Wants ``ordinal, code, label, ok``."""
    mark = F.when(F.col("ok"), OK_MARK).otherwise(FAILED_MARK)
    line = F.concat(mark, F.lit("  "), pad(F.col("code"), 8), F.lit("  "), F.col("label"))
    return results.select("ordinal", line.alias("line")).orderBy("ordinal")


def kpi_digest_head(results: DataFrame, report_date: str, title: str = "Daily Run Summary") -> DataFrame:
    """The lines above the KPI digest, in order: ``position, line``, with two-way counts."""
    lines = F.array(
        F.lit(f"{title} — {report_date}"), F.concat(F.lit(f"  {OK_MARK} Succeeded : "), "ok"), F.concat(F.lit(f"  {FAILED_MARK} Failed    : "), "fail"),
        F.concat(F.lit("  Total       : "), "total"), F.lit(""), F.lit("─" * 50),
    )
    return ok_counts(results).select(F.posexplode(lines).alias("position", "line"))


def audit_records(facts: DataFrame, run_id: str, stage: str, step: str, ts: Column,
                  outcome: Column, extras: list[str]) -> DataFrame:
    """Audit records with the extra fields next to the fixed ones, ready for JSON lines."""
    duration = F.col("duration_ms") if "duration_ms" in facts.columns else F.lit(0).cast("bigint")
    return facts.select(
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ts"),
        F.lit(run_id).alias("run_id"),
        F.lit(stage).alias("stage"),
        F.lit(step).alias("step"),
        outcome.alias("outcome"),
        duration.alias("duration_ms"),
        *extras,
    )


def audit_json(records: DataFrame) -> DataFrame:
    return records.select(F.to_json(F.struct(*records.columns)).alias("value"))
