"""One query per operator over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillgrid.functions.dates import before_run, reformat_date
from tillgrid.functions.naming import kpi_message, kpi_output_name, output_name, report_subject, sales_message, summary_subject
from tillgrid.functions.numbers import is_number, to_int, to_money
from tillgrid.functions.text import is_no_data, norm_a, norm_b, or_all, sanitize
from tillgrid.operators import header, kpi, locations, sets, status
from tillgrid.operators.ordinal import number_rows
from tillgrid.operators.spec import ITEM_SALES, raw_cell, target_columns
from tillgrid.plans import item_sales as sales
from tillgrid.plans import kpi_report, status_report
from tillgrid.session import listing, scratch_dir, written
from tillgrid.sinks import store
from tillgrid.sinks.tables import KPI_FOLDERS, append_audit, write_kpi, write_report
from tillgrid.sources import csv_grid, landing, mapping, payloads, xlsx_grid
from tillgrid.streaming.incremental import AUDIT, ingest
from tillgrid.testbed import tables as t
from tillgrid.testbed.workbook import workbook_bytes

Query = Callable[[SparkSession, str], DataFrame]
RUN_ID = "run-1"
KEYS = ["file_id", "row_idx"]
_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _joined(cells: str = "cells") -> Column:
    return F.array_join(cells, "|").alias("line")


# ---- sources and sinks -----------------------------------------------------------------------


@query
def src_csv_grid(spark, sf):
    path = scratch_dir(spark, "landing")
    t.land_csv(t.landed(spark, sf, t.report_grid), path)
    grid = csv_grid.read_csv_grid(spark, path, "*.txt")
    return grid.select(t.landed_id(F.col("file_id")).alias("file_id"), "row_idx",
                       F.size("cells").cast("bigint").alias("n_cells"), _joined())


@query
def src_csv_split(spark, sf):
    """The same files by the route that large ones take."""
    path = scratch_dir(spark, "landing")
    t.land_csv(t.landed(spark, sf, t.report_grid), path)
    grid = csv_grid.split_grid(spark, path, "*.txt", limit=0)
    return grid.select(t.landed_id(F.col("file_id")).alias("file_id"), "row_idx",
                       F.size("cells").cast("bigint").alias("n_cells"), _joined())


def _workbook(report: pd.DataFrame) -> pd.DataFrame:
    rows = [list(cells) for cells in report.sort_values("row_idx")["cells"]]
    return report[["file_id"]].head(1).assign(file_name="report_raw.xlsx", content=workbook_bytes(rows))


@query
def src_xlsx_grid(spark, sf):
    """Workbooks are made per report (a report is bounded), written as files, found by a scan and decoded again."""
    grid = t.landed(spark, sf, t.report_grid).select("file_id", "row_idx", "cells")
    books = grid.groupBy("file_id").applyInPandas(_workbook, "file_id string, file_name string, content binary")
    path = scratch_dir(spark, "workbooks")
    # The text sink writes the bytes as they are; a line break behind an archive does it no harm.
    books.select(F.col("content").cast("string").alias("value"), "file_id").write.partitionBy("file_id").text(path)
    rows = xlsx_grid.chunks_to_rows(xlsx_grid.decode_workbooks(xlsx_grid.workbooks(spark, path, "*.txt")))
    return rows.select(t.landed_id(F.col("file_id")).alias("file_id"), "row_idx", F.rtrim(F.array_join("cells", "|"), F.lit("|")).alias("line"))


def _as_csv(df: DataFrame) -> str:
    path = scratch_dir(df.sparkSession, "mapping")
    df.write.csv(path, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return path


@query
def dim_location(spark, sf):
    """The mapping as a CSV file, read back."""
    return mapping.read_locations(spark, _as_csv(t.location_dim(spark, sf)))


@query
def dim_code(spark, sf):
    return mapping.read_codes(spark, _as_csv(t.code_dim(spark, sf)))


@query
def kpi_extract(spark, sf):
    entries = kpi.kpi_extract(t.landed(spark, sf, t.kpi_reports))
    return entries.select("workplace_id", F.col("report_date").cast("string").alias("report_date"),
                          F.col("entry_json").isNotNull().alias("has_entry"), F.col("entry.total.turnover").alias("turnover"))


def _workplaces(spark, sf) -> DataFrame:
    return locations.workplace_dedup(payloads.workplace_rows(t.landed(spark, sf, t.workplace_pages)))


@query
def workplace_pages(spark, sf):
    """All entries of all landed pages, a file for each, with the size of its page."""
    path = scratch_dir(spark, "pages")
    t.landed(spark, sf, t.workplace_pages).select(F.col("payload").alias("value"), "page").repartition("page").write.partitionBy("page").text(path)
    pages = payloads.read_pages(spark, path, r"page=(\d+)/", "*.txt")
    rows = payloads.workplace_rows(pages).withColumn("page", t.whole_div(F.col("seq"), payloads.PAGE_SIZE))
    return rows.join(payloads.page_sizes(pages), "page").select("seq", "name", "id", "entries")


@query
def pages_complete(spark, sf):
    return payloads.pages_complete(t.landed(spark, sf, t.workplace_pages))


@query
def page_gaps(spark, sf):
    """Small pages, numbered with holes; some are there twice."""
    return payloads.page_gaps(t.landed(spark, sf, t.pages_with_holes), 10)


@query
def kpi_rejects(spark, sf):
    """Reports without figures; of some the text breaks off."""
    rejects = kpi.kpi_rejects(t.cut_payloads(t.landed(spark, sf, t.kpi_reports)))
    return rejects.withColumn("report_date", F.col("report_date").cast("string"))


@query
def latest_file(spark, sf):
    named = landing.with_provenance(t.landed(spark, sf, t.landed_names)).where(F.col("location_tag").isNotNull())
    return landing.latest_files(named, ["location_tag", "suffix"]).select("location_tag", "suffix", "file_id")


@query
def empty_files(spark, sf):
    files = t.landed(spark, sf, t.landed_names)
    return landing.missing_or_empty(files.select("file_name"), files)


@query
def file_provenance(spark, sf):
    return landing.with_provenance(t.landed(spark, sf, t.landed_names)).select(
        "file_id", "file_name", "run_id", "location_tag", "suffix"
    )


def _report_table(spark, sf) -> str:
    grid = t.landed(spark, sf, t.report_grid)
    keep = ("file_id", "file_name", "row_idx", "business_date")
    items = sales.item_sales(sales.rows_of_grid(grid, only=MAPPED, keyed=is_number), keep=keep)
    located = sales.with_location(items, locations.active_locations(t.location_dim(spark, sf)))
    path = scratch_dir(spark, "report")
    write_report(sales.for_sink(located.where(F.col("label").isNotNull())), path)
    return path


def _sink_columns() -> list[Column]:
    columns = [F.col(f"`{c}`") for c in ("file_id", "row_idx", *ITEM_SALES.order)]
    return [*columns, F.col("business_day").cast("string"), F.col("location_key").cast("string")]


@query
def sink_report(spark, sf):
    with listing(spark):
        return spark.read.parquet(_report_table(spark, sf)).select(*_sink_columns())


@query
def report_slice(spark, sf):
    """Some locations and days of the written table; folders without any of them are not read."""
    dim = locations.active_locations(t.location_dim(spark, sf)).where(F.col("ordinal") % 3 == 0)
    table = spark.read.schema(f"{_SLICE}, business_day string, location_key string").parquet(_report_table(spark, sf))
    days = [F.lit(d).cast("date") for d in ("1998-08-01", "1998-12-01")]
    return sales.reports_of(table, dim, *days).select("file_id", "row_idx", "business_day", "location_key")


_SLICE = "file_id string, row_idx bigint"


def _kpi_rows(spark, sf) -> DataFrame:
    return kpi_report.kpi_report(t.landed(spark, sf, t.kpi_reports), t.code_dim(spark, sf), _workplaces(spark, sf))


@query
def sink_kpi(spark, sf):
    path = scratch_dir(spark, "kpi")
    write_kpi(_kpi_rows(spark, sf), path)
    with listing(spark):
        return spark.read.parquet(path).drop(*KPI_FOLDERS)


@query
def audit_rows(spark, sf):
    """Rows and outcome of each report, appended to the audit log and read back."""
    grid = t.landed(spark, sf, t.report_grid)
    meta = written(header.file_meta(grid), "meta")
    counts = sales.item_rows(sales.rows_of_grid(grid, meta=meta, only=[ITEM_SALES.key], keyed=is_number)).groupBy("file_id").agg(F.count("*").alias("rows"))
    failed = header.missing_key_files(meta, ITEM_SALES.key)
    facts = meta.select("file_id").join(counts, "file_id", "left").join(failed, "file_id", "left").select(
        F.col("file_id").alias("file"), F.coalesce("rows", F.lit(0)).alias("rows"),
        or_all(F.lit(None).cast("string")).alias("location"), "error",
    )
    records = status.audit_records(
        facts, RUN_ID, "transform", "export", F.lit("2026-04-16 10:23:00").cast("timestamp"),
        F.when(F.col("error").isNull(), "ok").otherwise("error"), ["file", "rows", "location"],
    )
    path = scratch_dir(spark, "audit")
    append_audit(records, path)
    return spark.read.schema(records.schema).json(path)


_STORES: dict[tuple[str, str], str] = {}


def _filled_store(spark, sf) -> str:
    """A store that took up all reports as landed files."""
    landed, path = scratch_dir(spark, "landing"), scratch_dir(spark, "store")
    t.land_csv(t.landed(spark, sf, t.report_grid), landed)
    of_report = t.landed_id(F.col("file_id"))
    name = F.concat(F.lit(f"{t.RUN_STAMP}_a1b2c3d4_"), sanitize(t.report_place(of_report)), F.lit("_raw.csv"))
    dim = locations.active_locations(t.report_dim(spark, sf))
    ingest(spark, landed, dim, path, scratch_dir(spark, "ingest"), glob="*.txt", file_name=name).awaitTermination()
    _STORES[spark.sparkContext.applicationId, sf] = path
    return path


def _store(spark, sf) -> str:
    """The store filled last in this application."""
    return _STORES.get((spark.sparkContext.applicationId, sf)) or _filled_store(spark, sf)


@query
def ingest_incremental(spark, sf):
    """Take up all reports as landed files, then read the table."""
    columns = [f"`{c}`" for c in ITEM_SALES.order]
    return store.read_report(spark, _filled_store(spark, sf)).select(
        t.landed_id(F.col("file_id")).alias("file_id"), "row_idx", *columns, "business_day", "location_key"
    )


@query
def ingest_outcomes(spark, sf):
    """What became of each landed file."""
    return store.read_decisions(spark, _store(spark, sf)).select(
        t.landed_id(F.col("file_id")).alias("file_id"), "business_date", "outcome", F.coalesce("error", F.lit("")).alias("error")
    )


@query
def sales_status(spark, sf):
    """Outcome of every location in use, from the store, written as the status of a run and read back."""
    dim = locations.active_locations(t.report_dim(spark, sf))
    results = status_report.write_outcome(spark, _store(spark, sf), dim, RUN_ID, scratch_dir(spark, "outcome"))
    return results.select("pos_name", "label", "ok", "no_data", "stage", "error", "row_count", "business_date")


@query
def sales_digest(spark, sf):
    """The digest of the same run as it was written."""
    dim, path = locations.active_locations(t.report_dim(spark, sf)), scratch_dir(spark, "outcome")
    status_report.write_outcome(spark, _store(spark, sf), dim, RUN_ID, path)
    return spark.read.text(f"{path}/digest/{RUN_ID}").select(F.col("value").alias("line"))


@query
def sales_audit(spark, sf):
    """Counts of the audit log, observed while the reports were taken up; all batches together."""
    log = store.read_audit(spark, _store(spark, sf), AUDIT)
    return log.groupBy("stage", "step").agg(*[F.sum(c).alias(c) for c in ("files", "rows", "rejects", "failed")])


# ---- projections and filters -----------------------------------------------------------------


MAPPED = [c.raw for c in ITEM_SALES.mapped]


def _report_rows(spark, sf, only: list[str], keyed: Callable[[Column], Column] = is_number) -> DataFrame:
    return sales.rows_of_grid(t.landed(spark, sf, t.report_grid), only=only, keyed=keyed)


@query
def header_clean(spark, sf):
    return header.header_columns(header.file_meta(t.landed(spark, sf, t.report_grid)))


@query
def strip_totals(spark, sf):
    return sales.strip_totals(_report_rows(spark, sf, [ITEM_SALES.key], sales.has_key)).select(*KEYS, raw_cell(ITEM_SALES, ITEM_SALES.key).alias("item"))


@query
def strip_subheaders(spark, sf):
    return sales.strip_subheaders(_report_rows(spark, sf, [ITEM_SALES.key])).select(
        *KEYS, raw_cell(ITEM_SALES, ITEM_SALES.key).alias("item")
    )


@query
def row_ordinal(spark, sf):
    rows = sales.item_rows(_report_rows(spark, sf, [ITEM_SALES.key])).select(*KEYS)
    return number_rows(rows, ["file_id"], "row_idx")


def _targets(names: list[str]) -> Query:
    raw = [c.raw for c in ITEM_SALES.mapped if c.target in names or c.raw == ITEM_SALES.key]

    def run(spark, sf):
        return sales.item_rows(_report_rows(spark, sf, raw)).select(*KEYS, *target_columns(ITEM_SALES, names))

    return run


_QUERIES["project_spec"] = _targets([c.target for c in ITEM_SALES.mapped])
_QUERIES["inject_date"] = _targets(["Sales Date *"])
_QUERIES["inject_empty"] = _targets(["Order ID", "Sales Type Code"])


@query
def reorder_extras(spark, sf):
    return sales.item_sales_with_extras(t.landed(spark, sf, t.report_grid))


@query
def missing_key_files(spark, sf):
    return header.missing_key_files(header.file_meta(t.landed(spark, sf, t.report_grid)), ITEM_SALES.key)


def _lines(spark, sf) -> DataFrame:
    return t.table(spark, sf, "lineitem")


@query
def cast_int(spark, sf):
    n, q = F.col("l_linenumber"), F.col("l_quantity").cast("bigint")
    text = (
        F.when(n == 1, t.text(q)).when(n == 2, t.join_text("-", q, ".75")).when(n == 3, t.join_text(" ", q, " "))
        .when(n == 4, t.join_text("1,", q)).when(n == 5, t.join_text(q, "d")).when(n == 6, t.join_text(q, "e2"))
    )
    return _lines(spark, sf).select("l_orderkey", "l_linenumber", text.alias("txt")).withColumn("amount", to_int(F.col("txt")))


@query
def cast_money(spark, sf):
    n, m = F.col("l_linenumber"), t.money_text(F.round(F.col("l_extendedprice") * 100).cast("bigint"))
    text = (
        F.when(n == 1, m).when(n == 2, t.join_text("AED ", m)).when(n == 3, t.join_text("(", m, ")"))
        .when(n == 4, t.join_text("-", m, " %")).when(n == 5, t.join_text("--", m)).when(n == 6, t.join_text("AED. ", m))
        .when(n == 7, "")
    )
    return _lines(spark, sf).select("l_orderkey", "l_linenumber", text.alias("txt")).withColumn("amount", to_money(F.col("txt")))


@query
def date_reformat(spark, sf):
    n, day = F.col("l_linenumber"), F.col("l_shipdate")
    text = (
        F.when(n == 2, F.date_format(day, "d/M/yyyy")).when(n == 3, F.date_format(day, "yyyy-MM-dd"))
        .when(n == 4, F.concat(F.lit("31/02/"), F.date_format(day, "yyyy"))).when(n == 5, "").when(n == 6, "nan")
        .otherwise(F.date_format(day, "dd/MM/yyyy"))
    )
    return _lines(spark, sf).select("l_orderkey", "l_linenumber", text.alias("txt")).withColumn(
        "shown", reformat_date(F.col("txt"))
    )


@query
def date_range(spark, sf):
    """Orders of a range that ends on the day before the run date."""
    start, run_date = F.lit("1998-03-01").cast("date"), F.lit("1998-04-01").cast("date")
    in_range = before_run(F.col("o_orderdate"), start, run_date)
    return t.table(spark, sf, "orders").where(in_range).select(
        "o_orderkey", F.to_date("o_orderdate").cast("string").alias("day")
    )


@query
def active_locations(spark, sf):
    return locations.active_locations(t.location_dim(spark, sf))


@query
def list_locations(spark, sf):
    return locations.list_locations(t.location_dim(spark, sf))


@query
def limit_locations(spark, sf):
    return locations.limit_locations(locations.active_locations(t.location_dim(spark, sf)), 25)


@query
def pick_location(spark, sf):
    return locations.pick_location(t.location_dim(spark, sf), "PARADE'S STORE 5")


@query
def pick_codes(spark, sf):
    return locations.pick_codes(t.code_requests(spark, sf), t.code_dim(spark, sf))


@query
def kpi_empty(spark, sf):
    empty = kpi.kpi_empty(kpi.kpi_extract(t.landed(spark, sf, t.kpi_reports)))
    return empty.withColumn("report_date", F.col("report_date").cast("string"))


@query
def kpi_flatten(spark, sf):
    return _kpi_rows(spark, sf)


KPI_KEYS = ["Date", "Code", "Location", "`POS Name`"]


@query
def kpi_categories(spark, sf):
    names = [f"`{key.replace('_', ' ').title()} {f}`" for key in kpi.CATEGORIES for f in kpi.CATEGORY_FIELDS]
    return _kpi_rows(spark, sf).select(*KPI_KEYS, *names)


@query
def kpi_discounts(spark, sf):
    names = [f"`{label} {f}`" for label in kpi.DISCOUNTS.values() for f in kpi.SHARE_FIELDS]
    return _kpi_rows(spark, sf).select(*KPI_KEYS, *names)


@query
def no_data_flag(spark, sf):
    body = F.col("text")
    return t.landed_texts(spark, sf).select(
        "kind", "id", is_no_data(body).alias("no_data"), is_no_data(body, loose=True).alias("no_data_loose")
    )


@query
def run_status(spark, sf):
    return status.run_status(t.run_results(spark, sf)).select(
        "ordinal", "pos_name", "stage", "row_count", "business_date", "status"
    )


def _kpi_status(spark, sf) -> DataFrame:
    return kpi_report.kpi_status(
        t.code_requests(spark, sf), t.code_dim(spark, sf), _workplaces(spark, sf), t.landed(spark, sf, t.kpi_reports)
    )


@query
def kpi_status(spark, sf):
    return _kpi_status(spark, sf).withColumn("report_date", F.col("report_date").cast("string"))


# ---- joins -----------------------------------------------------------------------------------


@query
def attach_label(spark, sf):
    reports = _lines(spark, sf).select("l_orderkey", "l_linenumber", t.store_name(F.col("l_suppkey")).alias("pos_name"))
    return locations.attach_label(reports, t.location_dim(spark, sf)).select(
        "l_orderkey", "l_linenumber", "pos_name", "label"
    )


@query
def resolve_exact(spark, sf):
    return locations.resolve_exact(t.name_requests(spark, sf), _workplaces(spark, sf))


@query
def resolve_cascade(spark, sf):
    return locations.resolve_cascade(t.name_requests(spark, sf), _workplaces(spark, sf))


@query
def resolve_unmatched(spark, sf):
    return locations.resolve_unmatched(t.name_requests(spark, sf), _workplaces(spark, sf))


@query
def option_cascade(spark, sf):
    return locations.option_cascade(t.name_requests(spark, sf), t.portal_options(spark, sf))


@query
def option_unmatched(spark, sf):
    return locations.option_unmatched(t.name_requests(spark, sf), t.portal_options(spark, sf))


@query
def unknown_codes(spark, sf):
    unknown = locations.unknown_codes(t.code_requests(spark, sf), t.code_dim(spark, sf))
    return unknown.withColumn("report_date", F.col("report_date").cast("string"))


@query
def result_labels(spark, sf):
    requests = t.code_requests(spark, sf).select("o_orderkey", "code")
    return locations.result_labels(requests, t.code_dim(spark, sf))


# ---- aggregations ----------------------------------------------------------------------------


@query
def detect_header(spark, sf):
    return header.file_meta(t.landed(spark, sf, t.report_grid)).select("file_id", "header_row")


@query
def detect_business_date(spark, sf):
    return header.file_meta(t.landed(spark, sf, t.report_grid)).select("file_id", "business_date")


@query
def status_counts(spark, sf):
    return status.status_counts(t.run_results(spark, sf))


@query
def kpi_counts(spark, sf):
    return status.ok_counts(_kpi_status(spark, sf).withColumn("report_date", F.col("report_date").cast("string")), ["report_date"])


@query
def report_date(spark, sf):
    return status.report_date(t.run_results(spark, sf))


@query
def workplace_dedup(spark, sf):
    return _workplaces(spark, sf)


@query
def dim_counts(spark, sf):
    dim = t.location_dim(spark, sf)
    counted = {
        "locations": dim, "active locations": locations.active_locations(dim), "codes": t.code_dim(spark, sf),
        "workplaces": _workplaces(spark, sf),
    }
    counts = [df.agg(F.lit(what).alias("what"), F.count("*").alias("n")) for what, df in counted.items()]
    out = counts[0]
    for more in counts[1:]:
        out = out.unionByName(more)
    return out


@query
def failed_list(spark, sf):
    return status.failed_list(t.run_results(spark, sf))


# ---- set operations --------------------------------------------------------------------------


def _spec_names(meta: DataFrame, names: list[str]) -> DataFrame:
    """The wanted names of every report."""
    return meta.select("file_id", F.explode(F.array(*[F.lit(n) for n in names])).alias("name"))


@query
def spec_diff(spark, sf):
    # Dealt by file before the names are listed: a row per file is shuffled instead of one per name.
    meta = written(header.file_meta(t.landed(spark, sf, t.report_grid)), "meta").repartition("file_id")
    found = header.header_columns(meta).select("file_id", "name")
    return sets.both_differences(_spec_names(meta, ITEM_SALES.known), found, "spec", "report")


@query
def spec_required(spark, sf):
    meta = written(header.file_meta(t.landed(spark, sf, t.report_grid)), "meta")
    found = header.header_columns(meta).select("file_id", "name")
    return sets.missing_required(_spec_names(meta, ["Menu Item #", "Menu Item Name", "Gross after Disc."]), found)


# ---- scalar functions ------------------------------------------------------------------------


@query
def _sanitize(spark, sf):
    c, name = F.col("c_custkey"), F.col("c_name")
    kind = c % 6
    text = (
        F.when(kind == 0, t.join_text(name, ": a/b\\c")).when(kind == 1, t.join_text("  _", name, "??"))
        .when(kind == 2, "<*> ").when(kind == 3, t.join_text(name, '  –  "x" | y')).otherwise(t.hub_name(c))
    )
    return t.table(spark, sf, "customer").select("c_custkey", text.alias("name")).withColumn("safe", sanitize(F.col("name")))


@query
def _norm_a(spark, sf):
    return t.table(spark, sf, "customer").select("c_custkey", norm_a(t.hub_name(F.col("c_custkey"))).alias("norm"))


@query
def _norm_b(spark, sf):
    return t.table(spark, sf, "customer").select("c_custkey", norm_b(t.hub_name(F.col("c_custkey"))).alias("norm"))


for _name in ("sanitize", "norm_a", "norm_b"):
    _QUERIES[_name] = _QUERIES.pop(f"_{_name}")


@query
def kpi_long_labels(spark, sf):
    long = kpi.kpi_long(kpi.kpi_extract(t.landed(spark, sf, t.kpi_reports)), ["workplace_id", "report_date"])
    return long.withColumn("report_date", F.col("report_date").cast("string"))


@query
def _kpi_message(spark, sf):
    rows = _kpi_rows(spark, sf)
    message = kpi_message(F.col("Location"), F.col("`POS Name`"), F.col("Date"), F.col("Turnover"), F.col("Products"))
    return rows.select(F.col("Code").alias("code"), F.col("Date").alias("report_date"), message.alias("message"))


_QUERIES["kpi_message"] = _QUERIES.pop("_kpi_message")


@query
def _sales_message(spark, sf):
    results = t.run_results(spark, sf).where("ok")
    name = F.concat(sanitize(F.col("label")), F.lit(".csv"))
    known = F.when(F.col("ordinal") % 5 != 0, F.col("label"))
    return results.select("ordinal", sales_message(known, F.col("business_date"), F.col("row_count"), name, F.lit(RUN_ID)).alias("message"))


_QUERIES["sales_message"] = _QUERIES.pop("_sales_message")


@query
def kpi_digest_head(spark, sf):
    return status.kpi_digest_head(_kpi_status(spark, sf), "2024-01-31")


@query
def digest_lines(spark, sf):
    return status.digest_lines(t.run_results(spark, sf))


@query
def digest_head(spark, sf):
    return status.digest_head(t.run_results(spark, sf), RUN_ID)


@query
def digest_subject(spark, sf):
    results = t.run_results(spark, sf)
    reports = status.run_status(results).where("status = 'ok'").select(
        "ordinal", report_subject(F.col("label"), F.col("business_date")).alias("subject")
    )
    summary = status.run_summary(results).select(
        F.lit(-1).cast("bigint").alias("ordinal"),
        summary_subject(F.col("report_date"), F.col("succeeded"), F.col("total")).alias("subject"),
    )
    return reports.unionByName(summary)


@query
def kpi_digest(spark, sf):
    labelled = locations.result_labels(_kpi_status(spark, sf), t.code_dim(spark, sf))
    return status.kpi_digest_lines(labelled.withColumnRenamed("o_orderkey", "ordinal"))


@query
def _output_name(spark, sf):
    o, c = F.col("o_orderkey"), F.col("o_custkey")
    label = F.when(o % 9 == 0, "").otherwise(t.store_name(c))
    return t.table(spark, sf, "orders").select(
        "o_orderkey", output_name(label, F.col("o_orderdate"), F.lit(RUN_ID)).alias("name"),
        kpi_output_name(t.join_text("C", c), F.col("o_orderdate")).alias("kpi_name"),
    )


_QUERIES["output_name"] = _QUERIES.pop("_output_name")


# ---- the whole item-sales job ----------------------------------------------------------------


def item_sales(spark: SparkSession, sf: str) -> DataFrame:
    """From grid rows: the scalars of each report are joined to its rows."""
    return sales.item_sales(_report_rows(spark, sf, MAPPED))


def item_sales_text(spark: SparkSession, sf: str) -> DataFrame:
    """From whole texts, as landed files are read: header and rows in one pass."""
    line = F.struct("row_idx", t.csv_line(F.col("cells")).alias("line"))
    # A report is bounded, so its text is too.
    texts = t.landed(spark, sf, t.report_grid).groupBy("file_id", "file_name").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(line)), lambda x: x["line"]), "\n").alias("text")
    )
    files = texts.withColumn("modified_at", F.lit(None).cast("timestamp"))
    return sales.item_sales(sales.rows_of_files(files))


_QUERIES["item_sales"] = item_sales
_QUERIES["item_sales_text"] = item_sales_text
