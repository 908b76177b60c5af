"""Header row, business date and column names of a report.

A preview is ``array<struct<row_idx bigint, cells array<string>>>`` with the
first rows of one file in order. All functions here are column expressions on
it, so they run where the file is read, without a shuffle; only
``preview_by_file`` groups, and it takes the few of the first ``PREVIEW_ROWS``
rows of a file that matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillgrid.functions.naming import suffix_of
from tillgrid.functions.text import MISSING_TEXTS, strip

# Fixed values of the report layout.
PREVIEW_ROWS = 20
HEADER_CELL = "Menu Item Name"
DATE_CELL = "Business Dates"
UNNAMED = "Unnamed:"


def present(cell: Column) -> Column:
    """The cell text, null where the reader takes it as missing."""
    return F.when(~cell.isin(MISSING_TEXTS), cell)


def cell_at(cells: Column, position: Column) -> Column:
    return present(F.get(cells, position))


def _first_cell(row: Column) -> Column:
    return strip(F.get(row["cells"], F.lit(0)))


def header_entry(preview: Column, header_cell: str = HEADER_CELL) -> Column:
    """The preview row that holds the header; null if there is none."""
    return F.get(F.filter(preview, lambda row: _first_cell(row) == header_cell), F.lit(0))


def with_report_meta(files: DataFrame, preview: str = "preview", header_cell: str = HEADER_CELL) -> DataFrame:
    """Add ``header_row``, ``business_date`` and ``header_cells`` to one row per file.

    Without a header row the first row counts as the header. The date is the
    last one given above the header; a missing date gives ''.
    """
    entry = F.coalesce(F.col("_entry"), F.get(F.col(preview), F.lit(0)))
    found_at = F.col("_entry.row_idx")
    dates = F.filter(
        F.col(preview),
        lambda row: (_first_cell(row) == DATE_CELL) & (found_at.isNull() | (row["row_idx"] < found_at)),
    )
    date_cell = F.try_element_at(dates, F.lit(-1))["cells"]
    return (
        files.withColumn("_entry", header_entry(F.col(preview), header_cell))
        .withColumn("header_row", F.coalesce(found_at, F.lit(0).cast("bigint")))
        .withColumn("business_date", F.coalesce(strip(present(F.get(date_cell, F.lit(1)))), F.lit("")))
        .withColumn("header_cells", entry["cells"])
        .drop("_entry")
    )


def clean_header(header_cells: Column) -> Column:
    """Column names by position: trimmed and unique; null for blank and unnamed columns.

    A repeated name gets the first free suffix ``.1``, ``.2`` and so on.
    """
    names = F.transform(header_cells, lambda cell: F.coalesce(strip(cell), F.lit("")))
    # An array of one, so that names are made once and not where they are used.
    unique = F.get(F.transform(F.array(names), _unique_names), F.lit(0))
    return F.transform(unique, lambda name: F.when((name != "") & ~name.startswith(UNNAMED), name))


def _unique_names(names: Column) -> Column:
    def add(done: Column, name: Column) -> Column:
        candidates = F.transform(F.sequence(F.lit(1), F.size(names)), lambda k: F.concat(name, F.lit("."), k))
        free = F.filter(candidates, lambda c: ~F.array_contains(done, c) & ~F.array_contains(names, c))
        repeated = (name != "") & F.array_contains(done, name)
        return F.concat(done, F.array(F.when(repeated, F.get(free, F.lit(0))).otherwise(name)))

    given = F.filter(names, lambda name: name != "")
    return F.when(F.size(F.array_distinct(given)) == F.size(given), names).otherwise(F.aggregate(names, F.array().cast("array<string>"), add))


def with_header(files: DataFrame, ragged: Column) -> DataFrame:
    """Add what the rows need of their file: header row, date, column names and the width limit.

    ``ragged`` says whether rows longer than the header are bad (text files) or
    cannot occur (sheets, whose width is common).
    """
    meta = with_report_meta(files).withColumn("header", clean_header(F.col("header_cells")))
    return meta.withColumn("width", F.when(ragged, F.size("header"))).drop("header_cells", "preview")


def is_ragged(file_name: Column) -> Column:
    return ~F.coalesce(suffix_of(file_name), F.lit("")).isin("xlsx", "xls")


def preview_by_file(raw_rows: DataFrame, size: int = PREVIEW_ROWS) -> DataFrame:
    """``(file_id, ragged, preview)`` from grid rows, which count from 0 in each file.

    Of the first rows of a file only those are shuffled that header and date are
    taken from: row 0, rows that name themselves a header, and two cells of dates.
    """
    first, at = strip(F.get("cells", F.lit(0))), F.col("row_idx")
    dated = (first == DATE_CELL) & (at != 0)
    cells = F.when(dated, F.slice("cells", 1, 2)).otherwise(F.col("cells")).alias("cells")
    return (
        raw_rows.where((at < size) & ((at == 0) | first.isin(HEADER_CELL, DATE_CELL)))
        .groupBy("file_id")
        .agg(
            F.bool_and(is_ragged(F.col("file_name"))).alias("ragged"),
            F.sort_array(F.collect_list(F.struct("row_idx", cells))).alias("preview"),
        )
    )


def file_meta(raw_rows: DataFrame) -> DataFrame:
    """One row per file: ``file_id, header_row, business_date, header, width``."""
    return with_header(preview_by_file(raw_rows), F.col("ragged")).drop("ragged")


def header_columns(meta: DataFrame) -> DataFrame:
    """One row per kept column of each file: ``file_id, position, name``."""
    exploded = meta.select("file_id", F.posexplode("header").alias("position", "name"))
    return exploded.where(F.col("name").isNotNull()).withColumn("position", F.col("position").cast("bigint"))


def missing_key_files(meta: DataFrame, key: str) -> DataFrame:
    """Files whose header lacks the key column; they fail, the others go on."""
    return meta.where(~F.coalesce(F.array_contains(F.array_compact("header"), key), F.lit(False))).select(
        "file_id", F.concat(F.lit("missing column: "), F.lit(key)).alias("error")
    )
