"""Item sales: landed reports of all locations and days to one upload-ready table.

``report rows`` are grid rows with what is known of their file: ``header``,
``width``, ``header_row``, ``business_date``, the column positions ``pos`` and
the ``injected`` columns.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillgrid.functions.dates import UNDATED, before_run, business_day_key, parse_date
from tillgrid.functions.naming import location_tag_of
from tillgrid.functions.numbers import is_number
from tillgrid.functions.text import sanitize
from tillgrid.operators.header import file_meta, present
from tillgrid.operators.joins import BROADCAST_ROWS, fits_broadcast, lookup_join
from tillgrid.operators.spec import (
    ITEM_SALES,
    ReportSpec,
    extra_columns,
    extra_map,
    extra_names,
    raw_cell,
    target_columns,
    with_positions,
)
from tillgrid.session import settle, written
from tillgrid.sinks.tables import REPORT_FOLDERS, REPORT_PARTITIONS, key_part
from tillgrid.sources import csv_grid, xlsx_grid
from tillgrid.sources.landing import landed_files, latest_files, with_provenance

FILE_COLUMNS = ["file_id", "file_name", "modified_at"]
MOST_PLACES = 100  # narrow rows have no more cells than this
META_COLUMNS = ["header", "width", "header_row", "business_date", "pos", "injected"]


def _below_header(marks: bool) -> Column:
    """Rows below the header; with ``marks`` the header row too, or a row without a number, as the mark of each file."""
    below = F.col("row_idx") > F.col("header_row")
    return below | (F.col("row_idx") == F.col("header_row")) | F.col("row_idx").isNull() if marks else below


def rows_of_files(files: DataFrame, spec: ReportSpec = ITEM_SALES, extras: list[str] | None = None, marks: bool = False) -> DataFrame:
    """Report rows of whole text files; header and rows are taken in one pass without a shuffle.

    The outer explode and the one-element explodes keep the optimizer from
    repeating their input in filters pushed below them: each text and each line
    is split once, each header looked up once.
    """
    meta = with_positions(csv_grid.files_with_meta(files), spec, extras)
    once = meta.select(*FILE_COLUMNS, "records", F.explode(F.array(F.struct(*META_COLUMNS))).alias("_file"))
    lines = once.select(
        *FILE_COLUMNS, "_file.*", F.posexplode_outer("records").alias("row_idx", "line")
    ).where(_below_header(marks))
    return lines.select(
        *FILE_COLUMNS, *META_COLUMNS, F.col("row_idx").cast("bigint").alias("row_idx"),
        F.explode(F.array(csv_grid.cells(F.col("line")))).alias("cells"),
    )


def rows_of_workbooks(books: DataFrame, spec: ReportSpec = ITEM_SALES, extras: list[str] | None = None, marks: bool = False) -> DataFrame:
    chunks = xlsx_grid.chunks_with_meta(xlsx_grid.decode_workbooks(books))
    rows = xlsx_grid.chunks_to_rows(with_positions(chunks, spec, extras), marks)
    return rows.where(_below_header(marks))


def rows_of_grid(grid: DataFrame, spec: ReportSpec = ITEM_SALES, extras: list[str] | None = None,
                 meta: DataFrame | None = None, max_rows: int = BROADCAST_ROWS, marks: bool = False, only: list[str] | None = None,
                 keyed: Callable[[Column], Column] | None = None) -> DataFrame:
    """Report rows of a grid: the scalars of each file are joined to its rows.

    The scalars are written down, so that counting them (to see whether they
    may be broadcast) does not read the grid again. Whoever looks at no cells
    but those of some mapped raw names (and the extras) says so by ``only``:
    where the rows must be shuffled, they then take just the cells along in
    which any file has these. Whoever drops all rows whose key cell fails a test
    names it by ``keyed``: rows that fail it wherever a file may have its key
    are then left behind, and so are those above the first header of all.
    """
    if meta is None:
        meta = written(file_meta(grid), "meta")
    scalars = with_positions(meta, spec, extras)
    wanted = [f"p{i}" for i, c in enumerate(spec.mapped) if c.raw in (only or [])]
    if wanted and not fits_broadcast(scalars, max_rows):
        wanted += [f"e{i}" for i in range(len(extras or []))]
        if not marks:
            least = scalars.agg(F.min("header_row")).first()[0]  # of all files
            grid = grid.where(F.col("row_idx") > F.lit(least))
        grid, scalars, max_rows = *_narrow(grid, scalars, wanted, keyed and (spec, keyed)), 0
    rows = lookup_join(grid, scalars, "file_id", "inner", max_rows)
    return rows.where(_below_header(marks))


def _places(scalars: DataFrame, names: list[str]) -> list[int]:
    """Where any file has its columns of these names, no more than one place above ``MOST_PLACES`` of them."""
    listed = F.array_distinct(F.array(*[F.col(f"pos.{n}") for n in names]))
    found = scalars.select(F.explode(listed).alias("place")).where("place is not null").distinct().limit(MOST_PLACES + 1).collect()
    return sorted(r.place for r in found)


def _narrow(grid: DataFrame, scalars: DataFrame, wanted: list[str], keyed: tuple[ReportSpec, Callable[[Column], Column]] | None) -> tuple[DataFrame, DataFrame]:
    """Rows with the cells at the wanted columns' places in any file, and the places among those; unchanged if they are very many."""
    if keyed is not None:
        spec, test = keyed
        of_key = _places(scalars, [f"p{[c.raw for c in spec.mapped].index(spec.key)}"])
        if len(of_key) <= MOST_PLACES:
            grid = grid.where(reduce(lambda a, b: a | b, [test(F.get("cells", F.lit(k))) for k in of_key], F.lit(False)))
    kept = _places(scalars, wanted)
    if not kept or len(kept) > MOST_PLACES:
        return grid, scalars
    among = F.array(*map(F.lit, kept))
    moved = [
        ((F.nullif(F.array_position(among, F.col(f"pos.{n}")), F.lit(0)) - 1) if n in wanted else F.lit(None)).cast("int").alias(n)
        for n in scalars.schema["pos"].dataType.names
    ]
    cells = F.array(*[F.get("cells", F.lit(k)) for k in kept])
    return grid.withColumn("n_cells", F.size("cells")).withColumn("cells", cells), scalars.withColumn("pos", F.struct(*moved))


def _cell_count(rows: DataFrame) -> Column:
    """How many cells a row has in its file; narrow rows carry the number."""
    return F.col("n_cells") if "n_cells" in rows.columns else F.size("cells")


def _is_book(path: str) -> bool:
    return re.search(csv_grid.WORKBOOK, path.lower()) is not None


def _by_kind(spark: SparkSession, path: str | list[tuple[str, int]]) -> tuple[str | list[str], str | list[str], bool]:
    """Where text files are, where workbooks are, and whether a text file must be read in splits."""
    if isinstance(path, str):
        large = landed_files(spark, path, None).where(
            ~F.lower("file_name").rlike(csv_grid.WORKBOOK) & (F.col("length") > csv_grid.WHOLE_FILE_BYTES)
        )
        return path, path, not large.isEmpty()
    texts = [(p, size) for p, size in path if not _is_book(p)]
    return [p for p, _ in texts], [p for p, _ in path if _is_book(p)], any(size > csv_grid.WHOLE_FILE_BYTES for _, size in texts)


def read_report_rows(spark: SparkSession, path: str | list[tuple[str, int]], spec: ReportSpec = ITEM_SALES,
                     extras: list[str] | None = None, marks: bool = False) -> DataFrame:
    """Report rows of everything that landed below a folder, or of given files ``(path, bytes)``.

    Small and large text files and workbooks; a file that is no workbook by its
    suffix is read as text. ``failed_files`` lists what cannot be used; with
    ``marks`` each file has a row of its own too (see ``tagged_rows``).
    """
    texts, books, large = _by_kind(spark, path)
    parts = []
    if texts:
        parts.append(rows_of_files(csv_grid.whole_files(spark, texts), spec, extras, marks))
    if books:
        parts.append(rows_of_workbooks(xlsx_grid.workbooks(spark, books), spec, extras, marks))
    if large:
        grid, heads = csv_grid.split_grid_and_heads(spark, texts)
        parts.append(rows_of_grid(grid, spec, extras, settle(file_meta(heads)), marks=marks))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _file_error(spec: ReportSpec) -> Column:
    """Why a file gives no rows; null if it does."""
    lacks = ~F.coalesce(F.array_contains(F.array_compact("header"), spec.key), F.lit(False))
    return F.coalesce("error", F.when(lacks, F.lit(f"missing column: {spec.key}")))


def tagged_rows(rows: DataFrame, spec: ReportSpec = ITEM_SALES, extras: str = "map") -> DataFrame:
    """All that one pass over report rows with marks tells, by ``kind``.

    ``item`` rows have the target columns, ``reject`` rows (longer than their
    header) their cells, and ``file`` rows, at least one per file that has
    content, the reason why a file cannot be used.
    """
    mark = F.coalesce(F.col("row_idx") == F.col("header_row"), F.lit(True))
    long = F.coalesce(F.size("cells") > F.col("width"), F.lit(False))
    error = F.col("error") if "error" in rows.columns else F.lit(None).cast("string")
    key = F.coalesce(is_number(raw_cell(spec, spec.key)), F.lit(False))
    kind = F.when(mark, "file").when(long, "reject").when(key, "item")
    told = rows.withColumn("error", error).withColumn("kind", kind).where(F.col("kind").isNotNull())
    more = [extra_map(spec).alias("extras")] if extras == "map" else []
    item = F.col("kind") == "item"
    built = told.select(
        *FILE_COLUMNS, "business_date", "row_idx", "kind", F.when(item, F.struct(*target_columns(spec), *more)).alias("_item"),
        F.when(F.col("kind") == "reject", F.col("cells")).alias("cells"), F.when(F.col("kind") == "file", _file_error(spec)).alias("error"),
    )
    return built.select(*[c for c in built.columns if c != "_item"], "_item.*")


def meta_of_files(spark: SparkSession, path: str | list[tuple[str, int]]) -> DataFrame:
    """``file_id, file_name, header, header_row, business_date, error``: one row per landed file that has content."""
    texts, books, large = _by_kind(spark, path)
    columns = ["file_id", "file_name", "header", "header_row", "business_date"]
    parts = []
    if texts:
        parts.append(csv_grid.files_with_meta(csv_grid.whole_files(spark, texts)).select(*columns))
    if large:
        heads = csv_grid.split_heads(spark, texts)
        names = heads.where("row_idx = 0").select("file_id", "file_name")
        parts.append(file_meta(heads).join(names, "file_id").select(*columns))
    if books:
        chunks = xlsx_grid.decode_workbooks(xlsx_grid.workbooks(spark, books))
        parts.append(xlsx_grid.chunks_with_meta(chunks.where("first_row = 0 or error is not null")).select(*columns, "error"))
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return every if books else every.withColumn("error", F.lit(None).cast("string"))


def failed_files(spark: SparkSession, path: str | list[tuple[str, int]], spec: ReportSpec = ITEM_SALES) -> DataFrame:
    """``file_id, file_name, error`` of files that give no rows: unreadable, or without the key column."""
    meta = meta_of_files(spark, path)
    return meta.select("file_id", "file_name", _file_error(spec).alias("error")).where(F.col("error").isNotNull())


def rejected_rows(rows: DataFrame) -> DataFrame:
    """Rows with more fields than the header of their file."""
    return rows.where(_cell_count(rows) > F.col("width")).select(*FILE_COLUMNS, "row_idx", "cells")


def has_key(cell: Column) -> Column:
    return present(cell).isNotNull()


def strip_totals(rows: DataFrame, spec: ReportSpec = ITEM_SALES) -> DataFrame:
    """Drop totals rows: those without a key."""
    return rows.where(has_key(raw_cell(spec, spec.key)))


def strip_subheaders(rows: DataFrame, spec: ReportSpec = ITEM_SALES) -> DataFrame:
    """Drop rows whose key is no number. That takes the totals rows as well."""
    return rows.where(is_number(raw_cell(spec, spec.key)))


def item_rows(rows: DataFrame, spec: ReportSpec = ITEM_SALES) -> DataFrame:
    """Report rows that are items. Files without the key column have none."""
    fitting = rows.where(F.col("width").isNull() | (_cell_count(rows) <= F.col("width")))
    return strip_subheaders(fitting, spec)


def item_sales(rows: DataFrame, spec: ReportSpec = ITEM_SALES, extras: str | list[str] = "drop",
               keep: tuple[str, ...] = ("file_id", "row_idx")) -> DataFrame:
    """The upload table: one select over the item rows.

    ``extras`` says what becomes of raw columns outside the spec: ``'drop'``;
    ``'map'`` puts them into one map column; a list of names appends those as
    columns (the rows must have been read with the same list).
    """
    columns = [F.col(c) for c in keep] + target_columns(spec)
    if extras == "map":
        columns.append(extra_map(spec).alias("extras"))
    elif extras != "drop":
        columns += extra_columns(list(extras))
    return item_rows(rows, spec).select(*columns)


def item_sales_with_extras(grid: DataFrame, spec: ReportSpec = ITEM_SALES,
                           keep: tuple[str, ...] = ("file_id", "row_idx")) -> DataFrame:
    """The upload table with every raw column outside the spec appended, null where a file lacks it.

    More of them than a table can have as columns come as one map.
    """
    meta = written(file_meta(grid), "meta")
    names = extra_names(meta, spec, keep)
    # A map has all cells of a row.
    only = None if names is None else [c.raw for c in spec.mapped]
    rows = rows_of_grid(grid, spec, names, meta, only=only, keyed=is_number)
    return item_sales(rows, spec, "map" if names is None else names, keep)


def location_tags(dim: DataFrame) -> DataFrame:
    """``location_tag, pos_name, label, names``: what each tag stands for; both null where several names come out equal."""
    tags = dim.groupBy(sanitize(F.col("pos_name")).alias("location_tag")).agg(
        F.min_by(F.struct("pos_name", "label"), "ordinal").alias("_loc"), F.count_distinct("pos_name").alias("names")
    )
    one = F.col("names") == 1
    return tags.select("location_tag", F.when(one, F.col("_loc.pos_name")).alias("pos_name"), F.when(one, F.col("_loc.label")).alias("label"), "names")


def with_location(reports: DataFrame, dim: DataFrame, file_name: str = "file_name") -> DataFrame:
    """Attach ``pos_name`` and ``label`` by the location tag in the file name; null if unknown.

    File names carry the sanitized name, so that is the key of the lookup. A tag
    that several names share says nothing and is attributed to none of them.
    """
    return with_tagged_location(reports, location_tags(dim), file_name)


def with_tagged_location(reports: DataFrame, tags: DataFrame, file_name: str = "file_name") -> DataFrame:
    """``with_location`` for tags that are made already."""
    tagged = reports.withColumn("location_tag", location_tag_of(F.col(file_name)))
    return lookup_join(tagged, tags.drop("names"), "location_tag")


def for_sink(sales: DataFrame, spec: ReportSpec = ITEM_SALES) -> DataFrame:
    """Add the partition columns of the report table and the date as a date.

    Wants ``business_date`` and ``label`` among the kept columns. Reports without
    a date do not replace each other: their day names their file.
    """
    name = F.col("file_name" if "file_name" in sales.columns else "file_id")
    day = business_day_key(F.col("business_date"), spec.raw_date_format)
    own = F.concat(F.lit(f"{UNDATED}_"), sanitize(F.element_at(F.split(name, "/"), -1)))
    return (
        sales.withColumn("sales_date", parse_date(F.col("business_date"), spec.raw_date_format))
        .withColumn("business_day", F.when(day == UNDATED, own).otherwise(day))
        .withColumn("location_key", sanitize(F.coalesce(F.col("label"), F.lit(""))))
    )


def newest_only(sales: DataFrame) -> DataFrame:
    """Keep, for each business day and location, the rows of the newest file."""
    stamp = F.struct("modified_at", "file_name")
    newest = sales.groupBy(*REPORT_PARTITIONS).agg(F.max(stamp).alias("_newest"))
    kept = lookup_join(sales, newest, REPORT_PARTITIONS, "inner")
    return kept.where(stamp == F.col("_newest")).drop("_newest")


def reports_of(table: DataFrame, places: DataFrame, start: Column | None = None, run_date: Column | None = None) -> DataFrame:
    """Reports of some locations (rows of a mapping), and of the days from ``start`` up to the one before the run.

    The table's folders are by day and part of the locations: days are pruned as
    the query is planned, parts while it runs, by the keys of the mapping's rows.
    """
    wanted = places.select(sanitize(F.col("label")).alias("location_key")).distinct()
    day_folder, part = REPORT_FOLDERS
    if start is not None and run_date is not None:
        for day in ("business_day", *{day_folder} & {*table.columns}):
            table = table.where(before_run(F.col(day).cast("string"), start.cast("string"), run_date.cast("string")))
    if part not in table.columns:
        return lookup_join(table, wanted, "location_key", "left_semi")
    of_part = wanted.withColumn(part, key_part(F.col("location_key")))
    return lookup_join(table, of_part, [part, "location_key"], "left_semi").drop(*REPORT_FOLDERS)


def files_of_run(spark: SparkSession, path: str, run_id: str | None = None) -> list[tuple[str, int]]:
    """Raw files of one run below a folder, or the newest raw file, as ``sales_of_run`` takes them for a replay."""
    files = with_provenance(landed_files(spark, path))
    if run_id is None:
        chosen = files.orderBy(F.col("modified_at").desc(), F.col("file_name").desc()).limit(1)
    else:
        chosen = files.where(F.col("run_id") == run_id)
    return [(r.file_id, r.length) for r in chosen.select("file_id", "length").collect()]


def sales_of_run(spark: SparkSession, path: str | list[tuple[str, int]], dim: DataFrame, spec: ReportSpec = ITEM_SALES, extras: str = "map") -> tuple[DataFrame, DataFrame]:
    """The report table of everything below a folder or of given files, the newest file of a location and day; and what matches no location."""
    keep = (*FILE_COLUMNS, "business_date", "row_idx")
    sales = for_sink(with_location(item_sales(read_report_rows(spark, path, spec), spec, extras, keep), dim), spec)
    return newest_only(sales.where(F.col("label").isNotNull())), sales.where(F.col("label").isNull())


def sales_status(dim: DataFrame, files: DataFrame, failed: DataFrame, items: DataFrame, no_data: DataFrame | None = None) -> DataFrame:
    """Outcome of every expected location: ``ordinal, pos_name, label, ok, no_data, stage, error, row_count, business_date, bytes``.

    ``files`` are landed files (file_id, file_name, modified_at, length) of one
    run, ``failed`` those that give no rows (file_id, error), ``items`` the item
    rows (file_id, business_date), ``no_data`` the names (pos_name, error) for
    which the portal had none. The newest file of a location counts. Stage 2 is
    the download (an empty file is none), 3 the transformation, 4 what comes
    after both.
    """
    tags = location_tags(dim).select("location_tag", "names")
    newest = latest_files(files.withColumn("location_tag", location_tag_of(F.col("file_name"))).where(F.col("location_tag").isNotNull()), ["location_tag"])
    counts = items.groupBy("file_id").agg(F.count("*").alias("rows"), F.max("business_date").alias("date"))
    reasons = failed.groupBy("file_id").agg(F.min("error").alias("reason"))
    found = lookup_join(lookup_join(newest, counts, "file_id"), reasons, "file_id")
    expected = dim.withColumn("location_tag", sanitize(F.col("pos_name")))
    if no_data is None:
        told = expected.withColumn("_told", F.lit(None).cast("string"))
    else:
        told = lookup_join(expected, no_data.groupBy("pos_name").agg(F.min("error").alias("_told")), "pos_name")
    joined = lookup_join(lookup_join(told, tags, "location_tag"), found, "location_tag")
    landed = F.col("file_id").isNotNull()
    ambiguous = F.col("names") > 1
    error = (
        F.when(F.col("_told").isNotNull() & ~landed, F.col("_told"))
        .when(ambiguous, "ambiguous location name").when(~landed, "no file with content landed")
        .when(F.col("reason").isNotNull(), F.col("reason")).otherwise("")
    )
    stage = F.when(~landed, 2).when(ambiguous | F.col("reason").isNotNull(), 3).otherwise(4)
    return joined.select(
        "ordinal", "pos_name", "label", ((error == "") & landed).alias("ok"), (F.col("_told").isNotNull() & ~landed).alias("no_data"),
        stage.alias("stage"), error.alias("error"), F.when(error == "", F.coalesce("rows", F.lit(0))).otherwise(0).alias("row_count"),
        F.when(error == "", F.coalesce("date", F.lit(""))).otherwise("").alias("business_date"), F.coalesce("length", F.lit(0)).alias("bytes"),
    )
