"""Point-of-sale inputs derived by Spark from the driver's tables.

Each function turns whole tables into the shape an operator wants: report
grids from order lines, mappings from suppliers and customers, KPI payloads
from events, run results from orders. Nothing is filtered out.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillgrid.functions.text import sanitize
from tillgrid.session import SCRATCH_CODEC, scratch_dir

# A report holds at most this many menu items; a supplier with more has several reports.
ITEMS_PER_REPORT = 10_000
WIDTH = 13
RUN_STAMP = "20260416T102300"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_LANDED: dict[tuple[str, str, str], str] = {}


def landed(spark: SparkSession, sf_dir: str, build: Callable[[SparkSession, str], DataFrame]) -> DataFrame:
    """A derived input as a table in the shared scratch folder, written once per application.

    The operators then read it as they would read what has landed, and their
    plans hold nothing of how the input was made.
    """
    key = (spark.sparkContext.applicationId, sf_dir, build.__name__)
    if key not in _LANDED:
        path = scratch_dir(spark, build.__name__)
        build(spark, sf_dir).write.option("compression", SCRATCH_CODEC).parquet(path)
        _LANDED[key] = path
    return spark.read.parquet(_LANDED[key])


def text(value: Column) -> Column:
    return value.cast("string")


def join_text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else text(p) for p in parts])


def whole_div(value: Column, by: int) -> Column:
    return F.call_function("div", value, F.lit(by))


def money_text(cents: Column) -> Column:
    """Cents as money; names its input once, so that projections with many amounts stay small enough to be compiled."""
    return text(cents.cast("decimal(20,0)") * F.lit(Decimal("0.01")))


# ---- reports ---------------------------------------------------------------------------------


def store_name(s: Column) -> Column:
    kind = s % 4
    return (
        F.when(kind == 0, join_text("Store ", s, " – Mall"))
        .when(kind == 1, join_text("Parade's Store ", s))
        .when(kind == 2, join_text("Store/ ", s, " [North]"))
        .otherwise(join_text("STORE - ", s))
    )


def raw_file_name(file_id: Column, s: Column) -> Column:
    run = F.concat(F.lit(f"{RUN_STAMP}_"), F.substring(F.md5(file_id), 1, 8))
    return F.concat(run, F.lit("_"), sanitize(store_name(s)), F.lit("_raw.csv"))


def sold_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales of each supplier and part in whole cents: ``file_id, s, p, name, qty, gross, disc, last_day``."""
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    percent = F.round(F.col("l_discount") * 100).cast("bigint")
    sold = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_suppkey").alias("s"), F.col("l_partkey").alias("p"))
        .agg(
            F.sum(F.col("l_quantity").cast("bigint")).alias("qty"),
            F.sum(cents).alias("gross"),
            whole_div(F.sum(cents * percent), 100).alias("disc"),
            F.max(F.to_date("l_shipdate")).alias("last_day"),
        )
    )
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("p"), "p_name")
    name = F.coalesce("p_name", F.lit("?"))
    # A plain join: looking for hot parts first would add the lines up twice, and Spark's skew join splits them.
    return sold.join(parts, "p", "left").select(
        join_text("loc", F.col("s"), "-", whole_div(F.col("p"), ITEMS_PER_REPORT)).alias("file_id"),
        "s", "p", "qty", "gross", "disc", "last_day",
        F.when(F.col("p") % 9 == 0, F.concat(name, F.lit(', "XL"'))).otherwise(name).alias("name"),
    )


def _cells(*values: Column | str) -> Column:
    given = [F.lit(v) if isinstance(v, str) else v for v in values]
    return F.array(*given, *[F.lit("")] * (WIDTH - len(given)))


def _header(s: Column) -> Column:
    last = s % 4
    return F.array(
        F.lit("Menu Item Name"), F.when(s % 13 == 12, "Item No").otherwise("Menu Item #"), F.lit("Menu Item Def"),
        F.lit("Price Level"), F.lit(" Qty Sold "), F.lit("Returns"), F.lit("Net VAT before Disc."),
        F.lit("Discounts VAT"), F.lit("Net VAT after Disc."), F.lit("Gross before Disc."), F.lit("Discounts"),
        F.when(s % 5 == 4, "Gross (old)").otherwise("Gross after Disc."),
        F.when(last == 1, "Cashier").when(last == 2, "Discounts").when(last == 3, "").otherwise("Unnamed: 12"),
    )


def _item_cells() -> Column:
    s, p, gross, disc = F.col("s"), F.col("p"), F.col("gross"), F.col("disc")
    after = gross - disc

    def on(kind: int, mark: str) -> Column:
        return F.when(p % 6 == kind, mark).otherwise("")

    qty = F.when((p % 23 == 0) & (p % 7 != 0), "1,234").otherwise(F.concat(text(F.col("qty")), F.when(p % 7 == 0, ".9").otherwise("")))
    discount = F.when(p % 6 == 3, "").otherwise(F.concat(on(2, "("), money_text(F.when(p % 6 == 2, disc).otherwise(-disc)), on(2, ")")))
    extra = F.when(s % 4 == 1, join_text("till ", p % 5)).when(s % 4 == 2, money_text(disc)).when(s % 4 == 3, "x")
    return _cells(
        F.col("name"), text(p), "1", "1", qty, "0", money_text(whole_div(gross * 100, 105)),
        money_text(-whole_div(disc, 21)), F.concat(on(1, "AED "), money_text(whole_div(after * 100, 105))), money_text(gross),
        discount, F.concat(money_text(after), on(4, " AED")), F.coalesce(extra, F.lit("")),
    )


def report_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grid rows of all reports, with preamble, header, totals, section and item rows.

    Items are shuffled once, by report and before they have cells, and sorted
    once. A running sum over the items says where the rows of each begin, so
    the rows put beside them are numbered as they are made; items get their
    cells last, in one stage.
    """
    items = sold_items(spark, sf_dir).repartition("file_id")
    odd = table(spark, sf_dir, "lineitem").where("l_suppkey is null or l_partkey is null or l_partkey < 0")
    found, below = odd.agg(F.count("*"), F.count_if(F.col("l_partkey") < 0)).first()
    rows = _rows_by_place(items) if below else _rows_by_part(items.where(F.col("file_id").isNotNull()))
    if found and not below:
        rows = rows.unionByName(_rows_by_place(items.where(F.col("file_id").isNull())))
    return rows.select(
        "file_id", "file_name", F.lit(None).cast("timestamp").alias("modified_at"), "row_idx", F.coalesce("given", _item_cells()).alias("cells")
    )


def _rows_by_part(items: DataFrame) -> DataFrame:
    """Rows of reports with ``row_idx``: the report's own rows, then its parts in order; of one part all sections come before all items."""
    by_part = Window.partitionBy("file_id", "s").orderBy("p")
    smaller = by_part.rangeBetween(Window.unboundedPreceding, -1)
    s = F.col("s")
    heads = 6 + (s % 11 == 7).cast("int") + (s % 11 != 5).cast("int") + _fillers()
    rows = F.when(F.col("p") % 25 == 0, 2).otherwise(1)
    return _listed(items, {
        "begins": heads + F.coalesce(F.sum(rows).over(smaller), F.lit(0)),
        "tie": F.row_number().over(by_part) - 1 - F.count("*").over(smaller), "ties": F.count("*").over(by_part.rangeBetween(0, 0)),
    }).withColumn("row_idx", F.col("at"))


def _rows_by_place(items: DataFrame) -> DataFrame:
    """The same by a sort of all rows, which holds too for lines without a key (they are no report, but come together) and parts below zero."""
    place = F.row_number().over(Window.partitionBy("file_id").orderBy("place")) - 1
    return _listed(items, {"begins": F.lit(0), "tie": F.lit(0), "ties": F.lit(0)}).withColumn("row_idx", place.cast("bigint"))


def _fillers() -> Column:
    return F.when(F.col("s") % 17 == 16, 25).otherwise(F.col("s") % 3).cast("int")


def _listed(items: DataFrame, numbers: dict[str, Column]) -> DataFrame:
    """A row per grid row: the items' columns, ``place``, ``at`` and ``given`` cells.

    ``at`` follows from where the rows of a part begin, and which of how many
    lines of the same part this is (``numbers``: ``begins``, ``tie``, ``ties``).
    """
    s, p = F.col("s"), F.col("p")
    report = Window.partitionBy("file_id", "s")
    known = items.withColumn("first", F.row_number().over(report.orderBy("p")) == 1).withColumns({
        "file_name": F.max(F.when(F.col("first"), raw_file_name(F.col("file_id"), s))).over(report),
        "all_days": F.max("last_day").over(report), "all_qty": F.sum("qty").over(report),
        "all_gross": F.sum("gross").over(report), "all_disc": F.sum("disc").over(report),
        **{name: number.cast("bigint") for name, number in numbers.items()},
    })

    def row(place: Column | int, cells: Column | None = None, at: Column | int = 0) -> Column:
        given = F.lit(None).cast("array<string>") if cells is None else cells
        return F.struct(F.lit(place).cast("bigint").alias("place"), F.lit(at).cast("bigint").alias("at"), given.alias("given"))

    day = F.when(s % 11 == 3, F.date_format("all_days", "yyyy-MM-dd")).otherwise(F.date_format("all_days", "dd/MM/yyyy"))
    filler_rows = F.transform(
        F.slice(F.sequence(F.lit(1), F.lit(25)), F.lit(1), _fillers()), lambda i: row(F.lit(-100) + i, _cells(join_text("Filter ", i), "All"))
    )
    top = F.array_compact(F.array(
        F.when(s % 11 == 7, row(-200, _cells("Business Dates", "01/01/1990"))),
        F.when(s % 11 != 5, row(-199, _cells("Business Dates", day))),
        row(-198, _cells("Locations", store_name(s))),
        row(-197, _cells("Revenue Centers", store_name(s))),
        row(-196, _cells("Menu Items", "All")),
    ))
    head = F.array(
        row(-50, _cells("")),
        row(-49, _header(s)),
        row(-48, _cells("Totals:", "", "1", "1", text(F.col("all_qty")), "0", "", "", "", money_text(F.col("all_gross")),
                        money_text(-F.col("all_disc")), money_text(F.col("all_gross") - F.col("all_disc")))),
    )
    numbered = F.transform(
        F.concat(top, filler_rows, head), lambda row, i: F.struct(row["place"].alias("place"), i.cast("bigint").alias("at"), row["given"].alias("given"))
    )
    heads, sections = F.when(F.col("first"), numbered), p % 25 == 0
    begins = F.col("begins") + F.col("tie")
    section = row(p * 2, _cells(join_text("-- section ", p, " --"), "Section"), begins)
    item = row(p * 2 + 1, at=begins + F.when(sections, F.col("ties")).otherwise(0))
    listed = F.concat(F.coalesce(heads, F.array().cast(_ROWS)), F.when(sections, F.array(section, item)).otherwise(F.array(item)))
    # A column of its own first: what a generator holds itself is not compiled. Outer, as a filter on its size would make it twice.
    return known.withColumn("listed", listed).select(*known.columns, F.inline_outer("listed"))


_ROWS = "array<struct<place: bigint, at: bigint, given: array<string>>>"


def csv_line(cells: Column) -> Column:
    def field(c: Column) -> Column:
        quoted = F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
        return F.when(c.rlike('[",\r\n]'), quoted).otherwise(c)

    return F.array_join(F.transform(cells, field), ",")


def land_csv(grid: DataFrame, path: str) -> None:
    """Write each report as a text file of its own; a report is bounded, so one task writes it."""
    (
        grid.select("file_id", "row_idx", csv_line(F.col("cells")).alias("value"))
        .repartition("file_id")
        .sortWithinPartitions("file_id", "row_idx")
        .select("value", "file_id")
        .write.partitionBy("file_id")
        .text(path)
    )


def landed_id(file_id: Column) -> Column:
    """The report key in the path of a landed file."""
    return F.regexp_extract(file_id, "file_id=([^/]+)/", 1)


# ---- mappings --------------------------------------------------------------------------------


def location_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ordinal, pos_name, label`` from suppliers; some labels say that the location is out of use."""
    s = F.col("s_suppkey")
    kind = s % 17
    label = (
        F.when(kind == 3, "N/A").when(kind == 5, "LOCATION CLOSED ").when(kind == 7, "Location Name not mentioned yet")
        .when(kind == 9, "  ").when(kind == 11, "no sales for now").when(kind == 13, "Not in use")
        .otherwise(join_text("Label: ", s, " / ", F.col("s_name")))
    )
    return table(spark, sf_dir, "supplier").select(
        s.alias("ordinal"), store_name(s).alias("pos_name"), label.alias("label")
    )


def report_place(file_id: Column) -> Column:
    """The name of the place a single report is about: store and menu part."""
    s = F.regexp_extract(file_id, r"loc(\d+)-(\d+)", 1).cast("bigint")
    return join_text(store_name(s), " menu ", F.regexp_extract(file_id, r"loc(\d+)-(\d+)", 2))


def report_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ordinal, pos_name, label`` with one place per report, so that no report replaces another."""
    s = F.regexp_extract("file_id", r"loc(\d+)-", 1).cast("bigint")
    out_of_use = (s % 17).isin(3, 5, 7, 9, 11, 13)
    reports = landed(spark, sf_dir, report_grid).select("file_id").distinct()
    return reports.select(
        (s * 1_000_000 + F.regexp_extract("file_id", r"-(\d+)$", 1).cast("bigint")).alias("ordinal"), report_place(F.col("file_id")).alias("pos_name"),
        F.when(out_of_use, "N/A").otherwise(join_text("Label ", F.col("file_id"))).alias("label"),
    )


def hub_name(c: Column) -> Column:
    kind = c % 5
    return (
        F.when(kind == 0, join_text("Hub ", c)).when(kind == 1, join_text("Hub [", c, "] East"))
        .when(kind == 2, join_text("HUB'S - ", c)).when(kind == 3, join_text("Shop ", c, " "))
        .otherwise(join_text("hub ", c, "-x"))
    )


def portal_name(c: Column) -> Column:
    """The same places as the portal writes them: other case and marks, some repeated, some unknown."""
    kind = c % 5
    return (
        F.when(c % 11 == 0, join_text("Annex ", whole_div(c, 100)))
        .when(kind == 0, join_text("Hub ", c)).when(kind == 1, join_text("hub ", c, " east"))
        .when(kind == 2, join_text("Hub's-", c)).when(kind == 3, join_text(" Shop ", c))
        .when(c % 3 == 0, join_text("Depot ", c)).otherwise(join_text("HUB ", c, " X"))
    )


def code_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ordinal, code, label, pos_name`` from customers."""
    c = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        c.alias("ordinal"), join_text("C", c).alias("code"),
        join_text(F.col("c_name"), " - ", F.col("c_mktsegment")).alias("label"), hub_name(c).alias("pos_name"),
    )


def workplace_pages(spark: SparkSession, sf_dir: str, size: int = 500) -> DataFrame:
    """``page, payload``: portal pages of ``size`` workplaces from customers."""
    c = F.col("c_custkey")
    entry = F.struct(c.alias("at"), portal_name(c).alias("name"), c.alias("id"))
    listed = F.array_sort(F.collect_list(entry))  # at most `size` entries: the key is unique
    data = F.transform(listed, lambda e: F.struct(e["name"].alias("name"), e["id"].alias("id")))
    return (
        table(spark, sf_dir, "customer").groupBy(whole_div(c, size).alias("page"))
        .agg(F.to_json(F.struct(data.alias("data"))).alias("payload"))
    )


def pages_with_holes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of ten workplaces each, numbered so that the first and some others are missing; some are there twice."""
    pages = workplace_pages(spark, sf_dir, 10)
    page = F.col("page") + 2 + whole_div(F.col("page"), 5) + 3 * whole_div(F.col("page"), 11)
    moved = pages.withColumn("times", F.when(F.col("page") % 13 == 5, 2).otherwise(1)).select(page.alias("page"), "payload", "times")
    return moved.select("page", "payload", F.explode(F.sequence(F.lit(1), "times")).alias("time")).drop("time")


def cut_payloads(reports: DataFrame) -> DataFrame:
    """Some payloads that hold figures break off before their end."""
    key = F.col("workplace_id") + F.dayofmonth("report_date")
    nested = (key % 29 != 0) & (key % 31 != 0) & (key % 37 != 0)
    return reports.withColumn("payload", F.when(nested & (key % 11 == 0), F.expr("substring(payload, 1, length(payload) - 3)")).otherwise(F.col("payload")))


def portal_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(c.alias("ordinal"), portal_name(c).alias("option"))


def name_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``o_orderkey, pos_name``: places asked for, written in several ways, some unknown."""
    o, name = F.col("o_orderkey"), hub_name(F.col("o_custkey"))
    kind = o % 7
    asked = (
        F.when(kind == 4, F.upper(name)).when(kind == 5, F.replace(name, F.lit(" "), F.lit("  ")))
        .when(kind == 6, join_text("Unknown ", F.col("o_custkey") % 10)).otherwise(name)
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", asked.alias("pos_name"))


def code_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``o_orderkey, code, report_date``: KPI reports asked for, some codes unknown."""
    o, c = F.col("o_orderkey"), F.col("o_custkey")
    code = F.when(o % 40 == 0, join_text("X", c)).otherwise(join_text("C", whole_div(c, 10)))
    day = F.date_add(F.lit("2024-01-01").cast("date"), (o % 30).cast("int"))
    return table(spark, sf_dir, "orders").select("o_orderkey", code.alias("code"), day.alias("report_date"))


# ---- KPI payloads ----------------------------------------------------------------------------

# Event types and the category they stand for.
EVENT_CATEGORIES = {"click": "juice", "view": "coffee", "purchase": "sandwich", "signup": "breakfast"}


def _share(part: Column, whole: Column) -> Column:
    """The quotient as in the SQL: a share of nothing is no number or infinite, not an error."""
    return F.when(whole == 0, part * F.lit(float("inf"))).otherwise(part / whole)


def kpi_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``workplace_id, report_date, payload``: one nested JSON report per user and day."""
    kind, cents = F.col("event_type"), F.round(F.col("value") * 100).cast("bigint")
    sums = [F.sum(cents).alias("cents"), F.count("*").alias("n"), F.max("value").alias("top")]
    for event in [*EVENT_CATEGORIES, "error"]:
        sums.append(F.coalesce(F.sum(F.when(kind == event, cents)), F.lit(0)).alias(f"cents_{event}"))
        sums.append(F.count_if(kind == event).alias(f"n_{event}"))
    daily = table(spark, sf_dir, "events").groupBy(
        F.col("user_id").alias("workplace_id"), F.to_date("ts").alias("report_date")
    ).agg(*sums)

    def category(event: str) -> Column:
        count = F.col(f"n_{event}")
        figures = F.struct(
            (F.col(f"cents_{event}") / 100).alias("turnover"), count.alias("products"),
            _share(F.col(f"cents_{event}") * 100, F.col("cents")).alias("turnover_percentage"),
            (count * 100 / F.col("n")).alias("product_percentage"),
        )
        return F.when(count > 0, figures).alias(EVENT_CATEGORIES[event])

    share = F.struct(F.col("n_error").alias("products"), (F.col("n_error") * 100 / F.col("n")).alias("percentage"))
    data = F.struct(
        F.struct((F.col("cents") / 100).alias("turnover"), F.col("n").alias("products"),
                 F.col("top").alias("php_max")).alias("total"),
        F.struct((F.col("cents") / (F.col("n") * 100)).alias("turnover"), F.lit(None).cast("double").alias("products")
                 ).alias("average"),
        F.struct(*[category(e) for e in EVENT_CATEGORIES]).alias("categories"),
        F.struct(F.when(F.col("n_error") > 0, share).alias("neighbour")).alias("discount_group"),
        F.when(F.col("n_error") > 1, share).alias("employee_meal"),
    )
    nested = data.alias("data")
    for level in ("content", "content", "content", "tables", "data"):
        nested = F.array(F.struct(nested)).alias(level)
    key = F.col("workplace_id") + F.dayofmonth("report_date")
    payload = (
        F.when(key % 29 == 0, '{"data":[]}').when(key % 31 == 0, "not json")
        .when(key % 37 == 0, '{"data":[{"tables":[{"content":[{"content":[{"content":[{"data":{}}]}]}]}]}]}')
        .otherwise(F.to_json(F.struct(nested)))
    )
    return daily.select("workplace_id", "report_date", payload.alias("payload"))


# ---- runs and landed files -------------------------------------------------------------------


def run_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results per location from orders: status F is a success, O has no data, P failed."""
    o, c, state = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus")
    ok, no_data = state == "F", state == "O"
    error = (
        F.when(ok, "").when(no_data, join_text("No data for Store ", c))
        .otherwise(join_text("Report did not finish rendering for Store ", c, " with priority ", F.col("o_orderpriority")))
    )
    rows = F.floor("o_totalprice").cast("bigint")
    return table(spark, sf_dir, "orders").select(
        o.alias("ordinal"), join_text("Store ", c).alias("pos_name"),
        F.when(c % 10 == 0, join_text("A label that is longer than the forty-five characters shown ", c))
        .otherwise(join_text("Label ", c % 97)).alias("label"),
        ok.alias("ok"), no_data.alias("no_data"), F.when(ok, 4).when(no_data, 2).otherwise(2 + o % 3).cast("int").alias("stage"),
        error.alias("error"), F.when(ok, rows).otherwise(0).alias("row_count"),
        F.when(ok, F.date_format("o_orderdate", "dd-MMM-yyyy")).otherwise("").alias("business_date"),
    )


def landed_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``file_id, file_name, modified_at, length`` of landed files from orders; some are empty or misnamed."""
    o = F.col("o_orderkey")
    stamp = F.date_format("o_orderdate", "yyyyMMdd'T'HHmmss")
    run = F.concat(stamp, F.lit("_"), F.substring(F.md5(text(o)), 1, 8))
    tag = F.when(o % 9 == 0, "").otherwise(F.concat(F.lit("_"), sanitize(store_name(F.col("o_custkey")))))
    suffix = F.when(o % 3 == 0, "csv").when(o % 3 == 1, "XLSX").otherwise("xlsx")
    name = F.when(o % 50 == 0, join_text("notes ", o, ".txt")).otherwise(F.concat(run, tag, F.lit("_raw."), suffix))
    return table(spark, sf_dir, "orders").select(
        o.alias("file_id"), name.alias("file_name"), F.col("o_orderdate").cast("timestamp").alias("modified_at"),
        F.when(o % 20 == 0, 0).otherwise(F.floor("o_totalprice")).cast("bigint").alias("length"),
    )


def landed_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``kind, id, text``: whole document texts and pages, some ending in a row count."""

    def ending(key: Column) -> Column:
        return (
            F.when(key % 9 == 0, "\nShowing 10 rows").when(key % 9 == 1, "\nfound 0 Rows")
            .when(key % 9 == 2, "\nThere is NO DATA").otherwise("")
        )

    docs = table(spark, sf_dir, "documents").select(
        F.lit("document").alias("kind"), F.col("doc_id").alias("id"), F.concat("text", ending(F.col("doc_id"))).alias("text")
    )
    pages = table(spark, sf_dir, "pages").select(
        F.lit("page").alias("kind"), F.col("page_id").alias("id"), F.concat("html", ending(F.col("page_id"))).alias("text")
    )
    return docs.unionByName(pages)
