"""What only shows on larger tables: days without turnover, many reports."""

from __future__ import annotations

import pytest
from compare import connect, difference
from pyspark.sql import functions as F

from tillgrid.operators import header, joins
from tillgrid.operators.spec import ITEM_SALES, target_columns
from tillgrid.plans import item_sales
from tillgrid.sources import csv_grid
from tillgrid.testbed import tables


@pytest.fixture(scope="module")
def idle(spark, tmp_path_factory):
    """Users with events of no value on their only day, beside others."""
    folder = str(tmp_path_factory.mktemp("idle"))
    events = spark.range(60).select(
        F.col("id").alias("event_id"), F.timestamp_add("hour", F.col("id").cast("int"), F.lit("2024-01-01").cast("timestamp")).alias("ts"),
        (F.col("id") % 20).alias("user_id"), F.element_at(F.array(*map(F.lit, ["click", "view", "purchase", "error"])), (F.col("id") % 4 + 1).cast("int")).alias("event_type"),
        F.when(F.col("id") % 20 < 12, 0.0).otherwise(F.col("id") / 4).alias("value"), F.lit("{}").alias("props"),
    )
    customers = spark.range(20).select(
        F.col("id").alias("c_custkey"), F.concat(F.lit("Name "), "id").alias("c_name"), F.lit(1).alias("c_nationkey"), F.lit(0.0).alias("c_acctbal"),
        F.lit("A").alias("c_mktsegment"),
    )
    for name, table in {"events": events, "customer": customers}.items():
        table.toPandas().to_parquet(f"{folder}/{name}.parquet", coerce_timestamps="us")
    return folder


@pytest.mark.parametrize("name", ["kpi_extract", "kpi_categories", "kpi_long_labels", "kpi_flatten", "kpi_message"])
def test_days_without_turnover(spark, idle, name):
    assert difference(spark, connect(idle), name, idle) == ""


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_reports_are_built_in_one_pass(spark):
    """The lines are read once, and what is shuffled has no cells yet."""
    plan = plan_of(tables.report_grid(spark, "/root/testdata/sf0.001"))
    assert plan.count("l_extendedprice") and plan.count("FileScan parquet [l_") == 1
    assert plan.count("Exchange hashpartitioning(file_id") == 1


def test_preview_takes_the_rows_that_matter(spark):
    cells = [["x", "y", str(i)] for i in range(30)]
    cells[3], cells[5], cells[9], cells[25] = ["Business Dates", "1/1/2026", "z"], [" Business Dates ", "2/1/2026", "z"], ["Menu Item Name", "a", "b"], ["Menu Item Name"]
    grid = spark.createDataFrame([("f", "f.csv", i, c) for i, c in enumerate(cells)], "file_id string, file_name string, row_idx bigint, cells array<string>")
    kept = header.preview_by_file(grid).first().preview
    assert [(r.row_idx, len(r.cells)) for r in kept] == [(0, 3), (3, 2), (5, 2), (9, 3)]
    meta = header.file_meta(grid).first()
    assert (meta.header_row, meta.business_date, meta.header) == (9, "2/1/2026", cells[9])
    other = header.file_meta(grid.where("row_idx not in (9, 25)")).first()
    assert (other.header_row, other.business_date, other.header) == (0, "2/1/2026", ["x", "y", "0"])


def test_join_without_hot_keys_is_plain(spark):
    facts = spark.range(300).select((F.col("id") % 50).alias("key"), "id")
    dim = spark.range(40).select(F.col("id").alias("key"), (F.col("id") * 2).alias("v"))
    joined = joins.spread_join(facts, dim, ["key"])
    assert joined.columns == ["key", "id", "v"] and joined.where("v is null").count() == 60 and joined.count() == 300
    assert "_join_salt" not in plan_of(joined) and "_join_salt" in plan_of(joins.spread_join(facts, dim, ["key"], hot_rows=2))


def test_starts_of_splits(spark):
    """Quotes carry over from split to split of a file; no Python group per file."""
    rows = [("a", 0, True, False, 3, 9), ("a", 20, False, True, 4, 5), ("a", 10, True, True, 1, 2), ("b", 0, False, True, 7, 7)]
    kinds = "file_id string, block_start bigint, out_end boolean, in_end boolean, out_records bigint, in_records bigint"
    starts = csv_grid.split_starts(spark.createDataFrame(rows, kinds))
    assert sorted(map(tuple, starts.collect())) == [("a", 0, False, True, 0), ("a", 10, True, True, 3), ("a", 20, True, True, 5), ("b", 0, False, False, 0)]
    assert "Pandas" not in plan_of(starts)


def test_listed_rows_are_made_once(spark):
    """No filter on the size of a report's listed rows, which would build them a second time."""
    plan = plan_of(tables.report_grid(spark, "/root/testdata/sf0.001"))
    assert "Generate inline(" in plan and "Filter (size(" not in plan


def test_money_text_names_its_input_once(spark):
    cents = [0, 5, -5, 99, -100, 123456, -987654321, 2**62, None]
    df = spark.createDataFrame([(c,) for c in cents], "c bigint").select(tables.money_text(F.col("c")).alias("m"))
    assert [r.m for r in df.collect()] == ["0.00", "0.05", "-0.05", "0.99", "-1.00", "1234.56", "-9876543.21", "46116860184273879.04", None]
    assert plan_of(df).count("cast(c#") == 1


def test_names_of_a_header_are_made_once(spark):
    headers = [["a ", "b", "a", "a.1", "a", ""], ["x", " y", "", "", "Unnamed: 4"], [], None, ["", None, "z", "z"]]
    df = spark.createDataFrame([(h,) for h in headers], "h array<string>").select(header.clean_header(F.col("h")).alias("n"))
    assert [r.n for r in df.collect()] == [["a", "b", "a.2", "a.1", "a.3", None], ["x", "y", None, None, None], [], None, [None, None, "z", "z.1"]]
    assert plan_of(df.limit(1)).count("regexp_replace") == 1


def test_a_shuffled_grid_takes_only_the_wanted_cells_along(spark):
    """Other places per file, a file without the column, long and short rows; the same items as with all cells."""
    heads = {"f": ["Menu Item Name", "Menu Item #", "x", "Qty Sold"], "g": ["Menu Item Name", "Qty Sold", "y", "z", "Menu Item #"], "h": ["Menu Item Name", "q"], None: ["Menu Item Name", "Menu Item #"]}
    rows = []
    for file, head in heads.items():
        body = [["n", str(i), "7", str(i + 1), str(i + 2), "more"][: len(head) + i - 2] for i in range(4)]
        rows += [(file, "r.csv", i, c) for i, c in enumerate([["Business Dates", "1/1/2026"], head, *body])]
    grid = spark.createDataFrame(rows, "file_id string, file_name string, row_idx bigint, cells array<string>").withColumn("modified_at", F.lit(None).cast("timestamp"))
    wanted = ["Menu Item #", "Qty Sold"]
    targets = ["POS Item ID *", "Sold QTY *"]

    def items(**how):
        found = item_sales.rows_of_grid(grid, **how)
        shown = item_sales.item_rows(found).select("file_id", "row_idx", *target_columns(ITEM_SALES, targets))
        return sorted(map(tuple, shown.collect())), sorted((r.file_id, r.row_idx) for r in item_sales.rejected_rows(found).collect()), found

    whole, narrow = items(), items(max_rows=0, only=wanted)
    assert whole[:2] == narrow[:2] and whole[0] and whole[1]
    assert narrow[2].selectExpr("max(size(cells))").first()[0] == 3  # places 1, 3 and 4
    monkey, item_sales.MOST_PLACES = item_sales.MOST_PLACES, 2
    try:
        assert items(max_rows=0, only=wanted)[:2] == whole[:2]
    finally:
        item_sales.MOST_PLACES = monkey


def test_rows_of_reports_are_numbered_without_a_sort_of_all(spark, tmp_path):
    """Several reports, a supplier with all kinds of heads; lines without a key and parts below zero go by the sort of places."""
    def grid(lines):
        rows = [(i, p, s, 1, 2.0, 100.0 + i, 0.1, day) for i, (s, p, day) in enumerate(lines)]
        names = "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_shipdate timestamp"
        folder = str(tmp_path / str(len(list(tmp_path.iterdir()))))
        spark.createDataFrame(rows, names).write.parquet(f"{folder}/lineitem.parquet")
        spark.range(0, 20_100, 3).selectExpr("id p_partkey", "concat('part ', id) p_name").write.parquet(f"{folder}/part.parquet")
        return tables.report_grid(spark, folder)

    def by_place(df):
        return sorted((r.file_id, r.row_idx, tuple(r.cells), r.file_name) for r in df.where("file_id is not null").collect())

    from datetime import datetime

    day = datetime(1998, 8, 2)
    lines = [(s, p, day) for s in (0, 7, 16, 18, 29) for p in (0, 1, 25, 50, 9_999, 10_000, 20_000)] + [(7, 25, day)]
    plain = grid(lines)
    assert plan_of(plain).count("Sort [file_id") == 1
    got = by_place(plain)
    files = {f for f, *_ in got}
    assert len(files) == 15 and all([i for f, i, *_ in got if f == file] == list(range(sum(f == file for f, *_ in got))) for file in files)
    sold = tables.sold_items(spark, str(tmp_path / "0")).repartition("file_id")
    assert sorted((r.file_id, r.row_idx, r.place) for r in tables._rows_by_place(sold).collect()) == sorted(
        (r.file_id, r.row_idx, r.place) for r in tables._rows_by_part(sold).collect())
    twice = sold.union(sold.where("p in (0, 25, 9999)"))
    assert sorted((r.file_id, r.row_idx, r.place) for r in tables._rows_by_place(twice).collect()) == sorted(
        (r.file_id, r.row_idx, r.place) for r in tables._rows_by_part(twice.repartition("file_id")).collect())
    odd = grid([*lines, (None, 4, day), (5, None, day), (None, None, day), (None, 5, day)])
    assert by_place(odd) == got and sorted(r.row_idx for r in odd.where("file_id is null").collect()) == list(range(odd.where("file_id is null").count()))
    below = grid([*lines, (2, -60, day), (2, 3, day)])
    assert [r.cells[1] for r in below.where("file_id = 'loc2-0' and row_idx = 4").collect()] == ["-60"]


def test_rows_that_nobody_wants_are_not_shuffled(spark):
    """Rows whose key cell fails the test stay behind, and those above every header; the same items."""
    head = ["Menu Item Name", "Menu Item #", "Till"]
    rows = [(f, "r.csv", i, c) for f in ("f", "g") for i, c in enumerate([["Business Dates", "1/1/2026"], ["x", "7"], head, ["Totals:", "", ""], ["a", "5", "t"], ["-- b --", "Section"]])]
    grid = spark.createDataFrame(rows, "file_id string, file_name string, row_idx bigint, cells array<string>").withColumn("modified_at", F.lit(None).cast("timestamp"))
    whole, kept = item_sales.rows_of_grid(grid), item_sales.rows_of_grid(grid, max_rows=0, only=["Menu Item #"], keyed=item_sales.is_number)
    assert item_sales.item_rows(kept).count() == item_sales.item_rows(whole).count() == 2 and kept.count() == 2
    with_key = item_sales.rows_of_grid(grid, max_rows=0, only=["Menu Item #"], keyed=item_sales.has_key)
    assert with_key.count() == 4 and item_sales.strip_totals(with_key).count() == item_sales.strip_totals(whole).count()
    extras = item_sales.rows_of_grid(grid, extras=["Till"], max_rows=0, only=["Menu Item #"], keyed=item_sales.is_number)
    assert [r.Till for r in item_sales.item_sales(extras, extras=["Till"]).collect()] == ["t", "t"]
    assert "Till" in item_sales.item_sales_with_extras(grid).columns


def test_differences_bring_rows_together_once(spark):
    left = spark.createDataFrame([("f", "a"), ("f", "a"), ("f", None), ("g", "b"), (None, "c")], "file_id string, name string")
    right = spark.createDataFrame([("f", "a"), ("g", "b"), ("g", "d"), ("g", "d")], "file_id string, name string")
    from tillgrid.operators import sets

    found = sets.both_differences(left, right, "l", "r")
    assert sorted(map(str, (tuple(r) for r in found.collect()))) == sorted(map(str, [("f", "a", "l"), ("f", None, "l"), (None, "c", "l"), ("g", "d", "r"), ("g", "d", "r")]))
    assert plan_of(sets.both_differences(left, right, "l", "r")).count("Exchange hashpartitioning") == 1
