from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tillgrid.operators import joins, kpi, locations, sets, status
from tillgrid.operators.ordinal import number_rows
from tillgrid.operators.spec import ITEM_SALES, spec_from_config, spec_table
from tillgrid.plans import kpi_report
from tillgrid.sources import landing, mapping, payloads


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


# ---- joins and numbering: a third of all rows on one key ---------------------------------------


@pytest.fixture(scope="module")
def skewed(spark):
    facts = spark.range(3000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 500)).alias("key")
    )
    dim = spark.range(400).select(
        F.when(F.col("id") == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id"))).alias("key"), (F.col("id") * 10).alias("v")
    )
    return facts, dim


@pytest.mark.parametrize("how", ["left", "inner", "left_anti", "left_semi"])
def test_spread_join_equals_plain_join(skewed, how):
    facts, dim = skewed
    want = rows(facts.join(dim, "key", how), "id")
    spread = joins.spread_join(facts, dim, ["key"], how, hot_rows=10, salts=8)
    assert rows(spread.select(facts.join(dim, "key", how).columns), "id") == want
    small = joins.lookup_join(facts, dim, "key", how)
    large = joins.lookup_join(facts, dim, "key", how, max_rows=399)
    assert rows(small, "id") == rows(large, "id") == want


def test_hot_keys_are_found(skewed):
    facts, dim = skewed
    want = [r.h for r in dim.where("key = 'hot'").select(F.xxhash64("key").alias("h")).collect()]
    assert [r._join_hash for r in joins.hot_keys(facts, ["key"], 10).collect()] == want
    assert joins.hot_keys(facts, ["key"], 2000).count() == 0
    assert joins.fits_broadcast(dim, 400) and not joins.fits_broadcast(dim, 399) and not joins.fits_broadcast(dim, 0)


def test_join_with_duplicate_dimension_and_null_keys(spark):
    facts = spark.createDataFrame([(1, "a"), (2, None), (3, "b"), (4, "a")], "id int, key string")
    dim = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "key string, v int")
    for how in ("left", "inner", "left_anti"):
        want = sorted(map(str, facts.join(dim, "key", how).collect()))
        got = joins.spread_join(facts, dim, ["key"], how, hot_rows=1, salts=3)
        assert sorted(map(str, got.collect())) == want


@pytest.mark.parametrize("groups", [[], ["key"]])
def test_number_rows(skewed, groups):
    facts, _ = skewed
    sparse = facts.withColumn("place", F.col("id") * F.col("id") * 7_000_000)
    numbered = number_rows(sparse, groups, "place")
    got = {(r.key, r.id): r.ordinal for r in numbered.collect()}
    seen: dict = {}
    for key, i in sorted(got, key=lambda k: k[1]):
        group = key if groups else ""
        assert got[(key, i)] == seen.get(group, 0)
        seen[group] = seen.get(group, 0) + 1
    assert len(got) == 3000
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and ("Window" in plan) == bool(groups)


def test_number_rows_null_groups_text_order_and_empty(spark):
    entries = [(None, "b"), ("x", "c"), (None, "a"), ("x", None), (None, None), ("", "z")]
    df = spark.createDataFrame(entries, "g string, o string")
    assert rows(number_rows(df, ["g"], F.col("o").asc_nulls_last(), start=1), F.col("g").asc_nulls_first(), "ordinal") == [
        (None, "a", 1), (None, "b", 2), (None, None, 3), ("", "z", 1), ("x", "c", 1), ("x", None, 2),
    ]
    assert number_rows(df.limit(0), ["g"], "o").count() == 0 and number_rows(df.limit(0), [], "o").count() == 0


def test_number_rows_computes_its_input_once(spark):
    seen = spark.sparkContext.accumulator(0)
    source = spark.sparkContext.parallelize(range(1000), 5).map(lambda i: (seen.add(1), (i % 3, i))[1])
    assert number_rows(spark.createDataFrame(source, "g long, i long"), ["g"], "i").where("ordinal = 0").count() == 3
    assert seen.value == 1000


# ---- locations -------------------------------------------------------------------------------


def test_location_choice(spark):
    entries = [("Bay", "Bay-1"), ("Hill", "N/A"), ("bay", "Bay-2"), ("Dock", "Location Name not mentioned"), ("Pier", "Pier")]
    dim = mapping.locations_from_config(spark, [{"pos_name": p, "l": v} for p, v in entries], "l")
    assert [r.pos_name for r in locations.active_locations(dim).orderBy("ordinal").collect()] == ["Bay", "bay", "Pier"]
    assert [(r.number, r.pos_name) for r in locations.list_locations(dim).orderBy("number").collect()] == [
        (1, "Bay"), (2, "bay"), (3, "Pier"),
    ]
    assert [r.label for r in locations.pick_location(dim, "BAY").collect()] == ["Bay-1"]
    assert locations.limit_locations(dim, 2).count() == 2 and locations.limit_locations(dim, 0).count() == 5
    assert mapping.duplicate_names(dim).count() == 0
    same = mapping.locations_from_config(spark, [{"pos_name": "a", "l": "x y"}, {"pos_name": "a", "l": "x_y"}], "l")
    assert mapping.duplicate_names(same).count() == 1
    assert locations.key_collisions(same).first().location_key == "x_y"


def test_mapping_files(spark, tmp_path):
    (tmp_path / "l.csv").write_text('ordinal,pos_name,label\n0,"Bay, North",B\n')
    (tmp_path / "c.csv").write_text("ordinal,code,label,pos_name\n0,C1,L,Bay\n")
    assert tuple(mapping.read_locations(spark, str(tmp_path / "l.csv")).first()) == (0, "Bay, North", "B")
    codes = mapping.read_codes(spark, str(tmp_path / "c.csv"))
    assert tuple(codes.first()) == tuple(mapping.codes_from_config(spark, {"C1": ("L", "Bay")}).first()) == (0, "C1", "L", "Bay")


def pages(spark, *chunks):
    data = [(i, json.dumps({"data": [{"name": n, "id": k} for n, k in chunk]})) for i, chunk in enumerate(chunks)]
    return spark.createDataFrame(data, "page bigint, payload string")


def test_workplaces(spark):
    listed = pages(spark, [("Bay ", 1), ("Hill", 2)], [("bay", 3), ("Bay", 4)], [])
    found = locations.workplace_dedup(payloads.workplace_rows(listed, 2))
    assert rows(found, "first_seq") == [("Bay", 4, 0), ("Hill", 2, 1), ("bay", 3, 2)]
    assert tuple(payloads.pages_complete(listed, 2).first()) == (3, 4, True)
    assert tuple(payloads.pages_complete(pages(spark, [("a", 1), ("b", 2)]), 2).first()) == (1, 2, False)
    gap = listed.where("page <> 1")
    assert not payloads.pages_complete(gap, 2).first().complete


@pytest.mark.parametrize("max_rows", [100, 0])
def test_resolve(spark, max_rows):
    found = spark.createDataFrame(
        [("B-A-Y", 9, 0), ("Bay", 4, 1), ("Hill [1]", 2, 2), ("hill1", 5, 3)], "name string, id bigint, first_seq bigint"
    )
    asked = spark.createDataFrame([(1, "Bay"), (2, "BAY"), (3, "hill 1"), (4, "Dock"), (5, "hill1"), (6, None)], "n int, pos_name string")
    got = locations.resolve_cascade(asked, found, max_rows=max_rows)
    assert rows(got.select("n", "workplace_id", "matched_by"), "n") == [
        (1, 4, "exact"), (2, 9, "normalised"), (3, 2, "normalised"), (4, None, None), (5, 5, "exact"), (6, None, None),
    ]
    assert [r.n for r in locations.resolve_unmatched(asked, found).orderBy("n").collect()] == [4, 6]
    assert [r.n for r in locations.resolve_exact(asked, found).orderBy("n").collect()] == [1, 5]


@pytest.mark.parametrize("max_rows", [100, 0])
def test_options(spark, max_rows):
    options = spark.createDataFrame([(0, " bay "), (1, "BAY"), (2, "Hill-Top"), (3, "Hill Top")], "ordinal bigint, option string")
    asked = spark.createDataFrame([(1, "BAY"), (2, "Bay"), (3, "hilltop"), (4, "Dock")], "n int, pos_name string")
    got = locations.option_cascade(asked, options, max_rows=max_rows)
    assert rows(got.select("n", "option", "matched_by"), "n") == [
        (1, "BAY", "exact"), (2, "bay", "case"), (3, "Hill-Top", "normalised"), (4, None, None),
    ]
    assert [r.n for r in locations.option_unmatched(asked, options).collect()] == [4]


# ---- KPI -------------------------------------------------------------------------------------


def payload(data) -> str:
    return json.dumps({"data": [{"tables": [{"content": [{"content": [{"content": [{"data": data}]}]}]}]}]})


ENTRY = {
    "total": {"turnover": 1234.5, "products": 10, "employees": 3, "php_max": None},
    "average": {"turnover": 411.5},
    "categories": {
        "juice": {"turnover": 1000, "products": 8, "turnover_percentage": 81.0, "product_percentage": 80},
        "counter_product": {"turnover": 234.5, "products": 2},
        "other": {"turnover": 1},
    },
    "discount_group": {"loyalty": {"products": 1, "percentage": 10}},
    "employee_meal": {"products": 2, "percentage": 20.5},
}


@pytest.fixture(scope="module")
def kpi_world(spark):
    reports = spark.createDataFrame(
        [(1, "2026-04-15", payload(ENTRY)), (2, "2026-04-15", payload({})), (3, "2026-04-15", '{"data": []}'),
         (4, "2026-04-15", "no json"), (1, "2026-04-16", payload({"total": {"turnover": 1}}))],
        "workplace_id bigint, report_date string, payload string",
    ).withColumn("report_date", F.col("report_date").cast("date"))
    codes = mapping.codes_from_config(
        spark, {"C1": ("Label 1", "Bay [1]"), "C2": ("Label 2", "Hill"), "C3": ("Label 3", "Dock"), "C4": ("Label 4", "bay1")}
    )
    places = spark.createDataFrame([("bay 1", 1, 0), ("Hill", 2, 1)], "name string, id bigint, first_seq bigint")
    return reports, codes, places


def test_kpi_wide_row(kpi_world):
    reports, codes, places = kpi_world
    out = kpi_report.kpi_report(reports, codes, places)
    assert len(out.columns) == 60
    found = {(r.Code, r.Date): r.asDict() for r in out.collect()}
    assert sorted(found) == [("C1", "2026-04-15"), ("C1", "2026-04-16"), ("C4", "2026-04-15"), ("C4", "2026-04-16")]
    row = found["C1", "2026-04-15"]
    assert (row["Location"], row["POS Name"]) == ("Label 1", "Bay [1]")
    want = {
        "Turnover": 1234.5, "Products": 10.0, "Employees": 3.0, "PHP Max": 0.0, "Avg Turnover": 411.5, "Avg Products": 0.0,
        "Juice Turnover": 1000.0, "Juice Prod %": 80.0, "Counter Product Products": 2.0, "Counter Product TO %": 0.0,
        "Loyalty Card Turnover": 0.0, "Disc Loyalty Products": 1.0, "Disc Loyalty %": 10.0, "Disc Emp Meal %": 0.0,
        "Emp Meal Products": 2.0, "Emp Meal %": 20.5,
    }
    assert {k: row[k] for k in want} == want


def test_kpi_long_pivots_to_wide(kpi_world):
    reports, _, _ = kpi_world
    extracted = kpi.kpi_extract(reports)
    long = kpi.kpi_long(extracted, ["workplace_id", "report_date"])
    assert rows(long.select("category", "category_label", "turnover"), "category") == [
        ("counter_product", "Counter Product", 234.5), ("juice", "Juice", 1000.0), ("other", "Other", 1.0),
    ]
    wide = long.groupBy("workplace_id").pivot("category", kpi.CATEGORIES).agg(F.first("products"))
    assert wide.select("juice", "counter_product", "misc").first() == (8.0, 2.0, None)
    assert [r.workplace_id for r in kpi.kpi_empty(extracted).orderBy("workplace_id").collect()] == [2, 3, 4]


@pytest.mark.parametrize("max_rows", [100, 0])
def test_kpi_status(spark, kpi_world, max_rows):
    reports, codes, places = kpi_world
    asked = spark.createDataFrame([(1, "C1"), (2, "C2"), (3, "C3"), (4, "X"), (5, "C4")], "n int, code string")
    asked = asked.withColumn("report_date", F.lit("2026-04-15").cast("date"))
    got = kpi_report.kpi_status(asked, codes, places, reports, max_rows)
    assert rows(got.select("n", "ok", "reason"), "n") == [
        (1, True, ""), (2, False, "empty report"), (3, False, "workplace not found"), (4, False, "unknown code"), (5, True, ""),
    ]
    assert tuple(status.ok_counts(got).first()) == (2, 3, 5)
    labelled = locations.result_labels(got.withColumnRenamed("n", "ordinal"), codes)
    assert [r.line for r in status.kpi_digest_lines(labelled).collect()][3] == "❌  X         X"
    assert [r.code for r in locations.unknown_codes(asked, codes).collect()] == ["X"]
    assert [r.code for r in locations.pick_codes(asked, codes).orderBy("ordinal").collect()] == ["C1", "C2", "C3", "C4"]


# ---- status, digest, audit -------------------------------------------------------------------

RESULTS = (
    "ordinal bigint, pos_name string, label string, ok boolean, no_data boolean, stage int, error string, row_count bigint, "
    "business_date string"
)


@pytest.fixture(scope="module")
def results(spark):
    return spark.createDataFrame(
        [(2, "p2", "Bay", True, False, 4, "", 12345, "15-Apr-2026"), (0, "p0", "alpha", False, True, 2, "nothing", 0, ""),
         (1, "p1", "Zoo", False, False, 3, "x" * 60, 0, ""), (3, "p3", "Bay", True, False, 4, "", 7, "14-Apr-2026")],
        RESULTS,
    )


def test_status(results):
    assert tuple(status.status_counts(results).first()) == (2, 1, 1, 4, True)
    assert tuple(status.status_counts(results.where("not ok")).first()) == (0, 1, 1, 2, False)
    assert tuple(status.status_counts(results.where("false")).first()) == (0, 0, 0, 0, False)
    assert status.report_date(results).first()[0] == "15-Apr-2026"
    assert status.report_date(results.where("not ok")).first()[0] == ""
    assert rows(status.failed_list(results), "stage") == [(3, "p1", "x" * 60)]


def test_digest(results):
    lines = [r.line for r in status.digest_lines(results).collect()]
    assert lines == [
        f"{'Bay':<45}  ✅  12,345 rows", f"{'Bay':<45}  ✅  7 rows", f"{'Zoo':<45}  ❌  {'x' * 40}", f"{'alpha':<45}  –  no data",
    ]
    head = [r.line for r in status.digest_head(results, "r1").orderBy("position").collect()]
    assert head[0] == "Daily Run Summary — 15-Apr-2026" and head[1] == "Run ID: r1"
    assert head[3:7] == ["  ✅  Succeeded : 2", "  –   No data   : 1", "  ❌  Failed    : 1", "  Total         : 4"]
    assert head[9] == f"{'Location':<45} {'Rows':>6}  Status"


def test_audit_json(spark):
    facts = spark.createDataFrame([("a.csv", 3, None), ("b.csv", 0, "bad")], "file string, rows bigint, error string")
    records = status.audit_records(
        facts, "r1", "transform", "export", F.lit("2026-04-15 10:23:00.123456").cast("timestamp"),
        F.when(F.col("error").isNull(), "ok").otherwise("error"), ["file", "rows", "error"],
    )
    lines = [json.loads(r.value) for r in status.audit_json(records).orderBy("value").collect()]
    assert lines[1] == {
        "ts": "2026-04-15T10:23:00.123456", "run_id": "r1", "stage": "transform", "step": "export", "outcome": "ok",
        "duration_ms": 0, "file": "a.csv", "rows": 3,
    }
    assert lines[0]["error"] == "bad"


# ---- landing, sets, spec ---------------------------------------------------------------------


def test_landing(spark, tmp_path):
    for name, body in {"20260416T102300_a1b2c3d4_Bay_raw.csv": "x", "20260417T102300_a1b2c3d4_Bay_raw.csv": "xy", "empty_raw.csv": "", "other.csv": "z"}.items():
        (tmp_path / name).write_text(body)
    files = landing.landed_files(spark, str(tmp_path))
    assert rows(files.where("length > 0").select("file_name", "length"), "file_name") == [
        ("20260416T102300_a1b2c3d4_Bay_raw.csv", 1), ("20260417T102300_a1b2c3d4_Bay_raw.csv", 2),
    ]
    named = spark.createDataFrame(
        [("a", "f1", "2026-01-01"), ("a", "f2", "2026-01-02"), ("a", "f3", "2026-01-02"), ("b", "f4", "2025-01-01")],
        "location_tag string, file_name string, modified_at string",
    )
    assert rows(landing.latest_files(named, ["location_tag"]).select("file_name"), "file_name") == [("f3",), ("f4",)]
    wanted = spark.createDataFrame([("empty_raw.csv",), ("gone_raw.csv",), ("20260416T102300_a1b2c3d4_Bay_raw.csv",)], "file_name string")
    assert rows(landing.missing_or_empty(wanted, files), "file_name") == [("empty_raw.csv",), ("gone_raw.csv",)]


def test_spec_is_whole(spark):
    spec = spec_table(spark, ITEM_SALES)
    targets = spec.where("target is not null").select(F.col("target").alias("name"))
    order = spark.createDataFrame([(n,) for n in ITEM_SALES.order], "name string")
    assert sets.both_differences(order, targets, "order", "targets").count() == 0
    less = order.where("name <> 'Order ID'").unionAll(spark.createDataFrame([("New",)], "name string"))
    assert rows(sets.both_differences(less, targets, "order", "targets"), "name") == [("New", "order"), ("Order ID", "targets")]
    present = spark.createDataFrame([("columns",), ("portal",)], "key string")
    required = spark.createDataFrame([("columns",), ("locations",)], "key string")
    assert rows(sets.missing_required(required, present), "key") == [("locations",)]


def test_spec_from_config():
    config = {
        "columns": [
            {"raw": "Menu Item #", "target": "Id", "dtype": "int"}, {"raw": None, "target": "Day", "dtype": "date", "inject": "business_dates_metadata"},
            {"raw": "Returns", "target": None, "drop": True},
        ],
        "output_column_order": ["Day", "Id"],
        "output_date_format": "%Y-%m-%d",
    }
    spec = spec_from_config(config)
    assert (spec.targets, spec.known, spec.order) == (["Id", "Day"], ["Menu Item #", "Returns"], ["Day", "Id"])
    assert spec.output_date_format == "%Y-%m-%d" and spec.raw_date_format == "%d/%m/%Y"


# ---- malformed payloads and lost pages -------------------------------------------------------


def nested(data):
    return f'{{"data":[{{"tables":[{{"content":[{{"content":[{{"content":[{{"data":{data}}}]}}]}}]}}]}}]}}'


def test_malformed_payloads_are_told_from_empty_ones(spark):
    whole = nested('{"total":{"turnover":5}}')
    payloads_by_kind = {
        "ok": [whole, f" {whole}\n"], "no_data": [nested("{}"), nested("null"), '{"data":[]}', "{}", "[]", "null"],
        "failed": [whole[:-1], whole[: len(whole) // 2], "", "not json", None],
    }
    rows_in = [(f"{kind}{i}", p) for kind, given in payloads_by_kind.items() for i, p in enumerate(given)]
    df = spark.createDataFrame(rows_in, "id string, payload string")
    got = {r.id: r.outcome for r in kpi.kpi_outcomes(df).collect()}
    assert got == {name: name.rstrip("0123456789") for name, _ in rows_in}
    reasons = {r.id: r.reason for r in kpi.kpi_rejects(df).collect()}
    assert len(reasons) == 11 and reasons["failed0"] == "malformed payload" and reasons["no_data0"] == "empty report"


def page(number, entries):
    return number, json.dumps({"data": [{"name": f"n{number}-{i}", "id": i} for i in range(entries)]})


@pytest.mark.parametrize(("given", "found"), [
    ([], []),
    ([(0, 1)], []),
    ([(0, 2), (1, 2), (2, 1)], []),
    ([(2, 2), (3, 1)], [("missing", 0, 1)]),
    ([(0, 2), (2, 2), (2, 2), (3, 0), (9, 2)], [("double", 2, 2), ("missing", 1, 1), ("missing", 4, 8), ("short", 3, 3)]),
    ([(5, 1), (5, 1), (7, 2)], [("double", 5, 5), ("missing", 0, 4), ("missing", 6, 6), ("short", 5, 5)]),
])
def test_page_gaps(spark, given, found):
    pages = spark.createDataFrame([page(*p) for p in given], "page bigint, payload string")
    gaps = payloads.page_gaps(pages, 2)
    assert sorted(map(tuple, gaps.collect())) == found
    assert payloads.pages_complete(pages, 2).first().complete in ((True,) if given and not found else (False, None))
