"""Sinks and incremental ingest: idempotent, newest file wins, unknown locations kept apart."""

from __future__ import annotations

import os
from pathlib import Path

import pytest
from fixtures import EXPECTED, HEADER, ITEMS, report, write_csv, write_xlsx
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tillgrid.operators.spec import ITEM_SALES
from tillgrid.plans import item_sales as plan
from tillgrid.plans import status_report
from tillgrid.session import LISTING_TASKS
from tillgrid.operators import status
from tillgrid.sinks import store
from tillgrid.sinks.tables import append_audit, write_digest, write_kpi, write_report, write_status, write_upload_csv
from tillgrid.sources import csv_grid
from tillgrid.sources.landing import landed_files
from tillgrid.sources.mapping import locations_from_config
from tillgrid.streaming import incremental

RUN = "20260416T102300_a1b2c3d4"
NEXT = "20260417T080000_0badcafe"


@pytest.fixture
def dim(spark):
    return locations_from_config(spark, [{"pos_name": "Bay / North", "l": "Bay-N"}, {"pos_name": "Hill", "l": "Hill 1"}], "l")


@pytest.fixture
def run(spark, dim, tmp_path):
    landing, place = tmp_path / "landing", str(tmp_path / "store")
    landing.mkdir()

    def ingest(**options):
        incremental.ingest(spark, str(landing), dim, place, str(tmp_path / "checkpoint"), **options).awaitTermination()
        return store.read_report(spark, place)

    ingest.landing, ingest.store = landing, place
    return ingest


def land(run, name, rows, mtime, write=write_csv):
    path = write(run.landing / name, rows)
    os.utime(path, (mtime, mtime))


def counted(table):
    return sorted(
        (r.business_day, r.location_key, r.n) for r in
        table.groupBy(F.col("business_day").cast("string").alias("business_day"), "location_key").agg(F.count("*").alias("n")).collect()
    )


def test_ingest_and_resend(spark, run):
    land(run, f"{RUN}_Bay_North_raw.csv", report(), 1000)
    land(run, f"{RUN}_Hill_raw.csv", report("not a date"), 1000)
    land(run, f"{RUN}_Moon_raw.csv", report(), 1000)
    table = run()
    assert counted(table) == [("2026-04-15", "Bay-N", 3), ("not a date", "Hill_1", 3)]
    got = table.where("label = 'Bay-N'").orderBy("row_idx").select(*[f"`{c}`" for c in ITEM_SALES.order]).collect()
    assert [tuple(r) for r in got] == EXPECTED
    unknown = store.read_unmatched(spark, run.store)
    assert unknown.count() == 3 and unknown.where("label is not null").count() == 0

    assert counted(run()) == [("2026-04-15", "Bay-N", 3), ("not a date", "Hill_1", 3)]  # nothing new

    land(run, f"{NEXT}_Bay_North_raw.csv", report(items=ITEMS[:2]), 2000)
    land(run, f"{NEXT}_Hill_raw.csv", report("16/04/2026"), 2000)
    assert counted(run()) == [("2026-04-15", "Bay-N", 2), ("2026-04-16", "Hill_1", 3), ("not a date", "Hill_1", 3)]


def test_older_file_that_lands_late_does_not_win(spark, run):
    land(run, f"{NEXT}_Bay_North_raw.csv", report(items=ITEMS[:1]), 5000)
    assert counted(run()) == [("2026-04-15", "Bay-N", 1)]
    land(run, f"{RUN}_Bay_North_raw.csv", report(), 4000)
    land(run, f"{RUN}_Hill_raw.csv", report(), 4000)
    assert counted(run()) == [("2026-04-15", "Bay-N", 1), ("2026-04-15", "Hill_1", 3)]
    outcomes = {(r.modified_at.timestamp(), r.label, r.outcome) for r in store.read_decisions(spark, run.store).collect()}
    assert outcomes == {(5000, "Bay-N", "accepted"), (4000, "Bay-N", "older"), (4000, "Hill 1", "accepted")}


def test_two_files_of_one_day_in_one_batch(run):
    land(run, f"{RUN}_Bay_North_raw.csv", report(), 1000)
    land(run, f"{NEXT}_Bay_North_raw.csv", report(items=ITEMS[:1]), 2000)
    assert counted(run()) == [("2026-04-15", "Bay-N", 1)]


def test_all_kinds_and_sizes_in_one_stream(spark, run, monkeypatch):
    monkeypatch.setattr(csv_grid, "WHOLE_FILE_BYTES", 1500)
    land(run, f"{RUN}_Bay_North_raw.XLSX", report(), 1000, write_xlsx)
    land(run, f"{RUN}_Hill_raw.CSV", report(items=ITEMS * 20), 1000)
    land(run, f"{NEXT}_Hill_raw.csv", report("16/04/2026", items=[*ITEMS, ["Long", 5, 1, 1, 1, 0, 1, 1, 1, 1, 1, 1, "too", "many"]]), 1000)
    (run.landing / f"{NEXT}_Bay_North_raw.xlsx").write_bytes(b"no workbook")
    os.utime(run.landing / f"{NEXT}_Bay_North_raw.xlsx", (1000, 1000))
    land(run, f"{RUN}_Moon_raw.csv", report(header=["Menu Item Name", "Other"]), 1000)
    assert counted(run()) == [("2026-04-15", "Bay-N", 3), ("2026-04-15", "Hill_1", 60), ("2026-04-16", "Hill_1", 3)]
    assert [r.cells[0] for r in store.read_rejects(spark, run.store).collect()] == ["Long"]
    bad = {r.file_name: r.error for r in store.read_failed(spark, run.store).collect()}
    assert sorted(bad) == [f"{RUN}_Moon_raw.csv", f"{NEXT}_Bay_North_raw.xlsx"]
    assert bad[f"{RUN}_Moon_raw.csv"] == "missing column: Menu Item #"
    land(run, f"{RUN}_Bay_North_raw.csv", report("17/04/2026"), 3000)  # the next batch goes on
    assert ("2026-04-17", "Bay-N", 3) in counted(run())


@pytest.mark.parametrize("broken", ["write_files", "write_audit", "write_decisions"])
def test_a_batch_that_fails_between_two_writes(spark, run, monkeypatch, broken):
    """Nothing of it is seen; started again, nothing is there twice and nothing is missing."""
    land(run, f"{RUN}_Bay_North_raw.csv", report(), 1000)
    assert counted(run()) == [("2026-04-15", "Bay-N", 3)]
    long = ["Long", 5, 1, 1, 1, 0, 1, 1, 1, 1, 1, 1, "too", "many"]
    land(run, f"{NEXT}_Bay_North_raw.csv", report(items=[*ITEMS[:2], long]), 2000)
    land(run, f"{NEXT}_Moon_raw.csv", report(), 2000)

    def fail(*_):
        raise OSError("disk full")

    def seen():
        return [
            counted(store.read_report(spark, run.store)), store.read_unmatched(spark, run.store).count(),
            store.read_rejects(spark, run.store).count(), store.read_decisions(spark, run.store).count(),
        ]

    with monkeypatch.context() as patch:
        patch.setattr(store, broken, fail)
        with pytest.raises(StreamingQueryException):
            run()
    assert seen() == [[("2026-04-15", "Bay-N", 3)], 0, 0, 1]
    run()
    assert seen() == [[("2026-04-15", "Bay-N", 2)], 3, 1, 3]
    log = store.read_audit(spark, run.store, incremental.AUDIT).orderBy("run_id").collect()
    assert [(r.files, r.rows, r.rejects, r.failed, r.outcome) for r in log] == [(1, 3, 0, 0, "ok"), (2, 5, 1, 0, "ok")]
    assert log[1].bytes == sum(p.stat().st_size for p in run.landing.glob(f"{NEXT}*"))


def test_nothing_landed(spark, run, dim, tmp_path):
    incremental.ingest(spark, str(run.landing), dim, run.store, str(tmp_path / "checkpoint")).awaitTermination()
    assert store.read_decisions(spark, run.store).count() == 0


def stored_files(run, batch="*"):
    return list(Path(run.store).glob(f"rows/batch={batch}/kind=item/*.parquet"))


def test_compaction_beside_an_ingest(spark, run, monkeypatch):
    for day in range(1, 7):
        for name in ("Bay_North", "Hill"):
            land(run, f"{RUN[:-1]}{day}_{name}_raw.csv", report(f"{day:02d}/04/2026"), 1000 + day)
        run()
    before = counted(store.read_report(spark, run.store))
    assert len(before) == 12 and len(stored_files(run)) >= 6
    assert store.compact(spark, run.store, "2026-04-06") == 1
    assert counted(store.read_report(spark, run.store)) == before and len(stored_files(run, "-*")) == 1
    used = {r.file_batch for r in store.current(spark, run.store).where("business_day < '2026-04-06'").collect()}
    assert len(used) == 1 and used.pop() < 0

    land(run, f"{NEXT}_Hill_raw.csv", report("02/04/2026", items=ITEMS[:1]), 5000)  # sent again after it was packed
    run()
    want = [(d, k, 1 if (d, k) == ("2026-04-02", "Hill_1") else n) for d, k, n in before]
    assert counted(store.read_report(spark, run.store)) == want

    write = store.write_decisions

    def meanwhile(*args):
        """A report of a day that is being packed comes in before the compaction is seen."""
        monkeypatch.setattr(store, "write_decisions", write)
        land(run, f"{NEXT}_Bay_North_raw.csv", report("03/04/2026", items=ITEMS[:2]), 6000)
        run()
        write(*args)

    monkeypatch.setattr(store, "write_decisions", meanwhile)
    store.compact(spark, run.store, "2026-04-06")
    want = [(d, k, 2 if (d, k) == ("2026-04-03", "Bay-N") else n) for d, k, n in want]
    assert counted(store.read_report(spark, run.store)) == want


def test_a_compaction_that_fails_leaves_nothing_seen(spark, run, monkeypatch):
    land(run, f"{RUN}_Bay_North_raw.csv", report(), 1000)
    run()

    def fail(*_):
        raise OSError("disk full")

    with monkeypatch.context() as patch:
        patch.setattr(store, "write_decisions", fail)
        with pytest.raises(OSError):
            store.compact(spark, run.store, "2027")
    assert counted(store.read_report(spark, run.store)) == [("2026-04-15", "Bay-N", 3)]


def test_headers_that_appear_later(spark, run):
    land(run, f"{RUN}_Bay_North_raw.csv", report(header=[*HEADER, "Cashier"], items=[[*i, "Kim"] for i in ITEMS]), 1000)
    run()
    land(run, f"{RUN}_Hill_raw.csv", report("16/04/2026", header=[*HEADER, "Till", "CASHIER", "Order ID"], items=[[*i, "7", "Bo", "x"] for i in ITEMS]), 1000)
    wide = store.extras_as_columns(run())
    found = {(r.label, r["CASHIER"], r["Till"], r["Order ID"]) for r in wide.collect()}
    assert found == {("Bay-N", "Kim", None, ""), ("Hill 1", "Bo", "7", "")}
    assert {r.extras["Order ID"] for r in wide.where("label = 'Hill 1'").collect()} == {"x"}  # a name of the report's own stays in the map


def test_undated_reports_do_not_replace_each_other(run):
    land(run, f"{RUN}_Bay_North_raw.csv", report(""), 1000)
    land(run, f"{NEXT}_Bay_North_raw.csv", report("", items=ITEMS[:1]), 2000)
    assert sorted(n for _, _, n in counted(run())) == [1, 3]


def test_extras_are_kept(spark, run):
    land(run, f"{RUN}_Bay_North_raw.csv", report(header=[*HEADER, "Cashier"], items=[[*i, "Kim"] for i in ITEMS]), 1000)
    assert {r.extras["Cashier"] for r in run().collect()} == {"Kim"}


def test_a_tag_of_two_names_is_attributed_to_none(spark, run, tmp_path):
    dim = locations_from_config(spark, [{"pos_name": "Bay / North", "l": "A"}, {"pos_name": "Bay North", "l": "B"}, {"pos_name": "Hill", "l": "C"}], "l")
    write_csv(tmp_path / f"{RUN}_Bay_North_raw.csv", report())
    rows = plan.item_sales(plan.read_report_rows(spark, str(tmp_path)), keep=("file_id", "file_name"))
    assert {r.label for r in plan.with_location(rows, dim).collect()} == {None}


def test_batch_run_keeps_the_newest_file(spark, dim, tmp_path):
    for name, items, at in ((RUN, ITEMS, 1000), (NEXT, ITEMS[:2], 2000)):
        os.utime(write_csv(tmp_path / f"{name}_Bay_North_raw.csv", report(items=items)), (at, at))
    write_csv(tmp_path / f"{RUN}_Moon_raw.csv", report())
    table, unmatched = plan.sales_of_run(spark, str(tmp_path), dim)
    assert table.count() == 2 and unmatched.count() == 3


def test_status_of_a_run(spark, tmp_path):
    names = ["Bay / North", "Hill", "Moon", "Void", "Twin/A", "Twin A", "Bad", "Gone", "Quiet"]
    dim = locations_from_config(spark, [{"pos_name": n, "l": f"L {n}"} for n in names], "l")
    for name, rows in (("Bay_North", report()), ("Hill", report("16/04/2026", items=ITEMS[:1])), ("Moon", report(header=["Menu Item Name", "x"])), ("Twin_A", report())):
        write_csv(tmp_path / f"{RUN}_{name}_raw.csv", rows)
    (tmp_path / f"{RUN}_Void_raw.csv").write_bytes(b"")
    (tmp_path / f"{RUN}_Bad_raw.xlsx").write_bytes(b"zip?")
    path = str(tmp_path)
    files = landed_files(spark, path, None)
    items = plan.item_sales(plan.read_report_rows(spark, path), keep=("file_id", "business_date"))
    quiet = spark.createDataFrame([("Quiet", "no data for this day")], "pos_name string, error string")
    got = plan.sales_status(dim, files, plan.failed_files(spark, path), items, quiet).orderBy("ordinal").collect()
    assert [(r.pos_name, r.ok, r.no_data, r.stage, r.row_count, r.business_date) for r in got] == [
        ("Bay / North", True, False, 4, 3, "15/04/2026"), ("Hill", True, False, 4, 1, "16/04/2026"), ("Moon", False, False, 3, 0, ""),
        ("Void", False, False, 2, 0, ""), ("Twin/A", False, False, 3, 0, ""), ("Twin A", False, False, 3, 0, ""), ("Bad", False, False, 3, 0, ""),
        ("Gone", False, False, 2, 0, ""), ("Quiet", False, True, 2, 0, ""),
    ]
    errors = {r.pos_name: r.error for r in got}
    assert errors["Moon"] == "missing column: Menu Item #" and errors["Void"] == errors["Gone"] == "no file with content landed"
    assert errors["Bad"].startswith("unreadable workbook") and errors["Twin A"] == "ambiguous location name"
    results = spark.createDataFrame(got)
    counts = status.status_counts(results).first()
    assert (counts.succeeded, counts.no_data, counts.failed, counts.total, counts.success) == (2, 1, 6, 9, True)
    write_status(results, RUN, str(tmp_path / "status"))
    assert spark.read.parquet(str(tmp_path / "status")).count() == 9
    write_digest(status.digest_head(results, RUN), status.digest_lines(results), str(tmp_path / "digest"))
    lines = [r.value for r in spark.read.text(str(tmp_path / "digest")).collect()]
    assert lines[1] == f"Run ID: {RUN}" and len(lines) == 11 + 9 and lines[11].startswith("L Bad ")


def sold(spark, dim, tmp_path):
    write_csv(tmp_path / f"{RUN}_Bay_North_raw.csv", report())
    rows = plan.read_report_rows(spark, str(tmp_path))
    items = plan.item_sales(rows, keep=("file_id", "file_name", "row_idx", "business_date"))
    return plan.for_sink(plan.with_location(items, dim))


def test_report_sinks(spark, dim, tmp_path):
    sales = sold(spark, dim, tmp_path)
    table, upload = str(tmp_path / "table"), str(tmp_path / "upload")
    for _ in range(2):
        write_report(sales, table)
        write_upload_csv(sales, ITEM_SALES.order, upload)
    assert counted(spark.read.parquet(table)) == [("2026-04-15", "Bay-N", 3)]
    back = spark.read.option("header", True).option("inferSchema", True).csv(f"{upload}/business_day=2026-04-15/location_key=Bay-N")
    assert back.columns == ITEM_SALES.order
    assert sorted(r["POS Item ID *"] for r in back.collect()) == [10000003, 10000011, 10000016]
    assert sales.first().sales_date.isoformat() == "2026-04-15"


def test_kpi_and_audit_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("2026-04-15", "C1", 1.0), ("2026-04-15", "C2", 2.0), ("2026-04-16", "C1", 3.0)], "Date string, Code string, Turnover double")
    path = str(tmp_path / "kpi")
    write_kpi(rows, path)
    write_kpi(rows.where("Date = '2026-04-16'"), path)
    write_kpi(rows.where("Code = 'C1'"), path)
    assert spark.read.parquet(path).count() == 3
    log = str(tmp_path / "audit")
    for _ in range(2):
        append_audit(spark.createDataFrame([("r1", "ok")], "run_id string, outcome string"), log)
    assert spark.read.json(log).count() == 2


def test_files_of_any_age_are_taken_up(spark, tmp_path):
    """One dated 1970 lands after a new one was done."""
    import os

    from tillgrid.streaming.incremental import landing_stream

    (tmp_path / "in").mkdir()
    seen = []
    for name in ("new.csv", "old.csv"):
        (tmp_path / "in" / name).write_text("x")
        if name == "old.csv":
            os.utime(tmp_path / "in" / name, (86400, 86400))
        stream = landing_stream(spark, str(tmp_path / "in")).writeStream.option("checkpointLocation", str(tmp_path / "done")).trigger(availableNow=True)
        stream.foreachBatch(lambda batch, _: seen.extend(r.path.rsplit("/", 1)[-1] for r in batch.collect())).start().awaitTermination()
    assert seen == ["new.csv", "old.csv"]


def test_slices_of_the_table_read_their_folders_only(spark, tmp_path):
    path = str(tmp_path / "table")
    days = F.date_format(F.date_add(F.lit("2026-04-01").cast("date"), (F.col("id") % 20).cast("int")), "yyyy-MM-dd")
    rows = spark.range(2000).select("id", days.alias("business_day"), F.concat(F.lit("L_"), F.col("id") % 7).alias("location_key"))
    write_report(rows, path)
    places = locations_from_config(spark, [{"pos_name": "a", "l": "L 3"}, {"pos_name": "b", "l": "L 5"}, {"pos_name": "c", "l": "other"}], "l")
    table = spark.read.schema("id bigint, business_day string, location_key string").parquet(path)
    dates = [F.lit(d).cast("date") for d in ("2026-04-05", "2026-04-08")]
    got = plan.reports_of(table, places.where("pos_name <> 'c'"), *dates)
    assert {(r.business_day, r.location_key) for r in got.collect()} == {(f"2026-04-0{d}", f"L_{k}") for d in (5, 6, 7) for k in (3, 5)}
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in text and "business_day" in text.split("PartitionFilters: [")[1].split("]")[0]


def test_replay_of_a_run(spark, dim, tmp_path):
    for name, at in ((f"{RUN}_Bay_North", 1000), (f"{RUN}_Hill", 1500), (f"{NEXT}_Hill", 2000)):
        os.utime(write_csv(tmp_path / f"{name}_raw.csv", report(items=ITEMS[: 1 + at // 1000])), (at, at))
    (tmp_path / "notes.txt").write_text("x")
    newest = plan.files_of_run(spark, str(tmp_path))
    assert [p.rsplit("/", 1)[1] for p, _ in newest] == [f"{NEXT}_Hill_raw.csv"]
    run_files = plan.files_of_run(spark, str(tmp_path), RUN)
    assert len(run_files) == 2 and plan.files_of_run(spark, str(tmp_path), "20000101T000000_00000000") == []
    table, unmatched = plan.sales_of_run(spark, run_files, dim)
    assert counted(table) == [("2026-04-15", "Bay-N", 2), ("2026-04-15", "Hill_1", 2)] and unmatched.count() == 0


def test_outcome_of_a_store(spark, run, dim, tmp_path):
    land(run, f"{RUN}_Bay_North_raw.csv", report(), 1000)
    land(run, f"{RUN}_Hill_raw.csv", report(header=["Menu Item Name", "x"]), 1000)
    run()
    results = status_report.write_outcome(spark, run.store, dim, RUN, str(tmp_path / "out"))
    assert [(r.label, r.ok, r.row_count, r.error) for r in results.orderBy("ordinal").collect()] == [
        ("Bay-N", True, 3, ""), ("Hill 1", False, 0, "missing column: Menu Item #"),
    ]
    lines = [r.value for r in spark.read.text(str(tmp_path / "out" / "digest" / RUN)).collect()]
    assert lines[-1].startswith("Hill 1 ") and lines[-1].endswith("❌  missing column: Menu Item #")


def test_locations_are_worked_out_once_for_all_batches(spark, dim, tmp_path):
    landing, asked = tmp_path / "landing", spark.sparkContext.accumulator(0)
    landing.mkdir()
    for i, place in enumerate(["Hill", "Bay_North", "Nowhere"]):
        path = write_csv(landing / f"{RUN}_{place}_raw.csv", report())
        os.utime(path, (1000 + i, 1000 + i))

    def look(batches):
        asked.add(1)
        yield from batches

    looked_up = dim.coalesce(1).mapInArrow(look, dim.schema)
    place = str(tmp_path / "store")
    incremental.ingest(spark, str(landing), looked_up, place, str(tmp_path / "checkpoint"), max_files=1).awaitTermination()
    assert sorted(r.outcome for r in store.read_decisions(spark, place).collect()) == ["accepted", "accepted", "unmatched"]
    assert len(os.listdir(f"{place}/audit")) == 3
    assert asked.value == 1


def test_many_folders_are_listed_by_few_tasks(spark, tmp_path):
    for i in range(150):
        (tmp_path / f"file_id={i}").mkdir()
        (tmp_path / f"file_id={i}" / "report.txt").write_text(f"a,{i}")
    before, context = spark.conf.get(LISTING_TASKS), spark.sparkContext
    context.setJobGroup("listing", "folders of landed files")
    try:
        files = csv_grid.whole_files(spark, str(tmp_path), "*.txt")
        tracker = context.statusTracker()
        jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup("listing")]
        tasks = [tracker.getStageInfo(s).numTasks for j in jobs for s in j.stageIds]
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert tasks and max(tasks) <= 4 * context.defaultParallelism
    assert files.count() == 150 and spark.conf.get(LISTING_TASKS) == before


def test_tables_have_folders_by_day_and_replace_by_key(spark, tmp_path):
    """Folders do not grow with locations or codes; a rerun replaces its keys, also undated and missing ones, and leaves their neighbours."""
    day = F.when(F.col("id") % 5 == 0, F.concat(F.lit("undated_"), "id")).otherwise(F.lit("2026-04-15"))
    place = F.when(F.col("id") != 77, F.concat(F.lit("L_"), "id"))
    rows = spark.range(100).select("id", day.alias("business_day"), place.alias("location_key"), F.lit(1).alias("n"))
    table, kpi = str(tmp_path / "table"), str(tmp_path / "kpi")
    as_kpi = rows.select(F.col("business_day").alias("Date"), F.col("location_key").alias("Code"), "id", "n").where("id % 5 > 0")
    write_report(rows.where("id < 0"), table)
    write_report(rows, table)
    write_kpi(as_kpi, kpi)
    leaves = [d for d, below, _ in os.walk(table) if not below]
    assert len(leaves) <= 8 and len([d for d, below, _ in os.walk(kpi) if not below]) <= 4
    again = rows.where("id in (1, 5, 77)").withColumn("n", F.lit(2)).withColumn("more", F.lit("x"))
    write_report(again, table)
    write_kpi(as_kpi.where("id in (1, 77)").withColumn("n", F.lit(2)), kpi)
    back = spark.read.option("mergeSchema", True).parquet(table)
    assert sorted((r.id, r.n, r.more) for r in back.collect()) == [(i, 2, "x") if i in (1, 5, 77) else (i, 1, None) for i in range(100)]
    assert sorted((r.id, r.n) for r in spark.read.parquet(kpi).collect()) == [(i, 2 if i in (1, 77) else 1) for i in range(100) if i % 5]
    write_report(rows.selectExpr("id + 200 id", "if(id < 2, '007', '2026-4-5') business_day", "location_key", "n").where("id < 210"), table)
    write_report(spark.read.parquet(table).where("id = 201").withColumn("n", F.lit(4)), table)
    assert spark.read.parquet(table).where("n = 4").count() == 1 and spark.read.parquet(table).count() == 110
    write_report(spark.read.parquet(table).where("id = 2").withColumn("n", F.lit(3)), table)
    assert spark.read.parquet(table).where("n = 3").count() == 1 and spark.read.parquet(table).count() == 110
