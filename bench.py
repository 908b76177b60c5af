"""Time the headline queries: one JSON line with seconds per query.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the local cores. The
inputs that stand for landed reports are derived and written first, apart from
the timing (``landing`` in the output); a query is then timed from building its
plan to its last row, best of ``BENCH_RUNS`` runs.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tillgrid.session import local_session  # noqa: E402
from tillgrid.testbed import tables  # noqa: E402
from tillgrid.testbed.queries import all_queries  # noqa: E402

HEADLINE = [
    "item_sales", "item_sales_text", "detect_header", "reorder_extras", "row_ordinal", "audit_rows", "sink_report",
    "cast_money", "cast_int", "date_reformat", "attach_label", "resolve_cascade", "option_cascade", "kpi_flatten",
    "kpi_long_labels", "kpi_status", "no_data_flag", "status_counts", "digest_lines", "latest_file", "src_csv_grid", "src_csv_split",
    "src_xlsx_grid", "ingest_incremental",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "tillgrid-bench")
    begin = time.perf_counter()
    for build in (tables.report_grid, tables.kpi_reports, tables.workplace_pages, tables.landed_names):
        tables.landed(spark, sf_dir, build)
    landing = time.perf_counter() - begin

    seconds: dict[str, float] = {}
    queries = all_queries()
    for name in HEADLINE:
        taken = []
        for _ in range(runs):
            begin = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - begin)
        seconds[name] = round(min(taken), 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "landing": round(landing, 3), "sf": Path(sf_dir).name,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
