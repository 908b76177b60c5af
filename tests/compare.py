"""Compare every registered query with its SQL: ``python tests/compare.py [sf_dir] [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as entry  # noqa: E402


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def rows_of(frame: pd.DataFrame) -> list[tuple]:
    """Rows with columns in name order, values as text, in a common order."""
    frame = frame[sorted(frame.columns)]
    rows = [tuple("∅" if pd.isna(v) else str(v) for v in row) for row in frame.astype(object).itertuples(index=False)]
    return sorted(rows)


def difference(spark, con, name: str, sf_dir: str) -> str:
    """'' if the Spark result equals the SQL result, else what differs."""
    got = entry.queries()[name](spark, sf_dir)
    want = con.sql(entry.oracle_sql()[name])
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} / {sorted(want.columns)}"
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}
    left_types = {c: kinds.get(k, k) for c, k in got.dtypes}
    right_types = dict(zip(want.columns, map(str, want.types)))
    if left_types != right_types:
        return f"types { {c: (left_types[c], right_types[c]) for c in left_types if left_types[c] != right_types[c]} }"
    left = got.collect()
    left = rows_of(pd.DataFrame([tuple(r) for r in left], columns=got.columns, dtype=object))
    right = rows_of(pd.DataFrame(want.fetchall(), columns=want.columns, dtype=object))
    if left == right:
        return ""
    only = (sorted(set(left) - set(right))[:2], sorted(set(right) - set(left))[:2])
    return f"rows {len(left)} / {len(right)}\n   spark {only[0]}\n   sql   {only[1]}"


if __name__ == "__main__":
    from tillgrid.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    session, connection = local_session(8), connect(folder)
    for key in sys.argv[2:] or entry.queries():
        begin = time.time()
        try:
            result = difference(session, connection, key, folder) if key in entry.oracle_sql() else "no SQL"
        except Exception as error:  # noqa: BLE001
            result = f"ERROR {str(error)[:600]}"
        print(f"{'ok  ' if not result else 'FAIL'} {key} {time.time() - begin:.2f}s {result}", flush=True)
