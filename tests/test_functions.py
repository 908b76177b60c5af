"""Scalar functions against plain Python / pandas on edge values."""

from __future__ import annotations

import re
from datetime import date

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tillgrid.functions import dates, naming, numbers, text

NAMES = [
    "Parade's  Mall", "STORE - 5", "Bay [North]", "a/b\\c*d?e:f\"g<h>i|j", "  __x__  ", "***", "", " \t", "Ünï – cøde",
    "non breaking", "PARK'S – END", "tab\tname",
]


def column(spark, values, fn, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.o for r in df.select("i", fn(F.col("v")).alias("o")).orderBy("i").collect()]


def test_name_functions(spark):
    def safe(name):
        out = re.sub(r'[\\/*?:"<>|]', "_", name)
        return re.sub(r"[\s_]+", "_", out).strip("_") or "unknown_location"

    assert column(spark, NAMES, text.sanitize) == [safe(n) for n in NAMES]
    assert column(spark, NAMES, text.norm_a) == [
        n.lower().replace("'", "").replace("-", "").replace(" ", "") for n in NAMES
    ]
    assert column(spark, NAMES, text.norm_b) == [re.sub(r"[\s\-'\[\]]", "", n).lower() for n in NAMES]
    assert column(spark, NAMES, text.strip) == [n.strip() for n in NAMES]


def test_skip_rule(spark):
    labels = ["N/A", " not in use ", "LOCATION CLOSED", "No Sales For Now", "Location name not mentioned in list", "", " ", None,
              "Bay", "n/a bay", "not mentioned"]
    assert column(spark, labels, text.is_skipped) == [True] * 8 + [False] * 3


def test_no_data_text(spark):
    texts = ["NO DATA here", "found 0 rows", "found 10 rows", "There is no data.", "no rows", "rows", None]
    assert column(spark, texts, text.is_no_data) == [True, True, False, True, True, False, False]
    assert column(spark, texts, lambda c: text.is_no_data(c, loose=True)) == [True, True, True, True, True, False, False]


def test_pad_and_clip(spark):
    values = ["abc", "x" * 50, "Ünï", ""]
    assert column(spark, values, lambda c: text.pad(text.clip(c, 45), 45)) == [f"{v[:45]:<45}" for v in values]
    assert column(spark, values, lambda c: text.pad(c, 8)) == [f"{v:<8}" for v in values]
    assert column(spark, ["loyalty_card", "misc"], text.title_label) == ["Loyalty Card", "Misc"]


NUMBERS = ["12", " 12 ", "12.9", "-12.9", "1e3", ".5", "5.", "", "abc", "1,234", "12d", "0x10", "1_0", "NaN", None, "-", "+7", "1 2"]


def test_int_cast_like_pandas(spark):
    # Texts such as "NaN" are numbers for pandas but missing values in a report.
    want = pd.to_numeric(pd.Series(NUMBERS, dtype=object), errors="coerce").fillna(0).astype(int).tolist()
    assert column(spark, NUMBERS, numbers.to_int) == want
    assert column(spark, ["9007199254740993", "-9223372036854775808", "1e999", "99999999999999999999"], numbers.to_int) == [
        9007199254740993, -9223372036854775808, 0, 0,
    ]
    assert column(spark, ["1e999", "7", None, "inf"], numbers.is_number) == [False, True, None, None]


MONEY = ["1,234.50", "AED 12.30", "(1,234.50)", "AED. 12", "1.234,50", "1e+16", "-5.678", "--5", "-", "", None, "abc", "nan", "5 %", "-0.5",
         "0.125", "0.375", "-1.#IND"]


def test_money_cast_like_pandas(spark):
    kept = pd.Series(["nan" if v is None or v == "-1.#IND" else v for v in MONEY], dtype=object)
    digits = kept.str.replace(r"[^\d.\-]", "", regex=True).replace("", "0")
    want = pd.to_numeric(digits, errors="coerce").fillna(0.0).round(2).tolist()
    assert column(spark, MONEY, numbers.to_money) == want
    assert want[2:6] == [1234.5, 0.12, 1.23, 116.0]


def test_dates(spark):
    values = ["15/04/2026", "5/4/2026", "01/09/2026", "31/02/2026", "2026-04-15", "nan", "", None]
    assert column(spark, values, dates.reformat_date) == [
        "15-Apr-2026", "05-Apr-2026", "01-Sep-2026", "31/02/2026", "2026-04-15", "nan", "", None,
    ]
    assert column(spark, values, dates.business_day_key) == [
        "2026-04-15", "2026-04-05", "2026-09-01", "31/02/2026", "2026-04-15", "nan", "undated", "undated",
    ]
    assert column(spark, [date(2026, 3, 1)], dates.day_before, "date") == [date(2026, 2, 28)]
    with pytest.raises(ValueError):
        dates.parse_date(F.lit(""), "%Q")


def test_file_names(spark):
    names = ["20260416T102300_a1b2c3d4_Bay_North_raw.XLSX", "20260416T102300_a1b2c3d4_raw.csv", "notes.txt", None]
    assert column(spark, names, naming.run_id_of) == ["20260416T102300_a1b2c3d4"] * 2 + [None, None]
    assert column(spark, names, naming.location_tag_of) == ["Bay_North", None, None, None]
    assert column(spark, names, naming.suffix_of) == ["xlsx", "csv", "txt", None]


def test_names_and_texts(spark):
    day = F.lit("2026-04-15").cast("date")
    row = spark.range(1).select(
        naming.output_name(F.lit("Bay / North"), day, F.lit("r1")).alias("a"),
        naming.output_name(F.lit(None).cast("string"), day, F.lit("r1")).alias("b"),
        naming.kpi_output_name(F.lit("C1"), day).alias("c"),
        naming.report_subject(F.lit("Bay"), F.lit("15-Apr-2026")).alias("d"),
        naming.report_subject(F.lit(""), F.lit("15-Apr-2026")).alias("e"),
        naming.summary_subject(F.lit("15-Apr-2026"), F.lit(3), F.lit(4)).alias("f"),
        naming.kpi_message(F.lit("L"), F.lit("P"), F.lit("D"), F.lit(1234.5), F.lit(7.0)).alias("g"),
        numbers.thousands(F.lit(1234567)).alias("h"),
    ).first()
    assert tuple(row) == (
        "Bay_North_2026-04-15", "sales_report_2026-04-15_r1", "C1_2026-04-15", "POS Sales Report — Bay — 15-Apr-2026",
        "POS Sales Report — 15-Apr-2026", "[Summary] Run — 15-Apr-2026 — 3/4 OK",
        "Daily POS report for L (P)\nDate: D\n\nTurnover: 1234.50 SAR\nProducts: 7\n", "1,234,567",
    )
