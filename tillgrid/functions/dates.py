"""Date text from one notation to another."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Strftime codes and the date pattern letters Spark reads and writes for them.
_READ = {"%d": "d", "%m": "M", "%Y": "yyyy", "%y": "yy", "%b": "MMM", "%B": "MMMM"}
_WRITE = {"%d": "dd", "%m": "MM", "%Y": "yyyy", "%y": "yy", "%b": "MMM", "%B": "MMMM"}


def _pattern(strftime: str, letters: dict[str, str]) -> str:
    for code, letter in letters.items():
        strftime = strftime.replace(code, letter)
    if "%" in strftime:
        raise ValueError(f"date format not supported: {strftime}")
    return strftime


def parse_date(text: Column, raw_format: str = "%d/%m/%Y") -> Column:
    return F.try_to_date(text, _pattern(raw_format, _READ))


def reformat_date(text: Column, raw_format: str = "%d/%m/%Y", out_format: str = "%d-%b-%Y") -> Column:
    """The date in the output notation; text that is no date stays as it is."""
    parsed = parse_date(text, raw_format)
    return F.coalesce(F.date_format(parsed, _pattern(out_format, _WRITE)), text)


def day_before(run_date: Column) -> Column:
    return F.date_sub(run_date, 1)


UNDATED = "undated"


def before_run(day: Column, start: Column, run_date: Column) -> Column:
    """Whole days from ``start`` up to the one before the run; times of that last day count."""
    return (day >= start) & (day < run_date)


def business_day_key(text: Column, raw_format: str = "%d/%m/%Y") -> Column:
    """Partition value of a report: ISO date, else the raw text, else ``undated``."""
    iso = F.date_format(parse_date(text, raw_format), "yyyy-MM-dd")
    return F.coalesce(iso, F.nullif(text, F.lit("")), F.lit(UNDATED))
