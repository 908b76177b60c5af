"""File names, output names and message subjects."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillgrid.functions.numbers import plain, thousands, two_places
from tillgrid.functions.text import sanitize

# Fixed value: {run_id}[_{location}]_raw.{suffix}
RAW_FILE = r"^(\d{8}T\d{6}_[0-9a-f]{8})_?(.*)_raw\.(\w+)$"


def run_id_of(file_name: Column) -> Column:
    return F.nullif(F.regexp_extract(file_name, RAW_FILE, 1), F.lit(""))


def location_tag_of(file_name: Column) -> Column:
    return F.nullif(F.regexp_extract(file_name, RAW_FILE, 2), F.lit(""))


def suffix_of(file_name: Column) -> Column:
    return F.lower(F.regexp_extract(file_name, r"\.(\w+)$", 1))


def output_name(label: Column, day: Column, run_id: Column) -> Column:
    """``{label}_{day}``, or ``sales_report_{day}_{run}`` where no label is known."""
    day_text = F.date_format(day, "yyyy-MM-dd")
    named = F.concat(sanitize(label), F.lit("_"), day_text)
    unnamed = F.concat(F.lit("sales_report_"), day_text, F.lit("_"), run_id)
    return F.when(F.nullif(label, F.lit("")).isNotNull(), named).otherwise(unnamed)


def kpi_output_name(code: Column, day: Column) -> Column:
    return F.concat(code, F.lit("_"), F.date_format(day, "yyyy-MM-dd"))


def report_subject(label: Column, day_text: Column, title: str = "POS Sales Report") -> Column:
    return F.concat_ws(" — ", F.lit(title), F.nullif(label, F.lit("")), day_text)


def summary_subject(day_text: Column, ok: Column, total: Column, title: str = "[Summary] Run") -> Column:
    share = F.concat(ok.cast("string"), F.lit("/"), total.cast("string"), F.lit(" OK"))
    return F.concat_ws(" — ", F.lit(title), day_text, share)


def kpi_message(label: Column, pos_name: Column, day_text: Column, turnover: Column, products: Column,
                currency: str = "SAR") -> Column:
    # The lines of the message.
    return F.concat(
        F.lit("Daily POS report for "), label, F.lit(" ("), pos_name, F.lit(")\nDate: "), day_text,
        F.lit("\n\nTurnover: "), two_places(turnover), F.lit(f" {currency}\nProducts: "), plain(products),
        F.lit("\n"),
    )


def sales_message(label: Column, day_text: Column, row_count: Column, file_name: Column, run_id: Column, sender: str = "report pipeline") -> Column:
    """Text that goes with an item-sales report; the shorter form where no label is known."""
    # The lines of the message.
    known = F.concat(
        F.lit("Please find attached the daily POS Sales Report for:\n\n  • Location : "), label, F.lit("\n  • Date     : "), day_text,
        F.lit("\n  • Rows     : "), thousands(row_count), F.lit("\n  • File     : "), file_name, F.lit("\n  • Run ID   : "), run_id,
    )
    unknown = F.concat(
        F.lit("Please find attached the daily POS Sales Report for "), day_text, F.lit(".\n\n  • Rows: "), thousands(row_count),
        F.lit("\n  • File: "), file_name, F.lit("\n  • Run ID: "), run_id,
    )
    body = F.when(F.nullif(label, F.lit("")).isNotNull(), known).otherwise(unknown)
    return F.concat(F.lit("Hi,\n\n"), body, F.lit(f"\n\nThis report was generated automatically by the {sender}.\n\nRegards,\n{sender}"))
