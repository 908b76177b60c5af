"""Text expressions: trimming, file-safe names, match keys and fixed-width output."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels that take a location out of processing.
SKIP_LABELS = ["n/a", "not in use", "location closed", "no sales for now"]
SKIP_PREFIX = "location name not mentioned"

# Cell texts that the report reader takes as missing.
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Texts that tell that a report came back without rows.
NO_DATA_TEXTS = ["no data", "no rows", "there is no data"]
ZERO_ROWS = "0 rows"


def strip(text: Column) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def sanitize(name: Column) -> Column:
    """A name as a safe path component."""
    safe = F.regexp_replace(name, r'[\\/*?:"<>|]', "_")
    safe = F.btrim(F.regexp_replace(safe, r"(?U)[\s_]+", "_"), F.lit("_"))
    return F.coalesce(F.nullif(safe, F.lit("")), F.lit("unknown_location"))


def norm_a(name: Column) -> Column:
    """Match key for portal options: lower case without apostrophe, hyphen and blank."""
    return F.translate(F.lower(name), "'- ", "")


def norm_b(name: Column) -> Column:
    """Match key for workplaces: lower case without white space, hyphen, apostrophe, brackets."""
    return F.lower(F.regexp_replace(name, r"(?U)[\s\-'\[\]]", ""))


def is_skipped(label: Column) -> Column:
    key = F.lower(strip(F.coalesce(label, F.lit(""))))
    return (key == "") | key.isin(SKIP_LABELS) | key.startswith(SKIP_PREFIX)


def is_no_data(text: Column, loose: bool = False) -> Column:
    """True where a landed text says, in any letter case, that the report is empty.

    The default wants "0 rows" to be a number of its own; ``loose`` also takes
    "10 rows" as empty. Plain searches on the whole text come first, they are
    much faster than a pattern; only texts with zero rows meet the pattern.
    """
    lower = F.lower(text)
    zero = lower.contains(ZERO_ROWS)
    if not loose:
        zero = zero & lower.rlike(rf"\b{ZERO_ROWS}")
    for phrase in NO_DATA_TEXTS:
        zero = lower.contains(phrase) | zero
    return F.coalesce(zero, F.lit(False))


def clip(text: Column, size: int) -> Column:
    return F.substring(text, 1, size)


def pad(text: Column, size: int) -> Column:
    """Left-justify to a width; longer texts stay whole."""
    return F.when(F.length(text) >= size, text).otherwise(F.rpad(text, size, " "))


def title_label(key: Column) -> Column:
    return F.initcap(F.replace(key, F.lit("_"), F.lit(" ")))


def or_all(label: Column) -> Column:
    return F.coalesce(F.nullif(label, F.lit("")), F.lit("all"))
