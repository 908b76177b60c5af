"""Number parsing that turns bad text into a default instead of an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUMBER = r"^\s*[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?\s*$"
# Everything but digits, dot and minus, and the missing-value texts that hold some of those.
_NOT_MONEY = r"^-?1\.#(?:IND|QNAN)$|[^0-9.\-]"


def _number_text(text: Column) -> Column:
    """The text if it is a plain number, else ''.

    A SQL cast alone also takes forms such as ``12d`` or ``NaN``. The input is
    named only once here, which keeps the generated code short.
    """
    return F.regexp_extract(text, _NUMBER, 0)


def number(text: Column) -> Column:
    """Double, or null where the text is not a plain number."""
    return _number_text(text).try_cast("double")


def is_number(text: Column) -> Column:
    """True for a plain finite number; null or false for anything else."""
    return F.abs(number(text)) < float("inf")


def to_int(text: Column) -> Column:
    """Bigint, truncated toward zero; null and bad text give 0."""
    exact = _number_text(text).try_cast("decimal(38,18)")
    return F.coalesce(exact.try_cast("bigint"), F.lit(0).cast("bigint"))


def to_money(text: Column) -> Column:
    """Double with two places after dropping everything but digits, dot and minus."""
    return F.bround(F.coalesce(number(F.regexp_replace(text, _NOT_MONEY, "")), F.lit(0.0)), 2)


def thousands(value: Column) -> Column:
    return F.format_number(value, 0)


def two_places(value: Column) -> Column:
    return F.format_string("%.2f", F.bround(value, 2))


def plain(value: Column) -> Column:
    """A double as text, without ``.0`` where it is whole."""
    return F.when(value == F.floor(value), value.cast("bigint").cast("string")).otherwise(value.cast("string"))
