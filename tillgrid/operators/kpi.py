"""KPI reports: from the nested JSON payload to a wide row or a long table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillgrid.functions.text import title_label

# Fixed values of the payload: path to the entry, category and discount keys with their column names.
ENTRY_PATH = "$.data[0].tables[0].content[0].content[0].content[0].data"
CATEGORIES = [
    "juice", "sandwich", "shake", "coffee", "loyalty_card", "breakfast", "salad", "counter_product", "topping", "misc",
]
DISCOUNTS = {
    "neighbour": "Disc Neighbour",
    "employee": "Disc Employee",
    "loyalty": "Disc Loyalty",
    "employee_meal": "Disc Emp Meal",
}
BASE_FIELDS = {
    "Turnover": "total.turnover",
    "Products": "total.products",
    "Employees": "total.employees",
    "PHP Max": "total.php_max",
    "Avg Turnover": "average.turnover",
    "Avg Products": "average.products",
}
CATEGORY_FIELDS = {
    "Turnover": "turnover", "Products": "products", "TO %": "turnover_percentage", "Prod %": "product_percentage",
}
SHARE_FIELDS = {"Products": "products", "%": "percentage"}

_SHARE = "struct<products: double, percentage: double>"
ENTRY_SCHEMA = (
    "total struct<turnover: double, products: double, employees: double, php_max: double>, "
    "average struct<turnover: double, products: double>, "
    "categories map<string, struct<turnover: double, products: double, "
    "turnover_percentage: double, product_percentage: double>>, "
    f"discount_group map<string, {_SHARE}>, employee_meal {_SHARE}"
)
# Entry texts that count as empty.
EMPTY_ENTRIES = ["", "{}", "[]", "null", "0", "false"]


def kpi_extract(reports: DataFrame, payload: str = "payload") -> DataFrame:
    """Replace the payload by ``entry_json`` and the parsed ``entry``.

    Both are null where the entry is absent or empty or the payload is no JSON.
    The one-element explode keeps all rows; it makes the text found a column of
    its own, so that checks on it do not search the payload again.
    """
    kept = [c for c in reports.columns if c != payload]
    found = reports.select(*kept, F.explode(F.array(F.get_json_object(payload, ENTRY_PATH))).alias("_found"))
    text = F.when(~F.col("_found").isin(EMPTY_ENTRIES), F.col("_found"))
    return found.withColumn("entry_json", text).withColumn("entry", F.from_json("_found", ENTRY_SCHEMA)).drop("_found")


def kpi_outcomes(reports: DataFrame, payload: str = "payload") -> DataFrame:
    """``outcome`` and ``reason`` of each payload beside its other columns.

    ``ok`` has an entry, ``no_data`` is JSON without one or with an empty one,
    ``failed`` is no JSON, also where the text breaks off behind an entry.
    """
    told = reports.withColumn("_valid", F.try_parse_json(payload).isNotNull())
    found = kpi_extract(told, payload)
    outcome = F.when(~F.col("_valid"), "failed").when(F.col("entry_json").isNull(), "no_data").otherwise("ok")
    reason = F.when(~F.col("_valid"), "malformed payload").when(F.col("entry_json").isNull(), "empty report").otherwise("")
    return found.withColumn("outcome", outcome).withColumn("reason", reason).drop("_valid")


def kpi_rejects(reports: DataFrame, payload: str = "payload") -> DataFrame:
    """Reports without figures, with the reason: malformed ones apart from empty ones."""
    return kpi_outcomes(reports, payload).where("outcome <> 'ok'").drop("entry", "entry_json")


def with_entry(extracted: DataFrame) -> DataFrame:
    return extracted.where(F.col("entry_json").isNotNull())


def kpi_empty(extracted: DataFrame) -> DataFrame:
    return extracted.where(F.col("entry_json").isNull()).drop("entry", "entry_json")


def _zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def base_columns() -> list[Column]:
    return [_zero(F.col(f"entry.{path}")).alias(name) for name, path in BASE_FIELDS.items()]


def category_columns() -> list[Column]:
    return [
        _zero(F.col("entry.categories")[key][path]).alias(f"{key.replace('_', ' ').title()} {name}")
        for key in CATEGORIES
        for name, path in CATEGORY_FIELDS.items()
    ]


def discount_columns() -> list[Column]:
    return [
        _zero(F.col("entry.discount_group")[key][path]).alias(f"{label} {name}")
        for key, label in DISCOUNTS.items()
        for name, path in SHARE_FIELDS.items()
    ]


def meal_columns() -> list[Column]:
    return [_zero(F.col(f"entry.employee_meal.{path}")).alias(f"Emp Meal {name}") for name, path in SHARE_FIELDS.items()]


def kpi_flatten(extracted: DataFrame) -> DataFrame:
    """The 60-column row of each report that has an entry.

    Wants ``report_date, code, label, pos_name, entry``. Absent and null values give 0.
    """
    return with_entry(extracted).select(
        F.col("report_date").cast("string").alias("Date"),
        F.col("code").alias("Code"),
        F.col("label").alias("Location"),
        F.col("pos_name").alias("POS Name"),
        *base_columns(),
        *category_columns(),
        *discount_columns(),
        *meal_columns(),
    )


def kpi_long(extracted: DataFrame, keys: list[str]) -> DataFrame:
    """One row per report and category that occurs in it, with the category's label."""
    rows = with_entry(extracted).select(
        *keys, F.explode("entry.categories").alias("category", "figures")
    )
    return rows.select(
        *keys,
        "category",
        title_label(F.col("category")).alias("category_label"),
        *[_zero(F.col("figures")[path]).alias(path) for path in CATEGORY_FIELDS.values()],
    )
