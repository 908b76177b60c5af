"""Column specification of a report and the select it compiles to."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillgrid.functions.dates import reformat_date
from tillgrid.functions.numbers import to_int, to_money
from tillgrid.operators.header import cell_at, present


@dataclass(frozen=True)
class ColumnSpec:
    raw: str | None = None
    target: str | None = None
    dtype: str = "str"
    drop: bool = False
    inject: str | None = None


@dataclass(frozen=True)
class ReportSpec:
    columns: list[ColumnSpec]
    order: list[str]
    raw_date_format: str = "%d/%m/%Y"
    output_date_format: str = "%d-%b-%Y"
    key: str = "Menu Item #"
    injectors: dict[str, Callable[[ReportSpec], Column]] = field(default_factory=dict)

    @property
    def mapped(self) -> list[ColumnSpec]:
        return [c for c in self.columns if c.raw and c.target and not c.drop and not c.inject]

    @property
    def injected(self) -> list[ColumnSpec]:
        return [c for c in self.columns if c.target and c.inject]

    @property
    def known(self) -> list[str]:
        """Raw names that the spec maps or drops; any other raw name is an extra."""
        return [c.raw for c in self.columns if c.raw]

    @property
    def targets(self) -> list[str]:
        return [c.target for c in self.columns if c.target and not c.drop]


# The item-sales column mapping and output order.
ITEM_SALES = ReportSpec(
    columns=[
        ColumnSpec("Menu Item Name", "POS Item Name", "str"),
        ColumnSpec("Menu Item #", "POS Item ID *", "int"),
        ColumnSpec("Qty Sold", "Sold QTY *", "int"),
        ColumnSpec("Discounts", "Total Discount Value", "float"),
        ColumnSpec("Net VAT after Disc.", "Total sales excl. tax *", "float"),
        ColumnSpec("Gross after Disc.", "Total sales incl. tax *", "float"),
        ColumnSpec(None, "Sales Date *", "date", inject="business_dates_metadata"),
        ColumnSpec(None, "Order ID", "str", inject="empty"),
        ColumnSpec(None, "Sales Type Code", "str", inject="empty"),
        ColumnSpec("Menu Item Def", drop=True),
        ColumnSpec("Price Level", drop=True),
        ColumnSpec("Returns", drop=True),
        ColumnSpec("Net VAT before Disc.", drop=True),
        ColumnSpec("Discounts VAT", drop=True),
        ColumnSpec("Gross before Disc.", drop=True),
    ],
    order=[
        "Sales Date *", "POS Item ID *", "POS Item Name", "Sold QTY *", "Total Discount Value",
        "Total sales excl. tax *", "Total sales incl. tax *", "Order ID", "Sales Type Code",
    ],
)


def spec_from_config(config: dict) -> ReportSpec:
    """A spec from a parsed configuration with ``columns`` and ``output_column_order``."""
    columns = [
        ColumnSpec(c.get("raw"), c.get("target"), c.get("dtype") or "str", bool(c.get("drop")), c.get("inject"))
        for c in config["columns"]
    ]
    return ReportSpec(
        columns,
        list(config.get("output_column_order", [])),
        config.get("raw_date_format", "%d/%m/%Y"),
        config.get("output_date_format", "%d-%b-%Y"),
    )


def _inject_business_date(spec: ReportSpec) -> Column:
    return reformat_date(F.col("business_date"), spec.raw_date_format, spec.output_date_format)


def _inject_empty(spec: ReportSpec) -> Column:
    return F.lit("")


# Strategies for columns that the raw file does not hold; a spec may add its own.
INJECTORS = {"business_dates_metadata": _inject_business_date, "empty": _inject_empty}

CASTS: dict[str, Callable[[Column], Column]] = {"int": to_int, "float": to_money}


def with_positions(meta: DataFrame, spec: ReportSpec, extras: list[str] | None = None) -> DataFrame:
    """Add what the spec takes from a file as a whole.

    ``pos`` has, for every mapped or extra raw name, its 0-based place in the
    file, null if absent; ``injected`` has the columns that are not in the file.
    Done once per file, so that rows only fetch cells by position.
    """

    def place(raw: str) -> Column:
        return (F.nullif(F.array_position("header", raw), F.lit(0)) - 1).cast("int")

    def place_of_extra(name: str) -> Column:
        known = F.transform("header", lambda h: F.when(~h.isin(spec.known or [""]), F.lower(h)))
        return (F.nullif(F.array_position(known, name.lower()), F.lit(0)) - 1).cast("int")

    mapped = [place(c.raw).alias(f"p{i}") for i, c in enumerate(spec.mapped)]
    more = [place_of_extra(name).alias(f"e{i}") for i, name in enumerate(extras or [])]
    strategies = {**INJECTORS, **spec.injectors}
    injected = [strategies[c.inject](spec).alias(f"i{i}") for i, c in enumerate(spec.injected)]
    none = [F.lit(None).cast("string").alias("none")]
    return meta.withColumn("pos", F.struct(*mapped, *more)).withColumn("injected", F.struct(*(injected or none)))


def raw_cell(spec: ReportSpec, raw: str) -> Column:
    """The cell of a mapped raw column as it is in the file."""
    index = [c.raw for c in spec.mapped].index(raw)
    return F.get(F.col("cells"), F.col(f"pos.p{index}"))


def target_columns(spec: ReportSpec, only: list[str] | None = None) -> list[Column]:
    """Output columns in their final order.

    A mapped column that the file lacks stays null, while a blank cell of a
    present column takes the default of its type.
    """
    built: dict[str, Column] = {}
    for i, c in enumerate(spec.mapped):
        cast = CASTS.get(c.dtype)
        cell = raw_cell(spec, c.raw)
        built[c.target] = F.when(F.col(f"pos.p{i}").isNotNull(), cast(cell)) if cast else present(cell)
    for i, c in enumerate(spec.injected):
        built[c.target] = F.col(f"injected.i{i}")
    names = [n for n in spec.order if n in built] + [n for n in built if n not in spec.order]
    return [built[n].alias(n) for n in names if only is None or n in only]


def extra_names(meta: DataFrame, spec: ReportSpec, taken: tuple[str, ...] = (), limit: int = 500) -> list[str] | None:
    """Raw names outside the spec over all files that have the key, sorted: the schema of the extras.

    Names that differ in case alone are one column. The spec's own columns and
    the ``taken`` ones win over a raw column of their name. Only distinct names
    reach the driver; None says that there are more than ``limit``, which are no
    columns for a table but keys of a map.
    """
    used = sorted({n.lower() for n in (*spec.targets, *taken)})
    names = (
        meta.where(F.array_contains(F.array_compact("header"), spec.key))
        .select(F.explode("header").alias("name"))
        .where(F.col("name").isNotNull() & ~F.col("name").isin(spec.known) & ~F.lower("name").isin(used))
        .groupBy(F.lower("name").alias("folded")).agg(F.min("name").alias("name"))
    )
    found = [r.name for r in names.limit(limit + 1).collect()]
    return sorted(found) if len(found) <= limit else None


def extra_columns(names: list[str]) -> list[Column]:
    return [cell_at(F.col("cells"), F.col(f"pos.e{i}")).alias(name) for i, name in enumerate(names)]


def extra_map(spec: ReportSpec) -> Column:
    """All extras of a row as one map, for reports whose extras vary without bound."""
    pairs = F.arrays_zip(F.col("header").alias("name"), F.col("cells").alias("cell"))
    kept = F.filter(pairs, lambda p: p["name"].isNotNull() & ~p["name"].isin(spec.known))
    return F.map_from_entries(F.transform(kept, lambda p: F.struct(p["name"], p["cell"])))


def spec_table(spark: SparkSession, spec: ReportSpec) -> DataFrame:
    """The spec as rows, for checks."""
    rows = [(c.raw, c.target, c.dtype, c.drop, c.inject) for c in spec.columns]
    return spark.createDataFrame(rows, "raw string, target string, dtype string, `drop` boolean, inject string")
