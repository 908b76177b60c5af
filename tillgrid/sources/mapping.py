"""Mapping tables: locations ``(ordinal, pos_name, label)`` and codes ``(ordinal, code, label, pos_name)``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOCATION_SCHEMA = "ordinal bigint, pos_name string, label string"
CODE_SCHEMA = "ordinal bigint, code string, label string, pos_name string"


def read_locations(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, schema=LOCATION_SCHEMA, header=True)


def read_codes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, schema=CODE_SCHEMA, header=True)


def locations_from_config(spark: SparkSession, entries: list[dict], label_key: str) -> DataFrame:
    """Locations from the parsed ``locations`` list of a configuration; its order is the ordinal."""
    rows = [(i, e["pos_name"], e.get(label_key) or "") for i, e in enumerate(entries)]
    return spark.createDataFrame(rows, LOCATION_SCHEMA)


def codes_from_config(spark: SparkSession, entries: dict[str, tuple[str, str]]) -> DataFrame:
    rows = [(i, code, label, pos_name) for i, (code, (label, pos_name)) in enumerate(entries.items())]
    return spark.createDataFrame(rows, CODE_SCHEMA)


def duplicate_names(dim: DataFrame, name: str = "pos_name") -> DataFrame:
    """Names given more than once; a mapping must have none."""
    return dim.groupBy(name).agg(F.count("*").alias("entries")).where("entries > 1")
