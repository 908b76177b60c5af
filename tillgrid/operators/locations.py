"""Choosing locations from a mapping and matching names to portal entries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillgrid.functions.text import is_skipped, norm_a, norm_b, sanitize, strip
from tillgrid.operators.joins import BROADCAST_ROWS, lookup_join, small_join
from tillgrid.operators.ordinal import number_rows


def active_locations(dim: DataFrame) -> DataFrame:
    return dim.where(~is_skipped(F.col("label")))


def list_locations(dim: DataFrame) -> DataFrame:
    """Active locations numbered from 1 in mapping order."""
    return number_rows(active_locations(dim), [], "ordinal", "number", start=1)


def limit_locations(dim: DataFrame, n: int) -> DataFrame:
    """The first ``n`` in mapping order; 0 means all."""
    return dim.orderBy("ordinal").limit(n) if n else dim


def pick_location(dim: DataFrame, name: str) -> DataFrame:
    """The first location of that name, in any letter case."""
    return dim.where(F.lower("pos_name") == name.lower()).orderBy("ordinal").limit(1)


def pick_codes(requested: DataFrame, dim: DataFrame) -> DataFrame:
    """Mapping entries that are asked for."""
    return dim.join(requested.select("code").distinct(), "code", "left_semi")


def unknown_codes(requested: DataFrame, dim: DataFrame) -> DataFrame:
    return lookup_join(requested, dim.select("code"), "code", "left_anti")


def result_labels(results: DataFrame, dim: DataFrame) -> DataFrame:
    """Label of each result; an unknown code is its own label."""
    last = dim.groupBy("code").agg(F.max_by("label", "ordinal").alias("label"))  # of repeated entries the last counts
    labelled = lookup_join(results, last, "code")
    return labelled.withColumn("label", F.coalesce("label", "code"))


def attach_label(reports: DataFrame, dim: DataFrame) -> DataFrame:
    first = dim.groupBy("pos_name").agg(F.min_by("label", "ordinal").alias("label"))
    return lookup_join(reports, first, "pos_name")


def key_collisions(dim: DataFrame) -> DataFrame:
    """Labels that would share one output location."""
    return (
        dim.groupBy(sanitize(F.col("label")).alias("location_key"))
        .agg(F.count_distinct("label").alias("labels"), F.min("label").alias("first_label"))
        .where("labels > 1")
    )


def workplace_dedup(rows: DataFrame) -> DataFrame:
    """One row per trimmed name: the last id given, placed where the name came first."""
    return rows.groupBy(strip(F.col("name")).alias("name")).agg(
        F.max_by("id", "seq").alias("id"), F.min("seq").alias("first_seq")
    )


def cascade(requests: DataFrame, entries: DataFrame, name: str, text: str, value: str, order: str, steps: dict[str, Callable[[Column], Column]],
            result: str, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Add to requests the ``value`` of the entry whose ``text`` matches their name, as ``result``, and the step that did (``matched_by``).

    Steps are keys of a name, the strictest first; a name takes the first step
    in which an entry has its key, and there the first entry by ``order``. All
    steps are looked up in one join: distinct names and entries give a row per
    step and key, and of a name's hits the one of the lowest step stays.
    """

    def keyed(of: Column, *more: Column) -> list[Column]:
        keys = [F.struct(F.lit(i).alias("step"), key(of).alias("key")) for i, key in enumerate(steps.values())]
        return [*more, F.explode(F.array(*keys)).alias("_k")]

    listed = entries.select(*keyed(F.col(text), F.col(value).alias("_value"), F.col(order).alias("_order"))).select("_k.*", "_value", "_order")
    known = listed.where(F.col("_value").isNotNull()).groupBy("step", "key").agg(F.min_by("_value", "_order").alias("_value"))
    asked = _names(requests, name).select(*keyed(F.col(name), F.col(name))).select(name, "_k.*")
    hits = small_join(asked, known, ["step", "key"], "inner", max_rows)
    best = hits.groupBy(name).agg(F.min_by("_value", "step").alias(result), F.min("step").alias("_step"))
    how = F.element_at(F.array(*[F.lit(s) for s in steps]), F.col("_step") + 1)
    resolved = best.select(name, result, how.alias("matched_by"))
    return lookup_join(requests, resolved, name, "left", max_rows).select(*requests.columns, result, "matched_by")


def resolve_cascade(requests: DataFrame, workplaces: DataFrame, name: str = "pos_name",
                    max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Add ``workplace_id``: by exact name, else by the normalised name; null if neither is known.

    ``workplaces`` are deduplicated ``(name, id, first_seq)``.
    """
    steps = {"exact": lambda c: c, "normalised": norm_b}
    return cascade(requests, workplaces, name, "name", "id", "first_seq", steps, "workplace_id", max_rows)


def _names(requests: DataFrame, name: str) -> DataFrame:
    """The distinct names: few beside the requests, so they go through the steps and come back by one join."""
    return requests.select(name).where(F.col(name).isNotNull()).distinct()


def resolve_exact(requests: DataFrame, workplaces: DataFrame, name: str = "pos_name") -> DataFrame:
    exact = workplaces.select(F.col("name").alias(name), F.col("id").alias("workplace_id"))
    return lookup_join(requests, exact, name, "inner")


def resolve_unmatched(requests: DataFrame, workplaces: DataFrame, name: str = "pos_name") -> DataFrame:
    """Requests that no workplace matches. Equal names have equal normalised names, so one anti join does."""
    known = workplaces.select(norm_b(F.col("name")).alias("_norm")).distinct()
    keyed = requests.withColumn("_norm", norm_b(F.col(name)))
    return lookup_join(keyed, known, "_norm", "left_anti").select(*requests.columns)


def option_cascade(requests: DataFrame, options: DataFrame, name: str = "pos_name",
                   max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Add the portal ``option`` of a name: same text, else same lower case, else same normalised text.

    ``options`` are ``(ordinal, option)``; the first of several equals wins.
    """
    listed = options.select("ordinal", strip(F.col("option")).alias("option"))
    steps = {"exact": lambda c: c, "case": F.lower, "normalised": norm_a}
    return cascade(requests, listed, name, "option", "option", "ordinal", steps, "option", max_rows)


def option_unmatched(requests: DataFrame, options: DataFrame, name: str = "pos_name") -> DataFrame:
    """Names without an option; their reports are attributed to nobody."""
    known = options.select(norm_a(strip(F.col("option"))).alias("_key")).distinct()
    keyed = requests.withColumn("_key", norm_a(F.col(name)))
    return lookup_join(keyed, known, "_key", "left_anti").select(*requests.columns)
