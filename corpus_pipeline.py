"""A training corpus from raw documents, in five stages.

Each stage takes the documents that the one before kept and works on all of
them. All but the last return the columns of documents; the last gives the ids
of the texts, with a row per copy in the mix.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillgrid.llm import bpe, jaccard, language, line_dedup, mixing
from tillgrid.llm.common import stored, table
from tillgrid.llm.queries import vocabulary

# Documents go whose text has no letter, or whose letters and trigrams speak for no learned language.
LEAST_SCORE = 0.2


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID, learned from the labelled documents themselves."""
    found = language.predict(docs, language.learn(docs), docs.columns)
    return found.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE)).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in many documents stay in one of them; n_chars follows the text."""
    kept = line_dedup.apply_bitmaps(docs, line_dedup.bitmaps(docs))
    changed = F.length("text").cast(docs.schema["n_chars"].dataType)
    return kept.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(changed))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by similar shingles the smallest doc_id stays."""
    return jaccard.representatives(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every copy, with their counts and hashes."""
    return bpe.round_trip(docs, vocabulary())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", keep_known_language),
    ("line_dedup", drop_repeated_lines),
    ("jaccard_join", one_of_each_group),
    ("source_mix", mix_sources),
    ("bpe", encode),
]

# Language ID is learned and merges are iterated, which SQL cannot express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
SQL: dict[str, str] = {}
