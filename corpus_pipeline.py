"""From raw documents to packed training sequences; every stage is written and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import exact, jaccard, mixing, packing, quality
from llm.shared import documents, stored

#: Target weight of every source; None: mixing.balanced_weights().
WEIGHTS: dict[str, float] | None = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality.good_documents(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The longest document of each set of equal texts stays."""
    return exact.deduplicated(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates stays."""
    return jaccard.one_of_each(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mixture."""
    return mixing.in_order(docs, weights=WEIGHTS)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The bin and place of every document or piece of one; shards follow each other in the mixture."""

    def position(items: DataFrame) -> DataFrame:
        at = F.col("slot") * mixing.BLOCK_ROWS + F.col("place")
        return mixing.mixed(items, weights=WEIGHTS, source="from").withColumn("position", at)

    return packing.packed(docs, position=position)


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup),
    ("n-gram Jaccard join", near_dedup),
    ("mixing sources to target weights", source_mixing),
    ("best-fit packing", best_fit_packing),
]

#: Packing keeps state from bin to bin, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
