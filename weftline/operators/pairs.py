"""Candidate pairs from blocks. Block sizes are capped upstream, so the self-join is bounded by the cap."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PAIR = ["company_id_a", "company_id_b"]


def pairs_with_kind(blocks: DataFrame) -> DataFrame:
    """Each pair a < b of each block."""
    a = blocks.select("kind", "bkey", F.col("company_id").alias("company_id_a"))
    b = blocks.select(F.col("kind").alias("k2"), F.col("bkey").alias("b2"), F.col("company_id").alias("company_id_b"))
    on = (F.col("kind") == F.col("k2")) & (F.col("bkey") == F.col("b2")) & (F.col("company_id_b") > F.col("company_id_a"))
    return a.join(b, on).select("kind", "bkey", *PAIR)


def capped_pairs(with_kind: DataFrame, cap: int = 200) -> DataFrame:
    """Distinct pairs; each a keeps its ``cap`` smallest b. The cap is the feature, not a shortcut."""
    w = Window.partitionBy("company_id_a").orderBy("company_id_b")
    return with_kind.select(*PAIR).distinct().withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= cap).select(*PAIR)


def in_shard(df: DataFrame, modulus: int, shard: int) -> DataFrame:
    """Pairs whose a belongs to a shard, for runs that are cut by hand."""
    return df.filter(F.pmod(F.xxhash64("company_id_a"), F.lit(modulus)) == shard)
