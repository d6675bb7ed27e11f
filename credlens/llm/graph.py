"""Connected components of an edge table by alternating star operations (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def components(edges: DataFrame, path: str, rounds: int = 50) -> DataFrame:
    """(node, label): the smallest node of each node's component; nodes without an edge are left out.

    Each round is stored under ``path``, so lineage stays short and a lost executor costs
    one round.  A node's neighbours are never gathered: their minimum is an aggregate that is
    joined back."""
    spark = edges.sparkSession
    now = edges.toDF("a", "b").where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    seen = None
    for k in range(rounds):
        # Large star: larger neighbours of a node hang on the smallest of its neighbourhood.
        both = now.union(now.select("b", "a"))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # Small star: a node and its smaller neighbours hang on the smallest of them.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
                 .union(low.select("a", F.col("m").alias("b"))).distinct())
        small.write.parquet(f"{path}/{k}")
        now = spark.read.schema(small.schema).parquet(f"{path}/{k}")
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
