"""Epochs over chunks of a stored feature table (SRC-05, STR-09).

``store_chunks`` writes the features and labels once, partitioned by chunk; a step reads the folder of its
chunk and nothing else, so an epoch reads every row once whatever the number of chunks.  The weights
between the steps, as many rows as there are features, are stored after each step: a driver that fails
goes on after the last one that is complete.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from credlens.operators import linear
from credlens.operators.splits import fold_column


def store_chunks(features: DataFrame, labels: DataFrame, n_chunks: int, path: str, doc_col: str = "doc_id") -> None:
    """SRC-05: ``features`` (doc_id, feature, value) and ``labels`` (doc_id, label) dealt by document into
    ``n_chunks`` folders of ``path``."""
    chunk = fold_column(n_chunks, doc_col, "chunk:")
    labels.select(doc_col, "label", chunk.alias("chunk")).write.mode("overwrite").partitionBy("chunk").parquet(f"{path}/labels")
    rows = features.join(labels.select(doc_col), doc_col, "left_semi")
    rows.select(doc_col, "feature", "value", chunk.alias("chunk")).write.mode("overwrite").partitionBy("chunk").parquet(f"{path}/features")


def chunk(spark: SparkSession, path: str, k: int) -> tuple[DataFrame, DataFrame]:
    """(features, labels) of one chunk; the scan lists its folder alone."""
    features, labels = (spark.read.parquet(f"{path}/{name}").filter(F.col("chunk") == k).drop("chunk") for name in ("features", "labels"))
    return features, labels


def _done(spark: SparkSession, at: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    path = hadoop.Path(f"{at}/_SUCCESS")
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def train(spark: SparkSession, path: str, n_chunks: int, epochs: int, weights: DataFrame | None = None, eta: float = 1.0,
          alpha: float = 1e-4) -> DataFrame:
    """STR-09: weights after ``epochs`` passes of one online step per chunk, in chunk order.

    Steps that were stored by an earlier run under the same ``path`` are not taken again."""
    for epoch in range(epochs):
        for k in range(n_chunks):
            at = f"{path}/weights/{epoch:04d}-{k:06d}"
            if not _done(spark, at):
                features, labels = chunk(spark, path, k)
                # one small file: as many rows as there are features; the stored features are those of the labels
                linear.online_step(features, labels, weights, eta=eta, alpha=alpha, matched=True).coalesce(1).write.mode("overwrite").parquet(at)
            weights = spark.read.parquet(at)
    return weights if weights is not None else linear.zero_weights(spark)
