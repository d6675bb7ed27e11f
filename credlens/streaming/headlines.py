"""Polled headline classification as a Structured Streaming job (STR-01, SRC-09, MLT-12).

RSS files dropped into a folder are read with the XML source (``rowTag=item``);
each micro-batch strips the trailing " - Source" from titles, normalises them
(PRJ-05), scores every item with the frozen feature model and appends
RELIABLE/UNRELIABLE rows to the sink.  An item is its file and place in it, so
equal headlines are scored one by one.
Production uses a 10-second processing-time trigger; tests drain with
``availableNow``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from credlens.functions import text as tx
from credlens.operators import linear
from credlens.sources import records
from credlens.streaming import selftrain


def score_headlines(batch: DataFrame, state: str, per_file: int | None = None) -> DataFrame:
    spark = batch.sparkSession
    model = selftrain.FeatureModel.load(spark, state)
    items = records.parse_feed(batch.withColumn("item_pos", F.monotonically_increasing_id()), per_file=per_file)
    items = items.withColumn("doc_id", F.xxhash64("file", "item_pos")).withColumn(
        "norm", tx.light_normalise(F.col("title")))
    feats = selftrain.featurise(items.select("doc_id", F.col("norm").alias("text"), F.lit("").alias("title")),
                                model)
    scored = items.join(linear.score(feats, model.weights), "doc_id", "left")
    return records.label_headlines(scored).select("title", "source", "prediction", "confidence", "file")


def run_feed_stream(spark: SparkSession, feed_dir: str, state: str, sink: str, checkpoint: str,
                    available_now: bool = True, per_file: int | None = None):
    src = (spark.readStream.format("xml").option("rowTag", "item").schema(records.FEED_SCHEMA).load(feed_dir)
           .withColumn("file", F.input_file_name()))

    def write(batch: DataFrame, batch_id: int) -> None:
        out = score_headlines(batch, state, per_file).withColumn("batch_id", F.lit(batch_id))
        out.write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")  # idempotent per batch

    w = src.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def write_feed_files(items: DataFrame, path: str, records_per_file: int = 100_000) -> None:
    """Write (title, source) rows as RSS-like XML files (root ``channel``, rows ``item``): as many
    files as the table has partitions, and more where one exceeds ``records_per_file``."""
    (items.select("title", "source").write.option("maxRecordsPerFile", records_per_file)
     .mode("overwrite").format("xml").option("rootTag", "channel").option("rowTag", "item").save(path))
