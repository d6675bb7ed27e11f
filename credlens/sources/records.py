"""Failure records and headline feeds (SRC-06/07, SRC-09, STR-01, STR-10, WIN-12, MLT-12).

Failure records are an append-only JSON table, one record per misclassified
article, keyed by the first 16 hex digits of sha256(text) plus the epoch
second.  The reader takes an explicit schema and drops malformed files, and
reads both line-delimited and pretty-printed (multi-line) records.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from credlens.functions import lexicons as lx
from credlens.functions import text as tx

FAILURE_SCHEMA = ("title string, text string, url string, predicted_label int, true_label int, "
                  "confidence double, top_contributing_features array<string>, failure_reason string, "
                  "timestamp long")


def failure_records(errors: DataFrame, top_words: DataFrame, reason: str = lx.BENCHMARK_FAILURE_REASON,
                    doc_col: str = "doc_id") -> DataFrame:
    """SRC-06 + WIN-12: one record per misclassified row.

    ``errors``: (doc_id, title, text, url, pred, label, p_real);
    ``top_words``: (doc_id, direction, rank, feature) from the explanation.
    Features = fake words (by rank) then real words (by rank), first 5.
    """
    order = F.when(F.col("direction") == "fake", 0).otherwise(1) * 1000 + F.col("rank")
    feats = (top_words.withColumn("o", order)
             .groupBy(doc_col).agg(F.sort_array(F.collect_list(F.struct("o", "feature"))).alias("l"))
             .select(doc_col, F.slice(F.col("l.feature"), 1, 5).alias("top_contributing_features")))
    conf = F.when(F.col("pred") == 1, F.col("p_real")).otherwise(1.0 - F.col("p_real"))
    now = F.unix_timestamp(F.current_timestamp())
    return (errors.join(feats, doc_col, "left")
            .select(doc_col, "title", "text", "url", F.col("pred").cast("int").alias("predicted_label"),
                    F.col("label").cast("int").alias("true_label"), conf.alias("confidence"),
                    F.coalesce("top_contributing_features", F.array().cast("array<string>"))
                    .alias("top_contributing_features"),
                    F.lit(reason).alias("failure_reason"), now.alias("timestamp"),
                    tx.content_hash(F.col("text"), 16).alias("record_key")))


def write_failures(records: DataFrame, path: str) -> None:
    """SRC-06 sink: append-only JSON."""
    records.drop("doc_id").write.mode("append").json(path)


def read_failures(spark: SparkSession, path: str) -> DataFrame:
    """SRC-07 source: explicit schema, corrupt records dropped, equal records once.

    Line-delimited files (our sink), pretty-printed records and arrays of records are all accepted
    in one pass: a raw line break never lies inside a JSON string, so a record starts where a line
    starts with a brace.  Files are cut there by the text source, which splits large ones over
    tasks; a task holds one record at a time, or one array.
    """
    chunk = F.regexp_replace("value", r"^[\s\uFEFF]+", "")
    # The separator took the brace of every record but a file's first.
    whole = F.when(chunk.startswith('"'), F.concat(F.lit("{"), chunk)).otherwise(chunk)
    single = F.when(whole.startswith("["), F.from_json(whole, "array<string>")).otherwise(F.array(whole))
    rows = spark.read.option("lineSep", "\n{").text(path).select(F.explode(single).alias("raw"))
    parsed = rows.select(F.from_json("raw", f"{FAILURE_SCHEMA}, malformed string", {"columnNameOfCorruptRecord": "malformed"}).alias("r"))
    good = parsed.select("r.*").where("malformed is null and text is not null and true_label is not null").drop("malformed")
    return good.dropDuplicates(["text", "timestamp", "predicted_label", "true_label"])


# --- SRC-09 / STR-01: headline feeds ------------------------------------------------------
FEED_SCHEMA = "title string, source string"
DEFAULT_FEED_SOURCE = "Google News"


def parse_feed(items: DataFrame, file_col: str = "file", per_file: int | None = None) -> DataFrame:
    """SRC-09 + PRJ-10: feed items -> (title, source, item_pos); empty titles dropped.

    ``per_file`` keeps a dashboard's first items of each file; by default all items count."""
    if per_file is not None:
        w = Window.partitionBy(file_col).orderBy("item_pos")
        items = items.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= per_file)
    title = tx.strip_source_suffix(F.coalesce(F.col("title"), F.lit("")))
    return (items.select(title.alias("title"),
                         F.coalesce(F.col("source"), F.lit(DEFAULT_FEED_SOURCE)).alias("source"), file_col, "item_pos")
            .filter(F.col("title") != ""))


def label_headlines(scored: DataFrame) -> DataFrame:
    """MLT-12: RELIABLE / UNRELIABLE + confidence (polarity converted at the edge: 1 = real)."""
    pred = F.col("p_real") >= 0.5
    return scored.select("*", F.when(pred, F.lit("RELIABLE")).otherwise(F.lit("UNRELIABLE")).alias("prediction"),
                         F.when(pred, F.col("p_real")).otherwise(1.0 - F.col("p_real")).alias("confidence"))
