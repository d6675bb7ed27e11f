"""Corpus sources and sinks (SRC-01..05, SET-03/04, PRJ-01/02).

The article table has the schema ``(doc_id, title, text, subject, label)``
with ``label`` 1 = real, 0 = fake.  Driver tables map onto it as:
``documents.text`` -> text, first line -> title, ``documents.source`` ->
subject, ``labels.quality`` -> label.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from credlens.functions import lexicons as lx
from credlens.functions import text as tx
from credlens.operators import dedup
from credlens.session import table

ARTICLE_SCHEMA = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("subject", T.StringType()),
    T.StructField("date", T.StringType()),
])


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def articles(spark: SparkSession, sf_dir: str, labelled_only: bool = False) -> DataFrame:
    """Driver documents as articles; label from ``labels.quality`` (null if unlabelled).

    ``labels`` is a dimension keyed by doc_id; the join is left (or inner when
    ``labelled_only``) and Catalyst/AQE choose broadcast vs. sort-merge from the
    runtime size, so nothing unbounded is broadcast by hint.
    """
    docs = documents(spark, sf_dir).select("doc_id", "text", "source", "lang")
    return _as_articles(docs.join(labels(spark, sf_dir), "doc_id", "inner" if labelled_only else "left"))


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("int").alias("label"))


def _as_articles(joined: DataFrame) -> DataFrame:
    return joined.select(
        "doc_id",
        tx.first_line(F.col("text")).alias("title"),
        "text",
        F.col("source").alias("subject"),
        "lang",
        "label",
    )


def first_labelled_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SET-01 over the labelled articles; only texts of their first rows pass more than a hash on."""
    docs = documents(spark, sf_dir).select("doc_id", "text", "source", "lang")
    return _as_articles(dedup.dedup_known_text(docs, labels(spark, sf_dir)))


def read_labelled_csv(spark: SparkSession, path: str, label: int) -> DataFrame:
    """SRC-01: one class file (title,text,subject,date) with a constant label."""
    return (spark.read.schema(ARTICLE_SCHEMA)
            .option("header", True).option("multiLine", True).option("escape", '"')
            .csv(path).withColumn("label", F.lit(label)))


def stage_corpus(real: DataFrame, fake: DataFrame) -> DataFrame:
    """SRC-01/SET-03: union the two class tables (missing columns become null)."""
    return real.unionByName(fake, allowMissingColumns=True)


def seeded_shuffle(df: DataFrame, key: str = "doc_id", seed: int = 42) -> DataFrame:
    """SRC-02: deterministic pseudo-random order by a salted hash of the key."""
    return df.withColumn("_order", F.sha2(F.concat(F.lit(str(seed)), F.lit(":"),
                                                   F.col(key).cast("string")), 256))


def drop_null_text(df: DataFrame, col: str = "text") -> DataFrame:
    """PRJ-01."""
    return df.na.drop(subset=[col])


def fill_nulls(df: DataFrame, string_cols=("title", "text", "clean_text"), label_col="label") -> DataFrame:
    """PRJ-02: strings -> '', label -> 0."""
    out = df
    for c in string_cols:
        if c in df.columns:
            out = out.withColumn(c, F.coalesce(F.col(c), F.lit("")))
    if label_col in df.columns:
        out = out.withColumn(label_col, F.coalesce(F.col(label_col), F.lit(0)))
    return out


def hard_negatives(spark: SparkSession) -> DataFrame:
    """SET-04 input: the curated hard-negative rows (doc_id negative, never clashes)."""
    rows = [(-(i + 1), r["title"], r["text"], r["subject"], r["label"])
            for i, r in enumerate(lx.HARD_NEGATIVES)]
    return spark.createDataFrame(rows, "doc_id long, title string, text string, subject string, label int")


def with_hard_negatives(df: DataFrame) -> DataFrame:
    """SET-04: append the hard negatives to an article table."""
    return df.unionByName(hard_negatives(df.sparkSession), allowMissingColumns=True)


def write_corpus(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """SRC-03: corpus sink partitioned by label (never overwrites its own input)."""
    df.write.mode("overwrite").partitionBy("label").format(fmt).save(path)


def write_projection(df: DataFrame, path: str) -> None:
    """SRC-03 + PRJ-02: the (clean_text, label) projection that trainers read, nulls filled, by label."""
    fill_nulls(df.select("clean_text", "label")).write.mode("overwrite").partitionBy("label").parquet(path)


def stage_report(df: DataFrame) -> DataFrame:
    """SRC-04: rows per label plus the total, as one small table."""
    per_label = df.groupBy("label").agg(F.count(F.lit(1)).alias("n_rows"))
    total = df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(None).cast("int").alias("label"), "n_rows")
    return per_label.unionByName(total)

