"""Cleaning pipeline over ``documents``: toxicity, language, near duplicates, personal data, packing.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; all but the
last return the columns of ``documents``.  ``run`` stores each stage's result in the cluster's
shared place and reads it back as the next one's input.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from credlens.llm import jaccard, langid, packing, pii, toxicity
from credlens.llm.common import documents, prepare, stored, tokenizer_path, work_dir
from credlens.session import shared_dir, table

#: A document stays if its main language has at least this share of its letters.
MIN_LANGUAGE_SHARE = 0.35


def _names(docs: DataFrame, *names: str) -> list[str]:
    """Names for computed columns that the table does not have."""
    while any(n in docs.columns for n in names):
        names = tuple(f"_{n}" for n in names)
    return list(names)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon, learned from ``labels``, does not mark as toxic."""
    prepare(spark)
    lexicon = toxicity.train(docs, table(spark, sf_dir, "labels"))
    names = _names(docs, "score", "predicted", "evidence")
    scored = toxicity.score_text(docs, lexicon, carry=docs.columns, names=names)
    return scored.where(F.col(names[1]) == 0).select(*docs.columns)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language: neither letterless nor without a main language."""
    prepare(spark)
    names = _names(docs, "lang_pred", "share", "words", "switches")
    found = langid.predict(docs, langid.train(docs), carry=docs.columns, names=names)
    return found.where((F.col(names[0]) != "und") & (F.col(names[1]) >= MIN_LANGUAGE_SHARE)).select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8): that with
    the smallest id (none: last), of equal ids the first by a hash of its text.  Documents without words are no
    duplicates.  Rows are told apart by a key of their own, so rows of one id, or of none, are
    compared like any others, and only near duplicates go."""
    prepare(spark)
    key, name = _names(docs, "key", "component")
    # Stored, because every reading must see the same key.
    keyed = stored(docs.withColumn(key, F.monotonically_increasing_id()), work_dir(spark, "pipeline-keys"))
    groups = jaccard.jaccard_components(keyed.select(F.col(key).alias("doc_id"), "text"), words=5, num=80, den=100)
    groups = groups.select(F.col("doc_id").alias(key), F.col("component_id").alias(name))
    # A group's first row: its members are summed up before the shuffle, and no text moves but a hash.
    rank = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("text"), F.col(key).alias("key"))
    first = (keyed.select(key, rank.alias("rank")).join(groups, key).groupBy(name).agg(F.min("rank").alias("rank"))
             .select(F.col("rank.key").alias(key)))
    return keyed.join(first, key, "left_semi").select(*docs.columns)


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with e-mail, address, card and phone spans masked; ``n_chars`` follows the text."""
    prepare(spark)
    name, = _names(docs, "masked")
    masked = pii.redact(docs, pii.train(docs), name, carry=docs.columns)
    out = {"text": F.col(name)}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out["n_chars"] = F.when(F.col("n_chars").isNull(), F.lit(None)).otherwise(F.length(name)).cast(kind)
    return masked.withColumns(out).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences of 1024 ids, filled with lexical neighbours."""
    prepare(spark)
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"), end_id=0, window=1024)


STAGES = [
    ("toxicity", toxicity_stage),
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("personal_data", personal_data_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = shared_dir(spark, f"llm/pipeline/{uuid.uuid4().hex}")
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{at}/{name}")
        docs = spark.read.parquet(f"{at}/{name}")
    return docs


#: Learned models and the packing order are not SQL; tests/llm checks the stages by brute force.
ORACLE_SQL = None
