"""Corpus audit aggregations (AGG-01..03, TXT-20)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# FIXED VALUES: publisher-mention patterns of the audit
REUTERS_RE = r"(?iU)\breuters\b"
AP_RE = r"(?iU)\bassociated press\b|\b\(ap\)\b"
REUTERS_LEAD = "Reuters"
REUTERS_DATELINE = "WASHINGTON (Reuters)"


def label_subject_counts(df: DataFrame) -> DataFrame:
    """AGG-01: articles per (label, subject)."""
    return df.groupBy("label", "subject").agg(F.count(F.lit(1)).alias("n_articles"))


def publisher_mentions(df: DataFrame, text: str = "text") -> DataFrame:
    """AGG-02 / TXT-20: per label, articles mentioning Reuters / AP and the lead signature."""
    t = F.coalesce(F.col(text), F.lit(""))
    lead = F.ltrim(t).startswith(REUTERS_DATELINE) | (F.instr(F.substring(t, 1, 50), REUTERS_LEAD) > 0)
    return df.groupBy("label").agg(
        F.count(F.lit(1)).alias("n_articles"),
        F.sum(t.rlike(REUTERS_RE).cast("long")).alias("reuters_mentions"),
        F.sum(t.rlike(AP_RE).cast("long")).alias("ap_mentions"),
        F.sum(lead.cast("long")).alias("reuters_lead_signature"),
    )


def split_sources(df: DataFrame, split_col: str = "split", subject: str = "subject") -> DataFrame:
    """AGG-03: the distinct sources of each split, a row each, with their articles."""
    return df.groupBy(F.col(split_col).alias("split"), F.col(subject).alias("source")).agg(F.count(F.lit(1)).alias("n_articles"))
