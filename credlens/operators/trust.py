"""Domain trust lookup (JON-01..03).

Domain = URL authority, lower-cased, leading ``www.`` removed (port and
user-info kept, as a netloc is).  Exact matches come from a 16-row registry
joined by broadcast (fixed size); suffix rules are an ordered ``when`` chain
(first match wins); everything else is "Neutral" with score 50.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from credlens.functions import lexicons as lx

AUTHORITY_RE = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)"


def domain_of(url: Column) -> Column:
    """JON-01: netloc, lower-cased, without a leading 'www.' ('' when there is none)."""
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), AUTHORITY_RE, 1))
    return F.when(host.startswith("www."), F.substring(host, 5, 1 << 30)).otherwise(host)


def registry(spark: SparkSession) -> DataFrame:
    rows = ([(d, s, desc, "Trusted") for d, s, desc in lx.TRUSTED_DOMAINS]
            + [(d, s, desc, "Low Trust") for d, s, desc in lx.LOW_TRUST_DOMAINS])
    return spark.createDataFrame(rows, "domain string, reg_score int, reg_status string, reg_badge string")


def _suffix_rule(domain: Column, field: int) -> Column:
    expr = None
    for suffixes, score, desc in lx.SUFFIX_RULES:
        cond = None
        for sfx in suffixes:
            c = domain.endswith(sfx)
            cond = c if cond is None else (cond | c)
        value = F.lit([score, desc, "Trusted"][field])
        expr = F.when(cond, value) if expr is None else expr.when(cond, value)
    return expr


def with_trust(df: DataFrame, url_col: str = "url") -> DataFrame:
    """Add domain, score, status, badge columns for the URL column."""
    spark = df.sparkSession
    blank = F.col(url_col).isNull() | (F.col(url_col) == "")
    base = df.withColumn("domain", domain_of(F.col(url_col)))
    j = base.join(F.broadcast(registry(spark)), "domain", "left")
    d = F.col("domain")
    score = F.coalesce(F.col("reg_score"), _suffix_rule(d, 0), F.lit(lx.TRUST_DEFAULT[0]))
    status = F.coalesce(F.col("reg_status"), _suffix_rule(d, 1), F.lit(lx.TRUST_DEFAULT[1]))
    badge = F.coalesce(F.col("reg_badge"), _suffix_rule(d, 2), F.lit(lx.TRUST_DEFAULT[2]))
    na_domain, na_score, na_status, na_badge = lx.TRUST_NO_URL
    return j.select(
        *[c for c in df.columns],
        F.when(blank, F.lit(na_domain)).otherwise(d).alias("domain"),
        F.when(blank, F.lit(na_score)).otherwise(score).cast("int").alias("score"),
        F.when(blank, F.lit(na_status)).otherwise(status).alias("status"),
        F.when(blank, F.lit(na_badge)).otherwise(badge).alias("badge"),
    )
