"""Scoring rules as column expressions (RUL-01..11, AGG-17/18, WIN-10/11).

Scores are percentages of "real" (0..100).  Every rule is a pure column
expression, so a whole table of articles is scored in one narrow stage.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from credlens.functions import lexicons as lx
from credlens.functions import text as tx


# Word lists, thresholds and texts used below are the fixed values in lexicons.py;
# numeric constants in the formulas (30, 8, 0.2, 15, 4, 98, 40, 35, 0.1, 12, 0.65,
# 0.12, 0.35, 18, 0.95, 88, 95) are FIXED VALUES of the scoring rules.


def _bounded(word: str) -> str:
    return r"(?U)\b" + re.escape(word) + r"\b"


def any_word(lower_text: Column, words) -> Column:
    """Any of the words occurs word-bounded."""
    return F.lower(lower_text).rlike("|".join(_bounded(w) for w in words))


def distinct_word_hits(lower_text: Column, words) -> Column:
    """How many of the words occur word-bounded at least once."""
    return sum(lower_text.rlike(_bounded(w)).cast("int") for w in words)


def occurrence_count(lower_text: Column, words) -> Column:
    """Total word-bounded occurrences of all words (findall counts)."""
    return sum(F.size(F.regexp_extract_all(lower_text, F.lit(_bounded(w)), 0)) for w in words)


def substring_hits(lower_text: Column, words) -> Column:
    return sum((F.instr(lower_text, w) > 0).cast("int") for w in words)


# --- RUL-01 / AGG-18: evidence ----------------------------------------------------
def evidence_hits(evidence: DataFrame, doc_col: str = "doc_id") -> DataFrame:
    """JON-04 / AGG-18: per article, word-bounded fake/real signal hits split by query type."""
    content = F.lower(F.concat_ws(" ", F.coalesce(F.col("title"), F.lit("")),
                                  F.coalesce(F.col("snippet"), F.lit(""))))
    e = evidence.select(doc_col, "query_type",
                        distinct_word_hits(content, lx.EVIDENCE_FAKE_SIGNALS).alias("f"),
                        distinct_word_hits(content, lx.EVIDENCE_REAL_SIGNALS).alias("r"),
                        substring_hits(content, lx.VERDICT_FAKE_SIGNALS).alias("vf"),
                        substring_hits(content, lx.VERDICT_REAL_SIGNALS).alias("vr"))
    claim = F.col("query_type") == "claim"
    return e.groupBy(doc_col).agg(
        F.count(F.lit(1)).alias("n_results"),
        F.sum(F.when(~claim, F.col("f")).otherwise(0)).alias("fake_hits"),
        F.sum(F.when(~claim, F.col("r")).otherwise(0)).alias("real_hits"),
        F.sum(F.when(claim, F.col("f")).otherwise(0)).alias("claim_fake_hits"),
        F.sum(F.when(claim, F.col("r")).otherwise(0)).alias("claim_real_hits"),
        F.max(claim.cast("int")).alias("has_claim"),
        F.sum("vf").alias("verdict_fake"),
        F.sum("vr").alias("verdict_real"),
    )


# FIXED VALUES: verdict texts of the live search
SEARCH_VERDICTS = {
    "fake": "FAKE / HOAX (Confirmed by live fact-checkers)",
    "real": "REAL / VERIFIED (Confirmed by live reports)",
    "none": "INCONCLUSIVE (No definitive search signal)",
}


def search_verdict(verdict_fake: Column, verdict_real: Column) -> Column:
    """RUL-01."""
    return (F.when(verdict_fake > verdict_real, F.lit(SEARCH_VERDICTS["fake"]))
            .when(verdict_real > verdict_fake, F.lit(SEARCH_VERDICTS["real"]))
            .otherwise(F.lit(SEARCH_VERDICTS["none"])))


# --- RUL-02: hybrid score ------------------------------------------------------------
def hybrid_score(ml: Column, text: Column, n_results: Column, fake_hits: Column, real_hits: Column,
                 claim_fake: Column, claim_real: Column, has_claim: Column,
                 indicator_penalty: bool = True) -> Column:
    low = F.lower(F.coalesce(text, F.lit("")))
    cf2 = F.greatest(F.lit(0.2), (100.0 - ml) / 100.0)
    cf1 = F.greatest(F.lit(0.1), (100.0 - ml) / 100.0)
    has_results = F.coalesce(n_results, F.lit(0)) > 0
    fh, rh = F.coalesce(fake_hits, F.lit(0)), F.coalesce(real_hits, F.lit(0))
    cfh, crh = F.coalesce(claim_fake, F.lit(0)), F.coalesce(claim_real, F.lit(0))
    primary = (F.when(fh > rh, F.greatest(F.lit(5.0), ml - F.least(F.lit(30.0), 8.0 * (fh - rh) * cf2)))
               .when(rh > fh, F.least(F.lit(98.0), ml + F.least(F.lit(15.0), 4.0 * (rh - fh))))
               .otherwise(ml))
    with_claim = F.when((F.coalesce(has_claim, F.lit(0)) == 1) & ((cfh > crh) | (crh == 0)),
                        F.greatest(F.lit(5.0), primary - 40.0 * cf2)).otherwise(primary)
    no_results = F.when(any_word(low, lx.SENSATIONAL_WORDS),
                        F.greatest(F.lit(10.0), ml - 30.0 * cf2)).otherwise(ml)
    h = F.when(has_results, with_claim).otherwise(no_results)
    if not indicator_penalty:
        return h
    n_ind = occurrence_count(low, lx.FAKE_INDICATORS)
    return F.when(n_ind >= 2, F.greatest(F.lit(5.0), h - F.least(F.lit(35.0), 8.0 * n_ind * cf1))).otherwise(h)


# --- RUL-03 / AGG-17: writing style --------------------------------------------------
def cliche_count(text: Column) -> Column:
    return distinct_word_hits(F.lower(F.coalesce(text, F.lit(""))), lx.AI_CLICHES)


def burstiness(text: Column) -> Column:
    """Population variance of words per '.'-sentence when there are more than 3, else 20."""
    counts = F.transform(tx.dot_sentences(text), lambda s: F.size(tx.py_split(s)).cast("double"))
    n = F.size(counts)
    mean = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x) / n
    # the mean is broadcast into an array once; referencing it inside the lambda
    # would re-evaluate it for every element
    dev = F.zip_with(counts, F.array_repeat(mean, n), lambda x, m: (x - m) * (x - m))
    var = F.aggregate(dev, F.lit(0.0), lambda a, x: a + x) / n
    return F.when(n > 3, var).otherwise(F.lit(20.0))


def ai_probability(cliches: Column, variance: Column) -> Column:
    """RUL-03: 0.12 per cliche (max 4) + 0.35 if variance < 18, capped at 0.95."""
    p = (F.when(cliches >= 1, 0.12 * F.least(F.lit(4), cliches)).otherwise(0.0)
         + F.when(variance < 18.0, 0.35).otherwise(0.0))
    return F.least(F.lit(0.95), p)


def ai_penalty(score: Column, ai_prob: Column, n_results: Column) -> Column:
    """RUL-04: prob > .65 and no evidence -> max(5, s - 12 * cf), cf from the current score."""
    cf = F.greatest(F.lit(0.1), (100.0 - score) / 100.0)
    return F.when((ai_prob > 0.65) & (F.coalesce(n_results, F.lit(0)) == 0),
                  F.greatest(F.lit(5.0), score - 12.0 * cf)).otherwise(score)


def integrity_adjust(score: Column, match_pct: Column, n_altered: Column, has_reference: Column) -> Column:
    """RUL-05: only when a reference article exists."""
    cf = F.greatest(F.lit(0.2), (100.0 - score) / 100.0)
    pen = F.least(F.lit(30.0), (100.0 - match_pct) * 1.0 * cf)
    adj = F.when((match_pct < 95.0) & (n_altered > 0), F.greatest(F.lit(5.0), score - pen)) \
        .otherwise(F.greatest(score, F.lit(88.0)))
    return F.when(has_reference, adj).otherwise(score)


# --- RUL-06/07/08: labels and reasons --------------------------------------------------
def verdict(fake_score: Column) -> Column:
    return F.when(fake_score >= 50.0, F.lit("HIGH RISK MISINFORMATION")).otherwise(F.lit("VERIFIED AUTHENTIC CONTEXT"))


def risk_level(fake_score: Column) -> Column:
    return (F.when(fake_score >= 70.0, F.lit("HIGH")).when(fake_score >= 40.0, F.lit("MEDIUM"))
            .otherwise(F.lit("LOW")))


def readability_label(fre: Column) -> Column:
    return (F.when(fre < 50.0, F.lit("Difficult")).when(fre < 80.0, F.lit("Standard"))
            .otherwise(F.lit("Easy")))


def sentiment_label(polarity: Column) -> Column:
    return (F.when(polarity < -0.2, F.lit("Highly Negative")).when(polarity > 0.2, F.lit("Positive"))
            .otherwise(F.lit("Neutral")))


# FIXED VALUES: reason texts of the audit report (checked in this order, at most 5 shown)
REASONS = [
    ("clickbait", "✓ Clickbait word density is higher than normal."),
    ("emotion", "✓ Sentiment bias/sensational vocabulary intensity is high."),
    ("readability", "✓ Article readability requires advanced parsing."),
    ("trust_low", "✓ Domain trust rating is relatively low/unverified."),
    ("trust_high", "✓ Domain trust aligns with high-authority press registries."),
    ("lexical", "✓ Lexical vocabulary density is low."),
]


def reasons(clickbait_ratio: Column, emotion_intensity: Column, fre: Column, trust_score: Column,
            lexical_diversity: Column) -> Column:
    """RUL-07: ordered reason strings (array, at most 5)."""
    t = F.coalesce(trust_score, F.lit(50))
    conds = [clickbait_ratio > 0.05, emotion_intensity > 0.02, fre < 50.0, t < 60, (t >= 60) & (t >= 80),
             lexical_diversity < 0.4]
    arr = F.array(*[F.when(c, F.lit(msg)) for c, (_, msg) in zip(conds, REASONS)])
    return F.slice(F.filter(arr, lambda x: x.isNotNull()), 1, 5)


# --- RUL-09/10/11: categories and triggers ---------------------------------------------
def failure_category(text: Column, title: Column) -> Column:
    """RUL-09: first matching category (substring tests on lower text or title)."""
    t = F.lower(F.coalesce(text, F.lit("")))
    ti = F.lower(F.coalesce(title, F.lit("")))
    expr = None
    for name, words in lx.FAILURE_CATEGORY_RULES:
        cond = None
        for w in words:
            c = (F.instr(t, w) > 0) | (F.instr(ti, w) > 0)
            cond = c if cond is None else (cond | c)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    click = (F.size(tx.py_split(ti)) < lx.CLICKBAIT_TITLE_MAX_WORDS) & (substring_hits(ti, lx.CLICKBAIT_TITLE_WORDS) > 0)
    return expr.when(click, F.lit(lx.FAILURE_CATEGORY_CLICKBAIT)).otherwise(F.lit(lx.FAILURE_CATEGORY_DEFAULT))


def failure_rationale(category: Column) -> Column:
    """RUL-11."""
    expr = None
    for cat, msg in lx.FAILURE_RATIONALES.items():
        expr = F.when(category == cat, F.lit(msg)) if expr is None else expr.when(category == cat, F.lit(msg))
    return expr.otherwise(F.lit(lx.FAILURE_RATIONALE_DEFAULT))


def evidence_trigger(text: Column, score: Column, forced: Column | None = None) -> Column:
    """RUL-10: look up evidence when forced, a sensational word occurs (substring), or score == 50."""
    low = F.lower(F.coalesce(text, F.lit("")))
    cond = (substring_hits(low, lx.SENSATIONAL_WORDS) > 0) | (score == 50.0)
    return cond | forced if forced is not None else cond


# --- WIN-10/11: search queries -------------------------------------------------------------
def primary_query(text: Column) -> Column:
    """WIN-11: first line of the stripped text; its first 10 words when longer."""
    first = F.split(F.regexp_replace(F.coalesce(text, F.lit("")), "^[" + tx.WS + "]+|[" + tx.WS + "]+$", ""),
                    "\n", 2).getItem(0)
    words = tx.py_split(first)
    return F.when(F.size(words) > 10, F.array_join(F.slice(words, 1, 10), " ")).otherwise(first)


def claim_query(text: Column) -> Column:
    """WIN-10: last sentence containing a claim keyword (substring); first 12 words when longer."""
    sents = tx.sentences(text)
    hits = F.filter(sents, lambda s: F.exists(F.array(*[F.lit(k) for k in lx.CLAIM_KEYWORDS]),
                                              lambda k: F.lower(s).contains(k)))
    last = F.element_at(hits, -1)
    words = tx.py_split(last)
    q = F.when(F.size(words) > 12, F.array_join(F.slice(words, 1, 12), " ")).otherwise(last)
    return F.when(F.size(hits) > 0, q)


# --- TXT-19 / RUL-08 ----------------------------------------------------------------------
def sentiment_bias(text: Column) -> Column:
    """TXT-19: (positive - negative) / words over lower-cased whitespace tokens; 0 for no words."""
    words = tx.py_split(F.lower(F.coalesce(text, F.lit(""))))
    pos = tx.word_count_in(words, lx.STREAM_POSITIVE_WORDS)
    neg = tx.word_count_in(words, lx.STREAM_NEGATIVE_WORDS)
    n = F.size(words)
    return F.when(n == 0, F.lit(0.0)).otherwise((pos - neg) / n)


# FIXED VALUES: contributing-feature texts of the audit report
EXCESSIVE_PUNCT_TEXT = "Excessive punctuation usage"
REPETITIVE_TEXT = "Repetitive style keywords"
GENERAL_TEXT = "General news vocabulary"


def contributing_features(words: Column, excessive_punct: Column, lexical_diversity: Column) -> Column:
    """RUL-08: up to 3 explanation words (quoted, upper-cased) + style flags; a default when empty.

    ``words``: the verdict-side word list (fake words when the fake score >= 50, else real words).
    """
    quoted = F.transform(F.slice(F.coalesce(words, F.array().cast("array<string>")), 1, 3),
                         lambda w: F.concat(F.lit('"'), F.upper(w), F.lit('"')))
    flags = F.array(F.when(excessive_punct > 0, F.lit(EXCESSIVE_PUNCT_TEXT)),
                    F.when(lexical_diversity < 0.4, F.lit(REPETITIVE_TEXT)))
    out = F.concat(quoted, F.filter(flags, lambda x: x.isNotNull()))
    return F.when(F.size(out) == 0, F.array(F.lit(GENERAL_TEXT))).otherwise(out)


# --- staged (DataFrame-level) forms: intermediates become columns, so large
# --- subexpressions (regex passes, sentence arrays) are evaluated once per row
def with_style_scores(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds cliche_count, variance (AGG-17) and ai_prob (RUL-03)."""
    counts = F.transform(tx.dot_sentences(F.col(text)), lambda s: F.size(tx.py_split(s)).cast("double"))
    out = df.withColumn("cliche_count", cliche_count(F.col(text))).withColumn("_counts", counts)
    n = F.size("_counts")
    out = out.withColumn("_n", n).withColumn(
        "_mean", F.aggregate("_counts", F.lit(0.0), lambda a, x: a + x) / F.col("_n"))
    dev = F.zip_with("_counts", F.array_repeat(F.col("_mean"), F.col("_n")), lambda x, m: (x - m) * (x - m))
    out = out.withColumn("variance", F.when(F.col("_n") > 3, F.aggregate(dev, F.lit(0.0), lambda a, x: a + x)
                                            / F.col("_n")).otherwise(F.lit(20.0)))
    return (out.withColumn("ai_prob", ai_probability(F.col("cliche_count"), F.col("variance")))
            .drop("_counts", "_n", "_mean"))


def with_hybrid_score(df: DataFrame, ml: str, text: str, out: str = "hybrid_score",
                      n_results: str | None = None, fake_hits: str | None = None, real_hits: str | None = None,
                      claim_fake: str | None = None, claim_real: str | None = None,
                      has_claim: str | None = None) -> DataFrame:
    """RUL-02 with staged intermediates (same result as :func:`hybrid_score`)."""
    def c(name):
        return F.col(name) if name else F.lit(None).cast("long")
    low = F.lower(F.coalesce(F.col(text), F.lit("")))
    staged = df.withColumn("_n_ind", occurrence_count(low, lx.FAKE_INDICATORS)).withColumn(
        "_h", hybrid_score(F.col(ml), F.col(text), c(n_results), c(fake_hits), c(real_hits),
                           c(claim_fake), c(claim_real), c(has_claim), indicator_penalty=False))
    cf1 = F.greatest(F.lit(0.1), (100.0 - F.col(ml)) / 100.0)
    pen = F.when(F.col("_n_ind") >= 2, F.greatest(F.lit(5.0), F.col("_h") - F.least(
        F.lit(35.0), 8.0 * F.col("_n_ind") * cf1))).otherwise(F.col("_h"))
    return staged.withColumn(out, pen).drop("_n_ind", "_h")
