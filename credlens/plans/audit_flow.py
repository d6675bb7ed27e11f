"""Out-of-domain audit of a labelled article table with URLs (MLT-11, E5).

articles (doc_id, title, text, url, label) -> frozen feature model -> score ->
threshold -> domain trust -> correct? -> failure records for the misses ->
summary metrics.  Every step is a DataFrame job; the model is a saved
:class:`FeatureModel`, so the same audit runs on any table of any size.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from credlens.functions import rules as rl
from credlens.functions import text as tx
from credlens.operators import evaluation as ev
from credlens.operators import linear, similarity, trust
from credlens.sources import records
from credlens.streaming.selftrain import FeatureModel, featurise


@dataclass
class AuditResult:
    rows: DataFrame      # per article: domain, score, prediction, confidence, correct
    failures: DataFrame  # failure records of the misclassified rows
    summary: DataFrame   # accuracy, precision, recall, f1, fpr, fnr, roc_auc, status


def audit_articles(articles: DataFrame, model: FeatureModel, threshold: float = 0.5) -> AuditResult:
    feats = featurise(articles.select("doc_id", "title", "text"), model).persist()
    scored = articles.join(linear.score(feats, model.weights), "doc_id")
    pred = (F.col("p_real") >= threshold).cast("int")
    rows = trust.with_trust(scored.withColumn("pred", pred)).select(
        "doc_id", "title", "url", "domain", F.col("score").alias("domain_score"), "label", "pred", "p_real",
        F.when(F.col("pred") == 1, F.col("p_real")).otherwise(1.0 - F.col("p_real")).alias("confidence"),
        (F.col("pred") == F.col("label")).alias("correct"))
    errors = (rows.filter(~F.col("correct")).join(articles.select("doc_id", "text"), "doc_id")
              .select("doc_id", "title", "text", "url", "pred", "label", "p_real"))
    words = linear.top_word_contributions(linear.contributions(feats, model.weights))
    failures = records.failure_records(errors, words)
    summary = ev.summary(rows.select("doc_id", "label", "p_real"), threshold)
    return AuditResult(rows, failures, summary)


#: Characters that a fetched page needs to serve as a reference.
MIN_REFERENCE_CHARS = 100


def wants_evidence(articles: DataFrame, forced=None) -> DataFrame:
    """RUL-10: the articles (doc_id, text, ml) whose evidence is to be looked up."""
    return articles.filter(rl.evidence_trigger(F.col("text"), F.col("ml"), forced))


def first_usable_reference(evidence: DataFrame, pages: DataFrame) -> DataFrame:
    """JON-06: (doc_id, url) of the best-ranked non-claim result whose page holds more than ``MIN_REFERENCE_CHARS``
    characters.  The minimum over (rank, url) is summed up before the shuffle: no window over an
    article with very many results."""
    usable = pages.filter(F.length(F.trim(F.coalesce("text", F.lit("")))) > MIN_REFERENCE_CHARS).select("url").distinct()
    primary = evidence.filter((F.col("query_type").isNull()) | (F.col("query_type") != "claim")).select("doc_id", "rank", "url")
    return primary.join(usable, "url").groupBy("doc_id").agg(F.min(F.struct("rank", "url")).alias("best")).select("doc_id", F.col("best.url").alias("url"))


def audit_with_evidence(articles: DataFrame, evidence: DataFrame, pages: DataFrame, check_sentences: bool = True) -> DataFrame:
    """E2 with evidence: articles (doc_id, title, text, url, ml), evidence (doc_id, query_type, rank, title, url, snippet) and
    fetched pages (url, text) -> hits, search verdict, hybrid score, style penalty, reference, altered sentences, trust, verdict.

    JON-04/AGG-18, RUL-01..06, JON-05/06, JON-01..03; an article without evidence keeps the rules for none."""
    hits = rl.evidence_hits(evidence)
    t = trust.with_trust(articles).withColumnRenamed("score", "domain_score").join(hits, "doc_id", "left")
    t = t.withColumn("search_verdict", rl.search_verdict(F.coalesce("verdict_fake", F.lit(0)), F.coalesce("verdict_real", F.lit(0))))
    t = t.withColumn("hybrid", rl.hybrid_score(F.col("ml"), F.col("text"), F.col("n_results"), F.col("fake_hits"), F.col("real_hits"),
                                               F.col("claim_fake_hits"), F.col("claim_real_hits"), F.col("has_claim")))
    t = rl.with_style_scores(t, "text")
    t = t.withColumn("styled", rl.ai_penalty(F.col("hybrid"), F.col("ai_prob"), F.col("n_results")))
    refs = first_usable_reference(evidence, pages).withColumnRenamed("url", "reference_url")
    t = t.join(refs, "doc_id", "left")
    if check_sentences:
        # a page that was fetched more than once counts once
        own = pages.groupBy(F.col("url").alias("reference_url")).agg(F.max("text").alias("text"))
        checked = similarity.check_pairs(refs, articles.select("doc_id", "text"), own, ref_id="reference_url")
        t = t.join(checked.drop("reference_url"), "doc_id", "left")
    else:
        t = t.withColumn("match_pct", F.lit(None).cast("double")).withColumn("n_altered", F.lit(None).cast("int"))
    final = rl.integrity_adjust(F.col("styled"), F.col("match_pct"), F.col("n_altered"), F.col("match_pct").isNotNull())
    t = t.withColumn("final", final)
    return t.select("doc_id", "domain", "domain_score", F.coalesce("n_results", F.lit(0)).alias("n_results"),
                    *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("fake_hits", "real_hits", "claim_fake_hits", "claim_real_hits")],
                    "search_verdict", "hybrid", "styled", "reference_url", "match_pct", "n_altered", "final",
                    rl.verdict(100.0 - F.col("final")).alias("verdict"), rl.risk_level(100.0 - F.col("final")).alias("risk"))


def passage_evidence(pairs: DataFrame, passages: DataFrame, per_article: int = 3) -> DataFrame:
    """Evidence rows from passages that share sentences with an article: (doc_id, item_id, n_shared) ranked by
    shared sentences, then id; the passage's first line is its title, the passage its snippet."""
    # the limit on the rank is applied before the shuffle: a task sends an article's best few
    w = Window.partitionBy("doc_id").orderBy(F.col("n_shared").desc(), "item_id")
    ranked = pairs.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= per_article).select("doc_id", "rank", "item_id")
    return ranked.join(passages.select("item_id", "text"), "item_id").select(
        "doc_id", F.lit("primary").alias("query_type"), F.col("rank").cast("int").alias("rank"), tx.first_line(F.col("text")).alias("title"),
        F.concat(F.lit("passage:"), F.col("item_id").cast("string")).alias("url"), F.col("text").alias("snippet"))
