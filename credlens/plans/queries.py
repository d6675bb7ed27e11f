"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the driver tables (or data Spark derives from them) in
full.  Doubles are quantised with :func:`credlens.session.q6` so results
compare exactly against the DuckDB oracles in :mod:`credlens.plans.oracles`.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as _W
from pyspark.sql import functions as F

from credlens.functions import lexicons as _lx
from credlens.functions import rules as rl
from credlens.functions import stylometry as st
from credlens.functions import text as tx
from credlens.operators import audit, dedup, epochs, knn, linear, models, splits, trust
from credlens.operators import evaluation as ev
from credlens.operators import batchfit as bf
from credlens.operators import learners as ml
from credlens.operators import similarity as sim
from credlens.operators import vocab as vc
from credlens.plans import audit_flow, model_flow, replay, reports
from credlens.session import cut_lineage, q6, shared_dir, table
from credlens.sources import corpus
from credlens.sources import pages as pg
from credlens.sources import records as rec
from credlens.streaming import headlines, progress, selftrain


def _articles(spark, sf_dir, labelled_only=False):
    return corpus.articles(spark, sf_dir, labelled_only)


# --- flagship -----------------------------------------------------------------
def source_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: documents -> drop null text -> de-dup -> full clean -> 32 features
    -> per (subject, label) profile."""
    a = _articles(spark, sf_dir).select("doc_id", "title", "text", "subject", "label")
    a = dedup.dedup_text(corpus.drop_null_text(a))
    a = a.withColumn("clean_text", tx.full_preprocess(F.col("text")))
    f = st.with_dense_features(a, keep=["subject", "label"])
    return f.groupBy("subject", "label").agg(
        F.count(F.lit(1)).alias("n_docs"),
        q6(F.avg("lexical_diversity")).alias("avg_lexical_diversity"),
        q6(F.avg("flesch_reading_ease")).alias("avg_flesch_reading_ease"),
        q6(F.avg("avg_sentence_len")).alias("avg_sentence_len"),
        q6(F.avg("uppercase_ratio")).alias("avg_uppercase_ratio"),
        F.sum(F.col("word_count").cast("long")).alias("total_words"),
    )


# --- text cleaning ------------------------------------------------------------
def leakage_clean(spark, sf_dir):
    """TXT-01..03 over every document."""
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", tx.clean_text(F.col("text")).alias("clean_text"))


def stopword_filter(spark, sf_dir):
    """TXT-04 on the leakage-cleaned text."""
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", tx.tokenize_and_filter(tx.clean_text(F.col("text"))).alias("filtered_text"))


def full_clean(spark, sf_dir):
    """TXT-05..15 over every document."""
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", tx.full_preprocess(F.col("text")).alias("clean_text"))


def light_normalise(spark, sf_dir):
    """PRJ-05 over every conversation turn."""
    c = table(spark, sf_dir, "conversations")
    return c.select("conv_id", "turn", tx.light_normalise(F.col("text")).alias("norm_text"))


def stylometric_features(spark, sf_dir):
    """FEA-01..32 per document (title = first line)."""
    a = _articles(spark, sf_dir).withColumn("clean_text", tx.full_preprocess(F.col("text")))
    f = st.with_dense_features(a, keep=["doc_id"])
    return f.select("doc_id", *[q6(F.col(c)).alias(c) for c in st.FEATURE_COLUMNS])


# --- de-dup / corpus ------------------------------------------------------------
def dedup_first_text(spark, sf_dir):
    """SET-01: one row per distinct text, smallest doc_id kept."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return dedup.dedup_text(d).select("doc_id", "source")


def dedup_title_text(spark, sf_dir):
    """SET-02 + PRJ-04/05: de-dup on title+text, then normalise."""
    a = _articles(spark, sf_dir)
    return dedup.dedup_title_text(a).select("doc_id", "combined_text")


def corpus_stage_report(spark, sf_dir):
    """SRC-04 over the labelled corpus."""
    return corpus.stage_report(corpus.articles(spark, sf_dir, labelled_only=True))


def audit_label_subject(spark, sf_dir):
    """AGG-01."""
    return audit.label_subject_counts(corpus.articles(spark, sf_dir, labelled_only=True))


def audit_publisher_mentions(spark, sf_dir):
    """AGG-02."""
    return audit.publisher_mentions(_articles(spark, sf_dir, labelled_only=True))


QUERIES = {
    "source_profile": source_profile,
    "leakage_clean": leakage_clean,
    "stopword_filter": stopword_filter,
    "full_clean": full_clean,
    "light_normalise": light_normalise,
    "stylometric_features": stylometric_features,
    "dedup_first_text": dedup_first_text,
    "dedup_title_text": dedup_title_text,
    "corpus_stage_report": corpus_stage_report,
    "audit_label_subject": audit_label_subject,
    "audit_publisher_mentions": audit_publisher_mentions,
}


# --- vocabulary / weighting (VEC) ------------------------------------------------


def _all_doc_tokens(spark, sf_dir):
    # partition by doc_id first, so the regex cleaning runs after the exchange in
    # every partition (not inside a single scan task) and later per-document steps
    # reuse the same partitioning
    d = vc.partition_docs(table(spark, sf_dir, "documents").select("doc_id", "text"))
    d = cut_lineage(d.select("doc_id", tx.full_clean_tokens(F.col("text")).alias("tokens")))
    # filter above the stored table: a filter pushed through the projection would
    # substitute the alias and run the whole regex cleaner a second time
    return d.filter(F.size("tokens") > 0)


def tfidf_vocabulary(spark, sf_dir):
    """VEC-01..03 over all documents: pruned top-5000 vocabulary with df and idf."""
    docs = _all_doc_tokens(spark, sf_dir)
    n = docs.count()
    v = vc.prune_vocabulary(vc.document_frequencies(vc.term_frequencies(docs)), n, vc.BASELINE)
    return v.select("term", F.col("df").cast("long").alias("df"), F.col("tf_total").cast("long").alias("tf_total"),
                    q6(F.col("idf")).alias("idf"))


def tfidf_weights(spark, sf_dir):
    """VEC-04: L2-normalised sublinear TF-IDF weights (long form) for every document."""
    docs = _all_doc_tokens(spark, sf_dir)
    n = docs.count()
    # counted inside the rows, for the vocabulary and again for the weights: the counts of all terms, many
    # times the texts, are kept nowhere
    tf = vc.term_frequencies(docs)
    v = cut_lineage(vc.prune_vocabulary(vc.document_frequencies(tf), n, vc.BASELINE))
    return vc.tfidf(tf, v).select("doc_id", "term", q6(F.col("weight")).alias("weight"))


def tfidf_top_tokens(spark, sf_dir):
    """VEC-11 / WIN-05: the 5 highest-weighted terms per document (ties by term)."""
    from pyspark.sql import Window
    w = tfidf_weights(spark, sf_dir)
    win = Window.partitionBy("doc_id").orderBy(F.col("weight").desc(), F.col("term").asc())
    return w.withColumn("rank", F.row_number().over(win).cast("long")).filter(F.col("rank") <= 5)


def chi2_selection(spark, sf_dir):
    """VEC-06/07: chi-square scores on the train split, top 4000 terms."""
    f = model_flow.fit(spark, sf_dir)
    return f.selected.select("term", "chi2")


def minmax_scaled_features(spark, sf_dir):
    """VEC-08: 32 dense features scaled with train min/max (test rows not clipped)."""
    f = model_flow.fit(spark, sf_dir)
    return f.dense.select("doc_id", *[q6(F.col(c)).alias(c) for c in st.FEATURE_COLUMNS])


def online_weights(spark, sf_dir):
    """MLT-06: weights of the logistic fit on the train split."""
    f = model_flow.fit(spark, sf_dir)
    return f.weights.select("feature", q6(F.col("weight")).alias("weight"))


def scored_documents(spark, sf_dir):
    """MLT-10: p_real, p_fake, prediction and confidence for every labelled document."""
    f = model_flow.fit(spark, sf_dir)
    pred = (F.col("p_real") >= 0.5).cast("int")
    conf = F.when(pred == 1, F.col("p_real")).otherwise(1.0 - F.col("p_real"))
    return f.scored.select("doc_id", "label", "split", q6(F.col("p_real")).alias("p_real"),
                           q6(1.0 - F.col("p_real")).alias("p_fake"), pred.alias("pred"),
                           q6(conf).alias("confidence"))


def eval_confusion(spark, sf_dir):
    """AGG-04 on the test split."""
    return ev.confusion(model_flow.test_scores(spark, sf_dir))


def eval_class_report(spark, sf_dir):
    """AGG-05 on the test split."""
    return ev.class_report(model_flow.test_scores(spark, sf_dir))


def eval_summary(spark, sf_dir):
    """AGG-06/07/09: accuracy, precision, recall, F1, FPR, FNR, ROC-AUC, status."""
    return ev.summary(model_flow.test_scores(spark, sf_dir).persist())


def eval_roc_curve(spark, sf_dir):
    """AGG-08."""
    return ev.roc_curve(model_flow.test_scores(spark, sf_dir).persist())


def eval_pr_curve(spark, sf_dir):
    """AGG-10: precision/recall per distinct score plus the average precision."""
    s = model_flow.test_scores(spark, sf_dir).persist()
    ap = ev.average_precision(s)
    return ev.pr_curve(s).select(q6(F.col("p_real")).alias("threshold"), q6(F.col("precision")).alias("precision"),
                                 q6(F.col("recall")).alias("recall"), q6(F.lit(ap)).alias("average_precision"))


def eval_calibration(spark, sf_dir):
    """AGG-11."""
    return ev.calibration_curve(model_flow.test_scores(spark, sf_dir))


def eval_threshold_sweep(spark, sf_dir):
    """AGG-13: F1 at each of 81 thresholds."""
    return ev.threshold_sweep(model_flow.test_scores(spark, sf_dir))


def eval_best_threshold(spark, sf_dir):
    """AGG-13: earliest threshold with the best F1 (default 0.5)."""
    return ev.best_threshold(ev.threshold_sweep(model_flow.test_scores(spark, sf_dir)))


def eval_hardest_errors(spark, sf_dir):
    """WIN-01 + PRJ-08: top-5 most confident errors with a 350-char excerpt."""
    f = model_flow.fit(spark, sf_dir)
    s = f.scored.filter(F.col("split") == "test").select("doc_id", "label", "p_real")
    h = ev.hardest_errors(s)
    return (h.join(f.docs.select("doc_id", F.substring("text", 1, 350).alias("excerpt")), "doc_id")
            .select("doc_id", "label", "pred", "confidence", "excerpt"))


def model_top_coefficients(spark, sf_dir):
    """WIN-04: 15 strongest fake and real vocabulary weights."""
    f = model_flow.fit(spark, sf_dir)
    return linear.top_coefficients(f.weights).select("direction", "feature", q6(F.col("weight")).alias("weight"))


def explain_top_words(spark, sf_dir):
    """MLT-14 / WIN-02: per test document, top 8 real-leaning and top 8 fake-leaning words."""
    f = model_flow.fit(spark, sf_dir)
    test = f.hybrid.join(f.docs.filter(F.col("split") == "test").select("doc_id"), "doc_id", "left_semi")
    c = linear.contributions(test, f.weights)
    return linear.top_word_contributions(c).select(
        "doc_id", "direction", "rank", "feature", q6(F.col("contribution")).alias("contribution"))


def explain_categories(spark, sf_dir):
    """AGG-21: per test document, summed dense contributions per category (by name)."""
    f = model_flow.fit(spark, sf_dir)
    test = f.hybrid.join(f.docs.filter(F.col("split") == "test").select("doc_id"), "doc_id", "left_semi")
    return linear.category_summary(linear.contributions(test, f.weights)).select(
        "doc_id", "category", q6(F.col("contribution")).alias("contribution"))


QUERIES.update({
    "tfidf_vocabulary": tfidf_vocabulary,
    "tfidf_weights": tfidf_weights,
    "tfidf_top_tokens": tfidf_top_tokens,
    "chi2_selection": chi2_selection,
    "minmax_scaled_features": minmax_scaled_features,
    "online_weights": online_weights,
    "scored_documents": scored_documents,
    "eval_confusion": eval_confusion,
    "eval_class_report": eval_class_report,
    "eval_summary": eval_summary,
    "eval_roc_curve": eval_roc_curve,
    "eval_pr_curve": eval_pr_curve,
    "eval_calibration": eval_calibration,
    "eval_threshold_sweep": eval_threshold_sweep,
    "eval_best_threshold": eval_best_threshold,
    "eval_hardest_errors": eval_hardest_errors,
    "model_top_coefficients": model_top_coefficients,
    "explain_top_words": explain_top_words,
    "explain_categories": explain_categories,
})


# --- pages and domain trust (PAG, JON-01..03) -------------------------------------


def domain_trust(spark, sf_dir):
    """JON-01..03 for every page URL."""
    p = table(spark, sf_dir, "pages").select("page_id", "url")
    return trust.with_trust(p).select("page_id", "domain", "score", "status", "badge")


def page_title_regex(spark, sf_dir):
    """PAG-02 regex variant over every page."""
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", pg.title_regex(F.col("html")).alias("title"))


def page_language(spark, sf_dir):
    """PAG-07 over every page."""
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", pg.language_regex(F.col("html")).alias("language"))


def page_extract(spark, sf_dir):
    """PAG-01..10: full extraction job over every page (rows-only check + pytest)."""
    p = table(spark, sf_dir, "pages")
    return pg.extract_pages(p).select(
        "page_id", "url", "title", "text", "author", "date", "publisher", "category", "canonical_url",
        "language", "word_count", "article_length", "reading_time",
        F.col("poor_quality").cast("int").alias("poor_quality"), "error")


def page_quality_by_domain(spark, sf_dir):
    """PAG + JON: extracted pages joined with trust, quality summary per badge and language."""
    p = table(spark, sf_dir, "pages")
    ex = trust.with_trust(pg.extract_pages(p))
    return ex.groupBy("badge", "language").agg(
        F.count(F.lit(1)).alias("n_pages"),
        F.sum(F.col("poor_quality").cast("long")).alias("n_poor"),
        F.sum("word_count").alias("total_words"))


QUERIES.update({
    "domain_trust": domain_trust,
    "page_title_regex": page_title_regex,
    "page_language": page_language,
    "page_extract": page_extract,
    "page_quality_by_domain": page_quality_by_domain,
})


# --- rules (RUL) and the per-article audit (E2) -------------------------------------


def ai_style_scores(spark, sf_dir):
    """RUL-03 + AGG-17 + TXT-17 over every document."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    c = rl.with_style_scores(d, "text")
    return c.select("doc_id", F.col("cliche_count").cast("long").alias("cliche_count"),
                    q6(F.col("variance")).alias("variance"), q6(F.col("ai_prob")).alias("ai_prob"))


def search_queries(spark, sf_dir):
    """WIN-10/11 + TXT-16: primary and claim search queries per document."""
    d = table(spark, sf_dir, "documents")
    q = d.select("doc_id", rl.primary_query(F.col("text")).alias("primary_query"),
                 rl.claim_query(F.col("text")).alias("claim"))
    keep = F.col("claim").isNotNull() & (F.instr(F.col("primary_query"), F.col("claim")) == 0)
    return q.select("doc_id", "primary_query", F.when(keep, F.col("claim")).alias("claim_query"))


def _errors(f):
    s = f.scored.filter(F.col("split") == "test")
    e = s.withColumn("pred", (F.col("p_real") >= 0.5).cast("int")).filter(F.col("pred") != F.col("label"))
    return e.join(f.docs.select("doc_id", "title", "text"), "doc_id")


def failure_categories(spark, sf_dir):
    """RUL-09 + AGG-14: misclassified test articles per failure category."""
    e = _errors(model_flow.fit(spark, sf_dir))
    return (e.withColumn("category", rl.failure_category(F.col("text"), F.col("title")))
            .groupBy("category").agg(F.count(F.lit(1)).alias("n_errors")))


def error_samples(spark, sf_dir):
    """WIN-07 + RUL-11 + PRJ-08: first 10 errors (by doc_id) with category, rationale, excerpt."""
    e = _errors(model_flow.fit(spark, sf_dir))
    e = e.withColumn("category", rl.failure_category(F.col("text"), F.col("title")))
    return (e.orderBy("doc_id").limit(10)
            .select("doc_id", "label", "pred", q6(F.col("p_real")).alias("p_real"), "category",
                    rl.failure_rationale(F.col("category")).alias("rationale"),
                    F.substring("text", 1, 250).alias("excerpt")))


def article_audit(spark, sf_dir):
    """E2 over a table: model score -> hybrid rules -> style penalty -> trust -> verdict,
    risk, labels and reasons, one row per labelled article (no evidence, no URL)."""
    f = model_flow.fit(spark, sf_dir)
    raw = st.with_dense_features(f.docs, keep=["doc_id", "text"])
    t = raw.join(f.scored.select("doc_id", "p_real"), "doc_id").withColumn("ml", F.col("p_real") * 100.0)
    t = rl.with_hybrid_score(t, "ml", "text", out="hyb")     # no evidence rows
    t = rl.with_style_scores(t, "text")
    t = t.withColumn("final", rl.ai_penalty(F.col("hyb"), F.col("ai_prob"), F.lit(None).cast("long")))
    trust_score = F.lit(50)  # no URL: 'N/A', 50, 'Unverified'
    fake = 100.0 - F.col("final")
    return t.select(
        "doc_id", q6(F.col("final")).alias("real_score"), q6(fake).alias("fake_score"),
        rl.verdict(fake).alias("verdict"), rl.risk_level(fake).alias("risk"),
        rl.readability_label(F.col("flesch_reading_ease")).alias("readability"),
        rl.sentiment_label(F.col("polarity")).alias("sentiment"),
        F.array_join(rl.reasons(F.col("clickbait_ratio"), F.col("emotion_intensity"), F.col("flesch_reading_ease"),
                                trust_score, F.col("lexical_diversity")), "|").alias("reasons"))


QUERIES.update({
    "ai_style_scores": ai_style_scores,
    "search_queries": search_queries,
    "failure_categories": failure_categories,
    "error_samples": error_samples,
    "article_audit": article_audit,
})


# --- nearest neighbours (MLT-05) ----------------------------------------------------


def knn_predictions(spark, sf_dir):
    """MLT-05: exact 9-NN distance-weighted class for every test embedding (train = the rest)."""
    e = table(spark, sf_dir, "embeddings").withColumn("split", linear.split_column("vec_id"))
    test = e.filter(F.col("split") == "test")
    train = e.filter(F.col("split") == "train")
    p = knn.knn_predict(test, train, k=9)
    return p.join(test.select("vec_id", "label"), "vec_id").select("vec_id", "label", "pred")


def knn_accuracy(spark, sf_dir):
    """MLT-05 + AGG-07: accuracy of the 9-NN classifier on the test embeddings."""
    p = knn_predictions(spark, sf_dir)
    return p.agg(F.count(F.lit(1)).alias("n"),
                 q6(F.avg((F.col("pred") == F.col("label")).cast("double"))).alias("accuracy"))


QUERIES.update({"knn_predictions": knn_predictions, "knn_accuracy": knn_accuracy})


# --- streaming (STR) ------------------------------------------------------------------


def stream_routing(spark, sf_dir):
    """STR-02 batch twin: route every labelled article by model confidence."""
    f = model_flow.fit(spark, sf_dir)
    r = selftrain.route(f.scored)
    return r.groupBy("route").agg(F.count(F.lit(1)).alias("n_articles"),
                                  F.sum(F.col("pred").cast("long")).alias("n_pred_real"))


def stream_selftrain_telemetry(spark, sf_dir):
    """STR-02..07 as a real Structured Streaming query over every document.

    The model is fitted on the labelled train split, the whole documents table
    is staged as files of a file source, as many as its size asks for, and the stream drains it
    with an availableNow trigger; the per-batch telemetry table is returned.
    """
    f = model_flow.fit(spark, sf_dir)
    base = shared_dir(spark, f"credlens/selftrain/{uuid.uuid4().hex}")
    selftrain.FeatureModel(f.vocabulary, f.selected, f.stats, f.weights).save(base + "/state")
    docs = corpus.articles(spark, sf_dir).select("doc_id", "title", "text")
    selftrain.stage_source(docs, base + "/source")
    q = selftrain.run_stream(spark, base + "/source", base + "/state", base + "/checkpoint")
    q.awaitTermination()
    return selftrain.telemetry(spark, base + "/state").select(
        "batch_id", "total_processed", "pseudo_labeled", "drift_reviewed", "ignored",
        q6(F.col("parameter_drift_rate")).alias("parameter_drift_rate"), "top_feature_shifts")


QUERIES.update({"stream_routing": stream_routing, "stream_selftrain_telemetry": stream_selftrain_telemetry})


# --- Spark ML learners (MLT) -----------------------------------------------------------


def _learner_table(spark, sf_dir, max_rows: int | None = None) -> ml.Table:
    """The fitted flow's rows; ``max_rows``: of the train rows, a bounded subset alone (WIN-13)."""
    f = model_flow.fit(spark, sf_dir)
    docs = f.docs.select("doc_id", "label", "split")
    if max_rows is not None:
        # stored: every reading of the subset would search all rows for it again
        docs = cut_lineage(linear.training_subset(docs.filter(F.col("split") == "train"), max_rows))
        return ml.Table(cut_lineage(f.hybrid.join(docs.select("doc_id"), "doc_id", "left_semi")), docs)
    return ml.Table(f.hybrid, docs)


def ml_model_metrics(spark, sf_dir):
    """MLT-01..04, 07, 08, 10 + AGG-05/09: test metrics of every learner, of the mean of two calibrated
    ones and of the calibrated soft vote of four."""
    t = _learner_table(spark, sf_dir)
    labels = t.docs.select("doc_id", "label")

    def judged(name: str, p: DataFrame) -> DataFrame:
        return ev.summary(cut_lineage(p.join(labels, "doc_id"))).select(F.lit(name).alias("model"), "*")

    found = ml.together(spark, [lambda name=name, p=p: judged(name, p) for name, p in ml.test_metrics_inputs(t).items()], threads=8)
    out = found[0]
    for s in found[1:]:
        out = out.unionByName(s)
    return out


def ml_tuning(spark, sf_dir, max_rows: int = 5000):
    """MLT-09: the five parameter searches, on a tuning subset of documented size."""
    return ml.tune_all(_learner_table(spark, sf_dir, max_rows))


def ml_learning_curve(spark, sf_dir):
    """AGG-12: train / validation accuracy for 5 train fractions x 3 folds (15 fits, in one go)."""
    c = ml.learning_curve(_learner_table(spark, sf_dir))
    return c.select("fraction", q6(F.col("train_accuracy")).alias("train_accuracy"),
                    q6(F.col("validation_accuracy")).alias("validation_accuracy"))


#: Steps of the learners' descent that the SQL oracles unroll.
DESCENT_STEPS = 6


def ml_grid_descent(spark, sf_dir):
    """MLT-09 / MLT-03: two losses x three strengths x three folds fitted in the same passes: loss and left-out accuracy."""
    t = _learner_table(spark, sf_dir)
    cands, fits = ml.descent_grid(t, DESCENT_STEPS)
    # train rows alone, told by their place in the blocks: no row of a margin moves to learn its split
    m = bf.margins(t.design, cands, fits, held_only=True, below=ml.TEST_PLACE)
    facts = spark.createDataFrame([(i, c.loss, c.C, c.fold_out, float(f.loss), f.n_train) for i, (c, f) in enumerate(zip(cands, fits))],
                                  "candidate int, loss string, C double, fold_out int, objective double, n_train long")
    right = ((F.col("margin") >= 0).cast("int") == F.col("label")).cast("long")
    held = m.join(F.broadcast(facts), "candidate").filter(F.col("fold") == F.col("fold_out"))
    return held.groupBy("loss", "C", "fold_out", "n_train", "objective").agg(
        F.count(F.lit(1)).alias("n_held"), F.sum(right).alias("n_right")).withColumn("objective", q6(F.col("objective")))


def svm_weights(spark, sf_dir):
    """MLT-03: weights of the squared-hinge SVM on the train rows after a few steps of descent."""
    t = _learner_table(spark, sf_dir)
    fit, = bf.fit_many(t.design, [bf.Candidate("svm", "squared_hinge", ml.SVM_C, penalise_bias=True)], DESCENT_STEPS, memory=0)
    return t.design.weights_table(fit.weights).select("feature", q6(F.col("weight")).alias("weight"))


def svm_calibrated(spark, sf_dir):
    """MLT-07: the SVM of each fold calibrated on the rows it did not see; mean probability of every test row."""
    t = _learner_table(spark, sf_dir)
    cands = [bf.Candidate("svm", "squared_hinge", ml.SVM_C, fold_out=o, penalise_bias=True) for o in range(ml.FOLDS)]
    fits = bf.fit_many(t.design, cands, DESCENT_STEPS, memory=0)
    p = ml.calibrate(ml.outer_rows(t, bf.margins(t.design, cands, fits), range(ml.FOLDS)))
    return p.select("doc_id", q6(F.col("p_real")).alias("p_real"))


QUERIES.update({"ml_grid_descent": ml_grid_descent, "svm_weights": svm_weights, "svm_calibrated": svm_calibrated})
QUERIES.update({"ml_model_metrics": ml_model_metrics, "ml_tuning": ml_tuning, "ml_learning_curve": ml_learning_curve})


# --- integrity matching against reference passages (JON-05/06, RUL-05) ------------------


def integrity_matches(spark, sf_dir):
    """JON-05/06: every document paired with the benchmark passage it shares most sentences
    with, then match percentage and altered-sentence count (difflib semantics)."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    b = table(spark, sf_dir, "benchmark").select("item_id", "text")
    m = sim.integrity_matches(d, b)
    adj = rl.integrity_adjust(F.lit(50.0), F.col("match_pct"), F.col("n_altered"), F.lit(True))
    return m.select("doc_id", "item_id", F.col("n_shared").cast("long").alias("n_shared"),
                    q6(F.col("match_pct")).alias("match_pct"), "n_altered",
                    q6(adj).alias("adjusted_score_from_50"))


def integrity_pairs(spark, sf_dir):
    """JON-06 pairing alone: SQL-checkable (shared normalised-sentence counts)."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    b = table(spark, sf_dir, "benchmark").select("item_id", "text")
    return sim.pair_with_reference(d, b).select("doc_id", "item_id", F.col("n_shared").cast("long").alias("n_shared"))


QUERIES.update({"integrity_matches": integrity_matches, "integrity_pairs": integrity_pairs})


# --- failure records, replay, headline feed (SRC-06/07/09, SET-05, STR-01/10, MLT-12) ------


def failure_records(spark, sf_dir):
    """SRC-06 -> SRC-07 -> SET-05: misclassified test articles written as failure records,
    read back with the tolerant reader and replayed into the corpus (idempotent)."""
    f = model_flow.fit(spark, sf_dir)
    test = f.hybrid.join(f.docs.filter(F.col("split") == "test").select("doc_id"), "doc_id", "left_semi")
    words = linear.top_word_contributions(linear.contributions(test, f.weights))
    errs = (_errors(f).withColumn("url", F.lit(None).cast("string")))
    base = shared_dir(spark, f"credlens/failures/{uuid.uuid4().hex}")
    rec.write_failures(rec.failure_records(errs, words), base)
    back = rec.read_failures(spark, base)
    corpus_rows = f.docs.select("title", "text", "subject", "label")
    replayed = dedup.replay_failures(dedup.replay_failures(corpus_rows, back), back)  # twice: idempotent
    n_replayed = replayed.count() - corpus_rows.count()
    return back.select(tx.content_hash(F.col("text"), 16).alias("record_key"), "predicted_label", "true_label",
                       q6(F.col("confidence")).alias("confidence"),
                       F.array_join("top_contributing_features", ",").alias("top_features"),
                       F.lit(n_replayed).cast("long").alias("n_new_corpus_rows"))


def headline_stream(spark, sf_dir):
    """STR-01 / SRC-09 / MLT-12: document first lines published as RSS files (source =
    document source), classified by a streaming job with the XML source."""
    f = model_flow.fit(spark, sf_dir)
    base = shared_dir(spark, f"credlens/feed/{uuid.uuid4().hex}")
    selftrain.FeatureModel(f.vocabulary, f.selected, f.stats, f.weights).save(base + "/state")
    docs = table(spark, sf_dir, "documents")
    items = docs.select(F.concat(tx.first_line(F.col("text")), F.lit(" - "), F.col("source")).alias("title"),
                        F.col("source"))
    headlines.write_feed_files(items, base + "/feed")
    q = headlines.run_feed_stream(spark, base + "/feed", base + "/state", base + "/sink", base + "/ckpt")
    q.awaitTermination()
    out = spark.read.parquet(base + "/sink")
    return out.groupBy("source", "prediction").agg(F.count(F.lit(1)).alias("n_headlines"),
                                                   q6(F.avg("confidence")).alias("avg_confidence"))


QUERIES.update({"failure_records": failure_records, "headline_stream": headline_stream})


# --- more corpus operators (SRC-02, SET-04, AGG-03, JON-09, AGG-15/16) ---------------------
def seeded_order(spark, sf_dir):
    """SRC-02: deterministic shuffle key of every document (consumers sort by it)."""
    d = table(spark, sf_dir, "documents").select("doc_id")
    return corpus.seeded_shuffle(d).select("doc_id", F.col("_order").alias("shuffle_key"))


def hard_negative_corpus(spark, sf_dir):
    """SET-04: labelled corpus plus the curated hard negatives, counted per (label, subject)."""
    a = corpus.articles(spark, sf_dir, labelled_only=True).select("doc_id", "title", "text", "subject", "label")
    return audit.label_subject_counts(corpus.with_hard_negatives(a))


def split_sources(spark, sf_dir):
    """AGG-03: distinct sources and their number per split of the labelled corpus."""
    return audit.split_sources(model_flow.fit(spark, sf_dir).docs, "split", "subject")


def prediction_cache(spark, sf_dir):
    """JON-09: every document looked up by content hash in the stored predictions."""
    f = model_flow.fit(spark, sf_dir)
    stored = f.scored.join(f.docs.select("doc_id", "text"), "doc_id").select(
        tx.content_hash(F.col("text")).alias("hash"), "p_real")
    hits, misses = dedup.cache_split(table(spark, sf_dir, "documents").select("doc_id", "text"), stored)
    h = hits.agg(F.count(F.lit(1)).alias("n_hits"), q6(F.avg("p_real")).alias("avg_cached_p_real"))
    m = misses.agg(F.count(F.lit(1)).alias("n_distinct_misses"))
    return h.withColumn("_k", F.lit(1)).join(m.withColumn("_k", F.lit(1)), "_k").drop("_k")


def model_consensus(spark, sf_dir):
    """AGG-15/16 + MLT-08: two linear models (hybrid features, dense-only features) scored
    on the test split; mean and vote consensus per document."""
    f = model_flow.fit(spark, sf_dir)
    test_ids = f.docs.filter(F.col("split") == "test").select("doc_id")
    dense = linear.dense_long(f.dense)
    w2 = model_flow.dense_only_weights(f)
    # Stored, as both consensus forms read them.  Spark takes a union of two aggregates by document to be dealt by
    # document; when it finds while running that they no longer are alike, a join above would meet other partitions.
    p1 = cut_lineage(linear.score(f.hybrid.join(test_ids, "doc_id", "left_semi"), f.weights)).withColumn("model", F.lit("hybrid"))
    p2 = cut_lineage(linear.score(dense.join(test_ids, "doc_id", "left_semi"), w2)).withColumn("model", F.lit("dense"))
    long_preds = p1.unionByName(p2)
    mean = ev.consensus_mean(long_preds).withColumnRenamed("consensus", "mean_consensus")
    vote = ev.consensus_vote(long_preds).withColumnRenamed("consensus", "vote_consensus")
    return mean.join(vote, "doc_id").select("doc_id", "vote_consensus", "real_share", "n_models", "mean_consensus")


QUERIES.update({
    "seeded_order": seeded_order,
    "hard_negative_corpus": hard_negative_corpus,
    "split_sources": split_sources,
    "prediction_cache": prediction_cache,
    "model_consensus": model_consensus,
})


# --- TXT-19, WIN-08, PRJ-06 ---------------------------------------------------------------


def sentiment_bias(spark, sf_dir):
    """TXT-19 over every document and conversation turn is the stream's lexicon score."""
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", q6(rl.sentiment_bias(F.col("text"))).alias("sentiment_bias"))


def first_sample_per_label(spark, sf_dir):
    """WIN-08: the first labelled article (smallest doc_id) of each class, with a 150-char excerpt."""
    a = corpus.articles(spark, sf_dir, labelled_only=True)
    w = _W.partitionBy("label").orderBy("doc_id")
    first = a.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") == 1)
    return first.select("doc_id", "label", F.substring("text", 1, 150).alias("excerpt"))


def cross_source_split(spark, sf_dir):
    """PRJ-06 + MLT-13 split: seen subjects train, held-out subjects test; the driver's sources
    match neither list, so the reference's fallback (random stratified split) applies."""
    a = corpus.articles(spark, sf_dir, labelled_only=True)
    s = linear.source_split(a, _lx.TRAIN_SUBJECTS, _lx.HELDOUT_SUBJECTS, fallback=True)
    return s.groupBy("split", "label").agg(F.count(F.lit(1)).alias("n_articles"))


QUERIES.update({"sentiment_bias": sentiment_bias, "first_sample_per_label": first_sample_per_label,
                "cross_source_split": cross_source_split})


# --- WIN-03 ---------------------------------------------------------------------------------
def explain_dense_ranked(spark, sf_dir):
    """WIN-03: every dense feature of every test article, ranked by the size of its contribution."""
    f = model_flow.fit(spark, sf_dir)
    test = f.docs.filter(F.col("split") == "test").select("doc_id")
    ranked = linear.ranked_dense_contributions(linear.contributions(f.hybrid.join(test, "doc_id", "left_semi"), f.weights))
    return ranked.select("doc_id", "feature", q6(F.col("contribution")).alias("contribution"), "rank")


QUERIES["explain_dense_ranked"] = explain_dense_ranked


# --- MLT-13, PRJ-07: held-out sources, exact shares ------------------------------------------
def _cross_source(spark, sf_dir, *parts):
    """Fit on train sources, threshold frozen on inner ones; the scored rows of ``parts`` with their source and text.
    Articles of other parts are left out before the join, which moves texts."""
    f = model_flow.fit(spark, sf_dir, model_flow.CROSS_SOURCE)
    threshold = model_flow.frozen_threshold(f)
    wanted = F.col("split").isin(*parts)
    sources = f.docs.filter(wanted).select("doc_id", F.coalesce("subject", F.lit("")).alias("source"), "title", "text")
    return threshold, f.scored.filter(wanted).join(sources, "doc_id")


def cross_source_eval(spark, sf_dir):
    """MLT-13: metrics on sources that the fit never saw, at the threshold that other unseen sources chose."""
    threshold, rows = _cross_source(spark, sf_dir, "inner", "test")
    out = None
    for part in ("inner", "test"):
        one = rows.filter(F.col("split") == part).select("doc_id", "label", "p_real", "source").persist()
        n, n_sources = one.agg(F.count(F.lit(1)), F.countDistinct("source")).first()
        m = ev.summary(one, threshold).select(F.lit(part).alias("part"), F.lit(n).cast("long").alias("n_articles"),
                                              F.lit(n_sources).cast("long").alias("n_sources"), F.lit(threshold).alias("threshold"), "*")
        out = m if out is None else out.unionByName(m)
    return out.select("part", "n_articles", "n_sources", "threshold", "accuracy", "precision", "recall", "f1", "fpr", "fnr",
                      "roc_auc", "status")


def cross_source_failures(spark, sf_dir):
    """MLT-13 + RUL-09/11: every misclassified article of the held-out sources, with category and rationale."""
    threshold, rows = _cross_source(spark, sf_dir, "test")
    e = (rows.withColumn("pred", (F.col("p_real") >= threshold).cast("int"))
         .filter(F.col("pred") != F.col("label"))
         .withColumn("category", rl.failure_category(F.col("text"), F.col("title"))))
    return e.select("doc_id", "source", "label", "pred", q6(F.col("p_real")).alias("p_real"), q6(1.0 - F.col("p_real")).alias("p_fake"),
                    "category", rl.failure_rationale(F.col("category")).alias("rationale"))


def source_folds(spark, sf_dir):
    """MLT-13: every source of ``documents`` in one of five folds of like size."""
    d = table(spark, sf_dir, "documents").select(F.coalesce("source", F.lit("")).alias("source"))
    return (d.join(splits.source_folds(d, "source"), "source").groupBy("source", "fold")
            .agg(F.count(F.lit(1)).alias("n_documents")))


def stratified_split(spark, sf_dir):
    """PRJ-07: a test share of each class that is exact to one row."""
    return splits.stratified_split(table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label")))


QUERIES.update({"cross_source_eval": cross_source_eval, "cross_source_failures": cross_source_failures,
                "source_folds": source_folds, "stratified_split": stratified_split})


# --- SRC-11, MLT-10: stored models, several at once ------------------------------------------
def registry_scores(spark, sf_dir):
    """SRC-11 + MLT-10 + AGG-15: two models and the threshold of unseen sources stored under a manifest, read back,
    and applied to the raw text of every labelled article."""
    f = model_flow.fit(spark, sf_dir, model_flow.CROSS_SOURCE)
    features = selftrain.FeatureModel(f.vocabulary, f.selected, f.stats, f.weights)
    found = {"hybrid": [models.Member(weights=f.weights)], "dense": [models.Member(weights=model_flow.dense_only_weights(f))]}
    stored = models.Registry(features, found, inputs=model_flow.input_state(spark, sf_dir))
    # the threshold is chosen for the mean of the models, on sources that trained neither
    inner = f.docs.filter(F.col("split") == "inner")
    p = stored.decide(stored.score(inner)).join(inner.select("doc_id", "label"), "doc_id")
    stored.threshold = float(ev.best_threshold(ev.threshold_sweep(p.select("doc_id", "label", "p_real").persist())).first()["best_threshold"])
    path = shared_dir(spark, f"credlens/registry/{uuid.uuid4().hex}")
    stored.save(path)
    back = models.Registry.load(spark, path)
    return back.decide(back.score(f.docs)).select("doc_id", q6(F.col("hybrid")).alias("p_hybrid"), q6(F.col("dense")).alias("p_dense"),
                                                  q6(F.col("p_real")).alias("p_real"), "pred", F.lit(back.threshold).alias("threshold"))


# --- STR-10: mine, replay, retrain -------------------------------------------------------------
def replay_retrain(spark, sf_dir):
    """STR-10: the misses on the test articles are written as failure records, read back, replayed into the train
    rows and the model is fitted again from merged statistics; errors before and after."""
    f = model_flow.fit(spark, sf_dir)
    base = shared_dir(spark, f"credlens/replay/{uuid.uuid4().hex}")
    state = replay.FitState(spark, base + "/state")
    state.add(f.docs, 0)
    before = state.refit()
    errors = _errors(before).withColumn("url", F.lit(None).cast("string"))
    test = before.hybrid.join(errors.select("doc_id"), "doc_id", "left_semi")
    words = linear.top_word_contributions(linear.contributions(test, before.weights))
    rec.write_failures(rec.failure_records(errors, words), base + "/failures")
    train = before.docs.filter(F.col("split") == "train")
    state.add(replay.replay_rows(train, rec.read_failures(spark, base + "/failures")), 1)
    out = None
    for phase, fitted in (("before", before), ("after", state.refit())):
        n_train = fitted.docs.filter(F.col("split") == "train").count()
        one = replay.judged(fitted).select(F.lit(phase).alias("phase"), F.lit(n_train).cast("long").alias("n_train"), "n_test", "n_errors",
                                           q6(F.col("accuracy")).alias("accuracy"), q6(F.col("log_loss")).alias("log_loss"))
        out = one if out is None else out.unionByName(one)
    return out


QUERIES.update({"registry_scores": registry_scores, "replay_retrain": replay_retrain})


# --- STR-09 / SRC-05: epochs over stored chunks ------------------------------------------------
def chunked_epochs(spark, sf_dir, n_chunks: int = 3, n_epochs: int = 2):
    """STR-09 / SRC-05: weights after two epochs over three stored chunks, one online step per chunk."""
    f = model_flow.fit(spark, sf_dir)
    path = shared_dir(spark, f"credlens/epochs/{uuid.uuid4().hex}")
    train = f.docs.filter(F.col("split") == "train").select("doc_id", "label")
    epochs.store_chunks(f.hybrid, train, n_chunks, path)
    return epochs.train(spark, path, n_chunks, n_epochs).select("feature", q6(F.col("weight")).alias("weight"))


# --- MLT-10 in a stream, AGG-22: latency and throughput -----------------------------------------
def stream_progress(spark, sf_dir):
    """AGG-22: every document decided by a stored model in a stream; rows and latency of each micro-batch as the
    listener saw them, beside the rows that the batch wrote."""
    f = model_flow.fit(spark, sf_dir)
    base = shared_dir(spark, f"credlens/progress/{uuid.uuid4().hex}")
    features = selftrain.FeatureModel(f.vocabulary, f.selected, f.stats, f.weights)
    models.Registry(features, {"hybrid": [models.Member(weights=f.weights)]}).save(base + "/registry")
    selftrain.stage_source(corpus.articles(spark, sf_dir), base + "/source")
    with progress.ProgressLog(spark, base + "/progress"):
        models.score_stream(spark, base + "/source", base + "/registry", base + "/sink", base + "/checkpoint").awaitTermination()
    log = progress.batches(spark, base + "/progress")
    written = spark.read.parquet(base + "/sink").groupBy("batch_id").agg(F.count(F.lit(1)).alias("n_decided"), F.sum("pred").alias("n_real"))
    return log.join(written.withColumn("batch_id", F.col("batch_id").cast("long")), "batch_id", "left").select(
        "batch_id", "input_rows", "n_decided", "n_real", (F.col("trigger_ms") > 0).alias("timed"), (F.col("rows_per_second") > 0).alias("rated"))


# --- JON-04, JON-06, RUL-01, RUL-02 with evidence, RUL-10 -----------------------------------------
def evidence_audit(spark, sf_dir):
    """E2 with evidence over every labelled article: benchmark passages that share a sentence with it are its
    ranked evidence and its reference pages (the likeness of sentences is left to ``integrity_matches``)."""
    f = model_flow.fit(spark, sf_dir)
    articles = f.docs.select("doc_id", "title", "text").join(f.scored.select("doc_id", (F.col("p_real") * 100.0).alias("ml")), "doc_id")
    passages = table(spark, sf_dir, "benchmark").select("item_id", "text")
    evidence = cut_lineage(audit_flow.passage_evidence(sim.shared_sentences(articles, passages), passages))
    pages = evidence.select("url", F.col("snippet").alias("text")).distinct()
    a = audit_flow.audit_with_evidence(articles.withColumn("url", F.lit("")), evidence, pages, check_sentences=False)
    wanted = audit_flow.wants_evidence(articles).select("doc_id", F.lit(True).alias("wanted"))
    return a.join(wanted, "doc_id", "left").select(
        "doc_id", F.coalesce("wanted", F.lit(False)).alias("wants_evidence"), F.col("n_results").cast("long").alias("n_results"), "fake_hits",
        "real_hits", "search_verdict", q6(F.col("hybrid")).alias("hybrid"), q6(F.col("final")).alias("final"), "reference_url", "verdict", "risk")


QUERIES.update({"chunked_epochs": chunked_epochs, "stream_progress": stream_progress, "evidence_audit": evidence_audit})


# --- SRC-03 + PRJ-02, PAG-08/09 ------------------------------------------------------------------
def training_projection(spark, sf_dir):
    """SRC-03: the (clean_text, label) projection of the labelled corpus, written by label and read back."""
    path = shared_dir(spark, f"credlens/projection/{uuid.uuid4().hex}")
    corpus.write_projection(model_flow.fit(spark, sf_dir).docs, path)
    return spark.read.parquet(path).select("clean_text", F.col("label").cast("int").alias("label"))


def page_text_stats(spark, sf_dir):
    """PAG-08/09: word count, length, reading time and quality flag of every page's text without its tags."""
    p = table(spark, sf_dir, "pages").select("page_id", F.regexp_replace("html", "<[^>]*>", " ").alias("text"), F.lit(None).cast("string").alias("error"))
    return pg.with_page_stats(p).select("page_id", "word_count", "article_length", q6(F.col("reading_time")).alias("reading_time"),
                                        F.col("poor_quality").cast("int").alias("poor_quality"))


QUERIES.update({"training_projection": training_projection, "page_text_stats": page_text_stats})


# --- SRC-12 ----------------------------------------------------------------------------------------
def cross_source_report(spark, sf_dir):
    """SRC-12: the Markdown report of the held-out sources, written to the shared folder and read back by line."""
    path = shared_dir(spark, f"credlens/reports/{uuid.uuid4().hex}")
    failures = cross_source_failures(spark, sf_dir).persist()
    metrics = cross_source_eval(spark, sf_dir).filter(F.col("part") == "test")
    counts = failures.groupBy("category").agg(F.count(F.lit(1)).alias("n"))
    samples = failures.orderBy("doc_id").select("doc_id", "source", "label", "p_real", "category", "rationale")
    text = reports.generalisation_report(metrics) + "\n" + reports.failure_category_report(counts, samples)
    reports.write_report(spark, text, path)
    return spark.read.text(path).select(F.col("value").alias("line")).filter(F.col("line") != "")


QUERIES["cross_source_report"] = cross_source_report
