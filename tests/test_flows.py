"""Epochs over chunks, progress of streams, audits with evidence: against plain loops and hand-worked rows."""
import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from credlens.functions import rules as rl
from credlens.operators import epochs, linear, splits
from credlens.plans import audit_flow, reports
from credlens.session import shared_dir
from credlens.sources import corpus
from credlens.streaming import progress, selftrain


# ---- epochs -----------------------------------------------------------------------------------------

def test_epochs_equal_a_plain_loop_and_resume(spark):
    rng = np.random.default_rng(3)
    x, y = rng.random((30, 4)), rng.integers(0, 2, 30)
    features = spark.createDataFrame([(i, f"f{j}", float(x[i, j])) for i in range(30) for j in range(4)], "doc_id long, feature string, value double")
    labels = spark.createDataFrame([(i, int(v)) for i, v in enumerate(y)], "doc_id long, label int")
    path = shared_dir(spark, f"test-epochs-{os.getpid()}")
    epochs.store_chunks(features, labels, 3, path)
    chunk = {r["doc_id"]: r["c"] for r in labels.select("doc_id", splits.fold_column(3, salt="chunk:").alias("c")).collect()}
    # a step reads the folder of its chunk alone
    one, _ = epochs.chunk(spark, path, 1)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(chunk" in plan and {r["doc_id"] for r in one.collect()} == {i for i, c in chunk.items() if c == 1}
    got = {r["feature"]: r["weight"] for r in epochs.train(spark, path, 3, 2, eta=0.5, alpha=0.01).collect()}
    w = np.zeros(5)
    for _ in range(2):
        for c in range(3):
            rows = [i for i in range(30) if chunk[i] == c]
            r = 1 / (1 + np.exp(-(x[rows] @ w[:4] + w[4]))) - y[rows]
            w = w - 0.5 * (np.append(x[rows].T @ r, r.sum()) / len(rows) + 0.01 * np.append(w[:4], 0.0))
    assert all(math.isclose(got[f"f{j}"], w[j], abs_tol=1e-12) for j in range(4)) and math.isclose(got[linear.BIAS], w[4], abs_tol=1e-12)
    # another epoch goes on from the stored steps
    third = {r["feature"]: r["weight"] for r in epochs.train(spark, path, 3, 3, eta=0.5, alpha=0.01).collect()}
    fresh = shared_dir(spark, f"test-epochs-fresh-{os.getpid()}")
    epochs.store_chunks(features, labels, 3, fresh)
    whole = {r["feature"]: r["weight"] for r in epochs.train(spark, fresh, 3, 3, eta=0.5, alpha=0.01).collect()}
    assert third.keys() == whole.keys() and all(math.isclose(v, whole[k], abs_tol=1e-12) for k, v in third.items())


# ---- progress ---------------------------------------------------------------------------------------

def test_progress_counts_what_each_batch_read(spark, tmp_path):
    sizes = [5, 0, 7, 11]
    for k, n in enumerate(sizes):
        spark.range(n).selectExpr("id", f"{k} as file").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    log, sink = str(tmp_path / "log"), str(tmp_path / "out")
    with progress.ProgressLog(spark, log):
        q = (spark.readStream.schema("id long, file int").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
             .writeStream.queryName("counted").format("parquet").option("path", sink).option("checkpointLocation", str(tmp_path / "ck"))
             .trigger(availableNow=True).start())
        q.awaitTermination()
    rows = progress.batches(spark, log).collect()
    assert sorted(r["input_rows"] for r in rows) == [5, 7, 11] and {r["query"] for r in rows} == {"counted"}
    assert all(r["trigger_ms"] > 0 and r["add_batch_ms"] <= r["trigger_ms"] and r["rows_per_second"] > 0 for r in rows)
    s = progress.summary(progress.batches(spark, log)).first()
    assert (s["n_batches"], s["n_rows"]) == (3, 23) and s["rows_per_second"] > 0 and s["p95_latency_ms"] >= s["mean_latency_ms"] * 0.5
    # a query that runs after the listener left is not logged
    spark.readStream.schema("id long, file int").parquet(str(tmp_path / "in")).writeStream.format("noop").option(
        "checkpointLocation", str(tmp_path / "ck2")).trigger(availableNow=True).start().awaitTermination()
    assert progress.batches(spark, log).count() == 3


# ---- evidence ---------------------------------------------------------------------------------------

LONG = "The minister confirmed the new budget on Monday. " * 4
EVIDENCE = [  # doc_id, query_type, rank, title, url, snippet
    (1, "primary", 2, "Report", "u2", "officials confirmed it"), (1, "primary", 1, "Hoax alert", "u1", "a false rumor"),
    (1, "claim", 1, "Claim", "u9", "verified and true"), (2, "primary", 1, "t", "u3", "plain words"), (2, "primary", 1, "t", "u2", "plain words"),
    (3, "primary", 1, "t", "u1", "nothing"), (3, "primary", 2, "t", "gone", "nothing"), (4, "claim", 1, "Fake", "u2", "debunk hoax"),
    (6, None, 1, None, "u2", None)]
PAGES = [("u1", "too short"), ("u2", LONG), ("u3", LONG + " More."), ("u2", LONG), ("u9", LONG), ("u4", None)]
ARTICLES = [(i, f"title {i}", LONG if i != 5 else "A secret plan was leaked. " * 5, u, 60.0) for i, u in
            ((1, "https://www.reuters.com/x"), (2, "http://infowars.com/y"), (3, None), (4, ""), (5, "http://example.org"), (6, "http://a.gov/b"))]


@pytest.fixture(scope="module")
def tables(spark):
    return (spark.createDataFrame(ARTICLES, "doc_id long, title string, text string, url string, ml double"),
            spark.createDataFrame(EVIDENCE, "doc_id long, query_type string, rank int, title string, url string, snippet string"),
            spark.createDataFrame(PAGES, "url string, text string"))


def test_first_usable_reference(tables):
    _, evidence, pages = tables
    got = {r["doc_id"]: r["url"] for r in audit_flow.first_usable_reference(evidence, pages).collect()}
    # 1: rank 1 is too short; 2: a tie goes to the first url; 3: none usable; 4: claims do not count
    assert got == {1: "u2", 2: "u2", 6: "u2"}


def test_audit_with_evidence(tables):
    articles, evidence, pages = tables
    got = {r["doc_id"]: r for r in audit_flow.audit_with_evidence(articles, evidence, pages).collect()}
    assert len(got) == 6
    assert (got[1]["domain"], got[1]["domain_score"]) == ("reuters.com", 100) and got[4]["domain"] == "N/A" and got[6]["domain_score"] == 98
    one = got[1]
    # primary: hoax, false, rumor against confirmed; claim: verified, true
    assert (one["n_results"], one["fake_hits"], one["real_hits"], one["claim_fake_hits"], one["claim_real_hits"]) == (3, 3, 1, 0, 2)
    assert one["search_verdict"].startswith("REAL") and math.isclose(one["hybrid"], 60.0 - 8.0 * 2 * 0.4)
    assert one["match_pct"] == 100.0 and one["n_altered"] == 0 and one["final"] == 88.0  # every sentence is in the reference
    assert got[2]["hybrid"] == 60.0 and got[2]["reference_url"] == "u2" and got[2]["final"] == 88.0
    assert got[3]["reference_url"] is None and got[3]["final"] == got[3]["styled"] == 60.0
    assert math.isclose(got[4]["hybrid"], 60.0 - 40.0 * 0.4) and got[4]["search_verdict"].startswith("FAKE")  # the claim is fake
    # no evidence, a sensational word, and two indicators or more
    assert got[5]["n_results"] == 0 and got[5]["hybrid"] < 60.0 - 30.0 * 0.4 + 1e-9
    assert {r["verdict"] for r in got.values()} <= {"HIGH RISK MISINFORMATION", "VERIFIED AUTHENTIC CONTEXT"}


def test_altered_article_loses_score(spark, tables):
    _, evidence, pages = tables
    altered = LONG + "Aliens secretly wrote the entire document yesterday. Nobody was told about the hidden machine."
    articles = spark.createDataFrame([(2, "t", altered, "", 60.0)], "doc_id long, title string, text string, url string, ml double")
    r = audit_flow.audit_with_evidence(articles, evidence, pages).first()
    assert r["n_altered"] == 2 and math.isclose(r["match_pct"], 4 / 6 * 100) and math.isclose(r["final"], r["styled"] - min(30.0, (100 - 4 / 6 * 100) * max(0.2, (100 - r["styled"]) / 100)))


def test_search_verdict_and_trigger(spark):
    df = spark.createDataFrame([(1, 3, 1), (2, 1, 3), (3, 2, 2)], "i int, f int, r int")
    got = [r[0].split()[0] for r in df.orderBy("i").select(rl.search_verdict(F.col("f"), F.col("r"))).collect()]
    assert got == ["FAKE", "REAL", "INCONCLUSIVE"]
    rows = spark.createDataFrame([(1, "Nothing here", 51.0), (2, "He was arrested", 51.0), (3, "Nothing", 50.0), (4, None, 51.0)], "doc_id long, text string, ml double")
    assert sorted(r["doc_id"] for r in audit_flow.wants_evidence(rows).collect()) == [2, 3]
    assert audit_flow.wants_evidence(rows, F.lit(True)).count() == 4
    assert audit_flow.wants_evidence(rows, F.col("doc_id") == 4).count() == 3


def test_every_failure_category(spark):
    rows = [("A vaccine story", "t"), ("The senate voted", "t"), ("an anonymous insider", "t"), ("plain", "Shocking breaking alert"), ("plain", "t"), (None, None)]
    df = spark.createDataFrame(rows, "text string, title string").withColumn("c", rl.failure_category(F.col("text"), F.col("title")))
    got = [(r["c"], r["why"]) for r in df.withColumn("why", rl.failure_rationale(F.col("c"))).collect()]
    assert [c for c, _ in got] == ["health misinformation", "political misinformation", "satire / conspiracy", "clickbait", "general news bias", "general news bias"]
    assert len({w for _, w in got}) == 3 and all(w for _, w in got)


# ---- weight log -------------------------------------------------------------------------------------

def _weights(spark, **w):
    return spark.createDataFrame(list(w.items()), "feature string, weight double")


def test_weight_log_survives_an_update_that_was_not_written(spark):
    path = shared_dir(spark, f"test-log-{os.getpid()}")
    selftrain.write_weights(_weights(spark, a=1.0), path, 0, "initial")
    assert selftrain.next_version(spark, path, "batch:0") == (0, 1)
    selftrain._claim(spark, path, 1, "batch:0")  # the driver fails before the weights are there
    assert selftrain.weight_log(spark, path) == {"initial": 0} and selftrain.latest_weights(spark, path).first()["weight"] == 1.0
    assert selftrain.next_version(spark, path, "batch:0") == (0, 1)  # the batch again: its own version
    assert selftrain.next_version(spark, path, "feedback:7") == (0, 2)  # another update meanwhile
    selftrain.write_weights(_weights(spark, a=2.0), path, 2, "feedback:7")
    assert selftrain.next_version(spark, path, "batch:0") == (2, 3)  # and it is not lost
    selftrain.write_weights(_weights(spark, a=3.0), path, 3, "batch:0")
    assert selftrain.next_version(spark, path, "batch:0") == (2, 3)  # written already: the same result again
    assert selftrain.weight_log(spark, path) == {"initial": 0, "feedback:7": 2, "batch:0": 3}
    assert selftrain.latest_weights(spark, path).first()["weight"] == 3.0


def test_drift_and_shifts_equal_the_tables(spark):
    old, new = {"a": 1.0, "b": -2.0, "gone": 0.5, linear.BIAS: 0.25}, {"a": 1.5, "b": -2.0, "new": -0.5, linear.BIAS: -0.5}
    drift, shifts = linear.drift_and_shifts(old, new, 3)
    t = [spark.createDataFrame(list(w.items()), "feature string, weight double") for w in (old, new)]
    assert math.isclose(drift, linear.weight_drift(*t).first()[0])
    assert shifts == [r.asDict() for r in linear.top_shifts(*t, 3).collect()]


# ---- sinks ------------------------------------------------------------------------------------------

def test_projection_fills_nulls(spark, tmp_path):
    rows = spark.createDataFrame([("a b", 1, 5), (None, 0, 6), ("c", None, 7)], "clean_text string, label int, doc_id int")
    corpus.write_projection(rows, str(tmp_path / "p"))
    got = sorted((r["clean_text"], r["label"]) for r in spark.read.parquet(str(tmp_path / "p")).collect())
    assert got == [("", 0), ("a b", 1), ("c", 0)]


def test_reports_are_written_whole(spark, tmp_path):
    summary = spark.createDataFrame([(0.8, 0.75, 1.0, 0.8571, 13 / 24, 0.5, 0.0, "PASS")],
                                    "accuracy double, precision double, recall double, f1 double, roc_auc double, fpr double, fnr double, status string")
    counts = spark.createDataFrame([("general news bias", 3), ("clickbait", 5)], "category string, n long")
    text = reports.generalisation_report(summary) + "\n" + reports.failure_category_report(counts)
    reports.write_report(spark, text, str(tmp_path / "r"))
    assert "\n".join(r[0] for r in spark.read.text(str(tmp_path / "r")).collect()).strip() == text.strip()
    assert "- **Accuracy**: 80.00%" in text and "- **ROC-AUC**: 0.5417" in text
    assert text.index("| clickbait | 5 |") < text.index("| general news bias | 3 |")
