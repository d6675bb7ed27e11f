"""Findings of round 4: how work is dealt, and that it is done once."""
import math
import types

from pyspark.sql import functions as F

from credlens.functions import stylometry as st
from credlens.functions import text as tx
from credlens.operators import learners, linear
from credlens.plans import model_flow, queries
from credlens.session import cut_lineage
from credlens.streaming import selftrain


def _plan(df):
    return df._jdf.queryExecution().toString()


def _model(spark):
    vocabulary = spark.createDataFrame([("alpha", 1.0), ("beta", 1.5)], "term string, idf double")
    weights = spark.createDataFrame([("alpha", 8.0), ("beta", -8.0), (linear.BIAS, 0.0)], "feature string, weight double")
    return selftrain.FeatureModel(vocabulary, vocabulary.select("term"), {c: (0.0, 1.0) for c in st.FEATURE_COLUMNS}, weights)


def test_a_batch_of_one_staged_file_is_dealt_to_all_tasks(spark, monkeypatch, tmp_path):
    """ids of one file share a remainder of Spark's hash; still the tasks that clean them all get rows."""
    rows = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("t").alias("title"), F.concat(F.lit("alpha beta "), "id").alias("text"))
    selftrain.stage_source(rows, str(tmp_path / "source"), 1000)
    file = next((tmp_path / "source").glob("*.parquet"))
    stored, cut = [], selftrain.cut_lineage
    monkeypatch.setattr(selftrain, "cut_lineage", lambda df: stored.append(df) or cut(df))
    tasks = selftrain.batch_tasks(spark)
    feats = selftrain.featurise(spark.read.parquet(str(file)), _model(spark), tasks=tasks)
    dealt = {r[0]: r[1] for r in stored[0].groupBy(F.spark_partition_id()).count().collect()}
    n = spark.read.parquet(str(file)).count()
    assert len(dealt) == tasks > 2 and max(dealt.values()) < 3 * n / tasks
    # the raw text goes no further than the pass that measures it
    assert "text" not in stored[0].columns and feats.filter("feature = 'dense:word_count'").agg(F.sum("value")).first()[0] == 3.0 * n


def test_a_batch_is_featurised_once(spark, monkeypatch, tmp_path):
    """F2: scores, step and gradient read stored features; the step does not search them for its rows again."""
    _model(spark).save(str(tmp_path / "state"))
    batch = spark.createDataFrame([(1, "t", "alpha alpha story"), (2, "t", "beta beta story"), (3, None, " "), (4, "t", "other words")], selftrain.INPUT_SCHEMA)
    seen, step = [], linear.online_step

    def kept(features, labels, weights, **k):
        seen.append((_plan(features), k, features.select("doc_id").distinct().count(), labels.count()))
        return step(features, labels, weights, **k)

    monkeypatch.setattr(linear, "online_step", kept)
    selftrain.process_batch(batch, 0, str(tmp_path / "state"))
    (plan, options, n_featurised, n_labelled), = seen
    assert "Window" not in plan.split("== Optimized Logical Plan ==")[0] and options["matched"] and n_featurised == n_labelled > 0
    row = selftrain.telemetry(spark, str(tmp_path / "state")).first()
    assert row.total_processed == 4 and row.pseudo_labeled == n_labelled and math.isfinite(row.parameter_drift_rate)


def test_consensus_holds_where_nothing_is_broadcast(spark, monkeypatch):
    """the predictions of two models, each dealt by document, are read by both consensus forms."""
    n = 40
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "test").otherwise("train").alias("split"))
    dense = spark.range(n).select(F.col("id").alias("doc_id"), *[(F.col("id") / n).alias(c) for c in st.FEATURE_COLUMNS])
    first = linear.DENSE_PREFIX + st.FEATURE_COLUMNS[0]
    weights = spark.createDataFrame([(first, 4.0), (linear.BIAS, -1.0)], "feature string, weight double")
    fitted = types.SimpleNamespace(docs=cut_lineage(docs), dense=cut_lineage(dense), hybrid=cut_lineage(linear.dense_long(dense)), weights=weights)
    monkeypatch.setattr(model_flow, "fit", lambda *_: fitted)
    monkeypatch.setattr(model_flow, "dense_only_weights", lambda f: f.weights)
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "-1")
        rows = {r["doc_id"]: r for r in queries.model_consensus(spark, "").collect()}
    finally:
        spark.conf.set(key, before)
    assert rows.keys() == set(range(0, n, 2)) and all(r["n_models"] == 2 for r in rows.values())
    assert all(math.isclose(r["mean_consensus"], 100 / (1 + math.exp(1 - 4 * i / n)), abs_tol=1e-5) for i, r in rows.items())


def test_vectors_are_dealt_by_their_rows(spark, monkeypatch):
    """every task of a pass sends sums as long as the model, so there are as many as the rows ask for, of like size."""
    monkeypatch.setattr(learners, "VECTOR_ROWS", 100)
    n = 390
    feats = spark.range(n).select(F.col("id").alias("doc_id"), F.explode(F.array(F.lit("a"), F.lit("b"))).alias("feature"), (F.col("id") + 1.0).alias("value"))
    docs = spark.range(n).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("label"),
                                 F.when(F.col("id") % 4 == 0, "test").otherwise("train").alias("split"))
    t = learners.Table(feats.repartition(8), docs)
    dealt = [r[1] for r in t.vectors.groupBy(F.spark_partition_id()).count().collect()]
    assert t.vectors.rdd.getNumPartitions() == len(dealt) == 4 and sum(dealt) == n and max(dealt) < 2 * n / 4
    assert learners.random_forest().getCacheNodeIds()


def test_articles_alone_wait_for_no_model(spark, monkeypatch):
    """a job that reads the flow's articles and fits models of its own does not fit the flow's model first."""
    docs = spark.createDataFrame([(1, "s")], "doc_id long, subject string")
    calls = []
    monkeypatch.setattr(model_flow, "_FITTED", {})
    monkeypatch.setattr(model_flow, "input_state", lambda *_: ())
    monkeypatch.setattr(model_flow, "labelled_docs", lambda *_: docs)
    made = model_flow.Fitted(docs, *["v", "s", "t", "d", "h", "w", "p"], {})
    monkeypatch.setattr(model_flow, "_fit", lambda *a: calls.append(a) or made)
    f = model_flow.fit(spark, "x")
    assert f.docs is docs and not calls
    assert (f.weights, f.scored, model_flow.fit(spark, "x").hybrid) == ("w", "p", "h") and len(calls) == 1


def test_features_of_tokens_are_those_of_the_clean_text(spark):
    """tokens that are at hand are not split from the clean text again; words are put in lower case once."""
    rows = ["", "  ", "AAA bbb aeiou aei x B2B", "The THE the!!! ??? \n\n \"q\" 'x' http://a www.b", "breaking act now you will not believe this shocking must read",
            "x" * 300 + " " + "e" * 300, "\u03a3\u0391\u03a3 \u0130stanbul caf\u00e9 \u00c9\u00c9\u00c9 \uff14\uff15", "why who why who cat dog cat cat"]
    df = spark.createDataFrame([(i, t, t) for i, t in enumerate(rows)], "doc_id long, text string, title string")
    df = df.withColumn("tokens", tx.full_clean_tokens(F.col("text"))).withColumn("clean_text", F.array_join("tokens", " "))
    split, given = st.with_dense_features(df, keep=["doc_id"]), st.with_dense_features(df.drop("clean_text"), keep=["doc_id"], tokens="tokens")
    assert sorted(split.collect()) == sorted(given.collect())
    words = [t.split() for t in rows]
    got = {r["doc_id"]: r for r in given.collect()}
    for i, w in enumerate(words):
        assert got[i]["word_count"] == len(w)
        assert math.isclose(got[i]["avg_word_len"], sum(map(len, w)) / max(len(w), 1))
        assert math.isclose(got[i]["stopword_ratio"], sum(x.lower() in tx.lx.STOPWORDS for x in w) / max(len(w), 1))
