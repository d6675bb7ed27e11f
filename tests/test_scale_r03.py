"""Steps that grew faster than their input: what is shuffled, stored and kept in memory by them."""
import math
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from credlens.functions import stylometry as st
from credlens.functions import text as tx
from credlens.operators import batchfit as bf
from credlens.operators import epochs, knn, learners, linear, similarity, splits, vocab
from credlens.plans import model_flow, queries
from credlens.session import cut_lineage
from credlens.sources import corpus, pages
from credlens.streaming import selftrain


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_stored_tables_of_different_partitionings_meet(spark):
    """a stored table has a known size and claims no partitioning that its files do not have."""
    rows = spark.range(200).select((F.col("id") % 50).alias("k"), "id")
    one = cut_lineage(rows.repartition(8, "k").groupBy("k").agg(F.sum("id").alias("a")))
    assert int(str(one._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) < 1 << 20
    assert "hashpartitioning" not in one._jdf.queryExecution().executedPlan().outputPartitioning().toString()
    two = cut_lineage(rows.repartition(3, "k").groupBy("k").agg(F.count("id").alias("b")))
    got = {r["k"]: (r["a"], r["b"]) for r in one.join(two, "k").collect()}
    assert got == {k: (sum(range(k, 200, 50)), 4) for k in range(50)}


def test_terms_are_counted_without_a_shuffle(spark):
    """a document's terms lie in one row."""
    docs = spark.createDataFrame([(1, "x", ["b", "a", "b", "a"]), (2, "y", ["c"]), (3, "y", [])], "doc_id long, split string, tokens array<string>")
    tf = vocab.term_frequencies(docs, keep=["split"])
    assert "Exchange" not in _plan(tf)
    assert {(r["doc_id"], r["split"], r["term"], r["tf"]) for r in tf.collect()} == {
        (1, "x", "a", 2), (1, "x", "b", 2), (1, "x", "a b", 1), (1, "x", "b a", 2), (2, "y", "c", 1)}


def test_a_step_of_the_fit_joins_nothing(spark, monkeypatch):
    """whatever the number of steps, rows are dealt once; documents without a label and zeros are told apart."""
    rng = np.random.default_rng(3)
    x = rng.random((30, 3))
    rows = [(i, f"f{j}", float(x[i, j])) for i in range(30) for j in range(3)]
    rows += [(i, "zero", 0.0) for i in range(30)] + [(99, "f0", 5.0), (99, "other", 1.0)]
    y = (x[:, 0] > 0.5).astype(float)
    feats = spark.createDataFrame(rows, "doc_id long, feature string, value double")
    labels = spark.createDataFrame([(i, int(y[i])) for i in range(30)], "doc_id long, label int")
    joins, join = [], type(feats).join
    monkeypatch.setattr(type(feats), "join", lambda *a, **k: joins.append(1) or join(*a, **k))
    got = {r["feature"]: r["weight"] for r in linear.fit_logistic(feats, labels, steps=8, eta=0.5, alpha=0.01).collect()}
    assert len(joins) < 4
    z = np.column_stack([x, np.ones(30)])
    old = np.array([0.0, 0.0, 0.0, math.log(y.sum() / (30 - y.sum()))])
    ahead = old
    for k in range(8):
        g = z.T @ (1 / (1 + np.exp(-z @ ahead)) - y) / 30 + 0.01 * ahead * [1, 1, 1, 0]
        new = ahead - 0.5 * g
        ahead, old = new + (k + 1) / (k + 4) * (new - old), new
    assert set(got) == {"f0", "f1", "f2", "zero", linear.BIAS} and got["zero"] == 0.0
    assert np.allclose([got["f0"], got["f1"], got["f2"], got[linear.BIAS]], old, atol=1e-12)


def test_rows_do_not_move_to_meet_their_source(spark):
    """a few sources hold all rows; none becomes a task's key."""
    docs = spark.createDataFrame([(i, f"s{i % 3}") for i in range(60)], "doc_id long, subject string")
    split = splits.source_split(docs, k=3)
    assert "BroadcastHashJoin" in _plan(split) and "Exchange hashpartitioning" not in _plan(split)
    assert split.groupBy("subject").agg(F.countDistinct("split").alias("n")).filter("n <> 1").count() == 0


def test_staged_files_follow_the_rows_not_the_tasks(spark, tmp_path):
    """every staged file is a micro-batch."""
    rows = spark.range(0, 100, 1, 16).select(F.col("id").alias("doc_id"), F.lit("t").alias("title"), F.lit("x").alias("text"))
    for name, per_file, least, most in (("one", 1000, 1, 1), ("some", 30, 4, 7)):
        selftrain.stage_source(rows, str(tmp_path / name), per_file)
        files = list((tmp_path / name).glob("*.parquet"))
        assert least <= len(files) <= most
        assert spark.read.parquet(str(tmp_path / name)).select("doc_id").distinct().count() == 100


def test_one_product_answers_many_queries():
    """F16: as exact as one query at a time."""
    rng = np.random.default_rng(5)
    v = np.concatenate([rng.normal(size=(300, 6)), np.zeros((4, 6))])
    ids, queries = rng.permutation(304), np.concatenate([rng.normal(size=(20, 6)), v[:2], np.zeros((1, 6))])
    for q, (places, d) in zip(queries, knn._nearest_in(v, (v * v).sum(1), ids, queries, 9), strict=True):
        exact = np.sqrt(((v - q) ** 2).sum(1))
        assert list(places) == list(np.lexsort((ids, exact))[:9]) and np.array_equal(d, exact[places])


def test_pages_leave_a_worker_in_pieces(spark):
    """a worker holds a bounded number of pages, whatever the batch."""
    pdf = pd.DataFrame({"page_id": range(450), "url": "http://a/", "html": "<p>x</p>"})
    assert [len(p) for p in pages._extract_batches(iter([pdf]))] == [200, 200, 50]
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "10000")
        pages.extract_pages(spark.createDataFrame([(1, "u", "h")], "page_id long, url string, html string"))
        assert int(spark.conf.get(key)) <= pages.ARROW_ROWS
    finally:
        spark.conf.set(key, before)


def test_sentences_without_a_reference_do_not_move(spark):
    """documents' sentences meet the references' before any shuffle; repeats count once."""
    docs = spark.createDataFrame([(1, "One two three four. One two three four. Not shared at all."), (2, "Other words are here.")], "doc_id long, text string")
    refs = spark.createDataFrame([(7, "One two three four. More of it here.")], "item_id long, text string")
    found = similarity.shared_sentences(docs, refs)
    plan = _plan(found)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert plan.index("Exchange hashpartitioning") < plan.index("BroadcastHashJoin")  # the shuffle lies above the join
    assert [tuple(r) for r in found.collect()] == [(1, 7, 1)]


def test_a_batch_is_cleaned_once_by_all_tasks(spark):
    """the text of a micro-batch is cleaned once, and stored, whatever reads its features."""
    vocabulary = spark.createDataFrame([("alpha", 1.0), ("beta", 1.5)], "term string, idf double")
    model = selftrain.FeatureModel(vocabulary, vocabulary.select("term"), {c: (0.0, 1.0) for c in st.FEATURE_COLUMNS}, linear.zero_weights(spark))
    docs = spark.createDataFrame([(1, "t", "alpha beta alpha gamma"), (2, "t", ""), (3, None, "beta")], "doc_id long, title string, text string")
    feats = selftrain.featurise(docs, model)
    # the cleaner's word pattern is in no plan that reads the features
    assert "[a-z]{3,15}" not in feats._jdf.queryExecution().optimizedPlan().toString()
    got = {(r["doc_id"], r["feature"]): r["value"] for r in feats.filter("not startswith(feature, 'dense:')").collect()}
    a, b = (1 + math.log(2)) * 1.0, 1.5
    assert set(got) == {(1, "alpha"), (1, "beta"), (3, "beta")}
    assert math.isclose(got[1, "alpha"], a / math.hypot(a, b)) and math.isclose(got[3, "beta"], 1.0)


def _learner_table(spark, n=240):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(n, 4))
    y = (x[:, 0] - x[:, 1] + 0.5 * rng.normal(size=n) > 0).astype(int)
    feats = spark.createDataFrame([(i, f"f{j}", float(x[i, j])) for i in range(n) for j in range(4)], "doc_id long, feature string, value double")
    return learners.Table(feats, spark.createDataFrame([(i, int(y[i]), "test" if i % 4 == 0 else "train") for i in range(n)],
                                                       "doc_id long, label int, split string"))


def test_learners_share_passes_and_run_side_by_side(spark, monkeypatch):
    """all linear learners are fitted by one call; forests and perceptrons do not wait for each other."""
    t = _learner_table(spark)
    calls, widths, fit_many, together, forest = [], [], bf.fit_many, learners.together, learners.random_forest
    monkeypatch.setattr(bf, "fit_many", lambda d, c, *a, **k: calls.append(len(c)) or fit_many(d, c, *a, **k))
    monkeypatch.setattr(learners, "together", lambda s, jobs, *a: widths.append(len(jobs)) or together(s, jobs, *a))
    monkeypatch.setattr(learners, "random_forest", lambda depth=5: forest(min(depth, 5), 5))
    monkeypatch.setattr(learners, "mlp", lambda n: learners.MultilayerPerceptronClassifier(layers=[n, 3, 2], maxIter=5, seed=1))
    found = learners.test_metrics_inputs(t)
    assert calls == [1 + 3 + 3 + 3 + 9] and max(widths) == 1 + 4 + 4 + 3
    assert set(found) == {"logreg", "random_forest", "neuralnet", "linear_svm", "calibrated_logreg", "calibrated_rf", "ensemble", "voting"}
    # what was fitted together is what each learner fits alone
    for name, alone in (("linear_svm", learners.calibrated_linear(t, learners.SVM_C, "squared_hinge", learners.SVM_ITERATIONS)),
                        ("calibrated_logreg", learners.calibrated_linear(t, learners.CALIBRATED_C)),
                        ("voting", learners.voting_ensemble(t))):
        a, b = ({r["doc_id"]: r["p_real"] for r in p.collect()} for p in (found[name], alone))
        assert a.keys() == b.keys() and len(a) == 60 and all(math.isclose(a[i], b[i], abs_tol=1e-9) for i in a), name


def test_limits_hold_per_candidate(spark):
    """candidates with different step limits share their passes."""
    cands = [bf.Candidate("a", "logistic", 1.0), bf.Candidate("b", "logistic", 1.0)]
    short, long = bf.fit_many(_learner_table(spark).design, cands, [2, 500])
    assert short.steps == 2 and not short.converged and long.converged


def test_a_learning_curve_deals_no_rows_again(spark, monkeypatch):
    """the curve cuts the blocks that every other learner reads; test rows neither train nor count."""
    t = _learner_table(spark)
    monkeypatch.setattr(bf, "design", lambda *a, **k: pytest.fail("dealt again"))
    rows = {r["fraction"]: r for r in learners.learning_curve(t, fractions=(0.4, 1.0)).collect()}
    c = bf.Candidate("c", "logistic", learners.LOGISTIC_C, fold_out=0, below=0.4)
    docs = t.docs.where("split = 'train'").withColumn("u", splits.hash_key(salt="curve:") / float(1 << 60))
    fit, = bf.fit_many(t.design, [c])
    assert fit.n_train == docs.where("u < 0.4 and fold <> 0").count() < bf.fit_many(t.design, [bf.Candidate("all")])[0].n_train == 180
    assert set(rows) == {0.4, 1.0} and all(0.7 < r["validation_accuracy"] <= 1.0 for r in rows.values())


def test_cleaning_passes_run_where_they_change_something(spark):
    """a text is translated once, and a pass runs on rows that hold its literal; results are those of all passes."""
    rows = ["", None, "plain words only here", "won't can't ain't y'all it's they\u2019re I'LL we'd don\u2018t o'clock 'tis", "washington (reuters) - the words follow",
            "(AP) x - first words", "see http://a.b/c and www.d.e now", "mail me@home.org or @you or a@", "text read more via somebody else\nnext line",
            "Soooo good!!! caf\u00e9 na\u00efve \u0130stanbul", "the bbc and cnn said", "HTTP://UP.CASE Read More Via X", "that's\u00a0it's  isn't"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "i int, text string").repartition(2)

    def plain(col):
        t = F.lower(F.translate(col, tx.lx.SMART_PUNCT_FROM, tx.lx.SMART_PUNCT_TO))
        for pattern, repl in tx.CONTRACTION_RULES:
            t = F.regexp_replace(t, pattern, repl)
        for pattern, repl in ((tx.REPEAT_RE, "$1$1"), (tx.NON_ASCII_RE, " "), (tx.FULL_DATELINE_RE, ""), (tx.PUBLISHER_RE, ""), (tx.READ_MORE_RE, ""),
                              (tx.ASCII_URL_RE, ""), (tx.EMAIL_RE, "")):
            t = F.regexp_replace(t, pattern, repl)
        toks = F.filter(F.regexp_extract_all(t, F.lit(tx.TOKEN_RE), 0), lambda w: ~w.isin(list(tx.lx.CLEANER_STOPWORDS)))
        return F.when(col.isNull() | (col == ""), F.array().cast("array<string>")).otherwise(toks)

    got = df.select("i", tx.full_clean_tokens(F.col("text")).alias("a"), plain(F.col("text")).alias("b")).collect()
    assert len(got) == len(rows) and all(r["a"] == r["b"] for r in got)
    assert str(tx.full_clean_tokens(F.col("text"))).count("translate(") == 1


def test_tokens_that_occur_once(spark):
    """counted without a struct per token."""
    rows = [["b", "a", "b", "c", "a", "a"], [], ["x"], ["x", "x"], ["q", "r", "s"]]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, w array<string>")
    count = st._hapax_count(F.sort_array("w"))
    assert "struct" not in str(count) and "arrays_zip" not in str(count)
    got = {r["i"]: r["n"] for r in df.select("i", count.alias("n")).collect()}
    assert got == {i: sum(n == 1 for n in Counter(r).values()) for i, r in enumerate(rows)}


def test_a_search_finds_its_subset_once(spark, monkeypatch):
    """the subset of a search and its features are stored tables, not a search of all rows at each reading."""
    docs = spark.range(40).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("label"),
                                  F.when(F.col("id") < 30, "train").otherwise("test").alias("split"))
    hybrid = docs.select("doc_id", F.lit("f").alias("feature"), F.rand(1).alias("value"))
    monkeypatch.setattr(queries.model_flow, "fit", lambda *a: SimpleNamespace(docs=docs, hybrid=hybrid))
    t = queries._learner_table(spark, "", max_rows=12)
    plan = t.hybrid._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Sort" not in plan and "Limit" not in plan
    assert t.hybrid.count() == t.docs.count() == 12 and t.docs.where("split <> 'train' or doc_id >= 30").isEmpty()


def test_a_step_does_not_match_its_stored_rows_again(spark, monkeypatch, tmp_path):
    """a chunk holds the features of its labels alone; a step over it searches for them no more."""
    rng = np.random.default_rng(2)
    feats = spark.createDataFrame([(i, f"f{j}", float(rng.random())) for i in range(24) for j in range(3)], "doc_id long, feature string, value double")
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, label int")  # four documents have none
    epochs.store_chunks(feats, labels, 2, str(tmp_path))
    wanted = None
    for _ in range(2):
        for k in range(2):
            wanted = cut_lineage(linear.online_step(*epochs.chunk(spark, str(tmp_path), k), wanted))
    kinds, join = [], type(feats).join
    monkeypatch.setattr(type(feats), "join", lambda s, o, on=None, how=None: kinds.append(how) or join(s, o, on, how))
    got = epochs.train(spark, str(tmp_path), 2, 2)
    assert kinds and "left_semi" not in kinds
    a, b = ({r["feature"]: r["weight"] for r in w.collect()} for w in (got, wanted))
    assert a.keys() == b.keys() == {"f0", "f1", "f2", linear.BIAS} and all(math.isclose(a[f], b[f], abs_tol=1e-12) for f in a)


def _no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    return lambda: spark.conf.set(key, before)


def test_a_labelled_text_moves_once(spark, tmp_path):
    """hashes decide which row is a text's first; the rows then move once, to meet them."""
    docs = [(1, "one", "s", "en"), (2, "same", "s", "en"), (3, "same", "t", "en"), (4, "same", "u", "en"), (5, None, "s", "en"),
            (6, "six\nsix", None, "en"), (7, "seven a", "s", "en"), (7, "seven b", "s", "en"), (8, "", "s", None), (9, "twice", "s", "en"), (9, "twice", "s", "en")]
    spark.createDataFrame(docs, "doc_id long, text string, source string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    # 2 has no label, so 3 is the first of its text; 4 is a copy
    labels = [(3, 1), (4, 0), (5, 1), (6, None), (7, 0), (8, 1), (9, 1), (9, 1), (11, 1)]
    spark.createDataFrame(labels, "doc_id long, quality long").write.parquet(str(tmp_path / "labels.parquet"))
    wanted = [(3, "same", "same", "t", "en", 1), (6, "six", "six\nsix", None, "en", None), (7, "seven a", "seven a", "s", "en", 0),
              (7, "seven b", "seven b", "s", "en", 0), (8, "", "", "s", None, 1), (9, "twice", "twice", "s", "en", 1)]
    assert sorted(map(tuple, corpus.first_labelled_articles(spark, str(tmp_path)).collect()), key=lambda r: (r[0], r[1])) == wanted
    again = _no_broadcast(spark)
    try:
        found = corpus.first_labelled_articles(spark, str(tmp_path))
        assert _plan(found).count("Exchange hashpartitioning") == 2  # the rows and their pairs
        assert sorted(map(tuple, found.collect()), key=lambda r: (r[0], r[1])) == wanted
    finally:
        again()


def test_the_flow_stores_tokens_alone(spark, monkeypatch):
    """the clean text is not stored beside its tokens."""
    stored = []
    monkeypatch.setattr(model_flow, "cut_lineage", lambda df: stored.append(df.columns) or cut_lineage(df))
    docs = model_flow.labelled_docs(spark, "/root/testdata/sf0.001")
    assert "tokens" in stored[0] and "clean_text" not in stored[0]
    assert docs.where("clean_text <> array_join(tokens, ' ') or clean_text = '' or clean_text is null").isEmpty() and not docs.isEmpty()


def test_left_out_margins_meet_no_table(spark, monkeypatch):
    """the blocks know which rows are train rows and which candidate left them out."""
    t = _learner_table(spark)
    cands, fits = learners.descent_grid(t, 2)
    got = bf.margins(t.design, cands, fits, held_only=True, below=learners.TEST_PLACE)
    every = bf.margins(t.design, cands, fits).join(t.docs.where("split = 'train'").select("doc_id"), "doc_id", "left_semi")
    key = lambda r: (r["doc_id"], r["candidate"])
    a, b = sorted(got.collect(), key=key), sorted((r for r in every.collect() if r["fold"] == cands[r["candidate"]].fold_out), key=key)
    assert a == b and len(a) == 180 * len(cands) // 3
    monkeypatch.setattr(queries, "_learner_table", lambda *a: t)
    kinds, join = [], type(t.docs).join
    monkeypatch.setattr(type(t.docs), "join", lambda s, o, on=None, how=None: kinds.append(how) or join(s, o, on, how))
    out = queries.ml_grid_descent(spark, "").collect()
    assert "left_semi" not in kinds and len(out) == len(cands) and sum(r["n_held"] for r in out) == len(a)


def test_texts_of_other_parts_do_not_move(spark, monkeypatch):
    """only articles of the judged sources meet their scores; a miss needs the text of a test article."""
    parts = ["train", "train", "train", "inner", "test"]
    docs = spark.createDataFrame([(i, f"s{i % 5}", f"title {i}", f"text {i}", i % 2, parts[i % 5]) for i in range(60)],
                                 "doc_id long, subject string, title string, text string, label int, split string")
    scored = docs.select("doc_id", "label", "split", ((F.col("doc_id") % 3) / 2).alias("p_real"))
    fitted = SimpleNamespace(docs=cut_lineage(docs), scored=cut_lineage(scored))
    monkeypatch.setattr(queries.model_flow, "fit", lambda *a: fitted)
    monkeypatch.setattr(queries.model_flow, "frozen_threshold", lambda f: 0.5)
    again = _no_broadcast(spark)
    try:
        for names, n in ((("test",), 12), (("inner", "test"), 24)):
            _, rows = queries._cross_source(spark, "", *names)
            assert rows.count() == n and {r["split"] for r in rows.select("split").distinct().collect()} == set(names)
            plan = _plan(rows)
            side = next(p for p in plan.split("Exchange")[1:] if "subject" in p)  # below the exchange of the texts
            assert "test" in side.split("FileScan")[0] and "split" in side.split("FileScan")[0]
        got = {r["doc_id"]: r["source"] for r in queries.cross_source_failures(spark, "").collect()}
    finally:
        again()
    assert got == {i: "s4" for i in range(4, 60, 5) if int(i % 3 >= 1) != i % 2}
