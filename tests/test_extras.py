"""Corpus ingest/sinks, chunked multi-epoch training, review queue, report helpers."""
import json
import math
import os
import tempfile

from pyspark.sql import functions as F

from credlens.functions import rules as rl
from credlens.operators import dedup, linear
from credlens.sources import corpus, records
from credlens.streaming import selftrain


def test_csv_ingest_stage_and_sink(spark):
    d = tempfile.mkdtemp(prefix="credlens-csv-")
    with open(os.path.join(d, "true.csv"), "w") as f:
        f.write('title,text,subject,date\n"A","line one\nline two, with comma",politicsNews,"Dec 1"\n')
    with open(os.path.join(d, "fake.csv"), "w") as f:
        f.write('title,text,subject,date\nB,"fake ""quoted"" text",politics,x\n')
    real = corpus.read_labelled_csv(spark, os.path.join(d, "true.csv"), 1)
    fake = corpus.read_labelled_csv(spark, os.path.join(d, "fake.csv"), 0)
    staged = corpus.stage_corpus(real, fake)
    rows = {r.label: r for r in staged.collect()}
    assert rows[1].text == "line one\nline two, with comma" and rows[0].text == 'fake "quoted" text'
    out = os.path.join(d, "out")
    corpus.write_corpus(staged, out)
    assert sorted(os.listdir(out))[:2] == ["_SUCCESS", "label=0"] or "label=1" in os.listdir(out)
    rep = {r.label: r.n_rows for r in corpus.stage_report(staged).collect()}
    assert rep == {1: 1, 0: 1, None: 2}


def test_train_epochs_and_warm_start(spark):
    feats = spark.createDataFrame([(i, "x", float(i % 3)) for i in range(12)], "doc_id long, feature string, value double")
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)], "doc_id long, label int")
    w = linear.train_epochs(feats, labels, n_batches=3, epochs=2)
    got = {r.feature: r.weight for r in w.collect()}
    assert set(got) == {"x", linear.BIAS} and all(math.isfinite(v) for v in got.values())
    w2 = linear.online_step(feats, labels, w)  # warm start from the previous table
    assert set(r.feature for r in w2.collect()) == {"x", linear.BIAS}


def test_review_queue_resolution(spark):
    q = spark.createDataFrame([("t1", "a", 0.5, 0, 1.0), ("t2", "b", 0.6, 1, 2.0)],
                              "text string, title string, confidence double, predicted_label int, timestamp double")
    assert selftrain.latest_review(q).collect()[0].text == "t2"
    decisions = spark.createDataFrame([("t1", 1)], "text string, label int")
    resolved, still_open = selftrain.resolve_reviews(q, decisions)
    assert [r.text for r in resolved.collect()] == ["t1"] and [r.text for r in still_open.collect()] == ["t2"]


def test_replay_is_idempotent(spark):
    corpus_rows = spark.createDataFrame([("a", "known text", "x", 1)], "title string, text string, subject string, label int")
    fails = spark.createDataFrame([("b", "new text", 0), ("a", "known text", 1), ("b", "new text", 0)],
                                  "title string, text string, true_label int")
    once = dedup.replay_failures(corpus_rows, fails)
    twice = dedup.replay_failures(once, fails)
    assert once.count() == 2 and twice.count() == 2
    assert once.filter(F.col("text") == "new text").collect()[0].subject == "politics"


def test_failure_records_roundtrip(spark):
    d = tempfile.mkdtemp(prefix="credlens-fail-")
    errs = spark.createDataFrame([(1, "T", "some text", "http://x", 1, 0, 0.9)],
                                 "doc_id long, title string, text string, url string, pred int, label int, p_real double")
    words = spark.createDataFrame([(1, "fake", 1, "w1"), (1, "real", 1, "w2"), (1, "fake", 2, "w3")],
                                  "doc_id long, direction string, rank long, feature string")
    records.write_failures(records.failure_records(errs, words), d)
    # a pretty-printed single-record file, as another writer would produce
    with open(os.path.join(d, "failure_1_abc.json"), "w") as f:
        f.write('{\n  "title": "P",\n  "text": "pretty",\n  "url": "u",\n  "predicted_label": 1,\n'
                '  "true_label": 0,\n  "confidence": 0.7,\n  "top_contributing_features": ["a"],\n'
                '  "failure_reason": "r",\n  "timestamp": 5\n}\n')
    with open(os.path.join(d, "broken.json"), "w") as f:
        f.write("{not json")
    back = {r.text: r for r in records.read_failures(spark, d).collect()}
    assert set(back) == {"some text", "pretty"}
    assert back["some text"].top_contributing_features == ["w1", "w3", "w2"]
    assert math.isclose(back["some text"].confidence, 0.9)


def test_failure_reader_layouts(spark, tmp_path):
    """One pass over every layout: lines, pretty records, arrays, CRLF, no last line break, broken records."""
    def record(text, **more):
        return {"title": "T {x}", "text": text, "url": None, "predicted_label": 1, "true_label": 0, "confidence": 0.5,
                "top_contributing_features": ["a", "b"], "failure_reason": "r", "timestamp": 7} | more

    lines = [record("line one\n{ still text }"), record("line two"), record("line two")]
    files = {
        "lines.json": "\n".join(json.dumps(r) for r in lines),
        "crlf.json": "\r\n".join(json.dumps(record(t)) for t in ("crlf one", "crlf two")) + "\r\n",
        "pretty.json": "\n".join(json.dumps(record(t, extra={"k": [1, {"z": 2}]}), indent=2) for t in ("pretty one", "pretty two")),
        "array.json": json.dumps([record("array one"), record("array two")], indent=2),
        "cut.json": json.dumps(record("before the cut")) + "\n" + json.dumps(record("cut off"))[:-1] + "\n" + json.dumps(record("after the cut")),
        "cut_pretty.json": json.dumps(record("cut off"), indent=2)[:-1],
        "typed.json": json.dumps(record("wrong type", true_label="no")),
        "missing.json": json.dumps({"title": "no text", "true_label": 1}) + "\n{}\n\n[]\nnull",
        "empty.json": "",
    }
    for name, content in files.items():
        (tmp_path / name).write_bytes(content.encode())
    back = records.read_failures(spark, str(tmp_path)).collect()
    assert sorted(r.text for r in back) == sorted([
        "line one\n{ still text }", "line two", "crlf one", "crlf two", "pretty one", "pretty two",
        "array one", "array two", "before the cut", "after the cut"])
    assert all((r.title, r.predicted_label, r.true_label, r.confidence, r.top_contributing_features, r.timestamp)
               == ("T {x}", 1, 0, 0.5, ["a", "b"], 7) for r in back)


def test_rules_helpers(spark):
    df = spark.createDataFrame([("Great truth but fake hoax", ["alpha", "beta", "gamma", "delta"], 1.0, 0.3)],
                               "t string, w array<string>, ep double, ld double")
    r = df.select(rl.sentiment_bias(F.col("t")).alias("s"),
                  rl.contributing_features(F.col("w"), F.col("ep"), F.col("ld")).alias("c")).collect()[0]
    assert math.isclose(r.s, 0.0)  # great, truth vs fake, hoax
    assert r.c == ['"ALPHA"', '"BETA"', '"GAMMA"', "Excessive punctuation usage", "Repetitive style keywords"]
    e = spark.createDataFrame([([], 0.0, 0.9)], "w array<string>, ep double, ld double")
    assert e.select(rl.contributing_features(F.col("w"), F.col("ep"), F.col("ld"))).collect()[0][0] == [
        "General news vocabulary"]


def test_source_split_fallback(spark):
    a = spark.createDataFrame([(1, "politicsNews"), (2, "worldnews"), (3, "other")], "doc_id long, subject string")
    s = {r.doc_id: r.split for r in linear.source_split(a, ["politicsNews"], ["worldnews"]).collect()}
    assert s == {1: "train", 2: "test"}
    f = linear.source_split(a, ["nope"], ["worldnews"], fallback=True).collect()
    assert len(f) == 3 and all(r.split in ("train", "test") for r in f)
