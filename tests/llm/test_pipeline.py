"""Stages of the pipeline against brute force on the planted rows of a small table."""

import random

import pytest

import corpus_pipeline as cp
from credlens.llm import pii
from credlens.llm.common import tokenizer_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string"


def prose(rng, words, n):
    return " ".join(rng.choice(words) for _ in range(n))


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    rng = random.Random(5)
    en = ["the", "of", "and", "to", "with", "from", "have", *("".join(rng.choice(["th", "in", "er", "on", "an"]) for _ in range(3)) for _ in range(150))]
    de = ["der", "die", "und", "nicht", "ein", "mit", *("".join(rng.choice(["sch", "ung", "ich", "kei", "au"]) for _ in range(3)) for _ in range(150))]
    rows, labels = [], []
    for i in range(160):
        lang, words = ("en", en) if i % 2 else ("de", de)
        text, toxic = prose(rng, words, rng.randint(20, 200)), i % 5 == 0
        if toxic:
            text += " you idiot moron " + prose(rng, words, 5) + " scum"
        rows.append((i, text, lang, "s", len(text), "x"))
        labels.append((i, 1, int(toxic)))
    near = rows[1][1].split()
    for i in range(200, 210):
        near = near[:-1] + [f"tail{i}"] if len(near) > 100 else rows[1][1].split()
        rows.append((i, rows[1][1], "en", "s", 1, None))
    rows += [(300, "call +1 (555) 555-1234 or a.b@example.com " + prose(rng, en, 60), "en", None, None, None), (301, None, None, None, None, None),
             (302, "", "en", "s", 0, "x"), (303, "123 456 !!!", None, "s", 3, "x"), (None, prose(rng, en, 40), "en", "s", 3, "x"),
             (304, prose(rng, en, 9000), "en", "s", 3, "x"), (304, prose(rng, en, 50), "en", "s", 3, "x")]
    d = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return str(d), spark.read.parquet(f"{d}/documents.parquet"), {i: t for i, _, t in labels}


def test_stages(spark, table):
    d, docs, toxic = table
    columns = docs.columns
    assert [n for n, _ in cp.STAGES] == ["toxicity", "language", "near_duplicates", "personal_data", "packing"]
    kept = cp.toxicity_stage(spark, docs, d)
    assert kept.columns == columns and kept.schema == docs.schema
    ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
    assert not [i for i in ids if toxic.get(i)] and len(ids) == docs.count() - sum(toxic.values())
    spoken = cp.language_stage(spark, kept, d)
    assert spoken.columns == columns
    gone = set(ids) - {r["doc_id"] for r in spoken.select("doc_id").collect()}
    assert gone == {301, 302, 303}
    single = cp.near_duplicate_stage(spark, spoken, d)
    assert single.columns == columns
    left = sorted(str(r["doc_id"]) for r in single.select("doc_id").collect())
    # the unrelated rows of id 304 both stay
    assert left == sorted(str(r["doc_id"]) for r in spoken.select("doc_id").collect() if r["doc_id"] not in range(200, 210))
    masked = cp.personal_data_stage(spark, single, d)
    assert masked.schema == docs.schema
    text = masked.where("doc_id = 300").first()["text"]
    assert text.startswith("call [PHONE] or [EMAIL] ") and not pii.base_spans(text)
    assert {r["text"] for r in masked.where("doc_id < 100").collect()} == {r["text"] for r in single.where("doc_id < 100").collect()}


def test_stages_take_empty_tables(spark, table):
    d, docs, _ = table
    empty = docs.limit(0)
    for _, stage in cp.STAGES:
        assert stage(spark, empty, d).count() == 0


def test_run(spark, table):
    from tokenizers import Tokenizer
    d, docs, _ = table
    rows = cp.run(spark, d).collect()
    lib = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    now = docs
    for _, stage in cp.STAGES[:-1]:
        now = stage(spark, now, d)
    want = sorted((str(r["doc_id"]), len(lib.encode(r["text"], add_special_tokens=False).ids) + 1) for r in now.collect())
    total = {}
    for r in rows:
        key = (str(r["doc_id"]), r["doc_tokens"])
        total[key] = total.get(key, 0) + r["length"]
    assert sorted(total) == want and all(n == k[1] for k, n in total.items())


def test_unrelated_rows_of_one_id_stay(spark):
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(300)]
    a, b, c = (prose(rng, words, 60) for _ in range(3))
    near = a.split()
    near[59] = "other"
    rows = [(1, a), (1, b), (2, a), (None, c), (None, c), (None, " ".join(near)), (3, None), (None, None), (None, ""), (4, ""), (5, "!")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1, "x") for i, t in rows], SCHEMA)
    got = [(r["doc_id"], r["text"]) for r in cp.near_duplicate_stage(spark, docs, "").collect()]
    want = [(1, a), (1, b), (None, c), (3, None), (None, None), (None, ""), (4, ""), (5, "!")]
    assert sorted(got, key=str) == sorted(want, key=str)
