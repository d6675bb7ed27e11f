"""Tree BPE, token files, packing: against the tokenizers library and exact round trips."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from credlens.llm import bpe, packing, registry, tokenfile
from credlens.llm.common import tokenizer_path

WORD, BYTE = "word_bpe_49k.json", "byte_bpe_50k.json"
SF = "/root/testdata/sf0.001"
ODD = "doc_id long, text string, score string, ids int"
ODD_ROWS = [(None, "a b", "x", 1), (None, None, None, None), (5, "", "", 2), (5, "it's A  test\n", "q", 3), (5, "it's A  test\n", "q", 3),
            (-7, "é" * 900 + " 12ab<|endoftext|>!", "y", 4), (9, "word " * 3000, "", 5)]


def library(name):
    return Tokenizer.from_file(tokenizer_path(name))


@pytest.mark.parametrize("name", [WORD, BYTE])
@given(parts=st.lists(st.sampled_from(["a", "th", "ing", " ", "  ", "\n", "'s", "'", "!", "é", "́", "12", "<|endoftext|>",
                                       "Z", "日本", "\t", "'re", "x　", "\x1c", "\x85", "ß", "İ", "×"]), max_size=60),
       leaf=st.sampled_from([5, 23, 10_000]))
@settings(max_examples=120, deadline=None)
def test_tree_encoding_is_the_librarys(name, parts, leaf):
    text = "".join(parts)
    want = library(name).encode(text, add_special_tokens=False).ids
    assert bpe.encode_texts([text], tokenizer_path(name), leaf)[0].tolist() == want


@pytest.mark.parametrize("name", [WORD, BYTE])
def test_unsplit_runs(name):
    random.seed(4)
    texts = ["ab" * 900, "a" * 1500, "'" * 300 + "s", "1" * 200, "".join(random.choice("abcdefgh") for _ in range(3000))]
    lib = library(name)
    for got, t in zip(bpe.encode_texts(texts, tokenizer_path(name), 64), texts, strict=True):
        assert got.tolist() == lib.encode(t, add_special_tokens=False).ids


def test_encoder_forgets_and_goes_on():
    enc = bpe.Encoder(tokenizer_path(WORD), remember=50)
    lib = library(WORD)
    for k in range(4):
        texts = [f"word{k}{i} alpha beta{i}" for i in range(40)]
        for got, t in zip(enc.encode(texts), texts, strict=True):
            assert np.frombuffer(got, enc.dtype).tolist() == lib.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("spread", [200, 10**9])
def test_encode_table(spark, spread):
    df = spark.createDataFrame(ODD_ROWS, ODD)
    lib = library(WORD)
    got = bpe.encode(df, tokenizer_path(WORD), leaf=64, spread=spread).collect()
    want = sorted((str(r[0]), lib.encode(r[1] or "", add_special_tokens=False).ids) for r in ODD_ROWS)
    assert sorted((str(r["doc_id"]), np.frombuffer(r["ids"], "<u4").tolist()) for r in got) == want
    assert bpe.encode(df.limit(0), tokenizer_path(WORD)).count() == 0
    back = bpe.decode(bpe.encode(df, tokenizer_path(WORD)), tokenizer_path(WORD))
    assert sorted(r["decoded"] for r in back.collect()) == sorted(lib.decode(w, skip_special_tokens=False) for _, w in want)


def test_op7_query(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    lib = library(WORD)
    rows = registry.op7_tree_bpe(spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = lib.encode(docs[r["doc_id"]] or "", add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_perfect_hash_is_minimal_and_tells_foreign_keys():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(-2**62, 2**62, 20_000))
    h = tokenfile.key_hash(keys, np.zeros(len(keys), bool))
    mph = tokenfile.PerfectHash.build(h)
    assert sorted(mph.slots(h).tolist()) == list(range(len(keys)))
    raw = tokenfile.write_shard(keys.tolist(), [np.array([i % 7], "<u2").tobytes() for i in range(len(keys))], 2)
    shard = tokenfile.Shard(memoryview(raw))
    first, count = shard.find(keys, np.zeros(len(keys), bool))
    assert first.tolist() == list(range(len(keys))) and (count == 1).all()
    foreign = np.setdiff1d(rng.integers(-2**62, 2**62, 20_000), keys)
    assert (shard.find(foreign, np.zeros(len(foreign), bool))[1] > 0).mean() < 1e-3


def test_token_files(spark):
    df = spark.createDataFrame(ODD_ROWS, ODD)
    path = tokenfile.write(df, tokenfile.new_path(spark, "t"), tokenizer_path(WORD), shard_chars=500)
    lib = library(WORD)
    want = sorted((str(r[0]), lib.encode(r[1] or "", add_special_tokens=False).ids + [1]) for r in ODD_ROWS)
    rows = tokenfile.read(spark, path).collect()
    assert sorted((str(r["doc_id"]), np.frombuffer(r["ids"], "<u4").tolist()) for r in rows) == want
    man = tokenfile.manifest(spark, path).collect()
    assert sum(r["n_docs"] for r in man) == len(ODD_ROWS) and len(man) > 1
    hit = tokenfile.lookup(spark, path, [5, -7, 123456]).collect()
    assert sorted(r["doc_id"] for r in hit) == [-7, 5, 5, 5]
    empty = tokenfile.write(df.limit(0), tokenfile.new_path(spark, "t"), tokenizer_path(WORD))
    assert tokenfile.read(spark, empty).count() == 0


def test_token_files_of_one_key(spark):
    """Most rows have one id, or none: their key spans shards and files, and all of them are found."""
    rows = [(7, f"text {i} " * 9) for i in range(150)] + [(None, "the same words")] * 100 + [(9, "nine"), (-3, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    path = tokenfile.write(df, tokenfile.new_path(spark, "t"), tokenizer_path(WORD), shard_chars=400)
    lib = library(WORD)
    want = sorted((str(i), lib.encode(t or "", add_special_tokens=False).ids + [1]) for i, t in rows)
    docs = tokenfile.read(spark, path)
    assert sorted((str(r["doc_id"]), np.frombuffer(r["ids"], "<u4").tolist()) for r in docs.collect()) == want
    man = tokenfile.manifest(spark, path)
    assert man.where("min_key = 7").count() > 3 and max(r["n_docs"] for r in man.collect()) < 50
    placed = docs.join(man.select("file", "shard_no", "first_token"), ["file", "shard_no"]).collect()
    ends = sorted((r["first_token"] + r["local_start"], r["n_tokens"], r["doc_id"] is not None, r["doc_id"] or 0) for r in placed)
    assert [e[0] for e in ends] == [0, *np.cumsum([e[1] for e in ends])[:-1].tolist()] and [e[2:] for e in ends] == sorted(e[2:] for e in ends)
    assert sorted(r["doc_id"] for r in tokenfile.lookup(spark, path, [7, 9]).collect()) == [7] * 150 + [9]


def test_op4_query(spark):
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    lib, start, want = library(WORD), 0, []
    for i, t in docs:
        ids = lib.encode(t or "", add_special_tokens=False).ids + [1]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = registry.op4_perfect_hash_ids(spark, SF).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, got)) == want


def check_pieces(rows, docs, lib, window):
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault((r["doc_id"], r["doc_tokens"]), []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append(r)
    for own in by_seq.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= window and (at == window or at & (at - 1) == 0)
    want = {}
    for i, t in docs:
        ids = np.array(lib.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        want.setdefault((i, len(ids)), []).append(ids)
    assert by_doc.keys() == want.keys()
    for key, own in by_doc.items():
        assert sum(r["length"] for r in own) == sum(map(len, want[key]))
        if len(want[key]) == 1:
            at = 0
            for r in sorted(own, key=lambda r: r["start"]):
                assert r["start"] == at and r["ids_crc32"] == zlib.crc32(want[key][0][at:at + r["length"]].tobytes())
                at += r["length"]


def test_op6_query(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    check_pieces(registry.op6_bm25_packing(spark, SF).collect(), docs, library(BYTE), 1024)


def test_packing_odd_rows(spark):
    df = spark.createDataFrame(ODD_ROWS, ODD)
    rows = packing.pack(df, tokenizer_path(BYTE), window=64, shard_rows=3).collect()
    check_pieces(rows, [r[:2] for r in ODD_ROWS], library(BYTE), 64)
    assert packing.pack(df.limit(0), tokenizer_path(BYTE)).count() == 0


def test_packing_finds_neighbours_with_distant_ids(spark):
    """Pairs of like texts, 400 ids apart, over many shards."""
    rng = np.random.default_rng(3)
    names = ["".join(chr(97 + c) for c in rng.integers(0, 26, 5)) for _ in range(4000)]
    rows = []
    for i in range(200):
        own = [names[j] for j in rng.integers(0, 4000, 30)]
        for doc in (i, 400 + i):  # the same words in another order
            rows.append((doc, " ".join("and of the in to".split() * 2 + [own[j] for j in rng.permutation(30)])))
    rows.append((1000, rows[0][1]))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = packing.pack(df, tokenizer_path(BYTE), window=128, shard_rows=16).collect()
    check_pieces(got, rows, library(BYTE), 128)
    windows = {}
    for r in got:
        windows.setdefault(r["doc_id"], set()).add(r["sequence_id"])
    assert np.mean([bool(windows[i] & windows[400 + i]) for i in range(200)]) >= 0.9
    assert windows[1000] & windows[0]


def test_order_keeps_true_neighbours_together(spark):
    """Rests of forty topics, over whole queries: the true nearest rest mostly shares the shard."""
    rng = np.random.default_rng(8)
    n, size, shard = 1200, 4000, 100
    topics = [rng.integers(1, size, 60) for _ in range(40)]
    rests = [np.append(np.concatenate([rng.choice(topics[i % 40], 25), rng.integers(1, size, 8)]), 0).astype("<u2") for i in range(n)]
    held = np.zeros(size)
    for r in rests:
        held[np.unique(r)] += 1
    idf = np.log1p((n - held + 0.5) / (held + 0.5)).astype(np.float32)
    df = spark.createDataFrame([(i, i, bytearray(r.tobytes())) for i, r in enumerate(rests)], "doc_id long, node long, rest binary")
    packing.prepare(spark)
    placed = packing.ordered(df, idf, 30.0, "<u2", packing.work_dir(spark, "order")).orderBy("cell", "node").collect()
    at = {r["doc_id"]: k // shard for k, r in enumerate(placed)}
    assert len(at) == n
    weights = np.zeros((n, size))
    for i, r in enumerate(rests):
        tf = np.bincount(r, minlength=size)
        weights[i] = idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(r) / 30.0))
    found = []
    for i in range(0, n, 7):
        score = weights[:, np.unique(rests[i])].sum(1)
        score[i] = -1
        found.append(at[int(score.argmax())] == at[i])
    assert np.mean(found) >= 0.6  # one in twelve by chance


def test_order_splits_a_crowd_of_copies(spark):
    rows = [(i, i % 3, bytearray(np.array([5, 6, 7, 0], "<u2").tobytes())) for i in range(60)] + [(90, 9, bytearray(np.array([8, 0], "<u2").tobytes()))]
    df = spark.createDataFrame(rows, "doc_id long, node long, rest binary")
    packing.prepare(spark)
    got = packing.ordered(df, np.ones(10, np.float32), 3.0, "<u2", packing.work_dir(spark, "order"))
    assert got.count() == 61 and got.where("doc_id < 60").select("cell").distinct().count() == 1


def test_best_places_come_in_order():
    rng = np.random.default_rng(2)
    for n in (0, 1, 5, 40, 500):
        score = rng.integers(-1, 6, n).astype(float)
        want = [int(i) for i in np.argsort(-score, kind="stable") if score[i] >= 0]
        assert list(packing._best(score, first=4)) == want


def test_windows_hold_lexical_neighbours():
    """Rests of two vocabularies: a seed's window takes its own kind first."""
    rng = np.random.default_rng(0)
    rests = [rng.integers(0, 200, 100).astype("<u2") + (0 if i % 2 else 500) for i in range(40)]
    df = np.zeros(1000)
    for r in rests:
        df[np.unique(r)] += 1
    idf = np.log1p((40 - df + 0.5) / (df + 0.5)).astype(np.float32)
    pure = [len({r % 2 for r, _, _ in own}) == 1 for own in packing.pack_shard(rests, idf, 100.0, 400)]
    assert sum(pure) >= 0.8 * len(pure)


def test_bm25_scores_against_brute_force():
    rng = np.random.default_rng(5)
    rests = [rng.integers(0, 60, rng.integers(1, 80)).astype("<u2") for _ in range(30)]
    idf = rng.random(60).astype(np.float32)
    index = packing.Index(rests, idf, 40.0)
    for seed in range(30):
        for j, r in enumerate(rests):
            tf = np.bincount(r, minlength=60)
            want = sum(idf[q] * tf[q] * 2.2 / (tf[q] + 1.2 * (0.25 + 0.75 * len(r) / 40.0)) for q in np.unique(rests[seed]) if tf[q])
            assert index.scores(seed)[j] == pytest.approx(want, rel=1e-4, abs=1e-6)
