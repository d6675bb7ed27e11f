"""N-gram Jaccard join, components, piecewise hashing, WARC index: against brute force."""

import collections
import hashlib
import random

import numpy as np
import pytest

from credlens.llm import ctph, graph, jaccard, registry, warc
from credlens.session import shared_dir

SF = "/root/testdata/sf0.001"


def shingles(text, n):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def brute(rows, n, num, den):
    sets = [shingles(t, n) for _, t in rows]
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    inverted = collections.defaultdict(list)
    for i, s in enumerate(sets):
        for j, c in collections.Counter(j for g in s for j in inverted[g]).items():
            if den * c >= num * (len(s) + len(sets[j]) - c):
                parent[top(i)] = top(j)
        for g in s:
            inverted[g].append(i)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[top(i)] = min(low.get(top(i), d), d)
    return sorted((str(d), len(sets[i]), str(low.get(top(i)) if sets[i] else d)) for i, (d, _) in enumerate(rows))


def planted():
    random.seed(3)
    vocabulary = [f"w{i}" for i in range(4000)]
    base = [random.choice(vocabulary) for _ in range(120)]
    rows = [(i, " ".join(random.choice(vocabulary) if random.random() < random.choice([0, .01, .02, .04]) else x for x in base))
            for i in range(130)]
    rows += [(1000 + i, " ".join(random.choice(vocabulary[:6]) for _ in range(random.randint(0, 14)))) for i in range(120)]
    rows += [(None, "a b c"), (None, "A b c"), (None, None), (7777, ""), (7778, "  "), (8888, "x"), (8889, "X\n"),
             (5, "Q " * 30), (5, None), (9000, "z" * 300 + " y"), (9001, "z" * 300 + " y")]
    return rows


@pytest.mark.parametrize("n, num, den", [(3, 90, 100), (5, 80, 100), (1, 50, 100)])
def test_components_equal_brute_force(spark, n, num, den):
    rows = planted()
    df = spark.createDataFrame([(d, t, "s", 1) for d, t in rows], "doc_id long, text string, node string, size int").repartition(5)
    got = jaccard.jaccard_components(df, n, num, den).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in got) == brute(rows, n, num, den)


def test_hot_block_without_links(spark):
    """Very many texts share columns but do not link: a hot block whose pairs all stay apart."""
    random.seed(8)
    shared = [f"s{i}" for i in range(60)]
    rows = [(i, " ".join(shared + [f"u{i}x{k}" for k in range(random.randint(8, 14))])) for i in range(150)]
    rows += [(500 + i, " ".join([*shared, f"v{i % 2}"])) for i in range(80)]
    got = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90, 100).collect()
    assert sorted((str(r[0]), r[1], str(r[2])) for r in got) == brute(rows, 3, 90, 100)


def brute_links(rows, n, num, den):
    """Number of other rows that each row links with, all pairs one by one."""
    sets = [shingles(t, n) for _, t in rows]
    out = [0] * len(rows)
    for i, a in enumerate(sets):
        for k in range(i):
            c = len(a & sets[k])
            if c and den * c >= num * (len(a) + len(sets[k]) - c):
                out[i] += 1
                out[k] += 1
    return sorted((str(d), len(s), k) for (d, _), s, k in zip(rows, sets, out, strict=True))


@pytest.mark.parametrize("n, num, den, block", [(3, 90, 100, 512), (5, 80, 100, 40), (1, 50, 100, 40), (2, 100, 100, 40)])
def test_number_of_links_equals_brute_force(spark, monkeypatch, n, num, den, block):
    """Hot groups of near copies, cold pairs, exact copies; blocks smaller than the groups as well."""
    monkeypatch.setattr(jaccard, "BLOCK", block)
    random.seed(12)
    words = [f"h{i}" for i in range(3000)]
    base = [random.choice(words) for _ in range(200)]
    rows = planted() + [(2000 + i, " ".join(base[:random.randint(150, 200)])) for i in range(150)]
    rows += [(3000 + i, " ".join(random.choice(words) if random.random() < .01 else w for w in base)) for i in range(100)]
    rows += [(4000 + i, rows[3 * i][1]) for i in range(40)]
    got = jaccard.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), n, num, den).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], r["n_links"]) for r in got) == brute_links(rows, n, num, den)
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in got) == brute(rows, n, num, den)


def test_hot_group_of_copies_stays_in_place(spark):
    """One text for a third of all rows: its rows are joined by broadcast, and all link with each other."""
    rows = [(i, "the very same text again and again") for i in range(400)] + [(1000 + i, f"text {i} of its own {i}") for i in range(800)]
    got = {r["doc_id"]: (r["component_id"], r["n_links"]) for r in
           jaccard.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90, 100).collect()}
    assert all(got[i] == (0, 399) for i in range(400)) and all(got[1000 + i] == (1000 + i, 0) for i in range(800))


def test_jaccard_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.jaccard_components(empty).count() == 0
    assert jaccard.jaccard_join(empty).count() == 0


def test_op9_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = registry.op9_ngram_jaccard(spark, SF).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in got) == brute(rows, 3, 90, 100)


def test_components_of_chains_and_stars(spark):
    random.seed(1)
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 260)] + [(3, 3)] + [(260, 100)] * 2
    random.shuffle(edges)
    out = graph.components(spark.createDataFrame(edges, "x long, y long"), shared_dir(spark, f"t/{random.random()}"))
    labels = {r["node"]: r["label"] for r in out.collect()}
    # 160 .. 100 - 260 is one chain; 7's star holds 200..259
    assert all(labels[i] == 100 for i in [*range(100, 161), 260]) and all(labels[i] == 7 for i in [7, *range(200, 260)])
    assert 3 not in labels


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_edit_distance_is_levenshtein():
    random.seed(2)
    letters = ctph.LETTERS.tobytes().decode()
    pairs = [("".join(random.choice(letters[:random.choice([3, 64])]) for _ in range(random.randint(0, 64))),
              "".join(random.choice(letters[:5]) for _ in range(random.randint(0, 64)))) for _ in range(150)]
    assert ctph.edit_distances(pairs).tolist() == [levenshtein(*p) for p in pairs]


def test_fingerprints_do_not_depend_on_their_neighbours():
    random.seed(6)
    texts = [None, "", "a", *("".join(random.choice("abc é\n") for _ in range(random.randint(1, 4000))) for _ in range(30))]
    together = ctph.fingerprints(texts)
    assert together == [ctph.fingerprints([t])[0] for t in texts]
    assert all(len(s) <= 64 for f in together for s in f.split(":")[1:])
    long = "".join(random.choice("abcdefghij klmnop") for _ in range(9000))
    near = long[:4000] + "changed here" + long[4010:]
    a, b, c = ctph.fingerprints([long, near, "".join(random.choice("abcdefghij klmnop") for _ in range(9000))])
    assert ctph.likeness([a], [b])[0] > 0.8 and ctph.likeness([a], [c])[0] < 0.2 and ctph.likeness([a], [a])[0] == 1


@pytest.mark.parametrize("bucket_chars", [ctph.BUCKET_CHARS, 20_000])
def test_op8_walk(spark, bucket_chars):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    docs = sorted(((r["doc_id"], r["text"]) for r in df.collect()), reverse=True)
    got = ctph.compare_with_next(df, keep_text=False, bucket_chars=bucket_chars).orderBy("doc_id", ascending=False).collect()
    assert len(got) == len(docs)
    for k, r in enumerate(got):
        (i, t), following = docs[k], docs[(k + 1) % len(docs)][1]
        new = t[:len(t) - len(t) // 3] + following[:len(t) // 3]
        assert (r["doc_id"], r["n_chars"], r["edited_sha256"]) == (i, len(t), hashlib.sha256(new.encode()).hexdigest())
        own, other, changed = ctph.fingerprints([t, following, new])
        assert (r["fingerprint"], r["edited_fingerprint"]) == (own, changed)
        assert r["near_next"] == ctph.likeness([own], [other])[0] and r["near_edited"] == ctph.likeness([own], [changed])[0]


def test_op8_odd_rows(spark):
    rows = [(None, "abc"), (None, None), (3, "hello world " * 20), (3, "hello world " * 20), (3, None), (9, "")]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, place string")
    got = ctph.compare_with_next(df, bucket_chars=50).collect()
    assert sorted((str(r["doc_id"]), r["n_chars"]) for r in got) == sorted((str(i), len(t or "")) for i, t in rows)
    assert ctph.compare_with_next(df.limit(0)).count() == 0
    one = ctph.compare_with_next(df.where("doc_id = 9")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0


def test_loser_tree_merges_runs():
    random.seed(1)
    for k in (0, 1, 2, 3, 5, 8, 13):
        runs = [sorted(((f"u{random.randint(0, 5)}", str(random.randint(0, 9)), random.choice([None, 1, 2]), 0, 0, 0, 0, 0, "f",
                         random.randint(0, 99)) for _ in range(random.randint(0, 20))), key=warc.order) for _ in range(k)]
        assert list(map(warc.order, warc.LoserTree(runs))) == sorted(warc.order(x) for r in runs for x in r)


def expected_captures(pages):
    by = collections.defaultdict(list)
    for i, h in pages:
        by[(h or "").encode()].append(i)
    out = []
    for i, h in pages:
        raw = (h or "").encode()
        ids = [x for x in by[raw] if x is not None]
        again = len(raw) >= 1000 and bool(ids) and i != max(ids)
        out.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", max(ids) if again else None))
    return sorted(out, key=str)


def test_warc_round_trip(spark):
    rows = [(1, "http://a.b/c d", "x" * 1200), (2, None, "x" * 1200), (None, "http://www.A.b:80/", "x" * 1200),
            (None, "u", "é" * 900), (None, "u", "é" * 900), (5, "http://q.org/é?x=1", None), (6, "http://q.org/", ""),
            (7, "v\r\nWARC-Type: evil", "WARC/1.0\r\n\r\n" * 200), (8, "x", "WARC/1.0\r\n\r\n" * 200), (9, "x", "y" * 999), (10, "x", "y" * 999)]
    df = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, file string")
    got = warc.archive_and_index(df).collect()
    keys = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r[k] for k in keys) for r in got), key=str) == expected_captures([(r[0], r[2]) for r in rows])
    assert [r["urlkey"] for r in got] == sorted(r["urlkey"] for r in got)
    assert warc.archive_and_index(df.limit(0)).count() == 0


def test_warc_long_payloads_and_ranges(spark, monkeypatch):
    """Payloads of every size class, and one address that spans many key ranges."""
    monkeypatch.setattr(warc, "FILES", ((1500, 8), (4000, 2), (1 << 62, 1)))
    monkeypatch.setattr(warc, "RANGE_ROWS", 7)
    random.seed(2)
    rows = [(i, "http://one.site/page", random.choice("abc") * random.choice([3, 1200, 3000, 3000, 300_000])) for i in range(60)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    got = warc.archive_and_index(df)
    assert got.rdd.getNumPartitions() > 3
    keys = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    got = got.collect()
    assert sorted((tuple(r[k] for k in keys) for r in got), key=str) == expected_captures([(r[0], r[2]) for r in rows])
    assert [r["page_id"] for r in got] == list(range(60)) and len({r["file"] for r in got if r["payload_bytes"] > 4000}) > 2


def test_op3_query(spark):
    pages = [(r["page_id"], r["html"]) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    got = registry.op3_warc_index(spark, SF).collect()
    keys = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r[k] for k in keys) for r in got), key=str) == expected_captures(pages)


def test_shingle_hashes_follow_the_words():
    texts = ["a b c a b c", "A  B\tC\x0bd", "x" * 100 + " y z", "x" * 99 + "y" + " y z", None, "", " ", "é è", "a b"]
    got = jaccard.shingle_sets(texts, 3)
    assert [len(s) for s in got] == [len(shingles(t, 3)) for t in texts]
    assert len(np.intersect1d(got[0], got[1])) == 1 and not len(np.intersect1d(got[2], got[3]))
