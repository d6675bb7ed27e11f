"""Personal data, language, quality, toxicity: brute force, gradients, held-out accuracy."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st

from credlens.llm import langid, pii, quality, registry, toxicity

SF = "/root/testdata/sf0.001"
MID = "/root/testdata/sf0.01"
ODD = "doc_id long, text string, score string, spans int, predicted string"
ODD_ROWS = [(None, "mail a@b.co now", "x", 1, ""), (None, None, None, None, None), (5, "", "", 2, ""), (5, "+1 (555) 555-1234 idiot\n", "q", 3, ""),
            (5, "+1 (555) 555-1234 idiot\n", "q", 3, ""), (9, "word " * 30000, "", 5, ""), (10, "12 34 ## \x00 é", None, 1, None)]


def odd_rows(spark):
    return spark.createDataFrame(ODD_ROWS, ODD)


# --- op1 ---------------------------------------------------------------------------------------
BASE = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def brute_spans(text):
    out = []
    for kind, pattern in enumerate(BASE):
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            if kind == 1 and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == 2:
                total = sum(sum(divmod(int(c) * 2, 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d)))
                if not 12 <= len(d) <= 19 or total % 10:
                    continue
            if kind == 3 and not 9 <= len(d) <= 15:
                continue
            out.append((m.start(), m.end(), kind))
    return sorted(out, key=lambda s: (s[0], s[2]))


@given(st.lists(st.sampled_from(["a@", "b.c", "@", "1.2.3.4", "+1 ", "555", "-", "4111 1111 1111 1111", " ", ".", "é", "999", "(0)",
                                 "x@y.z@w.v", "@@", "000000000000", "+"]), max_size=14).map("".join))
@settings(max_examples=400, deadline=None)
def test_base_spans_equal_the_patterns(text):
    assert pii.base_spans(text) == brute_spans(text)


def test_gradients_of_the_network():
    r = np.random.default_rng(0)
    net = pii.Network.new()
    x, y = r.integers(2, 128, (3, 6)), r.integers(0, pii.TAGS, (3, 6))
    net.p["t"] = r.normal(0, 0.3, (pii.TAGS, pii.TAGS))
    _, g = net.gradients(x, y)
    for k, a in net.p.items():
        at = (int(x[0, 2]), int(r.integers(a.shape[1]))) if k[0] == "w" else tuple(int(r.integers(s)) for s in a.shape)
        keep = a[at]
        a[at] = keep + 1e-5
        up = net.gradients(x, y)[0]
        a[at] = keep - 1e-5
        down = net.gradients(x, y)[0]
        a[at] = keep
        assert abs(g[k][at] - (up - down) / 2e-5) < 1e-6


def test_viterbi_is_the_best_path():
    r = np.random.default_rng(1)
    e, t = r.normal(size=(4, 4, 3)), r.normal(size=(3, 3))
    got = pii.viterbi(e, t)
    for n in range(4):
        paths = np.indices((3,) * 4).reshape(4, -1).T
        score = [sum(e[n, i, p[i]] for i in range(4)) + sum(t[p[i], p[i + 1]] for i in range(3)) for p in paths]
        assert got[n].tolist() == paths[int(np.argmax(score))].tolist()


def test_windows_are_reconciled_in_one_lattice():
    r = np.random.default_rng(3)
    parts = [(0, r.normal(size=(8, pii.TAGS))), (4, r.normal(size=(8, pii.TAGS))), (8, r.normal(size=(8, pii.TAGS)))]
    got = pii.lattice(parts, 14)
    near = [1, 2, 3, 4, 4, 3, 2, 1]
    for i in range(14):
        own = [(near[i - s], e[i - s]) for s, e in parts if 0 <= i - s < 8]
        assert np.allclose(got[i], sum(w * e for w, e in own) / sum(w for w, _ in own), atol=1e-5)
    trans = r.normal(size=(pii.TAGS, pii.TAGS)).astype(np.float32)
    several = [r.normal(size=(n, pii.TAGS)).astype(np.float32) * 5 for n in (3, 14, 1, 9, 9)]
    for tags, e in zip(pii.viterbi_all(several, trans), several, strict=True):
        assert len(tags) == len(e)
        # the best path whose end is followed by "outside", as that of every padded lattice is
        longest = max(map(len, several))
        alone = np.concatenate([e, np.full((longest - len(e), pii.TAGS), -1e6, np.float32)])
        alone[len(e):, 0] = 0
        assert tags.tolist() == pii.viterbi(alone[None], trans)[0][:len(e)].tolist()


def trained_on_some(spark):
    texts = [r["text"] for r in spark.read.parquet(f"{MID}/documents.parquet").where("text rlike '[0-9@]'").orderBy("doc_id").collect()]
    return pii.fit(texts)


def test_disguised_spans_are_found_whole_wherever_they_lie(spark):
    """Names and hosts that no document holds, with and without digits, 20 to 120 characters, at every offset of a window."""
    net = trained_on_some(spark)
    plain = [r["text"] for r in spark.read.parquet(f"{MID}/documents.parquet").where("length(text) > 1500 and not text rlike '[0-9@]'").orderBy("doc_id").limit(40).collect()]
    values = ["jane.roe [at] mail [dot] net", "max.muster(at)firma-nord.de", "hein.19 [at] mail5 [dot] example [dot] com",
              "firstname.middlename.lastname [at] department [dot] university [dot] edu",
              "averylongfirstname.averylongsurname [at] institute [dot] of [dot] technology [dot] somewhere [dot] org",
              "firstname.secondname.thirdname.lastname [at] laboratory [dot] faculty [dot] university [dot] country [dot] edu"]
    for value in values:
        whole = cut = 0
        for offset in range(pii.WINDOW):
            own = plain[offset % len(plain)]
            before = own[100:200 + offset].replace("\n", " ").rstrip() + " "
            text = before + value + " " + own[700:900]
            found = pii.added_spans(text, pii.base_spans(text), pii.decode([text], net)[0])
            mine = [s[:2] for s in found if s[0] < len(before) + len(value) and s[1] > len(before)]
            whole += mine == [(len(before), len(before) + len(value))]
            cut += bool(mine) and mine != [(len(before), len(before) + len(value))]
        assert whole >= 0.9 * pii.WINDOW and cut <= 0.05 * pii.WINDOW, (value, whole, cut)
    # clean prose stays as it is
    assert sum(len(pii.added_spans(t, pii.base_spans(t), d)) for t, d in zip(plain, pii.decode(plain, net), strict=True)) == 0


def test_very_long_runs_of_digits_are_decoded(spark):
    net = trained_on_some(spark)
    text = "1 2 3 " * 20_000 + "jane.roe [at] mail [dot] net"
    assert len(pii.decode([text, "", "x"], net)) == 3


def test_op1_query_and_held_out_disguises(spark):
    docs = spark.read.parquet(f"{MID}/documents.parquet")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    rows = registry.op1_char_lstm_pii(spark, MID).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = brute_spans(texts[r["doc_id"]])
        joined = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, b, k in base)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[2] == i for s in base) for i in range(4)]
        assert set(joined.split(",")) - {""} <= set(r["spans"].split(","))
    # Trained on the even documents, decoded on spans of the odd ones, disguised.
    net = pii.fit([t for i, t in sorted(texts.items()) if i % 2 == 0 and re.search("[0-9@]", t)])
    rng, hit, all_ = np.random.default_rng(0), 0, 0
    for t in (t for i, t in texts.items() if i % 2):
        for a, b, kind in pii.base_spans(t):
            value = pii.disguise(t[a:b], kind, rng)
            whole = re.sub("[0-9@]", "x", t[max(0, a - 200):a]) + value + re.sub("[0-9@]", "x", t[b:b + 200])
            found = pii.added_spans(whole, pii.base_spans(whole), pii.decode([whole], net)[0])
            all_ += 1
            hit += value in [whole[x:y] for x, y, _ in found]
    assert all_ > 20 and hit >= 0.7 * all_


def test_pii_odd_rows(spark):
    got = pii.find(odd_rows(spark), None).collect()
    assert sorted(str((r["doc_id"], r["spans"])) for r in got) == sorted(
        str((r[0], ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, b, k in brute_spans(r[1] or "")))) for r in ODD_ROWS)
    masked = {r["doc_id"]: r["_m"] for r in pii.redact(odd_rows(spark), None, "_m").where("doc_id = 5").collect()}
    assert masked[5] in ("", "[PHONE] idiot\n")
    assert pii.find(odd_rows(spark).limit(0), None).count() == 0
    assert pii.train(odd_rows(spark).limit(0)) is None


# --- op2 ---------------------------------------------------------------------------------------
def test_forward_backward_equals_enumeration():
    r = np.random.default_rng(3)
    e, a = r.random((2, 4, 3)) + 0.1, r.random((3, 3)) + 0.1
    pairs = np.zeros((3, 3))
    g = langid.forward_backward(e.copy(), a, pairs)
    want, expected = np.zeros((2, 4, 3)), np.zeros((3, 3))
    for n in range(2):
        weights = {}
        for p in np.indices((3,) * 4).reshape(4, -1).T:
            weights[tuple(p)] = np.prod([e[n, i, p[i]] for i in range(4)]) * np.prod([a[p[i], p[i + 1]] for i in range(3)])
        z = sum(weights.values())
        for p, w in weights.items():
            for i in range(4):
                want[n, i, p[i]] += w / z
            for i in range(3):
                expected[p[i], p[i + 1]] += w / z
    assert np.allclose(g, want) and np.allclose(pairs, expected)


def test_op2_held_out_accuracy_and_switches(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{MID}/documents.parquet").collect()}
    rows = registry.op2_crf_language(spark, MID).collect()
    assert len(rows) == len(docs)
    test = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for r in rows)
    assert sum(r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in test) >= 0.97 * len(test)
    model = langid.fit([d["text"] for d in docs.values()][:400], [d["lang"] for d in docs.values()][:400])
    by = {}
    for d in list(docs.values())[400:]:
        by.setdefault(d["lang"], " ".join(langid.words_of(d["text"])[:30]))
    en, de = by["en"], by["de"]
    tagged = langid.tag(f"{en} {de}", model)
    want = ["en"] * len(en.split()) + ["de"] * len(de.split())
    assert np.mean([t == w for (_, t), w in zip(tagged, want, strict=True)]) > 0.9


def test_windows_of_long_texts_agree_with_one_chain(spark):
    r = np.random.default_rng(0)
    model = langid.fit(["the of and to " * 20, "der die und das " * 20], ["en", "de"])
    words = [str(r.choice(["the", "of", "der", "die", "xyz"])) for _ in range(900)]
    t = langid.Tagger(model)
    got = t.marginals([words])[0]
    whole = langid.forward_backward(model.emissions(words)[None], np.exp(model.transitions))[0]
    assert np.abs(got - whole).max() < 1e-3


def test_langid_odd_rows(spark):
    df = odd_rows(spark).withColumnRenamed("spans", "lang_pred")
    model = langid.fit(["the of and " * 30, "der die und " * 30], ["en", "de"])
    got = {(r["doc_id"], r["lang_pred"]) for r in langid.predict(df, model).collect()}
    assert (5, "und") in got and (None, "und") in got and len(langid.predict(df, model).collect()) == len(ODD_ROWS)
    assert {r["lang_pred"] for r in langid.predict(df, None).collect()} == {"und"}
    assert langid.predict(df.limit(0), model).count() == 0
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert langid.train(empty) is None


# --- op5 ---------------------------------------------------------------------------------------
@given(st.lists(st.sampled_from(["a", "b", "c", " ", "\n", "\n\n", "\t", "\x0b", "#", "$", "é", "\x1c", "　", "a b c ", "\x85"]), max_size=80))
@settings(max_examples=300, deadline=None)
def test_word_rules_equal_brute_force(parts):
    text = "".join(parts)
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {i + k for i in range(len(words) - 2) if grams[tuple(words[i:i + 3])] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    assert quality.word_rules(text) == (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered))


def test_compression_bands():
    random.seed(1)
    prose = " ".join("".join(random.choice(["ta", "re", "in", "lo", "mi", "su", "de"]) for _ in range(random.randint(1, 4))) for _ in range(900))
    loop = "the same line again and again.\n" * 400
    noise = " ".join(hashlib.sha256(str(i).encode()).hexdigest()[:random.randint(6, 9)] for i in range(1500))
    packer = zstandard.ZstdCompressor(level=quality.LEVEL)
    got = quality.judge([prose, loop, None, ""])
    assert got["kept"] == [True, False, False, False] and got["base_failed"] == [False, True, True, True]
    ratio = len(prose) / len(packer.compress(prose.encode()))
    assert abs(got["zstd_ratio"][0] - ratio) < 0.05
    assert not quality.in_band(5000, 20.0) and not quality.in_band(5000, 1.05) and quality.in_band(100, 1.0)
    raw = random.Random(3).randbytes(20_000).decode("latin-1")
    spaced = " ".join(raw[i:i + 7] for i in range(0, len(raw), 7))
    verdict = quality.judge([spaced, noise])
    assert verdict["base_failed"][1] is False and verdict["zstd_ratio"][1] < 2.2


def junk(alphabet: str, size: int, seed: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(alphabet) for _ in range(rng.randint(4, 10))) for _ in range(size // 8 + 1))[:size]


def test_junk_is_rejected_and_clean_text_stays(spark):
    docs = spark.read.parquet(f"{MID}/documents.parquet").select("doc_id", "text")
    limits = quality.lower_limits(docs)
    hexa, base64, letters = "0123456789abcdef", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/", "abcdefghijklmnopqrstuvwxyz"
    whole = [junk(base64, n, n) for n in (600, 1500, 2500, 5000, 20_000)]
    whole += [junk(hexa, n, n) for n in (5000, 20_000)] + [junk(letters, n, n) for n in (2500, 5000, 20_000)]
    got = quality.judge(whole, limits)
    assert not any(got["base_failed"]) and not any(got["kept"]), list(zip(map(len, whole), got["kept"], got["zstd_ratio"], strict=True))
    # Without a corpus the fixed limits still reject base64.
    assert not any(quality.judge(whole[:5])["kept"])
    texts = [r["text"] for r in docs.where("length(text) > 5000").limit(400).collect()]
    clean = quality.judge(texts, limits)
    good = [t for t, ok in zip(texts, clean["kept"], strict=True) if ok]
    assert len(good) >= 0.97 * (len(texts) - sum(clean["base_failed"]))
    for a in (hexa, base64, letters):
        planted = quality.judge([t[:6000] + " " + junk(a, 3500, i) for i, t in enumerate(good[:100])], limits)
        assert sum(planted["kept"]) <= 2


def test_limits_hold_in_polluted_and_thin_classes(spark):
    docs = [r["text"] for r in spark.read.parquet(f"{MID}/documents.parquet").where("length(text) between 1500 and 3000").select("text").collect()]
    base64 = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/"
    bad = [junk(base64, 1500 + 5 * i, i) for i in range(len(docs) // 2)]  # a third of all texts
    rows = spark.createDataFrame([(t,) for t in docs + bad], "text string")
    limits = quality.lower_limits(rows)
    assert not any(quality.judge(bad, limits)["kept"])
    kept = quality.judge(docs, limits)
    assert sum(kept["kept"]) >= 0.97 * (len(docs) - sum(kept["base_failed"]))
    # no number of texts switches the rule: a class of one, or of fifty, moves its limit a little
    at = [quality.smoothed({20: (1000, 1.92, 1.95), 21: (n, 1.99, 2.02)})[21] for n in range(0, 400)]
    assert max(b - a for a, b in zip(at, at[1:], strict=False)) < 0.001 and at == sorted(at)
    assert quality.lower_limits(rows.limit(0))[20] == 0.0


def test_op5_query(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = registry.op5_compression_bands(spark, SF).collect()
    assert len(rows) == len(docs)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    for r in rows:
        assert tuple(r[n] for n in names) == quality.word_rules(docs[r["doc_id"]] or "")
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])
    good = [r for r in rows if not r["base_failed"]]
    assert sum(r["kept"] for r in good) >= 0.98 * len(good)
    assert quality.quality_rules(odd_rows(spark)).count() == len(ODD_ROWS)
    assert quality.quality_rules(odd_rows(spark).limit(0)).count() == 0


# --- op10 --------------------------------------------------------------------------------------
def test_folding_and_exceptions():
    assert toxicity.fold("1d10t IDIOT іdiоt ｉｄｉｏｔ id​iot st@r 555 a1") == "idiot idiot idiot idiot idiot star 555 a1"
    lex = toxicity.Lexicon([("trash", True, 3.0), ("moron", False, 2.0)])
    a = lex.matcher()
    assert toxicity.evidence("the trash can is full", a) == 0 and toxicity.evidence("you trash!", a) > 0
    assert toxicity.evidence("trashy oxymoron", a) == 0 and toxicity.evidence("moronic", a) > 0
    short, long = toxicity.evidence("you trash", a), toxicity.evidence("you trash" + " word" * 5000, a)
    assert short > long > 0


def test_matches_equal_brute_force():
    random.seed(4)
    entries = [("bad", True, 1.0), ("badg", False, 2.0), ("ugh", False, 0.5), ("ba", False, 0.25)]
    lex = toxicity.Lexicon(entries, ["bad luck"])
    a = lex.matcher()
    for _ in range(300):
        text = " ".join(random.choice(["bad", "badge", "badger", "ugh", "ughh", "luck", "abad", "ba", "Bad", "x"]) for _ in range(random.randint(0, 9)))
        low, total = text.lower(), 0.0
        safe = [(m.start(), m.end()) for m in re.finditer(r"\bbad luck\b", low)]
        for m in re.finditer(r"\w+", low):
            best = None
            for w, whole, v in entries:
                ok = m[0] == w if whole else m[0].startswith(w)
                if ok and not any(x <= m.start() and m.start() + len(w) <= y for x, y in safe) and (best is None or len(w) > best[0]):
                    best = (len(w), v)
            total += best[1] if best else 0
        found, _ = toxicity.matches(text, a)
        assert abs(sum(found) - total) < 1e-9, text


def test_op10_held_out(spark):
    rows = registry.op10_toxicity_lexicon(spark, MID).collect()
    truth = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{MID}/labels.parquet").collect()}
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    test = [r for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in test]) >= 0.95
    clean = [r for r in test if not truth[r["doc_id"]]]
    assert np.mean([r["predicted"] for r in clean]) <= 0.02


def test_toxicity_odd_rows(spark):
    labels = spark.createDataFrame([(5, 1, 1), (None, 1, 1), (9, 1, None), (10, 1, 0)], "doc_id long, quality int, toxic int")
    lexicon = toxicity.train(odd_rows(spark), labels)
    got = toxicity.score_text(odd_rows(spark), lexicon).collect()
    assert len(got) == len(ODD_ROWS)
    none = toxicity.train(odd_rows(spark), labels.limit(0))
    assert {w for w, _, _ in none.entries} == set(toxicity.SEEDS)
    assert toxicity.score_text(odd_rows(spark).limit(0), none).count() == 0


def test_ip_parts_of_any_length():
    zeros = "0" * 5000
    assert pii.base_spans(f"at {zeros}1.2.3.{zeros}255 end") == [(3, 3 + 5000 + 1 + 5 + 5000 + 3, 1)]
    assert pii.base_spans(f"{zeros}256.1.1.1") == [] and pii.base_spans("9" * 6000 + ".1.1.1") == []


def test_words_of_long_runs_and_numerals():
    a, b = "a" * 39 + "xyz" * 10, "a" * 39 + "ung" * 10
    assert "".join(langid.words_of(a)) == a and max(map(len, langid.words_of(a))) == langid.LONGEST
    assert langid.words_of(a) != langid.words_of(b)
    assert langid.words_of("½ ² ① Ⅷ 12 _ ٣") == [] and langid.words_of("x½y") == ["x", "y"]
    model = langid.fit(["der hund und die katze " * 5, "the dog and the cat " * 5], ["de", "en"])
    # a text without spaces is decided by all its letters, not by its first ones
    first = "".join(w for w in ("the dog and the cat " * 3).split())
    marg = langid.tagger(model).marginals([langid.words_of(first + "q" * 100)])[0]
    assert len(marg) == len(langid.words_of(first + "q" * 100)) >= 3


def test_numerals_alone_have_no_language(spark):
    model = langid.fit(["der hund und die katze " * 5, "the dog and the cat " * 5], ["de", "en"])
    df = spark.createDataFrame([(1, "½ ② Ⅷ 7"), (2, "the dog")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in langid.predict(df, model).collect()}
    assert got[1]["lang_pred"] == "und" and got[1]["score"] == 0.0 and got[2]["lang_pred"] == "en"


def test_a_worker_keeps_one_thing():
    from credlens.llm import common
    assert common.kept("a", 1, lambda: "x") == "x" == common.kept("a", 1, lambda: "y")
    assert common.kept("b", 1, lambda: "z") == "z" and list(common._KEPT) == [("b", 1)]
