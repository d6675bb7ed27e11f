"""Registered queries of the training-data operators, one ``opN_<name>`` each."""

from __future__ import annotations

from pyspark.sql import functions as F

from credlens.llm import bpe, ctph, jaccard, langid, merkle, packing, pii, quality, secrets, spelling, tokenfile, toxicity, warc
from credlens.llm.common import documents, held_out, tokenizer_path
from credlens.session import table


def op1_char_lstm_pii(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return pii.find(docs, pii.train(docs))


def op2_crf_language(spark, sf_dir):
    docs = documents(spark, sf_dir)
    found = langid.predict(docs, langid.train(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "n_letter_words", "n_switches")


def op3_warc_index(spark, sf_dir):
    index = warc.archive_and_index(table(spark, sf_dir, "pages"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_perfect_hash_ids(spark, sf_dir):
    path = tokenfile.write(documents(spark, sf_dir), tokenfile.new_path(spark, "token-ids"),
                           tokenizer_path("word_bpe_49k.json"), end_id=1)
    docs = tokenfile.read(spark, path, with_ids=False)
    shards = tokenfile.manifest(spark, path).select("file", "shard_no", "first_token")
    return docs.join(shards, ["file", "shard_no"]).select(
        "doc_id", (F.col("first_token") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")


def op5_compression_bands(spark, sf_dir):
    return quality.quality_rules(documents(spark, sf_dir))


def op6_bm25_packing(spark, sf_dir):
    return packing.pack(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"), end_id=0, window=1024)


def op7_tree_bpe(spark, sf_dir):
    return bpe.encode(documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"), result=bpe.DIGESTS)


def op8_piecewise_hash(spark, sf_dir):
    return ctph.compare_with_next(documents(spark, sf_dir), keep_text=False)


def op9_ngram_jaccard(spark, sf_dir):
    return jaccard.jaccard_join(documents(spark, sf_dir), words=3, num=90, den=100)


def op10_toxicity_lexicon(spark, sf_dir):
    docs = documents(spark, sf_dir)
    lexicon = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score_text(docs, lexicon)
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted", F.col("evidence"))


def op11_merkle_manifest(spark, sf_dir):
    return merkle.tampered_manifest(documents(spark, sf_dir))


def op12_spelling_variants(spark, sf_dir):
    return spelling.spelling_variants(spark, documents(spark, sf_dir))


def op13_blob_ledger_secrets(spark, sf_dir):
    return secrets.find(spark, documents(spark, sf_dir))


QUERIES = {
    "op1_char_lstm_pii": op1_char_lstm_pii,
    "op2_crf_language": op2_crf_language,
    "op3_warc_index": op3_warc_index,
    "op4_perfect_hash_ids": op4_perfect_hash_ids,
    "op5_compression_bands": op5_compression_bands,
    "op6_bm25_packing": op6_bm25_packing,
    "op7_tree_bpe": op7_tree_bpe,
    "op8_piecewise_hash": op8_piecewise_hash,
    "op9_ngram_jaccard": op9_ngram_jaccard,
    "op10_toxicity_lexicon": op10_toxicity_lexicon,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_blob_ledger_secrets": op13_blob_ledger_secrets,
}



def crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of a text's UTF-8 bytes (code points below 2048) as DuckDB SQL: bit by bit."""
    codes = f"list_transform(string_split({text}, ''), lambda c: unicode(c))"
    octets = (f"flatten(list_transform({codes}, lambda u: CASE WHEN u < 128 THEN [u::BIGINT]"
              " ELSE [(192 | (u >> 6))::BIGINT, (128 | (u & 63))::BIGINT] END))")
    step = ("list_reduce([xor(r, o), 0, 0, 0, 0, 0, 0, 0, 0],"
            " lambda t, z: xor(t >> 1, 3988292384 * (t & 1)))")
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {octets}), lambda r, o: {step}), 4294967295)"


def _merkle_levels(name: str, leaves: str) -> str:
    """Recursive table of a forest's levels: (g, k, i, h, n) for node i of n on level k of tree g."""
    return f"""{name} AS (
  SELECT g, 0 AS k, i, h, n FROM {leaves}
  UNION ALL
  SELECT g, k + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), any_value(n + 1) // 2 FROM {name} WHERE n > 1 GROUP BY g, k, i // 2)"""


_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE octet_length(encode({0}::VARCHAR)) || ':' || {0}::VARCHAR END"


def _row_sql(n_chars: str = "n_chars") -> str:
    return "sha256(" + " || ".join(f"({_FIELD.format(c)})" for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"


#: Compression ratios, learned models, tokenizer files and fingerprints are not SQL: the other
#: queries are tested against brute force, exact round trips or held-out accuracy in tests/llm.
ORACLES: dict[str, str] = {
    "op3_warc_index": """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
  FROM pages),
q AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS original FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id <> original THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> original THEN original END AS refers_to
FROM q""",
    "op9_ngram_jaccard": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id
  GROUP BY x.doc_id, y.doc_id),
links AS (
  SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * c >= 90 * (p.n + q.n - c)),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, min(r.other) AS component_id,
  (SELECT count(*) FROM links WHERE a = d.doc_id)::BIGINT AS n_links
FROM documents d JOIN reach r ON d.doc_id = r.doc_id LEFT JOIN sizes s ON d.doc_id = s.doc_id
GROUP BY d.doc_id, s.n""",
    "op11_merkle_manifest": f"""
WITH RECURSIVE raw AS (
  SELECT doc_id, lang, {_row_sql()} AS leaf, {_row_sql("(n_chars + 1)")} AS forged, coalesce({crc32_sql("doc_id::VARCHAR")} % 7 = 0, false) AS bad
  FROM documents),
placed AS MATERIALIZED (
  SELECT *, coalesce('v' || lang, '') AS g, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
    count(*) OVER (PARTITION BY lang) AS n FROM raw),
leaves AS (SELECT g, i, leaf AS h, n FROM placed),
{_merkle_levels("lower_walk", "leaves")},
lower_tree AS MATERIALIZED (SELECT * FROM lower_walk),
subroots AS MATERIALIZED (
  SELECT g AS of, k AS depth, h, row_number() OVER (ORDER BY encode(g)) - 1 AS i, count(*) OVER () AS n FROM lower_tree WHERE n = 1),
tops AS (SELECT 0 AS g, i, h, n FROM subroots),
{_merkle_levels("upper_walk", "tops")},
upper_tree AS MATERIALIZED (SELECT * FROM upper_walk),
ways AS MATERIALIZED (
  SELECT p.g, p.i, t.k, t.i AS at, s.h AS sibling FROM placed p
  JOIN lower_tree t ON t.g = p.g AND t.n > 1 AND t.i = p.i >> t.k
  LEFT JOIN lower_tree s ON s.g = t.g AND s.k = t.k AND s.i = xor(t.i, 1::BIGINT)
  UNION ALL
  SELECT p.g, p.i, r.depth + t.k, t.i, s.h FROM placed p JOIN subroots r ON r.of = p.g
  JOIN upper_tree t ON t.n > 1 AND t.i = r.i >> t.k
  LEFT JOIN upper_tree s ON s.k = t.k AND s.i = xor(t.i, 1::BIGINT)),
proofs AS (SELECT g, i, sha256(coalesce(string_agg(sibling, '' ORDER BY k), '')) AS proof_sha256, count(*) AS steps FROM ways GROUP BY g, i),
folding(g, i, k, h) AS (
  SELECT g, i, 0, CASE WHEN bad THEN forged ELSE leaf END FROM placed
  UNION ALL
  SELECT f.g, f.i, f.k + 1, sha256(CASE WHEN w.sibling IS NULL THEN f.h WHEN w.at % 2 = 1 THEN w.sibling || f.h ELSE f.h || w.sibling END)
  FROM folding f JOIN ways w ON w.g = f.g AND w.i = f.i AND w.k = f.k)
SELECT p.doc_id, p.leaf, r.h AS subroot, u.h AS root, coalesce(q.proof_sha256, sha256('')) AS proof_sha256, f.h AS folded_root, f.h = u.h AS verified
FROM placed p JOIN subroots r ON r.of = p.g JOIN (SELECT h FROM upper_tree WHERE n = 1) u ON true
LEFT JOIN proofs q ON q.g = p.g AND q.i = p.i
JOIN folding f ON f.g = p.g AND f.i = p.i AND f.k = coalesce(q.steps, 0)""",
    "op12_spelling_variants": rf"""
WITH RECURSIVE runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')), '{spelling.UPPER}', '{spelling.LOWER}') AS run
  FROM documents),
hashed AS (
  SELECT run, count(*) AS c, {crc32_sql("doc_id::VARCHAR || ':' || run")} AS h FROM runs WHERE length(run) >= 6 GROUP BY doc_id, run),
counted AS (
  SELECT CASE WHEN h % 199 = 0 THEN left(run, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, sum(c) AS n
  FROM hashed GROUP BY 1),
words AS MATERIALIZED (SELECT word, n::BIGINT AS n FROM counted WHERE length(word) >= 6 AND n >= 5),
cuts AS MATERIALIZED (
  SELECT word, i, left(word, i) || substr(word, i + 2) AS rest FROM (SELECT word, unnest(range(0, length(word))) AS i FROM words)),
near AS MATERIALIZED (
  SELECT a.word, b.word AS other FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, a.rest FROM cuts a JOIN words b ON a.rest = b.word
  UNION SELECT a.rest, a.word FROM cuts a JOIN words b ON a.rest = b.word),
best AS (
  SELECT x.word, count(*) AS n_near, max(w.n) AS top, arg_min(x.other, (-w.n, encode(x.other))) AS form
  FROM near x JOIN words w ON w.word = x.other GROUP BY x.word),
formed AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.top >= 5 * w.n THEN b.form END AS form,
    CASE WHEN b.top >= 5 * w.n THEN b.top END AS form_n FROM words w LEFT JOIN best b ON b.word = w.word),
chain(word, stop, form) AS (
  SELECT word, word, form FROM formed
  UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN formed f ON f.word = c.form)
SELECT f.word, f.form, c.stop AS root, f.n, f.n_near, f.form_n FROM formed f JOIN chain c ON c.word = f.word AND c.form IS NULL""",
}
