"""DuckDB SQL oracles, written from the operator definitions.

DuckDB uses RE2: no look-around, no back-references, ASCII ``\\b``/``\\w``.
Patterns below therefore use explicit classes (``[^\\p{L}\\p{N}_]`` for
Python's ``\\W``, an explicit whitespace set for Python's ``\\s``), the repeated-
character squeeze is one pass per ASCII character, and digit-only tokens are
dropped by a list filter.  Floats use the same ``floor(x*1e6+0.5)/1e6``
quantisation as the Spark side.
"""

from __future__ import annotations

from credlens.functions import lexicons as lx

WS = (r"\t\n\x{0B}\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
      r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}")
AWS = r"\t\n\x{0B}\f\r\x{1C}-\x{1F} "


def s(v: str) -> str:
    """SQL string literal."""
    return "'" + v.replace("'", "''") + "'"


def slist(words) -> str:
    return "[" + ", ".join(s(w) for w in words) + "]"


def q6(expr: str) -> str:
    return f"(floor(({expr}) * 1000000.0 + 0.5) / 1000000.0)"


def py_split(expr: str) -> str:
    return f"list_filter(regexp_split_to_array(coalesce({expr}, ''), '[{WS}]+'), lambda x: x <> '')"


def leakage_clean_sql(col: str) -> str:
    dateline = (
        "(?i)^[" + WS + "]*[A-Z" + WS + "]+(?:[" + WS + r"]*\([^)]+\))?[" + WS + "]*[-—][" + WS + "]*"
        "|^[" + WS + r"]*\([^)]*(?:reuters|ap|afp|bbc|bloomberg|xinhua)[^)]*\)[" + WS + "]*[-—][" + WS + "]*"
    )
    attrib = (r"(?i)\bvia[" + WS + r"]+[@#]?[A-Za-z0-9_]+\b|\bvia[" + WS + r"]+twitter\b|\bvia["
              + WS + r"]+facebook\b")
    url = r"https?://[^" + WS + r"]+|www\.[^" + WS + r"]+"
    t = f"regexp_replace({col}, {s(dateline)}, ' ')"
    t = f"regexp_replace({t}, {s(attrib)}, ' ', 'g')"
    t = f"lower({t})"
    t = f"regexp_replace({t}, {s(url)}, ' ', 'g')"
    t = f"regexp_replace({t}, {s('[^\\p{L}\\p{N}_]')}, ' ', 'g')"
    toks = (f"list_filter(string_split({t}, ' '), lambda w: w <> '' "
            f"AND NOT regexp_full_match(w, {s('\\p{Nd}+')}))")
    return f"CASE WHEN {col} IS NULL THEN '' ELSE array_to_string({toks}, ' ') END"


def _squeeze_ascii(t: str) -> str:
    """Runs of 3+ identical characters -> 2, one pass per ASCII char except newline."""
    for code in range(1, 128):
        if code == 10:
            continue
        rep = "chr(92) || chr(92) || chr(92) || chr(92)" if code == 92 else f"chr({code}) || chr({code})"
        t = f"regexp_replace({t}, '\\x{{{code:02X}}}{{3,}}', {rep}, 'g')"
    return t


def full_clean_tokens_sql(col: str) -> str:
    t = f"translate({col}, {s(lx.SMART_PUNCT_FROM)}, {s(lx.SMART_PUNCT_TO)})"
    t = f"lower({t})"
    for key, value in lx.CONTRACTIONS.items():
        t = f"regexp_replace({t}, {s(chr(92) + 'b' + key + chr(92) + 'b')}, {s(value)}, 'g')"
    t = _squeeze_ascii(t)
    t = f"regexp_replace({t}, '[^\\x00-\\x7F]+', ' ', 'g')"
    dl = r"^[a-z" + AWS + r"\.,\-_\|]+(\(reuters\)[^\-]*\-|\(ap\)[^\-]*\-)"
    t = f"regexp_replace({t}, {s(dl)}, '')"
    t = f"regexp_replace({t}, {s(r'\b(reuters|ap|bbc|cnn|foxnews|truthunleashed)\b')}, '', 'g')"
    t = f"regexp_replace({t}, {s(r'\bread more via\b[^\n]*\n?$')}, '')"
    t = f"regexp_replace({t}, {s(r'https?://[^' + AWS + r']+|www\.[^' + AWS + r']+')}, '', 'g')"
    t = f"regexp_replace({t}, {s(r'[^' + AWS + r']+@[^' + AWS + r']+')}, '', 'g')"
    toks = f"regexp_extract_all({t}, {s(r'\b[a-z]{3,15}\b')})"
    toks = f"list_filter({toks}, lambda w: NOT list_contains({slist(lx.CLEANER_STOPWORDS)}, w))"
    return f"CASE WHEN {col} IS NULL OR {col} = '' THEN []::VARCHAR[] ELSE {toks} END"


def full_clean_sql(col: str) -> str:
    return f"array_to_string({full_clean_tokens_sql(col)}, ' ')"


def title_sql(col: str) -> str:
    return f"split_part(coalesce({col}, ''), chr(10), 1)"


def _cnt(col: str, sub: str) -> str:
    return f"((length({col}) - length(replace({col}, {s(sub)}, ''))) // {len(sub)})"


def _chars(col: str, cls: str) -> str:
    return f"(length({col}) - length(regexp_replace({col}, {s(cls)}, '', 'g')))"


def _vowels(col: str) -> str:
    return _chars(col, "[aeiou]")


def _lexcount(tokens: str, words) -> str:
    return f"len(list_filter({tokens}, lambda x: list_contains({slist(words)}, x)))"


def _hits(col: str, phrases) -> str:
    return "(" + " + ".join(f"(CASE WHEN contains({col}, {s(p)}) THEN 1 ELSE 0 END)" for p in phrases) + ")"


def features_sql(source_cte: str) -> str:
    """32 features from a CTE with columns (doc_id, raw, clean, title)."""
    return f"""
    fx_tok AS (
      SELECT doc_id, raw, clean, title,
             {py_split('raw')} AS w, {py_split('clean')} AS cw
      FROM {source_cte}
    ),
    fx_hapax AS (
      SELECT doc_id, count(*) AS hapax FROM (
        SELECT doc_id, x, count(*) AS c FROM (SELECT doc_id, unnest(cw) AS x FROM fx_tok)
        GROUP BY doc_id, x) WHERE c = 1 GROUP BY doc_id
    ),
    fx_base AS (
      SELECT t.doc_id, t.raw, t.clean, t.title, t.w, t.cw,
        coalesce(h.hapax, 0) AS hapax,
        len(t.w) AS n_words,
        greatest(len(t.w), 1)::DOUBLE AS nW,
        greatest(len(t.cw), 1)::DOUBLE AS nC,
        greatest(length(t.raw), 1)::DOUBLE AS nch,
        greatest({_cnt('t.raw', '.')} + {_cnt('t.raw', '!')} + {_cnt('t.raw', '?')}, 1)::DOUBLE AS nS,
        lower(t.raw) AS lraw,
        len(list_distinct(t.cw))::DOUBLE AS n_distinct,
        len(list_filter(t.w, lambda x: {_vowels('lower(x)')} >= 3))::DOUBLE AS n_complex,
        {_lexcount('t.cw', lx.POSITIVE_WORDS)} AS pos,
        {_lexcount('t.cw', lx.NEGATIVE_WORDS)} AS neg
      FROM fx_tok t LEFT JOIN fx_hapax h ON t.doc_id = h.doc_id
    ),
    fx AS (
      SELECT doc_id,
        n_distinct / nC AS lexical_diversity,
        n_distinct / nC AS type_token_ratio,
        hapax / nC AS hapax_ratio,
        n_words / nS AS avg_sentence_len,
        coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) / nW AS avg_word_len,
        {_chars('raw', '[.,!?;:"' + "'" + r'()\[\]{}]')} / nch AS punct_density,
        {_chars('raw', r'\p{Nd}')} / nch AS digit_ratio,
        {_chars('raw', '[A-Z]')} / nch AS uppercase_ratio,
        len(list_filter(w, lambda x: list_contains({slist(lx.STOPWORDS)}, lower(x)))) / nW AS stopword_ratio,
        greatest(0.0, least(100.0, 206.835 - 1.015 * (n_words / nS)
                 - 84.6 * (greatest(n_words, {_vowels('lraw')}) / nW))) AS flesch_reading_ease,
        greatest(0.0, least(20.0, 0.39 * (n_words / nS)
                 + 11.8 * (greatest(n_words, {_vowels('lraw')}) / nW) - 15.59)) AS flesch_kincaid_grade,
        greatest(0.0, least(20.0, 0.4 * ((n_words / nS) + 100.0 * (n_complex / nW)))) AS gunning_fog,
        greatest(0.0, least(20.0, 0.0588 * ({_chars('raw', '[a-zA-Z0-9]')} / nW * 100.0)
                 - 0.296 * (nS / nW * 100.0) - 15.8)) AS coleman_liau,
        greatest(0.0, least(20.0, 1.0430 * sqrt(n_complex * (30.0 / nS)) + 3.1291)) AS smog_index,
        (pos - neg) / (pos + neg + 1e-5) AS polarity,
        (pos + neg) / nC AS subjectivity,
        {_lexcount('cw', lx.EMOTIONAL_VOCABULARY)} / nC AS emotion_intensity,
        CASE WHEN contains(raw, '!!!') OR contains(raw, '???') OR contains(raw, '!?') THEN 1.0 ELSE 0.0 END
          AS excessive_punct,
        {_lexcount('cw', lx.CLICKBAIT_WORDS)} / nC AS clickbait_ratio,
        len(list_filter(w, lambda x: upper(x) = x AND lower(x) <> x AND length(x) > 2)) / nW AS all_caps_ratio,
        {_hits('lraw', lx.SENSATIONAL_PHRASES)} / nS AS sensational_ratio,
        {_hits('lraw', lx.URGENCY_INDICATORS)} / nC AS urgency_ratio,
        {_lexcount('cw', lx.HEDGING_WORDS)} / nC AS hedging_ratio,
        {_lexcount('cw', lx.CERTAINTY_WORDS)} / nC AS certainty_ratio,
        length(title)::DOUBLE AS title_length_chars,
        len({py_split('title')})::DOUBLE AS title_length_words,
        length(raw)::DOUBLE AS article_length_chars,
        greatest({_cnt('raw', chr(10) + chr(10))} + 1, 1)::DOUBLE AS paragraph_count,
        ({_cnt('raw', '"')} + {_cnt('raw', "'")})::DOUBLE AS quotation_count,
        ({_cnt('raw', 'http://')} + {_cnt('raw', 'https://')} + {_cnt('raw', 'www.')})::DOUBLE AS external_links,
        n_words::DOUBLE AS word_count,
        n_words / 200.0 AS reading_time
      FROM fx_base
    )"""


FEATURES = [
    "lexical_diversity", "type_token_ratio", "hapax_ratio", "avg_sentence_len", "avg_word_len",
    "punct_density", "digit_ratio", "uppercase_ratio", "stopword_ratio",
    "flesch_reading_ease", "flesch_kincaid_grade", "gunning_fog", "coleman_liau", "smog_index",
    "polarity", "subjectivity", "emotion_intensity",
    "excessive_punct", "clickbait_ratio", "all_caps_ratio", "sensational_ratio", "urgency_ratio",
    "hedging_ratio", "certainty_ratio",
    "title_length_chars", "title_length_words", "article_length_chars",
    "paragraph_count", "quotation_count", "external_links", "word_count", "reading_time",
]


def _newline(sql: str) -> str:
    return sql


ORACLES: dict[str, str] = {}

ORACLES["leakage_clean"] = f"""
SELECT doc_id, {leakage_clean_sql('text')} AS clean_text FROM documents
"""

ORACLES["stopword_filter"] = f"""
WITH c AS (SELECT doc_id, {leakage_clean_sql('text')} AS t FROM documents)
SELECT doc_id,
  array_to_string(list_filter(string_split(t, ' '),
    lambda w: w <> '' AND NOT list_contains({slist(lx.STOPWORDS)}, w)), ' ') AS filtered_text
FROM c
"""

ORACLES["full_clean"] = f"""
SELECT doc_id, {full_clean_sql('text')} AS clean_text FROM documents
"""

ORACLES["light_normalise"] = f"""
SELECT conv_id, turn, lower(array_to_string({py_split('text')}, ' ')) AS norm_text FROM conversations
"""

ORACLES["stylometric_features"] = f"""
WITH src AS (
  SELECT doc_id, coalesce(text, '') AS raw, {full_clean_sql('text')} AS clean, {title_sql('text')} AS title
  FROM documents
),
{features_sql('src')}
SELECT doc_id, {", ".join(q6(c) + " AS " + c for c in FEATURES)} FROM fx
"""

ORACLES["source_profile"] = f"""
WITH firsts AS (
  SELECT text, min(doc_id) AS doc_id FROM documents WHERE text IS NOT NULL GROUP BY text
),
src AS (
  SELECT d.doc_id, d.source AS subject, l.quality AS label, coalesce(d.text, '') AS raw,
         {full_clean_sql('d.text')} AS clean, {title_sql('d.text')} AS title
  FROM documents d JOIN firsts f ON d.doc_id = f.doc_id
  LEFT JOIN labels l ON d.doc_id = l.doc_id
),
{features_sql('src')}
SELECT s.subject, s.label, count(*)::BIGINT AS n_docs,
  {q6('avg(fx.lexical_diversity)')} AS avg_lexical_diversity,
  {q6('avg(fx.flesch_reading_ease)')} AS avg_flesch_reading_ease,
  {q6('avg(fx.avg_sentence_len)')} AS avg_sentence_len,
  {q6('avg(fx.uppercase_ratio)')} AS avg_uppercase_ratio,
  sum(fx.word_count::BIGINT)::BIGINT AS total_words
FROM fx JOIN src s ON fx.doc_id = s.doc_id
GROUP BY s.subject, s.label
"""

ORACLES["dedup_first_text"] = """
SELECT d.doc_id, d.source FROM documents d
JOIN (SELECT text, min(doc_id) AS doc_id FROM documents WHERE text IS NOT NULL GROUP BY text) f
  ON d.doc_id = f.doc_id
"""

ORACLES["dedup_title_text"] = f"""
WITH c AS (
  SELECT doc_id, {title_sql('text')} || ' ' || coalesce(text, '') AS combined FROM documents
)
SELECT min(doc_id) AS doc_id, lower(array_to_string({py_split('combined')}, ' ')) AS combined_text
FROM c GROUP BY combined
"""

ORACLES["corpus_stage_report"] = """
SELECT l.quality AS label, count(*)::BIGINT AS n_rows
FROM documents d JOIN labels l ON d.doc_id = l.doc_id GROUP BY l.quality
UNION ALL
SELECT NULL::INTEGER AS label, count(*)::BIGINT AS n_rows
FROM documents d JOIN labels l ON d.doc_id = l.doc_id
"""

ORACLES["audit_label_subject"] = """
SELECT l.quality AS label, d.source AS subject, count(*)::BIGINT AS n_articles
FROM documents d JOIN labels l ON d.doc_id = l.doc_id GROUP BY l.quality, d.source
"""

ORACLES["audit_publisher_mentions"] = r"""
SELECT l.quality AS label, count(*)::BIGINT AS n_articles,
  sum(CASE WHEN regexp_matches(coalesce(d.text, ''), '(?i)\breuters\b') THEN 1 ELSE 0 END)::BIGINT
    AS reuters_mentions,
  sum(CASE WHEN regexp_matches(coalesce(d.text, ''), '(?i)\bassociated press\b|\b\(ap\)\b') THEN 1 ELSE 0 END)::BIGINT
    AS ap_mentions,
  sum(CASE WHEN starts_with(ltrim(coalesce(d.text, '')), 'WASHINGTON (Reuters)')
        OR contains(substr(coalesce(d.text, ''), 1, 50), 'Reuters') THEN 1 ELSE 0 END)::BIGINT
    AS reuters_lead_signature
FROM documents d JOIN labels l ON d.doc_id = l.doc_id GROUP BY l.quality
"""


# --- model chain (vocabulary, weights, chi-square, scaling, one logistic step) ----
import numpy as _np  # noqa: E402

THRESH_HEX = format(int(0.2 * 16 ** 8), "08x")


def dbl(x: float) -> str:
    return f"{float(x)!r}::DOUBLE"


def all_docs_vocab_ctes() -> str:
    """Vocabulary over every document (min_df 2, max_df 0.98, top 5000)."""
    return f"""
    vd AS (SELECT doc_id, {full_clean_tokens_sql('text')} AS tokens FROM documents),
    vd2 AS (SELECT doc_id, tokens FROM vd WHERE len(tokens) > 0),
    vterms AS (
      SELECT doc_id, unnest(list_concat(tokens,
        list_transform(range(1, len(tokens)), lambda i: tokens[i] || ' ' || tokens[i + 1]))) AS term
      FROM vd2),
    vtf AS (SELECT doc_id, term, count(*) AS tf FROM vterms GROUP BY doc_id, term),
    vn AS (SELECT count(*) AS n FROM vd2),
    vdf AS (SELECT term, count(*) AS df, sum(tf) AS tf_total FROM vtf GROUP BY term),
    vocab AS (
      SELECT term, df, tf_total, ln((1.0::DOUBLE + n) / (1.0::DOUBLE + df)) + 1.0::DOUBLE AS idf
      FROM vdf, vn WHERE df >= 2 AND df <= {dbl(0.98)} * n
      ORDER BY tf_total DESC, term ASC LIMIT 5000),
    vw0 AS (SELECT t.doc_id, t.term, (1.0::DOUBLE + ln(t.tf)) * v.idf AS raw_w FROM vtf t JOIN vocab v ON t.term = v.term),
    vweights AS (SELECT doc_id, term, raw_w / sqrt(sum(raw_w * raw_w) OVER (PARTITION BY doc_id)) AS weight FROM vw0)"""


def logistic_steps(steps: int = 20, eta: float = 1.0, alpha: float = 1e-4, only: str = "", name: str = "") -> str:
    """Accelerated full-batch logistic regression, one pair of CTEs for each step; last CTE ``weights``.

    ``only`` filters the features, ``name`` ends the names of the CTEs."""
    return _logistic_steps(steps, eta, alpha, only).replace("lr_", f"lr{name}_").replace("trainx", f"trainx{name}").replace("weights AS", f"weights{name} AS")


def _logistic_steps(steps: int, eta: float, alpha: float, only: str) -> str:
    out = [f"""trainx AS MATERIALIZED (SELECT h.doc_id, h.feature, h.value FROM hybrid h JOIN train t ON h.doc_id = t.doc_id {only}),
    lr_s0 AS MATERIALIZED (
      SELECT f.feature, 0.0::DOUBLE AS w, 0.0::DOUBLE AS v FROM (SELECT DISTINCT feature FROM trainx) f
      UNION ALL SELECT '__bias__', ln(sum(label)::DOUBLE / (count(*) - sum(label))), ln(sum(label)::DOUBLE / (count(*) - sum(label))) FROM train)"""]
    for k in range(steps):
        out.append(f"""lr_r{k} AS MATERIALIZED (
      SELECT x.doc_id, 1.0::DOUBLE / (1.0::DOUBLE + exp(-(sum(x.value * s.v) + (SELECT v FROM lr_s{k} WHERE feature = '__bias__'))))
             - any_value(t.label) AS r
      FROM trainx x JOIN lr_s{k} s ON x.feature = s.feature JOIN train t ON x.doc_id = t.doc_id GROUP BY x.doc_id),
    lr_g{k} AS (
      SELECT x.feature, sum(r.r * x.value) / (SELECT n FROM ntr) AS g FROM trainx x JOIN lr_r{k} r ON x.doc_id = r.doc_id GROUP BY x.feature
      UNION ALL SELECT '__bias__', sum(r) / (SELECT n FROM ntr) FROM lr_r{k}),
    lr_w{k + 1} AS (
      SELECT s.feature, s.w AS old, s.v - {dbl(eta)} * (g.g + CASE WHEN s.feature = '__bias__' THEN 0.0::DOUBLE ELSE {dbl(alpha)} * s.v END) AS w
      FROM lr_s{k} s JOIN lr_g{k} g ON s.feature = g.feature),
    lr_s{k + 1} AS MATERIALIZED (SELECT feature, w, w + {dbl((k + 1) / (k + 4))} * (w - old) AS v FROM lr_w{k + 1})""")
    out.append(f"weights AS (SELECT feature, w AS weight FROM lr_s{steps})")
    return ",\n    ".join(out)


HASH_SPLIT = f"""CASE WHEN substr(sha256('42:' || doc_id::VARCHAR), 1, 8) < '{THRESH_HEX}' THEN 'test' ELSE 'train' END"""


def hash_key_sql(expr: str, salt: str) -> str:
    """The 60-bit number of a salted SHA-256."""
    return f"('0x' || substr(sha256('{salt}' || {expr}), 1, 15))::BIGINT"


def source_split_ctes(k: int = 5) -> str:
    """Sources dealt into ``k`` folds, largest first, each to the lightest fold; small ones by hash.  Last CTE ``folds``."""
    return f"""
    kept AS (SELECT doc_id, coalesce(subject, '') AS source FROM docs0 WHERE len(tokens) > 0),
    sizes AS (SELECT source, count(*) AS n FROM kept GROUP BY source),
    large AS MATERIALIZED (
      SELECT source, n, row_number() OVER (ORDER BY n DESC, encode(source)) AS r FROM sizes
      WHERE n * {k * 200} >= (SELECT sum(n) FROM sizes)),
    deal(r, loads, fold) AS (
      SELECT 0::BIGINT, list_transform(range({k}), lambda i: 0::BIGINT), -1::BIGINT
      UNION ALL
      SELECT l.r, list_transform(range(1, {k + 1}), lambda i: d.loads[i] + CASE WHEN i = list_position(d.loads, list_min(d.loads)) THEN l.n ELSE 0 END),
        list_position(d.loads, list_min(d.loads)) - 1
      FROM deal d JOIN large l ON l.r = d.r + 1),
    lack AS (
      SELECT list_transform(loads, lambda n: greatest(z.total // {k} + 1 - n, 0)) AS l
      FROM deal, (SELECT sum(n)::BIGINT AS total FROM sizes) z ORDER BY r DESC LIMIT 1),
    folds AS MATERIALIZED (
      SELECT l.source, d.fold FROM large l JOIN deal d ON d.r = l.r
      UNION ALL SELECT source, len(list_filter(range(1, {k}), lambda i: {hash_key_sql('source', 'source:')} % list_sum(l)::BIGINT >= list_sum(l[1:i])))
      FROM sizes, lack WHERE source NOT IN (SELECT source FROM large)),"""


SOURCE_SPLIT = """(SELECT CASE f.fold WHEN 0 THEN 'test' WHEN 1 THEN 'inner' ELSE 'train' END FROM folds f WHERE f.source = coalesce(subject, ''))"""


def model_ctes(split: str = HASH_SPLIT, before: str = "", min_df: int = 2, max_df: float = 0.98) -> str:
    """The whole labelled train-and-score chain; final CTE ``scored``."""
    scaled = ",\n".join(
        f"(f.{c} - m.mn_{c}) * (CASE WHEN m.mx_{c} - m.mn_{c} = 0 THEN 1.0::DOUBLE "
        f"ELSE 1.0::DOUBLE / (m.mx_{c} - m.mn_{c}) END) AS {c}" for c in FEATURES)
    mins = ", ".join(f"min(f.{c}) AS mn_{c}, max(f.{c}) AS mx_{c}" for c in FEATURES)
    dense_rows = " UNION ALL ".join(f"SELECT doc_id, 'dense:{c}' AS feature, {c} AS value FROM dense" for c in FEATURES)
    return f"""
    lab AS (SELECT d.doc_id, d.text, d.source AS subject, l.quality AS label FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
    firsts AS (SELECT text, min(doc_id) AS doc_id FROM lab WHERE text IS NOT NULL GROUP BY text),
    docs0 AS (SELECT lab.doc_id, lab.text, lab.subject, lab.label, {full_clean_tokens_sql('lab.text')} AS tokens
              FROM lab JOIN firsts ON lab.doc_id = firsts.doc_id),{before}
    docs AS MATERIALIZED (
      SELECT doc_id, text, subject, label, tokens, array_to_string(tokens, ' ') AS clean, {title_sql('text')} AS title,
        {split} AS split
      FROM docs0 WHERE len(tokens) > 0),
    train AS (SELECT doc_id, label FROM docs WHERE split = 'train'),
    ntrain AS (SELECT count(*) AS n FROM train),
    terms AS (
      SELECT doc_id, unnest(list_concat(tokens,
        list_transform(range(1, len(tokens)), lambda i: tokens[i] || ' ' || tokens[i + 1]))) AS term
      FROM docs),
    tf AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY doc_id, term),
    dfreq AS (SELECT term, count(*) AS df, sum(tf) AS tf_total FROM tf
              WHERE doc_id IN (SELECT doc_id FROM train) GROUP BY term),
    vocab AS (
      SELECT term, df, tf_total, ln((1.0::DOUBLE + n) / (1.0::DOUBLE + df)) + 1.0::DOUBLE AS idf
      FROM dfreq, ntrain WHERE df >= {min_df} AND df <= {dbl(max_df)} * n
      ORDER BY tf_total DESC, term ASC LIMIT 5000),
    w0 AS (SELECT t.doc_id, t.term, (1.0::DOUBLE + ln(t.tf)) * v.idf AS raw_w FROM tf t JOIN vocab v ON t.term = v.term),
    wts AS (SELECT doc_id, term, raw_w / sqrt(sum(raw_w * raw_w) OVER (PARTITION BY doc_id)) AS weight FROM w0),
    prior AS (SELECT (count(*) FILTER (WHERE label = 1))::DOUBLE / count(*) AS p1 FROM train),
    obs AS (
      SELECT w.term, sum(CASE WHEN t.label = 1 THEN w.weight ELSE 0.0::DOUBLE END) AS o1,
             sum(CASE WHEN t.label = 1 THEN 0.0::DOUBLE ELSE w.weight END) AS o0
      FROM wts w JOIN train t ON w.doc_id = t.doc_id GROUP BY w.term),
    chi AS (
      SELECT term, {q6('(o0 - (o0 + o1) * (1.0::DOUBLE - p1)) * (o0 - (o0 + o1) * (1.0::DOUBLE - p1)) / ((o0 + o1) * (1.0::DOUBLE - p1)) + (o1 - (o0 + o1) * p1) * (o1 - (o0 + o1) * p1) / ((o0 + o1) * p1)')} AS chi2
      FROM obs, prior),
    sel AS (SELECT term, chi2 FROM chi ORDER BY chi2 DESC, term DESC LIMIT 4000),
    fsrc AS (SELECT doc_id, coalesce(text, '') AS raw, clean, title FROM docs),
    {features_sql('fsrc')},
    mm AS (SELECT {mins} FROM fx f JOIN train t ON f.doc_id = t.doc_id),
    dense AS (SELECT f.doc_id, {scaled} FROM fx f, mm m),
    hybrid AS (
      SELECT w.doc_id, w.term AS feature, w.weight AS value FROM wts w JOIN sel s ON w.term = s.term
      UNION ALL {dense_rows}),
    ntr AS (SELECT count(*)::DOUBLE AS n FROM train),
    {logistic_steps()},
    margin AS (
      SELECT h.doc_id, sum(h.value * coalesce(w.weight, 0.0::DOUBLE)) + (SELECT weight FROM weights WHERE feature = '__bias__') AS m
      FROM hybrid h LEFT JOIN (SELECT * FROM weights WHERE feature <> '__bias__') w ON h.feature = w.feature
      GROUP BY h.doc_id),
    scored AS (
      SELECT d.doc_id, d.label, d.split, 1.0::DOUBLE / (1.0::DOUBLE + exp(-m.m)) AS p_real
      FROM margin m JOIN docs d ON m.doc_id = d.doc_id),
    test AS (SELECT doc_id, label, p_real FROM scored WHERE split = 'test')"""


def _with(body: str, select: str) -> str:
    return "WITH " + body.strip().rstrip(",") + "\n" + select


_M = model_ctes()
_V = all_docs_vocab_ctes()

ORACLES["tfidf_vocabulary"] = _with(_V, f"SELECT term, df::BIGINT AS df, tf_total::BIGINT AS tf_total, {q6('idf')} AS idf FROM vocab")
ORACLES["tfidf_weights"] = _with(_V, f"SELECT doc_id, term, {q6('weight')} AS weight FROM vweights")


def _with2(body: str, extra: str, select: str) -> str:
    return "WITH " + body.strip().rstrip(",") + ",\n" + extra.strip().rstrip(",") + "\n" + select


ORACLES["tfidf_top_tokens"] = _with2(_V, f"""
    qw AS (SELECT doc_id, term, {q6('weight')} AS weight FROM vweights),
    rk AS (SELECT doc_id, term, weight,
             row_number() OVER (PARTITION BY doc_id ORDER BY weight DESC, term ASC) AS rank FROM qw)""",
    "SELECT doc_id, term, weight, rank FROM rk WHERE rank <= 5")

ORACLES["chi2_selection"] = _with(_M, "SELECT term, chi2 FROM sel")
ORACLES["minmax_scaled_features"] = _with(_M, "SELECT doc_id, " + ", ".join(q6(c) + " AS " + c for c in FEATURES)
                                          + " FROM dense")
ORACLES["online_weights"] = _with(_M, f"SELECT feature, {q6('weight')} AS weight FROM weights")
ORACLES["scored_documents"] = _with(_M, f"""
SELECT doc_id, label, split, {q6('p_real')} AS p_real, {q6('1.0::DOUBLE - p_real')} AS p_fake,
  CASE WHEN p_real >= 0.5 THEN 1 ELSE 0 END AS pred,
  {q6('CASE WHEN p_real >= 0.5 THEN p_real ELSE 1.0::DOUBLE - p_real END')} AS confidence
FROM scored""")

ORACLES["eval_confusion"] = _with(_M, """
SELECT c.label, c.pred, coalesce(n.n, 0)::BIGINT AS n
FROM (SELECT * FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) v(label, pred)) c
LEFT JOIN (SELECT label, CASE WHEN p_real >= 0.5 THEN 1 ELSE 0 END AS pred, count(*) AS n FROM test GROUP BY 1, 2) n
  ON c.label = n.label AND c.pred = n.pred""")

_CELLS = """,
    cells AS (
      SELECT count(*) FILTER (WHERE label = 1 AND p_real >= 0.5) AS tp,
             count(*) FILTER (WHERE label = 0 AND p_real >= 0.5) AS fp,
             count(*) FILTER (WHERE label = 1 AND p_real < 0.5) AS fn,
             count(*) FILTER (WHERE label = 0 AND p_real < 0.5) AS tn FROM test),
    m AS (
      SELECT tp, fp, fn, tn,
        CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS p1,
        CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS r1,
        CASE WHEN tn + fn = 0 THEN 0.0 ELSE tn / (tn + fn) END AS p0,
        CASE WHEN tn + fp = 0 THEN 0.0 ELSE tn / (tn + fp) END AS r0
      FROM cells),
    m2 AS (
      SELECT *, CASE WHEN p1 + r1 = 0 THEN 0.0 ELSE 2 * p1 * r1 / (p1 + r1) END AS f1,
                CASE WHEN p0 + r0 = 0 THEN 0.0 ELSE 2 * p0 * r0 / (p0 + r0) END AS f0,
                tp + fn AS s1, tn + fp AS s0 FROM m)"""

ORACLES["eval_class_report"] = _with(_M + _CELLS, f"""
SELECT cls, {q6('precision')} AS precision, {q6('recall')} AS recall, {q6('f1')} AS f1, support::BIGINT AS support FROM (
  SELECT '0' AS cls, p0 AS precision, r0 AS recall, f0 AS f1, s0 AS support FROM m2
  UNION ALL SELECT '1', p1, r1, f1, s1 FROM m2
  UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, s0 + s1 FROM m2
  UNION ALL SELECT 'weighted avg',
    CASE WHEN s0 + s1 = 0 THEN 0.0 ELSE (p0 * s0 + p1 * s1) / (s0 + s1) END,
    CASE WHEN s0 + s1 = 0 THEN 0.0 ELSE (r0 * s0 + r1 * s1) / (s0 + s1) END,
    CASE WHEN s0 + s1 = 0 THEN 0.0 ELSE (f0 * s0 + f1 * s1) / (s0 + s1) END, s0 + s1 FROM m2)""")

_BYSCORE = """,
    bys AS (SELECT p_real, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg
            FROM test GROUP BY p_real),
    tot AS (SELECT sum(pos) AS P, sum(neg) AS N FROM bys)"""

ORACLES["eval_summary"] = _with(_M + _CELLS + _BYSCORE + """,
    auc AS (
      SELECT CASE WHEN (SELECT P FROM tot) = 0 OR (SELECT N FROM tot) = 0 THEN 1.0
        ELSE sum(pos * (coalesce(neg_below, 0) + 0.5 * neg)) / ((SELECT P FROM tot) * (SELECT N FROM tot)) END AS a
      FROM (SELECT pos, neg, sum(neg) OVER (ORDER BY p_real ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS neg_below
            FROM bys))""", f"""
SELECT {q6('CASE WHEN tp + tn + fp + fn = 0 THEN 0.0 ELSE (tp + tn) / (tp + tn + fp + fn) END')} AS accuracy,
  {q6('p1')} AS precision, {q6('r1')} AS recall, {q6('f1')} AS f1,
  {q6('CASE WHEN tn + fp = 0 THEN 0.0 ELSE fp / (tn + fp) END')} AS fpr,
  {q6('CASE WHEN tp + fn = 0 THEN 0.0 ELSE fn / (tp + fn) END')} AS fnr,
  {q6('(SELECT a FROM auc)')} AS roc_auc,
  CASE WHEN (tp + tn) / (tp + tn + fp + fn) >= 0.8 THEN 'PASS' ELSE 'WARN' END AS status
FROM m2""")

ORACLES["eval_roc_curve"] = _with(_M + _BYSCORE, f"""
SELECT {q6('p_real')} AS threshold,
  {q6('CASE WHEN N = 0 THEN 0.0 ELSE cn / N END')} AS fpr, {q6('CASE WHEN P = 0 THEN 0.0 ELSE cp / P END')} AS tpr
FROM (SELECT p_real, sum(pos) OVER (ORDER BY p_real DESC) AS cp, sum(neg) OVER (ORDER BY p_real DESC) AS cn FROM bys), tot""")

ORACLES["eval_pr_curve"] = _with(_M + _BYSCORE + """,
    pr AS (SELECT p_real, pos, cp / (cp + cn) AS precision, CASE WHEN P = 0 THEN 0.0 ELSE cp / P END AS recall
           FROM (SELECT p_real, pos, sum(pos) OVER (ORDER BY p_real DESC) AS cp,
                        sum(neg) OVER (ORDER BY p_real DESC) AS cn FROM bys), tot),
    ap AS (SELECT CASE WHEN (SELECT P FROM tot) = 0 THEN 0.0 ELSE sum(pos / (SELECT P FROM tot) * precision) END AS ap FROM pr)""",
    f"SELECT {q6('p_real')} AS threshold, {q6('precision')} AS precision, {q6('recall')} AS recall, "
    f"{q6('(SELECT ap FROM ap)')} AS average_precision FROM pr")

_EDGES = "[" + ", ".join(dbl(x) for x in _np.linspace(0.0, 1.0, 11)[1:-1]) + "]"
ORACLES["eval_calibration"] = _with(_M, f"""
SELECT bin, {q6('avg(p_real)')} AS mean_predicted, {q6('avg(label::DOUBLE)')} AS fraction_positive, count(*)::BIGINT AS n
FROM (SELECT p_real, label, len(list_filter({_EDGES}, lambda e: e < p_real)) AS bin FROM test) GROUP BY bin""")

_GRID = " UNION ALL ".join(f"SELECT {i} AS idx, {dbl(t)} AS threshold" for i, t in enumerate(_np.linspace(0.1, 0.9, 81)))
_SWEEP = f""",
    grid AS ({_GRID}),
    sweep AS (
      SELECT g.idx, g.threshold,
        count(t.doc_id) FILTER (WHERE t.label = 1 AND t.p_real >= g.threshold) AS tp,
        count(t.doc_id) FILTER (WHERE t.label = 0 AND t.p_real >= g.threshold) AS fp,
        (SELECT count(*) FROM test WHERE label = 1) AS P
      FROM grid g LEFT JOIN test t ON TRUE GROUP BY g.idx, g.threshold),
    f1s AS (SELECT idx, {q6('threshold')} AS threshold,
              {q6('CASE WHEN 2 * tp + fp + (P - tp) = 0 THEN 0.0 ELSE 2 * tp / (2 * tp + fp + (P - tp)) END')} AS f1
            FROM sweep)"""
ORACLES["eval_threshold_sweep"] = _with(_M + _SWEEP, "SELECT idx, threshold, f1 FROM f1s")
ORACLES["eval_best_threshold"] = _with(_M + _SWEEP, """
SELECT coalesce((SELECT threshold FROM f1s WHERE f1 > 0 ORDER BY f1 DESC, idx ASC LIMIT 1), 0.5) AS best_threshold,
       coalesce((SELECT f1 FROM f1s WHERE f1 > 0 ORDER BY f1 DESC, idx ASC LIMIT 1), 0.0) AS best_f1""")

ORACLES["eval_hardest_errors"] = _with(_M, f"""
SELECT e.doc_id, e.label, e.pred, e.confidence, substr(d.text, 1, 350) AS excerpt FROM (
  SELECT doc_id, label, CASE WHEN p_real >= 0.5 THEN 1 ELSE 0 END AS pred,
    {q6('CASE WHEN p_real >= 0.5 THEN p_real ELSE 1.0::DOUBLE - p_real END')} AS confidence
  FROM test WHERE (CASE WHEN p_real >= 0.5 THEN 1 ELSE 0 END) <> label
  ORDER BY confidence DESC, doc_id ASC LIMIT 5) e JOIN docs d ON e.doc_id = d.doc_id""")

ORACLES["model_top_coefficients"] = _with(_M, f"""
SELECT direction, feature, {q6('weight')} AS weight FROM (
  (SELECT 'fake' AS direction, feature, weight FROM weights
   WHERE feature <> '__bias__' AND NOT starts_with(feature, 'dense:') ORDER BY weight ASC, feature ASC LIMIT 15)
  UNION ALL
  (SELECT 'real' AS direction, feature, weight FROM weights
   WHERE feature <> '__bias__' AND NOT starts_with(feature, 'dense:') ORDER BY weight DESC, feature ASC LIMIT 15))""")

ORACLES["explain_top_words"] = _with(_M, f"""
SELECT doc_id, direction, rank, feature, {q6('contribution')} AS contribution FROM (
  SELECT doc_id, direction, feature, contribution,
    row_number() OVER (PARTITION BY doc_id, direction ORDER BY (floor((abs(contribution)) * 1000000.0 + 0.5) / 1000000.0) DESC, feature ASC) AS rank
  FROM (
    SELECT h.doc_id, h.feature, h.value * w.weight AS contribution,
      CASE WHEN h.value * w.weight > 0 THEN 'real' ELSE 'fake' END AS direction
    FROM hybrid h JOIN weights w ON h.feature = w.feature
    WHERE h.doc_id IN (SELECT doc_id FROM test) AND w.feature <> '__bias__'
      AND NOT starts_with(h.feature, 'dense:') AND h.value * w.weight <> 0))
WHERE rank <= 8""")


def _category_rows() -> str:
    from credlens.operators.linear import CATEGORY_KEYWORDS
    rows = []
    for col, display in zip(FEATURES, lx.DENSE_FEATURE_DISPLAY_NAMES):
        for cat, kws in CATEGORY_KEYWORDS.items():
            if any(kw in display.lower() for kw in kws):
                rows.append(f"({s('dense:' + col)}, {s(cat)})")
    return ", ".join(rows)


ORACLES["explain_categories"] = _with(_M, f"""
SELECT h.doc_id, c.category, {q6('sum(h.value * w.weight)')} AS contribution
FROM hybrid h JOIN weights w ON h.feature = w.feature
JOIN (SELECT * FROM (VALUES {_category_rows()}) v(feature, category)) c ON h.feature = c.feature
WHERE h.doc_id IN (SELECT doc_id FROM test)
GROUP BY h.doc_id, c.category""")


# --- pages and trust -------------------------------------------------------------
def _trust_sql() -> str:
    exact = ", ".join(f"({s(d)}, {sc}, {s(desc)}, 'Trusted')" for d, sc, desc in lx.TRUSTED_DOMAINS)
    exact += ", " + ", ".join(f"({s(d)}, {sc}, {s(desc)}, 'Low Trust')" for d, sc, desc in lx.LOW_TRUST_DOMAINS)
    cases_score, cases_status = [], []
    for suffixes, sc, desc in lx.SUFFIX_RULES:
        cond = " OR ".join(f"ends_with(h.domain, {s(x)})" for x in suffixes)
        cases_score.append(f"WHEN {cond} THEN {sc}")
        cases_status.append(f"WHEN {cond} THEN {s(desc)}")
    return f"""
WITH h0 AS (
  SELECT page_id, url, lower(regexp_extract(coalesce(url, ''), '^(?:[A-Za-z][A-Za-z0-9+.\\-]*:)?//([^/?#]*)', 1)) AS host
  FROM pages),
h AS (SELECT page_id, url, CASE WHEN starts_with(host, 'www.') THEN substr(host, 5) ELSE host END AS domain FROM h0),
reg AS (SELECT * FROM (VALUES {exact}) v(domain, score, status, badge))
SELECT h.page_id,
  CASE WHEN h.url IS NULL OR trim(h.url) = '' THEN 'N/A' ELSE h.domain END AS domain,
  CASE WHEN h.url IS NULL OR trim(h.url) = '' THEN 50
       ELSE coalesce(r.score, CASE {' '.join(cases_score)} ELSE 50 END) END::INTEGER AS score,
  CASE WHEN h.url IS NULL OR trim(h.url) = '' THEN 'No URL provided'
       ELSE coalesce(r.status, CASE {' '.join(cases_status)} ELSE {s(lx.TRUST_DEFAULT[1])} END) END AS status,
  CASE WHEN h.url IS NULL OR trim(h.url) = '' THEN 'Unverified'
       ELSE coalesce(r.badge, CASE WHEN {' OR '.join(f"ends_with(h.domain, {s(x)})" for sfx, _, _ in lx.SUFFIX_RULES for x in sfx)}
                                   THEN 'Trusted' ELSE 'Neutral' END) END AS badge
FROM h LEFT JOIN reg r ON h.domain = r.domain"""


ORACLES["domain_trust"] = _trust_sql()

ORACLES["page_title_regex"] = r"""
SELECT page_id,
  CASE WHEN regexp_matches(html, '(?is)<h1[^>]*>(.*?)</h1>')
         THEN trim(regexp_replace(regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1), '<[^>]*>', '', 'g'))
       WHEN regexp_matches(html, '(?is)<title[^>]*>(.*?)</title>')
         THEN trim(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '<[^>]*>', '', 'g'))
       ELSE 'Untitled Article' END AS title
FROM pages"""

ORACLES["page_language"] = r"""
SELECT page_id,
  CASE WHEN lang = '' THEN 'en' ELSE lower(split_part(lang, '-', 1)) END AS language
FROM (SELECT page_id, trim(trim(trim(regexp_extract(html,
  '(?i)<html[^>]*[ \t\n]lang[ \t\n]*=[ \t\n]*("[^"]*"|''[^'']*''|[^ \t\n"''>]+)', 1), '"'),  )) AS lang FROM pages)"""


# --- rules ---------------------------------------------------------------------------
def _re_escape(w: str) -> str:
    import re as _re
    return _re.escape(w)


def _distinct_word_hits(col: str, words) -> str:
    return "(" + " + ".join(f"(CASE WHEN regexp_matches({col}, {s(chr(92) + 'b' + _re_escape(w) + chr(92) + 'b')}) "
                            "THEN 1 ELSE 0 END)" for w in words) + ")"


def _occurrences(col: str, words) -> str:
    return "(" + " + ".join(f"len(regexp_extract_all({col}, {s(chr(92) + 'b' + _re_escape(w) + chr(92) + 'b')}))"
                            for w in words) + ")"


def _strip(col: str) -> str:
    return f"regexp_replace({col}, '^[{WS}]+|[{WS}]+$', '', 'g')"


def _burst(col: str) -> str:
    sents = f"list_filter(list_transform(string_split(coalesce({col}, ''), '.'), lambda x: {_strip('x')}), lambda x: x <> '')"
    counts = f"list_transform({sents}, lambda x: len({py_split('x')})::DOUBLE)"
    return f"(CASE WHEN len({sents}) > 3 THEN list_aggregate({counts}, 'var_pop') ELSE 20.0 END)"


def _ai_prob(cl: str, var: str) -> str:
    return (f"least(0.95, (CASE WHEN {cl} >= 1 THEN 0.12 * least(4, {cl}) ELSE 0.0 END)"
            f" + (CASE WHEN {var} < 18.0 THEN 0.35 ELSE 0.0 END))")


ORACLES["ai_style_scores"] = f"""
WITH b AS (
  SELECT doc_id, {_distinct_word_hits("lower(coalesce(text, ''))", lx.AI_CLICHES)} AS cl, {_burst('text')} AS var
  FROM documents)
SELECT doc_id, cl::BIGINT AS cliche_count, {q6('var')} AS variance, {q6(_ai_prob('cl', 'var'))} AS ai_prob FROM b"""

_SENT_MARK = "chr(57344)"
_SENTS = (f"list_filter(list_transform(string_split(regexp_replace(coalesce(text, ''), '([.!?])[{WS}]+', "
          f"'\\1' || {_SENT_MARK}, 'g'), {_SENT_MARK}), lambda x: {_strip('x')}), lambda x: x <> '')")
_CLAIM_HIT = " OR ".join(f"contains(lower(x), {s(k)})" for k in lx.CLAIM_KEYWORDS)
ORACLES["search_queries"] = f"""
WITH q AS (
  SELECT doc_id,
    split_part({_strip('coalesce(text, ' + "''" + ')')}, chr(10), 1) AS first,
    list_filter({_SENTS}, lambda x: {_CLAIM_HIT}) AS hits
  FROM documents),
q2 AS (
  SELECT doc_id,
    CASE WHEN len({py_split('first')}) > 10 THEN array_to_string({py_split('first')}[1:10], ' ') ELSE first END AS primary_query,
    CASE WHEN len(hits) = 0 THEN NULL
         WHEN len({py_split('hits[-1]')}) > 12 THEN array_to_string({py_split('hits[-1]')}[1:12], ' ')
         ELSE hits[-1] END AS claim
  FROM q)
SELECT doc_id, primary_query,
  CASE WHEN claim IS NOT NULL AND NOT contains(primary_query, claim) THEN claim ELSE NULL END AS claim_query
FROM q2"""


def _category_sql(text: str, title: str) -> str:
    parts = []
    for name, words in lx.FAILURE_CATEGORY_RULES:
        cond = " OR ".join(f"contains(lower({text}), {s(w)}) OR contains(lower({title}), {s(w)})" for w in words)
        parts.append(f"WHEN {cond} THEN {s(name)}")
    click = " OR ".join(f"contains(lower({title}), {s(w)})" for w in lx.CLICKBAIT_TITLE_WORDS)
    parts.append(f"WHEN len({py_split('lower(' + title + ')')}) < {lx.CLICKBAIT_TITLE_MAX_WORDS} AND ({click}) "
                 f"THEN {s(lx.FAILURE_CATEGORY_CLICKBAIT)}")
    return "CASE " + " ".join(parts) + f" ELSE {s(lx.FAILURE_CATEGORY_DEFAULT)} END"


_ERRORS = """,
    errs AS (
      SELECT s.doc_id, s.label, s.p_real, CASE WHEN s.p_real >= 0.5 THEN 1 ELSE 0 END AS pred, d.text, d.title
      FROM scored s JOIN docs d ON s.doc_id = d.doc_id
      WHERE s.split = 'test' AND (CASE WHEN s.p_real >= 0.5 THEN 1 ELSE 0 END) <> s.label)"""

ORACLES["failure_categories"] = _with(_M + _ERRORS, f"""
SELECT {_category_sql('coalesce(text, ' + "''" + ')', 'title')} AS category, count(*)::BIGINT AS n_errors
FROM errs GROUP BY 1""")


def _rationale_sql(col: str) -> str:
    parts = " ".join(f"WHEN {col} = {s(k)} THEN {s(v)}" for k, v in lx.FAILURE_RATIONALES.items())
    return f"CASE {parts} ELSE {s(lx.FAILURE_RATIONALE_DEFAULT)} END"


ORACLES["error_samples"] = _with(_M + _ERRORS + f""",
    ec AS (SELECT *, {_category_sql('coalesce(text, ' + "''" + ')', 'title')} AS category FROM errs)""", f"""
SELECT doc_id, label, pred, {q6('p_real')} AS p_real, category, {_rationale_sql('category')} AS rationale,
  substr(text, 1, 250) AS excerpt
FROM ec ORDER BY doc_id LIMIT 10""")

_SENS = " OR ".join(f"regexp_matches(lt, {s(chr(92) + 'b' + _re_escape(w) + chr(92) + 'b')})" for w in lx.SENSATIONAL_WORDS)
_REASONS = [
    ("clickbait_ratio > 0.05", "✓ Clickbait word density is higher than normal."),
    ("emotion_intensity > 0.02", "✓ Sentiment bias/sensational vocabulary intensity is high."),
    ("flesch_reading_ease < 50.0", "✓ Article readability requires advanced parsing."),
    ("50 < 60", "✓ Domain trust rating is relatively low/unverified."),
    ("50 >= 80", "✓ Domain trust aligns with high-authority press registries."),
    ("lexical_diversity < 0.4", "✓ Lexical vocabulary density is low."),
]
_REASON_LIST = ("list_filter([" + ", ".join(f"CASE WHEN {c} THEN {s(m)} ELSE NULL END" for c, m in _REASONS)
                + "], lambda x: x IS NOT NULL)")

ORACLES["article_audit"] = _with(_M + f""",
    a0 AS (
      SELECT f.*, sc.p_real * 100.0 AS ml, lower(d.text) AS lt, d.text AS text0,
        {_occurrences('lower(d.text)', lx.FAKE_INDICATORS)} AS n_ind,
        {_distinct_word_hits('lower(d.text)', lx.AI_CLICHES)} AS cl, {_burst('d.text')} AS var
      FROM fx f JOIN scored sc ON f.doc_id = sc.doc_id JOIN docs d ON f.doc_id = d.doc_id),
    a1 AS (
      SELECT *, CASE WHEN {_SENS} THEN greatest(10.0, ml - 30.0 * greatest(0.2, (100.0 - ml) / 100.0)) ELSE ml END AS h0
      FROM a0),
    a2 AS (
      SELECT *, CASE WHEN n_ind >= 2
        THEN greatest(5.0, h0 - least(35.0, 8.0 * n_ind * greatest(0.1, (100.0 - ml) / 100.0))) ELSE h0 END AS h1
      FROM a1),
    a3 AS (
      SELECT *, CASE WHEN {_ai_prob('cl', 'var')} > 0.65
        THEN greatest(5.0, h1 - 12.0 * greatest(0.1, (100.0 - h1) / 100.0)) ELSE h1 END AS final
      FROM a2)""", f"""
SELECT doc_id, {q6('final')} AS real_score, {q6('100.0 - final')} AS fake_score,
  CASE WHEN 100.0 - final >= 50.0 THEN 'HIGH RISK MISINFORMATION' ELSE 'VERIFIED AUTHENTIC CONTEXT' END AS verdict,
  CASE WHEN 100.0 - final >= 70.0 THEN 'HIGH' WHEN 100.0 - final >= 40.0 THEN 'MEDIUM' ELSE 'LOW' END AS risk,
  CASE WHEN flesch_reading_ease < 50.0 THEN 'Difficult' WHEN flesch_reading_ease < 80.0 THEN 'Standard' ELSE 'Easy' END
    AS readability,
  CASE WHEN polarity < -0.2 THEN 'Highly Negative' WHEN polarity > 0.2 THEN 'Positive' ELSE 'Neutral' END AS sentiment,
  array_to_string({_REASON_LIST}[1:5], '|') AS reasons
FROM a3""")


# --- nearest neighbours ---------------------------------------------------------------
_KNN = f"""
WITH e AS (
  SELECT vec_id, embedding::DOUBLE[] AS v, label,
    CASE WHEN substr(sha256('42:' || vec_id::VARCHAR), 1, 8) < '{THRESH_HEX}' THEN 'test' ELSE 'train' END AS split
  FROM embeddings),
pairs AS (
  SELECT q.vec_id AS qid, q.label AS qlabel, r.vec_id AS rid, r.label AS rlabel,
    sqrt(list_reduce(list_transform(list_zip(q.v, r.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])), lambda a, b: a + b)) AS d
  FROM e q JOIN e r ON q.split = 'test' AND r.split = 'train'),
nn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY d, rid) AS rk FROM pairs) WHERE rk <= 9),
wt AS (
  SELECT qid, qlabel, rlabel,
    CASE WHEN max(CASE WHEN d = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY qid) = 1
         THEN (CASE WHEN d = 0 THEN 1.0 ELSE 0.0 END) ELSE 1.0 / d END AS w
  FROM nn),
votes AS (SELECT qid, qlabel, rlabel, sum(w) AS score FROM wt GROUP BY qid, qlabel, rlabel),
best AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, rlabel ASC) AS r FROM votes)
"""
ORACLES["knn_predictions"] = _KNN + "SELECT qid AS vec_id, qlabel AS label, rlabel AS pred FROM best WHERE r = 1"
ORACLES["knn_accuracy"] = _KNN + f"""SELECT count(*)::BIGINT AS n,
  {q6('avg(CASE WHEN rlabel = qlabel THEN 1.0 ELSE 0.0 END)')} AS accuracy FROM best WHERE r = 1"""


ORACLES["stream_routing"] = _with(_M + """,
    rt AS (
      SELECT CASE WHEN p_real >= 0.5 THEN 1 ELSE 0 END AS pred,
        CASE WHEN p_real >= 0.5 THEN p_real ELSE 1.0::DOUBLE - p_real END AS conf FROM scored)""", f"""
SELECT CASE WHEN conf >= {dbl(lx.ELITE_THRESHOLD)} THEN 'pseudo_label'
            WHEN conf < {dbl(lx.REVIEW_THRESHOLD)} THEN 'review' ELSE 'ignored' END AS route,
  count(*)::BIGINT AS n_articles, sum(pred)::BIGINT AS n_pred_real
FROM rt GROUP BY 1""")


# --- integrity pairing ---------------------------------------------------------------------
def _sentence_keys(table: str, id_col: str) -> str:
    norm = f"regexp_replace(regexp_replace(lower(s), '[^\\p{{L}}\\p{{N}}_{WS}]', '', 'g'), '^[{WS}]+|[{WS}]+$', '', 'g')"
    sents = (f"list_filter(list_transform(string_split(regexp_replace(coalesce(text, ''), '([.!?])[{WS}]+', "
             f"'\\1' || {_SENT_MARK}, 'g'), {_SENT_MARK}), lambda x: {_strip('x')}), lambda x: x <> '')")
    return f"""SELECT DISTINCT {id_col}, sha256({norm}) AS key FROM (
      SELECT {id_col}, unnest({sents}) AS s FROM {table}) WHERE len({py_split('s')}) >= 3"""


ORACLES["integrity_pairs"] = f"""
WITH dk AS ({_sentence_keys('documents', 'doc_id')}),
rk AS ({_sentence_keys('benchmark', 'item_id')}),
sh AS (SELECT dk.doc_id, rk.item_id, count(*)::BIGINT AS n_shared FROM dk JOIN rk ON dk.key = rk.key GROUP BY 1, 2)
SELECT d.doc_id, b.item_id, coalesce(b.n_shared, 0)::BIGINT AS n_shared FROM documents d LEFT JOIN (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n_shared DESC, item_id ASC) AS r FROM sh) b
  ON d.doc_id = b.doc_id AND b.r = 1"""


# --- more corpus operators -------------------------------------------------------------------
ORACLES["seeded_order"] = "SELECT doc_id, sha256('42:' || doc_id::VARCHAR) AS shuffle_key FROM documents"

_HN = ", ".join(f"({r['label']}, {s(r['subject'])})" for r in lx.HARD_NEGATIVES)
ORACLES["hard_negative_corpus"] = f"""
SELECT label, subject, count(*)::BIGINT AS n_articles FROM (
  SELECT l.quality AS label, d.source AS subject FROM documents d JOIN labels l ON d.doc_id = l.doc_id
  UNION ALL SELECT * FROM (VALUES {_HN}) v(label, subject))
GROUP BY label, subject"""

ORACLES["split_sources"] = _with(_M, """
SELECT d.split, x.source, count(*)::BIGINT AS n_articles
FROM docs d JOIN documents x ON d.doc_id = x.doc_id GROUP BY d.split, x.source""")

ORACLES["prediction_cache"] = _with(_M + """,
    stored AS (SELECT sha256(d.text) AS hash, s.p_real FROM scored s JOIN docs d ON s.doc_id = d.doc_id),
    req AS (SELECT doc_id, sha256(coalesce(text, '')) AS hash FROM documents)""", f"""
SELECT (SELECT count(*) FROM req JOIN stored ON req.hash = stored.hash)::BIGINT AS n_hits,
  {q6('(SELECT avg(stored.p_real) FROM req JOIN stored ON req.hash = stored.hash)')} AS avg_cached_p_real,
  (SELECT count(DISTINCT hash) FROM req WHERE hash NOT IN (SELECT hash FROM stored))::BIGINT AS n_distinct_misses""")

_DENSE_MODEL = """,
    """ + logistic_steps(only="WHERE starts_with(h.feature, 'dense:')", name="_d") + """,
    m2 AS (
      SELECT h.doc_id, sum(h.value * w.weight) + (SELECT weight FROM weights_d WHERE feature = '__bias__') AS m
      FROM hybrid h JOIN weights_d w ON h.feature = w.feature GROUP BY h.doc_id)"""
ORACLES["model_consensus"] = _with(_M + _DENSE_MODEL + """,
    lp AS (
      SELECT doc_id, p_real FROM test
      UNION ALL SELECT m2.doc_id, 1.0::DOUBLE / (1.0::DOUBLE + exp(-m2.m)) FROM m2 WHERE m2.doc_id IN (SELECT doc_id FROM test)),
    g AS (
      SELECT doc_id, count(*) AS n_models, avg(p_real * 100.0) AS mean_c,
        avg(CASE WHEN p_real >= 0.5 THEN 1.0 ELSE 0.0 END) * 100.0 AS share,
        avg(CASE WHEN p_real >= 0.5 THEN p_real * 100.0 END) AS real_conf,
        avg(CASE WHEN p_real < 0.5 THEN (1.0 - p_real) * 100.0 END) AS fake_conf
      FROM lp GROUP BY doc_id)""", f"""
SELECT doc_id,
  {q6('CASE WHEN share > 50 THEN real_conf WHEN share < 50 THEN 100.0 - fake_conf ELSE 50.0 END')} AS vote_consensus,
  {q6('share')} AS real_share, n_models::BIGINT AS n_models, {q6('mean_c')} AS mean_consensus
FROM g""")


# --- TXT-19, WIN-08, PRJ-06 -----------------------------------------------------------------
_W_SB = py_split("lower(text)")
ORACLES["sentiment_bias"] = f"""
SELECT doc_id, {q6(f"CASE WHEN len({_W_SB}) = 0 THEN 0.0 ELSE ({_lexcount(_W_SB, lx.STREAM_POSITIVE_WORDS)} - {_lexcount(_W_SB, lx.STREAM_NEGATIVE_WORDS)}) / len({_W_SB}) END")} AS sentiment_bias
FROM documents"""

ORACLES["first_sample_per_label"] = """
SELECT doc_id, label, substr(text, 1, 150) AS excerpt FROM (
  SELECT d.doc_id, l.quality AS label, d.text, row_number() OVER (PARTITION BY l.quality ORDER BY d.doc_id) AS r
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id) WHERE r = 1"""

ORACLES["cross_source_split"] = f"""
SELECT CASE WHEN substr(sha256('42:' || d.doc_id::VARCHAR), 1, 8) < '{THRESH_HEX}' THEN 'test' ELSE 'train' END AS split,
  l.quality AS label, count(*)::BIGINT AS n_articles
FROM documents d JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1, 2"""


ORACLES["explain_dense_ranked"] = _with(_M, f"""
SELECT h.doc_id, h.feature, {q6('h.value * w.weight')} AS contribution,
  row_number() OVER (PARTITION BY h.doc_id ORDER BY {q6('abs(h.value * w.weight)')} DESC, h.feature ASC)::BIGINT AS rank
FROM hybrid h JOIN weights w ON h.feature = w.feature JOIN docs d ON h.doc_id = d.doc_id
WHERE starts_with(h.feature, 'dense:') AND d.split = 'test'""")


# --- MLT-13: held-out sources, threshold from inner sources ------------------------------------
_X = "RECURSIVE " + model_ctes(SOURCE_SPLIT, source_split_ctes(), 5, 0.90).strip()
_XSWEEP = _SWEEP.replace("test t ON", "inner_rows t ON").replace("FROM test WHERE", "FROM inner_rows WHERE")
_XFLOW = _X + """,
    inner_rows AS (SELECT doc_id, label, p_real FROM scored WHERE split = 'inner')""" + _XSWEEP + """,
    frozen AS (SELECT coalesce((SELECT threshold FROM f1s WHERE f1 > 0 ORDER BY f1 DESC, idx ASC LIMIT 1), 0.5) AS threshold),
    judged AS MATERIALIZED (
      SELECT s.doc_id, s.split, s.label, s.p_real, CASE WHEN s.p_real >= z.threshold THEN 1 ELSE 0 END AS pred, d.text, d.title, coalesce(d.subject, '') AS source
      FROM scored s JOIN docs d ON d.doc_id = s.doc_id, frozen z WHERE s.split IN ('inner', 'test'))"""
ORACLES["cross_source_eval"] = _with(_XFLOW + """,
    counted AS (
      SELECT split, count(*) AS n, count(DISTINCT source) AS n_sources,
        count(*) FILTER (WHERE label = 1 AND pred = 1) AS tp, count(*) FILTER (WHERE label = 0 AND pred = 1) AS fp,
        count(*) FILTER (WHERE label = 1 AND pred = 0) AS fn, count(*) FILTER (WHERE label = 0 AND pred = 0) AS tn
      FROM judged GROUP BY split),
    ranks AS (
      SELECT a.split, sum(CASE WHEN b.p_real < a.p_real THEN 1.0 WHEN b.p_real = a.p_real THEN 0.5 ELSE 0.0 END) AS s
      FROM judged a JOIN judged b ON a.split = b.split AND a.label = 1 AND b.label = 0 GROUP BY a.split)""", f"""
SELECT c.split AS part, n::BIGINT AS n_articles, n_sources::BIGINT AS n_sources, (SELECT threshold FROM frozen) AS threshold,
  {q6('(tp + tn) / n')} AS accuracy, {q6('CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END')} AS precision,
  {q6('CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END')} AS recall,
  {q6('CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2 * tp / (2 * tp + fp + fn) END')} AS f1,
  {q6('CASE WHEN tn + fp = 0 THEN 0.0 ELSE fp / (tn + fp) END')} AS fpr, {q6('CASE WHEN tp + fn = 0 THEN 0.0 ELSE fn / (tp + fn) END')} AS fnr,
  {q6('CASE WHEN (tp + fn) * (tn + fp) = 0 THEN 1.0 ELSE r.s / ((tp + fn) * (tn + fp)) END')} AS roc_auc,
  CASE WHEN (tp + tn) / n >= 0.8 THEN 'PASS' ELSE 'WARN' END AS status
FROM counted c LEFT JOIN ranks r ON r.split = c.split""")
ORACLES["cross_source_failures"] = _with(_XFLOW + f""",
    xerr AS (SELECT *, {_category_sql("coalesce(text, '')", 'title')} AS category FROM judged WHERE split = 'test' AND pred <> label)""", f"""
SELECT doc_id, source, label, pred, {q6('p_real')} AS p_real, {q6('1.0::DOUBLE - p_real')} AS p_fake, category,
  {_rationale_sql('category')} AS rationale FROM xerr""")
ORACLES["source_folds"] = _with("RECURSIVE " + f"""
    docs0 AS (SELECT d.doc_id, d.source AS subject, [1] AS tokens FROM documents d),{source_split_ctes()}
    named AS (SELECT k.source, f.fold, count(*) AS n FROM kept k JOIN folds f ON f.source = k.source GROUP BY 1, 2)""",
    "SELECT source, fold::INTEGER AS fold, n::BIGINT AS n_documents FROM named")
ORACLES["stratified_split"] = f"""
WITH keyed AS (SELECT doc_id, quality AS label, {hash_key_sql('doc_id::VARCHAR', '42:')} AS k FROM labels),
ranked AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY k) AS r, count(*) OVER (PARTITION BY label) AS n FROM keyed)
SELECT doc_id, label, CASE WHEN r <= floor(0.2::DOUBLE * n + 0.5) THEN 'test' ELSE 'train' END AS split FROM ranked"""


# --- MLT-03, MLT-07, MLT-09: steepest descent with a line search, Platt scaling ----------------
from credlens.operators.batchfit import ARMIJO, LADDER, PLATT_REACH, PLATT_STEPS  # noqa: E402


def _loss_sql(m: str) -> str:
    return (f"(CASE c.loss WHEN 'logistic' THEN greatest({m}, 0.0) + ln(1.0::DOUBLE + exp(-abs({m}))) - u.y * ({m}) "
            f"ELSE power(greatest(0.0, 1.0::DOUBLE - (2.0 * u.y - 1.0) * ({m})), 2) END)")


def descent_ctes(cands: str, steps: int) -> str:
    """Descent of the candidates (cand, loss, c, fold_out); CTEs ``dw`` (cand, feature, w), ``dm`` (cand, doc_id, m), ``dl``
    (cand, l).  All rows get margins, those of the left-out fold and of the test split do not train."""
    out = [f"""cands AS (SELECT * FROM (VALUES {cands}) v(cand, loss, c, fold_out)),
    every_row AS MATERIALIZED (
      SELECT doc_id, label::DOUBLE AS y, label, split, {hash_key_sql('doc_id::VARCHAR', 'fold:')} % 3 AS fold FROM docs),
    used AS MATERIALIZED (SELECT c.cand, e.doc_id, e.y FROM cands c JOIN every_row e ON e.split = 'train' AND e.fold <> c.fold_out),
    used_n AS MATERIALIZED (SELECT u.cand, count(*)::DOUBLE AS n FROM used u GROUP BY u.cand),
    xs AS MATERIALIZED (SELECT doc_id, feature, value FROM hybrid WHERE value <> 0 UNION ALL SELECT doc_id, '__bias__', 1.0::DOUBLE FROM every_row),
    names AS (SELECT DISTINCT feature FROM hybrid UNION ALL SELECT '__bias__'),
    pen AS MATERIALIZED (
      SELECT c.cand, f.feature, CASE WHEN f.feature = '__bias__' AND c.loss = 'logistic' THEN 0.0::DOUBLE ELSE 1.0::DOUBLE / (c.c * n.n) END AS p
      FROM cands c JOIN used_n n ON n.cand = c.cand CROSS JOIN names f),
    dw0 AS (SELECT cand, feature, 0.0::DOUBLE AS w FROM pen),
    dm0 AS (SELECT c.cand, e.doc_id, 0.0::DOUBLE AS m FROM cands c CROSS JOIN every_row e),
    dl0 AS (SELECT cand, CASE loss WHEN 'logistic' THEN ln(2.0::DOUBLE) ELSE 1.0::DOUBLE END AS l FROM cands)"""]
    ladder = "[" + ", ".join(dbl(t) for t in LADDER) + "]"
    for k in range(steps):
        out.append(f"""ds{k} AS MATERIALIZED (
      SELECT u.cand, u.doc_id, CASE c.loss WHEN 'logistic' THEN 1.0::DOUBLE / (1.0::DOUBLE + exp(-m.m)) - u.y
        ELSE -2.0 * (2.0 * u.y - 1.0) * greatest(0.0, 1.0::DOUBLE - (2.0 * u.y - 1.0) * m.m) END AS r
      FROM used u JOIN cands c ON c.cand = u.cand JOIN dm{k} m ON m.cand = u.cand AND m.doc_id = u.doc_id),
    dg{k} AS MATERIALIZED (
      SELECT p.cand, p.feature, coalesce(s.g, 0.0) / n.n + p.p * w.w AS g, p.p, w.w FROM pen p JOIN used_n n ON n.cand = p.cand
      JOIN dw{k} w ON w.cand = p.cand AND w.feature = p.feature
      LEFT JOIN (SELECT r.cand, x.feature, sum(r.r * x.value) AS g FROM ds{k} r JOIN xs x ON x.doc_id = r.doc_id GROUP BY 1, 2) s
        ON s.cand = p.cand AND s.feature = p.feature),
    dd{k} AS MATERIALIZED (
      SELECT g.cand, x.doc_id, -sum(x.value * g.g) AS d FROM xs x JOIN dg{k} g ON g.feature = x.feature GROUP BY 1, 2),
    dt{k} AS (
      SELECT a.cand, a.t, a.l + q.l AS l, q.slope FROM (
        SELECT u.cand, j.t, sum({_loss_sql('m.m + j.t * d.d')}) / any_value(n.n) AS l
        FROM used u JOIN cands c ON c.cand = u.cand JOIN used_n n ON n.cand = u.cand JOIN dm{k} m ON m.cand = u.cand AND m.doc_id = u.doc_id
        JOIN dd{k} d ON d.cand = u.cand AND d.doc_id = u.doc_id CROSS JOIN (SELECT unnest({ladder}) AS t) j GROUP BY u.cand, j.t) a
      JOIN (SELECT g.cand, j.t, 0.5 * sum(g.p * power(g.w - j.t * g.g, 2)) AS l, -sum(g.g * g.g) AS slope
            FROM dg{k} g CROSS JOIN (SELECT unnest({ladder}) AS t) j GROUP BY g.cand, j.t) q ON q.cand = a.cand AND q.t = a.t),
    dp{k} AS MATERIALIZED (
      SELECT t.cand, max(t.t) AS t, arg_max(t.l, t.t) AS l FROM dt{k} t JOIN dl{k} o ON o.cand = t.cand
      WHERE t.l <= o.l + {dbl(ARMIJO)} * t.t * t.slope GROUP BY t.cand),
    dw{k + 1} AS MATERIALIZED (SELECT g.cand, g.feature, g.w - p.t * g.g AS w FROM dg{k} g JOIN dp{k} p ON p.cand = g.cand),
    dm{k + 1} AS MATERIALIZED (
      SELECT m.cand, m.doc_id, m.m + p.t * d.d AS m FROM dm{k} m JOIN dd{k} d ON d.cand = m.cand AND d.doc_id = m.doc_id
      JOIN dp{k} p ON p.cand = m.cand),
    dl{k + 1} AS MATERIALIZED (SELECT cand, l FROM dp{k})""")
    out.append(f"dw AS (SELECT * FROM dw{steps}), dm AS (SELECT * FROM dm{steps}), dl AS (SELECT * FROM dl{steps})")
    return ",\n    ".join(out)


def platt_ctes() -> str:
    """Platt scaling of (cand, m, y) in ``pr``; last CTE ``sigmoids`` (cand, a, b)."""
    out = ["""pt0 AS MATERIALIZED (
      SELECT cand, 0.0::DOUBLE AS a, ln((sum(y) + 1.0) / (sum(1.0 - y) + 1.0)) AS b, (sum(y) + 1.0) / (sum(y) + 2.0) AS hi,
        1.0::DOUBLE / (sum(1.0 - y) + 2.0) AS lo FROM pr GROUP BY cand)"""]
    for k in range(PLATT_STEPS):
        out.append(f"""pq{k} AS (
      SELECT r.cand, r.m, 1.0::DOUBLE / (1.0::DOUBLE + exp(-(s.a * r.m + s.b))) AS p, CASE WHEN r.y = 1.0 THEN s.hi ELSE s.lo END AS z
      FROM pr r JOIN pt{k} s ON s.cand = r.cand),
    ph{k} AS (
      SELECT cand, sum((p - z) * m) AS ga, sum(p - z) AS gb, sum(p * (1.0 - p) * m * m) + 1e-9 AS haa, sum(p * (1.0 - p) * m) AS hab,
        sum(p * (1.0 - p)) + 1e-9 AS hbb FROM pq{k} GROUP BY cand),
    pd{k} AS (
      SELECT cand, (hbb * ga - hab * gb) / (haa * hbb - hab * hab) AS da, (haa * gb - hab * ga) / (haa * hbb - hab * hab) AS db FROM ph{k}),
    pt{k + 1} AS MATERIALIZED (
      SELECT s.cand, s.a - least(1.0, {dbl(PLATT_REACH)} / greatest(abs(da), abs(db), 1e-300)) * da AS a,
        s.b - least(1.0, {dbl(PLATT_REACH)} / greatest(abs(da), abs(db), 1e-300)) * db AS b, s.hi, s.lo FROM pt{k} s JOIN pd{k} d ON d.cand = s.cand)""")
    out.append(f"sigmoids AS (SELECT cand, a, b FROM pt{PLATT_STEPS})")
    return ",\n    ".join(out)


def _upto_hybrid(ctes: str) -> str:
    """The flow up to the hybrid features, without its own logistic fit."""
    return ctes[:ctes.index("    ntr AS (")].rstrip().rstrip(",")


_H = _upto_hybrid(_M)
_GRID_CANDS = ", ".join(f"({i}, '{loss}', {dbl(c)}, {o})" for i, (loss, c, o) in enumerate(
    (loss, c, o) for loss in ("logistic", "squared_hinge") for c in (0.1, 1.0, 10.0) for o in range(3)))
_FOLD_SVMS = ", ".join(f"({o}, 'squared_hinge', {dbl(1.0)}, {o})" for o in range(3))
ORACLES["ml_grid_descent"] = _with2(_H, descent_ctes(_GRID_CANDS, 6), f"""
SELECT c.loss, c.c AS "C", c.fold_out::INTEGER AS fold_out, n.n::BIGINT AS n_train, {q6('any_value(l.l)')} AS objective, count(*)::BIGINT AS n_held,
  count(*) FILTER (WHERE (m.m >= 0) = (e.label = 1))::BIGINT AS n_right
FROM cands c JOIN used_n n ON n.cand = c.cand JOIN dl l ON l.cand = c.cand JOIN dm m ON m.cand = c.cand
JOIN every_row e ON e.doc_id = m.doc_id AND e.split = 'train' AND e.fold = c.fold_out GROUP BY c.loss, c.c, c.fold_out, n.n""")
ORACLES["svm_weights"] = _with2(_H, descent_ctes(f"(0, 'squared_hinge', {dbl(1.0)}, -1)", 6), f"SELECT feature, {q6('w')} AS weight FROM dw")
ORACLES["svm_calibrated"] = _with2(_H, descent_ctes(_FOLD_SVMS, 6) + """,
    pr AS MATERIALIZED (SELECT m.cand, m.m, e.y FROM dm m JOIN every_row e ON e.doc_id = m.doc_id AND e.split = 'train' AND e.fold = m.cand),
    """ + platt_ctes(), f"""
SELECT m.doc_id, {q6('sum(1.0::DOUBLE / (1.0::DOUBLE + exp(-(s.a * m.m + s.b)))) / 3')} AS p_real
FROM dm m JOIN every_row e ON e.doc_id = m.doc_id AND e.split = 'test' JOIN sigmoids s ON s.cand = m.cand GROUP BY m.doc_id""")

ORACLES["registry_scores"] = _with(_X + _DENSE_MODEL + """,
    two_models AS MATERIALIZED (
      SELECT s.doc_id, s.label, s.split, s.p_real AS p_hybrid, 1.0::DOUBLE / (1.0::DOUBLE + exp(-m2.m)) AS p_dense,
        (1.0::DOUBLE / (1.0::DOUBLE + exp(-m2.m)) + s.p_real) / 2 AS p_real FROM scored s JOIN m2 ON m2.doc_id = s.doc_id),
    inner_rows AS (SELECT doc_id, label, p_real FROM two_models WHERE split = 'inner')""" + _XSWEEP + """,
    frozen AS (SELECT coalesce((SELECT threshold FROM f1s WHERE f1 > 0 ORDER BY f1 DESC, idx ASC LIMIT 1), 0.5) AS threshold)""", f"""
SELECT doc_id, {q6('p_hybrid')} AS p_hybrid, {q6('p_dense')} AS p_dense, {q6('p_real')} AS p_real,
  CASE WHEN p_real >= threshold THEN 1 ELSE 0 END AS pred, threshold FROM two_models, frozen""")

_AFTER_DOCS = _M[_M.index("    train AS (SELECT doc_id, label FROM docs"):]
_JUDGED = f"""count(*)::BIGINT AS n_test, count(*) FILTER (WHERE (p_real >= 0.5) <> (label = 1))::BIGINT AS n_errors,
  {q6("avg(CASE WHEN (p_real >= 0.5) = (label = 1) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)")} AS accuracy,
  {q6("avg(-ln(greatest(CASE WHEN label = 1 THEN p_real ELSE 1.0::DOUBLE - p_real END, 1e-15)))")} AS log_loss"""
ORACLES["replay_retrain"] = _with(_M + f""",
    missed AS MATERIALIZED (SELECT doc_id FROM scored WHERE split = 'test' AND (p_real >= 0.5) <> (label = 1)),
    docs_before AS MATERIALIZED (SELECT * FROM docs),
    docs_after AS MATERIALIZED (
      SELECT * FROM docs_before UNION ALL
      SELECT -1 - doc_id, text, subject, label, tokens, clean, title, 'train' FROM docs_before WHERE doc_id IN (SELECT doc_id FROM missed)),
    scored_after AS MATERIALIZED (WITH docs AS MATERIALIZED (SELECT * FROM docs_after),
{_AFTER_DOCS}
    SELECT doc_id, label, split, p_real FROM scored)""", f"""
SELECT 'before' AS phase, (SELECT count(*) FROM docs_before WHERE split = 'train')::BIGINT AS n_train, {_JUDGED} FROM scored WHERE split = 'test'
UNION ALL
SELECT 'after', (SELECT count(*) FROM docs_after WHERE split = 'train')::BIGINT, {_JUDGED} FROM scored_after WHERE split = 'test'""")


# --- STR-09: epochs over chunks ------------------------------------------------------------------
def chunk_steps(n_chunks: int, n_epochs: int, eta: float = 1.0, alpha: float = 1e-4) -> str:
    """One online step per chunk and epoch; last CTE ``cw``."""
    out = [f"""crows AS MATERIALIZED (SELECT doc_id, label, {hash_key_sql('doc_id::VARCHAR', 'chunk:')} % {n_chunks} AS chunk FROM train),
    cx AS MATERIALIZED (SELECT h.doc_id, h.feature, h.value FROM hybrid h JOIN crows c ON c.doc_id = h.doc_id),
    cw0 AS (SELECT feature, 0.0::DOUBLE AS w FROM (SELECT DISTINCT feature FROM cx UNION ALL SELECT '__bias__'))"""]
    for k in range(n_chunks * n_epochs):
        out.append(f"""cr{k} AS MATERIALIZED (
      SELECT x.doc_id, 1.0::DOUBLE / (1.0::DOUBLE + exp(-(sum(x.value * w.w) + (SELECT w FROM cw{k} WHERE feature = '__bias__')))) - any_value(c.label) AS r
      FROM cx x JOIN cw{k} w ON w.feature = x.feature JOIN crows c ON c.doc_id = x.doc_id AND c.chunk = {k % n_chunks} GROUP BY x.doc_id),
    cg{k} AS (
      SELECT x.feature, sum(r.r * x.value) / (SELECT count(*) FROM cr{k}) AS g FROM cx x JOIN cr{k} r ON r.doc_id = x.doc_id GROUP BY x.feature
      UNION ALL SELECT '__bias__', sum(r) / count(*) FROM cr{k}),
    cw{k + 1} AS MATERIALIZED (
      SELECT w.feature, w.w - {dbl(eta)} * (coalesce(g.g, 0.0) + CASE WHEN w.feature = '__bias__' THEN 0.0 ELSE {dbl(alpha)} * w.w END) AS w
      FROM cw{k} w LEFT JOIN cg{k} g ON g.feature = w.feature)""")
    out.append(f"cw AS (SELECT * FROM cw{n_chunks * n_epochs})")
    return ",\n    ".join(out)


ORACLES["chunked_epochs"] = _with2(_H, chunk_steps(3, 2), f"SELECT feature, {q6('w')} AS weight FROM cw")

# --- JON-04, JON-06, RUL-01, RUL-02 with evidence, RUL-10 ------------------------------------------


def _ev_hits(words) -> str:
    return _distinct_word_hits("ct", words)


def _sub_hits(col: str, words) -> str:
    return " + ".join(f"(CASE WHEN contains({col}, {s(w)}) THEN 1 ELSE 0 END)" for w in words)


ORACLES["evidence_audit"] = _with2(_M, f"""
    dk AS ({_sentence_keys('docs', 'doc_id')}),
    bk AS ({_sentence_keys('benchmark', 'item_id')}),
    shared AS (SELECT d.doc_id, b.item_id, count(*) AS n FROM dk d JOIN bk b ON d.key = b.key GROUP BY 1, 2),
    evid AS MATERIALIZED (
      SELECT r.doc_id, r.rank, b.item_id, b.text AS snippet, lower({title_sql('b.text')} || ' ' || b.text) AS ct FROM (
        SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, item_id) AS rank FROM shared) r
      JOIN benchmark b ON b.item_id = r.item_id WHERE r.rank <= 3),
    hits AS (
      SELECT doc_id, count(*) AS n_results, sum({_ev_hits(lx.EVIDENCE_FAKE_SIGNALS)}) AS fake_hits, sum({_ev_hits(lx.EVIDENCE_REAL_SIGNALS)}) AS real_hits,
        sum({_sub_hits('ct', lx.VERDICT_FAKE_SIGNALS)}) AS vf, sum({_sub_hits('ct', lx.VERDICT_REAL_SIGNALS)}) AS vr,
        min(CASE WHEN length(trim(snippet)) > 100 THEN rank END) AS usable FROM evid GROUP BY doc_id),
    e0 AS (
      SELECT d.doc_id, sc.p_real * 100.0 AS ml, lower(d.text) AS lt, coalesce(h.n_results, 0) AS n_results, coalesce(h.fake_hits, 0) AS fh,
        coalesce(h.real_hits, 0) AS rh, coalesce(h.vf, 0) AS vf, coalesce(h.vr, 0) AS vr, h.usable,
        {_occurrences('lower(d.text)', lx.FAKE_INDICATORS)} AS n_ind, {_distinct_word_hits('lower(d.text)', lx.AI_CLICHES)} AS cl, {_burst('d.text')} AS var
      FROM docs d JOIN scored sc ON sc.doc_id = d.doc_id LEFT JOIN hits h ON h.doc_id = d.doc_id),
    e1 AS (
      SELECT *, greatest(0.2, (100.0 - ml) / 100.0) AS cf2, greatest(0.1, (100.0 - ml) / 100.0) AS cf1 FROM e0),
    e2 AS (
      SELECT *, CASE WHEN n_results > 0 THEN
          CASE WHEN fh > rh THEN greatest(5.0, ml - least(30.0, 8.0 * (fh - rh) * cf2)) WHEN rh > fh THEN least(98.0, ml + least(15.0, 4.0 * (rh - fh))) ELSE ml END
        ELSE CASE WHEN {_SENS} THEN greatest(10.0, ml - 30.0 * cf2) ELSE ml END END AS h0 FROM e1),
    e3 AS (SELECT *, CASE WHEN n_ind >= 2 THEN greatest(5.0, h0 - least(35.0, 8.0 * n_ind * cf1)) ELSE h0 END AS hybrid FROM e2),
    e4 AS (
      SELECT *, CASE WHEN {_ai_prob('cl', 'var')} > 0.65 AND n_results = 0
        THEN greatest(5.0, hybrid - 12.0 * greatest(0.1, (100.0 - hybrid) / 100.0)) ELSE hybrid END AS final FROM e3)""", f"""
SELECT e.doc_id, (({_sub_hits('lt', lx.SENSATIONAL_WORDS)}) > 0 OR ml = 50.0) AS wants_evidence, n_results::BIGINT AS n_results, fh::BIGINT AS fake_hits, rh::BIGINT AS real_hits,
  CASE WHEN vf > vr THEN 'FAKE / HOAX (Confirmed by live fact-checkers)' WHEN vr > vf THEN 'REAL / VERIFIED (Confirmed by live reports)'
    ELSE 'INCONCLUSIVE (No definitive search signal)' END AS search_verdict, {q6('hybrid')} AS hybrid, {q6('final')} AS final,
  'passage:' || v.item_id AS reference_url,
  CASE WHEN 100.0 - final >= 50.0 THEN 'HIGH RISK MISINFORMATION' ELSE 'VERIFIED AUTHENTIC CONTEXT' END AS verdict,
  CASE WHEN 100.0 - final >= 70.0 THEN 'HIGH' WHEN 100.0 - final >= 40.0 THEN 'MEDIUM' ELSE 'LOW' END AS risk
FROM e4 e LEFT JOIN evid v ON v.doc_id = e.doc_id AND v.rank = e.usable""")


# --- SRC-03, PAG-08/09 -----------------------------------------------------------------------------
ORACLES["training_projection"] = _with(_M[:_M.index("    train AS (")], "SELECT clean AS clean_text, label::INTEGER AS label FROM docs")
ORACLES["page_text_stats"] = f"""
WITH p AS (SELECT page_id, regexp_replace(html, '<[^>]*>', ' ', 'g') AS text FROM pages),
c AS (
  SELECT page_id, text, len({py_split('text')}) AS w, greatest(1, length(text) - length(replace(replace(replace(text, '.', ''), '!', ''), '?', ''))) AS sentences
  FROM (SELECT page_id, coalesce(text, '') AS text FROM p))
SELECT page_id, w::BIGINT AS word_count, length(text)::BIGINT AS article_length,
  {q6('greatest(0.5::DOUBLE, floor(w / 200.0::DOUBLE * 10 + 0.5) / 10)')} AS reading_time, CASE WHEN w < 50 OR sentences < 3 THEN 1 ELSE 0 END AS poor_quality FROM c"""
