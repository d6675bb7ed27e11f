"""Text-cleaning operators as Spark column expressions (TXT-*, PRJ-05/08/09/10).

Everything here compiles to JVM-side expressions (regexp_replace, split,
higher-order array functions), so it runs inside whole-stage codegen with no
Python on the hot path.  Regex patterns are written for Java's engine with the
flags that give the same meaning as the original Python ``re`` patterns:

* ``(?U)`` makes ``\\b``/``\\w`` Unicode-aware as in Python 3.
* ``(?d)`` (UNIX_LINES) makes ``.`` and ``$`` treat only ``\\n`` as a line end.
* Python's ``\\s`` also matches ``\\x1c-\\x1f`` and a few Unicode spaces, which
  Java's ``\\s`` does not; ``WS`` below spells the Python set out.
* Python's ``\\w`` is letters, numbers and ``_``: ``[\\p{L}\\p{N}_]``.
"""

from __future__ import annotations

from collections import OrderedDict

from pyspark.sql import Column
from pyspark.sql import functions as F

from credlens.functions import lexicons as lx

# Python's whitespace set (str.isspace) as a character-class body.
WS = (r"\t\n\x{0B}\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
      r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}")
# The ASCII part of it (after non-ASCII characters are gone).
ASCII_WS = r"\t\n\x{0B}\f\r\x{1C}-\x{1F} "
WORD = r"\p{L}\p{N}_"


def _alt(words) -> str:
    return "|".join(words)


# FIXED VALUES: cleaning patterns (the reference's regular expressions, written for Java
# with the explicit Python whitespace / word classes above)
# --- TXT-02 / TXT-03: leakage patterns ------------------------------------
DATELINE_RE = (
    "(?i)^[" + WS + "]*[A-Z" + WS + "]+(?:[" + WS + r"]*\([^)]+\))?[" + WS + "]*[-—][" + WS + "]*"
    "|^[" + WS + r"]*\([^)]*(?:" + _alt(lx.DATELINE_AGENCIES_LEAKAGE) + r")[^)]*\)["
    + WS + "]*[-—][" + WS + "]*"
)
ATTRIBUTION_RE = (
    r"(?iU)\bvia[" + WS + r"]+[@#]?[A-Za-z0-9_]+\b|\bvia[" + WS + r"]+twitter\b|\bvia["
    + WS + r"]+facebook\b"
)
URL_RE = r"https?://[^" + WS + r"]+|www\.[^" + WS + r"]+"


def clean_text(col: Column) -> Column:
    """TXT-01 leakage cleaner.

    dateline -> attribution -> lower -> URLs -> non-word chars -> standalone
    digit runs -> collapse spaces.  After the non-word step the string holds
    only word characters and spaces, so "standalone digit run" is exactly a
    space-delimited token made of decimal digits; dropping such tokens and
    re-joining on one space also performs the collapse-and-trim step.
    """
    t = F.regexp_replace(col, DATELINE_RE, " ")
    t = F.regexp_replace(t, ATTRIBUTION_RE, " ")
    t = F.lower(t)
    t = F.regexp_replace(t, URL_RE, " ")
    t = F.regexp_replace(t, "[^" + WORD + "]", " ")
    toks = F.filter(F.split(t, " "), lambda w: (w != "") & ~w.rlike(r"^\p{Nd}+$"))
    return F.when(col.isNull(), F.lit("")).otherwise(F.array_join(toks, " "))


def tokenize_and_filter(col: Column, stopwords=None) -> Column:
    """TXT-04: split on single spaces, drop empty tokens and stopwords (keeps duplicates)."""
    sw = list(stopwords if stopwords is not None else lx.STOPWORDS)
    toks = F.filter(F.split(F.coalesce(col, F.lit("")), " "), lambda w: (w != "") & ~w.isin(sw))
    return F.array_join(toks, " ")


def _contraction_rules(table: dict) -> list[tuple[str, str]]:
    """Derive a few grouped regex rewrites from the contraction table.

    Entries that share the same tail rewrite (``n't`` -> `` not``, ``'ll`` ->
    `` will`` ...) become one alternation with a back-reference to the kept
    head, so the whole table costs ~11 regex passes instead of 37.  Expansions
    contain no apostrophe, so applying groups one after another equals one
    simultaneous pass.
    """
    groups: "OrderedDict[tuple[str, str], list[str]]" = OrderedDict()
    for key, expansion in table.items():
        n = 0
        while n < min(len(key), len(expansion)) and key[n] == expansion[n]:
            n += 1
        groups.setdefault((key[n:], expansion[n:]), []).append(key[:n])
    rules = []
    for (key_tail, exp_tail), heads in groups.items():
        pattern = r"(?U)\b(" + "|".join(heads) + ")" + key_tail + r"\b"
        rules.append((pattern, "$1" + exp_tail))
    return rules


CONTRACTION_RULES = _contraction_rules(lx.CONTRACTIONS)
REPEAT_RE = r"(?d)(.)\1{2,}"
NON_ASCII_RE = r"[^\x00-\x7F]+"
FULL_DATELINE_RE = (r"^[a-z" + ASCII_WS + r"\.,\-_\|]+("
                    + "|".join(r"\(" + a + r"\)[^\-]*\-" for a in lx.DATELINE_AGENCIES_FULL) + ")")
PUBLISHER_RE = r"\b(" + _alt(lx.PUBLISHER_NAMES) + r")\b"
READ_MORE_RE = r"(?d)\bread more via\b.*$"
ASCII_URL_RE = r"https?://[^" + ASCII_WS + r"]+|www\.[^" + ASCII_WS + r"]+"
EMAIL_RE = r"[^" + ASCII_WS + r"]+@[^" + ASCII_WS + r"]+"
TOKEN_RE = r"\b[a-z]{3,15}\b"


def _where_found(col: Column, marks, step) -> Column:
    """``step(col)`` in rows that hold one of the literals ``marks``, without which ``step`` changes nothing.

    The lambda's variable stands for the value, so ``col`` is evaluated once, however often it is named."""
    def once(t):
        found = F.instr(t, marks[0]) > 0
        for m in marks[1:]:
            found = found | (F.instr(t, m) > 0)
        return F.when(found, step(t)).otherwise(t)
    return F.transform(F.array(col), once).getItem(0)


def _without(pattern: str):
    return lambda t: F.regexp_replace(t, pattern, "")


def expand_contractions(col: Column) -> Column:
    """TXT-07 (input already lower-case)."""
    for pattern, repl in CONTRACTION_RULES:
        tail = pattern[pattern.rindex(")") + 1:-len(r"\b")]  # a literal
        col = _where_found(col, [tail], lambda t, p=pattern, r=repl: F.regexp_replace(t, p, r))
    return col


def full_clean_tokens(col: Column, stopwords=None) -> Column:
    """TXT-05..15 up to the token list (array<string>)."""
    sw = list(stopwords if stopwords is not None else lx.CLEANER_STOPWORDS)
    t = F.translate(col, lx.SMART_PUNCT_FROM, lx.SMART_PUNCT_TO)   # TXT-06
    t = F.lower(t)
    # TXT-07: every contraction contains an apostrophe, so rows without one skip the contraction passes
    t = _where_found(t, ["'"], expand_contractions)
    t = F.regexp_replace(t, REPEAT_RE, "$1$1")                      # TXT-08
    t = F.regexp_replace(t, NON_ASCII_RE, " ")                      # TXT-09
    t = _where_found(t, ["("], _without(FULL_DATELINE_RE))          # TXT-10
    t = F.regexp_replace(t, PUBLISHER_RE, "")                       # TXT-11
    t = _where_found(t, ["read more via"], _without(READ_MORE_RE))  # TXT-12
    t = _where_found(t, ["http", "www."], _without(ASCII_URL_RE))   # TXT-13
    t = _where_found(t, ["@"], _without(EMAIL_RE))
    toks = F.regexp_extract_all(t, F.lit(TOKEN_RE), 0)              # TXT-14
    toks = F.filter(toks, lambda w: ~w.isin(sw))                    # TXT-15
    return F.when(col.isNull() | (col == ""), F.array().cast("array<string>")).otherwise(toks)


def full_preprocess(col: Column, stopwords=None) -> Column:
    """TXT-05 full cleaner: tokens joined by one space; null/'' -> ''."""
    return F.array_join(full_clean_tokens(col, stopwords), " ")


def py_split(col: Column) -> Column:
    """Python ``str.split()``: split on runs of whitespace, no empty tokens."""
    return F.filter(F.split(F.coalesce(col, F.lit("")), "[" + WS + "]+"), lambda w: w != "")


def light_normalise(col: Column) -> Column:
    """PRJ-05: collapse whitespace, trim, lower-case."""
    return F.lower(F.array_join(py_split(col), " "))


def first_line(col: Column) -> Column:
    """Title proxy for tables without a title: text before the first newline."""
    return F.split(F.coalesce(col, F.lit("")), "\n", 2).getItem(0)


def sentences(col: Column) -> Column:
    """TXT-16: split after ``.!?`` followed by whitespace; stripped, non-empty."""
    parts = F.split(F.coalesce(col, F.lit("")), r"(?<=[.!?])[" + WS + "]+")
    return F.filter(F.transform(parts, lambda s: _py_strip(s)), lambda s: s != "")


def _py_strip(col: Column) -> Column:
    return F.regexp_replace(col, "^[" + WS + "]+|[" + WS + "]+$", "")


def dot_sentences(col: Column) -> Column:
    """TXT-17: split on '.', stripped, non-blank."""
    return F.filter(F.transform(F.split(F.coalesce(col, F.lit("")), r"\."), _py_strip),
                    lambda s: s != "")


def sentence_normalise(col: Column) -> Column:
    """TXT-18: lower, drop characters that are neither word nor space, trim."""
    return _py_strip(F.regexp_replace(F.lower(col), "[^" + WORD + WS + "]", ""))


def text_or_title(text: Column, title: Column) -> Column:
    """PRJ-09: text, or the title when text is null/empty."""
    return F.when(F.coalesce(text, F.lit("")) == "", F.coalesce(title, F.lit(""))).otherwise(text)


def strip_source_suffix(title: Column) -> Column:
    """PRJ-10: drop the last ' - ' segment of a headline."""
    parts = F.split(title, " - ")
    return F.when(F.size(parts) > 1,
                  F.array_join(F.slice(parts, 1, F.size(parts) - 1), " - ")).otherwise(title)


def content_hash(col: Column, n: int | None = None) -> Column:
    """TXT-21: sha256 hex of the UTF-8 text, optionally its first ``n`` chars."""
    h = F.sha2(F.coalesce(col, F.lit("")), 256)
    return F.substring(h, 1, n) if n else h


def word_count_in(tokens: Column, words) -> Column:
    """Number of tokens (with repeats) that belong to a word list."""
    return F.size(F.filter(tokens, lambda w: w.isin(list(words))))


def distinct_substring_hits(lower_text: Column, phrases) -> Column:
    """How many of the phrases occur at least once (substring test)."""
    return sum(F.contains(lower_text, F.lit(p)).cast("int") for p in phrases)


def char_count(col: Column, chars_class: str) -> Column:
    """Number of characters matching a regex character class."""
    return F.length(col) - F.length(F.regexp_replace(col, chars_class, ""))


def substring_count(col: Column, sub: str) -> Column:
    """Non-overlapping occurrences of a literal substring (``str.count``)."""
    return ((F.length(col) - F.length(F.replace(col, F.lit(sub), F.lit("")))) / len(sub)).cast("long")
