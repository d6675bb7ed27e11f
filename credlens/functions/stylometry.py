"""FEA-01..32: the 32 stylometric / readability / lexicon features per document.

One ``select`` of column expressions; tokens are staged once as array columns
and every feature is computed from them with built-in higher-order functions.
No UDF, no shuffle: the whole job is a narrow map that stays inside whole-stage
codegen and scales linearly with text volume.

Hapax counting avoids the quadratic "count every distinct word" approach: the
token array is sorted once and a token is a hapax when it equals no
neighbour (O(n log n) per document).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from credlens.functions import lexicons as lx
from credlens.functions import text as tx

FEATURE_COLUMNS = [
    "lexical_diversity", "type_token_ratio", "hapax_ratio", "avg_sentence_len", "avg_word_len",
    "punct_density", "digit_ratio", "uppercase_ratio", "stopword_ratio",
    "flesch_reading_ease", "flesch_kincaid_grade", "gunning_fog", "coleman_liau", "smog_index",
    "polarity", "subjectivity", "emotion_intensity",
    "excessive_punct", "clickbait_ratio", "all_caps_ratio", "sensational_ratio", "urgency_ratio",
    "hedging_ratio", "certainty_ratio",
    "title_length_chars", "title_length_words", "article_length_chars",
    "paragraph_count", "quotation_count", "external_links", "word_count", "reading_time",
]


@dataclass(frozen=True)
class Lexicons:
    """Word lists used by the lexicon features; defaults are the fixed lists."""
    stopwords: list = field(default_factory=lambda: list(lx.STOPWORDS))
    positive: list = field(default_factory=lambda: list(lx.POSITIVE_WORDS))
    negative: list = field(default_factory=lambda: list(lx.NEGATIVE_WORDS))
    emotional: list = field(default_factory=lambda: list(lx.EMOTIONAL_VOCABULARY))
    clickbait: list = field(default_factory=lambda: list(lx.CLICKBAIT_WORDS))
    sensational: list = field(default_factory=lambda: list(lx.SENSATIONAL_PHRASES))
    urgency: list = field(default_factory=lambda: list(lx.URGENCY_INDICATORS))
    hedging: list = field(default_factory=lambda: list(lx.HEDGING_WORDS))
    certainty: list = field(default_factory=lambda: list(lx.CERTAINTY_WORDS))


def _clamp(c: Column, lo: float, hi: float) -> Column:
    return F.greatest(F.lit(lo), F.least(F.lit(hi), c))


#: A word with three vowels or more; possessive runs, so a word is walked once from each of its first vowels.
THREE_VOWELS_RE = "[aeiou][^aeiou]*+[aeiou][^aeiou]*+[aeiou]"


def _vowels(c: Column) -> Column:
    return F.length(c) - F.length(F.translate(c, "aeiou", ""))


def _hapax_count(sorted_tokens: Column) -> Column:
    """Tokens occurring once: the distinct tokens without those that equal their successor.

    Only whole-array expressions are used (no lookups into an outer array from
    inside a lambda, which Spark would re-evaluate per element).
    """
    s = sorted_tokens
    repeated = F.zip_with(s, F.slice(s, 2, F.greatest(F.size(s), F.lit(1))), lambda c, n: F.when(c == n, c))
    return F.size(F.array_distinct(s)) - F.size(F.filter(F.array_distinct(repeated), lambda c: c.isNotNull()))


def dense_feature_columns(raw: Column, title: Column, lex: Lexicons | None = None) -> list[Column]:
    """32 feature columns (in feature order) from raw text, the tokens of its cleaned text, and title.

    Expects ``raw``/``title`` to be non-null strings.
    Staging columns ``_w`` (whitespace tokens of raw), ``_lw`` (these in lower case), ``_cw`` (tokens of
    the cleaned text) and ``_cws`` (sorted) must already exist; see :func:`with_dense_features`.
    """
    lex = lex or Lexicons()
    words, lower_words, cw = F.col("_w"), F.col("_lw"), F.col("_cw")
    n_words = F.size(words)
    nW = F.greatest(n_words, F.lit(1)).cast("double")
    nC = F.greatest(F.size(cw), F.lit(1)).cast("double")
    nch = F.greatest(F.length(raw), F.lit(1)).cast("double")
    n_sent_raw = (tx.substring_count(raw, ".") + tx.substring_count(raw, "!")
                  + tx.substring_count(raw, "?"))
    nS = F.greatest(n_sent_raw, F.lit(1)).cast("double")
    lower_raw = F.lower(raw)
    syl = F.greatest(n_words, _vowels(lower_raw)).cast("double")
    asl = n_words / nS
    complex_words = F.size(F.filter(lower_words, lambda w: w.rlike(THREE_VOWELS_RE))).cast("double")
    # of the sorted tokens, as in the hapax count: Spark evaluates it once for both
    distinct = F.size(F.array_distinct(F.col("_cws"))).cast("double")
    pos = tx.word_count_in(cw, lex.positive)
    neg = tx.word_count_in(cw, lex.negative)
    letters_digits = tx.char_count(raw, "[a-zA-Z0-9]+")
    L = letters_digits / nW * 100.0
    S = nS / nW * 100.0
    title_len = F.length(title)
    cols = [
        distinct / nC,
        distinct / nC,
        _hapax_count(F.col("_cws")) / nC,
        asl,
        F.length(F.array_join(words, "")).cast("long") / nW,
        tx.char_count(raw, r"[.,!?;:\"'()\[\]{}]") / nch,
        tx.char_count(raw, r"\p{Nd}") / nch,
        tx.char_count(raw, "[A-Z]") / nch,
        F.size(F.filter(lower_words, lambda w: w.isin(list(lex.stopwords)))) / nW,
        _clamp(206.835 - 1.015 * asl - 84.6 * (syl / nW), 0.0, 100.0),
        _clamp(0.39 * asl + 11.8 * (syl / nW) - 15.59, 0.0, 20.0),
        _clamp(0.4 * (asl + 100.0 * (complex_words / nW)), 0.0, 20.0),
        _clamp(0.0588 * L - 0.296 * S - 15.8, 0.0, 20.0),
        _clamp(1.0430 * F.sqrt(complex_words * (30.0 / nS)) + 3.1291, 0.0, 20.0),
        (pos - neg) / (pos + neg + 1e-5),
        (pos + neg) / nC,
        tx.word_count_in(cw, lex.emotional) / nC,
        F.when((F.instr(raw, "!!!") > 0) | (F.instr(raw, "???") > 0) | (F.instr(raw, "!?") > 0),
               1.0).otherwise(0.0),
        tx.word_count_in(cw, lex.clickbait) / nC,
        F.size(F.filter(words, lambda w: (F.upper(w) == w) & (F.lower(w) != w)
                        & (F.length(w) > 2))) / nW,
        tx.distinct_substring_hits(lower_raw, lex.sensational) / nS,
        tx.distinct_substring_hits(lower_raw, lex.urgency) / nC,
        tx.word_count_in(cw, lex.hedging) / nC,
        tx.word_count_in(cw, lex.certainty) / nC,
        title_len.cast("double"),
        F.size(tx.py_split(title)).cast("double"),
        F.length(raw).cast("double"),
        F.greatest(tx.substring_count(raw, "\n\n") + 1, F.lit(1)).cast("double"),
        (tx.substring_count(raw, '"') + tx.substring_count(raw, "'")).cast("double"),
        (tx.substring_count(raw, "http://") + tx.substring_count(raw, "https://")
         + tx.substring_count(raw, "www.")).cast("double"),
        n_words.cast("double"),
        n_words / 200.0,
    ]
    return [c.cast("double").alias(name) for c, name in zip(cols, FEATURE_COLUMNS)]


def with_dense_features(df: DataFrame, raw: str = "text", clean: str = "clean_text",
                        title: str = "title", lex: Lexicons | None = None,
                        keep: list[str] | None = None, tokens: str | None = None) -> DataFrame:
    """Add the 32 feature columns to ``df``.

    ``keep`` lists the input columns carried through (default: all).  ``tokens``: the cleaned text's
    tokens, where they are at hand, so that it is not split again; ``clean`` is not read then.
    """
    keep = list(df.columns) if keep is None else keep
    staged = df.select(
        *keep,
        F.coalesce(F.col(raw), F.lit("")).alias("_raw"),
        *([F.col(tokens).alias("_cw")] if tokens else [F.coalesce(F.col(clean), F.lit("")).alias("_clean")]),
        F.coalesce(F.col(title).cast("string"), F.lit("")).alias("_title"),
    ).select("*", tx.py_split(F.col("_raw")).alias("_w"),
             *([] if tokens else [tx.py_split(F.col("_clean")).alias("_cw")]))
    staged = staged.select("*", F.transform("_w", F.lower).alias("_lw"), F.sort_array(F.col("_cw")).alias("_cws"))
    feats = dense_feature_columns(F.col("_raw"), F.col("_title"), lex)
    return staged.select(*keep, *feats)
