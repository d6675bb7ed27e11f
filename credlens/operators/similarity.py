"""Altered-sentence detection against a reference article (JON-05/06, RUL-05).

Both steps work on sentence tables (TXT-16), normalised as TXT-18:

* pairing joins the distinct sentence keys of documents and references and
  keeps, per document, the reference that shares the most (ties: smaller id);
* checking joins each paired document's sentences to its reference's sentences.
  Containment either way is a column expression; only sentence pairs that are
  left, and whose lengths allow the required likeness, are measured, each
  distinct pair once, in an Arrow-batched function.

A document sentence of fewer than 3 words, or without a letter or digit, is not
checked but counts in the denominator.  A checked sentence without a match is
altered.  A pair where either side has no sentence is a full match.
"""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from credlens.functions import text as tx
from credlens.session import cut_lineage

# FIXED VALUES: likeness that makes a match, words a checked sentence needs
MATCH_RATIO = 0.55
MIN_WORDS = 3


@F.pandas_udf(T.BooleanType())
def _alike(a: pd.Series, b: pd.Series) -> pd.Series:
    """Does the matching-blocks likeness of each pair reach ``MATCH_RATIO``?"""
    def one(x: str, y: str) -> bool:
        m = SequenceMatcher(None, x, y)
        return m.quick_ratio() >= MATCH_RATIO and m.ratio() >= MATCH_RATIO
    return pd.Series([one(x, y) for x, y in zip(a, b, strict=True)], dtype=bool)


def sentence_table(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, pos, norm, checked): every sentence, its normal form, and whether it is long enough."""
    s = df.select(id_col, F.posexplode(tx.sentences(F.col(text_col))).alias("pos", "s"))
    norm = tx.sentence_normalise(F.col("s"))
    return s.select(id_col, "pos", norm.alias("norm"),
                    ((F.size(tx.py_split(F.col("s"))) >= MIN_WORDS) & (norm != "")).alias("checked"))


def sentence_keys(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, key) of the normalised sentences of at least 3 words, repeated ones too."""
    s = df.select(id_col, F.explode(tx.sentences(F.col(text_col))).alias("s"))
    s = s.filter(F.size(tx.py_split(F.col("s"))) >= MIN_WORDS)
    return s.select(id_col, F.sha2(tx.sentence_normalise(F.col("s")), 256).alias("key"))


def shared_sentences(docs: DataFrame, refs: DataFrame, doc_id: str = "doc_id", ref_id: str = "item_id",
                     text: str = "text") -> DataFrame:
    """(doc_id, item_id, n_shared) of every document and reference that share a sentence."""
    # references' sentences are stored, a table of known size: the documents' meet them where they are
    # (by broadcast, unless there are too many), and only sentences that are shared move
    rk = cut_lineage(sentence_keys(refs, ref_id, text).distinct())
    met = sentence_keys(docs, doc_id, text).join(rk, "key").select(doc_id, ref_id, "key").distinct()
    return met.groupBy(doc_id, ref_id).agg(F.count(F.lit(1)).alias("n_shared"))


def pair_with_reference(docs: DataFrame, refs: DataFrame, doc_id: str = "doc_id", ref_id: str = "item_id",
                        text: str = "text") -> DataFrame:
    """JON-06: (doc_id, item_id, n_shared) for every document -- the reference sharing most
    sentences; a document that shares none has a null reference and 0."""
    shared = shared_sentences(docs, refs, doc_id, ref_id, text)
    w = Window.partitionBy(doc_id).orderBy(F.col("n_shared").desc(), F.col(ref_id).asc())
    best = shared.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") == 1).drop("_r")
    return docs.select(doc_id).join(best, doc_id, "left").select(
        doc_id, ref_id, F.coalesce("n_shared", F.lit(0)).alias("n_shared"))


def check_pairs(pairs: DataFrame, docs: DataFrame, refs: DataFrame, doc_id: str = "doc_id", ref_id: str = "item_id",
                text: str = "text") -> DataFrame:
    """JON-05: (doc_id, item_id, match_pct, n_altered) for given (doc_id, item_id) pairs."""
    pairs = pairs.select(doc_id, ref_id)
    own = sentence_table(docs.join(pairs, doc_id), doc_id, text).join(pairs, doc_id)
    theirs = sentence_table(refs, ref_id, text).filter(F.col("norm") != "").select(ref_id, F.col("norm").alias("ref")).distinct()
    wanted = own.filter("checked").select(ref_id, "norm").distinct()
    cand = wanted.join(theirs, ref_id).withColumn("inside", F.contains("ref", "norm") | F.contains("norm", "ref"))
    inside = cand.filter("inside").select(ref_id, "norm").distinct()
    a, b = F.length("norm"), F.length("ref")
    near = (cand.join(inside, [ref_id, "norm"], "left_anti")
            .filter(2.0 * F.least(a, b) / (a + b) >= MATCH_RATIO))
    alike = near.select("norm", "ref").distinct().filter(_alike("norm", "ref"))
    matched = inside.unionByName(near.join(alike, ["norm", "ref"]).select(ref_id, "norm").distinct())
    judged = own.join(matched.withColumn("hit", F.lit(1)), [ref_id, "norm"], "left")
    checked = F.col("checked").cast("int")
    hit = checked * F.coalesce("hit", F.lit(0))
    per = judged.groupBy(doc_id, ref_id).agg(F.count(F.lit(1)).alias("n"), F.sum(hit).alias("m"), F.sum(checked - hit).alias("altered"))
    filled = sentence_table(refs, ref_id, text).select(ref_id).distinct().withColumn("has", F.lit(True))
    full = F.col("n").isNull() | F.col("has").isNull()
    return (pairs.join(per, [doc_id, ref_id], "left").join(filled, ref_id, "left")
            .select(doc_id, ref_id, F.when(full, 100.0).otherwise(F.col("m") / F.col("n") * 100.0).alias("match_pct"),
                    F.when(full, 0).otherwise(F.col("altered")).cast("int").alias("n_altered")))


def integrity_matches(docs: DataFrame, refs: DataFrame, doc_id: str = "doc_id", ref_id: str = "item_id",
                      text: str = "text") -> DataFrame:
    """JON-05/06: match percentage and altered-sentence count of every document (null without a reference)."""
    pairs = pair_with_reference(docs, refs, doc_id, ref_id, text)
    found = check_pairs(pairs.filter(F.col(ref_id).isNotNull()), docs, refs, doc_id, ref_id, text)
    return pairs.join(found.drop(ref_id), doc_id, "left").select(doc_id, ref_id, "n_shared", "match_pct", "n_altered")
