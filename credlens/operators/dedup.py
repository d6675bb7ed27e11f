"""De-duplication and set operators (SET-01, SET-02, SET-05, JON-09).

"Keep first" is defined as: among rows with the same key, keep the one with
the smallest ordering column (``doc_id``).  It is computed as one hash
aggregate with ``min_by(struct(row), order)``; partial aggregation happens on
the map side, so a key that holds a third of all rows collapses to one row
per map task before the shuffle instead of landing whole in one reducer (which
is what a ``row_number()`` window over the key would do).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from credlens.functions import text as tx
from credlens.session import cut_lineage


def keep_first(df: DataFrame, key: Column | str, order: str = "doc_id") -> DataFrame:
    """Keep, per key value, the row with the smallest ``order``."""
    key_col = F.col(key) if isinstance(key, str) else key
    cols = df.columns
    # grouping by (64-bit hash, key) is exact and lets the sort-based aggregate
    # (min_by over a struct) compare the hash first instead of whole texts; a key
    # that is itself a column is not repeated inside the struct (the text would
    # otherwise cross the shuffle twice) but restored from the grouping key
    carried = [c for c in cols if not (isinstance(key, str) and c == key)]
    agg = (df.withColumn("__kf_key", key_col).withColumn("__kf_hash", F.xxhash64("__kf_key"))
           .groupBy("__kf_hash", "__kf_key")
           .agg(F.min_by(F.struct(*[F.col(c) for c in carried]), F.col(order)).alias("__kf_row")))
    return agg.select(*[(F.col("__kf_key") if c not in carried else F.col("__kf_row")[c]).alias(c)
                        for c in cols])


def dedup_text(df: DataFrame, text: str = "text", order: str = "doc_id") -> DataFrame:
    """SET-01: exact duplicates of ``text`` removed, first occurrence kept (nulls dropped).

    The first row of each text is found on (hash, order) pairs alone, by a hash aggregate that
    sums up before it shuffles; the rows themselves then move once, by that pair."""
    return _first_of(df.filter(F.col(text).isNotNull()), F.col(text), order)


def _first_of(df: DataFrame, value: Column, order: str) -> DataFrame:
    rows = df.withColumn("__kf_hash", F.unhex(F.sha2(value, 256)))
    first = rows.groupBy("__kf_hash").agg(F.min(order).alias(order))
    return rows.join(first, ["__kf_hash", order], "left_semi").dropDuplicates(["__kf_hash", order]).select(*df.columns)


def dedup_known_text(df: DataFrame, facts: DataFrame, text: str = "text", order: str = "doc_id") -> DataFrame:
    """SET-01 over the rows of ``df`` that ``facts`` knows by ``order``, with the columns of ``facts``.

    Texts are hashed where they lie: only (order, hash) pairs meet the facts and decide which row is a
    text's first.  Those pairs are stored, a table of known size, and each text moves once, to meet its pair."""
    rows = df.filter(F.col(text).isNotNull()).withColumn("__kf_hash", F.unhex(F.sha2(F.col(text), 256)))
    others = [c for c in facts.columns if c != order]
    first = rows.select(order, "__kf_hash").join(facts, order).groupBy("__kf_hash").agg(
        F.min(order).alias(order), *[F.min_by(c, order).alias(c) for c in others])
    # dealt by the pair where the join was a broadcast; a shuffled join has dealt the rows so, and Spark drops this one
    found = rows.join(cut_lineage(first), [order, "__kf_hash"]).repartition(order, "__kf_hash")
    return found.dropDuplicates([order, "__kf_hash"]).select(*df.columns, *others)


def dedup_title_text(df: DataFrame, title: str = "title", text: str = "text",
                     order: str = "doc_id") -> DataFrame:
    """SET-02: de-dup on ``title + " " + text`` (before normalisation), then PRJ-05.  As for SET-01, the
    first row is found on hashes, and only first rows are normalised."""
    combined = F.concat(F.coalesce(F.col(title), F.lit("")), F.lit(" "),
                        F.coalesce(F.col(text), F.lit("")))
    return _first_of(df, combined, order).withColumn("combined_text", tx.light_normalise(combined))


def replay_failures(corpus: DataFrame, failures: DataFrame) -> DataFrame:
    """SET-05: append failure records to the corpus, idempotently.

    Failures become ``(title, text, subject, label)`` rows (subject by true
    label, PRJ-11); rows whose text hash is already in the corpus are skipped
    via a left-anti join on the hash, so replaying twice adds nothing.
    """
    rows = failures.select(
        F.col("title"), F.col("text"),
        F.when(F.col("true_label") == 1, F.lit("worldnews")).otherwise(F.lit("politics")).alias("subject"),
        F.col("true_label").cast("int").alias("label"),
    ).withColumn("_h", tx.content_hash(F.col("text")))
    # of records with one text, the smallest by title and label stays
    rows = keep_first(rows.withColumn("_o", F.struct("title", "label")), "_h", "_o").drop("_o")
    known = corpus.select(tx.content_hash(F.col("text")).alias("_h"))
    new = rows.join(known, "_h", "left_anti").drop("_h")
    return corpus.unionByName(new, allowMissingColumns=True)


def cache_split(requests: DataFrame, stored: DataFrame, text: str = "text", order: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """JON-09: split requests into cache hits (joined to stored results) and misses.

    ``stored`` holds one row per ``hash``.  Misses are de-duplicated by hash
    so each distinct text is scored once.
    """
    req = requests.withColumn("hash", tx.content_hash(F.col(text)))
    hits = req.join(stored, "hash", "inner")
    misses = keep_first(req.join(stored.select("hash"), "hash", "left_anti"), "hash", order)
    return hits, misses
