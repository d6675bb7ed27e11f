"""Splits that are exact or keep sources apart (PRJ-06, PRJ-07, MLT-13).

* ``stratified_split``: of each class, the share of test rows is exact to one row.  The cut is the order
  statistic of a salted hash of the id, found by a radix histogram: one small aggregate per level
  narrows it to a bucket of the hash's next bits.  No class is ever sorted or numbered.
* ``source_folds``: every source lies in one fold, and folds are of like size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from credlens.session import cut_lineage

#: Bits of the hash that decide (15 hex digits), and bits looked at per level.
KEY_BITS, LEVEL_BITS = 60, 12
#: Sources of at least 1 / (folds * this) of all rows are balanced one by one.
BALANCED = 200


def hash_key(id_col: str = "doc_id", salt: str = "42:") -> Column:
    """A 60-bit number from a salted SHA-256 of the id; the same in every engine."""
    h = F.sha2(F.concat(F.lit(salt), F.col(id_col).cast("string")), 256)
    return F.conv(F.substring(h, 1, KEY_BITS // 4), 16, 10).cast("long")


def fold_column(k: int, id_col: str = "doc_id", salt: str = "fold:") -> Column:
    """Fold 0 .. k - 1 of a row, by hash."""
    return (hash_key(id_col, salt) % k).cast("int")


def stratified_cuts(df: DataFrame, label: str, key: Column, share: float) -> dict:
    """{class: bound}: rows whose key is below the bound are the smallest ``floor(share * n + 0.5)`` keys of
    their class.  Equal keys (repeated ids) stay on one side, the test side."""
    rows = df.select(F.col(label).alias("c"), key.alias("k"))
    wanted, prefix, cuts, shift = None, {}, {}, KEY_BITS
    while wanted is None or prefix:
        shift -= LEVEL_BITS
        inside = rows
        if wanted is not None:
            hit = F.lit(False)
            for c, p in prefix.items():
                hit = hit | (F.col("c").eqNullSafe(F.lit(c)) & (F.shiftright("k", shift + LEVEL_BITS) == p))
            inside = rows.where(hit)
        # at most 4096 buckets a class
        counts: dict = {}
        for r in inside.groupBy("c", F.shiftright("k", shift).alias("b")).agg(F.count(F.lit(1)).alias("n")).collect():
            counts.setdefault(r["c"], []).append((r["b"], r["n"]))
        if wanted is None:
            wanted = {c: int(share * sum(n for _, n in bs) + 0.5) for c, bs in counts.items()}
            prefix = dict.fromkeys(counts)
        for c in list(prefix):
            left = wanted[c]
            bound = None
            for b, n in sorted(counts[c]):
                if left == 0:
                    bound = b << shift
                elif n <= left or shift == 0:
                    left = max(left - n, 0)
                    continue
                else:
                    prefix[c], wanted[c] = b, left
                break
            else:
                bound = (max(b for b, _ in counts[c]) + 1) << shift
            if bound is not None:
                cuts[c] = bound
                del prefix[c]
    return cuts


def stratified_split(df: DataFrame, label: str = "label", id_col: str = "doc_id", share: float = 0.2) -> DataFrame:
    """PRJ-07: adds ``split``, 'test' for exactly ``share`` of each class (to one row), else 'train'."""
    key = hash_key(id_col)
    test = F.lit(False)
    for c, bound in stratified_cuts(df, label, key, share).items():
        test = test | (F.col(label).eqNullSafe(F.lit(c)) & (key < bound))
    return df.withColumn("split", F.when(test, F.lit("test")).otherwise(F.lit("train")))


def source_folds(df: DataFrame, source: str = "subject", k: int = 5) -> DataFrame:
    """MLT-13: (source, fold), folds of like size that share no source.

    Sources are placed by descending size (ties by name), each into the fold with the fewest rows
    so far (ties: the lowest).  Only large sources, ``BALANCED * k`` at most, are placed so; the others go
    by hash, in shares of what each fold then lacks, and are too small to unbalance one."""
    sizes = df.groupBy(F.coalesce(F.col(source), F.lit("")).alias(source)).agg(F.count(F.lit(1)).alias("n")).persist()
    total = sizes.agg(F.sum("n")).first()[0] or 0
    large = F.col("n") * (k * BALANCED) >= total
    load, placed = [0] * k, []
    for r in sizes.where(large).orderBy(F.col("n").desc(), source).collect():
        f = min(range(k), key=lambda i: (load[i], i))
        load[f] += r["n"]
        placed.append((r[source], f))
    lack = [max(total // k + 1 - n, 0) for n in load]
    place = hash_key(source, "source:") % sum(lack) if total else F.lit(0)
    fold = F.lit(k - 1)
    for i in reversed(range(k - 1)):
        fold = F.when(place < sum(lack[:i + 1]), F.lit(i)).otherwise(fold)
    small = sizes.where(~large).select(source, fold.alias("fold"))
    return df.sparkSession.createDataFrame(placed, f"`{source}` string, fold int").unionByName(small)


def source_split(df: DataFrame, source: str = "subject", k: int = 5, test_fold: int = 0, inner_fold: int = 1) -> DataFrame:
    """MLT-13: adds ``split`` by source: 'test' and 'inner' (for thresholds) for the rows of one fold each, else 'train'."""
    # stored: a small table of known size, so no row of ``df`` is shuffled to meet its source
    folds = cut_lineage(source_folds(df, source, k)).withColumnRenamed(source, "_source")
    tagged = df.join(folds, F.coalesce(F.col(source), F.lit("")) == F.col("_source"))
    return tagged.withColumn("split", F.when(F.col("fold") == test_fold, F.lit("test")).when(F.col("fold") == inner_fold, F.lit("inner"))
                             .otherwise(F.lit("train"))).drop("_source", "fold")
