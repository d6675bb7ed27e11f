"""Spelling variants of the corpus' words, found by a bit-sliced position index.

Vocabulary.  Runs of letters, lower-cased, are counted over all texts; the counts are summed up
before they are shuffled, so a word that holds a third of all tokens costs a row per task.

Blocks.  Two words within one edit agree in the first half or in the second half of the shorter
one.  So, for each length L, words of L and L + 1 letters meet under two keys: their first
``L // 2`` letters and their last ``L - L // 2``.  A word enters four such groups.  A group of more than
``BLOCK`` words is cut into index blocks, and its query words go to each of them.

Index.  In a block, bit j of ``index[p][c]`` says that word j has letter c at position p.  One pass over
the letters of a query keeps three sets of words at once: equal so far (``same``), one letter
replaced (``changed``), and one letter more, matched at positions shifted by one (``longer``).  Each
letter costs a few word-parallel operations for all words of the block.

A pair that meets under both keys is kept under the first.  Every pair with exactly one inserted,
deleted or replaced code point is found; nothing else is.

Cases.  Null and empty texts and texts without letters have no words.  Runs of any length are one
word.  Repeated rows count again, as do rows of one id.  Rows without an id keep their runs as they
are in ``corrupted_runs``.  Near words of equal count (ties): the first in code-point order is the
form.  An empty table has no words.  Only the id and the text are read, so extra columns, whatever
their names, do not matter.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from credlens.llm.common import prepare, sorted_groups, stored, work_dir

# FIXED VALUES: letters of a run, and the lower-cased ones
RUN = "[A-Za-z\u00C0-\u00FF]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Words of one index block, that is bits of one set.
BLOCK = 16_384
#: A word's form must occur at least so many times as often.
RATIO = 5


def runs(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, run): one row per lower-cased run of letters."""
    found = docs.select(F.col(id_col).alias("id"), F.explode(F.regexp_extract_all(F.col(text), F.lit(f"({RUN})"), F.lit(1))).alias("run"))
    return found.select("id", F.translate("run", UPPER, LOWER).alias("run"))


def corrupted_runs(found: DataFrame, every: int = 199) -> DataFrame:
    """``runs`` of which about one in ``every`` lost a letter, by the CRC-32 of ``<id>:<run>``: a planted misspelling."""
    h = F.crc32(F.concat(F.col("id").cast("string"), F.lit(":"), F.col("run")))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.length("run")))
    return (found.withColumn("h", h).select("id", F.when(F.col("h") % every == 0, cut).otherwise(F.col("run")).alias("run")))


def vocabulary(found: DataFrame, min_length: int = 6, min_count: int = 5) -> DataFrame:
    """(word, n) of the runs of at least ``min_length`` code points that occur ``min_count`` times or more."""
    return (found.where(F.length("run") >= min_length).groupBy(F.col("run").alias("word"))
            .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count))


class PositionIndex:
    """Bitsets over ``words`` by position and letter, and by length."""

    def __init__(self, words: list[str]):
        sliced: dict[tuple[int, str], list[int]] = {}
        lengths: dict[int, list[int]] = {}
        for j, word in enumerate(words):
            lengths.setdefault(len(word), []).append(j)
            for p, c in enumerate(word):
                sliced.setdefault((p, c), []).append(j)
        size = len(words) // 8 + 1
        self.at = {k: self._bits(js, size) for k, js in sliced.items()}
        self.of_length = {k: self._bits(js, size) for k, js in lengths.items()}
        self.every = (1 << len(words)) - 1

    @staticmethod
    def _bits(places: list[int], size: int) -> int:
        if len(places) < 8:
            out = 0
            for j in places:
                out |= 1 << j
            return out
        raw = bytearray(size)
        for j in places:
            raw[j >> 3] |= 1 << (j & 7)
        return int.from_bytes(raw, "little")

    def near(self, word: str) -> tuple[int, int]:
        """Bitsets of the words with one letter replaced, and of those with one letter more."""
        get, last = self.at.get, len(word)
        same, changed, longer = self.every, 0, 0
        for p, c in enumerate(word):
            here = get((p, c), 0)
            longer = (longer | same) & get((p + 1, c), 0)
            changed = changed & here | same & ~here
            same &= here
            if not (same or changed or longer):
                return 0, 0
        return changed & self.of_length.get(last, 0), (longer | same) & self.of_length.get(last + 1, 0)


def places(bits: int):
    """Places of the set bits, ascending."""
    while bits:
        low = bits & -bits
        yield low.bit_length() - 1
        bits ^= low


def _blocks(words: DataFrame, block: int) -> DataFrame:
    """(key, block, word, n, indexed): the words of each block, as index entries, queries or both."""
    spark, size = words.sparkSession, F.length("word")
    length = F.col("base")
    half = F.floor(length / 2).cast("int")
    based = words.select("word", "n", F.explode(F.array(size, size - 1)).alias("base"))
    side = lambda name, part: F.concat(F.lit(name), length.cast("string"), F.lit(":"), part)
    keyed = based.select("word", "n", F.explode(F.array(
        side("p", F.col("word").substr(F.lit(1), half)),
        side("s", F.col("word").substr(size - (length - half) + 1, length - half)))).alias("key"),
        (size == length).alias("query"))
    # At most 4 / block of the vocabulary's rows are such keys.
    large = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > block)
    large = large.select("key", F.ceil(F.col("rows") / block).cast("int").alias("cuts"))
    cut = keyed.join(large, "key", "left").withColumn("cuts", F.coalesce("cuts", F.lit(1)))
    own = F.pmod(F.xxhash64("word"), F.col("cuts")).cast("int")
    spread = F.when(F.col("query"), F.sequence(F.lit(0), F.col("cuts") - 1)).otherwise(F.array(own))
    return (cut.withColumn("own", own).withColumn("block", F.explode(spread))
            .select("key", "block", "word", "n", "query", (F.col("own") == F.col("block")).alias("indexed")))


_NEAR = "word string, near string, near_n bigint"


def near_pairs(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """(word, near, near_n), in both directions, for all words of (word, n) that differ by one edit."""
    prepare(words.sparkSession)
    arrow = pa.schema([("word", pa.string()), ("near", pa.string()), ("near_n", pa.int64())])

    def batch_of(out):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), arrow.types)], schema=arrow)

    def run(batches):
        out = []
        for (key, _), rows in sorted_groups(batches, ["key", "block"], ["word", "n", "query", "indexed"]):
            listed = [(w, n) for w, n, _, indexed in rows if indexed]
            if len(rows) < 2 or not listed:
                continue
            index = PositionIndex([w for w, _ in listed])
            head = None if key[0] == "p" else int(key[1:key.index(":")]) // 2
            for word, n, query, _ in rows:
                if not query:
                    continue
                changed, longer = index.near(word)
                start = word[:head or 0]
                for j in places(changed):
                    other, m = listed[j]
                    if head is None or not other.startswith(start):
                        out.append((word, other, m))
                for j in places(longer):
                    other, m = listed[j]
                    if head is None or not other.startswith(start):
                        out.append((word, other, m))
                        out.append((other, word, n))
                if len(out) > 20_000:
                    yield batch_of(out)
                    out = []
        if out:
            yield batch_of(out)

    dealt = _blocks(words, block).repartition("key", "block").sortWithinPartitions("key", "block")
    return dealt.mapInArrow(run, _NEAR)


def forms(words: DataFrame, near: DataFrame) -> DataFrame:
    """(word, n, n_near, form, form_n): a word's near word of largest count, if ``RATIO`` times as frequent."""
    best = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                    F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("near"))).alias("best"))
    joined = words.join(best, "word", "left")
    enough = -F.col("best.minus") >= RATIO * F.col("n")
    return joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                         F.when(enough, F.col("best.near")).alias("form"), F.when(enough, -F.col("best.minus")).alias("form_n"))


def roots(formed: DataFrame, path: str) -> DataFrame:
    """(word, root) of the words that have a form, by pointer doubling.

    Counts grow by ``RATIO`` at each step, so chains are short and never closed."""
    now, k = stored(formed.where("form is not null").select("word", F.col("form").alias("root")), f"{path}/0"), 0
    while True:
        to = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = now.join(to, "root", "left").select("word", F.coalesce("further", "root").alias("root"),
                                                   F.col("further").isNotNull().alias("moved"))
        k += 1
        step = stored(step, f"{path}/{k}")
        if step.where("moved").isEmpty():
            return step.select("word", "root")
        now = step.select("word", "root")


def variants(found: DataFrame, path: str | None = None, min_length: int = 6, min_count: int = 5) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for the vocabulary of the runs ``found``."""
    path = path or work_dir(found.sparkSession, "spelling")
    words = stored(vocabulary(found, min_length, min_count), f"{path}/words")
    formed = stored(forms(words, near_pairs(words)), f"{path}/forms")
    ends = roots(formed, f"{path}/roots")
    return (formed.join(ends, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def spelling_variants(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Variants in whole texts of which some runs lost a letter."""
    prepare(spark)
    return variants(corrupted_runs(runs(docs).where(F.length("run") >= 6)))
