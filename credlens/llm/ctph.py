"""Context-triggered piecewise hashing of documents (Kornblum 2006), vectorised.

A rolling hash of the last eight bytes marks chunk borders wherever it ends a multiple of the
block size, so borders depend on content and move with it.  Each chunk contributes one of 64
letters; the fingerprint is ``block size:letters:letters at twice the block size``.  The block
size is the smallest that needs at most 64 letters, halved while fewer than 32 come out.
Fingerprints are compared by edit distance, where their block sizes are equal or differ by a
factor of two.

Null and empty texts share the fingerprint ``3::``.  Equal texts have equal fingerprints.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from credlens.llm.common import arrow_schema, chunks, map_text, prepare, schema_of

LETTERS = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
SMALLEST, LENGTH = 3, 64
#: Signatures of this length or more count as alike only if they share so long a run of letters.
RUN, RUN_FROM = 4, 12
#: Texts handled together in a task, characters.
AT_ONCE = 1_000_000
#: Characters of text in one bucket of consecutive documents, about.
BUCKET_CHARS = 8_000_000
#: Buckets at most; beyond that they grow (a bucket is walked as a stream, whatever its size).
MAX_BUCKETS = 50_000

_GAP = 8
_P = np.uint64(0x9E3779B97F4A7C15)


def _rolling(data: np.ndarray) -> np.ndarray:
    """A hash of the last eight bytes at every byte, by doubling the window three times."""
    with np.errstate(over="ignore"):
        h = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
        factor = _P
        for width in (1, 2, 4):
            g = h.copy()
            g[width:] += h[:-width] * factor
            h, factor = g, factor * factor
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(29))


def _signature(cuts: np.ndarray, sums: np.ndarray, a: int, b: int, length: int) -> bytes:
    """Letters of the chunks of one text; ``sums``: running sums of the rolling hashes."""
    ends = cuts[:length - 1]
    if not len(ends) or ends[-1] != b:
        ends = np.append(ends, b)
    values = np.diff(sums[np.append(a, ends)])
    values = (values ^ (values >> np.uint64(31))) * _P
    return LETTERS[(values >> np.uint64(58)).astype(np.int64)].tobytes()


def fingerprints(texts: list[str | None]) -> list[str]:
    out: list[str] = []
    for s, e in chunks(texts, AT_ONCE):
        raws = [(t or "").encode("utf-8", "surrogatepass") for t in texts[s:e]]
        data = np.frombuffer((b"\0" * _GAP).join([b"", *raws]), np.uint8)
        h = _rolling(data) if len(data) else np.zeros(0, np.uint64)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(h, out=sums[1:])
        # A border of block size 3 * 2**k: hash + 1 is a multiple of it.  Every border of a larger
        # block size is one of the smaller sizes too, so one number per border tells its sizes.
        g = (h >> np.uint64(8)) + np.uint64(1)
        border = np.flatnonzero(g % np.uint64(3) == 0)
        low = g[border] & (~g[border] + np.uint64(1))
        level = np.log2(low.astype(np.float64)).astype(np.int16)
        border = border + 1
        at = 0
        for raw in raws:
            a = at + _GAP
            b = a + len(raw)
            at = b
            if not raw:
                out.append(f"{SMALLEST}::")
                continue
            i, j = np.searchsorted(border, (a, b), side="right")
            pos, lev = border[i:j], level[i:j]
            k = max(0, math.ceil(math.log2(len(raw) / (SMALLEST * LENGTH))))
            cuts = pos[lev >= k]
            while k and len(cuts) < LENGTH // 2:
                k -= 1
                cuts = pos[lev >= k]
            one = _signature(cuts, sums, a, b, LENGTH)
            two = _signature(pos[lev >= k + 1], sums, a, b, LENGTH // 2)
            out.append(f"{SMALLEST << k}:{one.decode()}:{two.decode()}")
    return out


def edit_distances(pairs: list[tuple[str, str]]) -> np.ndarray:
    """Levenshtein distances of pairs of strings of at most 64 letters (Myers' bit vectors, all
    pairs at once)."""
    n = len(pairs)
    lx, ly = (np.array([len(p[k]) for p in pairs], np.int64) for k in (0, 1))
    code = np.zeros(256, np.int64)
    code[LETTERS] = np.arange(64)
    peq = np.zeros((n, 64), np.uint64)
    one = np.uint64(1)
    x = np.zeros((n, 64), np.int64)
    y = np.zeros((n, 64), np.int64)
    for r, (p, q) in enumerate(pairs):
        x[r, :len(p)] = code[np.frombuffer(p.encode(), np.uint8)]
        y[r, :len(q)] = code[np.frombuffer(q.encode(), np.uint8)]
    rows = np.arange(n)
    for i in range(int(lx.max(initial=0))):
        live = rows[i < lx]
        peq[live, x[live, i]] |= one << np.uint64(i)
    pv, mv = np.full(n, ~np.uint64(0)), np.zeros(n, np.uint64)
    score, last = lx.copy(), np.maximum(lx - 1, 0).astype(np.uint64)
    with np.errstate(over="ignore"):
        for j in range(int(ly.max(initial=0))):
            eq = peq[rows, y[:, j]]
            xv = eq | mv
            xh = (((eq & pv) + pv) ^ pv) | eq
            ph, mh = mv | ~(xh | pv), pv & xh
            live = j < ly
            score += np.where(live, ((ph >> last) & one).astype(np.int64) - ((mh >> last) & one).astype(np.int64), 0)
            ph, mh = (ph << one) | one, mh << one
            pv, mv = mh | ~(xv | ph), ph & xv
    return np.where(lx == 0, ly, np.where(ly == 0, lx, score))


def _share_run(p: str, q: str) -> bool:
    if min(len(p), len(q)) < RUN_FROM:
        return True
    grams = {p[i:i + RUN] for i in range(len(p) - RUN + 1)}
    return any(q[i:i + RUN] in grams for i in range(len(q) - RUN + 1))


def likeness(left: list[str], right: list[str]) -> np.ndarray:
    """0 (nothing in common or block sizes that cannot be compared) to 1 (equal)."""
    out = np.zeros(len(left))
    pairs, at = [], []
    for i, (f, g) in enumerate(zip(left, right, strict=True)):
        if f == g:
            out[i] = 1.0
            continue
        (bf, f1, f2), (bg, g1, g2) = f.split(":"), g.split(":")
        bf, bg = int(bf), int(bg)
        options = [(f1, g1), (f2, g2)] if bf == bg else [(f1, g2)] if bf == 2 * bg else [(f2, g1)] if bg == 2 * bf else []
        for p, q in options:
            if p and q and _share_run(p, q):
                pairs.append((p, q))
                at.append(i)
    if pairs:
        size = np.array([max(len(p), len(q)) for p, q in pairs])
        np.maximum.at(out, at, 1.0 - edit_distances(pairs) / size)
    return out


def fingerprint(df: DataFrame, text_col: str = "text", carry=("doc_id",)) -> DataFrame:
    """``fingerprint`` of every whole text; one pass, no shuffle."""
    return map_text(df, lambda texts: {"fingerprint": fingerprints(texts)}, "fingerprint string", text_col, carry)


def edited(text: str | None, following: str | None) -> str:
    """The last third replaced by as much of the start of the following text."""
    t, k = text or "", len(text or "") // 3
    return t[:len(t) - k] + (following or "")[:k] if k else t


PAIR = ("n_chars bigint, edited_text string, fingerprint string, edited_fingerprint string, near_edited double, "
        "near_next double")


def next_in_order(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_chars: int = BUCKET_CHARS) -> DataFrame:
    """Every row placed for a walk in descending id order (nulls last, equal ids by text).

    Ids are cut into buckets at approximate quantiles, and each bucket also gets the first
    row of the bucket after it (``is_next``; the last bucket gets the very first row), so each
    bucket can be walked alone: no global sort, no task that sees all rows, one shuffle."""
    spark = df.sparkSession
    size, rows = df.agg(F.sum(F.length(text_col)), F.count(F.lit(1))).first()
    n = max(1, min(math.ceil((size or 0) / bucket_chars), rows or 1, MAX_BUCKETS))
    ends = sorted(set(df.approxQuantile(id_col, [i / n for i in range(1, n)], 0.2 / n))) if n > 1 else []
    splits = [-math.inf, *ends, math.inf]
    last = len(splits) - 1  # the place of null ids
    placed = df.select(F.col(id_col), F.col(text_col).alias("text"), F.col(id_col).cast("double").alias("_at"))
    if ends:
        placed = Bucketizer(splits=splits, inputCol="_at", outputCol="_bucket", handleInvalid="keep").transform(placed)
    else:
        placed = placed.withColumn("_bucket", F.lit(0))
    placed = placed.select(id_col, "text", F.when(F.col(id_col).isNull(), last)
                           .otherwise(last - 1 - F.col("_bucket")).cast("int").alias("place"))
    tops = placed.groupBy("place").agg(F.max(id_col).alias("top")).orderBy("place").collect()  # a row per bucket
    places = [r["place"] for r in tops]
    if not places:
        return placed.select(id_col, "text", "place", F.lit(False).alias("is_next"))
    before = dict(zip(places, [places[-1], *places[:-1]], strict=True))
    heads = spark.createDataFrame([(r["place"], r["top"], before[r["place"]]) for r in tops],
                                  f"place int, top {df.schema[id_col].dataType.simpleString()}, to int")
    # A few bytes for each bucket, MAX_BUCKETS at most: broadcast, so texts do not move for it.
    first = (placed.join(F.broadcast(heads), "place").where(F.col(id_col).eqNullSafe(F.col("top")))
             .groupBy("to", "top").agg(F.min(F.struct(F.col("text").isNotNull().alias("has"), "text")).alias("t")))
    extra = first.select(F.col("top").alias(id_col), F.col("t.text").alias("text"), F.col("to").alias("place"), F.lit(True).alias("is_next"))
    both = placed.withColumn("is_next", F.lit(False)).unionByName(extra)
    return both.repartition(max(1, len(places)), "place").sortWithinPartitions(
        "place", "is_next", F.col(id_col).desc_nulls_last(), F.col("text").asc_nulls_first())


def compare_with_next(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = True,
                      bucket_chars: int = BUCKET_CHARS) -> DataFrame:
    """Fingerprints of every text, of its edited text and their likeness to it and to the next
    document; ``keep_text=False`` leaves the edited text out and adds its SHA-256."""
    prepare(df.sparkSession)
    added = schema_of(PAIR if keep_text else PAIR.replace("edited_text", "edited_sha256"))
    types = arrow_schema(added)
    ordered = next_in_order(df, id_col, text_col, bucket_chars)
    names = [id_col, *types.names]

    def walk(batches):
        held = None  # the last row: (ids array of one, text, place) waiting for its next
        for batch in batches:
            for a in range(0, batch.num_rows, 2000):
                part = batch.slice(a, 2000)
                texts, places = part.column("text").to_pylist(), part.column("place").to_pylist()
                spare = part.column("is_next").to_pylist()
                ids = part.column(id_col)
                if held:
                    ids = pa.concat_arrays([held[0], ids])
                    texts, places, spare = [held[1], *texts], [held[2], *places], [False, *spare]
                for i, j in chunks(texts, 2 * AT_ONCE):
                    stop = min(j + 1, len(texts))  # one row more: the next of the last
                    own = [r for r in range(i, min(j, len(texts) - 1)) if not spare[r]]
                    if not own:
                        continue
                    prints = fingerprints(texts[i:stop])
                    changed = [edited(texts[r], texts[r + 1]) for r in own]
                    new = fingerprints(changed)
                    mine, after = [prints[r - i] for r in own], [prints[r - i + 1] for r in own]
                    values = {"n_chars": [len(texts[r] or "") for r in own], "edited_text": changed, "fingerprint": mine,
                              "edited_fingerprint": new, "near_edited": likeness(mine, new), "near_next": likeness(mine, after)}
                    if not keep_text:
                        values["edited_sha256"] = [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed]
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(own, pa.int64()))] +
                                                     [pa.array(values[f.name], f.type) for f in types], names=names)
                held = None if spare[-1] else (ids.slice(len(texts) - 1, 1), texts[-1], places[-1])

    return ordered.mapInArrow(walk, T.StructType([df.schema[id_col], *added.fields]))
