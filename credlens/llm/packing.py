"""Packing by lexical retrieval: windows filled with BM25 neighbours.

Every document is encoded and ends with an end id.  Full windows of a long document are
sequences of their own; what is left of it is a *rest*.  Rests are dealt into shards, each shard has
a BM25 inverted index of all ids of its rests, and is packed alone: the longest unused rest seeds a
window, its BM25 scores over all its ids give its nearest unused neighbours, and they fill the
window greedily in the order of their scores, the last one cut where the window is full.

Shards are cut from one order of all rests that keeps like ones together: a bounded sample of
``ANCHORS`` rests is scored by BM25 against every rest, and rests are ordered by their three best anchors,
best first, then by their text's hash.  So texts that share words mostly share a shard, copies stand side by
side, and a crowded cell is cut by the next anchors and hashes, never kept whole.  Work and traffic grow
in proportion to the rests.  A seed's neighbours are the best of its shard, not of the corpus: README has
the measured recall.

Document frequencies cover all documents; there is one count per vocabulary id, so they are small
however large the corpus is.  Sequences hold at most ``window`` ids.  The last rest of a shard is cut into
powers of two, which need no padding.  Null and empty texts are a single end id; long texts are
windows and one rest.  Repeated rows and ids are packed one by one; ties go by the order above.  An
empty table gives no piece.  Only id and text are read, so extra columns do not matter.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from credlens.llm.bpe import encoder
from credlens.llm.common import arrow_schema, chunks, give_back, prepare, schema_of, stored, tokenizer, work_dir

WINDOW = 1024
#: Rests in one shard.
SHARD_ROWS = 1024
#: Rests of the sample that orders the others, and ids that such a rest should have.
ANCHORS, ANCHOR_IDS = 64, 256
#: An id that more than one in so many rests of a shard hold has a row of scores, others have postings.
DENSE = 16
#: BM25's usual constants.
K1, B = 1.2, 0.75

PIECE = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
         "offset bigint")


def encode(df: DataFrame, path: str, end_id: int, window: int, id_col: str = "doc_id", text_col: str = "text",
           with_ids: bool = False) -> DataFrame:
    """One pass over the texts.  A row per document: ``doc_tokens``, checksums of its full windows
    (``crcs``; their ids on request) and its ``rest`` of less than a window.  A row per task: in
    how many of its documents each id occurs (``counts``, with the number and total length of the
    documents in the last two places)."""
    prepare(df.sparkSession)
    fields = T.StructType([df.schema[id_col], *schema_of(
        "doc_tokens bigint, crcs array<bigint>, windows array<binary>, rest binary, counts binary").fields])
    names = fields.names

    def run(batches):
        enc = encoder(path)
        end = np.array([end_id], enc.dtype).tobytes()
        vocabulary = max(enc.library.get_vocab_size(), end_id + 1)
        held, docs, total, id_type = np.zeros(vocabulary + 2, np.int64), 0, 0, None
        for batch in batches:
            id_type = batch.column(0).type
            texts = batch.column(1).to_pylist()
            for a, b in chunks(texts):
                rows = []
                for raw in enc.encode(texts[a:b]):
                    ids = np.frombuffer(raw + end, enc.dtype)
                    full = len(ids) // window * window
                    wide = ids[:full].astype("<u4").tobytes()
                    parts = [wide[i:i + 4 * window] for i in range(0, 4 * full, 4 * window)]
                    rest = ids[full:]
                    held[np.unique(ids)] += 1
                    docs, total = docs + 1, total + len(ids)
                    rows.append((len(ids), [zlib.crc32(p) for p in parts], parts if with_ids else None, rest.tobytes(), None))
                cols = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))], names=names)
        if docs:
            held[-2:] = docs, total
            yield pa.RecordBatch.from_arrays([pa.nulls(1, id_type), *(pa.nulls(1, t) for t in types[:-1]),
                                              pa.array([zlib.compress(held.tobytes(), 1)], pa.binary())], names=names)
        give_back()

    types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.binary()), pa.binary(), pa.binary()]
    return df.select(id_col, text_col).mapInArrow(run, fields)


def add_counts(counts: DataFrame) -> np.ndarray:
    """Sum of the tasks' count vectors: added up in sixteen tasks, then here."""
    def add(batches):
        total = None
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                v = np.frombuffer(zlib.decompress(raw), np.int64)
                total = v if total is None else total + v
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())], names=["counts"])

    parts = counts.repartition(16).mapInArrow(add, schema_of("counts binary")).collect()
    return sum((np.frombuffer(zlib.decompress(r["counts"]), np.int64) for r in parts), np.zeros(1, np.int64))


def _powers(n: int) -> list[int]:
    """``n`` as falling powers of two."""
    return [1 << k for k in range(n.bit_length() - 1, -1, -1) if n >> k & 1]


def _bm25(rests: list[np.ndarray], idf: np.ndarray, average: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, ids, weights): the BM25 weight of each distinct id of each rest."""
    uniq = [np.unique(r, return_counts=True) for r in rests]
    rows = np.repeat(np.arange(len(rests)), [len(u) for u, _ in uniq])
    ids = np.concatenate([u for u, _ in uniq]).astype(np.int64)
    tf = np.concatenate([c for _, c in uniq]).astype(np.float32)
    size = np.array([len(r) for r in rests], np.float32)[rows]
    return rows, ids, idf[ids] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * size / average))


class Index:
    """BM25 inverted index of one shard's rests: a row of weights for each common id, postings of the others."""

    def __init__(self, rests: list[np.ndarray], idf: np.ndarray, average: float):
        self.n = len(rests)
        rows, ids, weight = _bm25(rests, idf, average)
        weight = weight.astype(np.float32)
        keys, at, count = np.unique(ids, return_inverse=True, return_counts=True)
        common = count * DENSE > self.n
        place = np.where(common, np.cumsum(common) - 1, np.cumsum(~common) - 1)
        wide = common[at]
        self.dense = np.zeros((int(common.sum()), self.n), np.float32)
        self.dense[place[at[wide]], rows[wide]] = weight[wide]
        order = np.argsort(at[~wide], kind="stable")
        self.rows, self.weights = rows[~wide][order], weight[~wide][order]
        self.ends = np.cumsum(count[~common])
        self.starts = self.ends - count[~common]
        cuts = np.cumsum(np.bincount(rows, minlength=self.n))[:-1]
        self.common, self.rare = ([place[a[w == kind]] for a, w in zip(np.split(at, cuts), np.split(wide, cuts), strict=True)]
                                  for kind in (True, False))

    def scores(self, seed: int) -> np.ndarray:
        """BM25 scores of all rests of the shard against all ids of a seed."""
        out = self.dense[self.common[seed]].sum(axis=0)
        rare = self.rare[seed]
        if len(rare):
            size = self.ends[rare] - self.starts[rare]
            take = np.repeat(self.ends[rare] - np.cumsum(size), size) + np.arange(size.sum())
            out += np.bincount(self.rows[take], self.weights[take], self.n)
        return out


class Anchors:
    """BM25 weights of the sample's rests by id, to order all rests by."""

    def __init__(self, rests: list[np.ndarray], idf: np.ndarray, average: float):
        rows, ids, weights = _bm25(rests, idf, average)
        keys, at = np.unique(ids, return_inverse=True)
        self.row = np.full(len(idf), len(keys), np.int32)  # the last row is of ids that no anchor holds
        self.row[keys] = np.arange(len(keys))
        self.weights = np.zeros((len(keys) + 1, len(rests)), np.float32)
        self.weights[at, rows] = weights

    def cell(self, rest: np.ndarray) -> int:
        """The three best anchors as one number; ties go to the first."""
        score = self.weights[self.row[np.unique(rest)]].sum(axis=0)
        out = 0
        for a in np.argsort(-score, kind="stable")[:3].tolist():
            out = out * ANCHORS + a
        return out


def ordered(rests: DataFrame, idf: np.ndarray, average: float, dtype: str, path: str) -> DataFrame:
    """``rests`` (with ``node``, ``rest``) with ``cell``, by which like rests lie together; stored under ``path``.

    Only the ids of the sample are ordered; its rests, ``ANCHORS`` at most, reach the driver."""
    long = (F.octet_length("rest") < ANCHOR_IDS * np.dtype(dtype).itemsize).cast("int")
    picked = rests.groupBy("node").agg(F.min(long).alias("short")).orderBy("short", "node").limit(ANCHORS).select("node")
    sample = {r["node"]: r["rest"] for r in rests.join(F.broadcast(picked), "node").groupBy("node").agg(F.first("rest").alias("rest")).collect()}
    if not sample:
        return rests.withColumn("cell", F.lit(0).cast("long"))
    anchors = Anchors([np.frombuffer(sample[k], dtype) for k in sorted(sample)], idf, average)
    shared = rests.sparkSession.sparkContext.broadcast(anchors)
    at = rests.columns.index("rest")
    fields = T.StructType([*rests.schema.fields, T.StructField("cell", T.LongType())])

    def run(batches):
        for batch in batches:
            cells = [shared.value.cell(np.frombuffer(raw.as_buffer(), dtype)) for raw in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells, pa.int64())], names=fields.names)

    # Stored, because dealing by range looks at the cells before it moves the rows.
    return stored(rests.mapInArrow(run, fields), path)


def _best(score: np.ndarray, first: int = 16):
    """Places of the scores that are not negative, best first, equal ones in order; a few at a time."""
    low = np.inf
    while True:
        rest = np.flatnonzero((score >= 0) & (score < low))
        if not len(rest):
            return
        if len(rest) > first:
            low = -np.partition(-score[rest], first)[first]
            rest = rest[score[rest] >= low]
        else:
            low = 0.0
        yield from rest[np.argsort(-score[rest], kind="stable")].tolist()
        first *= 4


def pack_shard(rests: list[np.ndarray], idf: np.ndarray, average: float, window: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of (rest, start, length) that use every id of every rest once."""
    index = Index(rests, idf, average)
    used = np.zeros(len(rests), np.int64)          # ids of a rest packed already
    left = np.array([len(r) for r in rests], np.int64)
    sequences, order = [], np.argsort(-left, kind="stable").tolist()
    for seed in order:
        if not left[seed]:
            continue
        own, room = [(seed, int(used[seed]), int(left[seed]))], window - int(left[seed])
        left[seed] = 0
        if room:
            for r in _best(np.where(left > 0, index.scores(seed), -1.0)):
                n = min(int(left[r]), room)
                own.append((r, int(used[r]), n))
                used[r] += n
                left[r] -= n
                room -= n
                if not room:
                    break
        if room:  # nothing is left in the shard: powers of two need no padding
            for r, a, n in own:
                for p in _powers(n):
                    sequences.append([(r, a, p)])
                    a += p
        else:
            sequences.append(own)
    return sequences


def pack(df: DataFrame, path: str, end_id: int = 0, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
         shard_rows: int = SHARD_ROWS, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents: one row per piece, ``ids`` (little-endian uint32) on request.

    One pass over the texts, written to shared storage; then only the rests move."""
    spark: SparkSession = df.sparkSession
    prepare(spark)
    dtype = "<u2" if tokenizer(path).get_vocab_size() <= 65536 else "<u4"
    at = work_dir(spark, "packing")
    scan = stored(encode(df, path, end_id, window, id_col, text_col, with_ids), f"{at}/scan")
    counts = add_counts(scan.where("counts is not null").select("counts"))
    encoded = scan.where("counts is null")
    n_docs, total = (int(counts[-2]), int(counts[-1])) if len(counts) > 1 else (0, 0)
    idf = np.log1p((n_docs - counts[:-2] + 0.5) / (counts[:-2] + 0.5)).astype(np.float32)
    average = max(1.0, min(window / 2, total / max(1, n_docs)))
    shared = spark.sparkContext.broadcast(idf.tobytes())  # four bytes for each id of the vocabulary
    rests = encoded.where(F.octet_length("rest") > 0).select(id_col, "doc_tokens", "rest", F.xxhash64("rest").alias("node"))
    n = max(1, -(-n_docs // (shard_rows * 8)))
    order = ["cell", "node", id_col, "doc_tokens"]
    dealt = ordered(rests, idf, average, dtype, f"{at}/rests").repartitionByRange(n, *order).sortWithinPartitions(*order)
    fields = schema_of(PIECE + ", ids binary")
    types = arrow_schema(fields)

    def fill(batches):
        weights = np.frombuffer(shared.value, np.float32)
        # Odd sequence numbers, 2**32 for every task; full windows take the even ones.
        sequence = (TaskContext.get().partitionId() << 33) + 1
        held: list[tuple] = []

        def shard():
            nonlocal sequence
            rows = []
            for own in pack_shard([h[2] for h in held], weights, average, window):
                offset = 0
                for r, a, k in own:
                    doc, tokens, body = held[r]
                    ids = body[a:a + k].astype("<u4").tobytes()
                    rows.append((doc, tokens - len(body) + a, k, zlib.crc32(ids), tokens, sequence, offset, ids if with_ids else None))
                    offset += k
                sequence += 2
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), types, strict=True)],
                                              names=types.names)

        for batch in batches:
            for doc, tokens, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                held.append((doc, tokens, np.frombuffer(raw.as_buffer(), dtype)))
                if len(held) == shard_rows:
                    yield shard()
        if held:
            yield shard()

    filled = dealt.select(id_col, "doc_tokens", "rest").mapInArrow(fill, fields)
    part = F.posexplode(F.arrays_zip("crcs", "windows") if with_ids else F.col("crcs")).alias("no", "part")
    long = encoded.where(F.size("crcs") > 0).select(id_col, "doc_tokens", *(["crcs", "windows"] if with_ids else ["crcs"])).select(
        id_col, "doc_tokens", part)
    long = long.select(
        F.col(id_col).alias("doc_id"), (F.col("no") * window).cast("bigint").alias("start"), F.lit(window).cast("bigint").alias("length"),
        (F.col("part.crcs") if with_ids else F.col("part")).alias("ids_crc32"), "doc_tokens",
        (F.monotonically_increasing_id() * 2).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"),
        (F.col("part.windows") if with_ids else F.lit(None).cast("binary")).alias("ids"))
    out = filled.unionByName(long)
    return out if with_ids else out.drop("ids")
