"""Token-id files with a minimal perfect hash index per shard.

Documents are range-partitioned by id, so shards follow each other in ascending id order.  A
shard holds the raw ids of its documents end to end, and an index that maps a document key to
its place in constant time: a minimal perfect hash (levels of collision-free bits, as in
BBHash) gives the key's slot, the slot's stored fingerprint tells foreign keys apart, and the
slot's entry gives first document and number of documents of that key.

Shard layout, little-endian, 8-byte aligned::

    magic "LTOKIDS1" | u64 x 8: n_docs, n_keys, n_tokens, width, n_levels, seed, n_rest, bytes
    u64[n_docs + 1] starts | i64[n_docs] keys | u8[n_docs] key is null
    u64[n_levels] level bits | u64[...] bits of all levels | u64[n_rest] hashes of the rest
    u32[n_keys] fingerprints | u32[n_keys] first document | u32[n_keys] documents of the key
    ids, ``width`` bytes each

A file is a row of shards, each followed by a newline byte: Spark's own writer stores them
with its commit protocol, to any file system it reaches, so a lost executor leaves no half
files.  Null ids sort first under a key of their own; null texts are empty; repeated ids are
consecutive documents of one key, ordered by a hash of their text, equal ones as they were read.  A key of
very many documents spans shards and files, so no task gathers it; each of these shards indexes its
own documents.  Very long texts make a shard alone.  An empty table gives no shard.  Other columns are not read.
"""

from __future__ import annotations

import math
import struct
import uuid
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from credlens.llm.bpe import encoder
from credlens.llm.common import chunks, prepare, schema_of, stored
from credlens.session import shared_dir

MAGIC = b"LTOKIDS1"
#: Characters of text in one shard, about; bounds a task's memory and a file's size.
SHARD_CHARS = 8_000_000
#: Files at most; beyond that a file holds several shards.
MAX_FILES = 50_000
GAMMA = 2.0
MAX_LEVELS = 32
_M = (1 << 64) - 1


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit mixer (splitmix64 finaliser) over keys, one function per seed."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & _M)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def key_hash(keys: np.ndarray, null: np.ndarray) -> np.ndarray:
    """Distinct 64-bit numbers for distinct keys; the null key takes one that is not used."""
    h = _mix(keys.astype(np.int64).view(np.uint64), 7)
    if null.any():
        spare = int(_mix(np.array([0], np.uint64), 99)[0])
        used = set(h[~null].tolist())
        while spare in used:
            spare = (spare + 1) & _M
        h = np.where(null, np.uint64(spare), h)
    return h


@dataclass
class PerfectHash:
    """Minimal perfect hash of distinct 64-bit hashes onto 0..n-1."""
    levels: list[int]        # bits of each level
    bits: np.ndarray         # all levels' bits, one uint8 each while in memory
    rest: np.ndarray         # hashes that collided on every level, sorted

    @classmethod
    def build(cls, hashes: np.ndarray) -> PerfectHash:
        left, levels, bits = hashes, [], []
        while len(left) and len(levels) < MAX_LEVELS:
            size = max(64, math.ceil(GAMMA * len(left) / 64) * 64)
            at = (_mix(left, 100 + len(levels)) % np.uint64(size)).astype(np.int64)
            once = np.bincount(at, minlength=size) == 1
            levels.append(size)
            bits.append(once)
            left = left[~once[at]]
        return cls(levels, np.concatenate(bits) if bits else np.zeros(0, bool), np.sort(left))

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        """Slot of every hash; for foreign hashes any slot or -1."""
        rank = np.concatenate([[0], np.cumsum(self.bits)])
        out, open_, base = np.full(len(hashes), -1, np.int64), np.arange(len(hashes)), 0
        for k, size in enumerate(self.levels):
            at = base + (_mix(hashes[open_], 100 + k) % np.uint64(size)).astype(np.int64)
            hit = self.bits[at]
            out[open_[hit]] = rank[at[hit]]
            open_, base = open_[~hit], base + size
        if len(self.rest) and len(open_):
            i = np.minimum(np.searchsorted(self.rest, hashes[open_]), len(self.rest) - 1)
            found = self.rest[i] == hashes[open_]
            out[open_[found]] = rank[-1] + i[found]
        return out


def fingerprint(hashes: np.ndarray) -> np.ndarray:
    return (_mix(hashes, 5000) >> np.uint64(32)).astype(np.uint32)


def _pad(b: bytes) -> bytes:
    return b + b"\0" * (-len(b) % 8)


def write_shard(keys: list, ids: list[bytes], width: int) -> bytes:
    """Bytes of one shard; ``keys`` ascending (None first), ``ids`` raw little-endian."""
    null = np.array([k is None for k in keys], bool)
    numbers = np.array([0 if k is None else k for k in keys], np.int64)
    starts = np.concatenate([[0], np.cumsum([len(x) // width for x in ids])]).astype("<u8")
    first = np.ones(len(keys), bool)
    first[1:] = (numbers[1:] != numbers[:-1]) | (null[1:] != null[:-1])
    head = np.flatnonzero(first)
    hashes = key_hash(numbers[head], null[head])
    mph = PerfectHash.build(hashes)
    slot = mph.slots(hashes)
    count = np.diff(np.append(head, len(keys)))
    prints, firsts, counts = (np.zeros(len(head), "<u4") for _ in range(3))
    prints[slot], firsts[slot], counts[slot] = fingerprint(hashes), head, count
    body = b"".join([starts.tobytes(), numbers.astype("<i8").tobytes(), _pad(null.astype(np.uint8).tobytes()),
                     np.array(mph.levels, "<u8").tobytes(), np.packbits(mph.bits, bitorder="little").tobytes(),
                     mph.rest.astype("<u8").tobytes(), _pad(prints.tobytes()), _pad(firsts.tobytes()),
                     _pad(counts.tobytes()), _pad(b"".join(ids))])
    head_ = struct.pack("<8Q", len(keys), len(head), int(starts[-1]), width, len(mph.levels), 0, len(mph.rest), len(body))
    return MAGIC + head_ + body


class Shard:
    """A shard read back; ``find`` is the constant-time keyed access."""

    def __init__(self, raw: memoryview):
        if bytes(raw[:8]) != MAGIC:
            raise ValueError("not a token-id shard")
        self.n_docs, self.n_keys, self.n_tokens, self.width, n_levels, _, n_rest, size = struct.unpack("<8Q", raw[8:72])
        self.size = 72 + size
        at = 72

        def take(dtype, n):
            nonlocal at
            a = np.frombuffer(raw, dtype, n, at)
            at += -(-a.nbytes // 8) * 8
            return a

        self.starts = take("<u8", self.n_docs + 1)
        self.keys, self.null = take("<i8", self.n_docs), take("u1", self.n_docs).astype(bool)
        levels = take("<u8", n_levels).astype(int).tolist()
        bits = np.unpackbits(take("u1", sum(levels) // 8), bitorder="little").astype(bool)
        self.mph = PerfectHash(levels, bits, take("<u8", n_rest))
        self.prints, self.firsts, self.counts = take("<u4", self.n_keys), take("<u4", self.n_keys), take("<u4", self.n_keys)
        self.ids = take(f"<u{self.width}", self.n_tokens)

    def find(self, keys: np.ndarray, null: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first document, number of documents) of every key; number 0 for keys not here."""
        h = key_hash(keys, null)
        slot = self.mph.slots(h) if self.n_keys else np.full(len(h), -1)
        ok = slot >= 0
        ok[ok] = self.prints[slot[ok]] == fingerprint(h[ok])
        first, count = np.zeros(len(h), np.int64), np.zeros(len(h), np.int64)
        first[ok], count[ok] = self.firsts[slot[ok]], self.counts[slot[ok]]
        return first, count

    def document(self, i: int) -> np.ndarray:
        """Ids of document ``i`` as little-endian uint32."""
        return self.ids[int(self.starts[i]):int(self.starts[i + 1])].astype("<u4")


def shards(raw: bytes):
    """The shards of one file, in order."""
    view, at = memoryview(raw), 0
    while at < len(view):
        shard = Shard(view[at:])
        yield shard
        at += shard.size + 1


def write(df: DataFrame, path: str, tokenizer_file: str, end_id: int = 1, id_col: str = "doc_id",
          text_col: str = "text", shard_chars: int = SHARD_CHARS) -> str:
    """Encode every whole text and write the files under ``path``; returns ``path``.

    One shuffle: the texts, by id ranges."""
    prepare(df.sparkSession)
    n = df.agg(F.sum(F.length(text_col))).first()[0] or 0
    parts = min(max(1, math.ceil(n / shard_chars)), MAX_FILES)
    # Rows of one id are dealt by a hash of their text, copies of one row by the task that read them.
    order = [F.col("id").asc_nulls_first(), "hash", "task"]
    rows = (df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .withColumns({"hash": F.xxhash64("text"), "task": F.spark_partition_id()})
            .repartitionByRange(parts, *order).sortWithinPartitions(*order).select("id", "text"))

    def run(batches):
        enc = encoder(tokenizer_file)
        width = np.dtype(enc.dtype).itemsize
        end = np.array([end_id], enc.dtype).tobytes()
        keys, ids, chars = [], [], 0

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array([write_shard(keys, ids, width)], pa.binary())], names=["shard"])
            keys.clear()
            ids.clear()
            return out

        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in chunks(texts):
                own = [x + end for x in enc.encode(texts[a:b])]
                for k, x, t in zip(doc_ids[a:b], own, texts[a:b], strict=True):
                    if chars > shard_chars:
                        yield flush()
                        chars = 0
                    keys.append(k)
                    ids.append(x)
                    chars += len(t or "") + 1
        if keys:
            yield flush()

    # Bytes go through the text writer unchanged: a cast of binary to string does not alter them.
    rows.mapInArrow(run, "shard binary").select(F.col("shard").cast("string").alias("value")).write.text(path)
    return path


def read(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """Every document, from the files: (doc_id, file, shard_no, doc_no, local_start, n_tokens,
    ids_crc32, ids); ``with_ids=False`` leaves the ids out.

    Each key of a shard is looked up through the index, so what comes back is what keyed
    access gives."""
    prepare(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")

    def run(batches):
        for batch in batches:
            for f, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for no, shard in enumerate(shards(raw.as_buffer())):
                    heads = np.flatnonzero(np.append(True, (np.diff(shard.keys) != 0) | (np.diff(shard.null.astype(int)) != 0)))
                    first, count = shard.find(shard.keys[heads], shard.null[heads])
                    docs = np.concatenate([np.arange(a, a + c) for a, c in zip(first, count, strict=True)] or [np.zeros(0, int)])
                    for part in np.array_split(docs, max(1, -(-int(shard.n_tokens) // 4_000_000))):
                        own = [shard.document(i).tobytes() for i in part]
                        columns = [pa.array([None if shard.null[i] else int(shard.keys[i]) for i in part], pa.int64()),
                                   pa.array([f] * len(part), pa.string()), pa.array([no] * len(part), pa.int32()),
                                   pa.array(part, pa.int64()), pa.array(shard.starts[part].astype(np.int64)),
                                   pa.array([len(x) // 4 for x in own], pa.int64()),
                                   pa.array([zlib.crc32(x) for x in own], pa.int64())]
                        yield pa.RecordBatch.from_arrays(columns + ([pa.array(own, pa.binary())] if with_ids else []), names=names)

    fields = schema_of("doc_id bigint, file string, shard_no int, doc_no bigint, local_start bigint, n_tokens bigint, "
                       "ids_crc32 bigint" + (", ids binary" if with_ids else ""))
    names = fields.names
    return files.mapInArrow(run, fields)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row per shard: its size, key range and ``first_token`` (ids in all shards before)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")

    def run(batches):
        for batch in batches:
            for f, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows = []
                for no, s in enumerate(shards(raw.as_buffer())):
                    known = s.keys[~s.null]
                    rows.append((f, no, int(s.n_docs), int(s.n_tokens), int(known[0]) if len(known) else None,
                                 int(known[-1]) if len(known) else None, bool(s.null.any())))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[k] for r in rows], t) for k, t in enumerate(
                        (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()))],
                    names=["file", "shard_no", "n_docs", "n_tokens", "min_key", "max_key", "has_null"])

    rows = files.mapInArrow(run, schema_of("file string, shard_no int, n_docs bigint, n_tokens bigint, min_key bigint, "
                                           "max_key bigint, has_null boolean"))
    shards_of = stored(rows, new_path(spark, "manifest"))
    # Files, MAX_FILES at most, meet in one window; the shards of a file in another.
    ahead = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = shards_of.groupBy("file").agg(F.sum("n_tokens").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(ahead), F.lit(0)))
    within = Window.partitionBy("file").orderBy("shard_no").rowsBetween(Window.unboundedPreceding, -1)
    first = F.col("before") + F.coalesce(F.sum("n_tokens").over(within), F.lit(0))
    return shards_of.join(files.select("file", "before"), "file").withColumn("first_token", first).drop("before")


def lookup(spark: SparkSession, path: str, keys: list[int]) -> DataFrame:
    """Ids of a caller's keys (a list that fits the driver): (doc_id, n_tokens, ids).

    Only files whose key range holds a wanted key are opened."""
    prepare(spark)
    wanted = np.unique(np.array(keys, np.int64))
    inside = None
    for k in wanted.tolist():
        one = F.col("min_key").isNotNull() & F.lit(k).between(F.col("min_key"), F.col("max_key"))
        inside = one if inside is None else inside | one
    paths = [] if inside is None else [r[0] for r in manifest(spark, path).where(inside).select("file").distinct().collect()]
    schema = schema_of("doc_id bigint, n_tokens bigint, ids binary")
    if not paths:
        return spark.createDataFrame([], schema)
    files = spark.read.format("binaryFile").load(paths).select("content")

    def run(batches):
        for batch in batches:
            for raw in batch.column(0):
                for s in shards(raw.as_buffer()):
                    first, count = s.find(wanted, np.zeros(len(wanted), bool))
                    docs = [(int(k), s.document(i)) for k, a, c in zip(wanted, first, count, strict=True)
                            for i in range(a, a + c) if s.keys[i] == k]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([d[0] for d in docs], pa.int64()), pa.array([len(d[1]) for d in docs], pa.int64()),
                         pa.array([d[1].tobytes() for d in docs], pa.binary())], names=["doc_id", "n_tokens", "ids"])

    return files.mapInArrow(run, schema)


def new_path(spark: SparkSession, kind: str) -> str:
    """A fresh folder in the cluster's shared place."""
    return shared_dir(spark, f"llm/{kind}/{uuid.uuid4().hex}")

