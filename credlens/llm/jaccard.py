"""N-gram Jaccard join by a blocked sparse matrix product.

Rows of the incidence matrix are documents, columns are word shingles; two documents link when
the product of their rows, the number of common shingles, reaches the share of the union asked
for.  The product is never formed whole:

1. Equal rows collapse: documents with one set of shingles are one *node* (a 64-bit hash).
2. Columns are ordered by how frequent they are in all documents, rare ones first.  The counts sit
   in a table of fixed size; collisions only spoil the order, and any order is exact.
3. A row of size s can only reach the bound with a partner that shares one of its first
   s - ceil(t * s) + 1 columns, so the product runs over those columns first, block by block, and
   adds up the common ones of each pair.  A pair whose count cannot reach the size-derived bound
   with all the columns left is discarded.
4. The rows of the pairs that are left meet, and their whole overlap is counted exactly.

A column that very many nodes share is a hot block.  Its nodes are first compared with one pivot
for each range of sizes, and linked ones become components; then the whole rows of the nodes are
multiplied, block by block, where different components meet.  Nothing is capped: a link inside a
component is implied, every other pair is counted.

Only links between components are looked for after that, which gives the components.  The number of
each document's links is counted then: pair by pair for nodes without a hot column, and by
blocks of like size for the others, inside their component, where all their links lie.

Null and empty texts, and texts without words, have no shingles and link with nothing.  Repeated rows
are one node and link with each other.  Rows with a null id take part; a component that only has null ids
has a null component id.  Ties cannot occur: a component's id is its smallest.  Long texts are rows of
many columns.  An empty table gives an empty result.  Only ``doc_id`` and ``text`` are read, so extra columns
do not matter.
"""

from __future__ import annotations

import math
import uuid
import zlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from credlens.llm.common import arrow_schema, chunks, prepare, schema_of, tidy
from credlens.llm.graph import components
from credlens.session import shared_dir

#: Nodes in a column above which it is a hot block.
HOT = 64
#: Nodes of a hot column in one block of the product.
BLOCK = 512
#: log2 of the number of column counters; of them one byte each is broadcast (4 MB).
COUNTER_BITS = 22
#: log2 of the bits that tell which documents' rows are needed (1 MB).
NEED_BITS = 23
#: Pairs with one row on a side that one task compares; more are salted.
FAN = 250
#: A key of more than one in so many rows is joined by broadcast; there are fewer of them than this number.
HEAVY = 1000

_LONG = 64
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


with np.errstate(over="ignore"):
    #: Tabulation hashing of words: a number for each place and byte value.
    _TABLE = mix(np.arange(1, _LONG * 256 + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of every word of every text, first word of each text and the end).

    Words are what ASCII white space separates, with A-Z in lower case."""
    raw = b" ".join([b"", *[(t or "").encode("utf-8", "surrogatepass").lower() + b"\n" for t in texts], b""])
    data = np.frombuffer(raw, np.uint8)
    space = _SPACE[data]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    starts, ends = edge[0::2], edge[1::2]
    size = np.array([len((t or "").encode("utf-8", "surrogatepass")) + 2 for t in texts])
    borders = np.concatenate([[0], np.cumsum(size)])
    first = np.searchsorted(starts, borders)
    if not len(starts):
        return np.zeros(0, np.uint64), first
    sizes = ends - starts
    inside = ~space
    place = np.cumsum(inside, dtype=np.int64)  # running number of letters
    place -= np.repeat(place[starts] - 1, np.diff(np.append(starts, len(data)))) if starts[0] == 0 else np.concatenate(
        [np.zeros(starts[0], np.int64), np.repeat(place[starts] - 1, np.diff(np.append(starts, len(data))))])
    letters = np.flatnonzero(inside)
    at = np.minimum(place[letters] - 1, _LONG - 1) * 256 + data[letters]
    with np.errstate(over="ignore"):
        h = np.add.reduceat(_TABLE[at], np.concatenate([[0], np.cumsum(sizes)[:-1]]))
    for i in np.flatnonzero(sizes > _LONG).tolist():
        h[i] = xxhash.xxh64_intdigest(raw[starts[i]:ends[i]], 1)
    return mix(h), first


def shingle_sets(texts: list[str | None], words: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text."""
    h, first = word_hashes(texts)
    with np.errstate(over="ignore"):
        odd = mix(np.arange(1, words + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)  # unrelated factors
        n = len(h) - words + 1
        grams = mix(sum((h[k:k + n] * odd[k] for k in range(1, words)), h[:n] * odd[0])) if n > 0 else np.zeros(0, np.uint64)
        out = []
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            if b - a >= words:
                out.append(np.unique(grams[a:b - words + 1]))
            elif b > a:  # fewer words: the whole sequence, told from full shingles by its length
                one = sum((h[a + k:a + k + 1] * odd[k] for k in range(b - a)), np.full(1, b - a, np.uint64))
                out.append(mix(one ^ np.uint64(0xA5A5A5A5A5A5A5A5)))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def node_of(shingles: np.ndarray) -> int:
    """The set's 64-bit name, as a signed number."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes())).astype(np.int64))


def _bit(doc_id: int) -> int:
    return zlib.crc32(str(doc_id).encode()) & ((1 << NEED_BITS) - 1)


class Bound:
    """Sizes and overlaps that a similarity of ``num / den`` allows."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den

    def overlap(self, a, b):
        """Least number of common shingles of linked sets of these sizes."""
        return -(-self.num * (a + b) // (self.num + self.den))

    def prefix(self, size):
        return size - -(-self.num * size // self.den) + 1

    def sizes(self, a, b):
        """May sets of these sizes link?"""
        return (self.num * b <= self.den * a) & (self.num * a <= self.den * b)


def _texts(batch, column: str = "text"):
    texts = batch.column(column).to_pylist()
    for a, b in chunks(texts, 1_000_000):
        yield a, b, texts[a:b]


def _frame(rows: list[tuple], types: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [[] for _ in types]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, types, strict=True)], names=types.names)


def _arrays(types: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in types], names=types.names)


class _Join:
    """The steps of one join; tables between them lie in the cluster's shared place."""

    def __init__(self, docs: DataFrame, words: int, num: int, den: int):
        self.spark: SparkSession = docs.sparkSession
        prepare(self.spark)
        self.docs, self.words, self.bound = docs, words, Bound(num, den)
        self.at = shared_dir(self.spark, f"llm/jaccard/{uuid.uuid4().hex}")

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{self.at}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.at}/{name}")

    # 1 and 2: sizes, nodes, column counts
    def scan(self) -> tuple[DataFrame, DataFrame]:
        words, parts = self.words, 64
        fields = T.StructType([self.docs.schema["doc_id"], *schema_of("node bigint, size bigint, part int, counts binary").fields])

        def run(batches):
            counts = np.zeros(1 << COUNTER_BITS, np.uint32)
            ids_type = None
            for batch in batches:
                ids = batch.column(0)
                ids_type = ids.type
                for a, b, texts in _texts(batch):
                    sets = shingle_sets(texts, words)
                    every = np.concatenate(sets) >> np.uint64(64 - COUNTER_BITS)
                    np.add.at(counts, every.astype(np.int64), 1)
                    n = b - a
                    yield pa.RecordBatch.from_arrays(
                        [ids.slice(a, n), pa.array([node_of(s) if len(s) else None for s in sets], pa.int64()),
                         pa.array([len(s) for s in sets], pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())],
                        names=fields.names)
            if ids_type is not None:
                z = zstandard.ZstdCompressor(level=1)
                blocks = [z.compress(x.tobytes()) for x in np.split(counts, parts)]
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(parts, ids_type), pa.nulls(parts, pa.int64()), pa.nulls(parts, pa.int64()),
                     pa.array(range(parts), pa.int32()), pa.array(blocks, pa.binary())], names=fields.names)

        both = self.keep(self.docs.select("doc_id", "text").mapInArrow(tidy(run), fields), "scan")
        return both.where("part is null").drop("part", "counts"), both.where("part is not null").select("part", "counts")

    def frequencies(self, counts: DataFrame) -> np.ndarray:
        """log2 of each column counter, one byte each; 64 blocks reach the driver."""
        def add(batches):
            sums: dict[int, np.ndarray] = {}
            z = zstandard.ZstdDecompressor()
            for batch in batches:
                for p, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    v = np.frombuffer(z.decompress(raw), np.uint32)
                    sums[p] = sums[p] + v if p in sums else v.astype(np.uint64)
            if sums:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(sums), pa.int32()), pa.array([np.log2(v + 1.0).astype(np.uint8).tobytes() for v in sums.values()], pa.binary())],
                    names=["part", "counts"])

        rows = counts.repartition(64, "part").mapInArrow(tidy(add), schema_of("part int, counts binary")).collect()
        out = np.zeros(1 << COUNTER_BITS, np.uint8)
        size = len(out) // 64
        for r in rows:
            out[r["part"] * size:(r["part"] + 1) * size] = np.frombuffer(r["counts"], np.uint8)
        return out

    # 3: the first columns of every row, dealt out by column
    def columns(self, levels: np.ndarray) -> DataFrame:
        words, bound, shared = self.words, self.bound, self.spark.sparkContext.broadcast(levels.tobytes())
        fields = schema_of("column bigint, node bigint, size bigint")
        types = arrow_schema(fields)

        def run(batches):
            level = np.frombuffer(shared.value, np.uint8)
            done: set[int] = set()  # copies in one task are sent once
            for batch in batches:
                for _, _, texts in _texts(batch):
                    cols, nodes, sizes = [], [], []
                    for s in shingle_sets(texts, words):
                        if not len(s) or (node := node_of(s)) in done:
                            continue
                        done.add(node)
                        # 5 bits of frequency above 58 bits of the hash: the order of the columns and their name.
                        key = (level[(s >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)].astype(np.uint64) << np.uint64(58)) | (s & np.uint64((1 << 58) - 1))
                        p = int(bound.prefix(len(s)))
                        key = np.partition(key, p - 1)[:p] if p < len(key) else key
                        cols.append(key.astype(np.int64))
                        nodes.append(np.full(len(key), node, np.int64))
                        sizes.append(np.full(len(key), len(s), np.int64))
                    if cols:
                        yield _arrays(types, column=np.concatenate(cols), node=np.concatenate(nodes), size=np.concatenate(sizes))

        return self.docs.select("text").mapInArrow(tidy(run), fields)

    def products(self, postings: DataFrame) -> DataFrame:
        """kind 0: a pair that shares a column; 1: a hot column's node; 2: a pivot pair of a hot column."""
        bound = self.bound
        fields = schema_of("kind int, x bigint, y bigint, sx bigint, sy bigint, column bigint")
        types = arrow_schema(fields)

        def blocks(batches):
            """Column by column: the nodes of several columns at once, whole columns only."""
            held: list[np.ndarray] = []
            for batch in batches:
                held.append(np.column_stack([batch.column(k).to_numpy() for k in range(3)]))
                last = held[-1][-1, 0]
                if held[0][0, 0] == last:
                    continue  # a column goes on
                rows = np.concatenate(held)
                cut = int(np.searchsorted(rows[:, 0], last))
                yield rows[:cut]
                held = [rows[cut:]]
            if held:
                yield np.concatenate(held)

        def run(batches):
            for rows in blocks(batches):
                fresh = np.ones(len(rows), bool)
                fresh[1:] = (rows[1:] != rows[:-1]).any(axis=1)
                rows = rows[fresh]
                start = np.flatnonzero(np.append(True, rows[1:, 0] != rows[:-1, 0]))
                n = np.diff(np.append(start, len(rows)))
                out = {k: [] for k in types.names}

                def put(kind, x, y, column, out=out):
                    for k, v in (("kind", np.full(len(x), kind)), ("x", x[:, 1]), ("sx", x[:, 2]), ("y", y[:, 1]),
                                 ("sy", y[:, 2]), ("column", np.full(len(x), column))):
                        out[k].append(v)

                # Columns of two, by far the most, all at once; then the others one by one.
                two = start[n == 2]
                a, b = rows[two], rows[two + 1]
                ok = bound.sizes(a[:, 2], b[:, 2])
                put(0, a[ok], b[ok], 0)
                for s, m in zip(start[n > 2].tolist(), n[n > 2].tolist(), strict=True):
                    own = rows[s:s + m]  # by size, then node
                    if m <= HOT:
                        i, j = np.triu_indices(m, 1)
                        ok = bound.sizes(own[i, 2], own[j, 2])
                        put(0, own[i[ok]], own[j[ok]], 0)
                    else:
                        put(1, own, own, own[0, 0])
                        limit = own[:, 2] * bound.den // bound.num  # largest partner of each
                        pivot = 0
                        while pivot < m:
                            end = int(np.searchsorted(own[:, 2], limit[pivot], side="right"))
                            put(2, np.repeat(own[pivot:pivot + 1], end - pivot - 1, axis=0), own[pivot + 1:end], 0)
                            pivot = end
                if out["x"]:
                    yield _arrays(types, **{k: np.concatenate(v) for k, v in out.items()})

        return postings.repartition("column").sortWithinPartitions("column", "size", "node").mapInArrow(tidy(run), fields)

    @staticmethod
    def counted(products: DataFrame) -> DataFrame:
        """Common first columns of each pair (x < y)."""
        return (products.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"),
                                F.when(F.col("x") < F.col("y"), F.col("sx")).otherwise(F.col("sy")).alias("sx"),
                                F.when(F.col("x") < F.col("y"), F.col("sy")).otherwise(F.col("sx")).alias("sy"))
                .groupBy("x", "y", "sx", "sy").agg(F.count(F.lit(1)).alias("common")))

    def reachable(self, common):
        """Can a pair with so many common first columns reach the bound?"""
        num, den = self.bound.num, self.bound.den
        rest = [F.ceil(F.lit(num) * F.col(s) / F.lit(den)) - 1 for s in ("sx", "sy")]  # columns behind the first ones
        need = F.ceil(F.lit(num) * (F.col("sx") + F.col("sy")) / F.lit(num + den))
        return common + F.greatest(*rest) >= need

    # 4: whole overlaps
    def rows(self, needed: DataFrame, nodes: DataFrame) -> DataFrame:
        """(node, shingles): the whole rows of the nodes asked for, from their documents' texts."""
        bits, null_needed = self._bitmap(needed.join(nodes, "node").select("doc_id"))
        shared, words = self.spark.sparkContext.broadcast(bits), self.words
        row_type = schema_of("node bigint, shingles binary")

        def run(batches):
            flags = np.unpackbits(np.frombuffer(shared.value, np.uint8), bitorder="little").astype(bool)
            done: set[int] = set()
            for batch in batches:
                here = [null_needed if i is None else bool(flags[_bit(i)]) for i in batch.column(0).to_pylist()]
                batch = batch.filter(pa.array(here, pa.bool_()))
                for _, _, texts in _texts(batch):
                    out = []
                    for s in shingle_sets(texts, words):
                        if len(s) and (node := node_of(s)) not in done:
                            done.add(node)
                            out.append((node, s.tobytes()))
                    yield _frame(out, arrow_schema(row_type))

        sets = self.docs.select("doc_id", "text").mapInArrow(tidy(run), row_type).join(needed, "node", "left_semi")
        return self.keep(sets.dropDuplicates(["node"]), "rows")

    def links(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """The pairs (x, y) that link, by the exact overlap of their whole rows."""
        bound = self.bound
        # A row with very many partners is compared in several tasks.
        fan = pairs.groupBy("x").agg(F.ceil(F.count(F.lit(1)) / FAN).cast("int").alias("salts"))
        left = fan.join(sets, F.col("x") == F.col("node")).select(
            "x", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(None).cast("bigint").alias("y"), "shingles")
        right = pairs.join(fan, "x").join(sets, F.col("y") == F.col("node")).select(
            "x", F.pmod(F.xxhash64("y"), F.col("salts")).cast("int").alias("salt"), "y", "shingles")
        both = left.unionByName(right).repartition("x", "salt").sortWithinPartitions("x", "salt", F.col("y").asc_nulls_first())
        fields = schema_of("x bigint, y bigint")

        def compare(batches):
            own, key = None, None
            for batch in batches:
                out = []
                for x, salt, y, raw in zip(*[batch.column(k).to_pylist() for k in ("x", "salt", "y")], batch.column("shingles"), strict=True):
                    s = np.frombuffer(raw.as_buffer(), np.uint64)
                    if y is None:
                        own, key = s.copy(), (x, salt)
                    else:
                        assert key == (x, salt)
                        small, large = (s, own) if len(s) < len(own) else (own, s)
                        at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                        if int((large[at] == small).sum()) >= bound.overlap(len(s), len(own)):
                            out.append((x, y))
                yield _frame(out, arrow_schema(fields))

        return both.mapInArrow(tidy(compare), fields)

    def _bitmap(self, ids: DataFrame) -> tuple[bytes, bool]:
        """Fixed number of bits that tell which ids may be wanted; is null wanted?"""
        def mark(batches):
            bits, null = np.zeros(1 << NEED_BITS, bool), False
            for batch in batches:
                for i in batch.column(0).to_pylist():
                    if i is None:
                        null = True
                    else:
                        bits[_bit(i)] = True
            yield pa.RecordBatch.from_arrays([pa.array([zlib.compress(np.packbits(bits, bitorder="little").tobytes(), 1)], pa.binary()),
                                              pa.array([null], pa.bool_())], names=["bits", "has_null"])

        out, null = np.zeros((1 << NEED_BITS) // 8, np.uint8), False
        for r in ids.repartition(16).mapInArrow(tidy(mark), schema_of("bits binary, has_null boolean")).toLocalIterator():
            out |= np.frombuffer(zlib.decompress(r["bits"]), np.uint8)
            null |= r["has_null"]
        return out.tobytes(), null

    def hot_links(self, hot: DataFrame, labels: DataFrame, sets: DataFrame) -> DataFrame:
        """Links between nodes of a hot column that lie in different components.

        The column's nodes are dealt into blocks, and each pair of blocks is one product of
        their whole rows: a matrix product that gives the overlap of every pair without a row for
        it.  Two blocks of the column's largest component need none, so a column within one
        component costs nothing.  What comes back of a product is a forest of its links."""
        bound = self.bound
        tagged = hot.select("column", "node").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        per = tagged.groupBy("column", "label").agg(F.count(F.lit(1)).alias("n"))
        mixed = (per.groupBy("column").agg(F.sum("n").alias("m"), F.max(F.struct("n", "label")).alias("top"))
                 .where("top.n < m").select("column", F.col("top.label").alias("top"),
                                            F.ceil(F.col("top.n") / BLOCK).cast("int").alias("inner"),
                                            F.ceil((F.col("m") - F.col("top.n")) / BLOCK).cast("int").alias("outer")))
        at = F.xxhash64("node")
        # Blocks 0 .. outer-1 hold the other components' nodes, the next ``inner`` ones the largest component's.
        dealt = tagged.join(mixed, "column").select(
            "column", "node", "outer", "inner",
            F.when(F.col("label") == F.col("top"), F.col("outer") + F.pmod(at, F.col("inner"))).otherwise(F.pmod(at, F.col("outer"))).cast("int").alias("block"))
        partners = F.when(F.col("block") < F.col("outer"), F.sequence(F.lit(0), F.col("outer") + F.col("inner") - 1)).otherwise(
            F.sequence(F.lit(0), F.col("outer") - 1))
        spread = dealt.withColumn("other", F.explode(partners)).select(
            "column", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"), "block", "node")
        groups = spread.join(sets, "node").repartition("column", "a", "b").sortWithinPartitions("column", "a", "b", "block", "node")
        fields = schema_of("x bigint, y bigint")
        types = arrow_schema(fields)

        def run(batches):
            key, blocks, nodes, rows = None, [], [], []

            def product():
                linked = overlaps_reach(rows, np.array(blocks), bound)
                return _frame([(nodes[i], nodes[j]) for i, j in forest(linked)], types)

            for batch in batches:
                keys = zip(*[batch.column(k).to_pylist() for k in ("column", "a", "b")], strict=True)
                for now, block, node, raw in zip(keys, batch.column("block").to_pylist(), batch.column("node").to_pylist(),
                                                 batch.column("shingles"), strict=True):
                    if now != key:
                        if rows:
                            yield product()
                        key, blocks, nodes, rows = now, [], [], []
                    blocks.append(block)
                    nodes.append(node)
                    rows.append(np.frombuffer(raw.as_buffer(), np.uint64).copy())
            if rows:
                yield product()

        return groups.select("column", "a", "b", "block", "node", "shingles").mapInArrow(tidy(run), fields)

    def degrees(self, t: dict[str, DataFrame]) -> DataFrame:
        """(node, n_links): links of each node to other nodes, a node of several documents counted as often.

        A pair with a node that has no hot column shares a cold one, so it is among the links
        found pair by pair.  Two nodes with hot columns link only inside one component: there they
        are dealt into blocks of like size, and the product of two blocks gives each node the
        number of its links, never a row for a pair.  So each pair is counted in one place."""
        copies = t["nodes"].select("node", "copies")
        hot = self.keep(t["hot"].select("node", "size").distinct(), "hot-nodes")
        flag = [hot.select(F.col("node").alias(side), F.lit(True).alias(f"hot_{side}")) for side in ("x", "y")]
        cold = t["links"].join(flag[0], "x", "left").join(flag[1], "y", "left").where("hot_x is null or hot_y is null")
        ends = cold.select(F.col("x").alias("to"), F.col("y").alias("node")).union(cold.select("y", "x"))
        partial = ends.join(copies, "node").groupBy(F.col("to").alias("node")).agg(F.sum("copies").alias("n_links"))
        inside = hot.join(t["labels"], "node").join(copies, "node")
        partial = partial.unionByName(self.inner_degrees(inside, t["sets"]))
        return self.keep(partial.groupBy("node").agg(F.sum("n_links").alias("n_links")), "degrees")

    def inner_degrees(self, inside: DataFrame, sets: DataFrame) -> DataFrame:
        """(node, n_links) in parts: links between the nodes (``node, size, label, copies``) of one label.

        Blocks hold nodes of one size class; a class is as wide as the similarity lets sizes
        differ, so only blocks of one class or of two adjacent ones are multiplied."""
        bound = self.bound
        # A little wider than the widest ratio: rounding must not part two sizes by two classes.
        width = max(math.log(bound.den / bound.num) * (1 + 1e-9), 1e-9)
        inside = inside.withColumn("class", F.struct("label", F.floor(F.log("size") / width).alias("k")))
        blocks = self.keep(inside.groupBy("class").agg(F.count(F.lit(1)).alias("n"), F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("own")), "blocks")
        beside = [blocks.select(F.struct("class.label", (F.col("class.k") - step).alias("k")).alias("class"), F.col("own").alias(name))
                  for step, name in ((-1, "below"), (1, "above"))]
        blocks = self.keep(blocks.join(beside[0], "class", "left").join(beside[1], "class", "left").fillna(0, ["below", "above"]), "beside")
        dealt = spread_join(inside, blocks, "class", "n").withColumn("block", F.pmod(F.xxhash64("node"), F.col("own")).cast("int"))

        def each(count):
            return F.when(F.col(count) > 0, F.sequence(F.lit(0), F.col(count) - 1)).otherwise(F.array().cast("array<int>"))

        here, k = F.col("block"), F.col("class.k")
        partners = F.concat(
            F.transform(each("own"), lambda b: F.struct(k.alias("ka"), F.least(here, b).alias("a"), k.alias("kb"), F.greatest(here, b).alias("b"))),
            F.transform(each("above"), lambda b: F.struct(k.alias("ka"), here.alias("a"), (k + 1).alias("kb"), b.alias("b"))),
            F.transform(each("below"), lambda b: F.struct((k - 1).alias("ka"), b.alias("a"), k.alias("kb"), here.alias("b"))))
        keys = ["label", "ka", "a", "kb", "b"]
        spread = dealt.withColumn("pair", F.explode(partners)).select(
            "label", "pair.*", "node", "copies", ((F.col("pair.ka") == k) & (F.col("pair.a") == here)).alias("first"))
        tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))  # stated: products are small rows and much work
        groups = spread.join(sets, "node").repartition(tasks, *keys).sortWithinPartitions(*keys, "node")
        fields = schema_of("node bigint, n_links bigint")
        types = arrow_schema(fields)

        def run(batches):
            held: list[tuple] = []
            key = None

            def product():
                nodes, copies, side, rows = zip(*held, strict=True)
                # Both blocks of a pair, or a block with itself.
                diagonal = key[1:3] == key[3:5]
                return _arrays(types, node=nodes, n_links=links_of(list(rows), np.array(copies), None if diagonal else np.array(side), bound))

            for batch in batches:
                rows = zip(zip(*[batch.column(c).to_pylist() for c in keys], strict=True),
                           *[batch.column(c).to_pylist() for c in ("node", "copies", "first")], batch.column("shingles"), strict=True)
                for now, node, copies, side, raw in rows:
                    if now != key:
                        if held:
                            yield product()
                        key, held = now, []
                    held.append((node, copies, side, np.frombuffer(raw.as_buffer(), np.uint64).copy()))
            if held:
                yield product()

        return groups.select(*keys, "node", "copies", "first", "shingles").mapInArrow(tidy(run), fields)


def incidence(rows: list[np.ndarray], width: int = 4096):
    """The rows' incidence matrix, ``width`` columns at a time; only columns that two rows share."""
    columns, at, count = np.unique(np.concatenate(rows), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    place = np.cumsum(count > 1) - 1
    keep = count[at] > 1
    owner, place = owner[keep], place[at[keep]]
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    for c in range(0, int((count > 1).sum()), width):
        a, b = np.searchsorted(place, [c, c + width])
        m = np.zeros((len(rows), width), np.float32)
        m[owner[a:b], place[a:b] - c] = 1
        yield m


def links_of(rows: list[np.ndarray], weights: np.ndarray, first: np.ndarray | None, bound: Bound) -> np.ndarray:
    """Sum of the weights of the rows that each row links with: of all others, or of those on the other
    side where ``first`` tells the two sides apart."""
    sizes = np.array([len(r) for r in rows])
    left = right = np.arange(len(rows))
    if first is not None:
        left, right = np.flatnonzero(first), np.flatnonzero(~first)
    total = np.zeros((len(left), len(right)), np.float32)
    for m in incidence(rows):
        total += m[left] @ m[right].T
    linked = total >= bound.overlap(sizes[left][:, None], sizes[right][None, :])
    if first is None:
        np.fill_diagonal(linked, False)
        return linked @ weights
    out = np.zeros(len(rows), np.int64)
    out[left], out[right] = linked @ weights[right], linked.T @ weights[left]
    return out


def overlaps_reach(rows: list[np.ndarray], blocks: np.ndarray, bound: Bound, width: int = 4096) -> np.ndarray:
    """Which rows link, as a matrix, by the product of the incidence matrix with itself.

    Only columns that two rows share matter; they are multiplied ``width`` at a time.  Rows of one
    block are compared with each other only where there is no second block."""
    n, sizes = len(rows), np.array([len(r) for r in rows])
    total = np.zeros((n, n), np.float32)
    for m in incidence(rows, width):
        total += m @ m.T
    linked = total >= bound.overlap(sizes[:, None], sizes[None, :])
    if blocks.min() != blocks.max():
        linked &= blocks[:, None] != blocks[None, :]
    np.fill_diagonal(linked, False)
    return linked


def forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Edges that connect what the matrix connects, one fewer than nodes for each component."""
    new, out = np.ones(len(linked), bool), []
    for s in range(len(linked)):
        if not new[s]:
            continue
        new[s] = False
        queue = [s]
        while queue:
            u = queue.pop()
            found = np.flatnonzero(linked[u] & new).tolist()
            new[found] = False
            out += [(u, v) for v in found]
            queue += found
    return out


def _joined(docs: DataFrame, words: int, num: int, den: int) -> tuple[_Join, dict[str, DataFrame]]:
    """The join's tables: members (a row per document), nodes, hot columns, rows, links and labels."""
    j = _Join(docs.select("doc_id", "text"), words, num, den)
    members, counts = j.scan()
    nodes = j.keep(members.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies")), "nodes")
    products = j.keep(j.products(j.columns(j.frequencies(counts))), "products")
    hot = products.where("kind = 1").select("column", F.col("x").alias("node"), F.col("sx").alias("size"))
    counted = j.keep(j.counted(products.where("kind = 0")), "counted")
    # Columns of a pair that are hot were not counted yet: at most the smaller number of the two.
    hot_columns = hot.groupBy("node").agg(F.count(F.lit(1)).alias("n"))
    first = (counted.join(hot_columns.select(F.col("node").alias("x"), F.col("n").alias("hx")), "x", "left")
             .join(hot_columns.select(F.col("node").alias("y"), F.col("n").alias("hy")), "y", "left"))
    first = first.where(j.reachable(F.col("common") + F.least(F.coalesce("hx", F.lit(0)), F.coalesce("hy", F.lit(0)))))
    stars = products.where("kind = 2").select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()
    pairs = j.keep(first.select("x", "y").union(stars).distinct(), "pairs")
    needed = j.keep(pairs.select(F.col("x").alias("node")).union(pairs.select("y")).union(hot.select("node")).distinct(), "needed")
    sets = j.rows(needed, nodes)
    links = j.keep(j.links(pairs, sets), "links")
    labels = components(links, f"{j.at}/components")
    if not hot.isEmpty():
        labels = components(j.keep(links.union(j.hot_links(hot, labels, sets)), "all-links"), f"{j.at}/components-2")
    return j, {"members": members, "nodes": nodes, "hot": hot, "sets": sets, "links": links, "labels": labels}


def spread_join(rows: DataFrame, keyed: DataFrame, key: str, n: str) -> DataFrame:
    """``rows`` with the columns of ``keyed``, which has a row for each key and in ``n`` the number of its rows.

    Keys of more than one in ``HEAVY`` rows, fewer than ``HEAVY`` of them, are broadcast, so their rows
    stay where they are; the others shuffle."""
    total = keyed.agg(F.sum(n)).first()[0] or 0
    heavy = F.broadcast(keyed.where(F.col(n) * HEAVY > total).drop(n))
    light = keyed.where(F.col(n) * HEAVY <= total).drop(n)
    return rows.join(heavy, key).unionByName(rows.join(heavy.select(key), key, "left_anti").join(light, key))


def _named(j: _Join, t: dict[str, DataFrame], degrees: DataFrame | None = None) -> DataFrame:
    """The result: members with the smallest id of their component and, given degrees, their links."""
    placed = j.keep(t["nodes"].join(t["labels"], "node", "left"), "placed")
    alone = placed.where("label is null").withColumn("component_id", F.col("doc_id"))
    linked = placed.where("label is not null")
    lowest = j.keep(linked.groupBy("label").agg(F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("n")), "lowest")
    found = alone.unionByName(spread_join(linked, lowest, "label", "n")).select("node", "copies", "component_id")
    if degrees is not None:
        found = found.join(degrees, "node", "left").withColumn("n_links", F.col("copies") - 1 + F.coalesce("n_links", F.lit(0)))
    members = t["members"]
    out = spread_join(members.where("node is not null"), j.keep(found, "named"), "node", "copies")
    none = members.where("node is null").withColumn("component_id", F.col("doc_id"))
    if degrees is not None:
        none = none.withColumn("n_links", F.lit(0).cast("bigint"))
    out = out.unionByName(none).withColumnRenamed("size", "n_shingles")
    return out.select("doc_id", "n_shingles", "component_id", *(["n_links"] if degrees is not None else []))


def jaccard_components(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` (the smallest doc_id reachable by links of a
    Jaccard similarity of at least ``num / den`` over distinct word shingles)."""
    return _named(*_joined(docs, words, num, den))


def jaccard_join(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """As :func:`jaccard_components`, with ``n_links``: to how many other documents each one links."""
    j, t = _joined(docs, words, num, den)
    return _named(j, t, j.degrees(t))
