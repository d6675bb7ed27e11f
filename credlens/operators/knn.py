"""Exact k-nearest-neighbour classification with distance weights (MLT-05).

Reference vectors are dealt into cells around pivots (a fixed number of reference vectors).  Two passes:

1. a query looks at its nearest cells, as many as hold ``k`` vectors together: the k-th distance found
   there is a true upper bound of its k-th neighbour's distance;
2. by the triangle inequality a cell whose pivot is further than its radius plus that bound holds no
   neighbour; the query looks at the other cells only.

A pass is a join on the cell: a cell's vectors are cut into blocks, and a block answers its queries by
matrix products that pick candidates, whose distances are then computed exactly.  At most ``k`` rows
per query and block come back.  A cell that holds most vectors is many blocks, so it is many tasks' work.

The result is exact.  Ties in distance are broken by id.  Vote: weight 1/d; if any neighbour is at
distance 0, those neighbours get weight 1 and the others 0; the class with the largest total weight
wins, the smallest class on a tie.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from credlens.session import cut_lineage

PIVOTS = 32
#: Vectors of one block, and queries that one matrix product answers.
BLOCK, QUERIES = 4096, 256


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _with_pivots(df: DataFrame, pivots: np.ndarray, keep: str) -> DataFrame:
    """Adds ``cell`` (nearest pivot), ``dc`` (its distance) and ``pd`` (distances of all pivots) to (id, v, keep)."""
    sent = df.sparkSession.sparkContext.broadcast(pivots)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            v = _matrix(batch.column(1))
            d = np.sqrt(((v[:, None, :] - sent.value[None]) ** 2).sum(2))
            cell = d.argmin(1)
            cols = [*batch.columns, pa.array(cell, pa.int32()), pa.array(d[np.arange(len(d)), cell], pa.float64()), pa.array(list(d), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(cols, names=[*batch.schema.names, "cell", "dc", "pd"])

    kept = f", {keep} {df.schema[keep].dataType.simpleString()}" if keep else ""
    return df.mapInArrow(run, f"id {df.schema['id'].dataType.simpleString()}, v array<double>{kept}, cell int, dc double, pd array<double>")


def _nearest_in(v: np.ndarray, norms: np.ndarray, ids: np.ndarray, queries: np.ndarray, k: int):
    """(places, exact distances) of the ``k`` nearest rows of ``v`` to each query; ties by id.

    One product answers all queries; ``norms`` are the squared lengths of ``v``."""
    own = (queries * queries).sum(1)
    approx = norms[None] - 2.0 * (queries @ v.T) + own[:, None]
    cuts = None
    if len(v) > k:
        # products lose digits: everything near the k-th candidate is computed again
        cuts = np.partition(approx, k - 1, axis=1)[:, k - 1] + 1e-7 * (1.0 + own)
    for i, q in enumerate(queries):
        places = np.arange(len(v)) if cuts is None else np.flatnonzero(approx[i] <= cuts[i])
        exact = np.sqrt(((v[places] - q) ** 2).sum(1))
        order = np.lexsort((ids[places], exact))[:k]
        yield places[order], exact[order]


def _look(asked: DataFrame, cells: DataFrame, sizes: DataFrame, k: int) -> DataFrame:
    """(qid, rid, rlabel, d): per query and block of each asked cell, its nearest vectors.  ``asked``: (qid, v, cell)."""
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    refs = cells.join(F.broadcast(sizes), "cell").select(
        "cell", F.pmod(F.xxhash64("id"), blocks).cast("int").alias("block"), F.lit(0).alias("kind"), "id", "v", F.col("label").cast("string").alias("label"))
    queries = asked.join(F.broadcast(sizes), "cell").select(
        "cell", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"), F.lit(1).alias("kind"), F.col("qid").alias("id"), "v",
        F.lit(None).cast("string").alias("label"))
    met = refs.unionByName(queries).repartition("cell", "block").sortWithinPartitions("cell", "block", "kind")
    arrow = pa.schema([("qid", pa.int64()), ("rid", pa.int64()), ("rlabel", pa.string()), ("d", pa.float64())])

    def run(batches):
        key, held, block = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            at = list(zip(*(batch.column(i).to_pylist() for i in range(3))))
            ids, v, labels = batch.column(3).to_numpy(zero_copy_only=False), _matrix(batch.column(4)), batch.column(5).to_pylist()
            i = 0
            while i < len(at):
                # a run of rows of one block and kind
                j = i + 1
                while j < len(at) and at[j] == at[i]:
                    j += 1
                if at[i][:2] != key:
                    key, held, block = at[i][:2], [], None
                if at[i][2] == 0:
                    held.append((ids[i:j], v[i:j], labels[i:j]))
                elif held:
                    if block is None:
                        vectors = np.concatenate([h[1] for h in held])
                        block = np.concatenate([h[0] for h in held]), vectors, (vectors * vectors).sum(1), [x for h in held for x in h[2]]
                        held = [()]
                    for a in range(i, j, QUERIES):
                        b = min(a + QUERIES, j)
                        out = [(int(ids[a + n]), int(block[0][p]), block[3][p], float(x))
                               for n, (places, d) in enumerate(_nearest_in(block[1], block[2], block[0], v[a:b], k)) for p, x in zip(places, d)]
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)
                i = j

    return met.mapInArrow(run, "qid bigint, rid bigint, rlabel string, d double")


def _best(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("qid").orderBy(F.col("d").asc(), F.col("rid").asc())
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


class Cells:
    """Reference vectors in cells, and the two passes of queries over them."""

    def __init__(self, refs: DataFrame, n_pivots: int = PIVOTS):
        """``refs``: (id, v, label)."""
        # pivots: reference vectors chosen by hash of id (bounded)
        rows = refs.orderBy(F.sha2(F.col("id").cast("string"), 256)).limit(n_pivots).select("v").collect()
        self.pivots = np.array([r["v"] for r in rows], np.float64)
        if not len(rows):
            raise ValueError("no reference vectors")
        self.cells = cut_lineage(_with_pivots(refs, self.pivots, "label").drop("pd"))
        self.sizes = cut_lineage(self.cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("dc").alias("radius")))
        # one row per cell, n_pivots at most
        stats = {r["cell"]: (r["n"], r["radius"]) for r in self.sizes.collect()}
        self.members = [stats.get(c, (0, 0.0))[0] for c in range(len(rows))]
        self.radius = [float(stats.get(c, (0, 0.0))[1]) for c in range(len(rows))]

    def first_cells(self, queries: DataFrame, k: int) -> DataFrame:
        """(qid, v, pd, first): the nearest cells of each query that hold ``k`` vectors together (all, if fewer exist)."""
        n = F.array(*[F.lit(m).cast("long") for m in self.members])
        near = F.array_sort(F.transform("pd", lambda d, i: F.struct(d.alias("d"), i.alias("c"))))
        order = F.filter(F.transform(near, lambda s: s["c"]), lambda c: F.get(n, c) > 0)
        # a cell is asked while the cells before it hold fewer than k
        before = F.transform(order, lambda c, i: F.aggregate(F.slice(order, 1, i), F.lit(0).cast("long"), lambda a, x: a + F.get(n, x)))
        first = F.filter(F.zip_with(order, before, lambda c, b: F.when(b < k, c)), lambda c: c.isNotNull())
        return _with_pivots(queries, self.pivots, "").select(F.col("id").alias("qid"), "v", "pd", first.alias("first"))

    def further_cells(self, asked: DataFrame, bounds: DataFrame) -> DataFrame:
        """(qid, v, cell) of the cells that may hold a nearer vector than the bound (qid, bound); no bound: all others."""
        radius = F.array(*[F.lit(r) for r in self.radius])
        some = [c for c, m in enumerate(self.members) if m]
        every = F.array(*[F.lit(c) for c in some])
        with_bound = asked.join(bounds, "qid", "left")
        # a hair of slack: the bound and the pivot distances are rounded
        may = lambda c: F.get("pd", c) - F.get(radius, c) <= F.coalesce("bound", F.lit(float("inf"))) * (1 + 1e-9) + 1e-9
        left = F.filter(every, lambda c: ~F.array_contains("first", c) & may(c))
        return with_bound.select("qid", "v", F.explode(left).alias("cell"))

    def neighbours(self, queries: DataFrame, k: int) -> DataFrame:
        """(qid, rid, rlabel, d, rank) of the k nearest reference vectors of each query (id, v)."""
        asked = cut_lineage(self.first_cells(queries, k))
        near = cut_lineage(_best(_look(asked.select("qid", "v", F.explode("first").alias("cell")), self.cells, self.sizes.select("cell", "n"), k), k))
        bounds = near.filter(F.col("rank") == k).select("qid", F.col("d").alias("bound"))
        more = _look(self.further_cells(asked, bounds), self.cells, self.sizes.select("cell", "n"), k)
        return _best(near.drop("rank").unionByName(more), k)


def knn_predict(queries: DataFrame, refs: DataFrame, k: int = 9, n_pivots: int = PIVOTS,
                id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Predicted label per query row: (id, pred)."""
    r = refs.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"), F.col(label_col).alias("label"))
    q = queries.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    nn = Cells(r, n_pivots).neighbours(q, k)
    label_type = refs.schema[label_col].dataType
    per = nn.groupBy("qid").agg(F.min("d").alias("nearest"))
    weight = F.when(F.col("nearest") == 0, (F.col("d") == 0).cast("double")).otherwise(1.0 / F.col("d"))
    votes = nn.join(per, "qid").groupBy("qid", F.col("rlabel").cast(label_type).alias("rlabel")).agg(F.sum(weight).alias("score"))
    # of equal scores the smallest class
    top = votes.groupBy("qid").agg(F.min(F.struct((-F.col("score")).alias("s"), "rlabel")).alias("best"))
    return top.select(F.col("qid").cast(queries.schema[id_col].dataType).alias(id_col), F.col("best.rlabel").alias("pred"))
