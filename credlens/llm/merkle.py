"""Merkle manifest of a dataset, with a proof for every row found by pointer jumping.

Every row is a leaf.  The leaves of a group (``lang``, say) stand in the order of their id and
are hashed in pairs, level by level, to the group's sub-root; the sub-roots, ordered by group,
are hashed likewise to the root.  A proof is the list of siblings that lead from a leaf to the root.

* Numbering: rows are range-partitioned by (group, id, leaf), numbered inside their partition, and
  shifted by the rows that their group has in earlier partitions.  A group may hold any share of
  the rows: nothing is ever gathered per group.
* Building: blocks of 4096 (``2 ** BLOCK_BITS``) neighbouring nodes are hashed to their top in one task; the
  tops are the nodes of the next pass.  So a tree of n leaves takes ``log2(n) / BLOCK_BITS`` shuffles.
* Proofs: each node starts with a pointer to its parent and the one sibling on that way (its
  segment).  A self-join replaces a pointer by the pointer of the node it leads to and appends that
  node's segment, so distances double: 1, 2, 4, ...  After r joins only nodes whose level is a
  multiple of ``2 ** r`` can still be pointed at, so the tables of targets shrink fast; the leaves run
  through the same joins.  Targets of one round are shared by at most ``2 ** 2 ** r`` leaves, and are
  broadcast as soon as their counted size allows it, so no join has a hot key.

Cases.  A null field is hashed as ``-``, an empty text as ``0:``.  A null group is a group of its own
and comes first; null ids come first in their group.  Rows of one id (ties) are ordered by their
leaf; fully equal rows are leaves of their own with equal digests, and their proofs are theirs in
some order.  Long texts are hashed by Spark and never leave their row.  An empty table has no
root: every result is empty.  Only the named fields are read, so extra columns, whatever their
names, neither matter nor clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from credlens.llm.common import prepare, sorted_groups, stored, work_dir

#: Nodes hashed together by one task: blocks of 4096 digests.
BLOCK_BITS = 12
#: Counted size up to which a round's pointer targets are broadcast.
BROADCAST_BYTES = 16_000_000
#: A step of a proof: one byte (sibling on the right, on the left, none) and the sibling's digest.
STEP = 33
RIGHT, LEFT, ALONE = b"\0", b"\1", b"\2"

#: Key of the nodes above the sub-roots; keys of groups are empty (null) or start with ``v``.
UPPER = "r"


def digest(parts: Sequence[bytes]) -> bytes:
    """H of digests: SHA-256 over their lower-case hex texts."""
    return hashlib.sha256("".join(p.hex() for p in parts).encode()).digest()


def row_digest(fields: Sequence[str | Column]) -> Column:
    """H of a row's fields: ``-`` for null, else UTF-8 byte count, colon and value; as binary."""
    def one(f):
        text = (F.col(f) if isinstance(f, str) else f).cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
    return F.unhex(F.sha2(F.concat(*[one(f) for f in fields]), 256))


def _numbered(rows: DataFrame, sort: Sequence[str], path: str) -> DataFrame:
    """Adds ``idx``, the place of a row in its ``grp`` by ``sort``, and ``n``, the rows of the group."""
    names = rows.columns
    schema = rows.schema.simpleString()[len("struct<"):-1]

    def number(batches):
        part, group, at = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            places = []
            for g in batch.column(names.index("grp")).to_pylist():
                if g != group:
                    group, at = g, 0
                places.append(at)
                at += 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([part] * len(places), pa.int32()), pa.array(places, pa.int64())],
                names=[*names, "part", "pos"])

    order = [F.col(c).asc_nulls_first() for c in ("grp", *sort)]
    placed = stored(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                    .mapInArrow(number, schema + ",part:int,pos:bigint"), path)
    # A group has one row per partition here, never its own rows.
    counts = placed.groupBy("grp", "part").agg(F.count(F.lit(1)).alias("here"))
    earlier = Window.partitionBy("grp").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.select("grp", "part", F.coalesce(F.sum("here").over(earlier), F.lit(0)).alias("before"),
                          F.sum("here").over(Window.partitionBy("grp")).alias("n"))
    return placed.join(shift, ["grp", "part"]).withColumn("idx", F.col("before") + F.col("pos")).select(*names, "idx", "n")


def _block(rows: list[tuple], base: int, bits: int):
    """Nodes of one block, as (level, idx, digest, step), and its top, whose step is None.

    ``rows`` are (idx, digest, n) in order; n is the number of nodes of the whole group there."""
    first, n = rows[0][0], rows[0][2]
    nodes, level = [d for _, d, _ in rows], base
    for _ in range(bits):
        if n == 1:
            break
        above = []
        for i in range(0, len(nodes), 2):
            pair = nodes[i:i + 2]
            if len(pair) == 2:
                yield level, first + i, pair[0], RIGHT + pair[1]
                yield level, first + i + 1, pair[1], LEFT + pair[0]
            else:
                yield level, first + i, pair[0], ALONE + bytes(32)
            above.append(digest(pair))
        nodes, first, n, level = above, first >> 1, (n + 1) >> 1, level + 1
    yield level, first, nodes[0], None


_NODES = "grp string, level int, idx bigint, digest binary, step binary"
_ARROW = pa.schema([("grp", pa.string()), ("level", pa.int32()), ("idx", pa.int64()), ("digest", pa.binary()),
                    ("step", pa.binary())])


def _build(leaves: DataFrame, largest: int, path: str, bits: int) -> tuple[DataFrame, DataFrame]:
    """All nodes below the tops, and the top of each group (grp, level, digest)."""
    now, parts, base = leaves.select("grp", "idx", "digest", "n"), [], 0
    while True:
        def run(batches, base=base):
            out = []
            for (grp, _), rows in sorted_groups(batches, ["grp", "block"], ["idx", "digest", "n"]):
                out += [(grp, *node) for node in _block(rows, base, bits)]
                if len(out) > 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _ARROW.types)], schema=_ARROW)
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _ARROW.types)], schema=_ARROW)

        blocks = now.withColumn("block", F.shiftright("idx", bits))
        made = stored(blocks.repartition("grp", "block").sortWithinPartitions("grp", "block", "idx").mapInArrow(run, _NODES),
                      f"{path}/{len(parts)}")
        parts.append(made)
        if largest <= 1 << bits:
            break
        # Tops of groups that were done in an earlier pass have n = 1 and pass through unchanged.
        size = now.select("grp", F.shiftright(F.col("n") + (1 << bits) - 1, bits).alias("n")).distinct()
        base, largest = base + bits, (largest + (1 << bits) - 1) >> bits
        now = (made.where(f"step is null and level = {base}").select("grp", "idx", "digest")
               .join(size, "grp").select("grp", "idx", "digest", "n"))
    nodes = parts[0]
    for p in parts[1:]:
        nodes = nodes.unionByName(p)
    inner = nodes.where("step is not null")
    if len(parts) == 1:
        return inner, nodes.where("step is null").select("grp", "level", "digest")
    # A top that a later pass took up again is there either an inner node or the group's top.
    tops = nodes.where("step is null").groupBy("grp").agg(F.max_by("digest", "level").alias("digest"), F.max("level").alias("level"))
    return inner, tops.select("grp", "level", "digest")


def manifest(rows: DataFrame, fields: Sequence[str], group: str, order: str, carry: Mapping[str, Column] | None = None,
             path: str | None = None, block_bits: int = BLOCK_BITS) -> DataFrame:
    """A leaf and its whole proof per row of ``rows``.

    Returns ``order``'s column, the ``carry`` columns (for a caller that needs more of the row),
    ``leaf`` (binary), ``depth`` (steps up to the sub-root), ``proof`` (binary, ``STEP`` bytes a step) and
    ``root`` (binary, the same in all rows)."""
    spark, carry = rows.sparkSession, dict(carry or {})
    prepare(spark)
    path = path or work_dir(spark, "merkle")
    extra = [f"x{i}" for i in range(len(carry))]
    hashed = rows.select(F.coalesce(F.concat(F.lit("v"), F.col(group).cast("string")), F.lit("")).alias("grp"),
                         F.col(order).alias("ord"), row_digest(fields).alias("digest"),
                         *[c.alias(x) for x, c in zip(extra, carry.values())])
    leaves = _numbered(stored(hashed, f"{path}/rows"), ["ord", "digest"], f"{path}/placed")
    leaves = stored(leaves, f"{path}/leaves")
    names = {"ord": order, **dict(zip(extra, carry))}
    largest = leaves.agg(F.max("n")).first()[0]
    if largest is None:
        return leaves.select(*[F.col(x).alias(c) for x, c in names.items()], F.col("digest").alias("leaf"),
                             F.lit(0).alias("depth"), F.col("digest").alias("proof"), F.col("digest").alias("root"))
    lower, subroots = _build(leaves, largest, f"{path}/lower", block_bits)
    subroots = stored(subroots.select(F.lit("").alias("grp"), F.col("grp").alias("of"), "level", "digest"), f"{path}/subroots")
    tops = stored(_numbered(subroots, ["of"], f"{path}/placed_subroots"), f"{path}/tops")
    groups = tops.count()
    upper, roots = _build(tops, groups, f"{path}/upper", block_bits)
    root = bytes(roots.first()["digest"])
    rounds = max((largest - 1).bit_length() + (groups - 1).bit_length() - 1, 0).bit_length()

    # Pointers (g, level, idx) -> (ag, alevel, aidx).  A sub-root keeps its name of the lower trees.
    up = [F.lit(UPPER).alias("ag"), (F.col("level") + 1).alias("alevel"), F.shiftright("idx", 1).alias("aidx"),
          F.col("step").alias("seg")]
    named = (upper.where("level = 0").select("idx", "step").join(tops.select("idx", "of", F.col("level").alias("depth")), "idx")
             .select(F.col("of").alias("g"), F.col("depth").alias("level"), F.lit(0).cast("long").alias("idx"),
                     F.lit(UPPER).alias("ag"), F.lit(1).alias("alevel"), F.shiftright("idx", 1).alias("aidx"),
                     F.col("step").alias("seg"), F.lit(True).alias("keep")))
    high = upper.where("level > 0").select(F.lit(UPPER).alias("g"), "level", "idx", *up, F.lit(True).alias("keep"))
    up[0] = F.col("grp").alias("ag")
    inner = lower.where("level > 0").select(F.col("grp").alias("g"), "level", "idx", *up, F.lit(False).alias("keep"))
    targets = inner.unionByName(named).unionByName(high)

    # Leaves with their first pointer.  The only leaf of a group is the sub-root itself.
    first = (lower.where("level = 0").select("grp", "idx", F.col("grp").alias("ag"), F.lit(1).alias("alevel"),
                                              F.shiftright("idx", 1).alias("aidx"), F.col("step").alias("seg"))
             .unionByName(named.where("level = 0").select(F.col("g").alias("grp"), "idx", "ag", "alevel", "aidx", "seg")))
    climbing = leaves.join(first, ["grp", "idx"], "left")
    for r in range(rounds):
        targets = stored(targets, f"{path}/targets/{r}")
        small = targets.count() * (STEP * 2 ** r + 100) <= BROADCAST_BYTES
        climbing = _jump(climbing, targets, small)
        targets = _jump(targets.where(f"keep or level % {2 ** (r + 1)} = 0"), targets, small)
    return climbing.select(*[F.col(x).alias(c) for x, c in names.items()], F.col("digest").alias("leaf"),
                           F.when(F.col("n") == 1, 0).otherwise(F.length(F.bin(F.col("n") - 1))).alias("depth"),
                           F.coalesce("seg", F.lit(b"")).alias("proof"), F.lit(root).alias("root"))


def _jump(rows: DataFrame, targets: DataFrame, small: bool) -> DataFrame:
    """Doubles the distance of the pointers of ``rows``; those that lead to the root stay."""
    to = targets.select(F.col("g").alias("_g"), F.col("level").alias("_l"), F.col("idx").alias("_i"), F.col("ag").alias("_ag"),
                        F.col("alevel").alias("_al"), F.col("aidx").alias("_ai"), F.col("seg").alias("_s"))
    found = rows.join(F.broadcast(to) if small else to, (F.col("ag") == F.col("_g")) & (F.col("alevel") == F.col("_l"))
                      & (F.col("aidx") == F.col("_i")), "left")
    new = {"ag": F.coalesce("_ag", "ag"), "alevel": F.coalesce("_al", "alevel"), "aidx": F.coalesce("_ai", "aidx"),
           "seg": F.when(F.col("_s").isNull(), F.col("seg")).otherwise(F.concat("seg", "_s"))}
    return found.select(*[new[c].alias(c) if c in new else F.col(c) for c in rows.columns])


def fold(leaf: bytes, proof: bytes, steps: int | None = None) -> bytes:
    """The digest that ``leaf`` leads to over the first ``steps`` steps (default: all)."""
    end = len(proof) if steps is None else steps * STEP
    for i in range(0, end, STEP):
        side, other = proof[i:i + 1], proof[i + 1:i + STEP]
        leaf = digest([leaf] if side == ALONE else [leaf, other] if side == RIGHT else [other, leaf])
    return leaf


def siblings_digest(proof: bytes) -> bytes:
    """H of a proof's siblings, from the leaf up; steps without a sibling add nothing."""
    return digest([proof[i + 1:i + STEP] for i in range(0, len(proof), STEP) if proof[i:i + 1] != ALONE])


def verify(proofs: DataFrame, order: str, claimed: str = "leaf") -> DataFrame:
    """Checks the leaf in column ``claimed`` (null: the leaf itself) of each row against the root.

    Returns ``order``'s column and the lower-case hex digests leaf, subroot, root, proof_sha256 and
    folded_root, and whether the latter is the root.  Sub-root and folded root are recomputed from
    the leaf and its siblings alone, as a holder of one row would."""
    keep = proofs.schema[order]
    out = pa.schema([(c, pa.string()) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")] + [("verified", pa.bool_())])
    rows = proofs.select(order, "leaf", "depth", "proof", "root", F.coalesce(claimed, "leaf").alias("claimed"))

    def run(batches):
        for batch in batches:
            made = []
            for leaf, depth, proof, root, claim in zip(*[batch.column(i).to_pylist() for i in range(1, 6)]):
                subroot = fold(leaf, proof, depth)
                folded = fold(subroot, proof[depth * STEP:]) if claim == leaf else fold(claim, proof)
                made.append((leaf.hex(), subroot.hex(), root.hex(), siblings_digest(proof).hex(), folded.hex(), folded == root))
            if made:
                arrays = [pa.array(c, t) for c, t in zip(zip(*made), out.types)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=[order, *out.names])

    kept = f"`{order}` {keep.dataType.simpleString()}"
    return rows.mapInArrow(run, kept + ", " + ", ".join(f"{f.name} {'boolean' if f.name == 'verified' else 'string'}" for f in out))


def tampered_manifest(docs: DataFrame, block_bits: int = BLOCK_BITS) -> DataFrame:
    """Every row of ``documents`` checked against the root of the untampered table.

    Where 7 divides the CRC-32 of the id, the row's claimed leaf is that of a copy whose ``n_chars`` is
    one more (null stays null)."""
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    forged = row_digest(["doc_id", "source", "lang", F.col("n_chars") + 1, "text"])
    claimed = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, forged)
    return verify(manifest(docs, fields, group="lang", order="doc_id", carry={"claimed": claimed}, block_bits=block_bits),
                  "doc_id", "claimed")
