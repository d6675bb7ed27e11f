"""Shared helpers of the training-data operators: Arrow batch mapping, sampling, span digests.

Every operator reads an id column and a text column and returns the id plus its own
columns, so extra input columns can never clash with what an operator adds.
"""

from __future__ import annotations

import ctypes
import gc
import os
import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from credlens.session import shared_dir, ship_package, table

#: Text characters handled at once inside a task; bounds the working set whatever the batch size.
CHUNK_CHARS = 4_000_000

ARROW = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "double": pa.float64(),
         "boolean": pa.bool_(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64()),
         "array<binary>": pa.list_(pa.binary()), "array<double>": pa.list_(pa.float64())}


#: Rows in one Arrow batch at most.  Texts are long: ten thousand of them, Spark's default, in every
#: buffer between the JVM and Python would take more than the executor's heap.
ARROW_ROWS = 1000


def prepare(spark: SparkSession) -> None:
    """Make the package importable in Python workers and keep Arrow batches small."""
    ship_package(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))


_KEPT: dict = {}


def kept(kind: str, key, build: Callable):
    """What an operator keeps in a Python worker between its tasks: a matcher, a model, a memory of words.

    Workers are reused by every operator of an application, so one thing is kept at a time: asking
    for another frees the last one."""
    if (kind, key) not in _KEPT:
        _KEPT.clear()
        give_back()
        _KEPT[kind, key] = build()
    return _KEPT[kind, key]


def give_back() -> None:
    """Free memory of this worker returns to the machine: an idle worker holds none of its last task."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def tidy(run: Callable) -> Callable:
    """A task's function that keeps nothing in its worker: first it frees what another operator kept there,
    at last it gives back what the task took."""
    def inside(batches):
        _KEPT.clear()
        give_back()
        yield from run(batches)
        give_back()

    return inside


def schema_of(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def arrow_schema(schema: T.StructType) -> pa.Schema:
    return pa.schema([pa.field(f.name, ARROW[f.dataType.simpleString()]) for f in schema.fields])


def chunks(texts: Sequence[str | None], limit: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges of ``texts`` of at most ``limit`` characters (one text at least)."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t is not None else 0
        if size and size + n > limit:
            yield start, i
            start, size = i, 0
        size += n + 1
    if start < len(texts):
        yield start, len(texts)


def map_text(df: DataFrame, fn: Callable[[list], dict], out: str, text_col: str = "text",
             carry: Sequence[str] = ("doc_id",), names: Sequence[str] | None = None) -> DataFrame:
    """Run ``fn(list of texts) -> dict of equally long columns`` over Arrow batches.

    ``carry`` columns pass through untouched, ``out`` is the DDL of what ``fn`` adds; ``names``
    renames the added columns, for a caller that carries columns of the same names.  No
    shuffle; a lost executor's tasks are simply rerun.
    """
    prepare(df.sparkSession)
    carry = list(carry)
    types = arrow_schema(schema_of(out))
    names = list(names or types.names)
    added = T.StructType([T.StructField(n, f.dataType) for n, f in zip(names, schema_of(out).fields, strict=True)])
    kept = T.StructType([df.schema[c] for c in carry])
    need = carry + ([] if text_col in carry else [text_col])

    def run(batches):
        for batch in batches:
            if batch.num_rows == 0:
                continue
            col = batch.column(need.index(text_col))
            texts = col.to_pylist()
            for a, b in chunks(texts):
                got = fn(texts[a:b])
                arrays = [batch.column(need.index(c)).slice(a, b - a) for c in carry]
                arrays += [pa.array(got[f.name], type=f.type) for f in types]
                yield pa.RecordBatch.from_arrays(arrays, names=carry + names)
        give_back()

    return df.select(*need).mapInArrow(run, T.StructType(kept.fields + added.fields))


def sorted_groups(batches, keys: Sequence[str], columns: Sequence[str]) -> Iterator[tuple[tuple, list[tuple]]]:
    """(key, rows) for each run of equal ``keys`` in Arrow batches that arrive sorted by them."""
    current, rows = None, []
    for batch in batches:
        lists = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in (*keys, *columns)]
        for key, row in zip(zip(*lists[:len(keys)]), zip(*lists[len(keys):])):
            if key != current:
                if rows:
                    yield current, rows
                current, rows = key, []
            rows.append(row)
    if rows:
        yield current, rows


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder in the cluster's shared place."""
    return shared_dir(spark, f"llm/{name}/{uuid.uuid4().hex}")


def stored(df: DataFrame, path: str) -> DataFrame:
    """``df`` written to a table in the shared place and read back: a lost executor costs no earlier step."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def held_out(col: str = "doc_id"):
    """The contract's split: true for rows whose crc32(id as text) mod 5 is 0 (null ids: false)."""
    return F.coalesce(F.crc32(F.col(col).cast("string")) % 5 == 0, F.lit(False))


def bounded_sample(df: DataFrame, rows: int, key: str = "doc_id") -> DataFrame:
    """At most ``rows`` rows, those with the smallest hash of ``key``: the same at every run."""
    return df.orderBy(F.xxhash64(F.col(key).cast("string")), F.col(key)).limit(rows)


def tokenizer_path(name: str) -> str:
    """Default place of a public tokenizer file; every operator takes a path instead."""
    import public_tokenizers
    return public_tokenizers.path(name)


_TOKENIZERS: dict[str, object] = {}


def tokenizer(path: str):
    """One tokenizer per worker process; threads stay off, Spark already uses every core."""
    if path not in _TOKENIZERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
        _TOKENIZERS[path] = t
    return _TOKENIZERS[path]
