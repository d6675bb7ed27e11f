"""WARC archives of pages, and their capture index by external merge.

Writing is column work: every page becomes a WARC/1.0 record, and Spark's text writer puts the
records into gzip files with its commit protocol (the blank lines that end a record are the
writer's line separator).  Records with an equal payload of at least ``REVISIT_BYTES`` bytes: that
with the largest id is a ``response``, the others are ``revisit`` records that refer to it and hold
no payload.

Reading parses the files record by record, by Content-Length.  Each file gives a run of
captures sorted by URL key, time and id; runs are kept as tables in shared storage.  The index
is then merged: each task gets one key range of all runs and merges them with a loser tree, so
all ranges together list every URL's captures in global order, and a URL with very many
captures may span ranges.  A range holds about ``RANGE_ROWS`` captures however many there are.

Null html is an empty payload; null urls have an empty key; null ids are written as ``none``
and never become the record that others refer to (a payload that only such rows have: all
``response``).  Equal rows give equal records; captures of one key, time and id follow by file and offset.  Very long
payloads are in files of few records.  An empty table gives an empty index.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from credlens.llm.common import arrow_schema, prepare, schema_of
from credlens.session import shared_dir

#: Smaller payloads are always stored in full.
REVISIT_BYTES = 1000
#: (Largest payload in bytes, records in one file): one task reads a file as one value, so a file holds about a
#: gigabyte before compression at most, and larger pages have files of their own.
FILES = ((1 << 17, 8000), (1 << 23, 128), (1 << 62, 1))
#: Captures in one key range of the merge, about; bounds a task's memory.
RANGE_ROWS = 50_000
PROFILE = "http://netpreservefoundation.org/warc/1.1/revisit/identical-payload-digest"
EPOCH = 1_577_836_800

CAPTURE = ("urlkey string, captured string, page_id bigint, url string, record_type string, payload_bytes bigint, "
           "payload_digest string, refers_to bigint, file string, record_offset bigint, record_bytes bigint")


def capture_time(id_col: str) -> Column:
    """Pages carry no time: one second after another, by id."""
    return F.date_format(F.timestamp_seconds(F.lit(EPOCH) + F.coalesce(F.pmod(F.col(id_col), F.lit(10 ** 9)), F.lit(0))),
                         "yyyy-MM-dd'T'HH:mm:ss'Z'")


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            captured: Column | None = None) -> DataFrame:
    """One row per page: ``record``, the text of its WARC record without the closing blank lines.

    One shuffle of the payloads by their digest (AQE splits a digest that very many rows share);
    the digests' originals are summed up before they are shuffled."""
    p = pages.select(F.col(id_col).alias("id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"),
                     F.coalesce(F.col(html_col), F.lit("")).alias("html"),
                     (capture_time(id_col) if captured is None else captured).alias("captured"))
    p = p.select("*", F.sha1(F.encode("html", "UTF-8")).alias("digest"), F.octet_length("html").alias("bytes"))
    first = (p.where(F.col("bytes") >= REVISIT_BYTES).groupBy("digest", "bytes")
             .agg(F.max("id").alias("original"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    p = p.join(first, ["digest", "bytes"], "left")
    again = F.col("original").isNotNull() & ~F.col("id").eqNullSafe(F.col("original"))
    name = F.coalesce(F.col("id").cast("string"), F.lit("none"))
    # Control characters and blanks cannot stand in a header line.
    uri = F.regexp_replace("url", r"[\x00-\x20\x7f]", "%20")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("bytes").cast("string"), F.lit("\r\n\r\n"))
    block = F.when(again, http).otherwise(F.concat(http, F.col("html")))
    head = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: "), F.when(again, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: <urn:page:"), name, F.lit(">\r\nWARC-Date: "), F.col("captured"),
        F.lit("\r\nWARC-Target-URI: "), uri, F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("digest"),
        F.when(again, F.concat(F.lit(f"\r\nWARC-Profile: {PROFILE}\r\nWARC-Refers-To: <urn:page:"),
                               F.col("original").cast("string"), F.lit(">"))).otherwise(""),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "))
    return p.select(F.concat(head, F.octet_length(block).cast("string"), F.lit("\r\n\r\n"), block).alias("record"))


def write(pages: DataFrame, path: str, **columns) -> str:
    """Write the archives under ``path``, a folder for each class of payload sizes; returns it.

    Equal payloads are of one class, so each class finds its revisits alone."""
    size = F.coalesce(F.octet_length(columns.get("html_col", "html")), F.lit(0))
    largest, low = pages.agg(F.max(size)).first()[0] or 0, -1
    for high, n in FILES:
        (records(pages.where((size > low) & (size <= high)), **columns).write.option("lineSep", "\r\n\r\n")
         .option("compression", "gzip").option("maxRecordsPerFile", n).text(f"{path}/up-to-{high}"))
        low = high
        if largest <= high:
            break
    return path


def url_key(url: str | None) -> str:
    """Sort-friendly form of a URL: host labels reversed, then path and query; lower case."""
    m = re.match(r"(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?(?:www\d*\.)?([^/?#:]*)(?::(\d+))?([^#]*)", (url or "").lower())
    if not m:
        return (url or "").lower()
    port = f":{m[2]}" if m[2] and m[2] not in ("80", "443") else ""
    return ",".join(reversed(m[1].split("."))) + port + ")" + (m[3].rstrip("/") or "/")


class Stream:
    """A gzip (or plain) file read piece by piece."""

    def __init__(self, raw):
        self.raw, self.at, self.buffer, self.base = memoryview(raw), 0, bytearray(), 0
        self.gzip = zlib.decompressobj(31) if bytes(self.raw[:2]) == b"\x1f\x8b" else None

    def _more(self) -> bool:
        if self.at >= len(self.raw):
            return False
        part = bytes(self.raw[self.at:self.at + 262_144])
        self.at += len(part)
        while part:
            if not self.gzip:
                self.buffer += part
                break
            self.buffer += self.gzip.decompress(part)
            part = self.gzip.unused_data
            if self.gzip.eof:
                self.gzip = zlib.decompressobj(31)
        return True

    def until(self, mark: bytes) -> bytes | None:
        """Bytes before ``mark``, which is skipped; None at the end of the file."""
        seen = 0
        while (i := self.buffer.find(mark, seen)) < 0:
            seen = max(0, len(self.buffer) - len(mark))
            if not self._more():
                return None
        return self.take(i + len(mark))[:-len(mark)]

    def take(self, n: int) -> bytes:
        while len(self.buffer) < n and self._more():
            pass
        if len(self.buffer) < n:
            raise ValueError("archive ends inside a record")
        out = bytes(self.buffer[:n])
        del self.buffer[:n]
        self.base += n
        return out


def parse(raw) -> Iterator[tuple[dict, bytes, int, int]]:
    """(headers, block, offset, bytes) of every record of a file; offsets count uncompressed bytes."""
    s = Stream(raw)
    while True:
        start = s.base
        head = s.until(b"\r\n\r\n")
        if head is None:
            return
        lines = head.decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at {start}")
        fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
        block = s.take(int(fields["Content-Length"]))
        if s.take(4) != b"\r\n\r\n":
            raise ValueError(f"record at {start} does not end where it should")
        yield fields, block, start, s.base - start


def _page(name: str | None) -> int | None:
    m = re.fullmatch(r"<urn:page:(-?\d+)>", name or "")
    return int(m[1]) if m else None


def captures(raw, file: str) -> list[tuple]:
    """The sorted run of one file."""
    out = []
    for f, block, start, size in parse(raw):
        http, _, payload = block.partition(b"\r\n\r\n")
        kind = f["WARC-Type"]
        if kind == "revisit":
            n = int(re.search(rb"Content-Length: (\d+)", http)[1])
            digest = f["WARC-Payload-Digest"].removeprefix("sha1:")
        else:
            n, digest = len(payload), hashlib.sha1(payload).hexdigest()
            if digest != f["WARC-Payload-Digest"].removeprefix("sha1:"):
                raise ValueError(f"payload of {f['WARC-Record-ID']} does not match its digest")
        url = f.get("WARC-Target-URI", "")
        out.append((url_key(url), f["WARC-Date"], _page(f["WARC-Record-ID"]), url, kind, n, digest,
                    _page(f.get("WARC-Refers-To")), file, start, size))
    out.sort(key=order)
    return out


def order(row: tuple) -> tuple:
    """URL key, time, id (null first), place in the archives."""
    return row[0], row[1], row[2] is not None, row[2] or 0, row[8], row[9]


class LoserTree:
    """Merges sorted runs: inner nodes keep the loser of their match, so the next smallest row
    costs one match per level."""

    def __init__(self, runs: list[list[tuple]], key=order):
        self.runs, self.key, self.k = runs, key, max(1, len(runs))
        self.place = [0] * len(runs)
        self.heads = [(0, key(r[0])) if r else (1,) for r in runs] or [(1,)]  # (1,) is beyond every row
        self.losers = [-1] * self.k
        self.winner = self._play(1)

    def _play(self, node: int) -> int:
        if node >= self.k:
            return node - self.k
        a, b = self._play(2 * node), self._play(2 * node + 1)
        if self.heads[b] < self.heads[a]:
            a, b = b, a
        self.losers[node] = b
        return a

    def __iter__(self) -> Iterator[tuple]:
        while self.heads[self.winner] != (1,):
            w = self.winner
            run = self.runs[w]
            yield run[self.place[w]]
            self.place[w] += 1
            self.heads[w] = (0, self.key(run[self.place[w]])) if self.place[w] < len(run) else (1,)
            node = (w + self.k) // 2
            while node:
                if self.heads[self.losers[node]] < self.heads[w]:
                    self.losers[node], w = w, self.losers[node]
                node //= 2
            self.winner = w


def _batch(rows: list[tuple], types: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [[] for _ in types]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, types, strict=True)], names=types.names)


def write_runs(spark: SparkSession, path: str, runs: str) -> str:
    """Parse the archives under ``path`` and store a sorted run for each file under ``runs``."""
    prepare(spark)
    fields = schema_of(CAPTURE + ", run string, run_no bigint")
    types = arrow_schema(fields)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", True).load(path).select("path", "content")

    def run(batches):
        for batch in batches:
            for name, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows = [(*r, name, i) for i, r in enumerate(captures(raw.as_buffer(), name))]
                for i in range(0, len(rows), 10_000):
                    yield _batch(rows[i:i + 10_000], types)

    files.mapInArrow(run, fields).write.parquet(runs)
    return runs


def merge_runs(spark: SparkSession, runs: str) -> DataFrame:
    """The index: all captures in order of URL key, time and id, one key range to a partition."""
    fields = schema_of(CAPTURE)
    types = arrow_schema(fields)
    names = types.names

    def merge(batches):
        # The rows of a run follow each other in its own order: the partition is sorted so.
        runs, last = [], None
        for batch in batches:
            cols = [batch.column(n).to_pylist() for n in [*names, "run"]]
            for *row, run in zip(*cols, strict=True):
                if run != last:
                    runs.append([])
                    last = run
                runs[-1].append(tuple(row))
        out = []
        for row in LoserTree(runs):
            out.append(row)
            if len(out) == 10_000:
                yield _batch(out, types)
                out = []
        if out:
            yield _batch(out, types)

    found = spark.read.schema(schema_of(CAPTURE + ", run string, run_no bigint")).parquet(runs)
    n = max(1, -(-found.count() // RANGE_ROWS))
    dealt = found.repartitionByRange(
        n, "urlkey", "captured", F.col("page_id").asc_nulls_first(), "file", "record_offset").sortWithinPartitions("run", "run_no")
    return dealt.mapInArrow(merge, fields)


def archive_and_index(pages: DataFrame, **columns) -> DataFrame:
    """Write the archives, read them back, and return the merged index."""
    spark = pages.sparkSession
    at = shared_dir(spark, f"llm/warc/{uuid.uuid4().hex}")
    write(pages, f"{at}/archives", **columns)
    return merge_runs(spark, write_runs(spark, f"{at}/archives", f"{at}/runs"))
