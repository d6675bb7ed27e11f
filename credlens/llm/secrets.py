"""Secret scans over an incremental ledger of blobs.

A version is one text at one path; a blob is a text, named by its SHA-256.  The ledger keeps, in
the cluster's shared place, which version holds which blob (``versions``) and what each set of
rules found in each blob (``scans``).  ``ingest`` adds versions: blobs are named where the rows
are, (blob, rule version) pairs that the ledger already has are dropped, and only the texts of the
others are scanned, once each.  ``findings`` joins what was found back to every path.

* New rules: the same blobs are scanned again for the new rule version alone.
* Copies: a text that a third of all rows hold is hashed where it lies, moves once per task (rows of
  one blob are combined before the shuffle), and is scanned once.
* Findings: blobs that hold more than one row in ``HOT_SHARE`` are salted in the join back to the
  paths; there are at most ``HOT_SHARE`` of them.

Spans are in code points, the end exclusive.  A rule's matches are leftmost and do not overlap;
those that fail its check are dropped and not tried again.

Cases.  A null text is the empty blob, which is scanned like any other.  Repeated rows and rows of
one path, null paths included, are versions of their own.  Long texts are scanned whole.  Spans with one
start (ties) are in the order of the rules.  An empty table adds nothing.  Only the named columns are
read, so extra columns, whatever their names, do not matter.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from credlens.llm.common import chunks, prepare, work_dir

#: A blob is hot if more than one in so many versions hold it.
HOT_SHARE = 1000
#: Counted number of blobs up to which a set of names is broadcast (40 bytes each).
BROADCAST_BLOBS = 200_000


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` whose ``group`` passes ``check`` are secrets of ``kind``."""
    kind: str
    pattern: str
    flags: int = 0
    check: Callable[[re.Match], bool] | None = None
    #: A text that every match holds: others need no search.
    hint: str = ""

    def spans(self, text: str) -> Iterable[tuple[int, int]]:
        if self.hint not in text:
            return
        for m in re.compile(self.pattern, self.flags).finditer(text):
            if self.check is None or self.check(m):
                yield m.span()


@dataclass(frozen=True)
class RuleSet:
    """Rules under one version; a change of a rule needs a new version."""
    version: str
    rules: tuple[Rule, ...]

    def scan(self, text: str) -> list[tuple[str, int, int]]:
        found = [(start, i, end, rule.kind) for i, rule in enumerate(self.rules) for start, end in rule.spans(text)]
        return [(kind, start, end) for start, _, end, kind in sorted(found)]


def entropy(text: str) -> float:
    """Shannon bits per character."""
    n = len(text)
    return -sum(c / n * math.log2(c / n) for c in Counter(text).values()) if n else 0.0


def _long_value(m: re.Match) -> bool:
    return len(m.group(2)) >= 6


def _random_mix(m: re.Match) -> bool:
    """Upper and lower case and digits, and close to as many bits a character as its length allows."""
    s = m.group()
    return (re.search("[0-9]", s) is not None and re.search("[a-z]", s) is not None and re.search("[A-Z]", s) is not None
            and entropy(s) >= 0.8 * math.log2(min(len(s), 64)))


# FIXED VALUES: the base patterns; letters of the assignment's names are in either case
BASE = RuleSet("base-1", (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         re.ASCII | re.IGNORECASE, _long_value),
    Rule("access", "AKIA[A-Z0-9]+", 0, lambda m: m.end() - m.start() >= 20, "AKIA"),
    Rule("hex", "[0-9a-f]{24,}"),  # a run of fewer has no match at any of its places
))

# FIXED VALUES: public formats of keys and tokens
PROVIDERS = RuleSet("providers-1", (
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----[A-Za-z0-9+/=\s]+-----END (?:[A-Z]+ )*PRIVATE KEY-----", hint="-----BEGIN "),
    Rule("jwt", r"\beyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", hint="eyJ"),
    Rule("repository_token", r"\bgh[pousr]_[A-Za-z0-9]{36,}", hint="gh"),
    Rule("chat_token", r"\bxox[abprs]-[A-Za-z0-9-]{10,}", hint="xox"),
    Rule("browser_key", r"\bAIza[A-Za-z0-9_-]{35}", hint="AIza"),
    Rule("payment_key", r"\b[sr]k_live_[A-Za-z0-9]{16,}", hint="k_live_"),
    Rule("url_password", r"\b[a-z][a-z0-9+.-]{1,20}://[^\s:/@]{1,100}:[^\s/@]{6,100}@", hint="://"),
    Rule("random_text", r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{32,}={0,2}", 0, _random_mix),
))

SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
SCANS = T.StructType([T.StructField("blob", T.BinaryType()), T.StructField("rules", T.StringType()), T.StructField("spans", T.ArrayType(SPAN))])
_ARROW = pa.schema([("blob", pa.binary()), ("rules", pa.string()),
                    ("spans", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))])


class Ledger:
    """A ledger under ``path``: folders ``versions`` and ``scans``, one subfolder per ingest that succeeded.

    An ingest writes both tables of its number before it counts: a scan without its versions is
    redone, never half believed."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[T.StructField]):
        self.spark, self.path = spark, path
        #: Columns that name a version: a path, a revision.
        self.keys = list(keys)

    def _read(self, name: str, schema: T.StructType) -> DataFrame:
        done = range(self.ingests())
        if not done:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{name}/{k}" for k in done])

    def ingests(self) -> int:
        """Ingests whose versions, written last, are complete."""
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        at, k = hadoop.Path(self.path), 0
        fs = at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        while fs.exists(hadoop.Path(f"{self.path}/versions/{k}/_SUCCESS")):
            k += 1
        return k

    def versions(self) -> DataFrame:
        return self._read("versions", T.StructType([*self.keys, T.StructField("blob", T.BinaryType())]))

    def scans(self) -> DataFrame:
        return self._read("scans", SCANS)

    def ingest(self, rows: DataFrame, rule_sets: Sequence[RuleSet] = (BASE, PROVIDERS), text: str = "text") -> int:
        """Adds the versions in ``rows`` and scans what is new; also what the ledger's own rows lack
        of these rule sets, if ``rows`` hold it again.  Returns the number of blobs scanned."""
        prepare(self.spark)
        k, names = self.ingests(), [f.name for f in self.keys]
        body = F.coalesce(F.col(text), F.lit(""))
        blob = F.unhex(F.sha2(body, 256))
        versions = rows.select(*names, blob.alias("blob"))
        # Which pairs are new: names and bits only, no text moves.
        bit = F.lit(0)
        for i, r in enumerate(rule_sets):
            bit = F.when(F.col("rules") == r.version, 1 << i).otherwise(bit)
        known = self.scans().select("blob", bit.alias("bit")).groupBy("blob").agg(F.bit_or("bit").alias("known"))
        every = (1 << len(rule_sets)) - 1
        unseen = versions.select("blob").distinct().join(known, "blob", "left").select(
            "blob", F.lit(every).bitwiseXOR(F.coalesce("known", F.lit(0)).bitwiseAND(every)).alias("wanted")).where("wanted <> 0")
        unseen.write.mode("overwrite").parquet(f"{self.path}/unseen/{k}")
        unseen = self.spark.read.schema(unseen.schema).parquet(f"{self.path}/unseen/{k}")
        count = unseen.count()
        texts = rows.select(blob.alias("blob"), body.alias("body"))
        if count <= BROADCAST_BLOBS:
            wanted = texts.join(F.broadcast(unseen), "blob").groupBy("blob", "wanted").agg(F.first("body").alias("body"))
        else:
            # Copies are combined first: the join that follows has one row per blob on both sides.
            wanted = texts.groupBy("blob").agg(F.first("body").alias("body")).join(unseen, "blob")
        scans = wanted.select("blob", "wanted", "body").mapInArrow(_scanner(rule_sets), SCANS)
        scans.write.mode("overwrite").parquet(f"{self.path}/scans/{k}")
        versions.write.mode("overwrite").parquet(f"{self.path}/versions/{k}")
        return count

    def findings(self, rule_sets: Sequence[RuleSet] = (BASE, PROVIDERS)) -> DataFrame:
        """Every version with its ``spans`` under these rule sets, by start, then rule; none: an empty list."""
        order = {(r.version, rule.kind): i for i, (r, rule) in
                 enumerate((r, rule) for r in rule_sets for rule in r.rules)}
        rank = F.create_map(*[F.lit(x) for (v, kind), i in order.items() for x in (f"{v}/{kind}", i)])
        hits = (self.scans().where(F.col("rules").isin([r.version for r in rule_sets]) & (F.size("spans") > 0))
                .select("blob", "rules", F.explode("spans").alias("s"))
                .select("blob", F.struct(F.col("s.start").alias("start"), rank[F.concat("rules", F.lit("/"), F.col("s.kind"))].alias("at"),
                                         F.col("s.end").alias("end"), F.col("s.kind").alias("kind")).alias("s")))
        # A blob's spans are bounded by its text.  A pair scanned twice, by an ingest that was redone, counts once.
        hits = hits.groupBy("blob").agg(F.array_sort(F.collect_set("s")).alias("spans"))
        versions = self.versions()
        total = versions.count()
        hot = (versions.groupBy("blob").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") * HOT_SHARE > total)
               .select("blob", F.ceil(F.col("rows") * HOT_SHARE / F.lit(max(total, 1))).cast("int").alias("salts")))
        salted = versions.join(F.broadcast(hot), "blob", "left").withColumn(
            "salt", F.pmod(F.xxhash64(*[f.name for f in self.keys]), F.coalesce("salts", F.lit(1)).cast("long")))
        copies = hits.join(F.broadcast(hot), "blob", "left").withColumn(
            "salt", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("salts", F.lit(1)).cast("long") - 1)))
        found = salted.join(copies.select("blob", "salt", "spans"), ["blob", "salt"], "left")
        spans = F.transform(F.coalesce("spans", F.array().cast(copies.schema["spans"].dataType)),
                            lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
        return found.select(*[f.name for f in self.keys], "blob", spans.alias("spans"))


def _scanner(rule_sets: Sequence[RuleSet]):
    sets = list(rule_sets)

    def run(batches):
        for batch in batches:
            blobs, wanted, texts = (batch.column(i).to_pylist() for i in range(3))
            for a, b in chunks(texts):
                out = [(blobs[j], r.version, [{"kind": kind, "start": start, "end": end} for kind, start, end in r.scan(texts[j])])
                       for j in range(a, b) for i, r in enumerate(sets) if wanted[j] >> i & 1]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _ARROW.types)], schema=_ARROW)
    return run


def digest_text(spans):
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def find(spark: SparkSession, docs: DataFrame, path: str | None = None) -> DataFrame:
    """Secrets of every row of ``documents``, by a ledger of its own (or the one under ``path``)."""
    ledger = Ledger(spark, path or work_dir(spark, "secrets"), [docs.schema["doc_id"]])
    ledger.ingest(docs)
    found = ledger.findings()
    kinds = [rule.kind for rule in BASE.rules]
    base = F.filter("spans", lambda s: s["kind"].isin(kinds))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[count(kind) for kind in kinds], F.sha2(digest_text(base), 256).alias("base_sha256"),
                        digest_text(F.col("spans")).alias("spans"), F.lower(F.hex("blob")).alias("blob"))
