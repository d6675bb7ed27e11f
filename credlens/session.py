"""Spark session and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "credlens") -> SparkSession:
    """Session for tests and the bench; on a cluster the launcher's settings win."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("CREDLENS_DRIVER_MEMORY", "16g"))
    )
    if master:
        builder = builder.master(master)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def _single_machine(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A folder under the cluster's shared checkpoint location.

    The cluster names its shared folder in ``spark.checkpoint.dir``; we read it
    from the session.  Only when it is unset on a local master (tests, a laptop) do
    we create a private scratch folder and register it as the checkpoint dir; on a
    cluster other machines would not see such a folder, so that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base and not _single_machine(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not base:
        base = tempfile.mkdtemp(prefix="credlens-ckpt-")
        spark.sparkContext.setCheckpointDir(base)
        try:  # record it for later readers; some deployments reject setting core confs
            spark.conf.set("spark.checkpoint.dir", base)
        except Exception:  # noqa: BLE001
            pass
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/") + "/" + name


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared folder (survives executor loss), read back: compressed by column, so
    a reader takes the columns it needs, and of known size, so joins are planned on it."""
    path = shared_dir(df.sparkSession, f"credlens/tables/{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Session setting: partitions that every table scan is dealt into.  Unset (the default), files decide:
#: large ones split by themselves.  A launcher sets it where a table is one small file with one row
#: group, which a single task would read and map alone.
SCAN_PARTITIONS = "credlens.scan.partitions"


def scan_partitions(spark: SparkSession) -> int | None:
    dealt = spark.conf.get(SCAN_PARTITIONS, None)
    return int(dealt) if dealt else None


def shuffle_tasks(spark: SparkSession) -> int:
    """Partitions that the session shuffles into, for rows whose work is large for their bytes."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    dealt = scan_partitions(spark)
    return df.repartition(dealt) if dealt else df


def q6(col):
    """Quantise a double to 6 decimals with one IEEE-exact recipe.

    ``floor(x * 1e6 + 0.5) / 1e6`` gives bit-identical results in every engine
    that follows IEEE-754, unlike engine-specific ``round`` implementations.
    """
    from pyspark.sql import functions as F
    return (F.floor(col * 1000000.0 + 0.5) / 1000000.0).cast("double")


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``credlens`` importable in Python workers (UDFs, mapInPandas) wherever the
    driver was started: zip the package once per application and ``addPyFile`` it,
    which distributes it through Spark to every executor."""
    import zipfile

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    zpath = os.path.join(tempfile.mkdtemp(prefix="credlens-pyfiles-"), "credlens.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(zpath)
    _SHIPPED.add(app)
