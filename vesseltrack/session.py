"""Session helpers: UTC pinning, adaptive execution, shared scratch space.

Library functions never create a session; they take the caller's. ``get_session``
is for tests, the bench and command-line use.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Session settings every run relies on. UTC because `cast(ts as date)` and
# `timestampdiff` follow the session zone and the data is UTC.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Starting points for a large cluster (100 TB-class inputs); tune to the executors.
# Shuffle partitions: many, then let AQE coalesce small ones and split skewed
# joins; 128 MB scan splits; broadcast joins only through the explicit,
# size-checked hints of this package (no statistics-based surprises).
CLUSTER_CONF = {
    **SESSION_CONF,
    "spark.sql.shuffle.partitions": "4000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.sources.partitionOverwriteMode": "static",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "vesseltrack", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session configured for this library."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (SparkSession.builder
               .master(master or f"local[{cpus}]")
               .appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
               .config("spark.driver.memory", os.environ.get("VT_DRIVER_MEMORY", "8g")))
    for k, v in {**SESSION_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def pin_utc(spark: SparkSession) -> None:
    """Pin the session zone; every date/hour computation in the library assumes it."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only when none is set.

    On a cluster ``spark.checkpoint.dir`` names a shared file system; it is read
    from the session and never replaced; a session on a cluster without one is
    an error, as each executor would write to its own disk. Only an unset
    local session (unit tests, a laptop) gets a fresh local folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="vt-checkpoint-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder for staged writes."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/vt-scratch/{name}-{uuid.uuid4().hex}"


def materialize(df, name: str):
    """Cut lineage: write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Preferred to ``Dataset.checkpoint()`` for wide frames: the copy is
    columnar and compressed, and readers prune columns and push filters into
    it. The folder is on the cluster's shared storage, so the copy outlives a
    lost executor.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers (``addPyFile``), once per application.

    Pandas functions that run on executors refer to this package's modules;
    when the package is not installed on the executors it is zipped from the
    driver's copy and distributed by Spark like a ``--py-files`` archive.
    """
    import shutil

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out_dir = tempfile.mkdtemp(prefix="vt-pyfiles-")  # driver-side source of the archive only
    archive = shutil.make_archive(os.path.join(out_dir, "vesseltrack"), "zip",
                                  root_dir=os.path.dirname(pkg_dir), base_dir=os.path.basename(pkg_dir))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)


SCRATCH_DB = "vt_scratch"


class Scratch:
    """Intermediate tables of one job, dropped (data included) when the job is done.

    The tables live in a database located under ``spark.checkpoint.dir``
    (shared storage on a cluster), so they cut lineage and survive executor
    loss like a checkpoint, and ``DROP TABLE`` removes their files: a year of
    windowed runs does not pile up copies of every window's timeline.

        with Scratch(spark) as scratch:
            tl = scratch.keep(timeline_df, "timeline")
            ...  # every write that reads tl
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.tables: list[str] = []

    def keep(self, df, name: str):
        base = ensure_checkpoint_dir(self.spark).rstrip("/")
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {SCRATCH_DB} LOCATION '{base}/{SCRATCH_DB}'")
        table = f"{SCRATCH_DB}.{name.replace('-', '_')}_{uuid.uuid4().hex[:16]}"
        df.write.format("parquet").saveAsTable(table)
        self.tables.append(table)
        return self.spark.table(table)

    def close(self) -> None:
        for t in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {t}")
        self.tables.clear()

    def __enter__(self):
        return self

    def __exit__(self, *exc):
        self.close()
        return False


def keep(df, name: str, scratch: "Scratch | None" = None):
    """``scratch.keep`` when a job owns the intermediate, else :func:`materialize`."""
    return scratch.keep(df, name) if scratch is not None else materialize(df, name)
