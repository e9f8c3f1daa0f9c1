"""Session helpers: one place for the Spark settings the jobs rely on."""
from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, nullcontext

from pyspark.sql import DataFrame, SparkSession

# Settings every job wants; cluster launchers may override any of them.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # runtime (measured) size bound under which AQE turns a join into a broadcast
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "citegrid") -> SparkSession:
    """Session for tests and the bench (local mode only)."""
    b = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for k, v in _DEFAULTS.items():
        b = b.config(k, v)
    b = (b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
          .config("spark.driver.memory", os.environ.get("CITEGRID_DRIVER_MEMORY", "16g")))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the session.

    On a cluster ``spark.checkpoint.dir`` must point at shared storage; we only
    pick a folder of our own when it is unset and the master is local.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="citegrid-ckpt-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for a written table."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}-{uuid.uuid4().hex[:12]}"


_FREES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_go(spark: SparkSession) -> Iterator[None]:
    """What is written inside frees its shuffle files as soon as it is there, not
    when the driver happens to collect its garbage (Spark 4.1 and later)."""
    before = spark.conf.get(_FREES, None)
    spark.conf.set(_FREES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREES)
        else:
            spark.conf.set(_FREES, before)


def materialize(df: DataFrame, name: str, paths: list[str] | None = None, free: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back (cuts lineage, survives
    executor loss, unlike a local checkpoint).  ``paths`` collects what was
    written, for ``remove_tables`` when nothing reads it any more; with ``free``
    the shuffle files of the write go with it."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with shuffles_go(spark) if free else nullcontext():
        df.write.mode("overwrite").parquet(path)
    if paths is not None:
        paths.append(path)
    return spark.read.parquet(path)


def remove_tables(spark: SparkSession, paths: list[str]) -> None:
    """Deletes tables that ``materialize`` wrote in this run."""
    for path in paths:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


_SHIPPED: set[str] = set()
_SHIP_LOCK = threading.Lock()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in executor Python workers (what
    ``--py-files`` does): zip it once per SparkContext and ``addPyFile``.
    Needed by every ``mapInPandas`` stage, since the task functions refer to
    module-level helpers."""
    sc = spark.sparkContext
    key = sc.applicationId
    with _SHIP_LOCK:
        if key not in _SHIPPED:
            _ship(sc)
            _SHIPPED.add(key)


def _ship(sc) -> None:
    import zipfile
    from pathlib import Path

    root = Path(__file__).resolve().parent
    zpath = Path(tempfile.mkdtemp(prefix="citegrid-pyfiles-")) / "citegrid.zip"
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent).as_posix())
    sc.addPyFile(str(zpath))
