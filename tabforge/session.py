"""Session helpers: one place for the configuration the library relies on."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Settings every session built here carries. AQE re-plans joins and
# aggregations at runtime (broadcast conversion from real sizes, partition
# coalescing, skew splitting); the UI stays off (no server is opened).
BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Sizing for cluster runs over very large inputs (applied when the running
# master is not local, for settings the job did not set itself). Start with many shuffle partitions and let AQE coalesce them to
# ~256 MB each, so no reducer has to spill a giant partition; read files in
# 256 MB splits; split any partition over 512 MB (and 5x the median) in joins.
SCALE_CONF = {
    "spark.sql.shuffle.partitions": "4000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
}


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "tabforge",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the library's base configuration.

    On a cluster ``master`` is left to spark-submit; locally pass ``local[N]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    sc = _context(spark)
    if sc is not None:
        sc.setLogLevel("ERROR")
        if not (sc.master or "").startswith("local"):
            # cluster sizing (runtime SQL settings), never over the job's own --conf
            given = sc.getConf()
            for k, v in SCALE_CONF.items():
                if not given.contains(k) and k not in conf:
                    spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()
# paths staged inside the innermost ``released_scratch`` block
_HELD: ContextVar[list[str] | None] = ContextVar("held_scratch", default=None)


def _context(spark: SparkSession):
    """The SparkContext, or None for sessions without one (Spark Connect)."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions raise on access
        return None


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers (like ``--py-files``).

    Needed by Arrow/pandas stages whose functions live in the package. Done
    once per application and only in local mode; cluster jobs ship the
    package with ``spark-submit --py-files`` (no driver-local staging there).
    """
    sc = _context(spark)
    if sc is None:
        return
    app = sc.applicationId
    if app in _SHIPPED or not (sc.master or "").startswith("local"):
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    staging = tempfile.mkdtemp(prefix="tabforge-pyfiles-")
    archive = shutil.make_archive(
        os.path.join(staging, "tabforge"), "zip",
        root_dir=os.path.dirname(pkg_dir), base_dir=os.path.basename(pkg_dir),
    )
    sc.addPyFile(archive)
    _SHIPPED.add(app)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins. Only when it is unset in local mode
    (tests) is a fresh scratch folder created and registered; a cluster
    session without the setting is an error, never a machine-local folder.
    """
    sc = _context(spark)
    if sc is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("spark.checkpoint.dir must name a shared folder for this session")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not (sc.master or "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder for cluster runs")
        # local runs (tests) only: a fresh scratch folder on this machine
        configured = tempfile.mkdtemp(prefix="tabforge-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def cut_lineage(df: DataFrame, name: str = "materialized") -> DataFrame:
    """Materialise ``df`` as Parquet in the shared checkpoint folder.

    The plan runs once, the files live on fault-tolerant shared storage, and
    the returned frame reads them back (columnar, with pushdown), so a lost
    executor never forces recomputation of the upstream plan.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A unique path under the shared checkpoint folder for staged writes."""
    base = ensure_checkpoint_dir(spark)
    path = os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")
    if (held := _HELD.get()) is not None:
        held.append(path)
    return path


@contextmanager
def released_scratch(spark: SparkSession) -> Iterator[None]:
    """Delete the staged writes made inside the block when it ends.

    Frames that read them must have been written elsewhere by then. Sessions
    without a SparkContext (Spark Connect) keep the files.
    """
    outer, held = _HELD.get(), []
    token = _HELD.set(held)
    try:
        yield
    finally:
        _HELD.reset(token)
        sc = _context(spark)
        if sc is None:
            if outer is not None:
                outer.extend(held)
        else:
            for name in held:
                path = sc._jvm.org.apache.hadoop.fs.Path(name)
                path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
