"""Session defaults and the shared scratch location.

The library never invents a machine-local folder on a cluster: scratch data (stream
checkpoints, replay files, lineage cuts) lives under ``spark.checkpoint.dir``, which a
cluster points at shared storage. Only when the setting is absent (local runs, tests) do we
create one under the system temp directory.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every costpulse job relies on. UTC makes event time, window bounds and the
# DuckDB oracle agree; AQE coalesces small shuffles and splits skewed ones at runtime.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Parquet files are read at most 128 MB per task; the default, stated for clarity.
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
}


def get_spark(app_name: str = "costpulse", master: str | None = None,
              conf: dict[str, str] | None = None) -> SparkSession:
    """Create or reuse a session with costpulse defaults (explicit ``conf`` wins)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return ``spark.checkpoint.dir``. Only a local-mode session without one (tests, a
    laptop) gets a temporary folder; on a cluster a driver-local folder would be invisible
    to executors and lost with the driver, so the setting is required there."""
    current = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:          # a Spark Connect session has no SparkContext on the client
        sc = None
    if not current and sc is not None:
        current = sc.getCheckpointDir()
    if not current:
        if sc is None or not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS or "
                               "an object store) before running costpulse jobs on a cluster")
        current = tempfile.mkdtemp(prefix="costpulse-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, "costpulse", *parts, uuid.uuid4().hex])


def importable_by_workers(spark: SparkSession) -> None:
    """Put the folder of this package on the Python workers' path, where it is visible to them
    (local mode, a shared install). Elsewhere install the package or pass it by --py-files."""
    try:
        env = spark.sparkContext.environment
    except Exception:          # a Spark Connect session ships code its own way
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def prepare(spark: SparkSession) -> SparkSession:
    """Settings a costpulse plan relies on in any session: event time is a UTC wall clock
    (parsing, truncation and windows assume a UTC session), workers that can import the
    package, and a checkpoint folder where one can be set. Plans that need scratch space or
    ``checkpoint()`` ask for the folder themselves (``scratch_path``) and fail there when a
    cluster names none."""
    importable_by_workers(spark)
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    try:
        ensure_checkpoint_dir(spark)
    except RuntimeError:
        pass
    return spark
