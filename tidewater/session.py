"""Session defaults and the shared scratch location used by writing operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_SCRATCH: dict[int, str] = {}


def build_session(master: str = "local[*]", partitions: int = 8, app: str = "tidewater",
                  extra: dict | None = None, scratch_dir: str | None = None) -> SparkSession:
    """A session with the settings the library relies on.

    ``scratch_dir`` (``spark.checkpoint.dir``) is the shared folder for lineage cuts, staging and checkpoints.

    AQE re-plans joins and coalesces shuffle partitions at run time, skew-join
    splitting is on, the session zone is pinned to UTC so NTZ<->LTZ casts are
    stable, and the web UI stays off.
    """
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        # A whole-stage method above the JIT's 8000-bytecode limit would run
        # interpreted; past that size, fall back to per-operator codegen.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
    )
    if scratch_dir:
        builder = builder.config("spark.checkpoint.dir", scratch_dir)
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _checkpoint_base(spark: SparkSession) -> str:
    """The shared folder named by the cluster in ``spark.checkpoint.dir``.

    Only a local-mode session (tests, the bench) without that setting gets a
    private temporary folder; on a cluster the setting is required because a
    machine-local folder is not visible to other executors.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if base:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(base)
        return base.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if sc.master != "local" and not sc.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/NFS) for this cluster")
    key = id(sc)
    if key not in _LOCAL_SCRATCH:
        _LOCAL_SCRATCH[key] = tempfile.mkdtemp(prefix="tidewater-")
        sc.setCheckpointDir(_LOCAL_SCRATCH[key])
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, run-unique path under the shared checkpoint folder."""
    return f"{_checkpoint_base(spark)}/tw-{name}-{uuid.uuid4().hex[:12]}"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make sure ``checkpoint()`` has a shared folder; returns it."""
    return _checkpoint_base(spark)
