"""Session helpers: where jobs may write, and a session for tests/bench."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

from kiln import paths

_CKPT_KEY = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor and the driver can reach.

    On a cluster this is the shared folder named by ``spark.checkpoint.dir``.
    Only when the session has none (a bare local test session) is a local
    folder created and registered as the checkpoint dir; any other master
    raises, since driver and executors would write to different disks.
    """
    try:
        root = spark.conf.get(_CKPT_KEY, None)  # works for classic and Connect sessions
    except Exception:  # pragma: no cover - conf lookups differ by version
        root = None
    if not root:
        try:
            sc = spark.sparkContext  # classic sessions only
        except Exception:  # pragma: no cover - Spark Connect has no SparkContext
            sc = None
        if sc is not None:
            root = sc.getConf().get(_CKPT_KEY, None) or sc.getCheckpointDir()
            if not root and not (sc.master or "").startswith("local"):
                raise RuntimeError(f"set {_CKPT_KEY} to a folder every executor can reach")
            if not root:
                root = tempfile.mkdtemp(prefix="kiln-ckpt-")
                sc.setCheckpointDir(root)
    if not root:
        raise RuntimeError(f"set {_CKPT_KEY} to a folder every executor can reach")
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never-reused path under :func:`shared_dir`; the caller owns it (see :func:`drop_scratch`)."""
    return f"{shared_dir(spark)}/kiln/{label}-{uuid.uuid4().hex[:16]}"


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete a :func:`scratch_path` folder; whoever asked for the path owns it."""
    if not path.startswith(f"{shared_dir(spark)}/kiln/"):
        raise ValueError(f"{path} is no scratch path")
    paths.delete(spark, path)


def local_session(
    cpus: int | str = "*",
    shuffle_partitions: int = 8,
    app: str = "kiln",
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Local session for tests and the bench (never used by the library)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "8g")
    )
    for k, v in (extra_conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
