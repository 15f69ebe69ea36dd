"""Session settings and the shared scratch location.

Every job here assumes UTC: log offsets are applied when parsing, hour windows
align to the epoch and ``hour()`` reads the session zone. ``ensure_utc`` pins it.

Files that a job writes between stages go under the cluster's shared
``spark.checkpoint.dir``. Only a local-mode session without that setting (tests,
the bench) gets a fresh directory under the system temp folder.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # call sites for error messages double the calls that building a wide plan takes
    "spark.sql.dataFrameQueryContext.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "loglens",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the jobs rely on."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    if _is_local(spark) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None):
        ship_package(spark)     # the workers can import this package from any working folder
    return spark


def ensure_utc(spark: SparkSession) -> None:
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Falls back to a fresh temp folder (and registers it as the checkpoint dir)
    only in local mode, where machine-local is the same as shared.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        root = sc.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not _is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...) on a cluster")
    root = tempfile.mkdtemp(prefix="loglens-ckpt-")
    sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path under the checkpoint root."""
    return f"{checkpoint_root(spark)}/loglens/{name}-{uuid.uuid4().hex[:12]}"


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> str | None:
    """Make ``loglens`` importable in Python workers (``mapInPandas`` solvers, archive
    reader) when it is not installed on them: zip the package once per application
    into the shared checkpoint folder and register it with ``addPyFile``.
    Returns the zip path when it shipped now, None when already shipped."""
    import io
    import os
    import zipfile

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return None
    pkg = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
        for folder, _, names in os.walk(pkg):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    target = f"{scratch_path(spark, 'pkg')}/loglens.zip"
    if "://" in target and not target.startswith("file:"):
        jvm = sc._jvm
        path = jvm.org.apache.hadoop.fs.Path(target)
        out = path.getFileSystem(sc._jsc.hadoopConfiguration()).create(path, True)
        out.write(bytearray(buf.getvalue()))
        out.close()
    else:
        local = target[5:] if target.startswith("file:") else target
        os.makedirs(os.path.dirname(local), exist_ok=True)
        with open(local, "wb") as fh:
            fh.write(buf.getvalue())
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)
    return target
