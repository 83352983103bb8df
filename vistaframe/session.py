"""Session construction and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of the library expects. AQE re-plans joins and
# partition counts from runtime statistics; the UTC zone keeps timestamp
# arithmetic identical across executors and to the SQL oracle.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "vistaframe", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    On a cluster ``master`` stays ``None`` so the launcher decides; tests
    pass ``local[N]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster names a shared folder there; only in local mode, when nothing
    is set (tests, a laptop), do we create a private one.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="vistaframe-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A path below the shared checkpoint folder for written intermediates."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    leaf = "/".join(parts)
    if unique:
        leaf = f"{leaf}-{uuid.uuid4().hex[:12]}"
    return f"{base}/vistaframe/{leaf}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for APIs that need a plain local path."""
    return path[5:] if path.startswith("file:") else path


def files_fingerprint(spark: SparkSession, paths: list[str]) -> str:
    """Lengths and modification times of the files below ``paths``: changes when the data does."""
    jvm = spark.sparkContext._jvm
    seen = []
    for path in paths:
        root = jvm.org.apache.hadoop.fs.Path(path)
        files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(root, True)
        while files.hasNext():
            f = files.next()
            seen.append(f"{f.getPath().getName()}:{f.getLen()}:{f.getModificationTime()}")
    return ";".join(sorted(seen))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop filesystem of the path (works for
    local, HDFS and object stores alike)."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(jpath))


__all__ = ["build_session", "ensure_checkpoint_dir", "scratch_path", "path_exists", "files_fingerprint", "local_path",
           "DEFAULT_CONF"]
