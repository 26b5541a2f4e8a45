"""Session helpers: defaults for local runs and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

LOCAL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Settings for large clusters (100 TB inputs). Applied only where the session
# leaves them unset: shuffle partitions start high and AQE coalesces them to
# the advisory size; skewed join partitions are split; scan splits are large.
CLUSTER_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.shuffle.partitions": "4000",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
}

# Settings for streaming jobs. A stateful query keeps the number of shuffle
# partitions of its first start as its number of state partitions, and AQE
# does not coalesce them, so this is set apart; state lives in RocksDB.
STREAM_DEFAULTS = CLUSTER_DEFAULTS | {
    "spark.sql.shuffle.partitions": "200",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def apply_defaults(spark: SparkSession, defaults: dict[str, str] = CLUSTER_DEFAULTS) -> dict[str, str]:
    """Set each of ``defaults`` that the session has not set explicitly; return what was set."""
    already = spark.conf.getAll  # explicitly set keys only (startup and runtime)
    applied = {}
    for key, value in defaults.items():
        if key not in already:
            spark.conf.set(key, value)
            applied[key] = value
    return applied


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "squall") -> SparkSession:
    """A local session with the settings the tests and the bench use."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in LOCAL_DEFAULTS.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", "8g")
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set (shared storage every executor can reach).
    Only a local-mode session without it gets a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect sessions have no SparkContext
        sc = None
    if not root and sc is not None:
        root = sc.getCheckpointDir()
    if not root:
        local = sc is not None and sc.master.startswith("local")
        if not local:
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        root = tempfile.mkdtemp(prefix="squall-ckpt-")
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint root, unique per call."""
    return f"{checkpoint_root(spark)}/squall/{name}-{new_name()}"


def new_name() -> str:
    return uuid.uuid4().hex[:12]


def _hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop(spark, path)
    return fs.exists(p)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder; none if there is no such folder."""
    fs, p = _hadoop(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _hadoop(spark, path)
    fs.delete(p, True)


def move_path(spark: SparkSession, path: str, to: str) -> None:
    """Rename a file or folder; raises where that is not possible."""
    fs, p = _hadoop(spark, path)
    if not fs.rename(p, spark._jvm.org.apache.hadoop.fs.Path(to)):
        raise RuntimeError(f"cannot move {path} to {to}")


def make_folder(spark: SparkSession, path: str) -> None:
    """Create a folder; raises where that is not possible."""
    fs, p = _hadoop(spark, path)
    if not fs.mkdirs(p):
        raise RuntimeError(f"cannot create {path}")
