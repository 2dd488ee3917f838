"""Session helpers: local sessions for tests, and staging tables that cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
_OWNED: dict[str, list[str]] = {}
_LOCAL: dict[str, str] = {}


def local_session(cores: str = "8", name: str = "tallyrill", **conf: str) -> SparkSession:
    """Session for tests and the bench; on a cluster the session is given."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def staging_root(spark: SparkSession) -> str:
    """Shared folder for staged tables, as named by the session.

    A folder of this machine is made only for a local master, where no folder is named.
    """
    root = spark.conf.get(CHECKPOINT_KEY, None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
    # the setting can't be changed in a running session
    if spark.sparkContext.applicationId not in _LOCAL:
        _LOCAL[spark.sparkContext.applicationId] = tempfile.mkdtemp(prefix="tallyrill-")
    return _LOCAL[spark.sparkContext.applicationId]


def owned_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, which ``release`` will remove."""
    path = f"{staging_root(spark)}/{name}-{uuid.uuid4().hex}"
    _OWNED.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    The result no longer depends on the jobs that made it, so a lost executor costs one
    file scan, and every branch that reads it sees the same rows in the same slices.
    """
    spark = df.sparkSession
    path = owned_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> int:
    """Remove what this application has staged; results that still read it must have been used."""
    paths = _OWNED.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    return len(paths)
