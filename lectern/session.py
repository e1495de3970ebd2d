"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_SCRATCH: dict[str, str] = {}


def local_session(app: str = "lectern", cores: str = "8", memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_runtime_settings(spark: SparkSession) -> None:
    """Set what the library relies on; all of it can change at run time."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    # Python workers hold a batch several times over; Spark's own bound is 64 MB.
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, from ``spark.checkpoint.dir``.

    Only a local master may go without the setting; it then gets a temporary
    folder, since there driver and executors are one process.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    app = spark.sparkContext.applicationId
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if app not in _LOCAL_SCRATCH:
        _LOCAL_SCRATCH[app] = tempfile.mkdtemp(prefix="lectern-")
    return _LOCAL_SCRATCH[app]


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder."""
    return f"{shared_dir(spark)}/lectern/{label}-{uuid.uuid4().hex}"


def hadoop_path(spark: SparkSession, path: str):
    """The Hadoop file system and path object of ``path``."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = hadoop_path(spark, path)
    return fs.exists(target)
