"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, memory: str = "8g", **conf: str) -> SparkSession:
    """A session for tests and benchmarks on one machine. On a cluster, bring your own.

    Projections over many keys generate methods of more than 8,000 bytecodes, which the JVM interprets for ever unless
    it is told to compile them; on a cluster the same option belongs into ``spark.executor.extraJavaOptions``.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tablebridge")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.driver.extraJavaOptions", "-XX:-DontCompileHugeMethods")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def is_local(spark: SparkSession) -> bool:
    """True when driver and executors share one JVM."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder named by ``spark.checkpoint.dir``.

    Where the setting is absent a temporary folder is used, but only in local
    mode: a folder of one machine is of no use to executors on others.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None)
    if not base:
        if not is_local(spark):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tablebridge-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, on whatever file system its scheme names."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(conf).exists(target)
