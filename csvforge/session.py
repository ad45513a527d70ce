"""Session helpers: a local session for tests and the shared work folder."""
from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "csvforge") -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.execution.arrow.pyspark.enabled", "true")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.driver.memory", os.environ.get("CSVFORGE_DRIVER_MEMORY", "8g")))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    On a cluster it must be set (a distributed file system path).  Only when it is
    unset, as in local tests, a folder of our own is created and registered."""
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        conf_dir = spark.sparkContext.getCheckpointDir()
    if not conf_dir:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder for this cluster")
        conf_dir = tempfile.mkdtemp(prefix="csvforge-ckpt-")
        spark.sparkContext.setCheckpointDir(conf_dir)
        conf_dir = spark.sparkContext.getCheckpointDir() or conf_dir
    return conf_dir.rstrip("/")


def new_work_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared folder for one run's staged files."""
    return f"{shared_dir(spark)}/csvforge/{name}-{uuid.uuid4().hex[:12]}"


def default_parallelism(spark: SparkSession) -> int:
    """Cores Spark schedules by default (configuration fallback where the
    session has no SparkContext, as with Spark Connect)."""
    try:
        return int(spark.sparkContext.defaultParallelism)
    except Exception:
        return int(spark.conf.get("spark.default.parallelism", None)
                   or spark.conf.get("spark.sql.shuffle.partitions", "8"))
