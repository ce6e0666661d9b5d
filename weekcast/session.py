"""SparkSession helpers for tests and the bench.

On a cluster the session comes from the caller; these helpers only fill in
settings that are missing, so cluster-wide choices (checkpoint dir, shuffle
partitions, broadcast threshold) always win.
"""

from __future__ import annotations

import os
import shutil
import tempfile
import threading

from pyspark.sql import SparkSession


def local_session(cores: int | None = None, shuffle_partitions: int | None = None,
                  app: str = "weekcast") -> SparkSession:
    cores = cores or int(os.environ.get("BENCH_CPUS", "8"))
    shuffle_partitions = shuffle_partitions or cores
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.scheduler.mode", "FAIR")
        .config("spark.driver.memory", os.environ.get("WEEKCAST_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder, which driver and executors share.

    ``spark.checkpoint.dir`` names it on a cluster. Only a local master, where
    everything runs on one machine, gets a temporary folder when it names none.
    """
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            if not sc.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
            configured = tempfile.mkdtemp(prefix="weekcast-ckpt-")
        sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


_shipped: set[str] = set()
_shipping = threading.Lock()


def ship_code(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so tasks can import its functions.

    Threads may call it at the same time: one sends, the others wait. The archive
    has a name of its own, as Spark refuses a second file of the same name.
    """
    app = spark.sparkContext.applicationId
    with _shipping:
        if app not in _shipped:
            package = os.path.dirname(os.path.abspath(__file__))
            folder = tempfile.mkdtemp(prefix="weekcast-package-")
            target = os.path.join(folder, os.path.basename(folder))
            spark.sparkContext.addPyFile(shutil.make_archive(target, "zip", os.path.dirname(package), os.path.basename(package)))
            _shipped.add(app)
