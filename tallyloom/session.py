"""Session settings and the limits that pick between plan shapes."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import SparkSession

# Rows of one group that a single task may hold. Larger groups take the sliced plan.
GROUP_ROWS = ("tallyloom.groupRows", 500_000)
# Rows of a wide aggregate or a sort that one task takes.
TASK_ROWS = ("tallyloom.taskRows", 500_000)
# Hot keys that may be listed on the driver. A longer list stays a table.
KEY_LIST = ("tallyloom.keyList", 10_000)
# Bytes of feature rows, with all features written out, that fits of the same time may keep.
DENSE_BYTES = ("tallyloom.denseBytes", 4_000_000_000)


def limit(spark: SparkSession, setting: tuple[str, int]) -> int:
    """Value of one of the limits above, as set on the session."""
    name, default = setting
    return int(spark.conf.get(name, str(default)))


def build_session(app: str, cores: int | str = "*", memory: str = "8g") -> SparkSession:
    """Local session for tests and benchmarks, with a folder of its own for staged tables; clusters bring their own."""
    folder = tempfile.mkdtemp(prefix="tallyloom-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    width = os.cpu_count() if cores == "*" else int(cores)
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(width))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.checkpoint.dir", folder)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: spark.checkpoint.dir, or else one in the warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return (named or spark.conf.get("spark.sql.warehouse.dir") + "/_staged").rstrip("/")
