"""Session helpers. Library code never picks a master; only tests and the bench do."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

#: The folder that holds this package.
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def local_session(cores: int | str = "*", app: str = "starloom", **conf: str) -> SparkSession:
    """A local session for tests and the bench: adaptive execution on, UTC, no web page."""
    settings = {
        "spark.ui.enabled": "false",
        "spark.driver.host": "127.0.0.1",
        "spark.driver.bindAddress": "127.0.0.1",
        "spark.driver.memory": "8g",
        "spark.sql.session.timeZone": "UTC",
        # Call sites of columns in error messages cost several calls to the JVM per column.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path for intermediate tables, in the shared folder named by ``spark.checkpoint.dir``
    or else in the session's checkpoint folder. Every executor must see the files."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession, *paths: str) -> None:
    """Delete scratch tables that nothing reads any more."""
    for path in paths:
        named = spark._jvm.org.apache.hadoop.fs.Path(path)
        named.getFileSystem(spark._jsc.hadoopConfiguration()).delete(named, True)


def prepared(spark: SparkSession) -> SparkSession:
    """For tests, the bench and the entry points: the session, able to run the library's jobs.

    A local session that names no checkpoint folder gets one of its own; sessions on a cluster must
    name theirs. Python workers look for this package where the driver found it, besides what
    ``--py-files`` ships.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named and spark.conf.get("spark.master", "").startswith("local"):
        spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="starloom-"))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([*filter(None, paths), ROOT])
    return spark
