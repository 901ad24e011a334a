"""Session settings and the shared folder for data that cuts a plan's lineage."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def get_spark(app: str = "orgloom", cpus: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session with the settings the engine expects (UTC, AQE, Arrow)."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("ORGLOOM_DRIVER_MEMORY", "8g"))
        .config("spark.driver.host", "127.0.0.1")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can read, from ``spark.checkpoint.dir``.

    Only where the session names none and all of it runs on one machine, as in
    tests, a temporary one is made and set; on a cluster that is an error,
    since executors couldn't read one another's folders.
    """
    sc = spark.sparkContext
    at = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if at:
        if not sc._jsc.sc().getCheckpointDir().isDefined():
            sc.setCheckpointDir(at)
        return at
    known = sc._jsc.sc().getCheckpointDir()
    if known.isDefined():
        return known.get()
    if not sc.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that every executor can read")
    folder = tempfile.mkdtemp(prefix="orgloom-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    sc.setCheckpointDir("file://" + folder)
    return sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """The same rows, written once as a table in the shared folder, with a short lineage.

    Survives the loss of executors, unlike a cached or locally checkpointed
    frame, and later steps read only the columns they need. The tables of a session lie
    in one folder named after the application.
    """
    spark = df.sparkSession
    at = f"{shared_dir(spark).rstrip('/')}/{spark.sparkContext.applicationId}-tables/{uuid.uuid4().hex}"
    df.write.parquet(at)
    return spark.read.schema(df.schema).parquet(at)


def small(df: DataFrame, rows: int = 50_000, megabytes: int = 32) -> DataFrame:
    """A written table, marked for broadcast if it has at most ``rows`` rows and ``megabytes`` of data; otherwise joins shuffle it as usual.

    Give it tables from ``cut`` only: their rows and the sizes of their files are
    read without running what they came from.
    """
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return F.broadcast(df) if int(str(size)) <= megabytes << 20 and df.count() <= rows else df


def drop_tables(spark: SparkSession) -> None:
    """Deletes the tables that ``cut`` has written in this application; frames built on them can't be read any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark).rstrip('/')}/{spark.sparkContext.applicationId}-tables")
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def cut_in_order(df: DataFrame) -> DataFrame:
    """Like ``cut``, but keeps the partitions and the order of rows in them."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
