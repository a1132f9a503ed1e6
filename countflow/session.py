"""Settings read from the running session; nothing here starts or reconfigures a cluster."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only a local master without that setting gets a temporary folder; a cluster
    without it is an error, because its machines don't see each other's disks.
    """
    sc = spark.sparkContext
    at = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if at is None and (set_dir := sc._jsc.sc().getCheckpointDir()).isDefined():
        at = set_dir.get()
    if at is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        at = "file://" + tempfile.mkdtemp(prefix="countflow-")
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(at)
    return at.rstrip("/")


def checkpoint(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder as Parquet and read back, with its lineage cut. Unlike Spark's own checkpoint the result has the size of its files, not the
    plan's estimate, which joins multiply from round to round; so small tables are broadcast by the planner and large ones aren't."""
    spark = df.sparkSession
    at = f"{shared_dir(spark)}/tables/{uuid.uuid4().hex}"
    df.write.parquet(at)
    return spark.read.schema(df.schema).parquet(at)
