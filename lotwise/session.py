"""Session defaults and the shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # Building wide rule expressions is several times faster without a stack trace per call.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and the bench; a cluster brings its own."""
    b = SparkSession.builder.master(f"local[{cores}]").appName("lotwise")
    for k, v in DEFAULTS.items():
        b = b.config(k, v)
    spark = (b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
             .config("spark.driver.memory", memory).getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors reach.

    Named by the cluster in ``spark.checkpoint.dir``.  Only a local master may fall back
    to a fresh temporary folder; anywhere else an unset folder is an error, because
    state kept on one machine is lost with it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder")
    folder = tempfile.mkdtemp(prefix="lotwise-")
    spark.sparkContext.setCheckpointDir(folder)
    return shared_folder(spark)


def landed(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    For an expensive result that feeds several branches: it is computed once, its lineage
    ends here, lost executors only re-read files, and every branch still reads just the
    columns it needs.  The shuffle files it took are removed, not left until the driver
    happens to collect its garbage.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before) if before is not None else spark.conf.unset(CLEANUP)
    return spark.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame, key: str) -> DataFrame:
    """Rows spread evenly by ``key`` over as many tasks as a shuffle has, whatever files they came from.

    For costly work on rows of few bytes, which the sizes of files would put into few tasks.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Rows numbered from 1 in a total order, without bringing them into one task.

    A range sort puts them in order over the tasks and is landed, so that a task's rows stay the
    same; each task numbers its own after the total of the tasks before it.
    """
    ordered = df.repartitionByRange(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *order)
    parts = landed(ordered.withColumn("_part", F.spark_partition_id()), "ordered")
    before = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).withColumn(
        "_before", F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)))  # a row per task
    own = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return parts.withColumn("_own", own).join(F.broadcast(before), "_part").withColumn(
        name, F.coalesce("_before", F.lit(0)) + F.col("_own")).drop("_part", "_n", "_before", "_own")
