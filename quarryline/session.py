"""Session settings for local work, and the shared folder for written intermediates."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the bench; a cluster passes its own session to every function."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("quarryline")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    A temporary folder stands in only where the setting is absent (tests, local runs).
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    return _local_stand_in()


@functools.cache
def _local_stand_in() -> str:
    return tempfile.mkdtemp(prefix="quarryline-")


def new_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other job uses."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def checkpoint_dir(spark: SparkSession) -> None:
    """Let RDD checkpoints go to the shared folder, unless the session names a place for them."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(f"{shared_dir(spark)}/rounds")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The table as written to the shared folder: several passes then read it, not what it came from."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a written folder that nothing reads any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
