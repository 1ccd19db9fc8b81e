"""Tables written between two jobs, in the folder all executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`; a local session without one gets a temporary folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _local:
        _local[app] = tempfile.mkdtemp(prefix="chatmill-")
        atexit.register(shutil.rmtree, _local[app], ignore_errors=True)
    return _local[app]


def new_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/chatmill/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def spread(df: DataFrame) -> DataFrame:
    """The rows dealt to all tasks, for work on each row that is long for its size: a small file is read by one task, however many rows it has."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write a table and read it back.

    Used where two passes must see the same rows in the same places. The files outlive a lost executor,
    and later readers get column pruning.
    """
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
