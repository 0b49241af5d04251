"""Tables in the folder that all executors see."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where that is unset, a folder of our own in local mode, and an error on a cluster.

    On a cluster a folder of one machine would be written in parts by each executor and read in parts by others.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        found = _own.setdefault(app, f"file://{tempfile.mkdtemp(prefix='foliant-')}")
    return found


def own_dir(spark: SparkSession) -> str:
    """The application's own part of the shared folder, which other applications may use too."""
    return f"{shared_dir(spark)}/foliant/{spark.sparkContext.applicationId}"


def written(df: DataFrame, what: str) -> DataFrame:
    """Cut lineage: write df as a table in the shared folder, once, and read it back."""
    spark = df.sparkSession
    path = f"{own_dir(spark)}/{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_written(spark: SparkSession) -> None:
    """Delete the tables that written() left in this application, once nothing reads them; any file system that Spark knows."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(own_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
