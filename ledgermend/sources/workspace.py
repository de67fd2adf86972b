"""Places for written tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def new_path(spark: SparkSession, name: str) -> str:
    """A path that nothing else uses, in the folder of `spark.checkpoint.dir`; in local mode without it, in a new one.

    A cluster without that setting is refused: its executors share no local folder.
    """
    where = spark.conf.get(_SETTING, None)
    if not where:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError(f"set {_SETTING} to a folder that all executors share")
        where = "file://" + tempfile.mkdtemp(prefix="ledgermend-")
        spark.conf.set(_SETTING, where)
    return f"{where.rstrip('/')}/ledgermend/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, path: str) -> DataFrame:
    """The rows as a Parquet table at path: computed once, and safe from lost executors."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
