"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from pathlib import Path
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

ARROW_ROWS = 1000
"""Rows of a batch that goes to a Python worker, unless the session says otherwise: texts are long, and workers few."""

_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_PACKAGE = Path(__file__).resolve().parents[1]
_shipped: set[str] = set()
_places: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def ship(spark: SparkSession) -> None:
    """Sends this package to Python workers that would not find it, once per application.

    Workers find what lies in the driver's working folder (local mode) or on PYTHONPATH, and what was
    submitted with --py-files. Batches are cut to ARROW_ROWS where the session has Spark's default.
    """
    if spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, str(ARROW_ROWS))
    application = spark.sparkContext.applicationId
    found = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    if application in _shipped or any(folder and Path(folder).resolve() == _PACKAGE.parent for folder in found):
        return
    if _PACKAGE.is_dir():  # not from an archive that was itself submitted
        archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='ledgermend-')}/ledgermend", "zip", _PACKAGE.parent, _PACKAGE.name)
        spark.sparkContext.addPyFile(archive)
    _shipped.add(application)


def shared_dir(spark: SparkSession) -> str:
    """The folder of `spark.checkpoint.dir`; in local mode without it, a new one under /tmp.

    A cluster without that setting is refused: its executors share no local folder.
    """
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        where = "file://" + tempfile.mkdtemp(prefix="ledgermend-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/ledgermend/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder: computed once, and safe from lost executors."""
    ship(df.sparkSession)
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _places[out] = path
    return out


def forget(*tables: DataFrame) -> None:
    """Deletes tables made by `written` that no result needs any more; others are left alone."""
    for table_ in tables:
        path = _places.pop(table_, None)
        if path:
            spark = table_.sparkSession
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """The name, with underscores added until no column of df has it."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
