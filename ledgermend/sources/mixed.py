"""Tables whose files have different types: old exports as text, new ones as numbers.

Spark reads a Parquet table with one schema. Here the footers of all files are read in tasks, files with equal types
of the contract's columns make a group, each group is read with its own schema and conformed, and the groups are united.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermend.sources.contracts import CONTRACTS, conform

FILES_A_TASK = 200


def _known_names(table: str) -> set[str]:
    return {name.lower() for field in CONTRACTS[table] for name in (field.name, field.header) if name}


def schema_groups(spark: SparkSession, folder: str, table: str) -> list[list[str]]:
    """The files of a Parquet folder, in groups with equal names and types of the contract's columns.

    One row for each group comes to the driver, with the names of its files, which Spark lists there anyway.
    """
    names = _known_names(table)
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(folder)
    files = listed.select("path")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds = []
            for path in batch["path"].to_pylist():
                system, place = fs.FileSystem.from_uri(path)
                with system.open_input_file(place) as file:
                    schema = pq.read_schema(file)
                kinds.append(";".join(sorted(f"{f.name}:{f.type}" for f in schema if f.name.lower() in names)))
            yield pa.RecordBatch.from_arrays([batch["path"], pa.array(kinds, pa.string())], ["path", "kinds"])

    tasks = max(1, -(-files.count() // FILES_A_TASK))
    found = files.repartition(tasks).mapInArrow(read, "path string, kinds string")
    groups = found.groupBy("kinds").agg(F.sort_array(F.collect_list("path")).alias("paths")).orderBy("kinds").collect()
    return [row.paths for row in groups]


def read_mixed(spark: SparkSession, folder: str, table: str, strict: bool = True) -> DataFrame:
    """The rows of all files under ``folder`` in the form of ``table``'s contract.

    Partition columns of the folder are read as such. Each group must have the contract's required columns.
    """
    groups = schema_groups(spark, folder, table)
    if not groups:
        raise ValueError(f"{folder}: no Parquet files")
    frames = [conform(spark.read.option("basePath", folder).parquet(*paths), table, strict) for paths in groups]
    return reduce(lambda one, other: one.unionByName(other, allowMissingColumns=True), frames)
