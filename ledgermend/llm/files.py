"""Files that tasks write under temporary names, and the manifest that makes them one result.

Paths are URIs of any file system that pyarrow opens. What a task writes depends on its rows alone, so a task that
runs again replaces a file by an equal one. Only files named in the manifest, written last, belong to the result.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

MANIFEST = "manifest.json"


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


@contextmanager
def committed(uri: str) -> Iterator:
    """A stream to a temporary name beside uri, which takes its place if the block ends well."""
    system, path = filesystem(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    temporary = f"{path}.{uuid.uuid4().hex}.tmp"
    try:
        with system.open_output_stream(temporary) as out:
            yield out
    except BaseException:
        if system.get_file_info(temporary).type != fs.FileType.NotFound:
            system.delete_file(temporary)
        raise
    system.move(temporary, path)


def write_manifest(uri: str, files: list[dict]) -> None:
    """The list of files, one JSON object a line."""
    with committed(f"{uri}/{MANIFEST}") as out:
        out.write("".join(json.dumps(f, sort_keys=True) + "\n" for f in files).encode())


def read_manifest(spark: SparkSession, uri: str, schema: str) -> DataFrame:
    """The files of a finished result, each in a partition of its own."""
    files = spark.read.schema(schema).json(f"{uri}/{MANIFEST}")
    return files.repartition(max(1, files.count()))
