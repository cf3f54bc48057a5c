"""Small files and folders in shared storage, through the file system Spark itself uses.

Tables are read and written by Spark alone.  What is here serves the few
small records beside them (commits, finished steps) and the removal of
folders that are no longer needed.  A record is written under another name
and renamed, so readers see it whole or not at all.
"""

from __future__ import annotations

import json
import uuid
from typing import Any

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if there is no such folder."""
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file or a folder with all it holds, if it is there."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def remove_on_exit(spark: SparkSession, path: str) -> None:
    """Make the folder and have it removed when the driver's JVM ends."""
    fs, p = _fs(spark, path)
    fs.mkdirs(p)
    fs.deleteOnExit(p)


def put_record(spark: SparkSession, path: str, record: dict[str, Any]) -> None:
    """Write a small JSON record that must not be there yet."""
    fs, p = _fs(spark, path)
    if fs.exists(p):
        raise FileExistsError(path)
    _, part = _fs(spark, f"{p.getParent()}/.{p.getName()}-{uuid.uuid4().hex}")
    out = fs.create(part, True)
    try:
        out.write(bytearray(json.dumps(record).encode()))
    finally:
        out.close()
    if not fs.rename(part, p):
        fs.delete(part, False)
        raise FileExistsError(path)


def records(spark: SparkSession, folder: str) -> dict[str, dict[str, Any]]:
    """The records of a folder by name, in the order of their names.

    There is one for each load or step, whatever the size of the data.
    """
    out = {}
    for name in names(spark, folder):
        if not name.startswith("."):
            fs, p = _fs(spark, f"{folder}/{name}")
            source = fs.open(p)
            try:
                out[name] = json.loads(bytes(source.readAllBytes()).decode())
            finally:
                source.close()
    return out
