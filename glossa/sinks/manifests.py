"""Numbered manifests: what readers of a folder see, committed in one step.

Data folders are written first; a manifest ``_manifests/<number>.json`` then names them.
Readers take the newest manifest, so folders that none names (torn, unpublished or
abandoned ones) do not exist for them.  A writer takes the number after the one it read.
Manifests are written aside and renamed, so they are never seen in part; a store whose
rename does not replace files (HDFS) lets one of two writers through and tells the other.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

from ..session import file_system

FOLDER = "_manifests"


def newest(spark: SparkSession, root: str) -> tuple[int, dict | None]:
    """(number, body) of the newest manifest; (-1, None) without one."""
    fs, folder = file_system(spark, f"{root.rstrip('/')}/{FOLDER}")
    if not fs.exists(folder):
        return -1, None
    named = {s.getPath().getName(): s.getPath() for s in fs.listStatus(folder)}
    name = max((n for n in named if n.endswith(".json") and not n.startswith(".")), default=None)
    return (-1, None) if name is None else (int(name[:-5]), _body(fs, named[name]))


def read(spark: SparkSession, root: str, number: int) -> dict | None:
    """The body of one manifest, None if there is none of that number."""
    fs, path = file_system(spark, f"{root.rstrip('/')}/{FOLDER}/{number:012d}.json")
    return _body(fs, path) if fs.exists(path) else None


def _body(fs, path) -> dict:
    stream = fs.open(path)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode("utf-8"))
    finally:
        stream.close()


def commit(spark: SparkSession, root: str, number: int, body: dict) -> bool:
    """Make ``body`` manifest ``number``; False if another writer has taken it."""
    fs, folder = file_system(spark, f"{root.rstrip('/')}/{FOLDER}")
    child = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    aside, path = child(folder, f".{uuid.uuid4().hex}"), child(folder, f"{number:012d}.json")
    out = fs.create(aside, False)
    try:
        out.write(bytearray(json.dumps(body).encode("utf-8")))
    finally:
        out.close()
    if not fs.exists(path) and fs.rename(aside, path):
        return True
    fs.delete(aside, False)
    return False
