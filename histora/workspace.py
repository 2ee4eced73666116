"""The shared folder for data that a job writes and reads again."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_ROOT: dict[str, str] = {}
_MADE: list[str] = []


def shared_root(spark: SparkSession) -> str:
    """Folder named by spark.checkpoint.dir; a folder of our own only on a local master without it."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    if "root" not in _LOCAL_ROOT:
        _LOCAL_ROOT["root"] = tempfile.mkdtemp(prefix="histora-")
        atexit.register(shutil.rmtree, _LOCAL_ROOT["root"], ignore_errors=True)
    return _LOCAL_ROOT["root"]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path that no other run uses."""
    _MADE.append(f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}")
    return _MADE[-1]


def materialise(spark: SparkSession, name: str, df, partition_by: list[str] | None = None):
    """Write a DataFrame to the shared folder and read it back: a lineage cut that outlives executors."""
    path = fresh_path(spark, name)
    df.write.parquet(path, partitionBy=partition_by)
    return spark.read.schema(df.schema).parquet(path)


def _path(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    fs, place = _path(spark, path)
    return fs.exists(place)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below a path; none if it does not exist."""
    fs, place = _path(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(place) if s.isDirectory()] if fs.exists(place) else []


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, wherever Spark keeps it."""
    fs, place = _path(spark, path)
    fs.delete(place, True)


def clear_scratch(spark: SparkSession) -> int:
    """Delete all paths that this process was given so far; their number. For the end of a job: results still to be read from them go too."""
    paths = [_MADE.pop() for _ in range(len(_MADE))]
    for path in paths:
        remove(spark, path)
    return len(paths)
