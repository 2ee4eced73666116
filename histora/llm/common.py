"""Small helpers shared by the operators."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from histora.workspace import fresh_path, materialise, remove

_SHIPPED: set[str] = set()


#: Rows of whole texts that Spark hands to Python at a time, where the session has Spark's default
BATCH_ROWS = "arrow.maxRecordsPerBatch", "10000", "2000"


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application (as `--py-files` would), and keep batches of texts small.

    With Spark's default of 10,000 rows a batch, a worker, its copies and the JVM's buffers hold several times 10,000 texts.
    """
    name, usual, rows = BATCH_ROWS
    if spark.conf.get(f"spark.sql.execution.{name}") == usual:
        spark.conf.set(f"spark.sql.execution.{name}", rows)
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="ship-"), "histora.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(package)))
    spark.sparkContext.addPyFile(target)
    _SHIPPED.add(app)


class Scratch:
    """Tables that one operator writes to the shared folder and removes once it has read them for the last time.

    What a write has shuffled is let go with it: nothing reads it again, as later steps read the table.
    """

    CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._paths: dict[str, str] = {}

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """The rows, written under a name and read back; a table that had the name is removed then."""
        path, usual = fresh_path(self.spark, name), self.spark.conf.get(self.CLEANUP, "false")
        self.spark.conf.set(self.CLEANUP, "true")
        try:
            df.write.parquet(path)
        finally:
            self.spark.conf.set(self.CLEANUP, usual)
        self.drop(name)
        self._paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            if name in self._paths:
                remove(self.spark, self._paths.pop(name))


def saved(df: DataFrame, name: str) -> DataFrame:
    """The rows, written to the shared folder and read back: later steps survive lost executors."""
    return materialise(df.sparkSession, name, df)


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the rows don't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def fold(column: str, modulus: int) -> Column:
    """crc32 of an id as text, modulo `modulus`; null for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def ascii_words(text: str | None) -> list[bytes]:
    """Words of the lower-cased text (A-Z only), cut at ASCII white space, as UTF-8 bytes.

    Python's bytes.lower() changes A-Z only and bytes.split() cuts at 0x20 and 0x09 to 0x0D, which is the rule.
    """
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
