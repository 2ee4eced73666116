"""A table kept as partitions of one column: a batch replaces the partitions that occur in its delivery.

Every attempt at a batch writes a folder of its own, with a folder per partition in it, and becomes visible by one write of small
commit rows, one for each partition:

    <base>/parts/attempt=<a>/_part=<value>/
    <base>/commits/

Of the attempts of a batch the latest counts, and of the batches that brought a partition the last one. So a failed attempt
changes nothing, a repeat takes back partitions that only the attempt before had brought, and other partitions are left alone.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from histora.plans.storage import BatchHasSuccessors, ProtectedTable
from histora.spec import TableSpec, ref
from histora.workspace import exists, remove, subfolders

_COMMIT = "seq long, batch_id int, attempt string, part string, retired boolean"


class PartitionedTable:
    """One table of partitions. retain: how many batches stay readable as of their commit."""

    def __init__(self, spark: SparkSession, spec: TableSpec, base: str, partition_col: str, schema: T.StructType | None = None, retain: int = 2):
        if retain < 1:
            raise ValueError("the last batch has to stay")
        self.spark, self.spec, self.base, self.partition_col, self.retain = spark, spec, base.rstrip("/"), partition_col, retain
        self.schema = schema or spec.staging_schema()

    def _batches(self) -> dict[int, tuple[str, set[str]]]:
        """batch -> its attempt that counts and the partitions it brought. One row per batch and partition is fetched."""
        path = f"{self.base}/commits"
        rows = self.spark.read.schema(_COMMIT).parquet(path).collect() if exists(self.spark, path) else []
        found: dict[int, tuple[str, set[str]]] = {}
        for r in sorted(rows, key=lambda r: r.seq):
            if r.retired:
                found.pop(r.batch_id, None)
                continue
            if found.get(r.batch_id, ("",))[0] != r.attempt:
                found[r.batch_id] = (r.attempt, set())
            if r.part is not None:
                found[r.batch_id][1].add(r.part)
        return found

    def _folders(self, batches: dict[int, tuple[str, set[str]]], batch: int | None = None) -> dict[str, str]:
        """partition -> the folder that holds it as of a batch."""
        state = {}
        for b in sorted(batches):
            if batch is None or b <= batch:
                attempt, parts = batches[b]
                state |= {part: f"{self.base}/parts/attempt={attempt}/{part}" for part in parts}
        return state

    def read(self, batch: int | None = None) -> DataFrame:
        """The rows as of a batch, by default the last one."""
        folders = sorted(self._folders(self._batches(), batch).values())
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*folders)

    def switch(self, stg: DataFrame, batch_id: int) -> set[str]:
        """Put the staged rows in the place of the partitions they belong to; the folder names of these partitions."""
        if self.spec.protect:
            raise ProtectedTable(self.spec.name)
        later = sorted(b for b in self._batches() if b > batch_id)
        if later:
            raise BatchHasSuccessors(f"{self.spec.name}: batches {later} come after {batch_id}; rewind({batch_id}) takes them back")
        attempt = uuid.uuid4().hex
        folder = f"{self.base}/parts/attempt={attempt}"
        rows = stg.select(*[ref(f.name).cast(f.dataType) for f in self.schema], ref(self.partition_col).alias("_part"))
        # rebalancing brings a partition's rows together and splits the ones that outgrow a task
        rows.hint("rebalance", "_part").write.partitionBy("_part").parquet(folder)
        parts = set(subfolders(self.spark, folder))
        self._commit(batch_id, attempt, parts)
        self._clear()
        return parts

    def rewind(self, batch_id: int) -> list[int]:
        """Take back all later batches."""
        batches = self._batches()
        kept, later = sorted(batches)[-self.retain :], sorted(b for b in batches if b > batch_id)
        if batch_id not in kept:
            raise ValueError(f"{self.spec.name}: batch {batch_id} is not among the last {self.retain}")
        for b in later:
            self._commit(b, batches[b][0], set(), retired=True)
        return later

    def _commit(self, batch_id: int, attempt: str, parts: set[str], retired: bool = False) -> None:
        path = f"{self.base}/commits"
        seq = 0
        if exists(self.spark, path):
            seq = self.spark.read.schema(_COMMIT).parquet(path).agg(F.max("seq")).first()[0] or 0
        # a batch without rows is a batch as well
        rows = [(seq + 1, batch_id, attempt, part, retired) for part in [None, *sorted(parts)]]
        self.spark.createDataFrame(rows, _COMMIT).coalesce(1).write.mode("append").parquet(path)

    def _clear(self) -> None:
        """Remove folders that none of the last batches needs."""
        batches = self._batches()
        needed = {f for b in sorted(batches)[-self.retain :] for f in self._folders(batches, b).values()}
        for attempt in subfolders(self.spark, f"{self.base}/parts"):
            for part in subfolders(self.spark, f"{self.base}/parts/{attempt}"):
                if f"{self.base}/parts/{attempt}/{part}" not in needed:
                    remove(self.spark, f"{self.base}/parts/{attempt}/{part}")
