"""Row positions and surrogate keys without a single-task sort; surrogate keys that are hashes.

Rows are written once to the shared folder. A row's place is then (file, row index in the file), which
stays the same however often and wherever the files are read, also when executors are lost between the
reads. The only aggregate is one row count per file.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from histora.spec import TableSpec, ref
from histora.workspace import fresh_path, materialise

_TIE = "_tie"


def write_in_order(df: DataFrame, order_by: list[str], path: str) -> None:
    """Write sorted by the given columns across files: file n holds rows before those of file n + 1.

    Rows that agree in all order columns can still be spread over several tasks.
    """
    keys = [ref(c) for c in order_by]
    ranged = df.withColumn(_TIE, F.monotonically_increasing_id()).repartitionByRange(*keys, F.col(_TIE))
    ranged.sortWithinPartitions(*keys, _TIE).drop(_TIE).write.parquet(path)


def with_positions(files: DataFrame, name: str = "position", start: int = 0) -> DataFrame:
    """Number the rows of written parquet files densely from start + 1, in file order.

    files must be a plain read of a parquet folder.
    """
    place = files.select(
        "*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row")
    )
    per_file = files.select(F.col("_metadata.file_name").alias("_file")).groupBy("_file").count()
    # One row per written file: one task sums them up, which holds for some millions of files
    before = F.sum("count").over(Window.orderBy(F.length("_file"), "_file").rowsBetween(Window.unboundedPreceding, -1))
    offsets = per_file.select("_file", F.coalesce(before, F.lit(0)).alias("_before"))
    # broadcast: joined by exchange, all rows would move, and into no more tasks than there are files
    return (
        place.join(F.broadcast(offsets), "_file")
        .withColumn(name, F.lit(start) + F.col("_before") + F.col("_row") + 1)
        .drop("_file", "_row", "_before")
    )


def assign_sids(rows: DataFrame, spec: TableSpec, start: int = 0, order_by: list[str] | None = None) -> DataFrame:
    """Give rows without a surrogate key the next free ones, dense and increasing from start + 1.

    Without order_by rows are numbered as they are written, which needs no shuffle of the rows.
    """
    spark = rows.sparkSession
    path = fresh_path(spark, f"{spec.name}-sid")
    bare = rows.drop(spec.sid)
    if order_by:
        write_in_order(bare, order_by, path)
    else:
        bare.write.parquet(path)
    numbered = with_positions(spark.read.schema(bare.schema).parquet(path), spec.sid, start)
    return numbered.select(ref(spec.sid), *[ref(c) for c in bare.columns])


#: Rows that look for a value are few if the values given out are more than this many times their number
FEW = 8


class KeySpaceFull(ValueError):
    """There are more rows than values for their surrogate keys."""


def assign_hash_sids(
    rows: DataFrame,
    spec: TableSpec,
    on: list[str],
    taken: DataFrame | None = None,
    space: int = (1 << 63) - 1,
    seed: int = 0,
) -> DataFrame:
    """Give rows without a surrogate key the hash of the columns `on`, a value from 0 to space - 1 that no other row has.

    on: columns that identify a row, such as the business key and the start of a version. taken: the keys given out so far. A row
    whose value is taken, or wanted by a row with smaller `on` as well, moves on to the next value, in rounds until all rows have
    one. The outcome depends on the rows and `taken` only, not on tasks or partitions. Each round exchanges the rows that are
    left, by value; with 63 bits that is one round and, at 10 billion rows, a few rows of a second one.
    """
    spark, sid = rows.sparkSession, spec.sid
    bare = materialise(spark, f"{spec.name}-hash", rows.drop(sid))
    keys = [ref(c) for c in on]
    nulls = [k.isNull() for k in keys]
    twice = bare.groupBy(*keys).count().filter("count > 1")
    if not twice.isEmpty():
        raise ValueError(f"{spec.name}: rows to be numbered agree in {', '.join(on)}")
    held, n_held, n_left = None, 0, bare.count()
    if taken is not None:
        # written once: every round reads them, and what they come from may be a join
        held = materialise(spark, f"{spec.name}-taken", taken.select(ref(taken.columns[0]).alias("_value")))
        n_held = held.count()
    if n_left + n_held > space:
        raise KeySpaceFull(f"{spec.name}: {n_left + n_held} rows for {space} values")
    start = F.pmod(F.xxhash64(F.lit(seed), *keys, *nulls), F.lit(space))
    left = bare.select(*keys, start.alias("_value"))
    none = [F.lit(None).cast(bare.schema[c].dataType).alias(c) for c in on]
    order = Window.partitionBy("_value").orderBy("_free", *keys)
    placed = []
    while True:
        wanted = left.withColumn("_free", F.lit(True))
        if held is not None:
            met = held.filter("_value IS NOT NULL")
            if n_left * FEW < n_held:
                # where few rows are left, this comes down to a scan of the values given out
                met = met.join(left.select("_value").distinct(), "_value", "left_semi")
            # one exchange and one sort: a value given out lies before the rows that want it
            wanted = wanted.unionByName(met.select(*none, "_value", F.lit(False).alias("_free")))
        nth = wanted.withColumn("_nth", F.row_number().over(order)).filter("_free").drop("_free")
        tried = materialise(spark, f"{spec.name}-hash", nth)
        got = tried.filter("_nth = 1").select(*keys, "_value")
        placed.append(got)
        later = tried.filter("_nth > 1")
        n_held, n_left = n_held + n_left, later.count()
        if not n_left:
            break
        left = later.select(*keys, ((F.col("_value") + 1) % F.lit(space)).alias("_value"))
        held = got.select("_value") if held is None else held.unionByName(got.select("_value"))
    found = reduce(DataFrame.unionByName, placed)
    found = found.select(*[k.alias(f"_on{i}") for i, k in enumerate(keys)], F.col("_value").cast("bigint").alias(sid))
    same = [k.eqNullSafe(F.col(f"_on{i}")) for i, k in enumerate(keys)]
    return bare.join(found, same).select(ref(sid), *[ref(c) for c in bare.columns])


def highest_sid(dwh: DataFrame, spec: TableSpec) -> int:
    """The last surrogate key given out; 0 for an empty table."""
    return dwh.agg(F.max(ref(spec.sid))).first()[0] or 0
