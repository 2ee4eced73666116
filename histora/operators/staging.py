"""From a source delivery to one staged snapshot. Row-wise projections: nothing here shuffles, except
delete detection, which exchanges the current members once on the business key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from histora.functions.defaults import default_for, default_value
from histora.functions.scalars import date_key, or_default, time_key
from histora.sources.delivery import conform
from histora.spec import (
    BATCH_INSERT,
    CURRENT_FLAG,
    DELETE_FLAG,
    EARLY_FLAG,
    UNKNOWN_KEY,
    TableSpec,
    ref,
)


def comparable(name: str, alias: str | None, spec: TableSpec, collation: str | None) -> Column:
    """A column for comparison; collation may name one, or be 'declared' for those of the contract. Whatever compares keys (merges,
    anti joins, checks, grouping) compares them in this form."""
    value = ref(name, alias)
    column = next((c for c in spec.columns if c.name == name), None)
    if collation and column is not None and column.length is not None:
        wanted = column.collation if collation == "declared" else collation
        if wanted:
            return F.collate(value, wanted)
    return value


def is_current_version() -> Column:
    return F.col(CURRENT_FLAG) == 1


def is_current_member() -> Column:
    """Current versions of members that are neither deleted nor waiting for their first delivery."""
    return is_current_version() & (F.col(DELETE_FLAG) == 0) & (F.col(EARLY_FLAG) == 0)


def cleanse(df: DataFrame, spec: TableSpec, split: bool = False) -> DataFrame:
    """Replace nulls by the column defaults; with split, add the typed date and time part per column.

    The parts are taken from the value as delivered, so a null shows the date and time of its default.
    """
    out = []
    for c in spec.columns:
        raw = ref(c.name)
        out.append(or_default(raw, default_for(c), c.spark_type).alias(c.name))
        if split and c.date_key:
            default = F.lit(default_value(c))
            out.append(F.coalesce(raw.cast("date"), default.cast("timestamp_ntz").cast("date")).alias(c.date_key))
            if c.time_key:
                out.append(F.coalesce(time_key(raw), time_key(default)).alias(c.time_key))
    return df.select(*out)


def add_date_time_keys(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Contract columns with the text date and time keys of their values, in staging order."""
    out = []
    for c in spec.columns:
        out.append(ref(c.name))
        if c.date_key:
            out.append(date_key(ref(c.name)).alias(c.date_key))
        if c.time_key:
            out.append(time_key(ref(c.name)).alias(c.time_key))
    return df.select(*out)


def stamp_staging(df: DataFrame, batch_id: int, delete_flag: int = 0) -> DataFrame:
    return df.withColumns(
        {BATCH_INSERT: F.lit(batch_id).cast("int"), DELETE_FLAG: F.lit(delete_flag).cast("int")}
    )


def staging_full_load(source: DataFrame, spec: TableSpec, batch_id: int) -> DataFrame:
    """The staged snapshot of a delivery: conformed, cleansed, with keys and batch stamp."""
    cleansed = cleanse(conform(source, spec), spec)
    return stamp_staging(add_date_time_keys(cleansed, spec), batch_id)


def dummy_row(spark: SparkSession, spec: TableSpec, batch_id: int) -> DataFrame:
    """The unknown member: every column at its default, every date and time key at '-1'."""
    out = []
    for c in spec.columns:
        out.append(default_for(c).alias(c.name))
        out += [F.lit(UNKNOWN_KEY).alias(key) for key in (c.date_key, c.time_key) if key]
    return stamp_staging(spark.range(0, 1, 1, 1).select(*out), batch_id)


def with_dummy(stg: DataFrame, spec: TableSpec, batch_id: int) -> DataFrame:
    return stg.unionByName(dummy_row(stg.sparkSession, spec, batch_id))


def without_match(left: DataFrame, right: DataFrame, spec: TableSpec, collation: str | None = None) -> DataFrame:
    """Rows of the left side whose business key does not occur on the right (NOT EXISTS)."""
    # One row per key: a key that occurs many times shrinks before the exchange, and the anti join
    # reuses the partitioning of the aggregation.
    key = comparable(spec.bk, None, spec, collation)
    keys = right.filter(ref(spec.bk).isNotNull()).select(key.alias("_known")).distinct()
    if spec.bk_column.mandatory:
        return left.join(keys, key == F.col("_known"), "left_anti")
    # Null keys match nothing, so they need no exchange and must not meet in one task
    with_key = left.filter(ref(spec.bk).isNotNull()).join(keys, key == F.col("_known"), "left_anti")
    return with_key.unionByName(left.filter(ref(spec.bk).isNull()))


def missing_members(dwh: DataFrame, stg: DataFrame, spec: TableSpec, collation: str | None = None) -> DataFrame:
    """Current members of the warehouse that the staged snapshot lacks."""
    return without_match(dwh.filter(is_current_member()), stg, spec, collation)


def with_deletes(stg: DataFrame, dwh: DataFrame, spec: TableSpec, batch_id: int, collation: str | None = None) -> DataFrame:
    """Append the last known values of missing members to the snapshot, flagged as deleted."""
    gone = missing_members(dwh, stg, spec, collation).select(*[ref(n) for n in spec.staging_columns()])
    return stg.unionByName(stamp_staging(gone, batch_id, delete_flag=1))
