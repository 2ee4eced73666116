"""Derivations over groups of rows.

A group may hold a large share of all rows. Its aggregate is therefore built with map-side combining,
and per-row results come from a join on a unique row key, never from a window over the whole group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histora.functions.scalars import moment
from histora.operators.surrogate import with_positions, write_in_order
from histora.spec import OPEN_END, ref
from histora.workspace import fresh_path


def consolidated_sum(df: DataFrame, group: str, value: str, name: str | None = None) -> DataFrame:
    """Sum of a value over the rows of one consolidation; rows without a group take no part."""
    return (
        df.filter(ref(group).isNotNull())
        .groupBy(ref(group))
        .agg(F.sum(ref(value)).alias(name or value), F.count(F.lit(1)).alias("n_rows"))
    )


def _at_extreme(df: DataFrame, keys: list[str], column: str, last: bool) -> DataFrame:
    """The rows of each group that hold its first or last value of a column; a null comes before all values.

    The value alone is aggregated, by hashing and combined before the exchange; the rows are found by a join on the group.
    """
    value = ref(column)
    ends = df.groupBy(*[ref(k).alias(f"_{k}") for k in keys]).agg(
        (F.max(value) if last else F.min(value)).alias("_end"), F.max(value.isNull()).alias("_null")
    )
    same = [ref(k).eqNullSafe(ref(f"_{k}")) for k in keys]
    hit = value.eqNullSafe(F.col("_end")) if last else F.when(F.col("_null"), value.isNull()).otherwise(value == F.col("_end"))
    return df.join(ends, same).filter(hit).drop("_end", "_null", *[f"_{k}" for k in keys])


def first_last_flags(
    df: DataFrame, group: str, order: str, key: str, first: str = "IsFirst_Flag", last: str = "IsLast_Flag"
) -> DataFrame:
    """'1' for the first and last row of its group, '0' for the others, '-1' for rows without a group.

    key identifies a row and breaks ties of the order.
    """
    rows = df.filter(ref(group).isNotNull()).select(ref(group).alias("_group"), ref(order).alias("_order"), ref(key).alias("_key"))
    lows = _at_extreme(rows, ["_group"], "_order", last=False).groupBy("_group").agg(F.min("_key").alias("_key"))
    highs = _at_extreme(rows, ["_group"], "_order", last=True).groupBy("_group").agg(F.max("_key").alias("_key"))
    ends = (
        lows.select("_key", F.lit(1).alias("_first"), F.lit(0).alias("_last"))
        .unionByName(highs.select("_key", F.lit(0).alias("_first"), F.lit(1).alias("_last")))
        .groupBy("_key")
        .agg(F.max("_first").alias("_first"), F.max("_last").alias("_last"))
    )

    def flag(mark: str) -> Column:
        value = F.coalesce(F.col(mark), F.lit(0)).cast("string")
        return F.when(ref(group).isNull(), F.lit("-1")).otherwise(value)

    return (
        df.join(ends, ref(key) == F.col("_key"), "left")
        .withColumns({first: flag("_first"), last: flag("_last")})
        .drop("_key", "_first", "_last")
    )


def current_of_sequence(
    df: DataFrame, keys: list[str], valid_from: str, valid_to: str, now, key: str, name: str = "Current_flag"
) -> DataFrame:
    """'1' for rows valid now and, in sequences that have ended, for the last row; '0' otherwise.

    A row without an end is open: it is valid from its start on, and its sequence has not ended.
    """
    at = moment(now)
    start = ref(valid_from).cast("timestamp_ntz")
    end = F.coalesce(ref(valid_to).cast("timestamp_ntz"), moment(OPEN_END))
    groups = [f"_g{i}" for i in range(len(keys))]
    # Start and end in one number, of which the largest is found by hashing, with the end of the sequence in the same aggregate
    place = F.coalesce(_micros(start), F.lit(-(10**18)).cast("decimal(19,0)")) * F.lit(10**18).cast("decimal(19,0)") + _micros(end)
    rows = df.select(
        *[ref(k).alias(g) for k, g in zip(keys, groups, strict=True)], end.alias("_e"), place.alias("_place"), ref(key).alias("_key")
    )
    ended = rows.groupBy(*[F.col(g).alias(f"{g}_") for g in groups]).agg(F.max("_e").alias("_until"), F.max("_place").alias("_last"))
    ended = ended.filter(F.col("_until") < at)
    same = [F.col(g).eqNullSafe(F.col(f"{g}_")) for g in groups]
    last_of_ended = rows.join(ended, [*same, F.col("_place") == F.col("_last")]).groupBy(*groups).agg(F.max("_key").alias("_last_key"))
    valid = F.coalesce(at.between(start, end), F.lit(False))
    return (
        df.join(last_of_ended.select("_last_key"), ref(key) == F.col("_last_key"), "left")
        .withColumn(name, F.when(valid | F.col("_last_key").isNotNull(), "1").otherwise("0"))
        .drop("_last_key")
    )


def _micros(time: Column) -> Column:
    """Microseconds since 1970 of a time without zone, exact and in the same order."""
    seconds = (time - F.lit("1970-01-01").cast("timestamp_ntz")).cast("interval second").cast("decimal(18,6)")
    return (seconds * 1_000_000).cast("decimal(18,0)")


def parent_child_days(
    parent: DataFrame, child: DataFrame, key: str, parent_start: str, child_start: str, name: str = "days_between"
) -> DataFrame:
    """Child rows with the days from the start of their parent to their own; null without a parent.

    Left join with the children on the left, the form in which adaptive execution splits a parent with
    very many children over several tasks.
    """
    starts = parent.select(ref(key), ref(parent_start).alias("_parent_start"))
    return (
        child.join(starts, key, "left")
        .withColumn(name, F.datediff(ref(child_start), F.col("_parent_start")))
        .drop("_parent_start")
    )


def number_children(
    df: DataFrame, keys: list[str], order_by: list[str], fields: list[str], name: str = "position"
) -> DataFrame:
    """One row per child: the parent's keys, the child's place among its siblings (from 1), and the fields.

    Children are numbered by their place in sorted files, so neither a list nor a bound on the number of children
    is needed, and the group of a large parent is never sorted or collected in one task.
    """
    spark = df.sparkSession
    path = fresh_path(spark, "nest")
    flat = df.select(*[ref(c) for c in dict.fromkeys(keys + order_by + fields)])
    write_in_order(flat, keys + order_by, path)
    placed = with_positions(spark.read.schema(flat.schema).parquet(path), "_pos")
    first = placed.groupBy(*[ref(k).alias(f"_{k}") for k in keys]).agg(F.min("_pos").alias("_first"))
    same_parent = [ref(k).eqNullSafe(ref(f"_{k}")) for k in keys]
    place = (F.col("_pos") - F.col("_first") + 1).alias(name)
    return placed.join(first, same_parent).select(*[ref(k) for k in keys], place, *[ref(f) for f in fields if f not in keys])


def nest_children(df: DataFrame, keys: list[str], order_by: list[str], fields: list[str], part_size: int) -> DataFrame:
    """The rows of `number_children` as ordered lists of at most part_size children.

    A parent with more children is continued in further rows (part_no 0, 1, ...), so that no list outgrows a
    task; part_size is the caller's to choose.
    """
    children = number_children(df, keys, order_by, fields, "_place")
    part = F.floor((F.col("_place") - 1) / part_size).cast("int")
    child = F.struct(F.col("_place"), *[ref(f) for f in fields])
    return (
        children.groupBy(*[ref(k) for k in keys], part.alias("part_no"))
        .agg(F.sort_array(F.collect_list(child)).alias("_sorted"))
        .select(
            *[ref(k) for k in keys],
            "part_no",
            F.size("_sorted").alias("n_children"),
            F.transform("_sorted", lambda c: F.struct(*[c[f].alias(f) for f in fields])).alias("children"),
        )
    )
