"""Type-2 historization: compare a staged snapshot with the current versions and derive the new state.

`scd2_merge` reads each side once. It is one full outer equi-join on the business key, followed by a
projection; a changed member yields two rows (the closed version and its successor), all others one.
"""

from __future__ import annotations

from functools import reduce
from operator import or_
from typing import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from histora.functions.scalars import closing_ts, moment, typed_null
from histora.operators.staging import comparable, is_current_version, without_match
from histora.spec import (
    BATCH_INSERT,
    BATCH_UPDATE,
    BEGINNING,
    CURRENT_FLAG,
    DELETE_FLAG,
    EARLY_FIELD,
    EARLY_FLAG,
    INSERT_DATE,
    OPEN_END,
    UNKNOWN_TEXT,
    UPDATE_DATE,
    VALID_FROM,
    VALID_TO,
    TableSpec,
    ref,
)

ACTION = "dwh_action"
KEEP, CLOSE, OPEN = "keep", "close", "open"
#: The row's version_hash as stored
HASH = "dwh_version_hash"


# Comparison --------------------------------------------------------------------------------------
def row_hash(spec: TableSpec, alias: str | None = None, extra: Iterable[Column] = ()) -> Column:
    """64-bit hash over the tracked columns. Spark's hash passes over nulls, so which columns are null is hashed as well. Only rows of
    one key are ever compared by it: a change goes unseen with a probability of 2 ** -64."""
    values = [ref(n, alias) for n in spec.staging_columns()]
    return F.xxhash64(*values, *[v.isNull() for v in values], *extra)


def version_hash(spec: TableSpec, delete: Column | None = None, early: Column | None = None, field: Column | None = None) -> Column:
    """Hash of a version with its delete and early-arrival marks (by default the row's own), to be stored with it. The lowest bit says
    that the member exists: it is neither deleted nor waiting for its delivery, so it can vanish."""
    delete, early = ref(DELETE_FLAG) if delete is None else delete, ref(EARLY_FLAG) if early is None else early
    field = ref(EARLY_FIELD) if field is None else field
    exists = ((delete == 0) & (early == 0)).cast("bigint")
    return row_hash(spec, None, (delete.cast("int"), early.cast("int"), field)).bitwiseAND(-2).bitwiseOR(exists)


def staged_hash(spec: TableSpec) -> Column:
    """`version_hash` of the version that a staged row would open."""
    return version_hash(spec, early=F.lit(0), field=F.lit(UNKNOWN_TEXT))


def changed(
    spec: TableSpec,
    d: str = "d",
    s: str = "s",
    null_safe: bool = False,
    collation: str | None = None,
    by: str = "columns",
) -> Column:
    """Whether the staged row differs from the current version it matches.

    By default a change between null and a value does not count, as with `<>` in SQL; null_safe counts
    it. by='hash' compares row hashes and is null-safe by nature. The current version's delete and
    early-arrival marks take part; a staged row never is an early arrival.
    """
    flags = [
        ref(DELETE_FLAG, d) != ref(DELETE_FLAG, s),
        ref(EARLY_FLAG, d) != F.lit(0),
        ref(EARLY_FIELD, d) != F.lit(UNKNOWN_TEXT),
    ]
    if by == "hash":
        tests = [row_hash(spec, d) != row_hash(spec, s)]
    elif by == "columns":
        pairs = [
            (comparable(n, d, spec, collation), comparable(n, s, spec, collation))
            for n in spec.staging_columns()
        ]
        tests = [~a.eqNullSafe(b) if null_safe else a != b for a, b in pairs]
    else:
        raise ValueError(f"unknown comparison {by!r}")
    return F.coalesce(reduce(or_, tests + flags), F.lit(False))


# Stamps ------------------------------------------------------------------------------------------
def opened_stamp(valid_from: Column, batch_id: int, now: Column, delete_flag: Column) -> dict[str, Column]:
    """Audit columns of a version that starts with this batch."""
    return {
        VALID_FROM: valid_from,
        VALID_TO: moment(OPEN_END),
        CURRENT_FLAG: F.lit(1),
        DELETE_FLAG: delete_flag.cast("int"),
        EARLY_FLAG: F.lit(0),
        EARLY_FIELD: F.lit(UNKNOWN_TEXT),
        INSERT_DATE: now,
        UPDATE_DATE: typed_null("timestamp_ntz"),
        BATCH_INSERT: F.lit(batch_id).cast("int"),
        BATCH_UPDATE: typed_null("int"),
    }


def stamp_dwh(
    stg: DataFrame, spec: TableSpec, valid_from, batch_id: int, now, keep: list[str] | None = None
) -> DataFrame:
    """Staged rows as first versions, in warehouse layout; keep names further columns to carry along."""
    stamps = opened_stamp(moment(valid_from), batch_id, moment(now), F.col(DELETE_FLAG))
    names = (keep or []) + spec.staging_columns()
    return stg.select(*[ref(n) for n in names], *[v.alias(k) for k, v in stamps.items()])


def dwh_full_load(stg: DataFrame, spec: TableSpec, batch_id: int, now) -> DataFrame:
    """Reload of a table without history: every staged row is valid from the beginning of time."""
    return stamp_dwh(stg, spec, BEGINNING, batch_id, now)


# Steps, one at a time ----------------------------------------------------------------------------
def match_current(dwh: DataFrame, stg: DataFrame, spec: TableSpec, collation: str | None = None) -> DataFrame:
    """Current versions (alias d) with the staged row (alias s) of the same business key."""
    on = comparable(spec.bk, "d", spec, collation) == comparable(spec.bk, "s", spec, collation)
    return dwh.filter(is_current_version()).alias("d").join(stg.alias("s"), on, "inner")


def _image(spec: TableSpec, alias: str) -> list[Column]:
    return [ref(n, alias).alias(n) for n in spec.staging_columns()]


def _audit_names(spec: TableSpec) -> list[str]:
    return spec.warehouse_columns(with_sid=False)[len(spec.staging_columns()):]


def closed_versions(dwh, stg, spec: TableSpec, batch_id: int, valid_from, now, **compare) -> DataFrame:
    """Current versions that end with this batch."""
    ends = {
        CURRENT_FLAG: F.lit(0),
        VALID_TO: closing_ts(moment(valid_from)),
        UPDATE_DATE: moment(now),
        BATCH_UPDATE: F.lit(batch_id).cast("int"),
    }
    matched = match_current(dwh, stg, spec, compare.get("collation")).filter(changed(spec, **compare))
    sid = [ref(spec.sid, "d").alias(spec.sid)] if spec.sid in dwh.columns else []
    return matched.select(
        *sid, *_image(spec, "d"), *[ends.get(n, ref(n, "d")).alias(n) for n in _audit_names(spec)]
    )


def new_versions(dwh, stg, spec: TableSpec, batch_id: int, valid_from, now, **compare) -> DataFrame:
    """Successors of the versions that end with this batch."""
    matched = match_current(dwh, stg, spec, compare.get("collation")).filter(changed(spec, **compare))
    stamps = opened_stamp(moment(valid_from), batch_id, moment(now), ref(DELETE_FLAG, "s"))
    return matched.select(*_image(spec, "s"), *[v.alias(k) for k, v in stamps.items()])


def new_members(stg: DataFrame, dwh: DataFrame, spec: TableSpec, collation: str | None = None) -> DataFrame:
    """Staged rows without a current version."""
    return without_match(stg, dwh.filter(is_current_version()), spec, collation)


def initial_versions(dwh, stg, spec: TableSpec, batch_id: int, init_valid_from, now, collation: str | None = None) -> DataFrame:
    """First versions of members the warehouse does not know yet."""
    return stamp_dwh(new_members(stg, dwh, spec, collation), spec, init_valid_from, batch_id, now)


# The whole step ----------------------------------------------------------------------------------
def one_row_per_key(df: DataFrame, spec: TableSpec, collation: str | None = None) -> DataFrame:
    """Fail when a business key is staged twice, without an exchange of its own: the window needs the
    partitioning and order that the join on the key asks for anyway. Two rows of a key are enough to fail, so each
    task passes on no more (a row number limit is applied before the exchange): a key that fills a delivery meets in no task."""
    key = comparable(spec.bk, None, spec, collation)
    nth = F.row_number().over(Window.partitionBy(key).orderBy(key))
    twice = F.raise_error(F.concat(F.lit(f"{spec.name}: staged twice: "), ref(spec.bk).cast("string")))
    few = df.withColumn("_nth", nth).filter(F.col("_nth") <= 2)
    return few.filter(F.when(F.col("_nth") == 1, True).otherwise(twice)).drop("_nth")


def scd2_merge(
    current: DataFrame,
    stg: DataFrame,
    spec: TableSpec,
    batch_id: int,
    init_valid_from,
    valid_from,
    now,
    null_safe: bool = False,
    collation: str | None = None,
    by: str = "columns",
    detect_deletes: bool = False,
    guard: bool = True,
) -> DataFrame:
    """New state of the current versions, each row marked in `dwh_action` as keep, close or open.

    detect_deletes: treat members missing from the snapshot as deleted in the same pass, with the
    result of staging them first by `with_deletes`, but without its extra join.
    """
    if spec.sid not in current.columns:
        current = current.withColumn(spec.sid, typed_null("bigint"))
    settings = (spec, batch_id, init_valid_from, valid_from, now, null_safe, collation, by, detect_deletes)
    if spec.bk_column.mandatory:
        return _merge(current, one_row_per_key(stg, spec, collation) if guard else stg, *settings)
    # Null keys match nothing. They are merged with an empty other side, which Catalyst turns into a
    # plain projection, so that they do not meet in one task of the join.
    nothing, no_key = F.lit(False), ref(spec.bk).isNull()
    keyed = stg.filter(~no_key)
    parts = [
        (current.filter(~no_key), one_row_per_key(keyed, spec, collation) if guard else keyed),
        (current.filter(no_key), stg.filter(nothing)),
        (current.filter(nothing), stg.filter(no_key)),
    ]
    return reduce(DataFrame.unionByName, [_merge(c, s, *settings) for c, s in parts])


def _merge(
    current, stg, spec, batch_id, init_valid_from, valid_from, now, null_safe, collation, by, detect_deletes
) -> DataFrame:
    columns = spec.warehouse_columns()
    d = current.select(*[ref(n) for n in columns], F.lit(True).alias("_in_dwh")).alias("d")
    s = stg.select(
        *[ref(n) for n in spec.staging_columns()], ref(DELETE_FLAG), F.lit(True).alias("_in_stg")
    ).alias("s")
    on = comparable(spec.bk, "d", spec, collation) == comparable(spec.bk, "s", spec, collation)
    in_dwh, in_stg = F.col("d._in_dwh").isNotNull(), F.col("s._in_stg").isNotNull()
    differs = changed(spec, null_safe=null_safe, collation=collation, by=by)
    if detect_deletes:
        vanished = (ref(DELETE_FLAG, "d") == 0) & (ref(EARLY_FLAG, "d") == 0)
        ends = in_dwh & F.when(in_stg, differs).otherwise(vanished)
    else:
        ends = in_dwh & in_stg & differs
    # What becomes of a joined row, as small numbers: they are compared once per column
    keep, close, open_staged, open_stored = (F.lit(i) for i in range(4))
    opening = F.when(in_stg, open_staged).otherwise(open_stored)
    steps = F.when(~in_dwh, F.array(open_staged)).when(ends, F.array(close, opening)).otherwise(F.array(keep))
    rows = d.join(s, on, "full_outer").withColumn("_step", F.explode(steps))

    staged, opens, closes = F.col("_step") == open_staged, F.col("_step") >= open_staged, F.col("_step") == close
    start = F.when(in_dwh, moment(valid_from)).otherwise(moment(init_valid_from))
    opened = opened_stamp(start, batch_id, moment(now), F.when(staged, ref(DELETE_FLAG, "s")).otherwise(1))
    closing = {
        CURRENT_FLAG: F.lit(0),
        VALID_TO: closing_ts(moment(valid_from)),
        UPDATE_DATE: moment(now),
        BATCH_UPDATE: F.lit(batch_id).cast("int"),
    }
    out = [F.when(~opens, ref(spec.sid, "d")).alias(spec.sid)]
    out += [F.when(staged, ref(n, "s")).otherwise(ref(n, "d")).alias(n) for n in spec.staging_columns()]
    for n in _audit_names(spec):
        value = F.when(opens, opened[n])
        if n in closing:
            value = value.when(closes, closing[n])
        out.append(value.otherwise(ref(n, "d")).alias(n))
    action = F.when(opens, OPEN).when(closes, CLOSE).otherwise(KEEP)
    return rows.select(*out, action.alias(ACTION))


def touched_keys(versions: DataFrame, staged: DataFrame, detect_deletes: bool = False) -> DataFrame:
    """What a merge may have to do with, found from narrow sides: a row (bk, sid) for every staged key that is new or whose hash differs
    from that of its current version, and, with detect_deletes, for every existing member that is not staged.

    versions: _key, sid, hash; staged: _key, bk, hash. Only these columns are exchanged.
    """
    v, s = versions.alias("v"), staged.alias("s")
    stored, delivered = F.col("v.sid").isNotNull(), F.col("s.bk").isNotNull()
    differs = stored & delivered & ~F.col("v.hash").eqNullSafe(F.col("s.hash"))
    gone = ~delivered & F.coalesce(F.col("v.hash").bitwiseAND(1) == 1, F.lit(True)) & F.lit(detect_deletes)
    both = v.join(s, F.col("v._key") == F.col("s._key"), "full_outer")
    return both.filter(~stored | differs | gone).select(F.col("s.bk").alias("bk"), F.col("v.sid").alias("sid"))


def scd2_apply(
    dwh: DataFrame,
    stg: DataFrame,
    spec: TableSpec,
    batch_id: int,
    init_valid_from,
    valid_from,
    now,
    **options,
) -> DataFrame:
    """The whole table after one batch: earlier history untouched, current versions merged.

    New versions have no surrogate key yet; see `histora.operators.surrogate`.
    """
    columns = spec.warehouse_columns(with_sid=spec.sid in dwh.columns)
    merged = scd2_merge(
        dwh.filter(is_current_version()), stg, spec, batch_id, init_valid_from, valid_from, now, **options
    )
    past = dwh.filter(~is_current_version())
    return past.select(*[ref(n) for n in columns]).unionByName(merged.select(*[ref(n) for n in columns]))


def empty_warehouse(spark, spec: TableSpec, with_sid: bool = True) -> DataFrame:
    """The warehouse table before its first load."""
    return spark.createDataFrame([], spec.warehouse_schema(with_sid))
