"""Type-1 loads: update in place, delta loads, overlap replacement."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histora.functions.scalars import moment, typed_null
from histora.operators.history import ACTION, OPEN, _audit_names, changed, one_row_per_key, stamp_dwh
from histora.operators.staging import comparable, staging_full_load
from histora.spec import BATCH_UPDATE, BEGINNING, DELETE_FLAG, EARLY_FIELD, EARLY_FLAG, UNKNOWN_TEXT, UPDATE_DATE
from histora.spec import TableSpec, ref


def delta_load(
    source: DataFrame,
    delta_column: str,
    last_value: Any,
    extra: Column | None = None,
    loaded: DataFrame | None = None,
    key: str | None = None,
) -> DataFrame:
    """Rows that are newer than the last loaded value; the filter reaches the scan.

    A row without a value can't be known to be old, so it is always loaded. loaded: the keys (column `key`) that were loaded with
    the last value itself. Rows that come late with that very value are then loaded as well, unless their key is among
    them. Only rows with this value meet the keys.
    """
    kind, value = source.schema[delta_column].dataType, ref(delta_column)
    if extra is not None:
        source = source.filter(extra)
    if last_value is None:
        return source
    last = F.lit(last_value).cast(kind)
    newer = source.filter(value.isNull() | (value > last))
    if loaded is None:
        return newer
    known = loaded.select(ref(key).alias("_known")).distinct()
    return newer.unionByName(source.filter(value == last).join(known, ref(key).eqNullSafe(F.col("_known")), "left_anti"))


def next_trigger(loaded: DataFrame, delta_column: str, last_value: Any = None) -> DataFrame:
    """The value the next delta load starts after, as a single row; an empty load keeps the old one."""
    kind = loaded.schema[delta_column].dataType
    return loaded.agg(
        F.coalesce(F.max(ref(delta_column)), F.lit(last_value).cast(kind)).alias("next_trigger"),
        F.count(F.lit(1)).alias("n_rows"),
    )


#: What becomes of a stored row that an update in place replaces
DROP = "drop"


def _matched(dwh: DataFrame, stg: DataFrame, spec: TableSpec, batch_id: int, now, null_safe, collation, by) -> DataFrame:
    """Stored rows (alias d) and staged ones (alias s) side by side, and whether the staged one replaces the stored one (_update)."""
    fresh = stamp_dwh(stg, spec, BEGINNING, batch_id, now)
    d = dwh.withColumn("_in_dwh", F.lit(True)).alias("d")
    s = fresh.withColumn("_in_stg", F.lit(True)).alias("s")
    on = comparable(spec.bk, "d", spec, collation) == comparable(spec.bk, "s", spec, collation)
    differs = changed(spec, null_safe=null_safe, collation=collation, by=by)
    update = F.col("d._in_dwh").isNotNull() & F.col("s._in_stg").isNotNull() & differs
    return d.join(s, on, "full_outer").withColumn("_update", update)


def _updated(spec: TableSpec, batch_id: int, now, with_sid: bool) -> list[Column]:
    """The columns of a row after the batch."""
    overwritten = {
        DELETE_FLAG: ref(DELETE_FLAG, "s"),
        EARLY_FLAG: F.lit(0),
        EARLY_FIELD: F.lit(UNKNOWN_TEXT),
        UPDATE_DATE: moment(now),
        BATCH_UPDATE: F.lit(batch_id).cast("int"),
        **{n: ref(n, "s") for n in spec.staging_columns()},
    }
    out = [ref(spec.sid, "d").alias(spec.sid)] if with_sid else []
    for n in spec.staging_columns() + _audit_names(spec):
        value = F.when(F.col("d._in_dwh").isNull(), ref(n, "s"))
        if n in overwritten:
            value = value.when(F.col("_update"), overwritten[n])
        out.append(value.otherwise(ref(n, "d")).alias(n))
    return out


def scd1_merge(
    dwh: DataFrame,
    stg: DataFrame,
    spec: TableSpec,
    batch_id: int,
    now,
    null_safe: bool = True,
    collation: str | None = None,
    by: str = "columns",
    guard: bool = True,
) -> DataFrame:
    """Update changed members in place, insert new ones, leave the others alone. One full outer join."""
    with_sid = spec.sid in dwh.columns
    no_key = ref(spec.bk).isNull()
    bypass = []
    if not spec.bk_column.mandatory:
        new_rows = stamp_dwh(stg.filter(no_key), spec, BEGINNING, batch_id, now)
        if with_sid:
            new_rows = new_rows.withColumn(spec.sid, typed_null("bigint"))
        bypass = [dwh.filter(no_key), new_rows]
        dwh, stg = dwh.filter(~no_key), stg.filter(~no_key)
    if guard:
        stg = one_row_per_key(stg, spec, collation)
    merged = _matched(dwh, stg, spec, batch_id, now, null_safe, collation, by).select(*_updated(spec, batch_id, now, with_sid))
    for part in bypass:
        merged = merged.unionByName(part.select(*[ref(c) for c in merged.columns]))
    return merged


def scd1_changes(
    dwh: DataFrame,
    stg: DataFrame,
    spec: TableSpec,
    batch_id: int,
    now,
    null_safe: bool = True,
    collation: str | None = None,
    by: str = "columns",
    guard: bool = True,
) -> DataFrame:
    """What `scd1_merge` changes: a row marked 'open' in dwh_action for every new member (without a surrogate key) and every new
    image of a changed one, and the image that it replaces, marked 'drop'."""
    no_key = ref(spec.bk).isNull()
    keyed = stg.filter(~no_key)
    keyed = one_row_per_key(keyed, spec, collation) if guard else keyed
    rows = _matched(dwh.filter(~no_key), keyed, spec, batch_id, now, null_safe, collation, by)
    steps = F.when(F.col("d._in_dwh").isNull(), F.array(F.lit(OPEN))).when(F.col("_update"), F.array(F.lit(DROP), F.lit(OPEN)))
    rows = rows.withColumn(ACTION, F.explode(steps))
    dropped = F.col(ACTION) == DROP
    after = zip(spec.warehouse_columns(), _updated(spec, batch_id, now, True), strict=True)
    changes = rows.select(*[F.when(dropped, ref(n, "d")).otherwise(value).alias(n) for n, value in after], ACTION)
    if not spec.bk_column.mandatory:
        new = stamp_dwh(stg.filter(no_key), spec, BEGINNING, batch_id, now).withColumn(spec.sid, typed_null("bigint"))
        changes = changes.unionByName(new.withColumn(ACTION, F.lit(OPEN)).select(*[ref(c) for c in changes.columns]))
    return changes


def scd1_delta_upsert(
    dwh: DataFrame,
    source: DataFrame,
    spec: TableSpec,
    delta_column: str,
    last_value: Any,
    batch_id: int,
    now,
    **options,
) -> DataFrame:
    """Load only cleansed rows newer than the last loaded value and merge them; nothing is deleted."""
    stg = delta_load(staging_full_load(source, spec, batch_id), delta_column, last_value)
    return scd1_merge(dwh, stg, spec, batch_id, now, **options)


def outside_range(df: DataFrame, column: str, low: Any, high: Any) -> Column:
    """Rows whose column has no value from low to high (both included), as a filter that reaches the scan."""
    kind, value = df.schema[column].dataType, ref(column)
    return value.isNull() | (value < F.lit(low).cast(kind)) | (value > F.lit(high).cast(kind))


def scd1_overlap_replace(
    dwh: DataFrame, stg: DataFrame, spec: TableSpec, overlap_column: str, low: Any, high: Any, batch_id: int, now
) -> DataFrame:
    """Remove the overlapping range (low to high, both included) and insert the staged rows instead."""
    kept = dwh.filter(outside_range(dwh, overlap_column, low, high))
    fresh = stamp_dwh(stg, spec, BEGINNING, batch_id, now)
    if spec.sid in dwh.columns:
        fresh = fresh.withColumn(spec.sid, typed_null("bigint"))
    return kept.unionByName(fresh.select(*[ref(c) for c in dwh.columns]))
