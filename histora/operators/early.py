"""Early-arriving members: keys that facts refer to before their dimension row has been delivered."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histora.functions.defaults import default_for
from histora.functions.scalars import moment, typed_null
from histora.operators.history import opened_stamp
from histora.operators.staging import is_current_version
from histora.spec import EARLY_FIELD, EARLY_FLAG, UNKNOWN_KEY, TableSpec, ref


def early_members(
    parent: DataFrame, child: DataFrame, fk_columns: list[str], spec: TableSpec, collation: str | None = None
) -> DataFrame:
    """Keys (with the first column that refers to them) that have no current row in the parent. Keys that a collation takes for one
    are one, in their first spelling.

    One pass over the child for all its columns. Keys shrink to one row each before the exchange, so
    neither a popular key nor a large fact table reaches the join.
    """
    order = {name: i for i, name in enumerate(fk_columns)}
    refs = F.array(*[F.struct(F.lit(order[n]).alias("pos"), ref(n).cast("string").alias("bk")) for n in fk_columns])
    names = F.array(*[F.lit(n) for n in fk_columns])
    wanted = spec.bk_column.collation if collation == "declared" else collation
    wanted = wanted if spec.bk_column.length is not None else None
    key = F.collate("bk", wanted) if wanted else F.col("bk")
    keys = (
        child.select(F.explode(refs).alias("r"))
        .select("r.bk", "r.pos")
        .filter(F.col("bk").isNotNull() & (F.col("bk") != UNKNOWN_KEY))
        .groupBy(key.alias("_key"))
        .agg(F.min("pos").alias("pos"), F.min("bk").alias("bk"))
    )
    known = parent.filter(is_current_version()).select(ref(spec.bk).cast("string").alias("bk")).select(key.alias("_key"))
    return keys.join(known, "_key", "left_anti").select("bk", F.get(names, F.col("pos")).alias("field"))


def placeholders(
    parent: DataFrame,
    child: DataFrame,
    fk_columns: list[str],
    spec: TableSpec,
    batch_id: int,
    valid_from,
    now,
    collation: str | None = None,
) -> DataFrame:
    """One placeholder version per early member, in the columns of the parent."""
    stamps = opened_stamp(moment(valid_from), batch_id, moment(now), F.lit(0))
    stamps[EARLY_FLAG], stamps[EARLY_FIELD] = F.lit(1), F.col("field")
    out = [typed_null("bigint").alias(spec.sid)] if spec.sid in parent.columns else []
    for c in spec.columns:
        value = F.col("bk").cast(c.spark_type) if c.name == spec.bk else default_for(c)
        out.append(value.alias(c.name))
        out += [F.lit(UNKNOWN_KEY).alias(key) for key in (c.date_key, c.time_key) if key]
    return early_members(parent, child, fk_columns, spec, collation).select(*out, *[v.alias(k) for k, v in stamps.items()])


def add_early_arriving(
    parent: DataFrame, child: DataFrame, fk_columns: list[str], spec: TableSpec, batch_id: int, valid_from, now
) -> DataFrame:
    """The parent with a placeholder version per early member. Its first real delivery replaces it, as
    the early-arrival mark counts as a difference."""
    return parent.unionByName(placeholders(parent, child, fk_columns, spec, batch_id, valid_from, now))
