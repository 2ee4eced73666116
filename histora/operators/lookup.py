"""Lookups: code mappings, unit factors, code levels.

The joins carry no broadcast hint. Catalyst broadcasts a mapping whose measured size is below the
session's threshold and otherwise exchanges both sides; adaptive execution then splits a hot key of the
left side, which is why the data always stands left in a left join.
"""

from __future__ import annotations

from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histora.spec import UNKNOWN_KEY, ref


def _one_per_key(mapping: DataFrame, keys: list[str], value: str) -> DataFrame:
    """One row per key. A key with different values fails the job; rows without a complete key match nothing."""
    known = reduce(lambda a, b: a & b, [ref(k).isNotNull() for k in keys])
    low, high, filled = F.min(ref(value)), F.max(ref(value)), F.count(ref(value))
    entries = mapping.filter(known).groupBy(*[ref(k) for k in keys]).agg(
        low.alias("_low"), high.alias("_high"), filled.alias("_filled"), F.count(F.lit(1)).alias("_all")
    )
    one = F.col("_low").eqNullSafe(F.col("_high")) & F.col("_filled").isin(F.lit(0), F.col("_all"))
    several = F.raise_error(F.concat(F.lit("several entries for "), F.concat_ws("|", *[ref(k).cast("string") for k in keys])))
    return entries.filter(F.when(one, True).otherwise(several)).select(*[ref(k) for k in keys], F.col("_low").alias(value))


def map_codes(
    df: DataFrame,
    mapping: DataFrame,
    on: Mapping[str, str],
    code: str,
    where: Mapping[str, str] | None = None,
    name: str | None = None,
    default: str = UNKNOWN_KEY,
) -> DataFrame:
    """Add the mapped code of each row; rows without a mapping get the unknown member.

    A mapping that gives one key several codes is refused, as it would multiply rows; equal entries count once.

    on:    column of df -> column of the mapping.
    where: fixed values of mapping columns (source system, table, column); they reach its scan.
    """
    for column, value in (where or {}).items():
        mapping = mapping.filter(ref(column) == F.lit(value))
    pairs = list(on.items())
    small = mapping.select(
        *[ref(m).alias(f"_on{i}") for i, (_, m) in enumerate(pairs)], ref(code).cast("string").alias("_code")
    )
    condition = [ref(c) == F.col(f"_on{i}") for i, (c, _) in enumerate(pairs)]
    return (
        df.join(_one_per_key(small, [f"_on{i}" for i in range(len(pairs))], "_code"), condition, "left")
        .withColumn(name or code, F.coalesce(F.col("_code"), F.lit(default)))
        .drop("_code", *[f"_on{i}" for i in range(len(pairs))])
    )


def recalculate_units(
    df: DataFrame,
    factors: DataFrame,
    keys: Sequence[str],
    value: str,
    factor: str = "RecalculationFactor",
    unit_counts: Sequence[str] = ("NumberOfStandardUnitsAlternativeSubstance", "NumberOfStandardUnitsActiveIngredients"),
    name: str = "StandardValue",
) -> DataFrame:
    """Value in the output unit: value x factor, or null where a unit count above 1 leaves it undefined.

    A substance with different factors is refused, as it would multiply rows.
    """
    unclear = reduce(lambda a, b: a | b, [ref(c) > 1 for c in unit_counts])
    usable = factors.select(
        *[ref(k) for k in keys], F.when(~F.coalesce(unclear, F.lit(False)), ref(factor)).alias("_factor")
    )
    usable = _one_per_key(usable, list(keys), "_factor")
    return df.join(usable, list(keys), "left").withColumn(name, ref(value) * F.col("_factor")).drop("_factor")


def code_level(code: str, lengths: Sequence[int]):
    """Level of a code by its length; null for lengths that belong to no level."""
    size = F.length(ref(code))
    return reduce(lambda expr, i: expr.when(size == lengths[i], i), range(1, len(lengths)), F.when(size == lengths[0], 0))


def code_levels(df: DataFrame, code: str, name: str, lengths: Sequence[int] = (1, 3, 4, 5, 7)) -> DataFrame:
    """Level of each code, with code and name of itself and its ancestors per level ('-1' / '#NA#' below).

    The ancestor code is a prefix. Every code is spread over the prefixes above it, these meet the names in one
    join, and one aggregate brings the levels back into a row; a code's own name needs no lookup. Codes are unique;
    a code that is listed with different names is refused.
    """
    level = code_level(code, lengths)
    rows = df.withColumn("LevelNumber", level)
    names = _one_per_key(df.filter(level.isNotNull()).select(ref(code).alias("_prefix"), ref(name).alias("_name")), ["_prefix"], "_name")
    above = F.transform(
        F.filter(
            F.array(*[F.struct(F.lit(i).alias("level"), F.lit(n).alias("size")) for i, n in enumerate(lengths)]),
            lambda x: x["level"] < F.col("LevelNumber"),
        ),
        lambda x: F.struct(x["level"].alias("level"), F.substring(ref(code), F.lit(1), x["size"]).alias("prefix")),
    )
    spread = rows.select(ref(code).alias("_code"), F.explode(above).alias("_up"))
    spread = spread.select("_code", F.col("_up.level").alias("_level"), F.col("_up.prefix").alias("_prefix"))
    found = spread.join(names, "_prefix", "left").groupBy("_code").agg(
        *[F.max(F.when(F.col("_level") == i, F.col("_name"))).alias(f"_up{i:02d}") for i in range(len(lengths))]
    )
    out = rows.join(found, ref(code) == F.col("_code"), "left")
    columns = {}
    for i, size in enumerate(lengths):
        reached = F.col("LevelNumber") >= i
        label = F.when(F.col("LevelNumber") == i, ref(name)).otherwise(F.col(f"_up{i:02d}"))
        columns[f"CodeLevel{i:02d}"] = F.coalesce(F.when(reached, F.substring(ref(code), 1, size)), F.lit("-1"))
        columns[f"Level{i:02d}"] = F.coalesce(label, F.lit("#NA#"))
    return out.withColumns(columns).drop("_code", *[f"_up{i:02d}" for i in range(len(lengths))])
