"""Declared constraints as queries that return their violations.

Spark enforces neither keys nor NOT NULL on plain files. Row-level checks are one pass without a
shuffle; key checks aggregate before the exchange, so a key repeated many times does not pile up.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histora.operators.staging import comparable
from histora.spec import TableSpec, ref


def _violations(df: DataFrame, spec: TableSpec, tests: list[tuple[str, Column]]) -> DataFrame:
    """One row (column_name, bk) per violated test, in a single pass over the data.

    The filter comes first: where Catalyst can prove that no test fires (a cleansed column is never
    null), it drops the whole scan.
    """
    any_fires = reduce(or_, [test for _, test in tests], F.lit(False))
    found = F.filter(
        F.array(*[F.when(test, F.lit(name)) for name, test in tests] or [F.lit(None).cast("string")]),
        lambda name: name.isNotNull(),
    )
    return df.filter(any_fires).select(
        F.explode(found).alias("column_name"), ref(spec.bk).cast("string").alias("bk")
    )


def check_not_null(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Nulls in mandatory columns and in their derived keys."""
    fields = [f for c in spec.columns for f in c.fields() if not f.nullable]
    return _violations(df, spec, [(f.name, ref(f.name).isNull()) for f in fields if f.name in df.columns])


def check_length(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Texts longer than declared."""
    fields = [f for c in spec.columns for f in c.fields() if f.metadata.get("length")]
    return _violations(
        df, spec, [(f.name, F.length(ref(f.name)) > f.metadata["length"]) for f in fields if f.name in df.columns]
    )


def _constraints(df: DataFrame, spec: TableSpec) -> list[tuple[str, Column]]:
    tests = []
    for f in (f for c in spec.columns for f in c.fields() if f.name in df.columns):
        if not f.nullable:
            tests.append((f.name, ref(f.name).isNull()))
        if f.metadata.get("length"):
            tests.append((f.name, F.coalesce(F.length(ref(f.name)) > f.metadata["length"], F.lit(False))))
    return tests


def check_constraints(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Nulls in mandatory columns and texts longer than declared, in one pass."""
    return _violations(df, spec, _constraints(df, spec))


def breaks_constraint(df: DataFrame, spec: TableSpec) -> Column:
    """Whether a row has a null in a mandatory column or a text longer than declared."""
    return reduce(or_, [test for _, test in _constraints(df, spec)], F.lit(False))


def check_unique_key(
    df: DataFrame, columns: list[str], spec: TableSpec | None = None, collation: str | None = None
) -> DataFrame:
    """Keys that occur more than once, with their number of rows. With a contract and a collation, keys that differ only in what the
    collation passes over are one key, shown by its first spelling."""
    rows = F.count(F.lit(1)).alias("n_rows")
    if spec is None or not collation:
        return df.groupBy(*[ref(c) for c in columns]).agg(rows).filter(F.col("n_rows") > 1)
    keys = [comparable(c, None, spec, collation).alias(f"_key{i}") for i, c in enumerate(columns)]
    shown = [F.min(ref(c)).alias(c) for c in columns]
    return df.groupBy(*keys).agg(*shown, rows).filter(F.col("n_rows") > 1).select(*[ref(c) for c in columns], "n_rows")


class ConstraintViolation(ValueError):
    """A snapshot breaks its declared constraints."""


def require(violations: DataFrame, what: str, examples: int = 5) -> None:
    """Raise with a few examples if there is any violation."""
    found = violations.take(examples)
    if found:
        raise ConstraintViolation(f"{what}: " + "; ".join(str(row.asDict()) for row in found))
