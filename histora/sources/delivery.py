"""Source deliveries: any batch DataFrame, brought to the order and types of its contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.errors import AnalysisException
from pyspark.sql import types as T

from histora.functions.scalars import typed_null
from histora.spec import ContractError, TableSpec, ref


_SHELL = "shell"


def empty_source(spark: SparkSession, spec: TableSpec) -> DataFrame:
    """The shell of a source that has not been written yet: typed columns, no rows, and a mark that says so."""
    marked = [T.StructField(f.name, f.dataType, True, {_SHELL: True}) for f in spec.source_schema()]
    return spark.createDataFrame([], T.StructType(marked))


def is_shell(df: DataFrame) -> bool:
    """Whether nothing has been delivered, which is not the same as an empty delivery."""
    return bool(df.schema.fields) and all(f.metadata.get(_SHELL) for f in df.schema)


def conform(df: DataFrame, spec: TableSpec, missing: str = "reject") -> DataFrame:
    """Contract columns in contract order and type; other columns are left out.

    missing: 'reject' raises if the delivery lacks a contract column, 'null' fills it with nulls.
    """
    absent = [c.name for c in spec.columns if c.name not in df.columns]
    if absent and missing != "null":
        raise ContractError(f"{spec.name}: delivery lacks {', '.join(absent)}")
    return df.select(
        *[
            (typed_null(c.spark_type) if c.name in absent else ref(c.name).cast(c.spark_type)).alias(c.name)
            for c in spec.columns
        ]
    )


def source_or_shell(spark: SparkSession, spec: TableSpec, path: str, allow_shell: bool = False) -> DataFrame:
    """The delivery at a path. A path without one raises, or gives the shell if that is asked for."""
    try:
        delivered = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND" or not allow_shell:
            raise
        return empty_source(spark, spec)
    return conform(delivered, spec)
