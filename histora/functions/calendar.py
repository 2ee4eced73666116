"""The year-month calendar."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Month names of the model, in German
MONTH_NAMES = [
    "Januar", "Februar", "März", "April", "Mai", "Juni",
    "Juli", "August", "September", "Oktober", "November", "Dezember",
]


def year_months(span: DataFrame, start: str, end: str) -> DataFrame:
    """One row per month from start to end; span is a single row with both dates."""
    names = F.array(*[F.lit(n) for n in MONTH_NAMES])
    first = F.trunc(F.col(start).cast("date"), "month")
    months = F.explode(F.sequence(first, F.col(end).cast("date"), F.expr("INTERVAL 1 MONTH")))
    key = (F.year("m") * 100 + F.month("m")).cast("int")
    return span.select(months.alias("m")).select(
        key.alias("dim_YearMonth_bk"),
        key.alias("YearMonth"),
        F.get(names, F.month("m") - 1).alias("Month"),
        F.month("m").alias("MonthNumber"),
        F.year("m").alias("Year"),
    )


def year_month_dim(spark, start: str, end: str) -> DataFrame:
    """Calendar between two dates given as text."""
    span = spark.range(1).select(F.lit(start).alias("s"), F.lit(end).alias("e"))
    return year_months(span, "s", "e")
