"""Contracts and deliveries on the test tables.

A delivery is the whole table as its source system would send it at one time: members come and go and
attributes change between t1, t2 and t3, by rules on the key.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from histora.functions.scalars import composite_bk
from histora.operators.history import scd2_apply, stamp_dwh
from histora.plans.pipeline import stage
from histora.spec import BEGINNING, ColumnSpec, TableSpec, table

INIT = BEGINNING
VALID_FROM = {n: dt.datetime(2024, n, 1) for n in (1, 2, 3, 4)}
NOW = {n: moment + dt.timedelta(hours=1) for n, moment in VALID_FROM.items()}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def column(name: str, data_type: str, null: bool = False, **flags) -> ColumnSpec:
    return ColumnSpec(name, data_type, mandatory=not null, **flags)


CUSTOMER = table(
    "dim_Customer",
    [
        column("dim_Customer_bk", "nvarchar(56)", bk=True, pk=True),
        column("dim_SourceSystem_bk", "nvarchar(5)"),
        column("InternalId", "nvarchar(50)"),
        column("Name", "nvarchar(255)"),
        column("Segment", "nvarchar(10)", null=True),
        column("Balance", "float"),
        column("dim_Nation_bk", "nvarchar(56)"),
    ],
)

ORDER = table(
    "dim_Order",
    [
        column("dim_Order_bk", "nvarchar(56)", bk=True, pk=True),
        column("dim_SourceSystem_bk", "nvarchar(5)"),
        column("InternalId", "nvarchar(50)"),
        column("dim_Customer_bk", "nvarchar(56)", early_arrive_parent="dim_Customer"),
        column("Status", "nvarchar(5)"),
        column("Priority", "nvarchar(20)", null=True),
        column("TotalPrice", "float"),
        column("OrderDate", "datetime"),
    ],
)

EVENT = table(
    "dim_Event",
    [
        column("dim_Event_bk", "nvarchar(56)", bk=True, pk=True),
        column("dim_User_bk", "nvarchar(56)"),
        column("EventType", "nvarchar(20)"),
        column("Value", "float"),
        column("Props", "nvarchar(4000)", null=True),
        column("EventTime", "datetime"),
        column("EventTimeOpt", "datetime", null=True),
        column("EventDay", "date"),
    ],
)

LINE_ITEM = table(
    "fct_LineItem",
    [
        column("fct_LineItem_bk", "nvarchar(56)", bk=True, pk=True),
        column("dim_SourceSystem_bk", "nvarchar(5)"),
        column("dim_Order_bk", "nvarchar(56)"),
        column("dim_Part_bk", "nvarchar(56)"),
        column("dim_Supplier_bk", "nvarchar(56)"),
        column("LineNumber", "smallint"),
        column("Quantity", "decimal(10,3)"),
        column("ExtendedPrice", "float"),
        column("Discount", "float"),
        column("Tax", "float"),
        column("ReturnFlag", "nvarchar(1)"),
        column("LineStatus", "nvarchar(10)", null=True),
        column("ShipDate", "date"),
        column("ShipTime", "datetime"),
    ],
)


def _differs(key: Column, t: int, every: int) -> Column:
    """Rows whose attributes the second delivery changes."""
    return F.lit(t == 2) & (key % every == 0)


def _members(df: DataFrame, key: Column, t: int) -> DataFrame:
    if t == 1:
        return df.filter(key % 20 != 0)
    if t == 2:
        return df.filter(key % 13 != 0)
    return df


def customers(spark: SparkSession, sf_dir: str, t: int) -> DataFrame:
    key = F.col("c_custkey")
    return _members(read(spark, sf_dir, "customer"), key, t).select(
        composite_bk(F.lit("TPCH"), key).alias("dim_Customer_bk"),
        F.lit("TPCH").alias("dim_SourceSystem_bk"),
        key.cast("string").alias("InternalId"),
        F.col("c_name").alias("Name"),
        F.when(~_differs(key, t, 11), F.col("c_mktsegment")).alias("Segment"),
        F.when(_differs(key, t, 7), F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")).alias("Balance"),
        composite_bk(F.lit("TPCH"), F.col("c_nationkey")).alias("dim_Nation_bk"),
    )


def orders(spark: SparkSession, sf_dir: str, t: int) -> DataFrame:
    key = F.col("o_orderkey")
    return _members(read(spark, sf_dir, "orders"), key, t).select(
        composite_bk(F.lit("TPCH"), key).alias("dim_Order_bk"),
        F.lit("TPCH").alias("dim_SourceSystem_bk"),
        key.cast("string").alias("InternalId"),
        composite_bk(F.lit("TPCH"), F.col("o_custkey")).alias("dim_Customer_bk"),
        F.col("o_orderstatus").alias("Status"),
        F.when(~_differs(key, t, 11), F.col("o_orderpriority")).alias("Priority"),
        F.when(_differs(key, t, 7), F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).alias("TotalPrice"),
        F.col("o_orderdate").alias("OrderDate"),
    )


def events(spark: SparkSession, sf_dir: str, t: int = 1) -> DataFrame:
    key = F.col("event_id")
    time = F.when(key % 9 != 0, F.col("ts"))
    return read(spark, sf_dir, "events").select(
        composite_bk(F.lit("WEB"), key).alias("dim_Event_bk"),
        composite_bk(F.lit("WEB"), F.col("user_id")).alias("dim_User_bk"),
        F.col("event_type").alias("EventType"),
        F.when(_differs(key, t, 7), F.col("value") + 1).otherwise(F.col("value")).alias("Value"),
        F.when(~_differs(key, t, 11), F.col("props")).alias("Props"),
        time.alias("EventTime"),
        time.alias("EventTimeOpt"),
        F.col("ts").cast("date").alias("EventDay"),
    )


def line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The widest delivery; nulls in several columns."""
    number = F.col("l_linenumber")
    return read(spark, sf_dir, "lineitem").select(
        composite_bk(F.col("l_orderkey"), number).alias("fct_LineItem_bk"),
        F.lit("TPCH").alias("dim_SourceSystem_bk"),
        composite_bk(F.lit("TPCH"), F.col("l_orderkey")).alias("dim_Order_bk"),
        F.when(F.col("l_partkey") % 19 != 0, composite_bk(F.lit("TPCH"), F.col("l_partkey"))).alias("dim_Part_bk"),
        composite_bk(F.lit("TPCH"), F.col("l_suppkey")).alias("dim_Supplier_bk"),
        number.alias("LineNumber"),
        F.when(number != 5, F.col("l_quantity")).alias("Quantity"),
        F.col("l_extendedprice").alias("ExtendedPrice"),
        F.col("l_discount").alias("Discount"),
        F.when(number != 4, F.col("l_tax")).alias("Tax"),
        F.when(number != 3, F.col("l_returnflag")).alias("ReturnFlag"),
        F.when(number != 2, F.col("l_linestatus")).alias("LineStatus"),
        F.when(F.col("l_partkey") % 9 != 0, F.col("l_shipdate").cast("date")).alias("ShipDate"),
        F.when(
            F.col("l_partkey") % 9 != 0, F.col("l_shipdate") + F.expr("make_dt_interval(0, l_linenumber, 30, 15)")
        ).alias("ShipTime"),
    )


DELIVERIES = {"dim_Customer": (CUSTOMER, customers), "dim_Order": (ORDER, orders), "dim_Event": (EVENT, events)}


def staged(spark: SparkSession, sf_dir: str, spec: TableSpec, t: int) -> DataFrame:
    """The staged snapshot of delivery t (delivery 4 repeats 3), with the unknown member."""
    _, delivery = DELIVERIES[spec.name]
    return stage(delivery(spark, sf_dir, min(t, 3)), spec, t)


def loaded(spark: SparkSession, sf_dir: str, spec: TableSpec) -> DataFrame:
    """The warehouse table after the first batch, without surrogate keys."""
    return stamp_dwh(staged(spark, sf_dir, spec, 1), spec, INIT, 1, NOW[1])


def after_second(spark: SparkSession, sf_dir: str, spec: TableSpec, **options) -> DataFrame:
    """The warehouse table after the second batch, deletes detected, without surrogate keys."""
    return scd2_apply(
        loaded(spark, sf_dir, spec),
        staged(spark, sf_dir, spec, 2),
        spec,
        2,
        INIT,
        VALID_FROM[2],
        NOW[2],
        detect_deletes=True,
        **options,
    )
