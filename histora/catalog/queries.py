"""Every operator as a query over the test tables: name -> function (spark, folder) -> DataFrame."""

from __future__ import annotations

from dataclasses import replace
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from histora.catalog import fixtures as fx
from histora.catalog.fixtures import CUSTOMER, EVENT, INIT, LINE_ITEM, NOW, ORDER, VALID_FROM, column, read
from histora.functions import scalars as sc
from histora.functions.calendar import year_months
from histora.operators import checks, early, groups, hierarchy, history, lookup, staging, surrogate, type1
from histora.plans import pipeline, storage, views
from histora.plans.partitions import PartitionedTable
from histora.plans.storage import Warehouse
from histora.sources import conform, select_rows, source_or_shell
from histora.spec import CURRENT_FLAG, DELETE_FLAG, ref, table
from histora.spec import VALID_FROM as VALID_FROM_COLUMN
from histora.workspace import fresh_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def plain(df: DataFrame) -> DataFrame:
    """Times and dates as text, decimals as doubles: the same rendering in every engine."""
    kinds = {T.TimestampNTZType: "string", T.TimestampType: "string", T.DateType: "string", T.DecimalType: "double"}
    return df.select(
        *[
            ref(f.name).cast(kinds[type(f.dataType)]).alias(f.name) if type(f.dataType) in kinds else ref(f.name)
            for f in df.schema
        ]
    )


# Sources -----------------------------------------------------------------------------------------
@query
def source_shell(spark, sf):
    """Two sources of one table, one of them not delivered yet: its shell fits the other."""
    pending = source_or_shell(spark, CUSTOMER, f"{sf}/not_delivered.parquet", allow_shell=True)
    return pending.unionByName(conform(fx.customers(spark, sf, 3), CUSTOMER))


@query
def conform_source(spark, sf):
    return plain(conform(fx.line_items(spark, sf), LINE_ITEM))


@query
def metadata_filter(spark, sf):
    return select_rows(
        read(spark, sf, "conversations"), F.col("role") == "user", ["conv_id", "turn", "text"], ["conv_id", "turn"]
    )


# Sinks -------------------------------------------------------------------------------------------
@query
def staging_schema(spark, sf):
    """A snapshot written in the declared staging schema and read back."""
    stg = staging.staging_full_load(fx.line_items(spark, sf), LINE_ITEM, 1)
    return plain(storage.write_staging(stg, LINE_ITEM, fresh_path(spark, "staged")))


@query
def dwh_schema(spark, sf):
    """The empty warehouse table takes the first versions of all orders by name."""
    return plain(
        history.empty_warehouse(spark, ORDER, with_sid=False).unionByName(fx.loaded(spark, sf, ORDER))
    )


@query
def archive_table(spark, sf):
    """A stored table set aside under a time-stamped name, with all its rows."""
    path = fresh_path(spark, "archive")
    name = "dim_customer_" + path[-8:]
    fx.loaded(spark, sf, CUSTOMER).write.option("path", path).saveAsTable(name)
    return plain(spark.table(storage.archive_table(spark, name, "20240101000000")))


# Projections -------------------------------------------------------------------------------------
@query
def cleanse_defaults(spark, sf):
    return plain(staging.cleanse(conform(fx.events(spark, sf), EVENT), EVENT))


def _types_contract(**defaults: str):
    declared = [
        ("row_bk", "nvarchar(56)", False),
        ("InternalId", "nvarchar(50)", False),
        ("dim_Part_bk", "bigint", False),
        ("ShortText", "nvarchar(5)", False),
        ("LongText", "nvarchar(6)", False),
        ("FreeText", "nvarchar(10)", True),
        ("BigNumber", "bigint", False),
        ("LineCount", "integer", False),
        ("SmallNumber", "smallint", False),
        ("Amount", "decimal(10,3)", False),
        ("Price", "float", False),
        ("Rate", "real", False),
        ("ValidFrom", "datetime", False),
        ("active_since", "datetime", False),
        ("ShipDate", "date", False),
        ("insert_date", "date", False),
        ("Hour", "time", False),
        ("IsOpen", "boolean", False),
    ]
    return table(
        "all_types",
        [column(n, t, null=opt, bk=n == "row_bk", default=defaults.get(n, "")) for n, t, opt in declared],
    )


def _all_types(spark, sf):
    """A delivery of every declared type, in which each column is null for one line number."""
    item, number = read(spark, sf, "lineitem"), F.col("l_linenumber")
    values = {
        "InternalId": F.col("l_orderkey").cast("string"),
        "dim_Part_bk": F.col("l_partkey"),
        "ShortText": F.col("l_returnflag"),
        "LongText": F.col("l_linestatus"),
        "FreeText": F.col("l_linestatus"),
        "BigNumber": F.col("l_orderkey"),
        "LineCount": number,
        "SmallNumber": number,
        "Amount": F.col("l_quantity"),
        "Price": F.col("l_extendedprice"),
        "Rate": F.col("l_quantity"),
        "ValidFrom": F.col("l_shipdate"),
        "active_since": F.col("l_shipdate"),
        "ShipDate": F.col("l_shipdate"),
        "insert_date": F.col("l_shipdate"),
        "Hour": F.lit("12:30:00"),
        "IsOpen": F.col("l_linestatus") == "O",
    }
    key = sc.composite_bk(F.col("l_orderkey"), number, F.col("l_partkey"), F.col("l_suppkey"))
    return item.select(
        key.alias("row_bk"),
        *[F.when(number != i % 7 + 1, v).alias(n) for i, (n, v) in enumerate(values.items())],
    )


@query
def type_defaults(spark, sf):
    spec = _types_contract()
    return plain(staging.cleanse(conform(_all_types(spark, sf), spec), spec))


@query
def explicit_defaults(spark, sf):
    spec = _types_contract(
        ShortText="'n/a'", FreeText="'none'", LineCount="-1", Price="-0.5", ValidFrom="'2000-01-01 00:00:00'", IsOpen="true"
    )
    return plain(staging.cleanse(conform(_all_types(spark, sf), spec), spec))


@query
def date_time_keys(spark, sf):
    return read(spark, sf, "events").select(
        "event_id", sc.date_key(F.col("ts")).alias("dim_Date_ts_bk"), sc.time_key(F.col("ts")).alias("dim_Time_ts_bk")
    )


@query
def cleansed_view(spark, sf):
    return plain(staging.cleanse(conform(fx.events(spark, sf), EVENT), EVENT, split=True))


@query
def dummy_row(spark, sf):
    """Orders per customer segment, where orders of customers not delivered count for the unknown member."""
    members = staging.with_dummy(
        staging.staging_full_load(fx.customers(spark, sf, 1), CUSTOMER, 1), CUSTOMER, 1
    ).select("dim_Customer_bk", "Name", F.coalesce("Segment", F.lit("-")).alias("Segment"))
    per_customer = fx.orders(spark, sf, 3).groupBy("dim_Customer_bk").agg(F.count(F.lit(1)).alias("n"))
    resolved = lookup.map_codes(
        per_customer, members, on={"dim_Customer_bk": "dim_Customer_bk"}, code="dim_Customer_bk", name="member_bk"
    )
    orders = resolved.groupBy("member_bk").agg(F.sum("n").alias("n"))
    return (
        orders.join(members, F.col("member_bk") == F.col("dim_Customer_bk"))
        .groupBy("Segment")
        .agg(F.sum("n").alias("n_orders"), F.count(F.lit(1)).alias("n_members"))
    )


@query
def contract_projection(spark, sf):
    stg = staging.staging_full_load(fx.events(spark, sf), EVENT, 1)
    return plain(stg.select(*EVENT.staging_columns()))


@query
def date_keys_optional(spark, sf):
    """A contract that wants keys for one of its two datetime columns only."""
    spec = table(
        "dim_EventKeys",
        [
            column("dim_Event_bk", "nvarchar(56)", bk=True, pk=True),
            column("EventTime", "datetime", date_dim=False),
            column("EventTimeOpt", "datetime", null=True),
            column("EventDay", "date"),
        ],
    )
    return plain(staging.staging_full_load(fx.events(spark, sf), spec, 1))


# Staging -----------------------------------------------------------------------------------------
@query
def staging_full_load(spark, sf):
    return plain(staging.staging_full_load(fx.line_items(spark, sf), LINE_ITEM, 1))


@query
def staging_with_dummy(spark, sf):
    return plain(pipeline.stage(fx.events(spark, sf), EVENT, 1))


@query
def delete_detection(spark, sf):
    gone = staging.missing_members(fx.loaded(spark, sf, ORDER), fx.staged(spark, sf, ORDER, 2), ORDER)
    return plain(staging.stamp_staging(gone.select(*ORDER.staging_columns()), 2, delete_flag=1))


@query
def staging_with_deletes(spark, sf):
    stg, dwh = fx.staged(spark, sf, ORDER, 2), fx.loaded(spark, sf, ORDER)
    return plain(staging.with_deletes(stg, dwh, ORDER, 2))


# Comparison --------------------------------------------------------------------------------------
def _compare_events(spark, sf, **options):
    matched = history.match_current(fx.loaded(spark, sf, EVENT), fx.staged(spark, sf, EVENT, 2), EVENT)
    return matched.select(
        F.col("s.dim_Event_bk").alias("dim_Event_bk"), history.changed(EVENT, **options).cast("int").alias("changed")
    )


@query
def change_detection(spark, sf):
    return _compare_events(spark, sf)


@query
def change_detection_nullsafe(spark, sf):
    return _compare_events(spark, sf, null_safe=True)


@query
def hash_diff(spark, sf):
    return _compare_events(spark, sf, by="hash")


@query
def new_members(spark, sf):
    return plain(history.new_members(fx.staged(spark, sf, ORDER, 2), fx.loaded(spark, sf, ORDER), ORDER))


@query
def merge_match(spark, sf):
    matched = history.match_current(fx.loaded(spark, sf, ORDER), fx.staged(spark, sf, ORDER, 2), ORDER)
    return matched.select(
        F.col("d.dim_Order_bk").alias("dim_Order_bk"),
        F.col("d.TotalPrice").alias("old_TotalPrice"),
        F.col("s.TotalPrice").alias("new_TotalPrice"),
    )


# Historization -----------------------------------------------------------------------------------
def _second_batch(spark, sf):
    dwh = fx.loaded(spark, sf, ORDER)
    return dwh, staging.with_deletes(fx.staged(spark, sf, ORDER, 2), dwh, ORDER, 2)


@query
def scd2_closed_versions(spark, sf):
    dwh, stg = _second_batch(spark, sf)
    return plain(history.closed_versions(dwh, stg, ORDER, 2, VALID_FROM[2], NOW[2]))


@query
def scd2_new_versions(spark, sf):
    dwh, stg = _second_batch(spark, sf)
    return plain(history.new_versions(dwh, stg, ORDER, 2, VALID_FROM[2], NOW[2]))


@query
def scd2_initial_load(spark, sf):
    dwh, stg = _second_batch(spark, sf)
    return plain(history.initial_versions(dwh, stg, ORDER, 2, INIT, NOW[2]))


@query
def scd2_apply(spark, sf):
    return plain(fx.after_second(spark, sf, ORDER))


@query
def dwh_full_load(spark, sf):
    return plain(history.dwh_full_load(fx.staged(spark, sf, EVENT, 1), EVENT, 1, NOW[1]))


@query
def view_cur(spark, sf):
    return plain(views.view_cur(fx.after_second(spark, sf, ORDER), ORDER))


@query
def view_cid(spark, sf):
    return plain(views.view_cid(fx.after_second(spark, sf, ORDER), ORDER))


@query
def view_fhi(spark, sf):
    return plain(views.view_fhi(fx.after_second(spark, sf, ORDER, null_safe=True), ORDER))


@query
def surrogate_keys(spark, sf):
    numbered = surrogate.assign_sids(
        fx.after_second(spark, sf, ORDER), ORDER, order_by=["dim_Order_bk", VALID_FROM_COLUMN]
    )
    return plain(numbered.select(ORDER.sid, "dim_Order_bk", VALID_FROM_COLUMN))


# Constraints -------------------------------------------------------------------------------------
def _faulty_customers(spark, sf):
    """Staged customers with repeated keys, nulls in mandatory columns and texts that are too long."""
    stg, key = fx.staged(spark, sf, CUSTOMER, 3), F.col("InternalId").cast("bigint")
    twice = stg.withColumn("copy", F.explode(F.when(key % 97 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
    return twice.drop("copy").withColumns(
        {
            "Name": F.when(key % 101 != 0, F.col("Name")),
            "Segment": F.when(key % 103 == 0, F.concat("Segment", F.lit(" and more"))).otherwise(F.col("Segment")),
        }
    )


@query
def check_not_null(spark, sf):
    return checks.check_not_null(_faulty_customers(spark, sf), CUSTOMER)


@query
def check_length(spark, sf):
    return checks.check_length(_faulty_customers(spark, sf), CUSTOMER)


@query
def check_unique_key(spark, sf):
    return checks.check_unique_key(read(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def check_sid_unique(spark, sf):
    """A table whose closed versions were stored a second time."""
    dwh = surrogate.assign_sids(
        fx.after_second(spark, sf, ORDER), ORDER, order_by=["dim_Order_bk", VALID_FROM_COLUMN]
    )
    again = dwh.filter(F.col(CURRENT_FLAG) == 0)
    return checks.check_unique_key(dwh.unionByName(again), [ORDER.sid])


# Pipelines ---------------------------------------------------------------------------------------
@query
def pipeline_scd2(spark, sf):
    """Four batches of the customer table: first load, changes, reappearance, an unchanged redelivery."""
    house = Warehouse(spark, CUSTOMER, fresh_path(spark, "scd2"))
    for t in (1, 2, 3, 4):
        pipeline.run_scd2(fx.customers(spark, sf, min(t, 3)), house, t, VALID_FROM[t], NOW[t], INIT)
    return plain(views.view_fhi(house.table(), CUSTOMER).drop(CUSTOMER.sid))


@query
def pipeline_repeat(spark, sf):
    """Batch 2 is loaded from the wrong delivery, repeated with a faulty one (refused) and with the right one; then batch 3."""
    house = Warehouse(spark, CUSTOMER, fresh_path(spark, "repeat"))

    def run(batch, source):
        pipeline.run_scd2(source, house, batch, VALID_FROM[batch], NOW[batch], INIT)

    first, second = fx.customers(spark, sf, 1), fx.customers(spark, sf, 2)
    run(1, first)
    run(2, fx.customers(spark, sf, 3))
    try:
        run(2, second.unionByName(second))
    except Exception as refused:  # noqa: BLE001 - Spark wraps the error of the merge
        if "staged twice" not in str(refused):
            raise
    run(2, second)
    run(3, fx.customers(spark, sf, 3))
    return plain(views.view_fhi(house.table(), CUSTOMER).drop(CUSTOMER.sid))


@query
def pipeline_bucketed(spark, sf):
    """Three batches of a table whose versions are stored in buckets of the business key."""
    house = Warehouse(spark, CUSTOMER, fresh_path(spark, "bucketed"), buckets=4)
    for t in (1, 2, 3):
        pipeline.run_scd2(fx.customers(spark, sf, t), house, t, VALID_FROM[t], NOW[t], INIT)
    return plain(views.view_fhi(house.table(), CUSTOMER).drop(CUSTOMER.sid))


@query
def pipeline_collation(spark, sf):
    """The second delivery spells a third of the keys in lower case and some of them with trailing blanks: the same members."""
    house = Warehouse(spark, CUSTOMER, fresh_path(spark, "collation"))
    key, bk = F.col("InternalId").cast("bigint"), F.col("dim_Customer_bk")
    spelled = F.when(key % 15 == 0, F.concat(F.lower(bk), F.lit("  "))).when(key % 3 == 0, F.lower(bk)).otherwise(bk)
    for t, source in ((1, fx.customers(spark, sf, 1)), (2, fx.customers(spark, sf, 2).withColumn("dim_Customer_bk", spelled))):
        pipeline.run_scd2(source, house, t, VALID_FROM[t], NOW[t], INIT, stage_deletes=True, collation="UTF8_LCASE_RTRIM")
    return plain(views.view_fhi(house.table(), CUSTOMER).drop(CUSTOMER.sid))


@query
def pipeline_dispatch(spark, sf):
    """Two batches of two tables, each by the pipeline of its contract: one with history, one reloaded."""
    events = replace(EVENT, table_type="reload")
    houses = [Warehouse(spark, spec, fresh_path(spark, spec.name)) for spec in (CUSTOMER, events)]
    for t in (1, 2):
        sources = {CUSTOMER.name: fx.customers(spark, sf, t), events.name: fx.events(spark, sf, t)}
        done = pipeline.run_contracts(
            sources, houses, t, valid_from=VALID_FROM[t], now=NOW[t], init_valid_from=INIT
        )
        for result in done.values():
            if isinstance(result, Exception):
                raise result
    parts = [
        house.table().select(
            F.lit(house.spec.name).alias("table_name"), ref(house.spec.bk).alias("bk"), CURRENT_FLAG, DELETE_FLAG, VALID_FROM_COLUMN
        )
        for house in houses
    ]
    return plain(parts[0].unionByName(parts[1]))


@query
def pipeline_dependencies(spark, sf):
    """Nations, customers and orders given in the wrong order: each is loaded once the table it refers to is there."""
    nation = table(
        "dim_Nation", [column("dim_Nation_bk", "nvarchar(56)", bk=True), column("Name", "nvarchar(50)")], table_type="reload"
    )
    linked = [
        replace(c, early_arrive_parent="dim_Nation") if c.name == "dim_Nation_bk" else c for c in CUSTOMER.columns
    ]
    specs = [ORDER, replace(CUSTOMER, columns=tuple(linked)), nation]
    houses = {s.name: Warehouse(spark, s, fresh_path(spark, s.name)) for s in specs}
    nations = read(spark, sf, "nation").select(
        sc.composite_bk(F.lit("TPCH"), F.col("n_nationkey")).alias("dim_Nation_bk"), F.col("n_name").alias("Name")
    )
    sources = {"dim_Order": fx.orders(spark, sf, 1), "dim_Customer": fx.customers(spark, sf, 1), "dim_Nation": nations}
    done = pipeline.run_contracts(sources, houses.values(), 1, valid_from=VALID_FROM[1], now=NOW[1], init_valid_from=INIT)
    parts = []
    for i, (name, result) in enumerate(done.items()):
        if isinstance(result, Exception):
            raise result
        rows = houses[name].table().select(ref(houses[name].spec.bk).alias("bk"), DELETE_FLAG)
        parts.append(rows.select(F.lit(i + 1).alias("loaded_as"), F.lit(name).alias("table_name"), "bk", DELETE_FLAG))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def pipeline_catalog_views(spark, sf):
    """Two batches whose views are in the catalog, read by another session: the members that exist, and how many versions each has."""
    spec = replace(CUSTOMER, name="dim_CustomerShared")
    house = Warehouse(spark, spec, fresh_path(spark, "shared"), catalog_views=True)
    for t in (1, 2):
        pipeline.run_scd2(fx.customers(spark, sf, t), house, t, VALID_FROM[t], NOW[t], INIT)
    other = spark.newSession()
    versions = other.table("v_dim_CustomerShared_fhi").groupBy("dim_Customer_bk").agg(F.count(F.lit(1)).alias("n_versions"))
    return other.table("v_dim_CustomerShared_cur").select("dim_Customer_bk", "Segment", "Balance").join(versions, "dim_Customer_bk")


@query
def pipeline_hash_keys(spark, sf):
    """Two batches of a table with hashes as surrogate keys: versions, different keys and keys that a repeat of the load gives again."""
    houses = [Warehouse(spark, CUSTOMER, fresh_path(spark, "hashed"), hash_sids=True) for _ in range(2)]
    for house, parts in zip(houses, (1, 7), strict=True):
        for t in (1, 2):
            pipeline.run_scd2(fx.customers(spark, sf, t).repartition(parts), house, t, VALID_FROM[t], NOW[t], INIT)
    version = ["sid", CUSTOMER.bk, VALID_FROM_COLUMN]
    first, again = (house.table().withColumnRenamed(CUSTOMER.sid, "sid").select(*version) for house in houses)
    return first.join(again.withColumn("again", F.lit(1)), version, "left").agg(
        F.count("sid").alias("n_versions"), F.count_distinct("sid").alias("n_keys"), F.count("again").alias("n_repeated")
    )


@query
def hash_keys(spark, sf):
    """Orders numbered by hashes in a space of eight times their number, where many collide, the even ones beside the keys of the odd ones:
    as many keys as orders, none out of the space, and the same ones when the rows lie otherwise."""
    rows, sid = read(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderkey").cast("string").alias("bk")), ref(ORDER.sid)
    space = 8 * rows.count()

    def numbered(rows):
        odd = surrogate.assign_hash_sids(rows.filter("k % 2 = 1"), ORDER, ["bk"], space=space)
        even = surrogate.assign_hash_sids(rows.filter("k % 2 = 0"), ORDER, ["bk"], odd.select(sid), space)
        return odd.unionByName(even)

    again = numbered(rows.repartition(5)).select("k", sid.alias("again"))
    return numbered(rows).join(again, "k").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct(sid).alias("n_keys"),
        F.count(F.when((sid < 0) | (sid >= space), 1)).alias("n_out"),
        F.count(F.when(sid == F.col("again"), 1)).alias("n_same"),
    )


@query
def pipeline_scd1(spark, sf):
    """Two batches of a table that is updated in place."""
    spec = replace(ORDER, table_type="scd1", delete_detection=False)
    house = Warehouse(spark, spec, fresh_path(spark, "scd1"))
    for t in (1, 2):
        pipeline.run_table(fx.orders(spark, sf, t), house, t, now=NOW[t])
    return plain(house.table().drop(spec.sid))


@query
def pipeline_scd1_delta(spark, sf):
    """Three delta loads; each starts at the highest order date of the one before, which is stored with its batch."""
    spec = replace(ORDER, table_type="scd1", delete_detection=False, delta_load=True, delta_column="OrderDate")
    house = Warehouse(spark, spec, fresh_path(spark, "delta"))
    early = fx.orders(spark, sf, 1).filter(F.col("OrderDate") <= LAST_ORDER)
    for t, source in ((1, early), (2, fx.orders(spark, sf, 2)), (3, fx.orders(spark, sf, 3))):
        pipeline.run_table(source, house, t, now=NOW[t])
    return plain(house.table().drop(spec.sid))


@query
def pipeline_scd1_overlap(spark, sf):
    """A load, a delta that replaces the order dates it spans, and an empty delivery."""
    spec = replace(
        ORDER, table_type="fact", delete_detection=False, delta_load=True, delta_type="overlap", delta_column="OrderDate"
    )
    house = Warehouse(spark, spec, fresh_path(spark, "overlap"))
    second = fx.orders(spark, sf, 2).filter(F.col("OrderDate") <= "1999-06-30 23:59:59")
    pipeline.run_table(fx.orders(spark, sf, 1), house, 1, now=NOW[1])
    pipeline.run_scd1(second, house, 2, NOW[2], last_value="1997-06-30 23:59:59")
    pipeline.run_table(second.limit(0), house, 3, now=NOW[3])
    return plain(house.table().drop(spec.sid))


@query
def pipeline_early_arriving(spark, sf):
    """Orders refer to customers not delivered yet: placeholders, which the next delivery replaces."""
    house = Warehouse(spark, CUSTOMER, fresh_path(spark, "early"))
    pipeline.run_scd2(fx.customers(spark, sf, 1), house, 1, VALID_FROM[1], NOW[1], INIT)
    pipeline.run_early_arriving(fx.orders(spark, sf, 3), ORDER, {CUSTOMER.name: house}, 2, VALID_FROM[2], NOW[2])
    pipeline.run_scd2(fx.customers(spark, sf, 3), house, 3, VALID_FROM[3], NOW[3], INIT)
    return plain(house.table().drop(CUSTOMER.sid))


@query
def chained_views(spark, sf):
    """Staging views on top of each other, every step written once."""
    steps = [
        lambda d: d.filter(F.col("o_orderstatus") != "P"),
        lambda d: d.withColumn("year", F.year("o_orderdate")),
        lambda d: d.groupBy("year", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.max("o_orderkey").alias("last")),
    ]
    return storage.chain(read(spark, sf, "orders"), steps)


@query
def publish_and_replace(spark, sf):
    """A published view is pointed to a new folder; the old one stays whole until then."""
    name = "published_" + fresh_path(spark, "")[-8:]
    orders = read(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    storage.publish(orders.filter(F.col("o_orderkey") % 2 == 0), fresh_path(spark, "publish"), name)
    storage.publish(spark.table(name).unionByName(orders.filter(F.col("o_orderkey") % 3 == 1)), fresh_path(spark, "publish"), name)
    return spark.table(name)


@query
def pipeline_full_reload(spark, sf):
    house = Warehouse(spark, EVENT, fresh_path(spark, "reload"))
    for t in (1, 2):
        pipeline.run_full_reload(fx.events(spark, sf, t), house, t, NOW[t])
    return plain(views.view_cur(house.table(), EVENT).drop(EVENT.sid))


@query
def pipeline_psa(spark, sf):
    house = Warehouse(spark, ORDER, fresh_path(spark, "psa"))
    for t in (1, 2):
        pipeline.run_psa(fx.staged(spark, sf, ORDER, t), house, t, VALID_FROM[t], NOW[t], INIT)
    return plain(views.view_cid(house.table(), ORDER).drop(ORDER.sid))


# Further load patterns ---------------------------------------------------------------------------
@query
def early_arriving(spark, sf):
    """Customers that orders refer to before their own delivery."""
    return plain(
        early.add_early_arriving(
            fx.loaded(spark, sf, CUSTOMER), fx.orders(spark, sf, 3), ["dim_Customer_bk"], CUSTOMER, 2, VALID_FROM[2], NOW[2]
        )
    )


LAST_EVENT = "2024-01-15 00:00:00"
LAST_ORDER = "1998-01-01 00:00:00"


@query
def delta_load(spark, sf):
    """Events without a time can't be known to be old."""
    events = read(spark, sf, "events").withColumn("ts", F.when(F.col("event_id") % 50 != 0, F.col("ts")))
    return plain(type1.delta_load(events, "ts", LAST_EVENT))


@query
def delta_boundary(spark, sf):
    """Orders with the last value itself are loaded unless their key was loaded with it."""
    orders = read(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    known = orders.filter((F.col("o_orderdate") == LAST_ORDER) & (F.col("o_orderkey") % 2 == 0))
    return plain(type1.delta_load(orders, "o_orderdate", LAST_ORDER, loaded=known, key="o_orderkey"))


@query
def delta_trigger(spark, sf):
    newer = type1.delta_load(read(spark, sf, "events"), "ts", LAST_EVENT)
    return plain(type1.next_trigger(newer, "ts", LAST_EVENT))


@query
def scd1_merge(spark, sf):
    return plain(type1.scd1_merge(fx.loaded(spark, sf, ORDER), fx.staged(spark, sf, ORDER, 2), ORDER, 2, NOW[2]))


@query
def scd1_delta_upsert(spark, sf):
    return plain(
        type1.scd1_delta_upsert(
            fx.loaded(spark, sf, ORDER), fx.orders(spark, sf, 2), ORDER, "OrderDate", LAST_ORDER, 2, NOW[2]
        )
    )


@query
def scd1_overlap_replace(spark, sf):
    low, high = "1997-07-01 00:00:00", "1999-06-30 23:59:59"
    stg = staging.staging_full_load(
        fx.orders(spark, sf, 2).filter(F.col("OrderDate").between(low, high)), ORDER, 2
    )
    dwh = history.dwh_full_load(fx.staged(spark, sf, ORDER, 1), ORDER, 1, NOW[1])
    return plain(type1.scd1_overlap_replace(dwh, stg, ORDER, "OrderDate", low, high, 2, NOW[2]))


@query
def partition_switch(spark, sf):
    """Orders stored by year; the second delivery replaces the years from 1998 on."""
    path = fresh_path(spark, "switch")
    year = F.year("OrderDate").alias("order_year")
    first = staging.staging_full_load(fx.orders(spark, sf, 1), ORDER, 1).select("*", year)
    recent = fx.orders(spark, sf, 2).filter(F.col("OrderDate") >= "1998-01-01 00:00:00")
    second = staging.staging_full_load(recent, ORDER, 2).select("*", year)
    storage.switch_partition(first, path, ["order_year"])
    storage.switch_partition(second, path, ["order_year"])
    return plain(spark.read.schema(first.schema).parquet(path))


# Derivations -------------------------------------------------------------------------------------
@query
def pipeline_partitions(spark, sf):
    """Orders by year with commits: the second batch first brings wrong rows for more years and is then repeated with the right ones."""
    store = PartitionedTable(spark, ORDER, fresh_path(spark, "partitions"), "OrderYear")

    def staged(t):
        return staging.staging_full_load(fx.orders(spark, sf, t), ORDER, t).withColumn("OrderYear", F.year("OrderDate"))

    store.switch(staged(1), 1)
    store.switch(staged(3).filter("OrderYear >= 1996"), 2)
    store.switch(staged(2).filter("OrderYear >= 1998"), 2)
    return plain(store.read())


@query
def composite_bk(spark, sf):
    part = F.when(F.col("l_partkey") % 19 != 0, F.col("l_partkey"))
    return read(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        sc.composite_bk(F.lit("TPCH"), F.col("l_orderkey"), F.col("l_linenumber"), part).alias("line_bk"),
    )


@query
def padded_id(spark, sf):
    return read(spark, sf, "orders").select("o_orderkey", sc.padded_id(F.col("o_orderkey")).alias("InternalId"))


def _stays(spark, sf):
    """Orders as stays: admitted on the order date, discharged after up to 90 days."""
    key = F.col("o_orderkey")
    return read(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_custkey") % 17 != 0, F.col("o_custkey")).alias("group_key"),
        F.col("o_orderpriority").alias("kind"),
        F.col("o_orderdate").cast("date").alias("start_date"),
        F.date_add(F.col("o_orderdate").cast("date"), (key % 90).cast("int")).alias("end_date"),
    )


def _with_length(spark, sf):
    return _stays(spark, sf).withColumn(
        "LengthOfStayInDays", sc.length_of_stay(F.col("start_date"), F.col("end_date"))
    )


@query
def length_of_stay(spark, sf):
    return _with_length(spark, sf).select("o_orderkey", "LengthOfStayInDays")


@query
def consolidated_sum(spark, sf):
    return groups.consolidated_sum(_with_length(spark, sf), "group_key", "LengthOfStayInDays")


@query
def first_last_flags(spark, sf):
    flagged = groups.first_last_flags(_stays(spark, sf), "group_key", "start_date", "o_orderkey")
    return flagged.select("o_orderkey", "IsFirst_Flag", "IsLast_Flag")


@query
def current_of_sequence(spark, sf):
    open_ended = F.when(F.col("o_orderkey") % 13 != 0, F.col("end_date"))
    flagged = groups.current_of_sequence(
        _stays(spark, sf).withColumn("end_date", open_ended), ["group_key", "kind"], "start_date", "end_date", "1999-06-01 00:00:00", "o_orderkey"
    )
    return flagged.select("o_orderkey", "Current_flag")


@query
def durations(spark, sf):
    end = F.col("ts") + F.expr("make_dt_interval(0, 0, 0, user_id * 37)")
    return read(spark, sf, "events").select(
        "event_id",
        *[sc.duration(unit, F.col("ts"), end).alias(f"duration_{unit}s") for unit in ("second", "minute", "hour", "day")],
    )


@query
def planned_vs_actual(spark, sf):
    planned = F.col("l_shipdate") + F.expr("make_dt_interval(4 - l_linenumber, cast(l_quantity as int), 7, 30)")
    return read(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        sc.planned_vs_actual("minute", planned, F.col("l_shipdate")).alias("movement_minutes"),
    )


@query
def parent_child_days(spark, sf):
    parent = read(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    child = read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    return groups.parent_child_days(parent, child, "l_orderkey", "o_orderdate", "l_shipdate").drop("l_shipdate")


CODE_LENGTHS = (1, 3, 4, 5, 7)


@query
def code_levels(spark, sf):
    """Part numbers as a code tree: every prefix of a code length is a code, named by its first part name."""
    code = F.lpad(F.col("p_partkey").cast("string"), 7, "0")
    prefixes = F.explode(F.array(*[F.substring(code, 1, n) for n in CODE_LENGTHS]))
    codes = (
        read(spark, sf, "part").select(prefixes.alias("code"), "p_name").groupBy("code").agg(F.min("p_name").alias("name"))
    )
    return lookup.code_levels(codes, "code", "name", CODE_LENGTHS)


def _edges(spark, sf):
    """region > nation > customer > order, and orders below their priority as well."""

    def edge(table_name, child, parent, name):
        return read(spark, sf, table_name).select(
            F.concat(*child).alias("child"), F.concat(*parent).alias("parent"), ref(name).cast("string").alias("name")
        )

    lit, col = F.lit, F.col
    order = (lit("O"), col("o_orderkey"))
    return (
        edge("nation", (lit("N"), col("n_nationkey")), (lit("R"), col("n_regionkey")), "n_name")
        .unionByName(edge("customer", (lit("C"), col("c_custkey")), (lit("N"), col("c_nationkey")), "c_name"))
        .unionByName(edge("orders", order, (lit("C"), col("o_custkey")), "o_orderkey"))
        .unionByName(edge("orders", order, (lit("P"), col("o_orderpriority")), "o_orderkey"))
    )


@query
def hierarchy_closure(spark, sf):
    return hierarchy.hierarchy_closure(_edges(spark, sf), "child", "parent")


@query
def hierarchy_flatten(spark, sf):
    regions = read(spark, sf, "region").select(
        F.concat(F.lit("R"), F.col("r_regionkey")).alias("child"), F.col("r_name").alias("name")
    )
    priorities = read(spark, sf, "orders").select(
        F.concat(F.lit("P"), F.col("o_orderpriority")).alias("child"), F.col("o_orderpriority").alias("name")
    )
    roots = regions.unionByName(priorities.distinct())
    # suppliers hang below nodes that no root reaches, and some nations have no name
    lost = read(spark, sf, "supplier").select(
        F.concat(F.lit("S"), F.col("s_suppkey")).alias("child"),
        F.concat(F.lit("Q"), F.col("s_nationkey")).alias("parent"),
        F.col("s_name").alias("name"),
    )
    nameless = F.col("child").isin("N0", "N7", "N14", "N21")
    edges = _edges(spark, sf).withColumn("name", F.when(~nameless, F.col("name"))).unionByName(lost)
    return hierarchy.hierarchy_flatten(edges, "child", "parent", "name", roots, levels=5)


@query
def code_mapping(spark, sf):
    """Suppliers of line items mapped to nations; suppliers in debt have no mapping, all others the same one twice."""
    mapping = read(spark, sf, "supplier").filter(F.col("s_acctbal") >= 0).select(
        F.lit("TPCH").alias("system"),
        F.lit("lineitem").alias("table_name"),
        F.col("s_suppkey").alias("id"),
        sc.composite_bk(F.lit("N"), F.col("s_nationkey")).alias("code"),
    )
    items = read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return lookup.map_codes(
        items, mapping.unionByName(mapping), on={"l_suppkey": "id"}, code="code", where={"system": "TPCH", "table_name": "lineitem"}
    )


@query
def unit_recalculation(spark, sf):
    factors = read(spark, sf, "part").select(
        F.col("p_partkey").alias("l_partkey"),
        (F.col("p_size") * 0.5).alias("RecalculationFactor"),
        (F.col("p_size") % 3).alias("NumberOfStandardUnitsAlternativeSubstance"),
        (F.col("p_partkey") % 4).alias("NumberOfStandardUnitsActiveIngredients"),
    )
    items = read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return lookup.recalculate_units(items, factors, ["l_partkey"], "l_quantity")


@query
def year_month_dim(spark, sf):
    """The calendar that covers all order dates."""
    span = read(spark, sf, "orders").agg(F.min("o_orderdate").alias("s"), F.max("o_orderdate").alias("e"))
    return year_months(span, "s", "e")


@query
def nest_children(spark, sf):
    """Conversations with their turns as ordered lists, shown as text."""
    nested = groups.nest_children(
        read(spark, sf, "conversations"), ["conv_id"], ["turn", "role", "text"], ["turn", "role", "text"], part_size=4
    )
    line = F.transform("children", lambda c: F.concat_ws(":", c["turn"].cast("string"), c["role"], c["text"]))
    return nested.select("conv_id", "part_no", "n_children", F.array_join(line, "\n").alias("turns"))


@query
def numbered_children(spark, sf):
    """The turns of each conversation with their place in it."""
    order = ["turn", "role", "text"]
    return groups.number_children(read(spark, sf, "conversations"), ["conv_id"], order, order)
