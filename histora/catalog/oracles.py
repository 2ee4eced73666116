"""The SQL that gives the rows of each query, written against the test tables for DuckDB."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

OPEN_END = "TIMESTAMP '9999-12-31 23:59:59'"
DAY = "'%Y-%m-%d'"
CLOCK = "'%H:%M:%S'"

AUDIT = [
    "dwh_ValidFrom", "dwh_ValidTo", "dwh_CurrentFlag", "dwh_DeleteFlag", "dwh_EarlyArriveFlag",
    "dwh_EarlyArriveField", "dwh_InsertDate", "dwh_UpdateDate", "dwh_BatchRunIdInsert", "dwh_BatchRunIdUpdate",
]
AUDIT_TIMES = ["dwh_ValidFrom", "dwh_ValidTo", "dwh_InsertDate", "dwh_UpdateDate"]


def members(key: str, t: int) -> str:
    return {1: f"{key} % 20 <> 0", 2: f"{key} % 13 <> 0"}.get(t, "TRUE")


def as_text(sql: str, columns: list[str], doubles: list[str] | None = None) -> str:
    casts = [f"CAST({c} AS VARCHAR) AS {c}" for c in columns] + [f"CAST({c} AS DOUBLE) AS {c}" for c in doubles or []]
    return f"SELECT * REPLACE ({', '.join(casts)}) FROM ({sql})" if casts else sql


# Deliveries, already cleansed and with keys ------------------------------------------------------
CUSTOMER_COLUMNS = [
    "dim_Customer_bk", "dim_SourceSystem_bk", "InternalId", "Name", "Segment", "Balance", "dim_Nation_bk",
]
ORDER_COLUMNS = [
    "dim_Order_bk", "dim_SourceSystem_bk", "InternalId", "dim_Customer_bk", "Status", "Priority", "TotalPrice",
    "OrderDate", "dim_Date_OrderDate_bk", "dim_Time_OrderDate_bk",
]
EVENT_COLUMNS = [
    "dim_Event_bk", "dim_User_bk", "EventType", "Value", "Props", "EventTime", "dim_Date_EventTime_bk",
    "dim_Time_EventTime_bk", "EventTimeOpt", "dim_Date_EventTimeOpt_bk", "dim_Time_EventTimeOpt_bk",
    "EventDay", "dim_Date_EventDay_bk",
]


def customer_rows(t: int) -> str:
    segment = "CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_mktsegment END" if t == 2 else "c_mktsegment"
    balance = "CASE WHEN c_custkey % 7 = 0 THEN c_acctbal + 1 ELSE c_acctbal END" if t == 2 else "c_acctbal"
    return f"""SELECT 'TPCH|' || c_custkey AS dim_Customer_bk, 'TPCH' AS dim_SourceSystem_bk,
      CAST(c_custkey AS VARCHAR) AS InternalId, c_name AS Name, {segment} AS Segment, {balance} AS Balance,
      'TPCH|' || c_nationkey AS dim_Nation_bk
    FROM customer WHERE {members('c_custkey', t)}"""


def order_rows(t: int, condition: str = "TRUE") -> str:
    priority = "CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderpriority END" if t == 2 else "o_orderpriority"
    price = "CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice + 1 ELSE o_totalprice END" if t == 2 else "o_totalprice"
    return f"""SELECT 'TPCH|' || o_orderkey AS dim_Order_bk, 'TPCH' AS dim_SourceSystem_bk,
      CAST(o_orderkey AS VARCHAR) AS InternalId, 'TPCH|' || o_custkey AS dim_Customer_bk, o_orderstatus AS Status,
      {priority} AS Priority, {price} AS TotalPrice, CAST(o_orderdate AS TIMESTAMP) AS OrderDate,
      strftime(o_orderdate, {DAY}) AS dim_Date_OrderDate_bk, strftime(o_orderdate, {CLOCK}) AS dim_Time_OrderDate_bk
    FROM orders WHERE {members('o_orderkey', t)} AND {condition}"""


def event_rows(t: int = 1) -> str:
    value = "CASE WHEN event_id % 7 = 0 THEN value + 1 ELSE value END" if t == 2 else "value"
    props = "CASE WHEN event_id % 11 = 0 THEN NULL ELSE props END" if t == 2 else "props"
    time = "CASE WHEN event_id % 9 = 0 THEN {} ELSE {} END"
    return f"""SELECT 'WEB|' || event_id AS dim_Event_bk, 'WEB|' || user_id AS dim_User_bk, event_type AS EventType,
      {value} AS Value, {props} AS Props,
      {time.format(OPEN_END, 'ts')} AS EventTime,
      {time.format("'9999-12-31'", f'strftime(ts, {DAY})')} AS dim_Date_EventTime_bk,
      {time.format("'23:59:59'", f'strftime(ts, {CLOCK})')} AS dim_Time_EventTime_bk,
      {time.format('NULL', 'ts')} AS EventTimeOpt,
      {time.format('NULL', f'strftime(ts, {DAY})')} AS dim_Date_EventTimeOpt_bk,
      {time.format('NULL', f'strftime(ts, {CLOCK})')} AS dim_Time_EventTimeOpt_bk,
      CAST(ts AS DATE) AS EventDay, strftime(ts, {DAY}) AS dim_Date_EventDay_bk
    FROM events"""


CUSTOMER_DUMMY = "SELECT '-1', '-1', '-1', '#NA#', NULL, 0.0, '-1'"
ORDER_DUMMY = f"SELECT '-1', '-1', '-1', '-1', '-', NULL, 0.0, {OPEN_END}, '-1', '-1'"
EVENT_DUMMY = (
    f"SELECT '-1', '-1', '#NA#', 0.0, NULL, {OPEN_END}, '-1', '-1', NULL, '-1', '-1', DATE '9999-12-31', '-1'"
)

TABLES = {
    "customer": (CUSTOMER_COLUMNS, customer_rows, CUSTOMER_DUMMY, []),
    "order": (ORDER_COLUMNS, order_rows, ORDER_DUMMY, ["OrderDate"]),
    "event": (EVENT_COLUMNS, event_rows, EVENT_DUMMY, ["EventTime", "EventTimeOpt", "EventDay"]),
}


def with_dummy(name: str, t: int) -> str:
    _, rows, dummy, _ = TABLES[name]
    return f"{rows(min(t, 3))} UNION ALL {dummy}"


def staged(name: str, t: int, batch: int | None = None, dummy: bool = True) -> str:
    rows = with_dummy(name, t) if dummy else TABLES[name][1](t)
    return (
        f"SELECT *, CAST({batch or t} AS INTEGER) AS dwh_BatchRunIdInsert, CAST(0 AS INTEGER) AS dwh_DeleteFlag FROM ({rows})"
    )


def opened(prefix: str, columns: list[str], valid_from: str, batch: int, delete_flag: str) -> str:
    """Select list of a version that starts with a batch; loads run one hour after their month begins."""
    listed = ", ".join(f"{prefix}{c}" for c in columns)
    return f"""{listed}, TIMESTAMP '{valid_from}' AS dwh_ValidFrom, {OPEN_END} AS dwh_ValidTo,
      CAST(1 AS INTEGER) AS dwh_CurrentFlag, CAST({delete_flag} AS INTEGER) AS dwh_DeleteFlag,
      CAST(0 AS INTEGER) AS dwh_EarlyArriveFlag, '#NA#' AS dwh_EarlyArriveField,
      TIMESTAMP '2024-0{batch}-01 01:00:00' AS dwh_InsertDate, CAST(NULL AS TIMESTAMP) AS dwh_UpdateDate,
      CAST({batch} AS INTEGER) AS dwh_BatchRunIdInsert, CAST(NULL AS INTEGER) AS dwh_BatchRunIdUpdate"""


INIT = "1900-01-01 00:00:00"


def batches(name: str, last: int, null_safe: bool = False, deletes: bool = True) -> str:
    """WITH clause: s1..sn the staged snapshots, m2..mn the changed keys, d1..dn the table after each batch."""
    columns, _, _, _ = TABLES[name]
    bk = columns[0]
    differ = "{} IS DISTINCT FROM {}" if null_safe else "{} <> {}"
    tests = " OR ".join(differ.format(f"d.{c}", f"s.{c}") for c in columns)
    ctes = [
        f"s1 AS MATERIALIZED (SELECT *, 0 AS del FROM ({with_dummy(name, 1)}))",
        f"d1 AS MATERIALIZED (SELECT {opened('s.', columns, INIT, 1, '0')} FROM s1 s)",
    ]
    for n in range(2, last + 1):
        p = n - 1
        listed = ", ".join(f"d.{c}" for c in columns)
        gone = f"""
          UNION ALL SELECT {listed}, 1 AS del FROM d{p} d
          WHERE dwh_CurrentFlag = 1 AND dwh_DeleteFlag = 0 AND dwh_EarlyArriveFlag = 0
            AND NOT EXISTS (SELECT 1 FROM r{n} s WHERE s.{bk} = d.{bk})"""
        ends = f"m.{bk} IS NOT NULL AND d.dwh_CurrentFlag = 1"
        ctes += [
            f"r{n} AS MATERIALIZED ({with_dummy(name, n)})",
            f"s{n} AS MATERIALIZED (SELECT *, 0 AS del FROM r{n} {gone if deletes else ''})",
            f"""m{n} AS MATERIALIZED (SELECT s.* FROM d{p} d JOIN s{n} s ON s.{bk} = d.{bk}
              WHERE d.dwh_CurrentFlag = 1 AND ({tests} OR d.dwh_DeleteFlag <> s.del))""",
            f"""d{n} AS MATERIALIZED (
              SELECT {listed}, d.dwh_ValidFrom,
                CASE WHEN {ends} THEN TIMESTAMP '2024-0{n}-01 00:00:00' - INTERVAL 1 SECOND ELSE d.dwh_ValidTo END AS dwh_ValidTo,
                CASE WHEN {ends} THEN CAST(0 AS INTEGER) ELSE d.dwh_CurrentFlag END AS dwh_CurrentFlag,
                d.dwh_DeleteFlag, d.dwh_EarlyArriveFlag, d.dwh_EarlyArriveField, d.dwh_InsertDate,
                CASE WHEN {ends} THEN TIMESTAMP '2024-0{n}-01 01:00:00' ELSE d.dwh_UpdateDate END AS dwh_UpdateDate,
                d.dwh_BatchRunIdInsert,
                CASE WHEN {ends} THEN CAST({n} AS INTEGER) ELSE d.dwh_BatchRunIdUpdate END AS dwh_BatchRunIdUpdate
              FROM d{p} d LEFT JOIN m{n} m ON m.{bk} = d.{bk}
              UNION ALL SELECT {opened('m.', columns, f'2024-0{n}-01 00:00:00', n, 'm.del')} FROM m{n} m
              UNION ALL SELECT {opened('s.', columns, INIT, n, 's.del')} FROM s{n} s
              WHERE NOT EXISTS (SELECT 1 FROM d{p} d WHERE d.{bk} = s.{bk} AND d.dwh_CurrentFlag = 1))""",
        ]
    return "WITH " + ",\n".join(ctes)


def after(name: str, last: int, select: str, **options) -> str:
    times = TABLES[name][3] + AUDIT_TIMES
    return as_text(f"{batches(name, last, **options)} {select}", times)


# Sources and sinks -------------------------------------------------------------------------------
LINE_SOURCE = """SELECT l_orderkey || '|' || l_linenumber AS fct_LineItem_bk, 'TPCH' AS dim_SourceSystem_bk,
  'TPCH|' || l_orderkey AS dim_Order_bk,
  CASE WHEN l_partkey % 19 <> 0 THEN 'TPCH|' || l_partkey END AS dim_Part_bk,
  'TPCH|' || l_suppkey AS dim_Supplier_bk, CAST(l_linenumber AS SMALLINT) AS LineNumber,
  CASE WHEN l_linenumber <> 5 THEN l_quantity END AS Quantity, l_extendedprice AS ExtendedPrice, l_discount AS Discount,
  CASE WHEN l_linenumber <> 4 THEN l_tax END AS Tax,
  CASE WHEN l_linenumber <> 3 THEN l_returnflag END AS ReturnFlag,
  CASE WHEN l_linenumber <> 2 THEN l_linestatus END AS LineStatus,
  CASE WHEN l_partkey % 9 <> 0 THEN CAST(l_shipdate AS DATE) END AS ShipDate,
  CASE WHEN l_partkey % 9 <> 0
    THEN l_shipdate + to_hours(l_linenumber) + INTERVAL 30 MINUTE + INTERVAL 15 SECOND END AS ShipTime
  FROM lineitem"""
LINE_STAGED = f"""SELECT fct_LineItem_bk, dim_SourceSystem_bk, dim_Order_bk, coalesce(dim_Part_bk, '-1') AS dim_Part_bk,
  dim_Supplier_bk, LineNumber, coalesce(Quantity, 0) AS Quantity, ExtendedPrice, Discount, coalesce(Tax, 0) AS Tax,
  coalesce(ReturnFlag, '-') AS ReturnFlag, LineStatus,
  coalesce(CAST(ShipDate AS VARCHAR), '9999-12-31') AS ShipDate,
  coalesce(CAST(ShipDate AS VARCHAR), '9999-12-31') AS dim_Date_ShipDate_bk,
  coalesce(CAST(ShipTime AS VARCHAR), '9999-12-31 23:59:59') AS ShipTime,
  coalesce(strftime(ShipTime, {DAY}), '9999-12-31') AS dim_Date_ShipTime_bk,
  coalesce(strftime(ShipTime, {CLOCK}), '23:59:59') AS dim_Time_ShipTime_bk,
  CAST(1 AS INTEGER) AS dwh_BatchRunIdInsert, CAST(0 AS INTEGER) AS dwh_DeleteFlag FROM ({LINE_SOURCE})"""

ORACLES["source_shell"] = customer_rows(3)
ORACLES["conform_source"] = as_text(LINE_SOURCE, ["ShipDate", "ShipTime"])
ORACLES["metadata_filter"] = "SELECT conv_id, turn, text FROM conversations WHERE role = 'user' ORDER BY conv_id, turn"
ORACLES["staging_schema"] = LINE_STAGED
ORACLES["staging_full_load"] = LINE_STAGED
ORACLES["dwh_schema"] = after("order", 1, "SELECT * FROM d1")
ORACLES["archive_table"] = after("customer", 1, "SELECT * FROM d1")

# Projections -------------------------------------------------------------------------------------
EVENT_KEYS = [c for c in EVENT_COLUMNS if c.startswith(("dim_Date", "dim_Time"))]
ORACLES["cleanse_defaults"] = as_text(
    f"SELECT * EXCLUDE ({', '.join(EVENT_KEYS)}) FROM ({event_rows()})", TABLES["event"][3]
)
ORACLES["contract_projection"] = as_text(event_rows(), TABLES["event"][3])
# A nullable column without a value has no date or time part either
ORACLES["cleansed_view"] = as_text(event_rows(), TABLES["event"][3])
ORACLES["staging_with_dummy"] = as_text(staged("event", 1), TABLES["event"][3])
ORACLES["date_time_keys"] = (
    f"SELECT event_id, strftime(ts, {DAY}) AS dim_Date_ts_bk, strftime(ts, {CLOCK}) AS dim_Time_ts_bk FROM events"
)
ORACLES["date_keys_optional"] = as_text(
    "SELECT dim_Event_bk, EventTime, EventTimeOpt, dim_Date_EventTimeOpt_bk, dim_Time_EventTimeOpt_bk, EventDay,"
    " dim_Date_EventDay_bk, CAST(1 AS INTEGER) AS dwh_BatchRunIdInsert, CAST(0 AS INTEGER) AS dwh_DeleteFlag"
    f" FROM ({event_rows()})",
    TABLES["event"][3],
)


def all_types(explicit: dict[str, str]) -> str:
    """column -> (value, default of the type rule); the i-th column is null for line number i mod 7 + 1."""
    far = "TIMESTAMP '9999-12-31 23:59:59'"
    columns = {
        "InternalId": ("CAST(l_orderkey AS VARCHAR)", "'-1'"),
        "dim_Part_bk": ("l_partkey", "-1"),
        "ShortText": ("l_returnflag", "'-'"),
        "LongText": ("l_linestatus", "'#NA#'"),
        "FreeText": ("l_linestatus", "NULL"),
        "BigNumber": ("l_orderkey", "0"),
        "LineCount": ("CAST(l_linenumber AS INTEGER)", "0"),
        "SmallNumber": ("CAST(l_linenumber AS SMALLINT)", "0"),
        "Amount": ("l_quantity", "0"),
        "Price": ("l_extendedprice", "0"),
        "Rate": ("CAST(l_quantity AS FLOAT)", "0"),
        "ValidFrom": ("CAST(l_shipdate AS TIMESTAMP)", far),
        "active_since": ("CAST(l_shipdate AS TIMESTAMP)", "TIMESTAMP '1900-01-01 00:00:00'"),
        "ShipDate": ("CAST(l_shipdate AS DATE)", "DATE '9999-12-31'"),
        "insert_date": ("CAST(l_shipdate AS DATE)", "DATE '1900-01-01'"),
        "Hour": ("'12:30:00'", "'00:00:00'"),
        "IsOpen": ("l_linestatus = 'O'", "false"),
    }
    parts = ["l_orderkey || '|' || l_linenumber || '|' || l_partkey || '|' || l_suppkey AS row_bk"]
    for i, (name, (value, default)) in enumerate(columns.items()):
        chosen = explicit.get(name, default)
        parts.append(f"CASE WHEN l_linenumber = {i % 7 + 1} THEN {chosen} ELSE {value} END AS {name}")
    return as_text(f"SELECT {', '.join(parts)} FROM lineitem", ["ValidFrom", "active_since", "ShipDate", "insert_date"])


ORACLES["type_defaults"] = all_types({})
ORACLES["explicit_defaults"] = all_types(
    {
        "ShortText": "'n/a'",
        "FreeText": "'none'",
        "LineCount": "-1",
        "Price": "-0.5",
        "ValidFrom": "TIMESTAMP '2000-01-01 00:00:00'",
        "IsOpen": "true",
    }
)
ORACLES["dummy_row"] = f"""
WITH members AS ({with_dummy('customer', 1)}),
resolved AS (
  SELECT coalesce(m.dim_Customer_bk, '-1') AS bk, count(*) AS n
  FROM ({order_rows(3)}) o LEFT JOIN members m ON m.dim_Customer_bk = o.dim_Customer_bk GROUP BY 1)
SELECT coalesce(m.Segment, '-') AS Segment, CAST(sum(n) AS BIGINT) AS n_orders, count(*) AS n_members
FROM resolved r JOIN members m ON m.dim_Customer_bk = r.bk GROUP BY 1"""

# Comparison --------------------------------------------------------------------------------------
LISTED_ORDER = ", ".join(f"d.{c}" for c in ORDER_COLUMNS)
ORACLES["delete_detection"] = as_text(
    f"{batches('order', 2)} SELECT {', '.join(ORDER_COLUMNS)}, CAST(2 AS INTEGER) AS dwh_BatchRunIdInsert,"
    " CAST(1 AS INTEGER) AS dwh_DeleteFlag FROM s2 WHERE del = 1",
    ["OrderDate"],
)
ORACLES["staging_with_deletes"] = as_text(
    f"{batches('order', 2)} SELECT {', '.join(ORDER_COLUMNS)}, CAST(2 AS INTEGER) AS dwh_BatchRunIdInsert,"
    " CAST(del AS INTEGER) AS dwh_DeleteFlag FROM s2",
    ["OrderDate"],
)


def compared(null_safe: bool) -> str:
    differ = "{} IS DISTINCT FROM {}" if null_safe else "{} <> {}"
    tests = " OR ".join(differ.format(f"d.{c}", f"s.{c}") for c in EVENT_COLUMNS)
    return f"""SELECT s.dim_Event_bk, CAST(coalesce({tests}, false) AS INTEGER) AS changed
    FROM ({with_dummy('event', 1)}) d JOIN ({with_dummy('event', 2)}) s ON s.dim_Event_bk = d.dim_Event_bk"""


ORACLES["change_detection"] = compared(False)
ORACLES["change_detection_nullsafe"] = compared(True)
ORACLES["hash_diff"] = compared(True)
ORACLES["new_members"] = as_text(
    f"""SELECT * FROM ({staged('order', 2)}) s WHERE NOT EXISTS (
      SELECT 1 FROM ({with_dummy('order', 1)}) d WHERE d.dim_Order_bk = s.dim_Order_bk)""",
    ["OrderDate"],
)
ORACLES["merge_match"] = f"""SELECT d.dim_Order_bk, d.TotalPrice AS old_TotalPrice, s.TotalPrice AS new_TotalPrice
  FROM ({with_dummy('order', 1)}) d JOIN ({with_dummy('order', 2)}) s ON s.dim_Order_bk = d.dim_Order_bk"""

# Historization -----------------------------------------------------------------------------------
ORACLES["scd2_closed_versions"] = after("order", 2, "SELECT * FROM d2 WHERE dwh_BatchRunIdUpdate = 2")
ORACLES["scd2_new_versions"] = after(
    "order", 2, "SELECT * FROM d2 WHERE dwh_BatchRunIdInsert = 2 AND dwh_ValidFrom > TIMESTAMP '1900-01-01 00:00:00'"
)
ORACLES["scd2_initial_load"] = after(
    "order", 2, "SELECT * FROM d2 WHERE dwh_BatchRunIdInsert = 2 AND dwh_ValidFrom = TIMESTAMP '1900-01-01 00:00:00'"
)
ORACLES["scd2_apply"] = after("order", 2, "SELECT * FROM d2")
ORACLES["dwh_full_load"] = after("event", 1, "SELECT * FROM d1")
ORACLES["view_cur"] = after(
    "order", 2, "SELECT * FROM d2 WHERE dwh_CurrentFlag = 1 AND dwh_DeleteFlag = 0 AND dwh_EarlyArriveFlag = 0"
)
ORACLES["view_cid"] = after("order", 2, "SELECT * FROM d2 WHERE dwh_CurrentFlag = 1")
ORACLES["view_fhi"] = after("order", 2, "SELECT * FROM d2", null_safe=True)
NUMBERED = "SELECT *, row_number() OVER (ORDER BY dim_Order_bk, dwh_ValidFrom) AS dim_Order_sid FROM d2"
ORACLES["surrogate_keys"] = (
    f"{batches('order', 2)} SELECT dim_Order_sid, dim_Order_bk, CAST(dwh_ValidFrom AS VARCHAR) AS dwh_ValidFrom"
    f" FROM ({NUMBERED})"
)
ORACLES["check_sid_unique"] = (
    f"{batches('order', 2)} SELECT dim_Order_sid, CAST(2 AS BIGINT) AS n_rows FROM ({NUMBERED}) WHERE dwh_CurrentFlag = 0"
)

# Constraints -------------------------------------------------------------------------------------
COPIES = "CASE WHEN c_custkey % 97 = 0 THEN 2 ELSE 1 END"
ORACLES["check_not_null"] = f"""SELECT 'Name' AS column_name, 'TPCH|' || c_custkey AS bk
  FROM customer, range({COPIES}) WHERE c_custkey % 101 = 0"""
ORACLES["check_length"] = f"""SELECT 'Segment' AS column_name, 'TPCH|' || c_custkey AS bk
  FROM customer, range({COPIES}) WHERE c_custkey % 103 = 0 AND length(c_mktsegment || ' and more') > 10"""
ORACLES["check_unique_key"] = (
    "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1"
)

# Pipelines ---------------------------------------------------------------------------------------
ORACLES["pipeline_scd2"] = after("customer", 4, "SELECT * FROM d4")
ORACLES["pipeline_repeat"] = after("customer", 3, "SELECT * FROM d3")
ORACLES["pipeline_bucketed"] = after("customer", 3, "SELECT * FROM d3")
ORACLES["pipeline_collation"] = after(
    "customer",
    2,
    """SELECT * REPLACE (CASE WHEN dwh_BatchRunIdInsert = 2 AND dwh_DeleteFlag = 0 AND CAST(InternalId AS BIGINT) % 3 = 0
      THEN lower(dim_Customer_bk) || CASE WHEN CAST(InternalId AS BIGINT) % 5 = 0 THEN '  ' ELSE '' END
      ELSE dim_Customer_bk END AS dim_Customer_bk) FROM d2""",
)
ORACLES["pipeline_dependencies"] = f"""
  SELECT CAST(1 AS INTEGER) AS loaded_as, 'dim_Nation' AS table_name, 'TPCH|' || n_nationkey AS bk, CAST(0 AS INTEGER) AS dwh_DeleteFlag FROM nation
  UNION ALL SELECT 1, 'dim_Nation', '-1', 0
  UNION ALL SELECT 2, 'dim_Customer', dim_Customer_bk, 0 FROM ({with_dummy('customer', 1)})
  UNION ALL SELECT 3, 'dim_Order', dim_Order_bk, 0 FROM ({with_dummy('order', 1)})"""
ORACLES["pipeline_catalog_views"] = f"""{batches('customer', 2)}
  SELECT c.dim_Customer_bk, c.Segment, c.Balance, v.n_versions FROM d2 c
  JOIN (SELECT dim_Customer_bk, count(*) AS n_versions FROM d2 GROUP BY 1) v ON v.dim_Customer_bk = c.dim_Customer_bk
  WHERE c.dwh_CurrentFlag = 1 AND c.dwh_DeleteFlag = 0"""
ORACLES["pipeline_hash_keys"] = (
    f"{batches('customer', 2)} SELECT count(*) AS n_versions, count(*) AS n_keys, count(*) AS n_repeated FROM d2"
)
ORACLES["hash_keys"] = "SELECT count(*) AS n, count(*) AS n_keys, CAST(0 AS BIGINT) AS n_out, count(*) AS n_same FROM orders"
ORACLES["pipeline_dispatch"] = f"""{batches('customer', 2)}
  SELECT 'dim_Customer' AS table_name, dim_Customer_bk AS bk, dwh_CurrentFlag, dwh_DeleteFlag,
    CAST(dwh_ValidFrom AS VARCHAR) AS dwh_ValidFrom FROM d2
  UNION ALL SELECT 'dim_Event', dim_Event_bk, CAST(1 AS INTEGER), CAST(0 AS INTEGER), '{INIT}' FROM ({with_dummy('event', 2)})"""
ORACLES["chained_views"] = """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderstatus, count(*) AS n, max(o_orderkey) AS last
  FROM orders WHERE o_orderstatus <> 'P' GROUP BY ALL"""
ORACLES["publish_and_replace"] = """SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey % 2 = 0
  UNION ALL SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey % 3 = 1"""
PLACEHOLDER = f"""SELECT o.bk, '-1', '-1', '#NA#', NULL, 0, '-1', TIMESTAMP '2024-02-01 00:00:00',
  CASE WHEN r.dim_Customer_bk IS NULL THEN {OPEN_END} ELSE TIMESTAMP '2024-02-29 23:59:59' END,
  CAST(CASE WHEN r.dim_Customer_bk IS NULL THEN 1 ELSE 0 END AS INTEGER), 0, 1, 'dim_Customer_bk', TIMESTAMP '2024-02-01 01:00:00',
  CASE WHEN r.dim_Customer_bk IS NOT NULL THEN TIMESTAMP '2024-03-01 01:00:00' END, 2,
  CASE WHEN r.dim_Customer_bk IS NOT NULL THEN 3 END
  FROM early o LEFT JOIN ({customer_rows(3)}) r ON r.dim_Customer_bk = o.bk"""
ORACLES["pipeline_early_arriving"] = as_text(
    f"""WITH known AS ({with_dummy('customer', 1)}),
    early AS (SELECT DISTINCT 'TPCH|' || o_custkey AS bk FROM orders
      WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.dim_Customer_bk = 'TPCH|' || o_custkey)),
    fresh AS (SELECT * FROM ({customer_rows(3)}) r WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.dim_Customer_bk = r.dim_Customer_bk))
    SELECT {opened('k.', CUSTOMER_COLUMNS, INIT, 1, '0')} FROM known k
    UNION ALL {PLACEHOLDER}
    UNION ALL SELECT {opened('f.', CUSTOMER_COLUMNS, '2024-03-01 00:00:00', 3, '0')} FROM fresh f WHERE f.dim_Customer_bk IN (SELECT bk FROM early)
    UNION ALL SELECT {opened('f.', CUSTOMER_COLUMNS, INIT, 3, '0')} FROM fresh f WHERE f.dim_Customer_bk NOT IN (SELECT bk FROM early)""",
    AUDIT_TIMES,
)
ORACLES["pipeline_full_reload"] = as_text(
    f"SELECT {opened('s.', EVENT_COLUMNS, INIT, 2, '0')} FROM ({with_dummy('event', 2)}) s", TABLES["event"][3] + AUDIT_TIMES
)
ORACLES["pipeline_psa"] = after("order", 2, "SELECT * FROM d2 WHERE dwh_CurrentFlag = 1", deletes=False)

# Further load patterns ---------------------------------------------------------------------------
ORACLES["early_arriving"] = after(
    "customer",
    1,
    """SELECT * FROM d1 UNION ALL
    SELECT o.bk, '-1', '-1', '#NA#', NULL, 0, '-1', TIMESTAMP '2024-02-01 00:00:00', TIMESTAMP '9999-12-31 23:59:59',
      1, 0, 1, 'dim_Customer_bk', TIMESTAMP '2024-02-01 01:00:00', NULL, 2, NULL
    FROM (SELECT DISTINCT 'TPCH|' || o_custkey AS bk FROM orders) o
    WHERE NOT EXISTS (SELECT 1 FROM d1 WHERE d1.dim_Customer_bk = o.bk)""",
)
LAST_EVENT = "TIMESTAMP '2024-01-15 00:00:00'"
ORACLES["delta_load"] = as_text(
    f"SELECT * REPLACE (CASE WHEN event_id % 50 <> 0 THEN ts END AS ts) FROM events WHERE event_id % 50 = 0 OR ts > {LAST_EVENT}",
    ["ts"],
)
ORACLES["delta_boundary"] = as_text(
    "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders WHERE o_orderdate > TIMESTAMP '1998-01-01 00:00:00'"
    " OR (o_orderdate = TIMESTAMP '1998-01-01 00:00:00' AND o_orderkey % 2 <> 0)",
    ["o_orderdate"],
)
ORACLES["delta_trigger"] = (
    f"SELECT CAST(coalesce(max(ts), {LAST_EVENT}) AS VARCHAR) AS next_trigger, count(*) AS n_rows"
    f" FROM events WHERE ts > {LAST_EVENT}"
)


def scd1(rows: str) -> str:
    """Update in place and insert, on the orders of the first delivery; null-safe comparison."""
    tests = " OR ".join(f"d.{c} IS DISTINCT FROM s.{c}" for c in ORDER_COLUMNS)
    picked = ", ".join(f"CASE WHEN u THEN s_{c} ELSE d_{c} END AS {c}" for c in ORDER_COLUMNS)
    both = ", ".join(f"d.{c} AS d_{c}, s.{c} AS s_{c}" for c in ORDER_COLUMNS)
    return f"""WITH d AS MATERIALIZED ({with_dummy('order', 1)}), s AS MATERIALIZED ({rows}),
    j AS MATERIALIZED (SELECT {both}, d.dim_Order_bk IS NULL AS fresh,
      s.dim_Order_bk IS NOT NULL AND (d.dim_Order_bk IS NULL OR {tests}) AS u
      FROM d FULL JOIN s ON s.dim_Order_bk = d.dim_Order_bk)
    SELECT {picked}, TIMESTAMP '{INIT}' AS dwh_ValidFrom, {OPEN_END} AS dwh_ValidTo, CAST(1 AS INTEGER) AS dwh_CurrentFlag,
      CAST(0 AS INTEGER) AS dwh_DeleteFlag, CAST(0 AS INTEGER) AS dwh_EarlyArriveFlag, '#NA#' AS dwh_EarlyArriveField,
      CASE WHEN fresh THEN TIMESTAMP '2024-02-01 01:00:00' ELSE TIMESTAMP '2024-01-01 01:00:00' END AS dwh_InsertDate,
      CASE WHEN u AND NOT fresh THEN TIMESTAMP '2024-02-01 01:00:00' END AS dwh_UpdateDate,
      CAST(CASE WHEN fresh THEN 2 ELSE 1 END AS INTEGER) AS dwh_BatchRunIdInsert,
      CAST(CASE WHEN u AND NOT fresh THEN 2 END AS INTEGER) AS dwh_BatchRunIdUpdate FROM j"""


ORDER_TIMES = ["OrderDate"] + AUDIT_TIMES
ORACLES["scd1_merge"] = as_text(scd1(with_dummy("order", 2)), ORDER_TIMES)
ORACLES["scd1_delta_upsert"] = as_text(
    scd1(order_rows(2, "o_orderdate > TIMESTAMP '1998-01-01 00:00:00'")), ORDER_TIMES
)
ORACLES["pipeline_scd1"] = ORACLES["scd1_merge"]
# Orders with the highest date of the batch before are late ones if that batch did not have their key
REACHED = {
    1: "SELECT max(o_orderdate) FROM orders WHERE o_orderkey % 20 <> 0 AND o_orderdate <= TIMESTAMP '1998-01-01 00:00:00'",
    2: "SELECT max(o_orderdate) FROM orders WHERE o_orderkey % 13 <> 0",
}
ORACLES["pipeline_scd1_delta"] = as_text(
    f"""SELECT {opened('d.', ORDER_COLUMNS, INIT, 1, '0')}
      FROM ({order_rows(1, "o_orderdate <= TIMESTAMP '1998-01-01 00:00:00'")} UNION ALL {ORDER_DUMMY}) d
    UNION ALL SELECT {opened('s.', ORDER_COLUMNS, INIT, 2, '0')}
      FROM ({order_rows(2, f"(o_orderdate > ({REACHED[1]}) OR (o_orderdate = ({REACHED[1]}) AND o_orderkey % 20 = 0))")}) s
    UNION ALL SELECT {opened('t.', ORDER_COLUMNS, INIT, 3, '0')}
      FROM ({order_rows(3, f"(o_orderdate > ({REACHED[2]}) OR (o_orderdate = ({REACHED[2]}) AND o_orderkey % 13 = 0))")}) t""",
    ORDER_TIMES,
)
SECOND = order_rows(2, "o_orderdate > TIMESTAMP '1997-06-30 23:59:59' AND o_orderdate <= TIMESTAMP '1999-06-30 23:59:59'")
ORACLES["pipeline_scd1_overlap"] = as_text(
    f"""WITH s AS MATERIALIZED ({SECOND}), span AS (SELECT min(OrderDate) AS low, max(OrderDate) AS high FROM s)
    SELECT {opened('d.', ORDER_COLUMNS, INIT, 1, '0')} FROM ({with_dummy('order', 1)}) d, span
      WHERE NOT OrderDate BETWEEN low AND high
    UNION ALL SELECT {opened('s.', ORDER_COLUMNS, INIT, 2, '0')} FROM s""",
    ORDER_TIMES,
)
OVERLAP = "BETWEEN TIMESTAMP '1997-07-01 00:00:00' AND TIMESTAMP '1999-06-30 23:59:59'"
ORACLES["scd1_overlap_replace"] = as_text(
    f"""SELECT {opened('d.', ORDER_COLUMNS, INIT, 1, '0')} FROM ({with_dummy('order', 1)}) d
    WHERE NOT OrderDate {OVERLAP}
    UNION ALL SELECT {opened('s.', ORDER_COLUMNS, INIT, 2, '0')} FROM ({order_rows(2)}) s WHERE OrderDate {OVERLAP}""",
    ORDER_TIMES,
)
RECENT = "o_orderdate >= TIMESTAMP '1998-01-01 00:00:00'"
ORACLES["partition_switch"] = as_text(
    f"""SELECT *, CAST(1 AS INTEGER) AS dwh_BatchRunIdInsert, CAST(0 AS INTEGER) AS dwh_DeleteFlag,
      CAST(year(OrderDate) AS INTEGER) AS order_year FROM ({order_rows(1, f'NOT ({RECENT})')})
    UNION ALL SELECT *, 2, 0, CAST(year(OrderDate) AS INTEGER) FROM ({order_rows(2, RECENT)})""",
    ["OrderDate"],
)

ORACLES["pipeline_partitions"] = ORACLES["partition_switch"].replace("SELECT * REPLACE", "SELECT * EXCLUDE (order_year) REPLACE")

# Derivations -------------------------------------------------------------------------------------
ORACLES["composite_bk"] = """SELECT l_orderkey, l_linenumber, 'TPCH|' || l_orderkey || '|' || l_linenumber || '|' ||
  CASE WHEN l_partkey % 19 = 0 THEN '-1' ELSE CAST(l_partkey AS VARCHAR) END AS line_bk FROM lineitem"""
ORACLES["padded_id"] = "SELECT o_orderkey, lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS InternalId FROM orders"
STAYS = """(SELECT o_orderkey, CASE WHEN o_custkey % 17 = 0 THEN NULL ELSE o_custkey END AS group_key,
  o_orderpriority AS kind, CAST(o_orderdate AS DATE) AS start_date,
  CAST(o_orderdate AS DATE) + CAST(o_orderkey % 90 AS INTEGER) AS end_date FROM orders)"""
DAYS = "date_diff('day', start_date, end_date) + 1"
ORACLES["length_of_stay"] = f"SELECT o_orderkey, CAST({DAYS} AS INTEGER) AS LengthOfStayInDays FROM {STAYS}"
ORACLES["consolidated_sum"] = f"""SELECT group_key, CAST(sum({DAYS}) AS BIGINT) AS LengthOfStayInDays, count(*) AS n_rows
  FROM {STAYS} WHERE group_key IS NOT NULL GROUP BY group_key"""
PLACE = "row_number() OVER (PARTITION BY group_key ORDER BY start_date {0}, o_orderkey {0})"
ORACLES["first_last_flags"] = f"""SELECT o_orderkey,
  CASE WHEN group_key IS NULL THEN '-1' WHEN {PLACE.format('ASC')} = 1 THEN '1' ELSE '0' END AS IsFirst_Flag,
  CASE WHEN group_key IS NULL THEN '-1' WHEN {PLACE.format('DESC')} = 1 THEN '1' ELSE '0' END AS IsLast_Flag
  FROM {STAYS}"""
ORACLES["current_of_sequence"] = f"""SELECT o_orderkey, CASE
  WHEN TIMESTAMP '1999-06-01 00:00:00' BETWEEN start_date AND until THEN '1'
  WHEN max(until) OVER (PARTITION BY group_key, kind) < TIMESTAMP '1999-06-01 00:00:00' AND row_number() OVER (
    PARTITION BY group_key, kind ORDER BY start_date DESC, until DESC, o_orderkey DESC) = 1 THEN '1'
  ELSE '0' END AS Current_flag
  FROM (SELECT *, CASE WHEN o_orderkey % 13 = 0 THEN DATE '9999-12-31' ELSE end_date END AS until FROM {STAYS})"""
ORACLES["durations"] = """SELECT event_id, date_sub('second', ts, e) AS duration_seconds, date_sub('minute', ts, e) AS duration_minutes,
  date_sub('hour', ts, e) AS duration_hours, date_sub('day', ts, e) AS duration_days
  FROM (SELECT event_id, ts, ts + to_seconds(user_id * 37) AS e FROM events)"""
ORACLES["planned_vs_actual"] = """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, date_sub('minute',
  l_shipdate + to_days(4 - l_linenumber) + to_hours(CAST(l_quantity AS BIGINT)) + INTERVAL 7 MINUTE + INTERVAL 30 SECOND,
  l_shipdate) AS movement_minutes FROM lineitem"""
ORACLES["parent_child_days"] = """SELECT l_orderkey, l_linenumber, l_partkey,
  CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS INTEGER) AS days_between
  FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey"""

LENGTHS = (1, 3, 4, 5, 7)


def _code_levels() -> str:
    padded = "lpad(CAST(p_partkey AS VARCHAR), 7, '0')"
    prefixes = " UNION ALL ".join(f"SELECT left({padded}, {n}) AS code, p_name FROM part" for n in LENGTHS)
    columns, joins = [], []
    for i, n in enumerate(LENGTHS):
        reached = f"length(c.code) >= {n}"
        columns.append(f"CASE WHEN {reached} THEN left(c.code, {n}) ELSE '-1' END AS CodeLevel{i:02d}")
        columns.append(f"coalesce(n{i}.name, '#NA#') AS Level{i:02d}")
        joins.append(f"LEFT JOIN codes n{i} ON {reached} AND n{i}.code = left(c.code, {n})")
    level = " ".join(f"WHEN {n} THEN {i}" for i, n in enumerate(LENGTHS))
    return f"""WITH codes AS (SELECT code, min(p_name) AS name FROM ({prefixes}) GROUP BY code)
    SELECT c.code, c.name, CAST(CASE length(c.code) {level} END AS INTEGER) AS LevelNumber, {', '.join(columns)}
    FROM codes c {' '.join(joins)}"""


ORACLES["code_levels"] = _code_levels()
EDGES = """edges AS (
  SELECT 'N' || n_nationkey AS child, 'R' || n_regionkey AS parent, n_name AS name FROM nation
  UNION ALL SELECT 'C' || c_custkey, 'N' || c_nationkey, c_name FROM customer
  UNION ALL SELECT 'O' || o_orderkey, 'C' || o_custkey, CAST(o_orderkey AS VARCHAR) FROM orders
  UNION ALL SELECT 'O' || o_orderkey, 'P' || o_orderpriority, CAST(o_orderkey AS VARCHAR) FROM orders)"""
ORACLES["hierarchy_closure"] = f"""WITH RECURSIVE {EDGES},
walk AS (SELECT parent AS ancestor, child AS descendant, 1 AS depth FROM edges
  UNION ALL SELECT w.ancestor, e.child, w.depth + 1 FROM walk w JOIN edges e ON e.parent = w.descendant)
SELECT ancestor, descendant, CAST(min(depth) AS INTEGER) AS depth,
  CASE WHEN ancestor IN (SELECT child FROM edges) THEN '0' ELSE '1' END AS root_flag,
  CASE WHEN descendant IN (SELECT parent FROM edges) THEN '0' ELSE '1' END AS leaf_flag
FROM walk GROUP BY ancestor, descendant"""


def _flatten(levels: int) -> str:
    columns = ", ".join(
        f"codes[{i + 1}] AS CodeLevel{i:02d}, names[{i + 1}] AS Level{i:02d}" for i in range(levels)
    )
    nothing = ", ".join("NULL" for _ in range(2 * levels))
    return f"""WITH RECURSIVE {EDGES},
    links AS (
      SELECT child, parent, CASE WHEN child NOT IN ('N0', 'N7', 'N14', 'N21') THEN name END AS name FROM edges
      UNION ALL SELECT 'S' || s_suppkey, 'Q' || s_nationkey, s_name FROM supplier),
    walk AS (
      SELECT node, 0 AS level, [node] AS codes, [name] AS names FROM (
        SELECT 'R' || r_regionkey AS node, r_name AS name FROM region
        UNION SELECT DISTINCT 'P' || o_orderpriority, o_orderpriority FROM orders)
      UNION ALL SELECT e.child, w.level + 1, list_append(w.codes, e.child), list_append(w.names, e.name)
      FROM walk w JOIN links e ON e.parent = w.node)
    SELECT node, CAST(level AS INTEGER) AS LevelNumber,
      array_to_string(list_transform(names, lambda x: coalesce(x, '#NA#')), '|') AS TreeVector, {columns} FROM walk
    UNION ALL SELECT node, NULL, NULL, {nothing} FROM (SELECT child AS node FROM links UNION SELECT parent FROM links)
      WHERE node NOT IN (SELECT node FROM walk)"""


ORACLES["hierarchy_flatten"] = _flatten(5)
ORACLES["code_mapping"] = """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, coalesce('N|' || s_nationkey, '-1') AS code
  FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey AND s_acctbal >= 0"""
ORACLES["unit_recalculation"] = """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
  CASE WHEN p_size % 3 > 1 OR p_partkey % 4 > 1 THEN NULL ELSE l_quantity * (p_size * 0.5) END AS StandardValue
  FROM lineitem LEFT JOIN part ON p_partkey = l_partkey"""
ORACLES["year_month_dim"] = """SELECT CAST(year(m) * 100 + month(m) AS INTEGER) AS dim_YearMonth_bk,
  CAST(year(m) * 100 + month(m) AS INTEGER) AS YearMonth,
  ['Januar', 'Februar', 'März', 'April', 'Mai', 'Juni', 'Juli', 'August', 'September', 'Oktober', 'November',
   'Dezember'][month(m)] AS Month, CAST(month(m) AS INTEGER) AS MonthNumber, CAST(year(m) AS INTEGER) AS Year
  FROM (SELECT unnest(generate_series(date_trunc('month', min(o_orderdate)), max(o_orderdate), INTERVAL 1 MONTH)) AS m
    FROM orders)"""
ORACLES["nest_children"] = """SELECT conv_id, CAST(part_no AS INTEGER) AS part_no, CAST(count(*) AS INTEGER) AS n_children,
  string_agg(turn || ':' || role || ':' || text, chr(10) ORDER BY pos) AS turns
  FROM (SELECT *, (pos - 1) // 4 AS part_no FROM (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS pos FROM conversations))
  GROUP BY conv_id, part_no"""
ORACLES["numbered_children"] = """SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS position,
  turn, role, text FROM conversations"""
