"""The three ways to read a warehouse table, as views of this session or of the catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from histora.operators.staging import is_current_member, is_current_version
from histora.spec import DELETE_FLAG, EARLY_FLAG, TableSpec, quoted, ref


def _columns(dwh: DataFrame, spec: TableSpec) -> DataFrame:
    return dwh.select(*[ref(n) for n in spec.warehouse_columns(with_sid=spec.sid in dwh.columns)])


def view_cur(dwh: DataFrame, spec: TableSpec) -> DataFrame:
    """Current versions of existing members."""
    return _columns(dwh.filter(is_current_member()), spec)


def view_cid(dwh: DataFrame, spec: TableSpec) -> DataFrame:
    """Current versions, deleted and early members included."""
    return _columns(dwh.filter(is_current_version()), spec)


def view_fhi(dwh: DataFrame, spec: TableSpec) -> DataFrame:
    """Full history."""
    return _columns(dwh, spec)


VIEWS = {"cur": view_cur, "cid": view_cid, "fhi": view_fhi}
#: How the views choose from the state view of a stored table
_CHOICE = {
    "cur": f"NOT dwh_past AND {DELETE_FLAG} = 0 AND {EARLY_FLAG} = 0",
    "cid": "NOT dwh_past",
    "fhi": "TRUE",
}


def publish_views(spark: SparkSession, spec: TableSpec, state_sql: str) -> list[str]:
    """(Re)create the reporting views of a table in the catalog, where other sessions find them and still do after this one ends.

    state_sql: the rows of all versions, and dwh_past for those that are closed. It is the only thing that a batch changes: one
    statement replaces the view over it, and all reporting views, which are defined on that view once, move together.
    """
    state = f"v_{spec.name}_state"
    spark.sql(f"CREATE OR REPLACE VIEW {quoted(state)} AS {state_sql}")
    names, columns = [], ", ".join(quoted(n) for n in spec.warehouse_columns())
    for suffix, choice in _CHOICE.items():
        name = f"v_{spec.name}_{suffix}"
        text = f"SELECT {columns} FROM {quoted(state)} WHERE {choice}"
        if _definition(spark, name) != text:
            spark.sql(f"CREATE OR REPLACE VIEW {quoted(name)} AS {text}")
        names.append(name)
    return names


def _definition(spark: SparkSession, name: str) -> str | None:
    """The text of a view in the catalog; None if there is none."""
    database = spark.catalog.currentDatabase()
    if not spark.sql(f"SHOW VIEWS IN {quoted(database)} LIKE '{name.lower()}'").filter("NOT isTemporary").count():
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(database)}.{quoted(name)}").filter("col_name = 'View Text'").collect()
    return rows[0]["data_type"] if rows else None


def register_views(dwh: DataFrame, spec: TableSpec) -> list[str]:
    """(Re)create the reporting views of a table; readers of the old ones are not disturbed."""
    names = []
    for suffix, view in VIEWS.items():
        name = f"v_{spec.name}_{suffix}"
        view(dwh, spec).createOrReplaceTempView(f"`{name}`")
        names.append(name)
    return names
