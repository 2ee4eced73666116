"""Where contracts come from: files in the declared form, or the two tables of a metadata repository."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histora.spec import ContractError, TableSpec


def load_contract(path: str | Path, on_unknown_type: str = "reject") -> TableSpec:
    """One contract from a YAML or JSON file, validated, with its defaults filled in."""
    path = Path(path)
    text = path.read_text(encoding="utf-8-sig")
    if path.suffix == ".json":
        data = json.loads(text)
    else:
        try:
            import yaml
        except ImportError as error:
            raise ContractError("reading YAML contracts needs PyYAML; JSON works without it") from error
        data = yaml.safe_load(text)
    return TableSpec.from_dict(data, on_unknown_type).validate().with_defaults()


def load_contracts(folder: str | Path, on_unknown_type: str = "reject") -> tuple[list[TableSpec], dict[str, str]]:
    """All contracts of a folder. Defective ones do not stop the others: they come back with their error."""
    specs, errors = [], {}
    for path in sorted(p for p in Path(folder).iterdir() if p.suffix in (".yml", ".yaml", ".json")):
        try:
            specs.append(load_contract(path, on_unknown_type))
        except ContractError as error:
            errors[path.stem] = str(error)
    return specs, errors


def select_rows(df: DataFrame, condition: Column, columns: list[str], order_by: list[str]) -> DataFrame:
    """Filtered, projected and ordered read; the filter and the columns reach the scan."""
    return df.filter(condition).select(*columns).orderBy(*order_by)


def read_contracts(tables: DataFrame, columns: DataFrame, area: str) -> list[TableSpec]:
    """Contracts of one table area from the repository's table and column lists.

    The lists describe tables, so they are small however large the tables are.
    """
    wanted = tables.filter(F.col("TableArea") == area)
    rows = select_rows(
        columns.join(wanted.select("SchemaName", "TableName"), ["SchemaName", "TableName"], "left_semi"),
        F.lit(True),
        columns.columns,
        ["SchemaName", "TableName", "ColumnOrder"],
    )
    children: dict[tuple[str, str], list[dict]] = {}
    for row in rows.toLocalIterator():
        children.setdefault((row["SchemaName"], row["TableName"]), []).append(
            {
                "column_name": row["ColumnName"],
                "data_type": row["DataType"],
                "mandatory": _mandatory(row["IsMandatory"]),
                "bk": row["IsBk"],
                "date_dim": row["HasDateDimension"],
                "description": row["Description"],
                "early_arrive_parent": row["EarlyArriveParentTable"],
            }
        )
    specs = []
    for row in wanted.orderBy("SchemaName", "TableName").toLocalIterator():
        found = children.get((row["SchemaName"], row["TableName"]))
        if not found:
            continue
        specs.append(
            TableSpec.from_dict(
                {
                    "table_name": row["TableName"],
                    "table_type": "scd2" if int(row["IsScd2HistoryTable"]) == 1 else "full_load",
                    "delete_detection": row["HasDeleteDetection"],
                    "dummy": row["HasDummyRecord"],
                    "delta_load": row["IsDeltaLoad"],
                    "delta_type": row["DeltaLoadType"],
                    "delta_column": row["DeltaColumnName"],
                    "delta_filter": row["DeltaFilterExpression"],
                    "area": row["TableArea"],
                    "columns": found,
                }
            )
            .validate()
            .with_defaults()
        )
    return specs


def _mandatory(value: object) -> str:
    """The repository may hold the declared text or a 0/1 flag."""
    return "NULL" if str(value).strip().upper() in ("NULL", "0", "FALSE") else "NOT NULL"
