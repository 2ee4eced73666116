import json
from collections import Counter

import pytest
from pyspark.sql import types as T

from histora import ColumnSpec, ContractError, TableSpec
from histora.functions.defaults import default_text, default_value
from histora.sources import load_contract, load_contracts, read_contracts

PATIENT = {
    "table_name": "dim_Patient",
    "columns": [
        {"column_name": "dim_Patient_bk", "data_type": "nvarchar(56)", "mandatory": "NOT NULL", "bk": 1, "pk": 1},
        {"column_name": "dim_SourceSystem_bk", "data_type": "nvarchar(5)", "mandatory": "NOT NULL"},
        {"column_name": "InternalId", "data_type": "nvarchar(50)", "mandatory": "NOT NULL"},
        {"column_name": "FirstName", "data_type": "nvarchar(255)", "mandatory": "NOT NULL"},
        {"column_name": "LastName", "data_type": "nvarchar(255)", "mandatory": "NOT NULL"},
        {"column_name": "BirthDate", "data_type": "datetime", "mandatory": "NULL"},
        {"column_name": "dim_Country_ResidenceCountry_bk", "data_type": "nvarchar(5)", "mandatory": "NOT NULL"},
        {"column_name": "GestationalAgeInDays", "data_type": "integer", "mandatory": "NULL"},
    ],
}


def patient() -> TableSpec:
    return TableSpec.from_dict(PATIENT).validate().with_defaults()


def test_small_contract():
    spec = patient()
    assert spec.bk == "dim_Patient_bk" and spec.pk == ["dim_Patient_bk"]
    assert [default_value(c) for c in spec.columns] == ["-1", "-1", "-1", "#NA#", "#NA#", None, "-1", None]
    names = spec.staging_columns()
    assert names[names.index("BirthDate") + 1 :][:2] == ["dim_Date_BirthDate_bk", "dim_Time_BirthDate_bk"]
    assert spec.staging_schema().fieldNames()[-2:] == ["dwh_BatchRunIdInsert", "dwh_DeleteFlag"]
    assert spec.warehouse_columns()[0] == "dim_Patient_sid" and len(spec.warehouse_columns()) == 1 + 10 + 10
    assert spec.warehouse_schema()["dim_Date_BirthDate_bk"].nullable


@pytest.mark.parametrize(
    "name, declared, expected",
    [
        ("x_bk", "integer", "'-1'"),
        ("InternalId", "bigint", "'-1'"),
        ("Code", "nvarchar(5)", "'-'"),
        ("Code", "nvarchar(6)", "'#NA#'"),
        ("Code", "varchar(1)", "'-'"),
        ("N", "bigint", "0"),
        ("N", "decimal(10,3)", "0"),
        ("N", "real", "0"),
        ("ValidFrom", "datetime", "'9999-12-31 23:59:59'"),
        ("valid_from", "datetime", "'1900-01-01 00:00:00'"),
        ("active_since", "date", "'1900-01-01'"),
        ("ValidTo", "date", "'9999-12-31'"),
        ("T", "time", "'00:00:00'"),
        ("B", "boolean", "false"),
    ],
)
def test_default_rule(name, declared, expected):
    assert default_text(ColumnSpec(name, declared)) == expected
    assert default_text(ColumnSpec(name, declared, mandatory=False)) == "NULL"


def test_case_insensitive_names_are_an_option():
    column = ColumnSpec("ValidFrom", "datetime")
    assert default_text(column, case_insensitive_names=True) == "'1900-01-01 00:00:00'"


def test_declared_default_wins():
    spec = TableSpec("t", (ColumnSpec("t_bk", "int", bk=True, default="7"), ColumnSpec("c", "int"))).with_defaults()
    assert Counter(c.default for c in spec.columns) == {"7": 1, "0": 1}


def test_types():
    assert ColumnSpec("c", "decimal(10,3)").spark_type == T.DecimalType(10, 3)
    assert ColumnSpec("c", "nvarchar(12)").fields()[0].metadata == {"length": 12}
    with pytest.raises(ContractError):
        ColumnSpec("c", "N/A").spark_type


def test_defective_contracts():
    with pytest.raises(ContractError, match="business key"):
        TableSpec("t", (ColumnSpec("a", "int"),)).validate()
    with pytest.raises(ContractError, match="twice"):
        TableSpec("t", (ColumnSpec("a", "int", bk=True), ColumnSpec("A", "int"))).validate()
    raw = {"table_name": "t", "columns": [{"column_name": "k", "data_type": "int", "bk": 1}, {"column_name": "x", "data_type": "N/A"}]}
    with pytest.raises(ContractError, match="N/A"):
        TableSpec.from_dict(raw)
    with pytest.warns(UserWarning):
        spec = TableSpec.from_dict(raw, on_unknown_type="skip")
    assert spec.skipped == ("x",) and spec.contract_columns() == ["k"]


def test_last_business_key_counts():
    spec = TableSpec("t", (ColumnSpec("a", "int", bk=True), ColumnSpec("b", "int", bk=True)))
    assert spec.bk == "b"


def test_collation_of_the_model():
    asked = ColumnSpec("c", "nvarchar(9)", extended="{0},ExtCollation,28=SQL_Latin1_General_CP1_CS_AS")
    assert asked.collation == "UTF8_BINARY_RTRIM"
    assert ColumnSpec("c", "nvarchar(9)").collation is None


def test_contract_files(tmp_path):
    (tmp_path / "dim_Patient.json").write_text(json.dumps(PATIENT))
    (tmp_path / "dim_Bad.yml").write_text("table_name: dim_Bad\ncolumns:\n- column_name: a\n  data_type: int\n")
    assert load_contract(tmp_path / "dim_Patient.json") == patient()
    specs, errors = load_contracts(tmp_path)
    assert [s.name for s in specs] == ["dim_Patient"] and "business key" in errors["dim_Bad"]


def test_repository(spark):
    tables = spark.createDataFrame(
        [("dwh", "dim_A", "CORE", 1, 1, 0, 0, None, None, None), ("dwh", "dim_B", "EDGE", 0, 0, 1, 1, "x", "d", "f")],
        "SchemaName string, TableName string, TableArea string, IsScd2HistoryTable int, HasDeleteDetection int,"
        " HasDummyRecord int, IsDeltaLoad int, DeltaLoadType string, DeltaColumnName string, DeltaFilterExpression string",
    )
    columns = spark.createDataFrame(
        [
            ("dwh", "dim_A", "Note", None, "nvarchar(20)", 2, "NULL", 0, 1, None),
            ("dwh", "dim_A", "dim_A_bk", None, "nvarchar(20)", 1, "NOT NULL", 1, 1, None),
            ("dwh", "dim_B", "dim_B_bk", None, "int", 1, "1", 1, 1, "dim_A"),
        ],
        "SchemaName string, TableName string, ColumnName string, Description string, DataType string, ColumnOrder int,"
        " IsMandatory string, IsBk int, HasDateDimension int, EarlyArriveParentTable string",
    )
    (core,) = read_contracts(tables, columns, "CORE")
    assert core.contract_columns() == ["dim_A_bk", "Note"] and core.delete_detection and not core.dummy
    (edge,) = read_contracts(tables, columns, "EDGE")
    assert edge.table_type == "full_load" and edge.delta_column == "d" and edge.columns[0].early_arrive_parent == "dim_A"
