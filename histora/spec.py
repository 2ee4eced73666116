"""Table contracts: the declared columns, keys and load flags of one table.

A contract lives on the driver and is small (at most a few dozen columns). Every operator takes it as
its configuration and returns a lazy DataFrame.
"""

from __future__ import annotations

import re
import warnings
from dataclasses import dataclass, field, replace
from typing import Any, Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


class ContractError(ValueError):
    """The contract cannot be loaded as declared."""


_FIXED_TYPES: dict[str, T.DataType] = {
    "datetime": T.TimestampNTZType(),
    "bigint": T.LongType(),
    "date": T.DateType(),
    "integer": T.IntegerType(),
    "int": T.IntegerType(),
    "smallint": T.ShortType(),
    "float": T.DoubleType(),
    "real": T.FloatType(),
    "number": T.DecimalType(38, 10),
    "boolean": T.BooleanType(),
    # Spark tables take no TIME columns by default, so a time of day is kept as HH:mm:ss text
    "time": T.StringType(),
}
_CHARS = re.compile(r"^n?varchar\s*\(\s*(\d+)\s*\)$")
_DECIMAL = re.compile(r"^(?:decimal|number|numeric)\s*\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\)$")
_COLLATION = re.compile(r"ExtCollation,\d+=\S*?_(CI|CS)_")

# Fixed values of the warehouse layout
BATCH_INSERT = "dwh_BatchRunIdInsert"
BATCH_UPDATE = "dwh_BatchRunIdUpdate"
DELETE_FLAG = "dwh_DeleteFlag"
CURRENT_FLAG = "dwh_CurrentFlag"
EARLY_FLAG = "dwh_EarlyArriveFlag"
EARLY_FIELD = "dwh_EarlyArriveField"
VALID_FROM = "dwh_ValidFrom"
VALID_TO = "dwh_ValidTo"
INSERT_DATE = "dwh_InsertDate"
UPDATE_DATE = "dwh_UpdateDate"
OPEN_END = "9999-12-31 23:59:59"
BEGINNING = "1900-01-01 00:00:00"
UNKNOWN_KEY = "-1"
UNKNOWN_TEXT = "#NA#"

STAGING_AUDIT = [
    T.StructField(BATCH_INSERT, T.IntegerType(), False),
    T.StructField(DELETE_FLAG, T.IntegerType(), False),
]
WAREHOUSE_AUDIT = [
    T.StructField(VALID_FROM, T.TimestampNTZType(), False),
    T.StructField(VALID_TO, T.TimestampNTZType(), False),
    T.StructField(CURRENT_FLAG, T.IntegerType(), False),
    T.StructField(DELETE_FLAG, T.IntegerType(), False),
    T.StructField(EARLY_FLAG, T.IntegerType(), False),
    T.StructField(EARLY_FIELD, T.StringType(), False),
    T.StructField(INSERT_DATE, T.TimestampNTZType(), False),
    T.StructField(UPDATE_DATE, T.TimestampNTZType(), True),
    T.StructField(BATCH_INSERT, T.IntegerType(), False),
    T.StructField(BATCH_UPDATE, T.IntegerType(), True),
]


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def ref(name: str, alias: str | None = None) -> Column:
    """Column reference that also works for names with blanks or brackets."""
    return F.col(f"{alias}.{quoted(name)}" if alias else quoted(name))


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    data_type: str
    mandatory: bool = True
    bk: bool = False
    pk: bool = False
    default: str = ""
    date_dim: bool = True
    description: str = ""
    extended: str = ""
    early_arrive_parent: str = ""

    @property
    def declared_type(self) -> str:
        return self.data_type.strip().lower()

    @property
    def length(self) -> int | None:
        match = _CHARS.match(self.declared_type)
        return int(match.group(1)) if match else None

    @property
    def spark_type(self) -> T.DataType:
        declared = self.declared_type
        if declared in _FIXED_TYPES:
            return _FIXED_TYPES[declared]
        if _CHARS.match(declared):
            return T.StringType()
        match = _DECIMAL.match(declared)
        if match:
            return T.DecimalType(int(match.group(1)), int(match.group(2) or 0))
        raise ContractError(f"column {self.name}: unsupported data type {self.data_type!r}")

    @property
    def date_key(self) -> str | None:
        """Name of the derived date key, for date and datetime columns."""
        if self.date_dim and self.declared_type in ("date", "datetime"):
            return f"dim_Date_{self.name}_bk"
        return None

    @property
    def time_key(self) -> str | None:
        """Name of the derived time key, for datetime columns."""
        if self.date_dim and self.declared_type == "datetime":
            return f"dim_Time_{self.name}_bk"
        return None

    @property
    def collation(self) -> str | None:
        """Spark collation for the case rule the model asks for, or None if it asks for none."""
        match = _COLLATION.search(self.extended)
        if not match:
            return None
        return "UTF8_LCASE_RTRIM" if match.group(1) == "CI" else "UTF8_BINARY_RTRIM"

    def fields(self) -> list[T.StructField]:
        """The column and its derived keys as stored, in order."""
        meta = {"length": self.length} if self.length else {}
        out = [T.StructField(self.name, self.spark_type, not self.mandatory, meta)]
        if self.date_key:
            out.append(T.StructField(self.date_key, T.StringType(), not self.mandatory, {"length": 10}))
        if self.time_key:
            out.append(T.StructField(self.time_key, T.StringType(), not self.mandatory, {"length": 8}))
        return out


@dataclass(frozen=True)
class TableSpec:
    name: str
    columns: tuple[ColumnSpec, ...]
    table_type: str = "scd2"
    delete_detection: bool = True
    dummy: bool = True
    pk_name: str = ""
    protect: bool = False
    area: str = ""
    delta_load: bool = False
    delta_type: str = ""
    delta_column: str = ""
    delta_filter: str = ""
    skipped: tuple[str, ...] = field(default=())

    # keys ---------------------------------------------------------------------------------------
    @property
    def bk_column(self) -> ColumnSpec:
        """The business key: the last column flagged as such."""
        flagged = [c for c in self.columns if c.bk]
        if not flagged:
            raise ContractError(f"{self.name}: no column is flagged as business key")
        return flagged[-1]

    @property
    def bk(self) -> str:
        return self.bk_column.name

    @property
    def pk(self) -> list[str]:
        return [c.name for c in self.columns if c.pk]

    @property
    def sid(self) -> str:
        return f"{self.name}_sid"

    # column lists -------------------------------------------------------------------------------
    def contract_columns(self) -> list[str]:
        return [c.name for c in self.columns]

    def staging_columns(self) -> list[str]:
        """Contract columns with the derived date and time keys right after their column."""
        return [f.name for c in self.columns for f in c.fields()]

    def staging_schema(self) -> T.StructType:
        return T.StructType([f for c in self.columns for f in c.fields()] + STAGING_AUDIT)

    def source_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.spark_type, True) for c in self.columns])

    def warehouse_schema(self, with_sid: bool = True) -> T.StructType:
        sid = [T.StructField(self.sid, T.LongType(), False)] if with_sid else []
        return T.StructType(sid + [f for c in self.columns for f in c.fields()] + WAREHOUSE_AUDIT)

    def warehouse_columns(self, with_sid: bool = True) -> list[str]:
        return self.warehouse_schema(with_sid).fieldNames()

    # building -----------------------------------------------------------------------------------
    def validate(self) -> "TableSpec":
        """Raise ContractError for contracts that cannot be loaded."""
        seen: set[str] = set()
        for name in self.staging_columns():
            if name.lower() in seen:
                raise ContractError(f"{self.name}: column {name} is declared twice")
            seen.add(name.lower())
        self.bk_column
        return self

    def with_defaults(self, case_insensitive_names: bool = False) -> "TableSpec":
        """Fill the empty defaults from the type rule; declared defaults win."""
        from histora.functions.defaults import default_text

        return replace(
            self,
            columns=tuple(
                c if c.default else replace(c, default=default_text(c, case_insensitive_names))
                for c in self.columns
            ),
        )

    @classmethod
    def from_dict(cls, data: Mapping[str, Any], on_unknown_type: str = "reject") -> "TableSpec":
        """Contract from its declared form (`table_name`, flags, `columns`).

        on_unknown_type: 'reject' raises for a column that is not modelled yet, 'skip' leaves it out
        with a warning.
        """
        columns, skipped = [], []
        for raw in data["columns"]:
            column = ColumnSpec(
                name=str(raw["column_name"]),
                data_type=str(raw["data_type"]),
                mandatory=str(raw.get("mandatory", "NOT NULL")).strip().upper() != "NULL",
                bk=_flag(raw.get("bk", 0)),
                pk=_flag(raw.get("pk", 0)),
                default=str(raw.get("default") or ""),
                date_dim=_flag(raw.get("date_dim", 1)),
                description=str(raw.get("description") or ""),
                extended=str(raw.get("extended") or ""),
                early_arrive_parent=str(raw.get("early_arrive_parent") or ""),
            )
            try:
                column.spark_type
            except ContractError:
                if on_unknown_type != "skip":
                    raise
                warnings.warn(f"{data['table_name']}: column {column.name} skipped ({column.data_type})")
                skipped.append(column.name)
                continue
            columns.append(column)
        return cls(
            name=str(data["table_name"]),
            columns=tuple(columns),
            table_type=str(data.get("table_type", "scd2")),
            delete_detection=_flag(data.get("delete_detection", 1)),
            dummy=_flag(data.get("dummy", 1)),
            pk_name=str(data.get("pk_name") or ""),
            protect=_flag(data.get("protect", 0)),
            area=str(data.get("area") or ""),
            delta_load=_flag(data.get("delta_load", 0)),
            delta_type=str(data.get("delta_type") or ""),
            delta_column=str(data.get("delta_column") or ""),
            delta_filter=str(data.get("delta_filter") or ""),
            skipped=tuple(skipped),
        )


def _flag(value: Any) -> bool:
    return str(value).strip().lower() in ("1", "true", "yes")


def table(name: str, columns: Iterable[ColumnSpec], **flags: Any) -> TableSpec:
    """Contract written in code, validated, with the type rule's defaults filled in."""
    return TableSpec(name, tuple(columns), **flags).validate().with_defaults()
