"""Default values of the unknown member, by declared type and column name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from histora.spec import BEGINNING, OPEN_END, UNKNOWN_KEY, UNKNOWN_TEXT, ColumnSpec, ContractError

# Name parts that mark the start of a validity
_START_WORDS = ("from", "since", "insert", "update")
_NUMBER_WORDS = ("number", "integer", "int", "decimal", "float", "real")


def default_text(column: ColumnSpec, case_insensitive_names: bool = False) -> str:
    """Default of a column as literal text; the first rule that fits decides.

    The words that mark a start date are matched as written. With case_insensitive_names they also
    match names such as ValidFrom, which otherwise get the open end.
    """
    declared = column.declared_type
    name = column.name.lower() if case_insensitive_names else column.name
    if not column.mandatory:
        return "NULL"
    if "_bk" in column.name or column.name == "InternalId":
        return f"'{UNKNOWN_KEY}'"
    if column.length is not None:
        return "'-'" if column.length <= 5 else f"'{UNKNOWN_TEXT}'"
    if any(word in declared for word in _NUMBER_WORDS):
        return "0"
    if declared in ("datetime", "date"):
        moment = BEGINNING if any(word in name for word in _START_WORDS) else OPEN_END
        return f"'{moment}'" if declared == "datetime" else f"'{moment[:10]}'"
    if declared == "time":
        return "'00:00:00'"
    if declared == "boolean":
        return "false"
    raise ContractError(f"column {column.name}: no default for data type {column.data_type!r}")


def default_value(column: ColumnSpec) -> str | None:
    """The default without its literal quotes; None stands for NULL."""
    text = (column.default or default_text(column)).strip()
    if text.upper() == "NULL":
        return None
    if len(text) >= 2 and text[0] == text[-1] == "'":
        return text[1:-1].replace("''", "'")
    return text


def default_for(column: ColumnSpec) -> Column:
    """The default as a literal of the column's type."""
    return F.lit(default_value(column)).cast(column.spark_type)
