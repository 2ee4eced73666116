"""Histora: dimensional warehouse loading expressed as Spark DataFrame operators."""

from histora.spec import ColumnSpec, ContractError, TableSpec

__all__ = ["ColumnSpec", "ContractError", "TableSpec"]
