from histora.sources.contracts import (
    load_contract,
    load_contracts,
    read_contracts,
    select_rows,
)
from histora.sources.delivery import conform, empty_source, is_shell, source_or_shell

__all__ = [
    "conform",
    "empty_source",
    "is_shell",
    "load_contract",
    "load_contracts",
    "read_contracts",
    "select_rows",
    "source_or_shell",
]
