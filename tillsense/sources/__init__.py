from tillsense.sources.retail import (
    ORDER_KEYS,
    RAW_SCHEMA,
    normalize_columns,
    read_table,
    retail_transactions,
    scan_transactions,
)

__all__ = [
    "ORDER_KEYS",
    "RAW_SCHEMA",
    "normalize_columns",
    "read_table",
    "retail_transactions",
    "scan_transactions",
]
