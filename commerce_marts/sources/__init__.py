"""Source schemas, readers, writers and the driver-table bindings."""

from commerce_marts.sources.bindings import DRIVER_TABLES, raw_sources
from commerce_marts.sources.io import (
    conform,
    export_marts,
    land_as_parquet,
    manifest_check,
    read_source,
    write_csv,
    write_table,
)
from commerce_marts.sources.schemas import (
    ORDER_STATUSES,
    PRICE_BANDS,
    RAW_SCHEMAS,
    SOURCES,
    WAREHOUSE_KEYS,
    WAREHOUSE_SCHEMAS,
    SourceSpec,
)

__all__ = [
    "DRIVER_TABLES", "ORDER_STATUSES", "PRICE_BANDS", "RAW_SCHEMAS", "SOURCES",
    "SourceSpec", "WAREHOUSE_KEYS", "WAREHOUSE_SCHEMAS", "conform", "export_marts",
    "land_as_parquet", "manifest_check", "raw_sources", "read_source", "write_csv",
    "write_table",
]
