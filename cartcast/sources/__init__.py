"""Sources and sinks: parquet tables, the transaction log view, CSV files."""

from cartcast.sources.tables import (  # noqa: F401
    LOG_ORDER,
    read_table,
    transactions,
)
