"""Sinks: Parquet layers, partitioned silver, gold CSV exports, gated writes."""

from haulage.sinks.publish import publish_checked, publish_table, recover
from haulage.sinks.writers import (
    write_layer,
    write_partitioned,
    write_gold,
    write_csv_export,
    gated_write,
)

__all__ = ["write_layer", "write_partitioned", "write_gold", "write_csv_export", "gated_write", "publish_checked", "publish_table", "recover"]
