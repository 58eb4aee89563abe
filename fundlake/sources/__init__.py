"""Sources and sinks: Bronze CSV landing, Parquet layers, catalog, decoding."""

from fundlake.sources.bronze import (CSV_OPTIONS, read_bronze, read_bronze_all, write_bronze,
                                     write_bronze_all, write_drops)
from fundlake.sources.catalog import create_layers, list_layer, register_table
from fundlake.sources.decode import decode, infer_types
from fundlake.sources.discover import (drift, layouts, list_files, pending, read_dates, record, register_layouts,
                                       types_by_date)
from fundlake.sources.snapshot import (LayerRun, Snapshot, current, publish, read_layer, read_table,
                                       vacuum, versions)
from fundlake.sources.tables import write_table

__all__ = ["CSV_OPTIONS", "read_bronze", "read_bronze_all", "write_bronze", "write_bronze_all", "write_drops",
           "create_layers", "list_layer", "register_table", "decode", "infer_types",
           "drift", "layouts", "list_files", "pending", "read_dates", "record", "register_layouts", "types_by_date",
           "LayerRun", "Snapshot", "current", "publish", "read_layer", "read_table", "vacuum",
           "versions", "write_table"]
