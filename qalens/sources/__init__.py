"""Sources and sinks: CSV (gzip) and Parquet."""

from qalens.sources.csv import CSV_OPTIONS, header_census, read_csv
from qalens.sources.csv_split import split_records
from qalens.sources.sinks import stored, write_csv, write_parquet
from qalens.sources.supplied import SUPPLIED_SCHEMAS, read_supplied
from qalens.sources.tables import (
    apply_schema,
    convert_to_parquet,
    load_table,
    load_tables,
    rejected_rows,
    rejected_values,
    text_schema,
)
from qalens.sources.versions import current_version, drop_old_versions, read_version, write_version

__all__ = [
    "CSV_OPTIONS",
    "SUPPLIED_SCHEMAS",
    "apply_schema",
    "convert_to_parquet",
    "current_version",
    "drop_old_versions",
    "header_census",
    "load_table",
    "load_tables",
    "read_csv",
    "read_supplied",
    "read_version",
    "rejected_rows",
    "rejected_values",
    "split_records",
    "stored",
    "text_schema",
    "write_csv",
    "write_parquet",
    "write_version",
]
