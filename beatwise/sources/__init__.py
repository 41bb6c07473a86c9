"""Sources and sinks."""

from beatwise.sources.features import read_features, split_features
from beatwise.sources.properties import properties_of, read_properties
from beatwise.sources.readers import (
    ingest_census,
    read_csv,
    read_csv_lines,
    read_delimited_fields,
    read_feature_docs,
    read_feature_docs_text,
    read_parquet,
)
from beatwise.sources.records import read_csv_records
from beatwise.sources.sinks import (
    collect_then_write,
    formatted_plan,
    write_csv,
    write_feature_docs,
    write_parquet,
)

__all__ = [
    "ingest_census",
    "read_csv", "read_csv_lines", "read_delimited_fields", "read_feature_docs",
    "read_feature_docs_text", "read_parquet", "collect_then_write", "formatted_plan", "write_csv",
    "write_feature_docs", "write_parquet",
    "split_features", "read_features", "properties_of", "read_properties", "read_csv_records",
]
