from recspark.sources.tables import read_table, reviews, items, events
from recspark.sources.files import (
    REVIEW_SCHEMA, read_json_lines, read_json_records, write_json_lines, write_json_records,
    write_parquet, read_parquet, write_table_roundtrip,
)
from recspark.sources.loader import load_reviews, union_chunks

__all__ = [
    "read_table", "reviews", "items", "events",
    "REVIEW_SCHEMA", "read_json_lines", "read_json_records", "write_json_lines", "write_json_records",
    "write_parquet", "read_parquet", "write_table_roundtrip",
    "load_reviews", "union_chunks",
]
