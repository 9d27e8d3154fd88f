from tabkit.sources.delimited import from_records, parse_lines, read_csv, read_delimited_text, schema_of
from tabkit.sources.writers import write_csv, write_text

__all__ = [
    "from_records",
    "parse_lines",
    "read_csv",
    "read_delimited_text",
    "schema_of",
    "write_csv",
    "write_text",
]
