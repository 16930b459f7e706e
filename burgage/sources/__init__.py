"""Reading landed files and writing results."""

from .csvfiles import (Typed, list_landed, null_tokens, read_csv, read_csv_inferred,
                       type_columns)
from .jsontables import append_all, decode_json_table, read_json_tables, rejected_responses
from .ledger import compared, digests, read_ledger, settle, standing
from .sinks import export_all, export_csv, export_one_csv, register_view, write_table
from .splitcsv import malformed, read_csv_split, split_records
from .upserts import latest, upsert

__all__ = [
    "Typed", "append_all", "compared", "decode_json_table", "digests", "export_all", "export_csv",
    "export_one_csv", "latest", "list_landed", "malformed", "null_tokens", "read_csv", "read_csv_inferred", "read_csv_split",
    "read_json_tables", "read_ledger", "register_view", "rejected_responses", "settle", "split_records",
    "standing", "type_columns", "upsert", "write_table",
]
