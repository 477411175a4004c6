from loamline.sinks.files import (
    Ingested,
    append_absent,
    append_rows,
    bucket_column,
    in_buckets,
    pruned,
    rejects_path,
    replace_partitions,
    replace_table,
    set_aside,
    store_rejects,
    write_table,
)
from loamline.sinks.jdbc import column_types, connection, for_database, load_table, load_tables

__all__ = [
    "Ingested",
    "append_absent",
    "append_rows",
    "bucket_column",
    "column_types",
    "connection",
    "for_database",
    "load_table",
    "load_tables",
    "in_buckets",
    "pruned",
    "rejects_path",
    "replace_partitions",
    "replace_table",
    "set_aside",
    "store_rejects",
    "write_table",
]
