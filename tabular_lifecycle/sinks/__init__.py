from .catalog import (
    append_table, create_database, create_external_table, drop_database, drop_table, merge_append_table,
    overwrite_path, overwrite_table, replace_batches, use_database,
)

__all__ = [
    "append_table", "create_database", "create_external_table", "drop_database", "drop_table",
    "merge_append_table", "overwrite_path", "overwrite_table", "replace_batches", "use_database",
]
