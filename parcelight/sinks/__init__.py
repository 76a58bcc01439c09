from parcelight.sinks.tables import (
    append_new_rows,
    append_rows,
    append_run_scores,
    compact,
    empty_tables,
    overwrite_table,
    write_part,
    write_ranked_file,
)

__all__ = [
    "append_new_rows", "append_rows", "append_run_scores", "compact", "empty_tables",
    "overwrite_table", "write_part", "write_ranked_file",
]
