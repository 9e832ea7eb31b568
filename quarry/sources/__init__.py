"""Sources and sinks: explicit schemas, readers, result writers, stand-ins."""

from quarry.sources.readers import (  # noqa: F401
    cast_columns, read_csv, read_log_text, read_table, rename_by_position,
)
from quarry.sources.sinks import persisted, preview, write_result  # noqa: F401
