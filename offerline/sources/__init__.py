"""Sources and sinks."""

from offerline.sources.io import (
    read_input,
    read_message_loads,
    read_table,
    write_message_loads,
    write_partitioned,
)

__all__ = ["read_input", "read_message_loads", "read_table", "write_message_loads", "write_partitioned"]
