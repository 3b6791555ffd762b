"""Readers: tag-delimited blocks and the line formats."""

from linktide.sources.blocks import drop_file_heads, file_heads, read_blocks, read_records
from linktide.sources.lines import (
    malformed_ranked_pages,
    read_adjacency,
    read_key_values,
    read_ranked_pages,
    split_ranked_pages,
)

__all__ = [
    "drop_file_heads",
    "file_heads",
    "malformed_ranked_pages",
    "read_adjacency",
    "read_blocks",
    "read_key_values",
    "read_ranked_pages",
    "split_ranked_pages",
    "read_records",
]
