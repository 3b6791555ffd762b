"""Writers: the line formats and the ordered ranking."""

from linktide.sinks.ranking import numbered, ranking, write_ranking
from linktide.sinks.text import (
    count_line,
    write_adjacency,
    write_count,
    write_key_values,
    write_ranked_pages,
)

__all__ = [
    "count_line",
    "numbered",
    "ranking",
    "write_adjacency",
    "write_count",
    "write_key_values",
    "write_ranked_pages",
    "write_ranking",
]
