"""Wiki markup rules as column expressions."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# A link holding one of these points to a namespace, section or subpage.
UNRANKED_MARKS = (":", "#", "/")


def normalise_title(title: Column) -> Column:
    # One search for a byte; ``translate`` looks every character up in a table.
    return F.replace(title, F.lit(" "), F.lit("_"))


def is_subpage(title: Column) -> Column:
    return title.contains("/")


def raw_links(text: Column) -> Column:
    """Array of the texts between each ``[[`` and the first ``]]`` after it.

    A ``[[`` that is never closed would make the pattern look through the rest of the
    text, for each such mark anew; so whatever follows the last ``]]`` is cut off first,
    and the scan stays linear on any text.
    """
    tail = F.substring_index(text, "]]", -1)
    closed = F.left(text, F.length(text) - F.length(tail))
    scanned = F.when(tail.contains("[["), closed).otherwise(text)
    return F.regexp_extract_all(scanned, F.lit(r"(?s)\[\[(.*?)\]\]"), 1)


def keeps_link(raw: Column, title: Column) -> Column:
    """Judges the whole raw link, label included, against the normalised title."""
    marked = reduce(or_, (raw.contains(mark) for mark in UNRANKED_MARKS))
    return ~marked & (raw != title)


def link_target(raw: Column) -> Column:
    return normalise_title(F.substring_index(raw, "|", 1))
