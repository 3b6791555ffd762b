"""Page blocks to titles and links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linktide.functions import (
    is_subpage,
    keeps_link,
    link_target,
    normalise_title,
    raw_links,
)

_PAGE_FIELDS = (
    "title string, text string, revision array<struct<text: string>>, _corrupt_record string"
)
# What ``read_records`` says of a block besides its text.
RECORD_COLUMNS = ("record", "at_file_start", "record_file", "closed")
_XML_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": "_corrupt_record",
    "ignoreSurroundingSpaces": "false",
}


# Why a block is in quarantine, and how much of it is kept there.
UNTITLED, BROKEN = "no title", "broken markup"
EXCERPT = 500


def parse_pages(blocks: DataFrame, excerpts: bool = False) -> DataFrame:
    """``(title, texts, is_corrupt)`` per block, and where a block is from if ``blocks``
    are records (``RECORD_COLUMNS``); the title is normalised. With ``excerpts`` also the
    ``reason`` for which a block goes to quarantine, and its first ``EXCERPT`` characters.

    Each block is parsed on its own, so a malformed one costs only its own links:
    its title is read from the title element alone.
    """
    title_element = F.regexp_extract("block", r"(<title[^>]*>[^<]*</title>)", 1)
    title_only = F.concat(F.lit("<page>"), title_element, F.lit("</page>"))
    # The explode of one element keeps the optimizer from parsing once per use of a field.
    others = [c for c in RECORD_COLUMNS if c in blocks.columns]
    parsed = blocks.select(
        "block", *others, F.explode(F.array(F.from_xml("block", _PAGE_FIELDS, _XML_OPTIONS))).alias("page")
    )
    is_corrupt = F.col("page._corrupt_record").isNotNull()
    rescued = F.from_xml(title_only, _PAGE_FIELDS, _XML_OPTIONS)["title"]
    revisions = F.coalesce(F.col("page.revision.text"), F.array().cast("array<string>"))
    texts = F.filter(F.concat(revisions, F.array("page.text")), lambda text: text.isNotNull())
    title = normalise_title(F.when(is_corrupt, rescued).otherwise(F.col("page.title")))
    told = []
    if excerpts:
        # A broken block with a title stays as a page without links; one without is lost.
        reason = F.when(~F.coalesce(title != "", F.lit(False)), UNTITLED).when(is_corrupt, BROKEN)
        told = [reason.alias("reason"), F.when(reason.isNotNull(), F.substring("block", 1, EXCERPT)).alias("excerpt")]
    return parsed.select(
        title.alias("title"),
        F.when(is_corrupt, F.array().cast("array<string>")).otherwise(texts).alias("texts"),
        is_corrupt.alias("is_corrupt"),
        *told,
        *others,
    )


def has_title(column: str = "title"):
    return F.coalesce(F.col(column) != "", F.lit(False))


def ranked_titles(pages: DataFrame) -> DataFrame:
    """Pages that take part in the graph: titled, and not a subpage."""
    return pages.where(has_title() & ~is_subpage(F.col("title")))


def untitled_pages(pages: DataFrame) -> DataFrame:
    """Quarantine: pages that cannot become a node."""
    return pages.where(~has_title())


def extract_links(pages: DataFrame) -> DataFrame:
    """``(src, raw)``: one row per link written in a page."""
    texts = pages.select(F.col("title").alias("src"), F.explode("texts").alias("text"))
    return texts.select("src", F.explode(raw_links(F.col("text"))).alias("raw"))


def filter_links(raw: DataFrame) -> DataFrame:
    """``(src, dst)``: page links only, duplicates and red links included."""
    kept = raw.where(keeps_link(F.col("raw"), F.col("src")))
    return kept.select("src", link_target(F.col("raw")).alias("dst"))


def page_targets(pages: DataFrame, keep: bool = False) -> DataFrame:
    """``(id, targets)`` per page: the links of ``filter_links``, distinct in the page;
    with ``keep`` also what the parse says of the block.

    One narrow row per page, so that nodes and links come from a single parse.
    """
    others = [c for c in (*RECORD_COLUMNS, "is_corrupt", "reason", "excerpt") if keep and c in pages.columns]
    raws = F.flatten(F.transform("texts", raw_links))
    kept = F.filter(raws, lambda raw: keeps_link(raw, F.col("title")))
    return pages.select(
        F.col("title").alias("id"),
        F.array_distinct(F.transform(kept, link_target)).alias("targets"),
        *others,
    )
