"""Column expressions on wiki markup."""

from linktide.functions.wiki import (
    is_subpage,
    keeps_link,
    link_target,
    normalise_title,
    raw_links,
)

__all__ = ["is_subpage", "keeps_link", "link_target", "normalise_title", "raw_links"]
