"""Page parsing and link rules, one case per rule."""

from __future__ import annotations

import time

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from model import links_in
from pyspark.sql import functions as F

from linktide.functions import raw_links
from linktide.operators import pages as p
from linktide.plans.rank_dump import dump_graph


def _block(title, *texts):
    head = "" if title is None else f"<title>{title}</title>"
    revisions = "".join(f"<revision><text>{t}</text></revision>" for t in texts)
    return f"<page>{head}{revisions}</page>"


@pytest.fixture
def pages_of(spark):
    def build(*blocks):
        return p.parse_pages(spark.createDataFrame([(b,) for b in blocks], "block string"))

    return build


@pytest.fixture
def links_of(pages_of):
    def build(*blocks):
        pages = p.ranked_titles(pages_of(*blocks))
        rows = p.filter_links(p.extract_links(pages)).collect()
        listed = p.page_targets(pages).select("id", F.explode("targets").alias("dst")).collect()
        assert {tuple(r) for r in rows} == {tuple(r) for r in listed}
        return sorted((r.src, r.dst) for r in rows)

    return build


def test_unclosed_link_is_ignored(links_of):
    assert links_of(_block("A", "[[Beta]] then [[Gamma")) == [("A", "Beta")]


def test_untitled_pages_are_quarantined(pages_of):
    pages = pages_of(_block(None, "[[A]]"), _block("", "[[A]]"), _block("A", "x"))
    assert p.untitled_pages(pages).count() == 2
    assert [r.title for r in p.ranked_titles(pages).collect()] == ["A"]


def test_texts_of_all_revisions(links_of):
    assert links_of(_block("A", "[[B]]", "[[C]]")) == [("A", "B"), ("A", "C")]


def test_text_directly_in_the_page(links_of):
    block = "<page><title>A</title><text>[[B]]</text></page>"
    assert links_of(block) == [("A", "B")]


def test_text_before_title(links_of):
    block = "<page><revision><text>[[B]]</text></revision><title>A</title></page>"
    assert links_of(block) == [("A", "B")]


def test_title_is_not_trimmed(pages_of):
    assert pages_of(_block(" T  U ", "x")).first().title == "_T__U_"


def test_title_with_tab_is_kept(pages_of):
    assert pages_of(_block("T\tU", "x")).first().title == "T\tU"


def test_entities_and_cdata(links_of, pages_of):
    block = "<page><title>A &amp; &#66;</title><text>&#91;[C]] <![CDATA[[[D&E]]]]></text></page>"
    assert pages_of(block).first().title == "A_&_B"
    assert links_of(block) == [("A_&_B", "C"), ("A_&_B", "D&E")]


@pytest.mark.parametrize("title", ["null", "NULL", "NaN", "1e5", "true", "2020-01-01", "#sink"])
def test_titles_stay_text(pages_of, title):
    assert pages_of(_block(title, "x")).first().title == title


def test_malformed_page_keeps_its_title_only(pages_of):
    block = "<page><title>Q&amp;A it&apos;s</title><text>[[B]] <b>broken</text></page>"
    row = pages_of(block).first()
    assert (row.title, row.texts, row.is_corrupt) == ("Q&A_it's", [], True)


def test_markup_inside_text_counts(links_of):
    assert links_of(_block("A", "[[B]] <i>[[C]]</i>")) == [("A", "B"), ("A", "C")]


def test_subpage_is_dropped_with_its_links(links_of):
    assert links_of(_block("A/B", "[[C]]"), _block("D", "[[C]]")) == [("D", "C")]


def test_whole_raw_link_is_judged(links_of):
    text = "[[B|b: label]] [[C|x#y]] [[D|a/b]] [[E|fine]] [[F:G]] [[H#I]] [[J/K]]"
    assert links_of(_block("A", text)) == [("A", "E")]


def test_link_nested_in_a_dropped_link_is_lost(links_of):
    assert links_of(_block("A", "[[File:x|see [[Gamma]] now]]")) == []


def test_self_links(links_of):
    assert links_of(_block("Beta", "[[Beta]]")) == []
    assert links_of(_block("Self Ref", "[[Self Ref]] [[Self_Ref]]")) == [("Self_Ref", "Self_Ref")]
    assert links_of(_block("Epsilon", "[[Epsilon|me]]")) == [("Epsilon", "Epsilon")]


def test_no_case_folding_and_spaces_to_underscores(links_of):
    assert links_of(_block("A", "[[foo bar|x]]")) == [("A", "foo_bar")]


def test_empty_and_piped_empty_link(links_of):
    assert links_of(_block("A", "[[]] [[|x]]")) == [("A", ""), ("A", "")]


def test_same_title_merges(spark, scratch):
    blocks = [_block("A", "[[B]] [[C]]"), _block("A", "[[C]] [[D]]")]
    blocks += [_block(t, "") for t in "BCD"]
    graph, _ = dump_graph(spark.createDataFrame([(b,) for b in blocks], "block string"), scratch)
    assert graph.n_nodes == 4
    assert sorted(tuple(r) for r in graph.edges.collect()) == [("A", "B"), ("A", "C"), ("A", "D")]


def test_no_pages(spark, scratch):
    graph, counts = dump_graph(spark.createDataFrame([], "block string"), scratch)
    assert (graph.n_nodes, graph.n_edges, counts["n_blocks"]) == (0, 0, 0)


@settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.text(alphabet="[]ab|\n", max_size=60), min_size=40, max_size=80))
def test_raw_links_match_a_walk_through_the_text(spark, texts):
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    found = rows.select("text", raw_links(F.col("text")).alias("links")).collect()
    assert [(r.text, r.links) for r in found] == [(t, links_in(t)) for t in texts]


def test_unclosed_brackets_do_not_blow_up(spark):
    hostile = "[[" * 500_000
    started = time.time()
    row = spark.createDataFrame([(hostile,)], "text string").select(
        F.size(raw_links(F.col("text"))).alias("n")
    )
    assert row.first().n == 0
    assert time.time() - started < 30


def test_one_parse_per_block(spark, pages_of):
    plan = p.page_targets(pages_of(_block("A", "x")))._jdf.queryExecution().optimizedPlan()
    whole_block_parses = plan.toString().count("false), block#")
    assert whole_block_parses == 1
