"""Block scan: splits, compression, incomplete blocks and tags."""

from __future__ import annotations

import bz2
import gzip
import random

import pytest
from pyspark.sql import functions as F

from linktide.scratch import settings
from linktide.sources import read_blocks


def _page(name, text=""):
    return f"<page>\n<title>{name}</title><revision><text>{text}</text></revision>\n</page>"


def _write(tmp_path, content, name="dump.xml"):
    path = tmp_path / name
    path.write_bytes(content if isinstance(content, bytes) else content.encode())
    return str(path)


def _blocks(spark, path):
    rows = read_blocks(spark, path, "<page>", "</page>").collect()
    return sorted(r.block for r in rows)


@pytest.fixture(scope="module")
def many():
    pages = [_page(f"Page {i}", f"é [[Page {i * 7 % 3000}]] " * (i % 9)) for i in range(3000)]
    return pages, "<mediawiki>\n" + "\n  ".join(pages) + "\n</mediawiki>\n"


@pytest.mark.parametrize("split_bytes", [1_000, 7_777, 50_000])
def test_blocks_across_splits(spark, tmp_path, many, split_bytes):
    pages, dump = many
    path = _write(tmp_path, dump)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    try:
        blocks = read_blocks(spark, path, "<page>", "</page>")
        assert blocks.rdd.getNumPartitions() > 5
        assert sorted(r.block for r in blocks.collect()) == sorted(pages)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("name, pack", [("d.xml.gz", gzip.compress), ("d.xml.bz2", bz2.compress)])
def test_compressed(spark, tmp_path, many, name, pack):
    pages, dump = many
    assert _blocks(spark, _write(tmp_path, pack(dump.encode()), name)) == sorted(pages)


def test_bz2_is_split(spark, tmp_path):
    rng = random.Random(0)
    pages = [_page(f"Page {i}", rng.randbytes(1500).hex()) for i in range(2000)]
    packed = bz2.compress("\n".join(pages).encode(), 1)
    path = _write(tmp_path, packed, "d.xml.bz2")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(len(packed) // 11))
    try:
        blocks = read_blocks(spark, path, "<page>", "</page>")
        tasks = blocks.select(F.spark_partition_id().alias("task")).distinct().count()
        assert tasks > 5
        assert sorted(r.block for r in blocks.collect()) == sorted(pages)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_several_files_keep_their_name(spark, tmp_path):
    _write(tmp_path, _page("A"), "a.xml")
    _write(tmp_path, _page("B"), "b.xml")
    rows = read_blocks(spark, str(tmp_path), "<page>", "</page>").collect()
    assert {r.file_path.rsplit("/", 1)[1]: r.block for r in rows} == {
        "a.xml": _page("A"),
        "b.xml": _page("B"),
    }


def test_cut_off_file_loses_only_its_last_block(spark, tmp_path):
    dump = "<mediawiki>" + _page("A") + _page("B") + "<page><title>C</title><revision><text>[[A"
    assert _blocks(spark, _write(tmp_path, dump)) == [_page("A"), _page("B")]


def test_unterminated_block_before_another_is_dropped(spark, tmp_path):
    dump = "<page><title>A</title>" + _page("B")
    assert _blocks(spark, _write(tmp_path, dump)) == [_page("B")]


def test_start_tag_is_literal(spark, tmp_path):
    attributed = '<page attr="1"><title>A</title></page>'
    dump = "<mediawiki>" + attributed + _page("B") + attributed + "</mediawiki>"
    assert _blocks(spark, _write(tmp_path, dump)) == [_page("B")]


def test_doubled_bracket_before_the_tag(spark, tmp_path):
    assert _blocks(spark, _write(tmp_path, "<" + _page("A"))) == [_page("A")]


def test_text_after_the_block_is_cut(spark, tmp_path):
    dump = _page("A") + " stray </page> more " + _page("B")
    assert _blocks(spark, _write(tmp_path, dump)) == [_page("A"), _page("B")]


@pytest.mark.parametrize("split_bytes", [1_000, 100_000_000])
@pytest.mark.parametrize("name, pack", [("d.xml", bytes), ("d.xml.gz", gzip.compress)])
def test_a_declaration_inside_blocks(spark, tmp_path, split_bytes, name, pack):
    dump = "".join(f"<record><?xml version='1.0'?>{i}</record>" for i in range(1000))
    path = _write(tmp_path, pack(dump.encode()), name)
    with settings(spark, {"spark.sql.files.maxPartitionBytes": split_bytes}):
        assert read_blocks(spark, path, "<record>", "</record>").count() == 1000


def test_no_blocks(spark, tmp_path):
    assert _blocks(spark, _write(tmp_path, "<mediawiki></mediawiki>")) == []


@pytest.mark.parametrize("tags", [("", "</page>"), ("<page>", ""), (None, "</page>")])
def test_tags_are_mandatory(spark, tmp_path, tags):
    with pytest.raises(ValueError, match="tag"):
        read_blocks(spark, str(tmp_path), *tags)


def test_other_tags(spark, tmp_path):
    path = _write(tmp_path, "<doc>1</doc><doc>2</doc>")
    rows = read_blocks(spark, path, "<doc>", "</doc>").collect()
    assert sorted(r.block for r in rows) == ["<doc>1</doc>", "<doc>2</doc>"]
