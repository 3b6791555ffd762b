"""Line formats: round trips and what they reject."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from linktide.scratch import Scratch, scratch_root
from linktide.sinks import (
    numbered,
    ranking,
    write_adjacency,
    write_count,
    write_key_values,
    write_ranked_pages,
    write_ranking,
)
from linktide.sources import (
    malformed_ranked_pages,
    read_adjacency,
    read_key_values,
    read_ranked_pages,
)


def _file(tmp_path, content):
    path = tmp_path / "lines.txt"
    path.write_text(content, encoding="utf-8")
    return str(path)


def test_key_values_cut_at_the_first_tab(spark, tmp_path):
    rows = read_key_values(spark, _file(tmp_path, "a\n\nb\tc\td\ne\t\n")).collect()
    assert [tuple(r) for r in rows] == [("a", ""), ("", ""), ("b", "c\td"), ("e", "")]


def test_key_value_round_trip(spark, tmp_path):
    pairs = [("a", "x y"), ("ü", ""), ("c", "1\t2")]
    path = str(tmp_path / "out")
    write_key_values(spark.createDataFrame(pairs, "key string, value string"), path)
    assert sorted(tuple(r) for r in read_key_values(spark, path).collect()) == sorted(pairs)


@pytest.mark.parametrize("pair", [("a\tb", "x"), ("a\nb", "x"), ("a", "x\ny"), ("a", "x\ry")])
def test_key_values_reject_what_breaks_the_line(spark, tmp_path, pair):
    df = spark.createDataFrame([pair], "key string, value string")
    with pytest.raises(PySparkException, match="in key|in value"):
        write_key_values(df, str(tmp_path / "out"))


def test_adjacency_round_trip(spark, tmp_path):
    rows = [("a", ["b", "c"]), ("b", [])]
    path = str(tmp_path / "out")
    write_adjacency(
        spark.createDataFrame(rows, "id string, outlinks array<string>"), "outlinks", path
    )
    assert sorted(tuple(r) for r in read_adjacency(spark, path).collect()) == rows


def test_ranked_pages_lines(spark, tmp_path):
    path = _file(tmp_path, "a\t1.0 \nb\t0.25 x  y\nc 1E-4 z\n")
    rows = read_ranked_pages(spark, path).collect()
    assert [tuple(r) for r in rows] == [
        ("a", 1.0, []),
        ("b", 0.25, ["x", "y"]),
        ("c", 0.0001, ["z"]),
    ]


@pytest.mark.parametrize("line", ["a", "", "a\tone b"])
def test_malformed_ranked_page(spark, tmp_path, line):
    path = _file(tmp_path, f"a\t1.0 b\n{line}\n")
    with pytest.raises(PySparkException, match="not a ranked page"):
        read_ranked_pages(spark, path).collect()
    assert [r.id for r in read_ranked_pages(spark, path, strict=False).collect()] == ["a"]
    assert [r.value for r in malformed_ranked_pages(spark, path).collect()] == [line]


def test_ranked_pages_round_trip(spark, tmp_path):
    rows = [("a", 1 / 3, ["b", "c"]), ("b", 1e-12, []), ("c", 123456789.125, None)]
    path = str(tmp_path / "out")
    schema = "id string, rank double, outlinks array<string>"
    write_ranked_pages(spark.createDataFrame([*rows, (None, 1.0, [])], schema), path)
    read = sorted(tuple(r) for r in read_ranked_pages(spark, path).collect())
    assert read == [(i, rank, links or []) for i, rank, links in rows]


@pytest.mark.parametrize("page", [("a b", 1.0, ["c"]), ("a", 1.0, ["c\td"]), ("a\n", 1.0, None)])
def test_ranked_pages_reject_whitespace(spark, tmp_path, page):
    df = spark.createDataFrame([page], "id string, rank double, outlinks array<string>")
    with pytest.raises(PySparkException, match="whitespace"):
        write_ranked_pages(df, str(tmp_path / "out"))


def test_count_line(spark, tmp_path):
    path = tmp_path / "n"
    write_count(spark, 42, str(path))
    assert [p.read_text() for p in sorted(path.glob("part-*")) if p.stat().st_size] == ["N=42\n"]


@pytest.fixture
def ranks(spark):
    return spark.range(5000).select(
        F.format_string("n%04d", "id").alias("id"),
        # Two thirds of the pages tie on one rank.
        F.when(F.col("id") % 3 == 0, F.col("id") / 7.0).otherwise(0.15).alias("rank"),
    )


def _expected(ranks):
    return sorted((tuple(r) for r in ranks.collect()), key=lambda r: (-r[1], r[0]))


def test_ranking_parts_are_in_order(ranks, tmp_path):
    path = tmp_path / "ranking"
    write_ranking(ranks, str(path))
    parts = sorted(path.glob("part-*"))
    lines = [line for part in parts for line in part.read_text().splitlines()]
    assert [(i, float(r)) for i, r in (x.split("\t") for x in lines)] == _expected(ranks)


def test_a_null_rank_fails(spark, tmp_path):
    pages = spark.createDataFrame([("a", None, ["b", "c"])], "id string, rank double, outlinks array<string>")
    with pytest.raises(Exception, match="no rank for a"):
        write_ranked_pages(pages, str(tmp_path / "out"))


def test_positions(ranks, scratch):
    rows = numbered(ranking(ranks), scratch).orderBy("position").collect()
    assert [r.position for r in rows] == list(range(1, 5001))
    assert [(r.id, r.rank) for r in rows] == _expected(ranks)


def test_positions_of_nothing(spark, scratch):
    empty = spark.createDataFrame([], "id string, rank double")
    assert numbered(ranking(empty), scratch).count() == 0


def test_scratch_uses_the_configured_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert scratch_root(spark) == root.rstrip("/")
    with Scratch(spark) as scratch:
        scratch.save(spark.range(3), "three")
        assert Path(scratch.folder).parent == Path(root)
    assert not Path(scratch.folder).exists()
