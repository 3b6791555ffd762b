"""The golden dump: blocks, links, edges, masses and both rankings."""

from __future__ import annotations

from pathlib import Path

import pytest

from linktide import rank_dump
from linktide.__main__ import main
from linktide.operators import pages as p
from linktide.operators.graph import inlink_lists
from linktide.plans.rank_dump import dump_graph
from linktide.scratch import DATABASE, Scratch, settings
from linktide.sources import read_blocks, read_key_values, read_records

WIKI_MINI = """<mediawiki xml:lang="en">
  <siteinfo><sitename>Mini</sitename></siteinfo>
  <page><title>Alpha Page</title><revision><text xml:space="preserve">See [[Beta]], [[Gamma|the gamma]], [[Red Link]], [[Beta]].</text></revision></page>
  <page><title>Beta</title><revision><text>[[Alpha Page]] [[File:x.png|see [[Gamma]] now]] [[Delta#History]] [[Beta]]</text></revision></page>
  <page><title>Gamma</title><revision><text>[[Alpha Page]] [[Beta|b: label]] [[Delta/Sub]] [[]]</text></revision></page>
  <page><title>Delta</title><revision><text>no links &amp; &lt;nothing&gt;</text></revision></page>
  <page><title>Self Ref</title><revision><text>[[Self Ref]] [[Delta]]</text></revision></page>
  <page><title>User/Sub</title><revision><text>[[Delta]]</text></revision></page>
  <page><title>Epsilon</title><revision><text>[[Epsilon|me]] [[epsilon]] [[Delta]]</text></revision></page>
  <page><title>Zeta</title><revision><text>[[Beta]] <b>broken</text></revision></page>
</mediawiki>
"""
NODES = {"Alpha_Page", "Beta", "Delta", "Epsilon", "Gamma", "Self_Ref", "Zeta"}
EDGES = {
    ("Alpha_Page", "Beta"),
    ("Alpha_Page", "Gamma"),
    ("Beta", "Alpha_Page"),
    ("Gamma", "Alpha_Page"),
    ("Self_Ref", "Self_Ref"),
    ("Self_Ref", "Delta"),
    ("Epsilon", "Epsilon"),
    ("Epsilon", "Delta"),
}
SINK_MASSES = [
    2.0,
    1.635714286,
    1.392423469,
    1.229939960,
    1.121424188,
    1.048951154,
    1.000549521,
    0.968224144,
]
RANKING_1 = [
    ("Alpha_Page", 2.092857143),
    ("Delta", 1.242857143),
    ("Beta", 0.817857143),
    ("Epsilon", 0.817857143),
    ("Gamma", 0.817857143),
    ("Self_Ref", 0.817857143),
    ("Zeta", 0.392857143),
]
RANKING_8 = [
    ("Alpha_Page", 2.376278506),
    ("Beta", 1.365225337),
    ("Gamma", 1.365225337),
    ("Delta", 0.679065336),
    ("Epsilon", 0.473317705),
    ("Self_Ref", 0.473317705),
    ("Zeta", 0.267570075),
]


@pytest.fixture
def dump(tmp_path):
    path = tmp_path / "wiki_mini.xml"
    path.write_text(WIKI_MINI, encoding="utf-8")
    return str(path)


@pytest.fixture
def blocks(spark, dump):
    return read_blocks(spark, dump, "<page>", "</page>")


def test_blocks_and_links(blocks):
    assert blocks.count() == 8
    pages = p.ranked_titles(p.parse_pages(blocks))
    assert {r.title for r in pages.collect()} == NODES
    raw = p.extract_links(pages)
    assert raw.count() == 17
    assert p.filter_links(raw).count() == 12
    targets = {r.dst for r in p.filter_links(raw).collect()}
    assert targets - NODES == {"", "Red_Link", "epsilon"}


def test_graph(blocks, scratch):
    graph, counts = dump_graph(blocks, scratch)
    assert counts == {"n_blocks": 8, "n_corrupt": 1, "n_untitled": 0}
    assert (graph.n_nodes, graph.n_edges) == (7, 8)
    assert {tuple(r) for r in graph.edges.select("src", "dst").collect()} == EDGES
    inlinks = {r.id: r.inlinks for r in inlink_lists(graph, scratch).collect()}
    assert inlinks == {
        "Alpha_Page": ["Beta", "Gamma"],
        "Beta": ["Alpha_Page"],
        "Delta": ["Epsilon", "Self_Ref"],
        "Epsilon": ["Epsilon"],
        "Gamma": ["Alpha_Page"],
        "Self_Ref": ["Self_Ref"],
    }


def _lines(spark, path):
    """Lines in the order of the part files."""
    parts = sorted(Path(path).glob("part-*"))
    return [line for part in parts for line in part.read_text(encoding="utf-8").splitlines()]


def test_whole_run(spark, dump, tmp_path):
    out = str(tmp_path / "results")
    report = rank_dump(spark, dump, out)
    assert (report.n_pages, report.n_links, report.n_corrupt) == (7, 8, 1)
    assert [round(sink, 9) for _, _, sink in report.masses] == SINK_MASSES
    assert all(abs(total - 7) < 1e-12 for _, total, _ in report.masses)
    assert _lines(spark, f"{out}/n") == ["N=7"]
    outlinks = {r.key: r.value for r in read_key_values(spark, f"{out}/outlinks").collect()}
    assert outlinks == {
        "Alpha_Page": "Beta Gamma",
        "Beta": "Alpha_Page",
        "Gamma": "Alpha_Page",
        "Delta": "",
        "Epsilon": "Delta Epsilon",
        "Self_Ref": "Delta Self_Ref",
        "Zeta": "",
    }
    for number, expected in ((1, RANKING_1), (8, RANKING_8)):
        lines = [line.split("\t") for line in _lines(spark, f"{out}/ranking_{number}")]
        assert [(name, round(float(rank), 9)) for name, rank in lines] == expected
    assert len(_lines(spark, f"{out}/masses")) == 8


def test_parquet_results(spark, dump, tmp_path):
    out = str(tmp_path / "results")
    rank_dump(spark, dump, out, iterations=2, snapshots=(2,), output_format="parquet")
    assert spark.read.parquet(f"{out}/n").first().n == 7
    assert spark.read.parquet(f"{out}/masses").count() == 2
    assert spark.read.parquet(f"{out}/ranking_2").count() == 7
    assert spark.read.parquet(f"{out}/outlinks").count() == 7


def test_results_replace_only_their_own_folders(spark, dump, tmp_path):
    out = tmp_path / "results"
    out.mkdir()
    (out / "notes.txt").write_text("mine")
    rank_dump(spark, dump, str(out), iterations=2)
    with pytest.raises(FileExistsError, match="ranking_2"):
        rank_dump(spark, dump, str(out), iterations=1)
    rank_dump(spark, dump, str(out), iterations=1, replace=True)
    assert (out / "notes.txt").read_text() == "mine"
    assert len(_lines(spark, out / "ranking_1")) == 7
    assert (out / "_SUCCESS").exists() and not (out / "ranking_2").exists()


def test_command_line(spark, dump, tmp_path, capsys):
    out = str(tmp_path / "results")
    main([dump, dump, out, "--iterations", "2", "--snapshots", "1", "2"])
    printed = capsys.readouterr().out
    assert "pages: 7, links: 8" in printed and "blocks: 16" in printed
    assert "round 2: total mass 7.0" in printed
    lines = [line.split("\t")[0] for line in _lines(spark, f"{out}/ranking_1")]
    assert lines == [name for name, _ in RANKING_1]


def test_bad_arguments(spark, dump, tmp_path):
    with pytest.raises(ValueError, match="output_format"):
        rank_dump(spark, dump, str(tmp_path / "out"), output_format="csv")
    with pytest.raises(ValueError, match="snapshots"):
        rank_dump(spark, dump, str(tmp_path / "out"), iterations=3, snapshots=(8,))
    with pytest.raises(ValueError, match="iterations"):
        rank_dump(spark, dump, str(tmp_path / "out"), iterations=0)
    assert not (tmp_path / "out").exists()


def test_default_snapshots_follow_the_rounds(spark, dump, tmp_path):
    rank_dump(spark, dump, str(tmp_path / "out"), iterations=5)
    names = {p.name for p in (tmp_path / "out").iterdir() if not p.name.startswith(".")}
    assert names == {"outlinks", "n", "masses", "ranking_1", "ranking_5", "_SUCCESS"}


@pytest.mark.parametrize("split_bytes", [300, 100_000_000])
def test_what_stands_before_the_first_start_tag_is_no_page(spark, tmp_path, split_bytes):
    page = "<page><title>{}</title><revision><text>[[A]] [[X]]</text></revision></page>\n"
    head = '<page id="1"><title>X</title></page>'
    (tmp_path / "one.xml").write_text(head + page.format("A") + page.format("B") * 9)
    (tmp_path / "two.xml").write_text("inside [[B]]</text></page>" + page.format("C") + "<page><title>D")
    with settings(spark, {"spark.sql.files.maxPartitionBytes": split_bytes}), Scratch(spark) as scratch:
        records = read_records(spark, str(tmp_path), "<page>", "</page>")
        graph, counts = dump_graph(records, scratch)
        assert {r.id for r in graph.nodes.collect()} == {"A", "B", "C"}
        assert counts == {"n_blocks": 11, "n_corrupt": 0, "n_untitled": 0}


def test_scratch_is_removed(spark, dump, tmp_path):
    def leftovers():
        folders = Path(spark.conf.get("spark.checkpoint.dir")).glob("linktide-*")
        tables = spark.catalog.listTables(DATABASE) if spark.catalog.databaseExists(DATABASE) else []
        return {f.name for f in folders} | {t.name for t in tables}

    before = leftovers()
    rank_dump(spark, dump, str(tmp_path / "out"), iterations=1, snapshots=(1,))
    assert leftovers() == before
