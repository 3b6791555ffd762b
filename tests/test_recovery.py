"""Journal, resumed runs and published results."""

from __future__ import annotations

import random

import pytest

from linktide import rank_dump, rank_graph
from linktide.journal import Journal
from linktide.operators import rank as r
from linktide.plans import rank_dump as plan
from linktide.sinks.published import POINTER, published


class DriverDied(BaseException):
    pass


@pytest.fixture
def rounds(monkeypatch):
    """Counts rounds; ``die_in`` makes one fail."""

    class Rounds:
        done, die_in = 0, None

    real = r.damped_update

    def update(*args, **options):
        Rounds.done += 1
        if Rounds.done == Rounds.die_in:
            raise DriverDied
        return real(*args, **options)

    monkeypatch.setattr(r, "damped_update", update)
    return Rounds


@pytest.fixture
def graph(graph_of):
    rng = random.Random(2)
    nodes = [f"n{i}" for i in range(60)]
    return graph_of(nodes, [(rng.choice(nodes), rng.choice(nodes[:30])) for _ in range(300)])


def ranks(ranked, number):
    return {row.id: row.rank for row in ranked.ranks(number).collect()}


def test_a_run_that_died_goes_on(spark, graph, scratch, rounds, tmp_path):
    whole = rank_graph(graph, scratch)
    rounds.done, rounds.die_in = 0, 4
    folder = str(tmp_path / "journal")
    journal = Journal(spark, folder, {"damping": 0.85})
    with pytest.raises(DriverDied), journal.scratch() as kept:
        rank_graph(graph, kept, journal=journal)
    # A session that knows nothing of the first one's tables.
    rounds.done, rounds.die_in = 0, None
    again = Journal(spark, folder, {"damping": 0.85})
    with again.scratch() as kept:
        resumed = rank_graph(graph, kept, journal=again)
        assert rounds.done == 5
        assert ranks(resumed, 8) == ranks(whole, 8) and ranks(resumed, 1) == ranks(whole, 1)
        assert resumed.metric_rows == whole.metric_rows
    # All is recorded: nothing is computed, and a snapshot that is gone is computed again.
    rounds.done = 0
    with again.scratch() as kept:
        assert ranks(rank_graph(graph, kept, journal=again), 8) == ranks(whole, 8) and rounds.done == 0
        other = rank_graph(graph, kept, snapshots=(0, 2, 8), journal=again)
        assert rounds.done == 7 and ranks(other, 8) == ranks(whole, 8)
        assert set(ranks(other, 0).values()) == {1.0}
    again.remove()
    assert not (tmp_path / "journal").exists()


def test_a_record_without_its_round_does_not_count(spark, graph, scratch, rounds, tmp_path):
    journal = Journal(spark, str(tmp_path / "journal"))
    rounds.die_in = 3
    with pytest.raises(DriverDied), journal.scratch() as kept:
        rank_graph(graph, kept, journal=journal)
    (tmp_path / "journal" / ".round_3-draft").write_text('{"half')
    assert journal.read("round_2") and journal.read("round_1") and journal.read("round_3") is None
    rounds.die_in = None
    with journal.scratch() as kept:
        assert ranks(rank_graph(graph, kept, journal=journal), 8) == ranks(rank_graph(graph, scratch), 8)


def test_a_journal_of_another_run_is_refused(spark, tmp_path):
    Journal(spark, str(tmp_path), {"damping": 0.85})
    with pytest.raises(ValueError, match="another run"):
        Journal(spark, str(tmp_path), {"damping": 0.5})


@pytest.fixture
def dump(tmp_path):
    page = "<page><title>{}</title><revision><text>{}</text></revision></page>\n"
    links = {"A": "[[B]] [[C]]", "B": "[[A]]", "C": "", "D": "[[A]] [[D x]]", "D x": "[[B]]"}
    path = tmp_path / "dump.xml"
    path.write_text("".join(page.format(t, x) for t, x in links.items()))
    return path


def read(spark, folder):
    return {row.id: row["rank"] for row in spark.read.parquet(f"{folder}/ranking_8").collect()}


@pytest.mark.parametrize("versioned", [True, False])
def test_a_dump_run_that_died_goes_on(spark, dump, tmp_path, rounds, monkeypatch, versioned):
    options = {"output_format": "parquet", "versioned": versioned, "resume": True}
    rank_dump(spark, str(dump), str(tmp_path / "whole"), output_format="parquet")
    out = tmp_path / "out"
    rounds.done, rounds.die_in = 0, 6
    with pytest.raises(DriverDied):
        rank_dump(spark, str(dump), str(out), **options)
    rounds.done, rounds.die_in = 0, None
    monkeypatch.setattr(plan, "ingest", None)  # not parsed again
    report = rank_dump(spark, str(dump), str(out), **options)
    assert rounds.done == 3 and report.n_pages == 5 and len(report.masses) == 8
    folder = published(spark, str(out)) if versioned else out
    assert read(spark, folder) == read(spark, tmp_path / "whole")
    assert not (out / "_journal").exists()


def test_changed_files_are_another_run(spark, dump, tmp_path, rounds):
    rounds.die_in = 2
    out = str(tmp_path / "out")
    with pytest.raises(DriverDied):
        rank_dump(spark, str(dump), out, resume=True)
    dump.write_text(dump.read_text() + "<page><title>E</title><text>[[A]]</text></page>")
    with pytest.raises(ValueError, match="another run"):
        rank_dump(spark, str(dump), out, resume=True)


def test_a_failed_run_leaves_the_published_results(spark, dump, tmp_path, monkeypatch):
    out = tmp_path / "out"
    options = {"output_format": "parquet", "versioned": True}
    with pytest.raises(FileNotFoundError):
        published(spark, str(out))
    rank_dump(spark, str(dump), str(out), **options)
    first, before = published(spark, str(out)), read(spark, published(spark, str(out)))

    def broken(*args):
        real(*args)
        raise DriverDied

    real = plan._write_parquet
    with monkeypatch.context() as patch:
        patch.setattr(plan, "_write_parquet", broken)
        with pytest.raises(DriverDied):
            rank_dump(spark, str(dump), str(out), damping=0.5, **options)
    assert published(spark, str(out)) == first and read(spark, first) == before
    assert len(list((out / "versions").iterdir())) == 1
    for _ in range(2):
        rank_dump(spark, str(dump), str(out), damping=0.5, **options)
    assert published(spark, str(out)) != first and read(spark, published(spark, str(out))) != before
    names = {p.name for p in (out / "versions").iterdir()}
    assert len(names) == 2 and first.rsplit("/", 1)[1] not in names  # the last two stay
    assert {p.name for p in out.iterdir() if not p.name.startswith(".")} == {"versions", POINTER}
