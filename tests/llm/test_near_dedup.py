"""Near-duplicates against all pairs in plain Python."""

from __future__ import annotations

import random
import re
from pathlib import Path

import pytest

from linktide.llm import membership
from linktide.llm.components import components
from linktide.llm.near_dedup import drop_near_duplicates, near_duplicates


def shingles(text, words):
    lower = {i: i + 32 for i in range(65, 91)}
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(lower))
    return frozenset(tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))) if w else frozenset()


def expected(rows, words, percent=80):
    sets = [shingles(t, words) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b]:
                shared = len(sets[a] & sets[b])
                if 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                    root[find(a)] = find(b)
    out = []
    for k, (doc_id, *_) in enumerate(rows):
        members = [rows[j][0] for j in range(len(rows)) if find(j) == find(k) and rows[j][0] is not None]
        least = min(members, default=None) if sets[k] else doc_id
        out.append((doc_id, len(sets[k]), least, doc_id is not None and doc_id == least))
    return out


def copies(seed=1, base_words=60):
    """Groups of near copies around the threshold, a large one among them."""
    rng = random.Random(seed)
    rows, doc_id = [], 100
    for n in (2, 5, 40):
        base = [f"w{rng.randrange(5000)}" for _ in range(base_words)]
        for _ in range(n):
            words = list(base)
            for _ in range(rng.randrange(4)):
                words[rng.randrange(len(words))] = f"x{rng.randrange(5000)}"
            rows.append((doc_id, " ".join(words)))
            doc_id += 1
    return rows


def by_value(rows):
    return sorted(rows, key=str)


@pytest.mark.parametrize("group_rows", [6, 1000])
@pytest.mark.parametrize("words", [4, 5])
def test_against_all_pairs(make_docs, scratch, odd_texts, words, group_rows):
    rows = odd_texts + copies()
    found = near_duplicates(make_docs(rows), scratch, words=words, group_rows=group_rows)
    assert by_value(map(tuple, found.collect())) == by_value(expected(rows, words))


def boilerplate(n, seed=3):
    """Texts that share most of their words and are linked with nothing, and a few pairs."""
    rng = random.Random(seed)
    frame = " ".join(f"licence{k}" for k in range(70))
    rows = [(k, f"{frame} " + " ".join(f"own{rng.randrange(10**9)}" for _ in range(45))) for k in range(n)]
    return rows + [(n + k, t + " end") for k, (_, t) in enumerate(rows[: n // 50])]


@pytest.mark.parametrize("n", [600, 1200])
def test_groups_that_only_share_a_frame_stay_linear(spark, make_docs, scratch, n):
    rows = boilerplate(n)
    found = near_duplicates(make_docs(rows), scratch, words=4, group_rows=50).collect()
    assert {r.doc_id: r.component_id for r in found} == {k: k if k < n else k - n for k, _ in rows}
    tables = {p.name.split("_", 1)[1]: p for p in sorted(Path(scratch.folder).iterdir())}
    assert "unlinked" in tables  # the leader of a large group has left a rest
    stored = {name: spark.read.parquet(str(p)).count() for name, p in tables.items()}
    # Nothing that is moved for the rest grows with the square of the group.
    assert stored["again"] <= len(rows) and stored["members"] <= 4 * len(rows)
    assert stored["shingle_groups"] <= 4 * len(rows)


def test_no_rows_and_no_words(make_docs, scratch):
    assert near_duplicates(make_docs([]), scratch).collect() == []
    rows = near_duplicates(make_docs([(1, None), (2, "")]), scratch).collect()
    assert by_value(map(tuple, rows)) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_one_of_each_group_stays(make_docs, scratch, odd_texts):
    rows = odd_texts + copies()
    docs = make_docs(rows)
    kept = drop_near_duplicates(docs, scratch)
    assert kept.columns == docs.columns
    names = sorted({(i, t) for (i, t), e in zip(rows, expected(rows, 5), strict=True) if e[3]}, key=str)
    assert by_value((r.doc_id, r.text) for r in kept.where("doc_id is not null").collect()) == names


def test_components_of_paths_and_stars(spark, scratch):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (None, 3)]
    found = components(spark.createDataFrame(links, "a long, b long"), scratch)
    roots = {r.node: r.root for r in found.collect()}
    assert roots == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 140)}


@pytest.mark.parametrize("most_bits", [64, 1 << 27])
def test_filter_never_drops_an_id(spark, scratch, monkeypatch, most_bits):
    monkeypatch.setattr(membership, "MOST_BITS", most_bits)
    ids = spark.range(0, 3000, 7).union(spark.createDataFrame([(None,)], "id long"))
    rows = spark.range(3000).union(spark.createDataFrame([(None,), (6,)], "id long"))
    maybe, sure = membership.IdFilter(ids, "id", scratch).split(rows.selectExpr("cast(id as int) as id"), "id")
    maybe, sure = ([r.id for r in x.collect()] for x in (maybe, sure))
    assert set(range(0, 3000, 7)) <= set(maybe) and not set(range(0, 3000, 7)) & set(sure)
    assert sorted(maybe + sure, key=str) == sorted([*range(3000), None, 6], key=str)
    assert most_bits == 64 or len(maybe) < 700
