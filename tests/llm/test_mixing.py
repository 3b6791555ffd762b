"""Mixing against a plain computation of targets, and what the sample must hold."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict
from fractions import Fraction

import pytest

from linktide.llm.mixing import mix_documents, mixed_sizes


def targets(sizes, weights=(5, 2, 1), share=1.5, most=2):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    left, free, found = share * sum(sizes.values()), set(names), {}
    while free:
        total = sum(weight[s] for s in free)
        above = [s for s in free if left * weight[s] / total > most * sizes[s]]
        if not above:
            return found | {s: left * weight[s] / total for s in free}
        for s in above:
            found[s] = most * sizes[s]
            free.discard(s)
        left -= sum(found[s] for s in above)
    return found


def chances(sizes, want):
    """Chances in proportion to size, the certain ones 1, that expect ``want`` words."""
    fitting = {k: n for k, n in sizes.items() if 0 < n <= want}
    certain = set()
    while True:
        rest = {k: n for k, n in fitting.items() if k not in certain}
        scale = Fraction(want - sum(fitting[k] for k in certain), sum(n * n for n in rest.values()) or 1)
        above = [k for k, n in rest.items() if scale * n > 1]
        if not above:
            return dict.fromkeys(certain, 1.0) | {k: float(scale) * n for k, n in rest.items()}
        # One size at a time: the others' chances change with it.
        certain |= {k for k in above if fitting[k] == max(fitting[a] for a in above)}


def drawn(texts, want, seed="mix"):
    """The documents of one source that the sample holds: ``texts`` by doc_id."""
    sizes = {k: len(t.split()) for k, t in texts.items()}
    order = []
    for k, p in chances(sizes, want).items():
        digits = hashlib.md5(f"{seed}:{k}".encode()).hexdigest()[:13]
        u = (int(digits, 16) + 0.5) / 2**52
        key = f"{digits}:{k}:{hashlib.md5(texts[k].encode()).hexdigest()}"
        order.append((0.0 if p >= 1 else u / (1 - u) / (p / (1 - p)), key, k))
    order.sort()
    gap, held = want, []
    for q, key, k in order:
        if sizes[k] <= gap:
            gap -= sizes[k]
            held.append((q, key, k))
    if gap:
        keys = {k: (q, key) for q, key, k in order}
        left = [(keys.get(k, (float("inf"), "")), k) for k in texts if sizes[k] and k not in {h[2] for h in held}]
        last, first = {0: None}, {}
        last |= {sizes[k]: k for q, _, k in held if q > 0}
        for _, k in sorted(left, reverse=True):
            first[sizes[k]] = k
        best = min(((abs(gap + a - b), a, b) for a in last for b in first), default=(gap,))
        if best[0] < gap:
            return {h[2] for h in held} - {last[best[1]]} | {first[best[2]]}
    return {h[2] for h in held}


@pytest.fixture
def rows():
    rng = random.Random(4)
    sources = ["a", "b", "é", "B", None, "empty"]
    made = [(k, "w " * min(400, int(rng.paretovariate(1.1) * 5)), rng.choice(sources[:5])) for k in range(900)]
    made += [(1000, "", "empty"), (1001, None, "empty"), (1002, "x y", None), (None, "no id", "a")]
    return made + [(k, "w " * 30, "hot") for k in range(2000, 2600)]


@pytest.mark.parametrize("rows_per_bucket", [7, 50_000])
def test_targets_and_samples(make_docs, scratch, rows, rows_per_bucket):
    docs = make_docs(rows)
    found = mixed_sizes(docs, scratch, rows_per_bucket=rows_per_bucket).collect()
    size = {i: len((t or "").split()) for i, t, _ in rows}
    source = {i: s for i, _, s in rows}
    sizes = defaultdict(int)
    for i, n in size.items():
        sizes[source[i]] += n
    want, taken = targets(sizes), defaultdict(int)
    for r in found:
        s = source[r.doc_id]
        assert r.size == size[r.doc_id] and r.source_size == sizes[s]
        assert r.target == pytest.approx(want[s])
        assert r.taken in {0, r.size, 2 * r.size}
        copies = int(want[s] // sizes[s]) if sizes[s] else 0
        assert r.taken >= copies * r.size
        taken[s] += r.taken
    assert len(found) == len(rows)
    least = {s: min((size[i] for i in size if source[i] == s and size[i]), default=0) for s in sizes}
    assert all(abs(taken[s] - want[s]) <= max(0.005 * want[s], least[s]) for s in sizes)
    # The buckets only find the cut; the sample is the same without them, and in reruns.
    again = mixed_sizes(docs.repartition(5), scratch).collect()
    assert {(r.doc_id, r.taken) for r in again} == {(r.doc_id, r.taken) for r in found}
    other = mixed_sizes(docs, scratch, seed="other").collect()
    assert {(r.doc_id, r.taken) for r in other} != {(r.doc_id, r.taken) for r in found}


def test_long_documents_do_not_end_a_source(make_docs, scratch):
    rows = [(1001 * s + k, "w " * (100 if k else 60_000), f"s{s}") for s in range(7) for k in range(1001)]
    found = mixed_sizes(make_docs(rows), scratch, weights=(1,), share_percent=15, rows_per_bucket=500).collect()
    taken = defaultdict(int)
    for r in found:
        assert r.target == 24_000
        taken[r.doc_id // 1001] += r.taken
    assert dict(taken) == dict.fromkeys(range(7), 24_000)


@pytest.mark.parametrize("seed", ["mix", "x"])
def test_sample_against_plain_python(make_docs, scratch, seed):
    rng = random.Random(7)
    texts = {s: {1000 * s + k: "w " * int(rng.paretovariate(0.8) * 3) for k in range(80)} for s in range(4)}
    rows = [(k, t, f"s{s}") for s, group in texts.items() for k, t in group.items()]
    found = mixed_sizes(make_docs(rows), scratch, seed=seed, share_percent=60, rows_per_bucket=20).collect()
    for s, group in texts.items():
        mine = [r for r in found if r.doc_id // 1000 == s]
        copies, want = divmod(mine[0].target, mine[0].source_size)
        held = drawn(group, int(want + 0.5), seed)
        assert {r.doc_id for r in mine if r.taken > copies * r.size} == held


def test_sampled_as_often_as_the_chances_say():
    rng = random.Random(3)
    texts = {k: "w " * rng.randrange(5, 60) for k in range(300)} | {400: "w " * 2000}
    sizes = {k: len(t.split()) for k, t in texts.items()}
    want = sum(sizes.values()) // 2
    p = chances(sizes, want)
    assert sum(p[k] * sizes[k] for k in p) == pytest.approx(want)
    runs = 400
    seen = defaultdict(int)
    for seed in range(runs):
        for k in drawn(texts, want, seed=str(seed)):
            seen[k] += 1
    certain = [k for k in p if p[k] >= 1]
    assert certain and all(seen[k] == runs for k in certain)
    # Four deviations of 400 draws; the mean shows that no kind of document is favoured.
    assert max(abs(seen[k] / runs - p[k]) for k in p) <= 0.1
    assert sum(abs(seen[k] / runs - p[k]) for k in p) / len(p) < 0.03


def test_documents_as_often_as_taken(make_docs, scratch, rows):
    docs = make_docs(rows)
    mixed = mix_documents(docs, scratch)
    assert mixed.columns == docs.columns
    want = {r.doc_id: r.taken // r.size for r in mixed_sizes(docs, scratch).collect() if r.size}
    got = defaultdict(int)
    for r in mixed.collect():
        got[r.doc_id] += 1
    assert {i: n for i, n in want.items() if n} == {i: n for i, n in got.items() if i not in (1000, 1001)}


def test_repeated_rows_go_together(make_docs, scratch):
    docs = make_docs([(1, "a b c", "s")] * 5 + [(k, "a b c", "t") for k in range(2, 40)])
    taken = [r.taken for r in mixed_sizes(docs, scratch).where("doc_id = 1").collect()]
    assert len(taken) == 5 and len(set(taken)) == 1


def test_nothing_to_mix(make_docs, scratch):
    assert mixed_sizes(make_docs([]), scratch).collect() == []
    assert mix_documents(make_docs([]), scratch).collect() == []
    empty = mixed_sizes(make_docs([(1, None, "a"), (2, "", None)]), scratch).collect()
    assert [(r.size, r.target, r.taken) for r in empty] == [(0, 0.0, 0)] * 2


def test_no_python_runs(make_docs, scratch, rows):
    plan = mixed_sizes(make_docs(rows), scratch)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
