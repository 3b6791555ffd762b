"""Decontamination against a search for every window in plain Python."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from linktide.llm.automaton import ItemAutomaton
from linktide.llm.decontaminate import decontaminate, mark_contamination


def words_of(text):
    folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded)


def hits(doc, items, window):
    places, names = set(), set()
    for key, item in items:
        n = min(window, len(item))
        for s in range(len(item) - n + 1 if n else 0):
            for p in range(len(doc) - n + 1):
                if doc[p : p + n] == item[s : s + n]:
                    places |= set(range(p, p + n))
                    names.add(key)
    return places, names


def test_automaton_against_search():
    rng = random.Random(3)
    for _ in range(400):
        letters, window = rng.choice([2, 3, 6]), rng.choice([1, 2, 3, 5])
        items = [(str(k), [bytes([97 + rng.randrange(letters)]) for _ in range(rng.randrange(9))]) for k in range(rng.randrange(5))]
        automaton = ItemAutomaton(items, window)
        doc = [bytes([97 + rng.randrange(letters + 1)]) for _ in range(rng.randrange(40))]
        spans, names = automaton.matches(np.array([automaton.vocabulary.get(w, -1) for w in doc], np.int64))
        assert ({i for a, b in spans for i in range(a, b)}, names) == hits(doc, items, window)


ITEMS = [
    (1, "The quick brown fox jumps over the lazy dog near the old river bank"),
    (2, "Tiny item"), (3, "tiny, ITEM!"), (4, None), (5, ""), (6, "..."), (None, "nameless one"),
    (7, "é日本 is a word here"), (1, "The quick brown fox jumps over the lazy dog near the old river bank"),
]
TEXTS = [
    (1, "Before. The QUICK brown, fox jumps over the lazy dog -- near the old mill. After tiny  item x"),
    (2, "quick brown fox jumps over the lazy dog near"), (3, None), (4, ""), (5, "a nameless one; and"),
    (6, "x é日本 is a word here"), (6, "clean text of the same id"), (None, "tiny item"), (7, "word " * 30_000 + "Tiny item"),
]


@pytest.mark.parametrize("block_words", [4, 200_000])
def test_marks(spark, make_docs, block_words):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    marked, names = mark_contamination(make_docs(TEXTS), items, block_words=block_words)
    spelled = [("" if k is None else str(k), words_of(t)) for k, t in ITEMS]
    want = []
    for doc_id, text in TEXTS:
        doc = words_of(text)
        places, found = hits(doc, spelled, 10)
        want.append((doc_id, len(doc), len(places), sorted(found)))
    rows = marked.select("doc_id", names.n_words, names.n_hit, names.items).collect()
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, want))


def test_spans_are_cut_out(spark, make_docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = make_docs(TEXTS)
    kept = decontaminate(docs, items, max_coverage=0.9)
    assert kept.columns == docs.columns
    left = {(r.doc_id, r.text): r.n_chars for r in kept.collect()}
    texts = sorted((t for _, t in left if t is not None), key=len)
    assert "Before.  mill. After  x" in texts and "a ; and" in texts
    assert (3, None) in left and (4, "") in left and (6, "clean text of the same id") in left
    assert (None, "tiny item") not in left  # all of it is an item
    assert all(n == len(t) for (_, t), n in left.items() if t is not None)
    assert not any(hits(words_of(t), [("", words_of(i)) for _, i in ITEMS], 10)[0] for t in texts)


def test_empty_tables(spark, make_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = make_docs(TEXTS)
    assert decontaminate(docs, none).count() == len(TEXTS)
    some = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontaminate(make_docs([]), some).count() == 0
