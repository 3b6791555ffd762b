from __future__ import annotations

import pytest

from __spark_entry__ import _ship

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, size long, key string, "
    "n_words int, kept boolean, spans string, row string, score double, hit_spans int, `key.b` int"
)


@pytest.fixture(autouse=True)
def shipped(spark):
    _ship(spark)


@pytest.fixture
def make_docs(spark):
    """Documents ``(doc_id, text)`` or ``(doc_id, text, source)``, with columns that clash."""

    def make(rows):
        filled = [
            (i, t, "en", s[0] if s else "src", None if t is None else len(t), -1, "k", -2, False, "s", "r", -3.0, 4, 5)
            for i, t, *s in rows
        ]
        return spark.createDataFrame(filled, SCHEMA).repartition(3)

    return make


@pytest.fixture
def odd_texts():
    """Null, empty, blank, repeated and very long texts."""
    long = " ".join(f"w{i % 977}x{i * i % 313}" for i in range(30_000))
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, long), (6, long), (7, "a b c d e f g h i j k"),
        (7, "a b c d e f g h i j k"), (7, "another text under the same id"), (None, "a b c d e f g h i j k"),
        (8, "é日本 \U0001F600 x" * 50), (9, "q" * 50_000),
    ]
