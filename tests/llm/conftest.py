from __future__ import annotations

import pytest

ANY = "doc_id long, text string, lang string, source string, n_chars long, body string, id long, row string, mix int, q int, kept int, _w int"


@pytest.fixture
def make(spark):
    """A documents table from texts, with columns whose names operators use inside."""

    def build(texts, ids=None, langs=None, sources=None):
        n = len(texts)
        rows = [
            (
                ids[i] if ids else i,
                texts[i],
                langs[i] if langs else "en",
                sources[i] if sources else "s",
                None if texts[i] is None else len(texts[i]),
                "b", 7, "r", 1, 2, 3, 4,
            )
            for i in range(n)
        ]
        return spark.createDataFrame(rows, ANY).repartition(3)

    return build


@pytest.fixture
def odd_texts():
    """Null, empty, blank, tiny, repeated, Unicode and very long texts."""
    long = " ".join(f"w{i % 977}x{i % 13}" for i in range(40_000))
    return [None, "", " \n\t ", "one", "one", "a b c d", "é ü ß 漢字 😀 word " * 30, long, long + " tail", "x" * 30_000, "\n".join(["same line here"] * 40)]
