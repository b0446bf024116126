from __future__ import annotations

import pytest

#: Null, empty, very long, repeated, odd and tied texts, with columns whose names the operators use inside.
EDGES = [
    (1, None), (2, ""), (3, " \n\t"), (4, "a"), (5, "To be, or not to be: that is the question.\n" * 3), (6, "To be, or not to be: that is the question.\n" * 3), (7, "x" * 5000), (8, "漢字 and 😀 ▁ <|endoftext|> é ﬁ " * 20),
    (9, "word " * 3000), (9, "word " * 3000), (10, "Licensed under CC BY-NC 4.0.\nReleased under the MIT License."), (11, "12 34 ### $$$ %%% | | |"), (12, "\x00\x01\x1f odd ퟿"),
]


@pytest.fixture(scope="module")
def edges(spark):
    rows = [(i, t, "en" if i % 2 else None, "s", 7.0, "clash", 1, [1]) for i, t in EDGES]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars double, word string, shard int, spans array<int>")


@pytest.fixture(scope="module")
def none(edges):
    return edges.limit(0)


@pytest.fixture(scope="session")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
