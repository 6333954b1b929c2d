from __future__ import annotations

import duckdb
import pytest

EDGE_TEXTS = [
    (1, "A plain text of a few words, twice told."), (2, None), (3, ""), (4, " \t\n "), (5, "A plain text of a few words, twice told."),
    (6, "Ünïcode – dashes, ½ and 日本語, <|endoftext|> inside; it's  two  blanks \n"), (7, "x" * 30_000), (8, "ab " * 20_000),
    (None, "no key at all"), (1, "A plain text of a few words, twice told."), (9, "\x1c odd \x85 blanks here"), (10, "i'LL I'S a\n b "),
]


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls, empty and long texts, ties, repeated rows, and extra columns whose names clash with results."""
    return spark.createDataFrame([(k, t, "x", -1.0, [0], True, b"?") for k, t in EDGE_TEXTS],
                                 "doc_id bigint, text string, ids string, n_tokens double, spans array<int>, kept boolean, row binary")


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.where("doc_id < -5")


@pytest.fixture(scope="session")
def documents(sf_dir):
    return duckdb.connect().execute(f"SELECT doc_id, text FROM '{sf_dir}/documents.parquet'").fetchall()
