"""Token counts: Arrow functions that encode in batches and return lengths only."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from sendero.llm.batches import by_bytes, table_of
from sendero.llm.subwords import Subwords


def count_tokens(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_bytes, n_tokens)`` of every row's whole text under the tokenizer file ``path``.

    A null or empty text has 0 bytes and 0 tokens. Repeated rows and null keys keep a row each. Other columns are not
    read. Scan tasks hold about equal bytes; inside a task batches are cut by bytes and long texts at blanks between
    letters, so memory follows neither the number of rows nor a text's length. Nothing is shuffled.
    """
    schema = pa.schema([("n_bytes", pa.int64()), ("n_tokens", pa.int64())])

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Subwords(path)
        for batch in by_bytes(batches, "_text"):
            texts = batch.column("_text").to_pylist()
            counts = table_of(schema, [len((t or "").encode()) for t in texts],
                              [len(ids) // 4 for ids in encoder.encode_all(texts)])
            yield pa.RecordBatch.from_arrays([batch.column("_key"), *counts.columns], ["_key", *schema.names])

    kind = dict(docs.dtypes)[key]
    rows = docs.select(docs[key].alias("_key"), docs[text].alias("_text"))
    return rows.mapInArrow(lengths, f"_key {kind}, n_bytes bigint, n_tokens bigint").withColumnRenamed("_key", key)
