"""Arrow batches of a bounded number of bytes."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa

BATCH_BYTES = 4 << 20


def by_bytes(batches: Iterable[pa.RecordBatch], column: str, size: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``size`` bytes of ``column``; a longer value gets a batch of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        start, total = 0, 0
        for i, value in enumerate(batch.column(column)):
            length = value.as_buffer().size if value.is_valid else 0
            if total and total + length > size:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += length
        yield batch.slice(start)


def table_of(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) if not isinstance(c, pa.Array) else c.cast(f.type)
                                       for c, f in zip(columns, schema)], schema=schema)
