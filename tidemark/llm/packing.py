"""Packing by power-of-two decomposition.

Each document's tokens are cut into as many pieces of the longest length as fit, and the rest into
pieces of descending powers of two, by the binary digits of its length. Every piece is a sequence of
its own, so no sequence crosses documents, none is padded, and sequences of equal length form the
buckets that batches are drawn from. There is no shuffle: a document's pieces depend on it alone.

Null text is an empty document, which still has its end token. Repeated rows are packed again, with
sequence ids of their own. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tidemark.llm.encoding import encoder

LONGEST = 4096
SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
    "offset long, bucket int"
)


def lengths(n: int, longest: int = LONGEST) -> list[int]:
    """Descending powers of two that add up to ``n``."""
    rest = n % longest
    return [longest] * (n // longest) + [
        1 << b for b in range(longest.bit_length() - 1, -1, -1) if rest >> b & 1
    ]


def pack(docs: DataFrame, path: str, end: int = 2, longest: int = LONGEST, tokens: bool = True) -> DataFrame:
    """One row per piece, in document order; ``bucket`` is the length's exponent.

    ``tokens`` adds ``ids``, the piece's token ids. ``path``: vocabulary file. Sequence ids are unique
    in the result: the task's number and a count within it.
    """
    if longest & (longest - 1):
        raise ValueError("the longest sequence must be a power of two")
    fields = [
        *((n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")),
        ("bucket", pa.int32()),
        *([("ids", pa.list_(pa.int32()))] if tokens else []),
    ]
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, last = encoder(path), np.array([end], "<u4").tobytes()
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            rows: list[list] = [[] for _ in fields]
            for doc_id, text in zip(*(batch.column(c).to_pylist() for c in (0, 1)), strict=True):
                ids = memoryview(encode.ids(text) + last)
                n, start = len(ids) // 4, 0
                for size in lengths(n, longest):
                    piece = ids[4 * start : 4 * (start + size)]
                    row = (doc_id, start, size, zlib.crc32(piece), n, number, 0, size.bit_length() - 1)
                    for out, value in zip(rows, row, strict=False):
                        out.append(value)
                    if tokens:
                        rows[-1].append(np.frombuffer(piece, "<i4"))
                    start += size
                    number += 1
                if len(rows[0]) >= 8192:
                    yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(rows, schema, strict=True)], schema=schema)
                    rows = [[] for _ in fields]
            if rows[0]:
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(rows, schema, strict=True)], schema=schema)

    return docs.select(docs["doc_id"].cast("long"), "text").mapInArrow(
        run, SCHEMA + (", ids array<int>" if tokens else "")
    )


def write_buckets(packed: DataFrame, path: str) -> None:
    """Sequences as Parquet, one folder per length, for readers that draw batches of one length."""
    packed.select("bucket", "sequence_id", "doc_id", "start", "ids").write.partitionBy("bucket").parquet(path)
