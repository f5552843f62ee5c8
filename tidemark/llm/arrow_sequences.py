"""Token ids as Arrow files of equal-length sequences.

Documents are ordered by id over range partitions, each of which writes one shard:

- ``<shard>.arrow``: Arrow file format; record batches of ``ids: fixed_size_list<uint16 or uint32>[L]``
  and ``mask: fixed_size_list<bool>[L]``. Documents follow one another through the sequences; the
  shard's last sequence is filled with zeros, which the mask marks. Buffers are not compressed, so a
  reader that maps the file reaches sequence ``i`` as batch ``i // rows``, row ``i % rows``, without a
  copy.
- ``<shard>.index.arrow``: ``doc_id``, ``start`` in the shard, ``n_tokens``.

A shard's name is new for every attempt of a task, and the manifest lists those that the job took, so
lost executors and repeated tasks leave no doubt about which files count. The manifest, one row per
shard, is the only thing that passes through the driver.

Null text is an empty document with its end token; rows that repeat an id are kept, ordered by their
text; a null id comes first. An empty table writes no shard. Other columns are not read.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import CLEANUP, scratch_path, shuffle_partitions
from tidemark.llm.encoding import encoder
from tidemark.session import setting

MANIFEST = "part int, shard string, n_docs long, n_tokens long"


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system that a qualified path names; a path without one could mean another to Spark."""
    if ":/" not in uri:
        raise ValueError(f"{uri}: not a URI")
    return fs.FileSystem.from_uri(uri)


class ShardWriter:
    """Writes one shard, batch by batch: memory holds one batch of sequences."""

    def __init__(self, path: str, length: int, rows: int, wide: bool):
        self.files, name = _open(path)
        self.files.create_dir(name.rsplit("/", 1)[0])
        self.length, self.rows = length, rows
        self.type = np.dtype("<u4" if wide else "<u2")
        item = pa.uint32() if wide else pa.uint16()
        self.schema = pa.schema([("ids", pa.list_(item, length)), ("mask", pa.list_(pa.bool_(), length))])
        self.index_schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "start", "n_tokens")])
        self.sink = self.files.open_output_stream(f"{name}.arrow")
        self.index_sink = self.files.open_output_stream(f"{name}.index.arrow")
        self.out = pa.ipc.new_file(self.sink, self.schema)
        self.index = pa.ipc.new_file(self.index_sink, self.index_schema)
        self.waiting: list[np.ndarray] = []
        self.held = self.n_tokens = self.n_docs = 0

    def add(self, doc_ids: list, documents: list[np.ndarray]) -> None:
        sizes = np.array([len(x) for x in documents], dtype=np.int64)
        starts = self.n_tokens + np.cumsum(sizes) - sizes
        columns = [pa.array(doc_ids, pa.int64()), pa.array(starts), pa.array(sizes)]
        self.index.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.index_schema))
        for ids in documents:
            self.waiting.append(ids)
            self.held += len(ids)
            if self.held >= self.length * self.rows:
                self._flush(False)
        self.n_tokens += int(sizes.sum())
        self.n_docs += len(doc_ids)

    def _flush(self, last: bool) -> None:
        flat = np.concatenate(self.waiting) if self.waiting else np.empty(0, self.type)
        # All batches but the last are full, so that a sequence's batch follows from its number.
        full = len(flat) if last else len(flat) - len(flat) % (self.length * self.rows)
        for i in range(0, full, self.length * self.rows):
            part = flat[i : min(full, i + self.length * self.rows)]
            n = -(-len(part) // self.length)
            ids = np.zeros(n * self.length, self.type)
            ids[: len(part)] = part
            mask = np.arange(n * self.length) < len(part)
            columns = [
                pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (ids, mask)
            ]
            self.out.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))
        rest = flat[full:]
        self.waiting, self.held = ([rest.copy()] if len(rest) else []), len(rest)

    def close(self) -> None:
        self._flush(True)
        for x in (self.out, self.index, self.sink, self.index_sink):
            x.close()


class ShardReader:
    """Random access to one shard: only the pages of the sequences asked for are read."""

    def __init__(self, path: str):
        files, name = _open(path)
        local = isinstance(files, fs.LocalFileSystem)
        opened = (pa.memory_map(f"{name}{x}") if local else files.open_input_file(f"{name}{x}") for x in (".arrow", ".index.arrow"))
        self.file, self.index = (pa.ipc.open_file(x) for x in opened)
        self.length = self.file.schema.field("ids").type.list_size
        self.rows = self.file.get_batch(0).num_rows if self.file.num_record_batches else 0

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids (a view of the file) and mask of one sequence."""
        batch = self.file.get_batch(i // self.rows)
        at = slice((i % self.rows) * self.length, (i % self.rows + 1) * self.length)
        ids = batch.column("ids").flatten().to_numpy()[at]
        return ids, batch.column("mask").flatten()[at].to_numpy(zero_copy_only=False)

    def documents(self) -> Iterator[tuple[list, np.ndarray, list[np.ndarray]]]:
        """Doc ids, starts in the shard and ids, index batch by index batch."""
        number, flat, base = 0, np.empty(0, self.file.schema.field("ids").type.value_type.to_pandas_dtype()), 0
        for k in range(self.index.num_record_batches):
            batch = self.index.get_batch(k)
            starts, sizes = (batch.column(c).to_numpy() for c in ("start", "n_tokens"))
            documents = []
            for start, size in zip(starts.tolist(), sizes.tolist(), strict=True):
                parts = [flat[start - base :]]
                while base + len(flat) < start + size:
                    base += len(flat)
                    flat = self.file.get_batch(number).column("ids").flatten().to_numpy()
                    number += 1
                    parts.append(flat)
                joined = np.concatenate(parts) if len(parts) > 1 else parts[0]
                documents.append(joined[:size])
            yield batch.column("doc_id").to_pylist(), starts, documents


def write_sequences(
    docs: DataFrame, folder: str, path: str, end: int = 2, length: int = 2048, rows: int = 64
) -> list[tuple]:
    """Write the shards and return their manifest rows in document order, with each one's first token.

    ``path``: vocabulary file; ``rows``: sequences in a record batch.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, writer, tail = encoder(path), None, np.array([end], "<u4").tobytes()
        shard = f"{folder}/{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                if writer is None:
                    writer = ShardWriter(shard, length, rows, encode.size() > 1 << 16)
                texts = part.column(1).to_pylist()
                ids = [np.frombuffer(encode.ids(x) + tail, "<u4").astype(writer.type) for x in texts]
                writer.add(part.column(0).to_pylist(), ids)
        if writer is not None:
            writer.close()
            row = [TaskContext.get().partitionId(), shard, writer.n_docs, writer.n_tokens]
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(row, (pa.int32(), pa.string(), pa.int64(), pa.int64()), strict=True)],
                names=["part", "shard", "n_docs", "n_tokens"],
            )

    n = shuffle_partitions(docs.sparkSession)
    ordered = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text")
    ordered = ordered.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
    with setting(docs.sparkSession, CLEANUP, "true"):
        shards = sorted(tuple(r) for r in ordered.mapInArrow(run, MANIFEST).collect())
    first, out = 0, []
    for _, shard, n_docs, n_tokens in shards:
        out.append((shard, n_docs, n_tokens, first))
        first += n_tokens
    return out


def read_documents(spark: SparkSession, manifest: list[tuple]) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens and ids_crc32, from the shards."""
    out = [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for doc_ids, starts, documents in ShardReader(shard).documents():
                    columns = [
                        pa.array(doc_ids, pa.int64()),
                        pa.array(starts + first),
                        pa.array([len(x) for x in documents], pa.int64()),
                        pa.array([zlib.crc32(x.astype("<u4")) for x in documents], pa.int64()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, schema=pa.schema(out))

    rows = [(shard, first) for shard, _, _, first in manifest]
    frame = spark.createDataFrame(rows, "shard string, first long")
    return frame.repartition(max(1, len(rows))).mapInArrow(run, ", ".join(f"{n} long" for n, _ in out))


def sequences_of(docs: DataFrame, path: str, end: int = 2, length: int = 2048) -> DataFrame:
    """Write ``docs`` to a new folder of the shared storage and read its documents back."""
    spark = docs.sparkSession
    return read_documents(spark, write_sequences(docs, scratch_path(spark, "sequences"), path, end, length))
