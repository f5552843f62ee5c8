"""Exact substring deduplication on a compacted De Bruijn graph of token k-mers.

A window is ``SPAN`` consecutive words. Each word covered by a window whose words also start in a document
with a smaller id is removed; windows are judged on the input.

Edges are k-mers of ``K`` words. Only closed syncmers are kept: k-mers whose least ``Q``-word shingle is their
first or last, which depends on the k-mer's words alone, and one of which lies in every window. An edge of
one document only means that no window around it is shared, which settles most of the text at once.

Edges that several documents have form the repeated graph. Where every occurrence of an edge is followed by
the same edge at the same distance, and that one always preceded by it, the two belong to one nonbranching
path. All occurrences of a path's edges run along the whole path, so a window inside it occurs exactly where
the path does, and the path's least document decides. Windows across the ends of paths are few: they are
written out with their source coordinates and verified by a 128-bit hash of their ``SPAN`` words.

Edges and windows are combined by Spark joins and aggregates, partial before each shuffle; a passage in a
third of all documents is one row a task in the aggregates, and the joins can be split. Text is
shuffled twice, to meet its edges and to lose its words; no group of rows is gathered but those of one
document. A row is known by its id and a hash of its text's sha256, so that no text can be made to pass for another.

Null texts have no words and keep no text. A null id counts as the least. Rows of equal id are one
document to each other: they never remove each other's words; rows of equal id and text have equal results.
Short texts and empty tables are allowed. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import blocks, dropped, grams, mixed, owners, signed, words, written

SPAN, K, Q = 50, 26, 4
LEAST = -(1 << 63)
END = np.uint64(0x5851F42D4C957F2D)
EDGES = "edge long, key long, id long, at int, next long, prev long"
PARTS = "key long, id long, start int, length int, code long, check long"


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` consecutive entries."""
    size = 1
    while 2 * size <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    rest = width - size
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def syncmers(code: np.ndarray, first: np.ndarray, k: int = K, q: int = Q) -> np.ndarray:
    """Places of the closed syncmers that lie within one text."""
    n = len(code) - k + 1
    if n <= 0:
        return np.empty(0, np.int64)
    shingles = grams(code, q)
    least = _least(shingles, k - q + 1)
    last = np.repeat(first[1:], np.diff(first))[:n]
    picked = (shingles[:n] == least) | (shingles[k - q : k - q + n] == least)
    return np.flatnonzero(picked & (np.arange(n) + k <= last))


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, keys = (batch.column(c).to_numpy() for c in (0, 1))
        for i, _, data, offsets in blocks(batch.column(2)):
            w = words(data, offsets)
            at = syncmers(w.hash, w.first)
            edge = grams(w.hash, K)[at]
            doc = owners(w.first)[at]
            link = np.full(len(at) + 1, END)
            back = np.full(len(at) + 1, END)
            same = doc[1:] == doc[:-1]
            gap = (np.diff(at).astype(np.uint64) << np.uint64(1))[same]
            link[:-2][same] = mixed(edge[1:][same] + gap)
            back[1:-1][same] = mixed(edge[:-1][same] + gap + np.uint64(1))
            columns = [signed(edge), keys[i + doc], ids[i + doc], (at - w.first[doc]).astype(np.int32)]
            columns += [signed(link[: len(at)]), signed(back[: len(at)])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in columns], names=["edge", "key", "id", "at", "next", "prev"]
            )


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Covered spans inside paths, and the windows that must be verified."""
    names = ["key", "id", "start", "length", "code", "check"]
    for batch in batches:
        ids, keys = (batch.column(c).to_numpy() for c in (0, 1))
        listed = batch.column(3)
        for i, j, data, offsets in blocks(batch.column(2)):
            w = words(data, offsets)
            at = syncmers(w.hash, w.first)
            if not len(at):
                continue
            part = listed.slice(i, j - i)
            found = part.flatten()
            place, follows, precedes, least = (found.field(c).to_numpy(zero_copy_only=False) for c in range(4))
            place = place + np.repeat(w.first[:-1], part.value_lengths().to_numpy())
            known = np.searchsorted(at, place)
            repeated, after, before = (np.zeros(len(at), bool) for _ in range(3))
            source = np.zeros(len(at), np.int64)
            repeated[known], after[known], before[known], source[known] = True, follows, precedes, least
            doc = owners(w.first)[at]
            joined = repeated[:-1] & repeated[1:] & (doc[:-1] == doc[1:]) & after[:-1] & before[1:]
            begins = np.flatnonzero(np.concatenate([[True], ~joined]))
            sizes = np.diff(np.append(begins, len(at)))
            left = np.repeat(at[begins], sizes)
            right = np.repeat(at[begins + sizes - 1] + K, sizes)
            # Windows by their first word: those within a text, all of whose edges are repeated.
            n = len(w.hash)
            ends = np.repeat(w.first[1:], np.diff(w.first))
            p = np.flatnonzero(np.arange(n) + SPAN <= ends)
            edges_before = np.zeros(n + 1, np.int64)
            edges_before[at + 1] = 1
            np.cumsum(edges_before, out=edges_before)
            single = np.zeros(len(at) + 1, np.int64)
            np.cumsum(~repeated, out=single[1:])
            a, b = edges_before[p], edges_before[p + SPAN - K + 1]
            p, a = (x[single[b] == single[a]] for x in (p, a))
            if not len(p):
                continue
            inside = (left[a] <= p) & (p + SPAN <= right[a])
            owner = doc[a]
            gone = p[inside & (source[a] < ids[i + owner])]
            columns = []
            if len(gone):
                starts = np.flatnonzero(np.concatenate([[True], np.diff(gone) != 1]))
                stops = np.append(starts[1:], len(gone)) - 1
                # Neighbouring windows of two texts cannot touch: a text's last window starts early.
                d = owners(w.first)[gone[starts]]
                none = pa.nulls(len(starts), pa.int64())
                columns.append(
                    [keys[i + d], ids[i + d], (gone[starts] - w.first[d]).astype(np.int32),
                     (gone[stops] - gone[starts] + SPAN).astype(np.int32), none, none]
                )
            q, d = p[~inside], owner[~inside]
            if len(q):
                code, check = grams(w.hash, SPAN)[q], grams(mixed(w.hash + END), SPAN)[q]
                columns.append(
                    [keys[i + d], ids[i + d], (q - w.first[d]).astype(np.int32),
                     np.full(len(q), SPAN, np.int32), signed(code), signed(check)]
                )
            for c in columns:
                yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in c], names=names)


#: What stands for a row: its id, and a hash of its text's sha256, which tells rows of one id apart.
ROW = ["id", "key"]


def _row() -> list[Column]:
    id_ = F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST))
    return [id_.alias("id"), F.xxhash64(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("key")]


def _based(docs: DataFrame) -> DataFrame:
    return docs.select(*_row(), F.coalesce("text", F.lit("")).alias("text"))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """id, key and spans (start, length): words to remove; a row for each id and text."""
    base = _based(docs)
    edges = base.mapInArrow(_edges, EDGES)
    graph = (
        edges.groupBy("edge")
        .agg(
            F.min("id").alias("least"), F.max("id").alias("most"),
            F.min("next").alias("n0"), F.max("next").alias("n1"),
            F.min("prev").alias("p0"), F.max("prev").alias("p1"),
        )
        .where("least < most")
        .select("edge", (F.col("n0") == F.col("n1")).alias("follows"), (F.col("p0") == F.col("p1")).alias("precedes"), "least")
    )
    graph = written(graph, "graph")
    told = (
        edges.select("edge", *ROW, "at")
        .join(graph, "edge")
        .groupBy(*ROW)
        .agg(F.collect_set(F.struct("at", "follows", "precedes", "least")).alias("edges"))
        .select(*ROW, F.array_sort("edges").alias("edges"))
    )
    parts = written(base.join(told, ROW).select("id", "key", "text", "edges").mapInArrow(_windows, PARTS), "parts")
    dropped(graph)
    open_ = parts.where(F.col("code").isNotNull())
    sources = (
        open_.groupBy("code", "check").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most")
    )
    sources = written(sources.select("code", "check", "least"), "sources")
    verified = open_.join(sources, ["code", "check"]).where("id > least").select(*ROW, "start", "length")
    settled = parts.where(F.col("code").isNull()).select(*ROW, "start", "length")
    return settled.union(verified).groupBy(*ROW).agg(F.collect_set(F.struct("start", "length")).alias("spans"))


def _kept(text: str, spans: list[dict]) -> tuple[int, int, bytes]:
    """Words, removed words, and the rest joined by one space."""
    found = text.encode().split()
    n = len(found)
    if not spans:
        return n, 0, b" ".join(found)
    edge = np.zeros(n + 1, np.int64)
    start = np.array([s["start"] for s in spans])
    np.add.at(edge, start, 1)
    np.add.at(edge, start + np.array([s["length"] for s in spans]), -1)
    keep = np.cumsum(edge[:-1]) == 0
    return n, n - int(keep.sum()), b" ".join([found[k] for k in np.flatnonzero(keep).tolist()])


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
    for batch in batches:
        for i in range(0, batch.num_rows, 1024):
            part = batch.slice(i, 1024)
            kept = [_kept(t, s) for t, s in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True)]
            columns = [
                part.column(0),
                pa.array([k[0] for k in kept], pa.int64()),
                pa.array([k[1] for k in kept], pa.int64()),
                pa.array([hashlib.sha256(k[2]).hexdigest() for k in kept], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every row."""
    spans = repeated_spans(docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), *_row())
    rows = rows.join(spans, ROW, "left").select("doc_id", "text", "spans")
    return rows.mapInArrow(_digest, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def deduplicated(docs: DataFrame) -> DataFrame:
    """``docs`` with the remaining words, joined by one space, as text where any were removed."""

    @F.arrow_udf("string")
    def kept(texts: pa.Array, spans: pa.Array) -> pa.Array:
        return pa.array(
            [_kept(t, s)[2].decode() if s else t for t, s in zip(texts.to_pylist(), spans.to_pylist(), strict=True)],
            pa.string(),
        )

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *_row())
    joined = rows.join(repeated_spans(docs), ROW, "left")
    own = F.col("row.text")
    text = F.when(F.col("spans").isNotNull(), kept(own, F.col("spans"))).otherwise(own)
    return joined.select(*[text.alias(c) if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])
