"""Written intermediate tables, folds, and vectorised words of Arrow text columns."""

from __future__ import annotations

import io
import os
import site
import uuid
import zipfile
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

import tidemark
from tidemark.session import setting, shared_folder

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, with its file system. It lives as long as results that read it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}")
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """The rows, written to the shared folder and read back: cuts lineage, survives executors.

    The shuffle files of the job go when it ends. ``options`` are the Parquet writer's.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with setting(spark, CLEANUP, "true"):
        df.write.parquet(path, **options)
    relieve(spark)
    return spark.read.schema(df.schema).parquet(path)


def relieve(spark: SparkSession, share: float = 0.6) -> bool:
    """Let the driver's JVM collect its garbage if its heap has grown past a share of its limit; whether it was asked to.

    A stage of many short jobs leaves their plans, and the JVM would rather grow to its limit, beside what Python and
    the JVM hold outside the heap, than collect them. A local session's heap is its executors' too and is left alone.
    """
    if spark.sparkContext._jsc.sc().isLocal():
        return False
    runtime = spark._jvm.java.lang.Runtime.getRuntime()
    grown = runtime.totalMemory() > share * runtime.maxMemory()
    if grown:
        spark._jvm.java.lang.System.gc()
    return grown


def dropped(*tables: DataFrame) -> None:
    """Remove the files of ``written`` tables that no later result reads."""
    for df in tables:
        spark = df.sparkSession
        jvm = spark._jvm
        for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def ship(spark: SparkSession) -> None:
    """Send this package to Python workers that would not find it: neither installed nor on their path."""
    root = Path(tidemark.__file__).resolve().parents[1]
    found = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep), *site.getsitepackages()]
    name = "tidemark-package.zip"
    if any(Path(x or ".").resolve() == root for x in found) or any(x.endswith(name) for x in spark.sparkContext._python_includes):
        return
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as out:
        for path in sorted((root / "tidemark").rglob("*.py")):
            out.write(path, path.relative_to(root))
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{scratch_path(spark, 'package')}/{name}")
    stream = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path)
    stream.write(packed.getvalue())
    stream.close()
    spark.sparkContext.addPyFile(path.toString())


def chosen(rows: DataFrame, most: int) -> DataFrame:
    """``doc_id`` of about ``most`` rows, those of the least hashes; all rows if there are no more.

    The bound on the hash follows from the number of rows, so that no task hands on more than its share.
    """
    known = rows.where("doc_id is not null").select("doc_id")
    n = known.count()
    if n <= most:
        return known.distinct()
    place = F.shiftrightunsigned(F.xxhash64("doc_id"), 1)
    return known.where(place <= int(most / n * (1 << 63))).distinct()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's decimal text, modulo ``folds``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# --- words of Arrow text columns ----------------------------------------------------------

#: Bytes worked on at once; arrays of eight bytes for each of them stay small.
BLOCK = 1 << 19
SPACES = np.array([0x20, *range(0x09, 0x0E)])


def mixed(x: np.ndarray) -> np.ndarray:
    """Finalising mix of 64-bit values (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _random(n: int, seed: int) -> np.ndarray:
    return mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


IS_WORD = np.ones(256, dtype=bool)
IS_WORD[SPACES] = False
_LOWER = np.arange(256)
_LOWER[65:91] += 32
BYTE_VALUES = {False: _random(256, 1), True: _random(256, 1)[_LOWER]}
_BASE, _WORD_BASE = 0xD6E8FEB86659FD93, 0xA0761D6478BD642F


class _Powers:
    """Powers of an odd number modulo 2**64, and of its inverse."""

    def __init__(self, base: int):
        self.base, self.inverse, self.size = base, pow(base, -1, 1 << 64), 0

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > self.size:
            self.size = 1 << (n - 1).bit_length()
            out = []
            for base in (self.base, self.inverse):
                powers = np.full(self.size, base, dtype=np.uint64)
                powers[0] = 1
                out.append(np.cumprod(powers, dtype=np.uint64))
            self.up, self.down = out
        return self.up[:n], self.down[:n]


_BYTES, _WORDS = _Powers(_BASE), _Powers(_WORD_BASE)


class Words(NamedTuple):
    """Words of a block of texts: byte ranges, 64-bit hashes, and each text's first word."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray


def blocks(texts: pa.Array, most: int = BLOCK):
    """(from, to, bytes, offsets) of runs of texts of about ``most`` bytes; null is empty."""
    texts = texts.fill_null("").cast(pa.large_string())
    if not len(texts):
        return
    _, where, data = texts.buffers()
    offsets = np.frombuffer(where, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def _part(data: np.ndarray, breaks: np.ndarray, values: np.ndarray):
    inside = IS_WORD[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    begins[breaks] = inside[breaks]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    last = breaks[breaks > 0] - 1
    ends[last] = inside[last]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    up, down = _BYTES.upto(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(values[data] * up[:-1], out=sums[1:])
    return start, end, (sums[end] - sums[start]) * down[start]


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> Words:
    """Runs of bytes other than ASCII white space, never across two texts.

    Long texts are hashed in pieces that end at white space, so that memory follows the
    number of words rather than eight-byte sums for every byte. A word longer than ``64 * BLOCK``
    bytes is summed piece by piece.
    """
    values, n = BYTE_VALUES[lower], len(data)
    out, i = [], 0
    while i < n:
        j = min(n, i + 2 * BLOCK)
        while j < n and IS_WORD[data[j - 1]] and IS_WORD[data[j]] and j - i < 64 * BLOCK:
            space = np.flatnonzero(~IS_WORD[data[i:j]])
            j = i + int(space[-1]) + 1 if len(space) else min(n, j + BLOCK)
        breaks = offsets[(offsets >= i) & (offsets < j)] - i
        start, end, sums = _part(data[i:j], breaks, values)
        start, end = start + i, end + i
        if i and IS_WORD[data[i - 1]] and IS_WORD[data[i]] and 0 not in breaks:
            # The last word goes on.
            was, ends, total = out[-1]
            up = pow(_BASE, i - int(was[-1]), 1 << 64)
            ends[-1], total[-1:] = end[0], total[-1:] + sums[:1] * np.uint64(up)
            start, end, sums = start[1:], end[1:], sums[1:]
        if len(start):
            out.append((start, end, sums))
        i = j
    if not out:
        empty = np.empty(0, np.int64)
        return Words(empty, empty, empty.astype(np.uint64), np.zeros(len(offsets), np.int64))
    start, end, code = (np.concatenate(x) for x in zip(*out, strict=True))
    return Words(start, end, mixed(code), np.searchsorted(start, offsets))


def grams(code: np.ndarray, k: int) -> np.ndarray:
    """Hashes of every ``k`` consecutive entries, texts notwithstanding."""
    n = len(code) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    up, down = _WORDS.upto(len(code) + 1)
    sums = np.zeros(len(code) + 1, dtype=np.uint64)
    np.cumsum(code * up[:-1], out=sums[1:])
    return mixed((sums[k:] - sums[:n]) * down[:n])


def owners(first: np.ndarray) -> np.ndarray:
    """The text of each word."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
