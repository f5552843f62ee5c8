"""Language-model scoring with a probabilistic suffix tree over words.

Tokens are words (A-Z lower-cased), then one end for each text.

The root's distribution holds every token of the training texts: absolute discounting takes ``d`` off each
count, estimated from the words seen once and twice, and gives the sum to unknown words.

Contexts are the last one or two tokens, of any words, and the begin of the text. A context is a candidate
with each continuation that recurs after it (``LEAST`` times, at every size of the corpus): what was seen once
after a context is no evidence that its distribution differs. A candidate becomes a state if its next
tokens diverge from those of its longest suffix state: their counts times the log ratio of the smoothed
distributions must pay for the state's parameters (half the log of its count each). A state's distribution is
discounted, and what is left goes to other tokens in proportion to the suffix state's distribution, so that
every state sums to one. A text is scored by the longest suffix state at every token.

Counts are over all training texts, and all counts, tests and states are tables, which grow with the corpus:
``States``. A text's score is a sum of what its words, its pairs and its triples of tokens are worth, since a
state's weight counts wherever its context occurs and an explicit continuation is worth the difference. Each
level meets its table by buckets of hashes, about ``BUCKET`` tokens each, and what it met goes back to runs of texts. The frequent words, pairs and triples
(at least 1 / ``SYMBOLS`` of all tokens, so there are at most that many) are broadcast with their worth and
never travel, so that no bucket is much larger than others. Texts are cut into words once: every pass after that
reads the hashes of their words.

Null texts are empty: one end token. Repeated rows are scored, and learned from, each time. Without training
texts scores are those of an unknown word with all the probability, 0. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import reduce
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import blocks, dropped, owners, signed, words, written
from tidemark.session import setting

SYMBOLS, LEAST, BUCKET = 1 << 16, 2, 1 << 19
BEGIN, END, RARE, FIRST = 0, 1, 2, 3
BITS = np.uint64(17)
#: Jobs that pairs or triples meet their worth in, a power of two: disk holds one of them at a time.
TURNS = 2
#: Jobs that pairs and triples are counted in.
PAIR_TURNS, TRIPLE_TURNS = 2, 3


def find(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Place of each key, or -1."""
    if not len(sorted_keys):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return np.where(sorted_keys[at] == keys, at, -1)


class Lookup:
    """``find`` by hashed slots; keys that share a slot are searched for."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        bits = max(4, int(len(keys)).bit_length() + 2)
        self.shift = np.uint64(64 - bits)
        slot = self._slot(keys)
        self.place = np.full(1 << bits, -1, np.int32)
        self.place[slot] = np.arange(len(keys))
        self.shared = np.bincount(slot, minlength=1 << bits) > 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys) or not len(keys):
            return np.full(len(keys), -1)
        slot = self._slot(keys)
        at = self.place[slot].astype(np.int64)
        at[(at >= 0) & (self.keys[np.maximum(at, 0)] != keys)] = -1
        again = np.flatnonzero((at < 0) & self.shared[slot])
        at[again] = find(self.keys, keys[again])
        return at


@dataclass
class Root:
    """Counts of frequent words, and totals."""

    hashes: np.ndarray  # of frequent words, sorted
    counts: np.ndarray
    tokens: int
    distinct: int
    texts: int
    discount: float
    lookup: Lookup | None = None
    words: DataFrame | None = None  # (word, c), all of them; stays on the driver

    def __getstate__(self):
        return self.__dict__ | {"words": None}

    def symbols(self, code: np.ndarray) -> np.ndarray:
        if self.lookup is None:
            self.lookup = Lookup(self.hashes)
        return (self.lookup(code) + FIRST).clip(RARE).astype(np.uint64)

    def logs(self) -> np.ndarray:
        """log10 of the root's probability of each symbol."""
        if not self.tokens:
            return np.zeros(FIRST)
        known = np.concatenate([[0, self.texts, 0], self.counts]).astype(np.float64)
        p = (known - self.discount) / max(1, self.tokens)
        p[BEGIN] = 0
        p[RARE] = 0
        p[RARE] = max(1e-12, 1 - p.sum())
        p[BEGIN] = 1e-300
        return np.log10(np.maximum(p, 1e-300))


@dataclass
class Tree:
    """States of frequent words in memory: contexts with the log10 weight of their suffix, and explicit continuations."""

    one: np.ndarray  # per symbol: log10 weight, nan where the symbol is no state
    next_one: np.ndarray
    logs_one: np.ndarray
    two: np.ndarray
    weight_two: np.ndarray
    next_two: np.ndarray
    logs_two: np.ndarray
    lookups: dict = field(default_factory=dict)

    def __getstate__(self):
        return self.__dict__ | {"lookups": {}}

    def _find(self, name: str, keys: np.ndarray) -> np.ndarray:
        if name not in self.lookups:
            self.lookups[name] = Lookup(getattr(self, name))
        return self.lookups[name](keys)

    def score(self, root: np.ndarray, a: np.ndarray, b: np.ndarray, w: np.ndarray) -> np.ndarray:
        """log10 probability of symbols ``w`` after ``a``, ``b``."""
        out = np.zeros(len(w))
        open_ = np.ones(len(w), bool)
        state = self._find("two", (a << BITS) | b)
        deep = np.flatnonzero(state >= 0)
        at = self._find("next_two", (a[deep] << (BITS + BITS)) | (b[deep] << BITS) | w[deep])
        hit = at >= 0
        out[deep[hit]] = self.logs_two[at[hit]]
        open_[deep[hit]] = False
        out[deep[~hit]] = self.weight_two[state[deep[~hit]]]
        weight = self.one[b.astype(np.int64)]
        deep = np.flatnonzero(open_ & ~np.isnan(weight))
        at = self._find("next_one", (b[deep] << BITS) | w[deep])
        hit = at >= 0
        out[deep[hit]] += self.logs_one[at[hit]]
        open_[deep[hit]] = False
        out[deep[~hit]] += weight[deep[~hit]]
        out[open_] += root[w[open_].astype(np.int64)]
        return out


_P1, _P2, _P3 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_P4, _P5 = np.uint64(0x85EBCA77C2B2AE63), np.uint64(0x27D4EB2F165667C5)
#: Bits that a context's hash is turned by before it meets what follows.
TURNED = 21


def joined_key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of a context and what follows it: words for pairs, overlapping pairs for triples. ``_key`` of columns: Spark's ``xxhash64``."""
    h = (left << np.uint64(TURNED)) | (left >> np.uint64(64 - TURNED))
    h ^= right
    h *= _P2
    h = (h << np.uint64(31)) | (h >> np.uint64(33))
    h *= _P1
    h ^= np.uint64(42) + (_P5 + np.uint64(8))
    h = (h << np.uint64(27)) | (h >> np.uint64(37))
    h *= _P1
    h += _P4
    h ^= h >> np.uint64(33)
    h *= _P2
    h ^= h >> np.uint64(29)
    h *= _P3
    h ^= h >> np.uint64(32)
    return h


class Grams(NamedTuple):
    """Pairs or triples of a block of texts; begin and end have the codes ``BEGIN`` and ``END``."""

    key: np.ndarray  # of pairs or triples
    left: np.ndarray  # token before, or pair before
    right: np.ndarray  # token, or pair
    text: np.ndarray


#: Words worked on at once.
MOST_WORDS = 1 << 17


def _hashed(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(from, to, hashes of words, each text's first word) of runs of texts, or of what ``_coded`` made of them."""
    if not (pa.types.is_binary(texts.type) or pa.types.is_large_binary(texts.type)):
        for i, j, data, offsets in blocks(texts):
            w = words(data, offsets, lower=True)
            yield i, j, w.hash, w.first
        return
    texts = texts.cast(pa.large_binary())
    if not len(texts):
        return
    _, where, data = texts.buffers()
    first = np.frombuffer(where, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8)[: first[-1]] if data is not None else np.empty(0, np.uint8)
    code, first = data[first[0] :].view(np.uint64), (first - first[0]) // 8
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(first, first[i] + MOST_WORDS, "right")) - 1)
        yield i, j, code[first[i] : first[j]], first[i : j + 1] - first[i]
        i = j


def _coded(docs: DataFrame, train: Column) -> DataFrame:
    """row, doc_id, own (``train``), words: the hashes of each text's words, 8 bytes each.

    Written once, so that a row has the same number at every level, and no later pass cuts texts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, code, first in _hashed(batch.column(3)):
                held = pa.Array.from_buffers(
                    pa.large_binary(), j - i, [None, pa.py_buffer(first * 8), pa.py_buffer(np.ascontiguousarray(code))]
                )
                columns = [batch.column(k).slice(i, j - i) for k in range(3)] + [held.cast(pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["row", "doc_id", "own", "words"])

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), train.alias("own"), "text"
    )
    coded = rows.mapInArrow(run, "row long, doc_id long, own boolean, words binary")
    with setting(docs.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch", TEXTS):
        return written(coded, "words_of_texts", compression="zstd")


def _grams(texts: pa.Array, level: str) -> Iterator[tuple[int, int, Grams]]:
    """(from, to, pairs or triples) of tokens: each text's words, then its end."""
    for i, j, hashes, first in _hashed(texts):
        n = j - i
        text = np.repeat(np.arange(n), np.diff(first) + 1)
        code = np.full(len(hashes) + n, END, np.uint64)
        inner = np.ones(len(code), bool)
        inner[first[1:] + np.arange(n)] = False
        code[inner] = hashes
        before = np.empty_like(code)
        before[1:] = code[:-1]
        inner[:] = True
        inner[first[:-1] + np.arange(n)] = False
        before[~inner] = BEGIN
        pair = joined_key(before, code)
        if level == "pairs":
            yield i, j, Grams(pair, before, code, text)
            continue
        at = np.flatnonzero(inner)
        left, right = pair[at - 1], pair[at]
        yield i, j, Grams(joined_key(left, right), left, right, text[at])


def _groups(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, an order that sorts all, and where each key's rows begin in it."""
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(key)), bool), key[1:] != key[:-1]]))
    return key[first], order, first


#: Keys that a worker holds before it hands their counts on.
MOST_KEYS = 1 << 20
#: Pairs or triples that it holds; and texts that reach it at once.
MOST_GRAMS, TEXTS = 1 << 18, "1000"


def _bits(tokens: int) -> int:
    """Buckets of keys, as a power of two, for about ``BUCKET`` tokens each."""
    return max(5, (tokens // BUCKET).bit_length())


def _cells(key: np.ndarray, bits: int) -> Iterator[tuple[int, slice]]:
    """(bucket, its part) of sorted keys: a bucket is the keys' first bits."""
    bucket = (key >> np.uint64(64 - bits)).astype(np.int64)
    first = np.flatnonzero(np.diff(bucket, prepend=-1))
    for i, j in zip(first, np.append(first, len(key))[1:], strict=True):
        yield int(bucket[i]), slice(i, j)


def _joined(column: pa.ChunkedArray, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def _batch(rows: list[tuple], names, types) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, types, strict=True)], names=list(names))


def vocabulary(train: DataFrame) -> tuple[DataFrame, Root]:
    """(word, c) of all training words, as a table, and the root. ``train``: one column of texts, or of hashes of their words.

    Workers count their own; a bucket adds up what they counted.
    """
    texts, size = train.agg(F.count("*"), F.sum(F.octet_length(train.columns[0]))).first()
    bits = _bits((size or 0) // 8)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0
        found = (code for batch in batches for _, _, code, _ in _hashed(batch.column(0)))
        for part in chain(found, [None]):
            if part is not None:
                held.append(part)
                size += len(part)
            if held and (part is None or size >= MOST_KEYS):
                key, n = np.unique(np.concatenate(held), return_counts=True)
                n = n.astype(np.uint32)
                rows = [(k, key[x].tobytes(), n[x].tobytes()) for k, x in _cells(key, bits)]
                yield _batch(rows, ("bucket", "keys", "n"), (pa.int32(), *[pa.binary()] * 2))
                held, size = [], 0

    def add(cells: pa.Table) -> pa.Table:
        key, at, first = _groups(_joined(cells.column("keys"), np.uint64))
        n = np.add.reduceat(_joined(cells.column("n"), np.uint32)[at].astype(np.int64), first)
        return pa.table([signed(key), n], names=["word", "c"])

    counted = train.mapInArrow(run, "bucket int, keys binary, n binary").groupBy("bucket").applyInArrow(add, "word long, c long")
    table = written(counted, "vocabulary")
    c = F.col("c")
    total = table.agg(F.sum(c), F.count("*"), F.count_if(c == 1), F.count_if(c == 2)).first()
    tokens, distinct = (total[0] or 0) + texts, total[1] + (texts > 0)
    frequent = table.where(c * SYMBOLS >= tokens).toArrow()  # at most SYMBOLS rows
    hashes = frequent.column("word").to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    once, twice = total[2], total[3]
    discount = min(0.9, max(0.1, once / max(1, once + 2 * twice)))
    return table, Root(hashes[order], frequent.column("c").to_numpy()[order], tokens, distinct, texts, discount, words=table)


CELLS = "bucket int, keys binary, others binary, n binary"


def _dealt(df: DataFrame, name: str) -> DataFrame:
    """``written``, with small batches of texts: workers share an executor's memory."""
    with setting(df.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch", TEXTS):
        return written(df, name)


def _counts(train: DataFrame, level: str, bits: int, turn: int = 0, turns: int = 1) -> DataFrame:
    """(left, right, n) of all pairs or triples that recur; of one part of them in each of ``turns``.

    Workers count their own; a bucket adds up what they counted.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        size = 0
        found = (g[:3] for batch in batches for *_, g in _grams(batch.column(0), level))
        for part in chain(found, [None]):
            if part is not None:
                if turns > 1:
                    own = np.flatnonzero(part[0] % np.uint64(turns) == turn)
                    part = tuple(x[own] for x in part)
                held.append(part)
                size += len(part[0])
            if held and (part is None or size >= MOST_GRAMS):
                key, left, right = (np.concatenate(x) for x in zip(*held, strict=True))
                n = len(key)
                key, at, first = _groups(key)
                n, at = np.diff(first, append=n).astype(np.uint32), at[first]
                left, right = left[at], right[at]
                rows = [(k, left[x].tobytes(), right[x].tobytes(), n[x].tobytes()) for k, x in _cells(key, bits)]
                yield _batch(rows, ("bucket", "keys", "others", "n"), (pa.int32(), *[pa.binary()] * 3))
                held, size = [], 0

    def add(cells: pa.Table) -> pa.Table:
        left, right = (_joined(cells.column(c), np.uint64) for c in ("keys", "others"))
        _, at, first = _groups(joined_key(left, right))
        n = np.add.reduceat(_joined(cells.column("n"), np.uint32)[at].astype(np.int64), first)
        at, n = at[first][n >= LEAST], n[n >= LEAST]
        return pa.table([signed(left[at]), signed(right[at]), n], names=["left", "right", "n"])

    return train.mapInArrow(run, CELLS).groupBy("bucket").applyInArrow(add, "left long, right long, n long")


def _distinct(table: DataFrame) -> DataFrame:
    """A table of one row a key: joins hash it, part by part, rather than sort both sides."""
    return table.hint("shuffle_hash")


def _key(left: str, right: str) -> Column:
    """``joined_key`` of two columns."""
    turned = F.shiftleft(left, TURNED).bitwiseOR(F.shiftrightunsigned(left, 64 - TURNED))
    return F.xxhash64(turned.bitwiseXOR(F.col(right)))


def _tested(candidates: DataFrame) -> DataFrame:
    """(context, weight) of the contexts that diverge enough.

    ``candidates``: context, its count ``total``, ``n`` of a continuation and ``above``, the suffix state's log10 of it.
    """
    p = F.col("p")
    sums = (
        candidates.withColumn("p", (F.col("n") - 0.5) / F.col("total"))
        .groupBy("context")
        .agg(
            F.max("total").alias("total"),
            F.count("*").alias("size"),
            F.sum("n").alias("named"),
            F.sum(p).alias("taken"),
            F.least(F.sum(F.pow(F.lit(10.0), F.col("above"))), F.lit(1 - 1e-9)).alias("parent"),
            F.sum(F.col("n") * (F.log10(p) - F.col("above"))).alias("gain"),
        )
        .withColumn("weight", F.log10(F.greatest(1 - F.col("taken"), F.lit(1e-12)) / (1 - F.col("parent"))))
    )
    gain = F.col("gain") + (F.col("total") - F.col("named")) * F.col("weight")
    return sums.where(gain * float(np.log(10)) > 0.5 * (F.col("size") + 1) * F.log(F.col("total"))).select("context", "weight")


@dataclass
class States:
    """All states as tables; logs to the base of ten."""

    words: DataFrame  # word, c, p (the root's log), weight of the context of one, or null
    pairs: DataFrame  # key, b, w, n, log, explicit: what an explicit continuation is worth
    triples: DataFrame  # context and right (keys of pairs), n, total, above (log of the suffix state)
    two: DataFrame  # context (key of a pair), weight
    pair_worth: DataFrame  # key, n, worth: those that are worth something, or frequent
    triple_worth: DataFrame
    begin: float  # weight of a text's begin as a context


def states(train: DataFrame, root: Root, keep: bool = True) -> States:
    """Count, test and smooth the contexts of one and two tokens.

    Unless ``keep``, words of the root, pairs and triples are dropped as soon as what they are worth is known.
    """
    bits, total = _bits(root.tokens), max(1, root.tokens)
    codes = [(x, root.texts, True) for x in (BEGIN, END)]
    ends = train.sparkSession.createDataFrame([x for x in codes if root.texts], "word long, c long, mark boolean")
    every = root.words.select("word", "c", F.lit(False).alias("mark")).unionByName(ends)
    every = every.withColumn("p", F.log10(F.greatest((F.col("c") - root.discount) / total, F.lit(1e-300))))
    # Pairs and triples in turns, so that a part of them travels at once.
    parts = [_dealt(_counts(train, "pairs", bits, turn, PAIR_TURNS), "pair_counts") for turn in range(PAIR_TURNS)]
    counted = reduce(DataFrame.unionByName, parts)
    follow = every.select(F.col("word").alias("right"), F.col("p").alias("above"))
    context = every.select(F.col("word").alias("left"), F.col("c").alias("total"))
    candidates = counted.join(_distinct(follow.where(F.col("right") != BEGIN)), "right").join(_distinct(context), "left")
    candidates = written(candidates.withColumnRenamed("left", "context"), "pair_candidates")
    one = written(_tested(candidates), "states_of_one")
    words_ = written(
        every.join(_distinct(one.withColumnRenamed("context", "word")), "word", "left").select("word", "c", "mark", "p", "weight"),
        "words",
    )
    if not keep:
        dropped(root.words)
    named = F.log10((F.col("n") - 0.5) / F.col("total"))
    pairs = written(
        candidates.join(_distinct(one), "context", "left").select(
            _key("context", "right").alias("key"),
            F.col("context").alias("b"),
            F.col("right").alias("w"),
            "n",
            F.when(F.col("weight").isNotNull(), named).otherwise(F.col("above")).alias("log"),
            F.coalesce(named - F.col("above") - F.col("weight"), F.lit(0.0)).alias("explicit"),
        ),
        "pairs",
    )
    dropped(*parts, candidates, one)
    parts = [_dealt(_counts(train, "triples", bits, turn, TRIPLE_TURNS), "triple_counts") for turn in range(TRIPLE_TURNS)]
    counted = reduce(DataFrame.unionByName, parts)
    follow = pairs.select(F.col("key").alias("right"), F.col("log").alias("above"))
    context = pairs.select(F.col("key").alias("left"), F.col("n").alias("total"))
    # Written between the joins, so that disk holds the shuffles of one at a time.
    continued = written(counted.join(_distinct(follow), "right"), "triples_with_suffix")
    dropped(*parts)
    triples = written(continued.join(_distinct(context), "left").withColumnRenamed("left", "context"), "triple_candidates")
    dropped(continued)
    two = written(_tested(triples), "states_of_two")
    matters = (F.col("worth") != 0) | (F.col("n") * SYMBOLS >= root.tokens)
    explicit = triples.join(_distinct(two), "context", "left").withColumn(
        "worth", F.coalesce(named - F.col("above") - F.col("weight"), F.lit(0.0))
    )
    explicit = explicit.where(matters).select(_key("context", "right").alias("key"), "n", "worth")
    weighed = pairs.join(_distinct(two.withColumnRenamed("context", "key")), "key", "left")
    weighed = weighed.withColumn("worth", F.col("explicit") + F.coalesce("weight", F.lit(0.0)))
    begin = words_.where(F.col("mark") & (F.col("word") == BEGIN)).first()
    pair_worth = written(weighed.where(matters).select("key", "n", "worth"), "worth_of_pairs")
    if not keep:
        dropped(pairs)
    triple_worth = written(explicit, "worth_of_triples")
    if not keep:
        dropped(triples, two)
    return States(
        words_.where(~F.col("mark")).drop("mark"), pairs, triples, two, pair_worth, triple_worth, (begin and begin["weight"]) or 0.0
    )


def grow(train: DataFrame, root: Root) -> Tree:
    """The states whose words are all frequent, in memory: a view for models that fit there; scoring uses ``states``."""
    found = states(train, root)
    codes = np.concatenate([np.array([BEGIN, END], np.uint64), root.hashes])
    spark = train.sparkSession
    frequent = spark.createDataFrame(pa.table({"code": signed(codes)}))

    def symbols(column: pa.ChunkedArray) -> np.ndarray:
        code = np.ascontiguousarray(column.to_numpy()).astype(np.int64).view(np.uint64)
        return np.where(code <= END, code, root.symbols(code))

    def collected(rows: DataFrame, *parts: str) -> tuple[np.ndarray, pa.Table]:
        for part in parts:
            rows = rows.join(frequent.withColumnRenamed("code", part), part, "left_semi")
        table = rows.toArrow()
        key = np.zeros(table.num_rows, np.uint64)
        for part in parts:
            key = (key << BITS) | symbols(table.column(part))
        order = np.argsort(key)
        return key[order], table.take(order)

    one = np.full(FIRST + len(root.hashes), np.nan)
    at, table = collected(found.words.where("weight is not null").select("word", "weight"), "word")
    one[at.astype(np.int64)] = table.column("weight").to_numpy()
    if found.begin:
        one[BEGIN] = found.begin
    next_one, logs_one = collected(found.pairs.where("explicit <> 0").select("b", "w", "log"), "b", "w")
    context = found.pairs.select(F.col("key").alias("context"), F.col("b").alias("a"), F.col("w").alias("b")).join(found.two, "context")
    two, weights = collected(context.select("a", "b", "weight"), "a", "b")
    log = F.log10((F.col("n") - 0.5) / F.col("total"))
    named = found.triples.withColumn("log", log).join(context, "context").select("a", "b", "right", "log")
    named = named.join(found.pairs.select(F.col("key").alias("right"), "w"), "right").drop("right")
    next_two, logs_two = collected(named, "a", "b", "w")
    return Tree(
        one, next_one, logs_one.column("log").to_numpy(), two, weights.column("weight").to_numpy(),
        next_two, logs_two.column("log").to_numpy(),
    )


def _frequent(table: DataFrame, root: Root) -> tuple[np.ndarray, np.ndarray]:
    """Keys and worth of pairs or triples with at least 1 / ``SYMBOLS`` of all tokens, sorted."""
    found = table.where(F.col("n") * SYMBOLS >= root.tokens).select("key", "worth").toArrow()
    key = found.column("key").to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(key)
    return key[order], found.column("worth").to_numpy()[order]


#: Bytes of the parts that numbers of 8 and 2 bytes travel as, low ones first: the high parts of small numbers compress.
PARTS = {8: (4, 2, 2), 2: (1, 1)}


def _planes(x: np.ndarray) -> list[np.ndarray]:
    x, out, low = x.view(f"u{x.itemsize}"), [], 0
    for size in PARTS[x.itemsize]:
        out.append((x >> x.dtype.type(8 * low)).astype(f"u{size}"))
        low += size
    return out


def _packed(planes: list[np.ndarray], part: slice) -> bytes:
    return b"".join([x[part].tobytes() for x in planes])


def _unpacked(cells: list[bytes], kind) -> np.ndarray:
    """All numbers of packed cells, one cell after the other."""
    size, low = np.dtype(kind).itemsize, 0
    out = np.zeros(sum(map(len, cells)) // size, f"u{size}")
    for part in PARTS[size]:
        data = b"".join([x[len(x) // size * low : len(x) // size * (low + part)] for x in cells])
        out |= np.frombuffer(data, f"u{part}").astype(out.dtype) << out.dtype.type(8 * low)
        low += part
    return out.view(kind)


def _steps(key: np.ndarray, cells: list[tuple[int, slice]]) -> np.ndarray:
    """Differences of sorted keys; a cell begins with its key."""
    step, first = np.diff(key, prepend=np.uint64(0)), [x.start for _, x in cells]
    step[first] = key[first]
    return step


def _summed(step: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Keys of ``_steps``."""
    key, first = np.cumsum(step, dtype=np.uint64), np.cumsum(sizes) - sizes
    return key - np.repeat(key[first] - step[first], sizes)


MET = "first long, texts binary, counts binary, heavy binary, worth binary"


def _met(rows: DataFrame, table: DataFrame, bits: int, spoken: Callable, summed: Callable, out: str, name: str, counted: bool) -> DataFrame:
    """One row a text, made by ``summed``, of what its keys meet in ``table``. ``rows``: row, text. ``table``: key, n, worth.

    ``summed`` gets numbers of whole texts; the text and count ``n`` of every key met, if these are ``counted``; texts and their worth.

    ``spoken`` gives for a batch of texts, run by run: from, to, keys, the text of each, and numbers of whole texts, one row each.
    Runs of about ``MOST_GRAMS`` keys travel as cells: the keys of a bucket, and how far each one's text is from the run's
    ``first``. What was met goes back to the run, whose texts are summed up at once: no row is made for a single key.
    """
    names = ("bucket", "first", "keys", "others")

    def cells(own: np.ndarray, texts: pa.Array) -> Iterator[pa.RecordBatch]:
        start, held, size = 0, [], 0
        for i, j, key, text, whole in spoken(texts):
            held.append((key, text + (i - start), whole))
            size += len(key)
            if size >= MOST_GRAMS or j == len(texts):
                key, text = (np.concatenate(x) for x in list(zip(*held, strict=True))[:2])
                order = np.argsort(key)
                key, first = key[order], int(own[start])
                whole = np.concatenate([x[2] for x in held], axis=1).astype(np.float64)
                made, parts = [(first % (1 << bits), first, None, whole.tobytes())], list(_cells(key, bits))
                steps, texts_of = _planes(_steps(key, parts)), _planes(text[order].astype(np.uint16))
                made += [(k, first, _packed(steps, x), _packed(texts_of, x)) for k, x in parts]
                yield _batch(made, names, (pa.int32(), pa.int64(), pa.binary(), pa.binary()))
                start, held, size = j, [], 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_numpy()
            # Rows of a run follow one another.
            cuts = np.union1d(np.flatnonzero(np.diff(own) != 1) + 1, np.arange(0, len(own), 1 << 16)).astype(np.int64)
            for i, j in zip(cuts, np.append(cuts, len(own))[1:], strict=True):
                yield from cells(own[i:j], batch.column(1).slice(i, j - i))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in chain(batches, [None]):
            if batch is not None:
                held.append(batch)
            if held and (batch is None or sum(map(len, held)) >= MOST_GRAMS):
                whole = pa.Table.from_batches(held)
                key = np.ascontiguousarray(whole.column("key").to_numpy()).astype(np.int64).view(np.uint64)
                order = np.argsort(key)
                key, parts = key[order], list(_cells(key[order], bits))
                columns = [_planes(_steps(key, parts)), *(_planes(whole.column(c).to_numpy()[order]) for c in ("n", "worth"))]
                made = [(k, *(_packed(c, x) for c in columns)) for k, x in parts]
                yield _batch(made, ("bucket", "keys", "n", "worth"), (pa.int32(), *[pa.binary()] * 3))
                held = []

    def cut(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
        held = column.to_pylist()
        sizes = np.array([len(x) // 8 for x in held], np.int64)
        return _summed(_unpacked(held, np.uint64), sizes), sizes

    def look(met: pa.Table, model: pa.Table) -> pa.Table:
        key_of, _ = cut(model.column("keys"))
        order = np.argsort(key_of)
        n_of, worth_of = (_unpacked(model.column(c).to_pylist(), kind)[order] for c, kind in (("n", np.int64), ("worth", np.float64)))
        whole = pc.is_null(met.column("keys"))
        made = [(*x, None, None, None, y) for *x, y in zip(*(met.filter(whole).column(c).to_pylist() for c in ("first", "others")), strict=True)]
        met = met.filter(pc.invert(whole))
        key, sizes = cut(met.column("keys"))
        at = Lookup(key_of[order])(key)
        cell, text = np.repeat(np.arange(len(sizes)), sizes), _unpacked(met.column("others").to_pylist(), np.uint16)
        cell, text, at = cell[at >= 0], text[at >= 0], at[at >= 0]
        heavy, sums = np.unique((cell << 16) | text, return_inverse=True)
        sums = np.bincount(sums, worth_of[at], len(heavy))
        heavy, sums = heavy[sums != 0], sums[sums != 0]
        if not counted:
            cell, text, at = cell[:0], text[:0], at[:0]
        cells = np.arange(len(sizes) + 1)
        met_at, heavy_at = np.searchsorted(cell, cells), np.searchsorted(heavy >> 16, cells)
        counts, heavy = _planes(n_of[at]), heavy.astype(np.uint16)
        for i, first in enumerate(met.column("first").to_pylist()):
            x, y = slice(met_at[i], met_at[i + 1]), slice(heavy_at[i], heavy_at[i + 1])
            made.append((first, text[x].tobytes(), _packed(counts, x), heavy[y].tobytes(), sums[y].tobytes()))
        batch = _batch(made, [x.split()[0] for x in MET.split(", ")], (pa.int64(), *[pa.binary()] * 4))
        return pa.Table.from_batches([batch])

    def add(cells: pa.Table) -> pa.Table:
        first, known = cells.column("first")[0].as_py(), pc.is_null(cells.column("texts"))
        whole = np.frombuffer(cells.filter(known).column("worth")[0].as_py())
        cells = cells.filter(pc.invert(known))
        text, heavy, worth = (_joined(cells.column(c), kind) for c, kind in (("texts", np.uint16), ("heavy", np.uint16), ("worth", np.float64)))
        columns = summed(whole, text, _unpacked(cells.column("counts").to_pylist(), np.int64), heavy, worth)
        return pa.table([first + np.arange(len(columns[0])), *columns], names=[x.split()[0] for x in out.split(", ")])

    model = table.select("key", "n", "worth").mapInArrow(deal, "bucket int, keys binary, n binary, worth binary")
    dealt = rows.mapInArrow(run, "bucket int, first long, keys binary, others binary").groupBy("bucket")
    met = dealt.cogroup(model.groupBy("bucket")).applyInArrow(look, MET)
    return _dealt(met.groupBy("first").applyInArrow(add, out), name)


def _grams_met(rows: DataFrame, table: DataFrame, root: Root, level: str, turn: int) -> DataFrame:
    """(row, score): what a text's pairs or triples are worth. The frequent ones are known where the text is.

    Each turn adds up its part of the keys, so that they do not all travel at once.
    """
    shared = rows.sparkSession.sparkContext.broadcast(_frequent(table, root))

    def spoken(texts: pa.Array):
        key_of, worth = shared.value
        known = Lookup(key_of)
        for i, j, g in _grams(texts, level):
            own = np.flatnonzero(g.key & np.uint64(TURNS - 1) == turn)
            key, text = g.key[own], g.text[own]
            at = known(key)
            hot, cold = at >= 0, at < 0
            yield i, j, key[cold], text[cold], np.bincount(text[hot], worth[at[hot]], j - i)[None]

    def summed(whole, text, n, heavy, worth):
        return [whole + np.bincount(heavy, worth, len(whole))]

    own = F.col("key").bitwiseAND(F.lit(TURNS - 1).cast("long")) == turn
    model = table.where(own & (F.col("worth") != 0) & (F.col("n") * SYMBOLS < root.tokens))
    return _met(rows, model, _bits(root.tokens), spoken, summed, "row long, score double", f"worth_of_{level}", False)


def _words_met(rows: DataFrame, found: States, root: Root) -> DataFrame:
    """row, n_tokens, n_known, base and score of the tokens at the root, with the weights of the contexts that they are."""
    bottom, total = root.tokens + 0.1 * (root.distinct + 1), max(1, root.tokens)
    # What a word is worth: its log at the root, and the weight of the context that it is for the next token.
    worth = F.col("p") + F.coalesce("weight", F.lit(0.0))
    frequent = found.words.where(F.col("c") * SYMBOLS >= root.tokens).select("word", worth.alias("worth")).toArrow()
    key = np.ascontiguousarray(frequent.column("word").to_numpy()).astype(np.int64).view(np.uint64)
    shared = rows.sparkSession.sparkContext.broadcast((root, frequent.column("worth").to_numpy()[np.argsort(key)]))
    end, unknown = 0.0, 0.0
    if root.tokens:
        end = float(np.log10(max((root.texts - root.discount) / total, 1e-300))) + found.begin
        unknown = float(np.log10(max(root.discount * root.distinct / total, 1e-300)))
    discount = root.discount

    def spoken(texts: pa.Array):
        known, values = shared.value
        value_of = np.concatenate([np.zeros(FIRST), values])
        base_of = np.log10((np.concatenate([[0, known.texts, 0], known.counts]) + 0.1) / bottom)
        for i, j, code, first in _hashed(texts):
            size, text = j - i, owners(first)
            symbol = known.symbols(code).astype(np.int64)
            hot, cold = symbol >= FIRST, symbol == RARE
            score = end + np.bincount(text[hot], value_of[symbol[hot]], size)
            base = base_of[END] + np.bincount(text[hot], base_of[symbol[hot]], size)
            seen = np.bincount(text[hot], minlength=size) + (known.texts > 0)
            rare = np.bincount(text[cold], minlength=size)
            yield i, j, code[cold], text[cold], np.stack([score, base, seen, rare, np.diff(first) + 1])

    def summed(whole, text, n, heavy, worth):
        score, base, seen, rare, tokens = whole.reshape(5, -1)
        size = len(score)
        met = np.bincount(text, minlength=size)
        score = score + np.bincount(text, np.log10(np.maximum((n - discount) / total, 1e-300)), size)
        score += np.bincount(heavy, worth, size) + (rare - met) * unknown
        base = base + np.bincount(text, np.log10((n + 0.1) / bottom), size) + (rare - met) * np.log10(0.1 / bottom)
        return [tokens.astype(np.int64), (seen + met).astype(np.int64), base, score]

    model = found.words.where(F.col("c") * SYMBOLS < root.tokens)
    model = model.select(F.col("word").alias("key"), F.col("c").alias("n"), F.coalesce("weight", F.lit(0.0)).alias("worth"))
    out = "row long, n_tokens long, n_known long, base double, score double"
    return _met(rows, model, _bits(root.tokens), spoken, summed, out, "worth_of_words", True)


def scored(docs: DataFrame, train: Column) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score of every row.

    ``train``: which rows the model learns from, an expression over ``docs``.
    """
    rows = _coded(docs, train)
    learned, texts = rows.where("own").select("words"), rows.select("row", "words")
    _, root = vocabulary(learned)
    found = states(learned, root, keep=False)
    parts = [rows.select("row", "doc_id"), _words_met(texts, found, root)]
    dropped(found.words)
    if root.tokens:
        for level, table in (("pairs", found.pair_worth), ("triples", found.triple_worth)):
            parts += [_grams_met(texts, table, root, level, turn) for turn in range(TURNS)]
            dropped(table)
    return (
        reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        .groupBy("row")
        .agg(
            F.max("doc_id").alias("doc_id"),
            F.max("n_tokens").alias("n_tokens"),
            F.sum("n_known").alias("n_known"),
            F.sum("base").alias("base_score"),
            F.sum("score").alias("score"),
        )
        .select("doc_id", "n_tokens", "n_known", F.lit(root.tokens).cast("long").alias("train_tokens"), "base_score", "score")
    )
