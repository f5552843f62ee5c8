"""Audit of how filters act together, by truth-table survival words.

A document that fails the filters ``f`` (a set of up to five) survives every subset of filters that has none
of ``f``. Its survival word is a row of a truth table: bit ``s`` of 32 says whether it survives the subset
``s``. Carry-save adders turn three words of one weight into one word of that weight and one of the next, all
32 positions at once, so that whole batches are reduced to the number of survivors of each subset, by part and
label. Every order of the filters is then a path through these 32 numbers: nothing else is read for 120 orders.

The facts of a document are built-in expressions, and its text leaves the scan only as its sha256. The least id of
every digest is found by a grouping that Spark begins before it shuffles, and met by id and digest together. Per
part and task, four rows of 32 counts are shuffled.

Null texts are empty. A null id is neither smaller than another id nor larger, so that rows without an id are
never copies and make no copies. Rows of one id and text are each counted and are not copies of each other. A
null part is the empty string. Several labels of one id count as good, or toxic, if one of them says so. Empty
tables have no parts and no rows. Other columns are not read.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import written

FILTERS = "ABCDE"
WORD = r"[^\x20\x09-\x0D]+"
#: Groups of part and label that a task holds before it hands their counts on.
GROUPS = 4096


def survival_words(filters: int) -> np.ndarray:
    """For each set of failed filters the word whose bit ``s`` is set if no filter of ``s`` is among them."""
    every = range(1 << filters)
    return np.array([sum(1 << s for s in every if not s & failed) for failed in every], np.uint32)


def positional_popcounts(words: np.ndarray) -> np.ndarray:
    """How many of the 32-bit words have each bit set."""
    totals, weight, layer = np.zeros(32, np.int64), 1, words.astype(np.uint32)
    while len(layer):
        carries = [layer[:0]]
        while len(layer) > 2:
            m = len(layer) // 3
            a, b, c = layer[:m], layer[m : 2 * m], layer[2 * m : 3 * m]
            half = a ^ b
            carries.append((a & b) | (half & c))
            layer = np.concatenate([half ^ c, layer[3 * m :]])
        bits = (layer[:, None] >> np.arange(32, dtype=np.uint32)) & np.uint32(1)
        totals += weight * bits.sum(axis=0, dtype=np.int64)
        layer, weight = np.concatenate(carries), 2 * weight
    return totals


def _survivors(filters: int):
    table = survival_words(filters)

    def rows(totals: dict) -> pa.RecordBatch:
        parts, labels = [k[0] for k in totals], np.array([k[1] for k in totals])
        columns = [pa.array(parts, pa.string()), pa.array(labels & 2 > 0), pa.array(labels & 1 > 0)]
        counts = pa.array([list(map(int, x)) for x in totals.values()], pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays([*columns, counts], names=["part", "good", "toxic", "survivors"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple[str, int], np.ndarray] = {}
        for batch in batches:
            part = batch.column(0).dictionary_encode()
            good, toxic, failed = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, 3))
            key = part.indices.to_numpy().astype(np.int64) * 4 + good * 2 + toxic
            order = np.argsort(key, kind="stable")
            key, words = key[order], table[failed[order]]
            starts = np.flatnonzero(np.diff(key, prepend=-1))
            for i, group in zip(starts.tolist(), np.split(words, starts[1:]), strict=True):
                name = (part.dictionary[int(key[i]) // 4].as_py(), int(key[i]) % 4)
                totals[name] = totals.get(name, 0) + positional_popcounts(group)
            if len(totals) > GROUPS:
                yield rows(totals)
                totals = {}
        if totals:
            yield rows(totals)

    return run


def _paths(names: str) -> str:
    """Every step of every order: its filter, and the subsets before, after, of it alone and of all others."""
    everything, out = (1 << len(names)) - 1, []
    for order in permutations(range(len(names))):
        before = 0
        for step, i in enumerate(order):
            after = before | 1 << i
            subsets = {"before": before, "after": after, "alone": 1 << i, "others": everything & ~(1 << i)}
            out.append({"filter_order": "".join(names[k] for k in order), "step": step + 1, "filter": names[i]} | subsets)
            before = after
    return json.dumps(out)


PATH = "array<struct<filter_order string, step int, filter string, before int, after int, alone int, others int>>"


def interactions(rows: DataFrame, filters: dict[str, Column]) -> DataFrame:
    """What each step of each order of the filters does, per part.

    ``rows`` has ``part``, ``good`` and ``toxic``; ``filters`` names up to five filters, by one letter each, and says
    which rows fail them.
    """
    names = "".join(filters)
    if not 1 <= len(filters) <= 5 or len(names) != len(filters):
        raise ValueError("one to five filters, named by a letter each")
    failed = sum((F.when(fails, 1 << i).otherwise(0) for i, fails in enumerate(filters.values())), F.lit(0))
    words = rows.select("part", "good", "toxic", failed.cast("int").alias("failed"))
    tallied = words.mapInArrow(_survivors(len(filters)), "part string, good boolean, toxic boolean, survivors array<long>")

    def total(s: int, of: Column) -> Column:
        return F.sum(F.when(of, F.col("survivors")[s]).otherwise(0))

    kinds = {"any": F.lit(True), "good": F.col("good"), "toxic": F.col("toxic")}
    subsets = range(1 << len(filters))
    sums = tallied.groupBy("part").agg(*[F.array(*[total(s, of) for s in subsets]).alias(f"of_{k}") for k, of in kinds.items()])
    steps = sums.select("*", F.inline(F.from_json(F.lit(_paths(names)), PATH)))

    def alive(subset: str, kind: str = "any") -> Column:
        return F.element_at(f"of_{kind}", F.col(subset) + 1)

    def lost(kind: str) -> Column:
        return alive("before", kind) - alive("after", kind)

    everyone, nobody_fails = F.col("of_any")[0], F.col("of_any")[len(subsets) - 1]
    out = steps.select(
        "part", "filter_order", "step", "filter",
        alive("after").alias("kept"),
        lost("any").alias("removed"),
        (everyone - alive("alone") - lost("any")).alias("redundant"),
        (alive("others") - nobody_fails).alias("unique_fails"),
        lost("good").alias("good_lost"),
        lost("toxic").alias("toxic_lost"),
    )
    # 120 rows of a part and filter at most.
    credit = F.sum("removed").over(Window.partitionBy("part", "filter"))
    return out.withColumn("shapley", credit).drop("filter")


def facts(docs: DataFrame) -> DataFrame:
    """Of every row: doc_id, part, digest of its text, and whether it fails A to D."""
    base = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    split = base.select("*", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("words"))
    words, distinct = F.size("words"), F.size(F.array_distinct("words"))
    capitals = F.length(F.regexp_replace("text", "[^A-Z]+", ""))
    return split.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "part",
        F.unhex(F.sha2("text", 256)).alias("digest"),
        (words < 200).alias("A"),
        (100 * distinct.cast("long") < 50 * words).alias("B"),
        (100 * capitals.cast("long") > 3 * F.length("text").cast("long")).alias("C"),
        F.col("text").rlike("[#$%&*|]").alias("D"),
    )


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Of every row: doc_id, part, whether it fails A to E, and its labels."""
    told = written(facts(docs), "facts")
    # Joined by id and text together, so that the copies of one text are not one key.
    first = told.where("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    marks = marks.agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    met = told.join(first.withColumn("first", F.lit(True)), ["doc_id", "digest"], "left").join(marks, "doc_id", "left")
    copy = F.col("doc_id").isNotNull() & F.col("first").isNull()
    kinds = [F.coalesce(k, F.lit(False)).alias(k) for k in ("good", "toxic")]
    return met.select("doc_id", "part", "A", "B", "C", "D", copy.alias("E"), *kinds)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    return interactions(judged(docs, labels), {name: F.col(name) for name in FILTERS})


SQL = r"""
with d as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w
  from documents
), l as (
  select doc_id, max(case when quality = 1 then 1 else 0 end) as good, max(case when toxic = 1 then 1 else 0 end) as toxic
  from labels group by doc_id
), f as (
  select d.part, coalesce(l.good, 0) as good, coalesce(l.toxic, 0) as toxic,
         len(w) < 200 as A,
         100 * len(list_distinct(w)) < 50 * len(w) as B,
         100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 3 * length(t) as C,
         regexp_matches(t, '[#$%&*|]') as D,
         coalesce(d.doc_id > min(d.doc_id) over (partition by t), false) as E
  from d left join l on d.doc_id = l.doc_id
), masks as (
  select part, good, toxic, A::int + 2 * B::int + 4 * C::int + 8 * D::int + 16 * E::int as m, count(*) as n
  from f group by all
), letters as (
  select * from (values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(x, bit)
), orders as (
  select a.x || b.x || c.x || d.x || e.x as filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] as bits
  from letters a, letters b, letters c, letters d, letters e
  where a.bit | b.bit | c.bit | d.bit | e.bit = 31
), steps as (
  select filter_order, step, bits[step] as bit, coalesce(list_sum(bits[1:step - 1]), 0)::bigint as earlier
  from orders, (select unnest(range(1, 6)) as step)
), counted as (
  select part, filter_order, step, bit,
         sum(case when m & (earlier | bit) = 0 then n else 0 end)::bigint as kept,
         sum(case when m & earlier = 0 and m & bit <> 0 then n else 0 end)::bigint as removed,
         sum(case when m & earlier <> 0 and m & bit <> 0 then n else 0 end)::bigint as redundant,
         sum(case when m = bit then n else 0 end)::bigint as unique_fails,
         sum(case when m & earlier = 0 and m & bit <> 0 then n * good else 0 end)::bigint as good_lost,
         sum(case when m & earlier = 0 and m & bit <> 0 then n * toxic else 0 end)::bigint as toxic_lost
  from masks, steps
  group by all
)
select part, filter_order, step::int as step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) over (partition by part, bit))::bigint as shapley
from counted
"""
