"""Resampling of documents by importance towards a target set, over hashed word n-grams.

A 256-byte table lower-cases A-Z and blanks every byte that separates words, so that ``bytes.split`` yields the
words of UTF-8 text. A run of words is hashed by carrying crc32 on: the checksum of a run is the seed for the
blank and the next word. Counters reduce the buckets of a batch, a task hands its counts on bucket by bucket,
and Spark adds them up. A bucket's gain is the logarithm of its smoothed share in the target over its share in
the documents, in thousandths; there are ``buckets`` gains, which is all that passes through the driver.

A document's weight is the mean gain of its features, its score adds Gumbel noise drawn from its id, and the
highest scores are drawn: sampling without replacement in proportion to the exponential weights. Ranks come from
one range partitioning of the written scores: positions within sorted partitions, plus the sizes of the
partitions before, one number each on the driver. No text is shuffled or held longer than ``PIECE`` bytes at once.

Null texts have no words; texts without features weigh 0. Ids need not be unique: rows of one id share its noise, and
ties of score and id go to the greater weight, then to more features. A null id draws the noise of an empty
id and comes last among equal scores. Empty tables are empty, and an empty target has no features. Other columns
are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import shuffle_partitions, written

BUCKETS = 10_000
#: Bytes of a text split at once.
PIECE = 1 << 20


def _folded(byte: int) -> int:
    if 0x41 <= byte <= 0x5A:
        return byte + 32
    kept = byte >= 0x80 or 0x30 <= byte <= 0x39 or 0x61 <= byte <= 0x7A
    return byte if kept else 0x20


TABLE = bytes(map(_folded, range(256)))


def split(text: bytes, piece: int = PIECE) -> Iterator[list[bytes]]:
    """The words of a text in order, in lists of about ``piece`` bytes; a word is never cut."""
    open_: list[bytes] = []  # parts of a word that reaches the end of its piece
    for i in range(0, len(text), piece):
        part = text[i : i + piece].translate(TABLE)
        words = part.split()
        if open_ and part[:1] != b" ":
            open_.append(words.pop(0))
            if not words and part[-1:] != b" ":
                continue
        if open_:
            words.insert(0, b"".join(open_))
        open_ = [words.pop()] if words and part[-1:] != b" " else []
        if words:
            yield words
    if open_:
        yield [b"".join(open_)]


def features(text: bytes, longest: int, buckets: int) -> Iterator[tuple[int, list[int]]]:
    """Pieces of a text: its words, and the bucket of every run of 1 to ``longest`` words that ends there."""
    runs: list[int] = []  # checksums of the runs that end at the word before, the shortest first
    for words in split(text):
        if longest == 1:
            yield len(words), [crc32(w) % buckets for w in words]
            continue
        out = []
        for w in words:
            tail = b" " + w
            runs = [crc32(w), *[crc32(tail, seed) for seed in runs[: longest - 1]]]
            out += [x % buckets for x in runs]
        yield len(words), out


def _counted(longest: int, buckets: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: Counter[int] = Counter()
        for batch in batches:
            for text in batch.column(0).cast(pa.large_binary()):
                for _, found in features(text.as_py() or b"", longest, buckets):
                    totals.update(found)
        rows = [pa.array(totals.keys(), pa.int32()), pa.array(totals.values(), pa.int64())]
        yield pa.RecordBatch.from_arrays(rows, names=["bucket", "n"])

    return run


def bucket_counts(texts: DataFrame, longest: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """bucket and n, of all features of the column ``text``; buckets without features are left out."""
    found = texts.select("text").mapInArrow(_counted(longest, buckets), "bucket int, n long")
    return found.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, longest: int = 1, buckets: int = BUCKETS) -> list[int]:
    """Of each bucket, the floored thousandfold logarithm of its smoothed target share over its share in the documents."""
    s, t = ([0] * buckets for _ in range(2))
    for counts, texts in ((s, docs), (t, target)):
        for row in bucket_counts(texts, longest, buckets).collect():
            counts[row["bucket"]] = row["n"]
    all_s, all_t = float(sum(s) + buckets), float(sum(t) + buckets)
    return [math.floor(1000 * math.log((y + 1) * all_s / ((x + 1) * all_t))) for x, y in zip(s, t, strict=True)]


def _weighed(gain: list[int], longest: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_features, weights = [], [], []
            for text in batch.column(1).cast(pa.large_binary()):
                total = n = words = 0
                for more, found in features(text.as_py() or b"", longest, len(gain)):
                    total += sum(map(gain.__getitem__, found))
                    n += len(found)
                    words += more
                n_words.append(words)
                n_features.append(n)
                weights.append(total // n if n else 0)
            columns = [batch.column(0), *[pa.array(x, pa.int64()) for x in (n_words, n_features, weights)]]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_features", "weight"])

    return run


def weighed(docs: DataFrame, gain: list[int], longest: int = 1) -> DataFrame:
    """doc_id, n_words, n_features and weight of every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_weighed(gain, longest), "doc_id long, n_words long, n_features long, weight long")


def scored(rows: DataFrame, seed: int = 2024) -> DataFrame:
    """The rows with ``score``: their weight and Gumbel noise from the seed and their id."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296)))
    return rows.withColumn("score", F.col("weight") + noise)


def ranked(rows: DataFrame, percent: int, least_words: int) -> DataFrame:
    """The rows with ``rank`` among the drawn ``percent`` of those with ``least_words`` words; null for the rest."""
    spark = rows.sparkSession
    apart = F.col("n_words") < least_words
    order = [apart, F.desc("score"), F.asc_nulls_last("doc_id"), F.desc("weight"), F.desc("n_features")]
    parts = shuffle_partitions(spark)
    sorted_ = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    # An id that Spark makes of the partition's number and the row's place in it.
    placed = written(sorted_.withColumn("place", F.monotonically_increasing_id()), "placed")
    part, place = F.shiftright("place", 33).cast("int"), F.col("place").bitwiseAND((1 << 33) - 1)
    sizes = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"), F.sum((~apart).cast("long")).alias("fit"))
    before, all_fit = {}, 0
    ahead = 0
    for row in sorted(sizes.collect()):
        before[row["part"]], ahead, all_fit = ahead, ahead + row["n"], all_fit + row["fit"]
    offsets = F.create_map(*[F.lit(x).cast("long") for pair in (before or {0: 0}).items() for x in pair])
    rank = F.element_at(offsets, part.cast("long")) + place + 1
    drawn = ~apart & (rank <= percent * all_fit // 100)
    return placed.withColumn("rank", F.when(drawn, rank)).drop("place")


def resampled(
    docs: DataFrame,
    target: DataFrame,
    longest: int = 1,
    buckets: int = BUCKETS,
    percent: int = 10,
    least_words: int = 20,
    seed: int = 2024,
) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every row of ``docs``, drawn towards the texts of ``target``."""
    found = written(scored(weighed(docs, gains(docs, target, longest, buckets), longest), seed), "scored")
    return ranked(found, percent, least_words).select("doc_id", "n_features", "weight", "score", "rank")


def drawn(docs: DataFrame, target: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` whose ids are drawn, with all their columns."""
    ids = resampled(docs, target, **settings).where("rank is not null").select("doc_id").distinct()
    return docs.join(ids, docs["doc_id"].cast("long").eqNullSafe(ids["doc_id"]), "left_semi")


SQL = r"""
with recursive rounds as (
  select i as byte, i::ubigint as c, 0 as k from range(256) r(i)
  union all
  select byte, case when c & 1 = 1 then xor(c >> 1, 3988292384::ubigint) else c >> 1 end, k + 1 from rounds where k < 8
), crc_table as (
  select list(c order by byte) as entries from rounds where k = 8
), d as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents
), b as (
  select regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark
), vocabulary as (
  select unnest(w) as word from d union select unnest(w) from b
), bytes as (
  select word, hex(encode(word)) as h from vocabulary
), hashed as (
  select word, xor(list_reduce(
      list_prepend(4294967295::ubigint, list_transform(range(0, length(h) // 2),
        lambda i: ((position(substr(h, 2 * i::int + 1, 1) in '0123456789ABCDEF') - 1) * 16
             + position(substr(h, 2 * i::int + 2, 1) in '0123456789ABCDEF') - 1)::ubigint)),
      lambda c, x: xor(c >> 8, entries[(xor(c, x) & 255)::int + 1])), 4294967295::ubigint) % 10000 as bucket
  from bytes, crc_table
), s as (
  select bucket, count(*) as n from (select unnest(w) as word from d) join hashed using (word) group by bucket
), t as (
  select bucket, count(*) as n from (select unnest(w) as word from b) join hashed using (word) group by bucket
), sums as (
  select coalesce((select sum(n) from s), 0)::double as s_all, coalesce((select sum(n) from t), 0)::double as t_all
), gain as (
  select s.bucket, floor(1000 * ln((coalesce(t.n, 0) + 1) * (s_all + 10000) / ((s.n + 1) * (t_all + 10000))))::bigint as g
  from s left join t using (bucket), sums
), weighed as (
  select doc_id, len(w)::bigint as n_features,
         coalesce((select floor(sum(g)::double / count(*)) from (select unnest(w) as word) join hashed using (word) join gain using (bucket)), 0)::bigint as weight
  from d
), scored as (
  select *, weight + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::varchar, '')), 1, 8))::bigint + 0.5) / 4294967296)))::bigint as score
  from weighed
), ranked as (
  select *, case when n_features >= 20 then row_number() over (
      partition by n_features >= 20 order by score desc, doc_id nulls last, weight desc, n_features desc) end as place
  from scored
)
select doc_id, n_features, weight, score,
       case when place <= 10 * (select count(*) from scored where n_features >= 20) // 100 then place end as rank
from ranked
"""
