r"""Benchmark decontamination by winnowing.

Texts are lower-cased (A-Z) and cut into words. A window is ``WINDOW`` consecutive words of a benchmark
item; an item of fewer words is one window of its own length. The fingerprint of a window is the least hash
of its ``GRAM``-word shingles (of a window shorter than that, the hash of the window). The same words give
the same fingerprint wherever they occur, so no shared window is missed; neighbouring windows mostly share
theirs, so a document has few.

Training and test fingerprints are joined, those of the documents once they are written; where they meet,
the document is read again, and its windows with that fingerprint are spelt out and joined with the items' windows word by word, so hash collisions do not count, and hits
extend over all windows that occur. Everything is Spark expressions. Fingerprints are distinct within a
document before they are shuffled; a fingerprint in a third of all documents only filters them (semi join),
which Spark may split.

A document is contaminated if at least one word, and a twentieth of its words, lies in an occurring window.
Null texts have no words. Rows that repeat id and text have equal results, a row each. Empty tables are
allowed on either side. Other columns are not read.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import dropped, written

WINDOW, GRAM = 13, 6
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.filter(F.split(lowered, BREAKS), lambda w: w != "")


def _sliding(array: Column, n: Column, width: int, of) -> Column:
    """``of`` every ``width`` consecutive entries of an array of ``n``."""
    starts = F.when(n >= width, F.sequence(F.lit(1), n - (width - 1))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: of(F.slice(array, i, width)))


def with_fingerprints(df: DataFrame, widths: list[int]) -> DataFrame:
    """Adds ``prints``: for each width an array with the fingerprint of every window of so many words.

    ``df`` must have the columns ``words`` and ``n``. Every step is a projection of its own and reads its
    input twice, so that Spark does not copy one step into the lambda of the next.
    """
    df = df.withColumn("codes", F.transform("words", lambda w: F.xxhash64(w)))
    n = F.size("codes")
    df = df.withColumn("grams", _sliding(F.col("codes"), n, GRAM, lambda x: F.xxhash64(x)))
    prints = []
    for width in widths:
        if width >= GRAM:
            prints.append(_sliding(F.col("grams"), F.size("grams"), width - GRAM + 1, F.array_min))
        else:
            prints.append(_sliding(F.col("codes"), n, width, lambda x, w=width: F.xxhash64(F.lit(w), x)))
    return df.withColumn("prints", F.array(*prints)).drop("codes", "grams")


def item_windows(items: DataFrame) -> DataFrame:
    """item_id, width, window (words joined by a space) and print, distinct."""
    base = items.select("item_id", words_of(F.col("text")).alias("words")).withColumn("n", F.size("words"))
    base = written(base.where("n > 0").withColumn("width", F.least("n", F.lit(WINDOW))), "items")
    widths = sorted(r[0] for r in base.select("width").distinct().collect())  # at most WINDOW numbers
    parts = []
    for width in widths:
        prints = with_fingerprints(base.where(F.col("width") == width), [width])
        spelt = _sliding(F.col("words"), F.col("n"), width, lambda x: F.array_join(x, " "))
        pairs = F.arrays_zip(spelt.alias("window"), F.col("prints")[0].alias("print"))
        parts.append(prints.select("item_id", "width", F.inline(pairs)))
    if not parts:
        return items.sparkSession.createDataFrame([], "item_id string, width int, window string, print long")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select(F.col("item_id").cast("string").alias("item_id"), "width", "window", "print").distinct()


def _spelling(width: int):
    """Place of a window to its start, width and words."""
    def spell(j: Column) -> Column:
        window = F.array_join(F.slice("words", j + 1, width), " ")
        return F.struct(j.alias("start"), F.lit(width).alias("width"), window.alias("window"))

    return spell


def _covered(windows: Column) -> Column:
    """Words covered by windows (start, width)."""
    def step(state: Column, w: Column) -> Column:
        end = w["start"] + w["width"]
        new = F.greatest(F.lit(0), end - F.greatest(w["start"], state["end"]))
        return F.struct((state["n"] + new).alias("n"), F.greatest(end, state["end"]).alias("end"))

    nothing = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    return F.aggregate(F.array_sort(windows), nothing, step, lambda s: s["n"]).cast("long")


def _key() -> Column:
    """256 bits that stand for a row's id and text; null and empty texts are one."""
    text = F.sha2(F.coalesce("text", F.lit("")), 256)
    id_ = F.coalesce(F.concat(F.lit("="), F.col("doc_id").cast("string")), F.lit(""))
    return F.unhex(F.sha2(F.concat(text, id_), 256))


def hits(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, key, n_words, and starts (start, width) and item_ids of occurring windows, null if none.

    ``key`` stands for the row's id and text.
    """
    test = written(item_windows(items), "item_windows")
    widths = sorted(r[0] for r in test.select("width").distinct().collect())
    base = docs.select("doc_id", "text", _key().alias("key"))
    if not widths:
        none = F.lit(None).cast("array<struct<start:int,width:int>>")
        counted = base.select("doc_id", "key", F.size(words_of(F.col("text"))).cast("long").alias("n_words"))
        return counted.select("*", none.alias("starts"), F.lit(None).cast("array<string>").alias("item_ids"))
    prints = written(test.select("print").distinct(), "item_prints")
    first = base.select("doc_id", "key", words_of(F.col("text")).alias("words")).withColumn("n", F.size("words"))
    first = with_fingerprints(first, widths).select(
        "doc_id", "key", F.col("n").cast("long").alias("n_words"), F.array_distinct(F.flatten("prints")).alias("prints")
    )
    first = written(first, "prints")
    met = (
        first.select("key", F.explode("prints").alias("print"))
        .join(prints, "print", "left_semi")
        .groupBy("key")
        .agg(F.collect_set("print").alias("met"))
    )
    met = written(met, "met")
    # Only texts with a meeting are read and split again; rows that repeat id and text once. Eight bytes of
    # their keys thin out the texts first, which is a list that Spark can often send to the scan.
    some = written(met.select(F.xxhash64("key").alias("some")), "some")
    thinned = base.withColumn("some", F.xxhash64("key")).join(some, "some", "left_semi")
    kept = thinned.join(met, "key").select("key", "met", words_of(F.col("text")).alias("words")).dropDuplicates(["key"])
    kept = kept.withColumn("n", F.size("words"))
    told = with_fingerprints(kept, widths)
    spelt = []
    for i, width in enumerate(widths):
        places = F.transform(F.col("prints")[i], lambda p, j: F.when(F.array_contains(F.col("met"), p), j))
        places = F.filter(places, lambda j: j.isNotNull())
        spelt.append(F.transform(places, _spelling(width)))
    found = written(told.select("key", F.concat(*spelt).alias("windows")), "windows")
    dropped(met, some)
    occurring = (
        found.select("key", F.inline("windows"))
        .join(test.select("width", "window", "item_id"), ["width", "window"])
        .groupBy("key")
        .agg(
            F.collect_set(F.struct("start", "width")).alias("starts"),
            F.collect_set("item_id").alias("item_ids"),
        )
    )
    return first.select("doc_id", "key", "n_words").join(occurring, "key", "left")


def decontaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The digest of every document."""
    found = hits(docs, items)
    n_hit = F.coalesce(_covered(F.col("starts")), F.lit(0).cast("long"))
    ids = F.coalesce(F.col("item_ids"), F.array().cast("array<string>"))
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), ids.alias("ids")).select(
        "doc_id", "n_words", "n_hit",
        F.size("ids").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("ids"), ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns."""
    found = hits(docs, items)
    n_hit = F.coalesce(_covered(F.col("starts")), F.lit(0).cast("long"))
    bad = found.where((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).select("key").distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), _key().alias("key"))
    kept = rows.join(bad, "key", "left_anti")
    return kept.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])


_UPPER, _LOWER = string.ascii_uppercase, string.ascii_lowercase
SQL = f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{WORDS}') AS w
  FROM documents
), i AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{WORDS}') AS w
  FROM benchmark
), item_windows AS (
  SELECT DISTINCT item_id, width, array_to_string(w[s : s + width - 1], ' ') AS window_words
  FROM (SELECT item_id, w, width, unnest(range(1, len(w) - width + 2)) AS s
        FROM (SELECT *, least(len(w), {WINDOW}) AS width FROM i WHERE len(w) > 0))
), doc_windows AS (
  SELECT doc_id, width, s, array_to_string(w[s : s + width - 1], ' ') AS window_words
  FROM (SELECT doc_id, w, width, unnest(range(1, len(w) - width + 2)) AS s
        FROM d, (SELECT DISTINCT width FROM item_windows))
), found AS (
  SELECT DISTINCT doc_id, width, s, item_id FROM doc_windows JOIN item_windows USING (width, window_words)
), hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(s, s + width)) AS p FROM found) GROUP BY doc_id
), listed AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM found) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN listed USING (doc_id)"""
