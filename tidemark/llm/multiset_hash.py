r"""Document fingerprints by a homomorphic multiset hash.

A text's pieces are its paragraphs (lines), cut further at white space that follows a sign, so at the ends of
sentences and clauses. Each piece hashes to a vector of
``LANES`` 16-bit numbers, every four of them under a seed of their own; a fingerprint is the piece count and the sum of the vectors, lane by lane modulo
2**32. Sums commute, so equal multisets of pieces have equal fingerprints in any order, and pieces are
inserted or deleted by adding or subtracting (``added``, ``removed``) without the rest of the text.

Lanes about their mean are sums of independent terms, so the cosine of two fingerprints estimates the
shared pieces over the geometric mean of the piece counts, within about ``1 / sqrt(LANES)``. Likeness is
that cosine, at least 0; equal fingerprints have likeness 1.

Everything is Spark expressions, one row at a time; no key gathers rows. Null text is the empty text,
which has no pieces. Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import shuffle_partitions, written

SEEDS = 16
LANES = 4 * SEEDS
PIECES = r"\n|(?<=[^\p{L}\p{N}\s])\s"
MODULUS = 1 << 32
LEAST = -(1 << 63)


def lanes(text: Column, pieces: str = PIECES) -> Column:
    """array<bigint>: the piece count, then the lanes."""
    units = F.filter(F.split(F.coalesce(text, F.lit("")), pieces), lambda u: u != "")
    seeds = F.array(*[F.lit(i) for i in range(SEEDS)])
    codes = F.transform(units, lambda u: F.transform(seeds, lambda j: F.xxhash64(j, u)))
    low = F.lit(0xFFFF)

    def four(x: Column) -> list[Column]:
        return [F.shiftrightunsigned(x, 16 * i).bitwiseAND(low) for i in range(4)]

    zero = F.lit(0).cast("long")
    nothing = F.struct(zero.alias("n"), F.array_repeat(F.struct(*[zero.alias(c) for c in "abcd"]), SEEDS).alias("s"))

    def step(state: Column, code: Column) -> Column:
        def plus(old: Column, x: Column) -> Column:
            return F.struct(*[(old[c] + y).alias(c) for c, y in zip("abcd", four(x), strict=True)])

        return F.struct((state["n"] + 1).alias("n"), F.zip_with(state["s"], code, plus).alias("s"))

    def flat(state: Column) -> Column:
        rows = F.transform(state["s"], lambda s: F.transform(F.array(*[s[c] for c in "abcd"]), lambda x: x % MODULUS))
        return F.concat(F.array(state["n"]), F.flatten(rows))

    return F.aggregate(codes, nothing, step, flat)


def added(a: Column, b: Column) -> Column:
    """Lanes of the two multisets together."""
    return F.zip_with(a, b, lambda x, y: (x + y) % MODULUS)


def removed(a: Column, b: Column) -> Column:
    """Lanes of ``a`` without the pieces of ``b``."""
    return F.zip_with(a, b, lambda x, y: F.pmod(x - y, F.lit(MODULUS)))


def stored(lane: Column) -> Column:
    """Lanes as array<int>, half as long on disk and in shuffles."""
    return F.transform(lane, lambda x: (x - MODULUS // 2).cast("int"))


def restored(lane: Column) -> Column:
    return F.transform(lane, lambda x: x.cast("long") + MODULUS // 2)


def text_of(lane: Column) -> Column:
    """The fingerprint as text: the count and eight hexadecimal digits for each lane."""
    digits = F.transform(F.slice(lane, 2, LANES), lambda x: F.lower(F.lpad(F.hex(x), 8, "0")))
    return F.concat_ws(":", lane[0].cast("string"), F.array_join(digits, ""))


def _centred(lane: Column) -> Column:
    """Signed lanes about the mean of as many pieces."""
    n = lane[0]
    half = F.lit(MODULUS // 2)
    return F.transform(
        F.slice(lane, 2, LANES),
        lambda x: (F.pmod(2 * x - n * F.lit(0xFFFF) + half, F.lit(MODULUS)) - half).cast("double"),
    )


def likeness(a: Column, b: Column) -> Column:
    """0 to 1; both must be columns of a written table, as they are read several times."""
    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)

    x, y = _centred(a), _centred(b)
    size = F.sqrt(dot(x, x) * dot(y, y))
    near = F.when(size > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), dot(x, y) / size)))
    return F.when(a == b, 1.0).otherwise(F.coalesce(near, F.lit(0.0)))


def following(ids: DataFrame) -> DataFrame:
    """``ids`` (id, distinct, and other columns) with ``next_id``; after the last comes the first.

    Ranges of ids are numbered, each range finds its own successors, and the first id of every range (one
    number a range on the driver) closes the gaps.
    """
    n = shuffle_partitions(ids.sparkSession)
    ranged = written(ids.repartitionByRange(n, "id").withColumn("part", F.spark_partition_id()), "ranges")
    heads = dict(ranged.groupBy("part").agg(F.min("id")).collect())
    if not heads:
        return ranged.select("*", F.col("id").alias("next_id")).drop("part")
    after, parts = {}, sorted(heads)
    for i, part in enumerate(parts):
        after[part] = heads[parts[(i + 1) % len(parts)]]
    successors = F.array(*[F.lit(after.get(p, 0)).cast("long") for p in range(parts[-1] + 1)])
    within = F.lead("id").over(Window.partitionBy("part").orderBy("id"))
    return ranged.withColumn("next_id", F.coalesce(within, successors[F.col("part")])).drop("part")


def edited_pairs(docs: DataFrame) -> DataFrame:
    """doc_id, id, next_id, order, text and edited of every row.

    ``edited``: the last quarter of the characters (rounded down) replaced by as many of the next document's
    first ones, or all it has. A null id counts as the least. Of several rows with one id, the one with the
    smallest hash (``order``) stands for it as the next document.
    """
    id_ = F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST))
    # One frame for both joins, so that the texts are shuffled once.
    base = docs.select(id_.alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    ids = base.groupBy("id").agg((F.max(F.length("text")) / 4).cast("int").alias("most"))
    order = written(following(ids), "order")
    wanted = order.select(F.col("next_id").alias("id"), F.col("id").alias("target"), "most")
    heads = (
        base.join(wanted, "id")
        .select("target", F.left(F.col("text"), F.col("most")).alias("head"), F.xxhash64("text").alias("order"))
        .groupBy(F.col("target").alias("id"))
        .agg(F.min_by("head", "order").alias("head"))
    )
    n = F.length("text")
    k = (n / 4).cast("int")
    edited = F.concat(F.left(F.col("text"), n - k), F.left(F.col("head"), k))
    return (
        base.join(order.select("id", "next_id"), "id")
        .join(heads, "id")
        .select(
            F.nullif("id", F.lit(LEAST)).alias("doc_id"), "id", "next_id",
            F.xxhash64("text").alias("order"), "text", edited.alias("edited"),
        )
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """The digest of every document, its edited text and its next document."""
    pairs = edited_pairs(docs).select(
        "doc_id", "id", "next_id", "order",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        stored(lanes(F.col("text"))).alias("own"),
        stored(lanes(F.col("edited"))).alias("other"),
    )
    pairs = written(pairs, "lanes")
    nexts = pairs.groupBy(F.col("id").alias("next_id")).agg(F.min_by("own", "order").alias("next"))
    met = pairs.join(nexts, "next_id")
    met = met.withColumns({c: restored(F.col(c)) for c in ("own", "other", "next")})
    return met.select(
        "doc_id", "n_chars", "edited_sha256",
        text_of(F.col("own")).alias("fingerprint"),
        text_of(F.col("other")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("other")).alias("near_edited"),
        likeness(F.col("own"), F.col("next")).alias("near_next"),
    )
