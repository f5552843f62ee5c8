"""Near-duplicate detection by order MinHash.

Words are lower-cased (A-Z); a document is the sequence of its ``K``-word shingles, each labelled with its
occurrence, so that it is unique in the document. A sketch takes the ``2`` labelled shingles with the least
hash under its own order and keeps them in text order: it agrees for two documents with about the square of
their shingles' Jaccard similarity, and less if the shared shingles stand in another order.

Two documents are linked if a banded alignment verifies them: the longest common subsequence of their
labelled shingles, within the band that a similarity of ``SIMILAR`` leaves, over the shingles of both
together is at least ``SIMILAR``. Classes are the connected components of the links.

Candidates. Documents with the same words are one text. Texts meet in buckets of two neighbouring sketches, and
each bucket has a leader, the least text. A text is first compared with the least of its leaders; then, where that
leaves a bucket in several classes, with its leader of another class. That settles copies of one text at two pairs a
text and bucket. Texts of buckets that still hold several classes, of whatever size, are gathered into families,
connected by buckets of three sketches, and in a family every two texts of different classes are compared: families
are dealt into blocks of about ``BLOCK`` shingles, a task counts the shingles that the texts of two blocks share,
aligns pairs that share enough, and joins classes as it goes. It returns the links that joined two classes,
fewer than it has texts, and no text meets another twice.

Before texts of the first two rounds are read, pairs whose sketches agree in fewer than ``AGREE`` of ``SKETCHES`` places
are passed over: at similarity 0.8 a sketch agrees with probability 0.64, and 0.6 if 4 of 5 shingles
are shared. No two neighbours of 40 agree, so that the texts never meet, with a chance of 4e-7 and 3e-6; fewer
than 9 of 40 agree with a chance of 2e-8 and 3e-7. Two texts of a family share none of its 120 buckets of three with a
chance of 2e-6 and 1e-5, and meet nevertheless where other texts connect them.

Exact copies are reduced to one row a task before they are shuffled, and joined back by a join that Spark may
split. Nothing is collected to the driver but counts.

Null ids count as the least. Texts without words are copies of each other. Texts of fewer than ``K`` words
have one shingle, all their words. Rows of equal id are one document, near to whatever
one of its texts is near to. Other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, functions as F

from tidemark.llm.common import blocks, dropped, grams, mixed, owners, signed, words, written

K, SIMILAR = 5, 0.8
SKETCHES, AGREE = 40, 9
#: Buckets of families: sketches i, i + x and i + y, for every i.
TRIPLES = [(1, 3), (7, 18), (5, 14)]
#: Shingles of a block of a family; a text counts as ``PER_TEXT`` more.
BLOCK, PER_TEXT = 1 << 19, 512
LEAST = -(1 << 63)
_SEEDS = mixed(np.arange(1, SKETCHES + 1, dtype=np.uint64) << np.uint64(32)) | np.uint64(1)


def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Labelled shingles of a block in text order, each text's first one, and each text's words."""
    w = words(data, offsets, lower=True)
    size = np.diff(w.first)
    code = grams(w.hash, K)
    ends = np.repeat(w.first[1:], size)
    whole = np.flatnonzero(np.arange(len(code)) + K <= ends[: len(code)])
    owner = owners(w.first)[whole]
    code = code[whole]
    short = np.flatnonzero((size > 0) & (size < K))
    if len(short):
        extra = np.array([int(grams(w.hash[w.first[t] : w.first[t + 1]], int(size[t]))[0]) for t in short], np.uint64)
        owner, code = np.concatenate([owner, short]), np.concatenate([code, extra])
        order = np.argsort(owner, kind="stable")
        owner, code = owner[order], code[order]
    key = (owner.astype(np.uint64) << np.uint64(44)) | (code >> np.uint64(20))
    order = np.argsort(key, kind="stable")
    same = np.zeros(len(key), bool)
    same[1:] = key[order][1:] == key[order][:-1]
    if same.any():
        place = np.arange(len(key))
        nth = place - np.maximum.accumulate(np.where(same, 0, place))
        later = order[same]
        code[later] = mixed(code[later] + nth[same].astype(np.uint64))
    return code, np.searchsorted(owner, np.arange(len(offsets))), w


def sketches(code: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A row of ``SKETCHES`` numbers for each text; texts without shingles get zeros."""
    n = len(first) - 1
    out = np.zeros((n, SKETCHES), np.uint64)
    full = np.flatnonzero(np.diff(first))
    if not len(full):
        return out
    starts, size = first[:-1][full], np.diff(first)[full]
    most = np.uint64(0xFFFFFFFFFFFFFFFF)
    for s in range(SKETCHES):
        value = (code ^ (_SEEDS[s] >> np.uint64(7))) * _SEEDS[s]
        found = []
        for _ in range(2):
            least = np.minimum.reduceat(value, starts)
            at = np.flatnonzero(value == np.repeat(least, size))
            at = at[np.searchsorted(at, starts)]
            found.append(at)
            value[at] = most
        # With one shingle the second choice is the first again.
        a, b = np.minimum(*found), np.maximum(*found)
        out[full, s] = mixed(code[a] * np.uint64(0x9E3779B97F4A7C15) + code[b] + np.uint64(s))
    return out


def _signed_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, data, offsets in blocks(batch.column(1)):
            code, first, w = shingles(data, offsets)
            rows = signed(sketches(code, first).ravel())
            # Two hashes of all words stand for the text.
            up = np.arange(len(w.hash)) - np.repeat(w.first[:-1], np.diff(w.first))
            place = mixed(up.astype(np.uint64) + np.uint64(1))
            sums = []
            for value in (mixed(w.hash ^ place), mixed(w.hash + place)):
                total = np.zeros(len(value) + 1, np.uint64)
                np.cumsum(value, out=total[1:])
                sums.append(signed(total[w.first[1:]] - total[w.first[:-1]]))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(rows) + 1, SKETCHES, dtype=np.int32)), pa.array(rows))
            columns = [batch.column(0).slice(i, j - i), *map(pa.array, sums), pa.array(np.diff(first)), lists]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "h1", "h2", "n", "sketch"])


def _shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, data, offsets in blocks(batch.column(1)):
            code, first, _ = shingles(data, offsets)
            lists = pa.LargeListArray.from_arrays(pa.array(first), pa.array(signed(code))).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), lists], names=["text_id", "code"])


def aligned(a: np.ndarray, b: np.ndarray, similar: float = SIMILAR) -> float:
    """Banded similarity of two sequences of distinct entries; 0 where it cannot reach ``similar``."""
    total = len(a) + len(b)
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    need = similar * total / (1 + similar)
    if len(i) < need - 1e-9:
        return 0.0
    order = np.argsort(i)
    i, j = i[order], j[order]
    # Entries on one side only number at most this, and no match can be further off its place.
    j = j[np.abs(i - j) <= total - 2 * need + 1e-9]
    if len(j) and (np.diff(j) > 0).all():
        common = len(j)
    else:
        tails: list[int] = []
        for x in j.tolist():
            at = bisect_left(tails, x)
            tails[at : at + 1] = [x]
        common = len(tails)
    return common / max(1, total - common)


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = batch.column(2), batch.column(3)
        keep = [aligned(a[i].values.to_numpy(), b[i].values.to_numpy()) >= SIMILAR for i in range(batch.num_rows)]
        mask = pa.array(keep, pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["a", "b"])


def components(links: DataFrame, rounds: int | None = None) -> DataFrame:
    """node and label (its component's least node) of links (a, b), by label propagation and jumps.

    After so many ``rounds``, if given, labels may still be those of parts of components.
    """
    both = written(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label")), "labels")
    while rounds is None or rounds > 0:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b")
        near = near.groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        moved = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("to"))
        jump = labels.select(F.col("node").alias("to"), F.col("label").alias("further"))
        moved = moved.join(jump, "to", "left").select("node", "old", F.least("to", "further").alias("label"))
        changes = Observation()
        moved = written(moved.observe(changes, F.count_if(F.col("label") < F.col("old")).alias("n")), "labels")
        dropped(labels)
        labels = moved.select("node", "label")
        rounds = rounds and rounds - 1
        if not changes.get["n"]:
            break
    dropped(both)
    return labels


def _ordered(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _led(buckets: DataFrame, order: Column) -> DataFrame:
    """Every text of a bucket, with the bucket's leader, the first by ``order``, and both classes."""
    leader = F.min_by(F.struct("text_id", "label"), order)
    led = buckets.groupBy("band", "bucket").agg(leader.alias("leader"))
    return buckets.join(led, ["band", "bucket"]).where(F.col("leader.label") != F.col("label"))


def _crossing(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """Texts, with their classes, of the buckets that hold several classes."""
    own = F.coalesce("label", "text_id")
    told = buckets.join(labels.withColumnRenamed("node", "text_id"), "text_id", "left").withColumn("label", own)
    several = told.groupBy("band", "bucket").agg(F.min("label").alias("l0"), F.max("label").alias("l1")).where("l0 < l1")
    return written(told.join(several.select("band", "bucket"), ["band", "bucket"]), "crossing")


def _likely(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Distinct pairs whose sketches and sizes allow a link."""
    def side(name: str) -> DataFrame:
        return texts.select(F.col("text_id").alias(name), F.col("sketch").alias(f"s{name}"), F.col("n").alias(f"n{name}"))

    agree = F.size(F.filter(F.zip_with("sa", "sb", lambda x, y: x == y), lambda x: x))
    near = F.least("na", "nb") >= SIMILAR * F.greatest("na", "nb")
    met = pairs.distinct().join(side("a"), "a").join(side("b"), "b").where(near & (agree >= AGREE))
    return written(met.select("a", "b"), "pairs")


def _families(left: DataFrame, texts: DataFrame) -> DataFrame:
    """text_id and family of the texts of ``left`` that three sketches connect with texts of another class."""
    n = SKETCHES
    buckets = [
        F.struct(F.lit(k * n + i).alias("band"), F.xxhash64(*[F.col("sketch")[(i + z) % n] for z in (0, x, y)]).alias("bucket"))
        for k, (x, y) in enumerate(TRIPLES)
        for i in range(n)
    ]
    told = left.select("text_id", "label").distinct().join(texts.select("text_id", "sketch"), "text_id")
    met = written(told.select("text_id", "label", F.inline(F.array(*buckets))), "triples")
    least = F.min("text_id").alias("a")
    several = met.groupBy("band", "bucket").agg(least, F.min("label").alias("l0"), F.max("label").alias("l1")).where("l0 < l1")
    shared = written(met.drop("label").join(several.select("band", "bucket", "a"), ["band", "bucket"]), "shared")
    # First every text with the least of its leaders; then only what buckets still connect.
    first = components(shared.groupBy(F.col("text_id").alias("b")).agg(F.min("a").alias("a")), rounds=2)
    own = F.coalesce("label", "text_id").alias("own")
    told = written(
        shared.join(first.withColumnRenamed("node", "text_id"), "text_id", "left").select("text_id", "band", "bucket", own), "told"
    )
    over = told.groupBy("band", "bucket").agg(F.min("own").alias("a"), F.max("own").alias("z")).where("a < z")
    edges = told.join(over.select("band", "bucket", "a"), ["band", "bucket"]).where("a <> own")
    found = components(edges.select("a", F.col("own").alias("b")).distinct()).withColumnRenamed("node", "own")
    members = told.select("text_id", "own").distinct().join(found, "own", "left")
    members = written(members.select("text_id", F.coalesce("label", "own").alias("family")), "members")
    dropped(met, shared, first, told)
    return members


def _joining(group: pa.Table) -> pa.Table:
    """Links that join classes of one pair of blocks of a family, none of which follows from the others."""
    part, ids = group.column("part").to_numpy(), group.column("text_id").to_numpy()
    p, q = group.column("p")[0].as_py(), group.column("q")[0].as_py()
    one, two = np.flatnonzero(part == p), np.flatnonzero(part == q)
    of = np.unique(group.column("label").to_numpy(), return_inverse=True)[1]
    if not of.any():
        return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
    lists = group.column("code").combine_chunks()
    code, ends = lists.flatten().to_numpy(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
    size = np.diff(ends)
    rank = np.unique(code, return_inverse=True)[1]
    # For every shingle the texts of the second block that have it.
    place = np.full(len(ids), -1)
    place[two] = np.arange(len(two))
    owner = np.repeat(place, size)
    entries = np.flatnonzero(owner >= 0)
    entries = entries[np.argsort(rank[entries], kind="stable")]
    holders, many = owner[entries], np.bincount(rank[entries], minlength=int(rank.max(initial=-1)) + 1)
    first = np.cumsum(many) - many
    found = []
    for i in one.tolist():
        mine = rank[ends[i] : ends[i + 1]]
        n, start = many[mine], first[mine]
        at = np.arange(n.sum()) + np.repeat(start - (np.cumsum(n) - n), n)
        shared = np.bincount(holders[at], minlength=len(two))
        enough = shared >= SIMILAR * (size[i] + size[two]) / (1 + SIMILAR) - 1e-9
        for j in two[enough & (of[two] != of[i]) & ((two > i) | (p != q))].tolist():
            if of[i] != of[j] and aligned(code[ends[i] : ends[i + 1]], code[ends[j] : ends[j + 1]]) >= SIMILAR:
                found.append((min(ids[i], ids[j]), max(ids[i], ids[j])))
                of[of == of[j]] = of[i]
    a, b = zip(*found, strict=True) if found else ((), ())
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _links_of_families(left: DataFrame, texts: DataFrame, codes: DataFrame) -> DataFrame:
    """Links between the classes of every family; a text goes to as many tasks as its family has blocks."""
    labels = left.select("text_id", "label").distinct()
    families = _families(left, texts)
    members = written(families.join(labels, "text_id"), "families")
    dropped(families)
    sizes = members.join(texts.select("text_id", "n"), "text_id").groupBy("family")
    sizes = sizes.agg(F.ceil(F.sum(F.col("n") + PER_TEXT) / BLOCK).alias("blocks"))
    dealt = members.join(sizes, "family").withColumn("part", F.pmod(F.xxhash64("text_id", F.lit(3)), F.col("blocks")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = dealt.select(
        "family", "text_id", "label", "part", F.least("part", "other").alias("p"), F.greatest("part", "other").alias("q")
    )
    joining = dealt.join(codes, "text_id").groupBy("family", "p", "q").applyInArrow(_joining, "a long, b long")
    found = written(joining, "links")
    dropped(members)
    return found


def _links(pairs: DataFrame, codes: DataFrame) -> DataFrame:
    one = codes.select(F.col("text_id").alias("a"), F.col("code").alias("x"))
    two = codes.select(F.col("text_id").alias("b"), F.col("code").alias("y"))
    joined = pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y")
    return written(joined.mapInArrow(_verified, "a long, b long"), "links")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """id (of every row, null ids as the least) and class_id, the least id of its class."""
    id_ = F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST))
    base = docs.select(id_.alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = written(base.mapInArrow(_signed_texts, "id long, h1 long, h2 long, n long, sketch array<long>"), "sketches")
    texts = rows.groupBy("h1", "h2").agg(
        F.min("id").alias("text_id"), F.any_value("n").alias("n"), F.any_value("sketch").alias("sketch")
    )
    texts = written(texts, "texts")
    copies = rows.select("id", "h1", "h2").join(texts.select("h1", "h2", "text_id"), ["h1", "h2"]).select("id", "text_id")

    bands = F.transform(
        F.sequence(F.lit(0), F.lit(SKETCHES - 1)),
        lambda i: F.struct(
            i.alias("band"), F.xxhash64(F.col("sketch")[i], F.col("sketch")[(i + 1) % SKETCHES]).alias("bucket")
        ),
    )
    met = texts.where("n > 0").select("text_id", F.inline(bands))
    crowded = written(met.groupBy("band", "bucket").agg(F.count("*").alias("size")).where("size > 1"), "crowded")
    buckets = written(met.join(crowded.select("band", "bucket"), ["band", "bucket"]), "buckets")
    dropped(crowded)

    playing = buckets.select(F.col("text_id").alias("id")).distinct()
    spelt = base.join(playing, "id").withColumn("hash", F.xxhash64("text")).dropDuplicates(["id", "hash"])
    codes = written(spelt.select("id", "text").mapInArrow(_shingled, "text_id long, code array<long>"), "codes")
    # An id with several texts is one document, which ties these texts.
    first = copies.groupBy("id").agg(F.min("text_id").alias("a"), F.max("text_id").alias("b")).where("a < b")
    tied = copies.join(first.select("id", "a"), "id").where("a <> text_id").select("a", F.col("text_id").alias("b"))
    links = written(tied.distinct(), "tied")

    # First every text with the least of its leaders, one pair a text.
    one = buckets.withColumn("label", F.col("text_id"))
    least = _led(one, F.col("text_id")).groupBy("text_id").agg(F.min("leader.text_id").alias("leader"))
    pairs = _likely(least.select(*_ordered(F.col("leader"), F.col("text_id"))), texts)
    links = links.union(_links(pairs, codes))
    # Labels of parts of classes do here: they only tell which texts need not be compared.
    labels = components(links, rounds=2)
    # Then, where a bucket still holds several classes, with its leader.
    left = _crossing(buckets, labels)
    more = _led(left, F.col("text_id")).select(*_ordered(F.col("leader.text_id"), F.col("text_id")))
    second = _likely(more.join(pairs, ["a", "b"], "left_anti"), texts)
    dropped(labels, buckets, pairs)
    links = links.union(_links(second, codes))
    labels = components(links, rounds=2)
    # Then every two texts of different classes in a family.
    still = _crossing(left.select("band", "bucket", "text_id"), labels)
    dropped(left, second, labels)
    if not still.isEmpty():
        links = links.union(_links_of_families(still, texts, codes))
    labels = components(links)
    dropped(still, codes, links)

    own = copies.join(labels.withColumnRenamed("node", "text_id"), "text_id", "left")
    return own.select("id", F.coalesce("label", "text_id").alias("class_id"), "text_id")


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, class_id and copy_of (the least id with the same words) of every row."""
    found = near_duplicates(docs)
    return found.select(
        F.when(F.col("id") != LEAST, F.col("id")).alias("doc_id"), "class_id", F.col("text_id").alias("copy_of")
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with the least id of their class, with all their columns.

    Rows of equal id are one document, and all of them stay.
    """
    kept = near_duplicates(docs).where("id = class_id").select("id").distinct()
    return docs.join(kept, F.coalesce(docs["doc_id"].cast("long"), F.lit(LEAST)) == kept["id"], "left_semi")
