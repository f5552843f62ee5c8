r"""URL filter by a cascade of Bloom filters.

A listed key set is encoded over the complete universe of keys that occur. Level 1 holds the listed
keys; level 2 holds the other keys that level 1 takes for listed; level 3 the listed keys that level 2
takes for others, and so on, until a level errs on no key. A key's membership is the parity of the
first level that does not hold it, which is exact for every key of the universe, without a join on keys.

Rules decide before the list does: a rule fits a host and its subdomains where the path starts with
the rule's path; the longest rule wins, between rules of equal length the one with the longer host.

Everything is Spark expressions, in one way at every size. Keys are dealt into shards of about ``SHARD_KEYS`` by their
hash. A level of a shard is a bitmap of ``BITS`` bits, made by an aggregate that each task begins for its own keys,
and the levels of all shards are built at once; the driver sees how many keys a level has, and the filters stay in a
written table. A page meets the filters of its shard, of which there are ``SALTS`` copies, so that an address
with a third of all pages is spread over as many partitions. Keys are distinct values, reduced before the shuffle.

Null urls and urls without ``://`` have an empty host and path; the empty address is a key like any other.
Repeated rows are judged alike. Empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import dropped, written

#: Keys of a shard, about; bits of one level of a shard (fixed: what Spark's bitmap aggregates hold);
#: copies of the filters that pages are dealt over.
SHARD_KEYS, BITS, SALTS = 1 << 14, 1 << 15, 16
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
#: (verdict, host, path)
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


def url_part(url: Column, part: int) -> Column:
    """1: the host, A-Z lower-cased; 2: the path."""
    found = F.coalesce(F.regexp_extract(url, PARTS, part), F.lit(""))
    return F.translate(found, string.ascii_uppercase, string.ascii_lowercase) if part == 1 else found


def shard_of(key: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(0)), F.lit(shards)).cast("int")


def places(key: Column, level: Column | int, probes: Column | int) -> Column:
    """The bits that stand for a key in a level."""
    level, probes = (x if isinstance(x, Column) else F.lit(x) for x in (level, probes))
    code = F.xxhash64(key, level)
    low, high = code.bitwiseAND(F.lit(0x7FFFFFFF)), F.shiftrightunsigned(code, 33).bitwiseOR(F.lit(1))
    return F.transform(F.sequence(F.lit(1), probes), lambda i: (low + high * i) % BITS)


def holds(key: Column, filter_: Column) -> Column:
    """Whether all bits of a key are set in a level (number, probes, bits)."""
    def is_set(place: Column) -> Column:
        byte = F.substring(filter_["bits"], F.shiftright(place, 3).cast("int") + 1, F.lit(1))
        return F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (place % 8).cast("int")) == 1

    return F.forall(places(key, filter_["number"], filter_["probes"]), is_set)


def contains(key: Column, levels: Column) -> Column:
    """Whether a key is listed, by its shard's levels in order; exact for keys of the universe."""
    first = F.array_position(F.transform(levels, lambda level: holds(key, level)), False)
    return F.when(first == 0, F.size(levels) % 2 == 1).otherwise(first % 2 == 0)


def build(universe: DataFrame, shard_keys: int = SHARD_KEYS) -> tuple[DataFrame, int]:
    """(shard, levels) of a cascade over ``universe`` (key, listed; keys distinct), and the number of shards.

    Shards without listed keys have no row.
    """
    shards = max(1, math.ceil(universe.count() / shard_keys))
    placed = written(universe.select(shard_of(F.col("key"), shards).alias("shard"), "key", "listed"), "placed")
    alive = {side: placed.where("listed" if side else "not listed").select("shard", "key") for side in (True, False)}
    levels, side, number = [], True, 1
    while n := alive[side].count():
        probes = min(8, max(1, round(BITS * shards / n * math.log(2))))
        bits = alive[side].select("shard", F.explode(places(F.col("key"), number, probes)).alias("place"))
        built = bits.groupBy("shard").agg(F.bitmap_construct_agg("place").alias("bits"))
        level = F.struct(F.lit(number).alias("number"), F.lit(probes).alias("probes"), "bits").alias("level")
        built = written(built.select("shard", level), "level")
        levels.append(built)
        side, number = not side, number + 1
        # The keys of the other side that this level takes for its own.
        erring = alive[side].join(built, "shard").where(holds(F.col("key"), F.col("level"))).select("shard", "key")
        alive[side] = written(erring, "erring")
    if not levels:
        levels = [universe.sparkSession.createDataFrame([], "shard int, level struct<number:int,probes:int,bits:binary>")]
    every = levels[0]
    for level in levels[1:]:
        every = every.unionByName(level)
    # One row a level, of which a shard has few.
    found = written(every.groupBy("shard").agg(F.array_sort(F.collect_list("level")).alias("levels")), "filters")
    dropped(placed, *alive.values())
    return found, shards


def listed_among(rows: DataFrame, key: Column, universe: DataFrame, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """``rows`` with ``listed``: whether their key is. Every key must be in ``universe`` (key, listed) once."""
    filters, shards = build(universe, shard_keys)
    copies = filters.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    copies = copies.withColumnRenamed("shard", "_shard").withColumnRenamed("levels", "_levels")
    dealt = rows.withColumns({"_shard": shard_of(key, shards), "_salt": (F.rand(1) * SALTS).cast("int")})
    met = dealt.join(copies, ["_shard", "_salt"], "left")
    listed = F.coalesce(contains(key, F.col("_levels")), F.lit(False))
    return met.withColumn("listed", listed).drop("_shard", "_salt", "_levels")


def address(url: Column) -> Column:
    """Host and path, the list's key."""
    return F.concat(url_part(url, 1), url_part(url, 2))


def plain_http_addresses(pages: DataFrame) -> DataFrame:
    """(key, listed) for every address: listed if no page has it over https."""
    secure = F.coalesce(F.col("url").startswith("https://"), F.lit(False))
    return (
        pages.select(address(F.col("url")).alias("key"), secure.alias("secure"))
        .groupBy("key")
        .agg((~F.max("secure")).alias("listed"))
    )


def judge(pages: DataFrame, universe: DataFrame, rules=RULES, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """page_id, host, path, rule, verdict and listed of every page.

    ``universe`` (key, listed) must hold every address of ``pages`` once.
    """
    universe = written(universe, "addresses")
    parts = pages.select(
        "page_id", url_part(F.col("url"), 1).alias("host"), url_part(F.col("url"), 2).alias("path")
    )
    judged = listed_among(parts, F.concat("host", "path"), universe, shard_keys)
    rule, verdict = F.lit(None).cast("string"), F.when(F.col("listed"), "block").otherwise("allow")
    for what, host, path in sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]))):
        fits = (F.col("host") == host) | F.col("host").endswith(f".{host}")
        fits &= F.col("path").startswith(path)
        rule = F.when(fits, F.lit(host + path)).otherwise(rule)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return judged.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"), "listed")


def _sql(rules=RULES) -> str:
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1])))
    fits = [
        (f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')", h + p, v) for v, h, p in ordered
    ]
    rule = " ".join(f"WHEN {f} THEN '{r}'" for f, r, _ in fits)
    verdict = " ".join(f"WHEN {f} THEN '{v}'" for f, _, v in fits)
    upper, lower = string.ascii_uppercase, string.ascii_lowercase
    return f"""
WITH parts AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(url, '{PARTS}', 1), '{upper}', '{lower}'), '') AS host,
    coalesce(regexp_extract(url, '{PARTS}', 2), '') AS path,
    coalesce(starts_with(url, 'https://'), false) AS secure
  FROM pages
), addresses AS (SELECT concat(host, path) AS key, NOT bool_or(secure) AS listed FROM parts GROUP BY key)
SELECT page_id, host, path, CASE {rule} END AS rule,
  CASE {verdict} WHEN listed THEN 'block' ELSE 'allow' END AS verdict, listed
FROM parts JOIN addresses ON key = concat(host, path)"""


SQL = _sql()
