"""Scoring, classifiers, filters and files: brute force, round trips and held-out accuracy."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from samples import MESSY
from tokenizers import Tokenizer

from tidemark.llm import arrow_sequences, language_id, packing, pu_quality, suffix_tree, url_cascade
from tidemark.llm.common import BYTE_VALUES, scratch_path
from tidemark.llm.queries import ORACLE, REGISTRY, vocabulary

FOLDER = "/root/testdata/sf0.001"
BYTES, WORDS = vocabulary("byte_bpe_50k.json"), vocabulary("word_bpe_49k.json")


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


# --- scoring ------------------------------------------------------------------------------


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def test_base_scores_and_counts_equal_brute_force(spark, messy, rows):
    train = F.coalesce(F.col("doc_id") != 9, F.lit(True))
    found = suffix_tree.scored(messy, train)
    counts, texts = Counter(), 0
    for i, t, _ in MESSY:
        if i != 9:
            counts.update(split(t))
            texts += 1
    n, v = sum(counts.values()) + texts, len(counts) + 1

    def base(c):
        return math.log10((c + 0.1) / (n + 0.1 * (v + 1)))

    expected = [
        (i, len(split(t)) + 1, sum(counts[w] > 0 for w in split(t)) + 1, n, sum(base(counts[w]) for w in split(t)) + base(texts))
        for i, t, _ in MESSY
    ]
    got = rows(found, "doc_id", "n_tokens", "n_known", "train_tokens", "base_score")
    assert [r[:4] for r in got] == [r[:4] for r in sorted(expected, key=repr)]
    assert all(math.isclose(a[4], b[4], rel_tol=1e-9) for a, b in zip(got, sorted(expected, key=repr)))


def test_scores_without_training_texts_or_rows(messy, nothing):
    found = suffix_tree.scored(messy, F.lit(False))
    assert found.count() == len(MESSY) and found.where("score <> 0 OR n_known <> 0").isEmpty()
    assert suffix_tree.scored(nothing, F.lit(True)).count() == 0


def test_states_diverge_sum_to_one_and_score_better(spark):
    """A source whose next word depends on the last two, hidden in noise."""
    random = np.random.default_rng(2)
    texts = []
    for _ in range(400):
        w = ["a", "b"]
        for _ in range(60):
            fixed = {("a", "b"): "c", ("b", "c"): "a"}.get((w[-2], w[-1]))
            w.append(fixed if fixed and random.random() < 0.9 else random.choice(list("abcdef")))
        texts.append(" ".join(w))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    train = docs.where("doc_id % 10 <> 0").select("text")
    _, root = suffix_tree.vocabulary(train)
    tree = suffix_tree.grow(train, root)
    assert len(tree.two) > 0 and not np.isnan(tree.one).all()
    logs = root.logs()
    symbols = np.arange(suffix_tree.END, suffix_tree.FIRST + len(root.hashes), dtype=np.uint64)
    for a in symbols:
        for b in symbols[symbols > suffix_tree.RARE]:
            p = 10 ** tree.score(logs, np.full_like(symbols, a), np.full_like(symbols, b), symbols)
            assert p.sum() == pytest.approx(1, abs=1e-6)
    held = suffix_tree.scored(docs, F.col("doc_id") % 10 != 0).where("doc_id % 10 = 0")
    assert held.where("score <= base_score").isEmpty()


def brute_scores(texts, train):
    """Every context of one and two tokens, tested and smoothed by the docstring, in plain Python."""
    grams, tokens = [Counter(), Counter(), Counter()], []
    for t, own in zip(texts, train, strict=True):
        x = [*split(t), 1]
        tokens.append(x)
        if own:
            grams[0].update(x)
            grams[1].update(zip([0, *x[:-1]], x, strict=True))
            grams[2].update(zip([0, *x[:-2]], x[:-1], x[1:], strict=False))
    n, once = sum(grams[0].values()), Counter(v for k, v in grams[0].items() if k != 1)
    d = min(0.9, max(0.1, once[1] / max(1, once[1] + 2 * once[2])))
    total = dict(grams[0]) | {0: sum(train)}

    def root(w):
        return math.log10((grams[0][w] - d) / n) if grams[0][w] else math.log10(d * len(grams[0]) / n)

    def grown(counts, totals, above):
        named = {}
        for k, c in counts.items():
            if c >= suffix_tree.LEAST:
                named.setdefault(k[:-1], {})[k[-1]] = c
        found = {}
        for ctx, follow in named.items():
            m = totals(ctx)
            p = {w: (c - 0.5) / m for w, c in follow.items()}
            up = {w: above(ctx, w) for w in follow}
            weight = math.log10(max(1 - sum(p.values()), 1e-12) / (1 - min(sum(10**x for x in up.values()), 1 - 1e-9)))
            gain = sum(c * (math.log10(p[w]) - up[w]) for w, c in follow.items()) + (m - sum(follow.values())) * weight
            if gain * math.log(10) > 0.5 * (len(follow) + 1) * math.log(m):
                found[ctx] = (weight, {w: math.log10(x) for w, x in p.items()})
        return found

    def scored(table, ctx, w, otherwise):
        if ctx not in table:
            return otherwise
        weight, named = table[ctx]
        return named.get(w, weight + otherwise)

    one = grown(grams[1], lambda ctx: total[ctx[0]], lambda ctx, w: root(w))
    two = grown(grams[2], lambda ctx: grams[1][ctx], lambda ctx, w: scored(one, ctx[1:], w, root(w)))
    return [
        sum(
            scored(two, (a, b) if i else None, w, scored(one, (b,), w, root(w)))
            for i, (a, b, w) in enumerate(zip([0, 0, *x[:-2]] if len(x) > 1 else [0], [0, *x[:-1]], x, strict=False))
        )
        for x in tokens
    ], len(one), len(two)


def test_scores_equal_brute_force_with_no_cut_by_share(spark, monkeypatch):
    """Rare passages make states however many other tokens there are; rare keys travel in buckets."""
    monkeypatch.setattr(suffix_tree, "SYMBOLS", 64)
    monkeypatch.setattr(suffix_tree, "BUCKET", 1 << 6)
    random = np.random.default_rng(5)
    rare = "Some odd words follow one another here"
    texts = [" ".join(random.choice(list("abcdefgh"), 40)) for _ in range(60)]
    texts += [f"x{k} {rare} y{k}" for k in range(3)] * 2 + [None, "", rare, "a b unseen", rare + " a"]
    train = [k % 7 != 0 for k in range(len(texts))]
    docs = spark.createDataFrame(list(zip(range(len(texts)), texts, train, strict=True)), "doc_id long, text string, own boolean")
    expected, one, two = brute_scores(texts, train)
    got = {r["doc_id"]: r["score"] for r in suffix_tree.scored(docs.repartition(3), F.col("own")).collect()}
    assert one > 5 and two > 2
    assert all(math.isclose(got[k], x, rel_tol=1e-9) for k, x in enumerate(expected)), [(got[k], x) for k, x in enumerate(expected)][-12:]


def test_texts_meet_their_words_without_a_row_a_key(spark, monkeypatch):
    """40,000 different words: what a level writes and shuffles are runs of texts, never rows of single words."""
    made, plain = {}, suffix_tree.written
    monkeypatch.setattr(suffix_tree, "SYMBOLS", 64)

    def watched(df, name, **options):
        out = plain(df, name, **options)
        made.setdefault(name, []).append((df, out))
        return out

    monkeypatch.setattr(suffix_tree, "written", watched)
    texts = [" ".join(f"w{200 * k + i}" for i in range(200)) for k in range(200)] * 2 + [None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    found = suffix_tree.scored(docs, F.lit(True))
    assert found.agg(F.sum("n_known"), F.sum("n_tokens")).first() == (80401, 80401)
    for name in ("worth_of_words", "worth_of_pairs", "worth_of_triples"):
        frames = made[name][-2:] if name != "worth_of_words" else made[name]
        for df, out in frames:
            assert out.count() == len(texts) and "Join" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_texts_are_cut_into_words_once(spark, monkeypatch):
    """One pass reads texts; all later ones read the hashes of their words, and no row goes through Python for its key."""
    made, plain = [], suffix_tree.written

    def watched(df, name, **options):
        made.append((name, df._jdf.queryExecution().optimizedPlan().toString()))
        return plain(df, name, **options)

    monkeypatch.setattr(suffix_tree, "written", watched)
    docs = spark.createDataFrame([(i, t, i != 9) for i, t, _ in MESSY], "doc_id long, text string, own boolean")
    found = suffix_tree.scored(docs, F.col("own"))
    made.append(("scores", found._jdf.queryExecution().optimizedPlan().toString()))
    assert [name for name, plan in made if re.search(r"\btext#", plan)] == ["words_of_texts"]
    assert not any("ArrowEvalPython" in plan for _, plan in made)


def test_keys_of_columns_equal_those_of_texts(spark):
    random = np.random.default_rng(1)
    left, right = (random.integers(0, 1 << 64, 300, np.uint64) for _ in range(2))
    left[:2], right[2:4] = suffix_tree.BEGIN, suffix_tree.END
    rows = spark.createDataFrame(pa.table([left.view(np.int64), right.view(np.int64)], names=["a", "b"]))
    got = rows.select("a", "b", suffix_tree._key("a", "b").alias("key")).toArrow()
    a, b, key = (got.column(c).to_numpy().view(np.uint64) for c in ("a", "b", "key"))
    assert (suffix_tree.joined_key(a, b) == key).all() and len(np.unique(key)) == 300


def test_packed_cells_give_their_keys_back():
    random = np.random.default_rng(3)
    key = np.sort(random.integers(0, 1 << 64, 5000, np.uint64))
    parts = list(suffix_tree._cells(key, 6))
    steps = suffix_tree._planes(suffix_tree._steps(key, parts))
    cells = [suffix_tree._packed(steps, x) for _, x in parts]
    sizes = np.array([len(x) // 8 for x in cells])
    assert (suffix_tree._summed(suffix_tree._unpacked(cells, np.uint64), sizes) == key).all()
    for x in (random.normal(size=50), random.integers(0, 1 << 16, 50, np.uint16), random.integers(0, 1 << 50, 50)):
        assert (suffix_tree._unpacked([suffix_tree._packed(suffix_tree._planes(x), slice(None))], x.dtype) == x).all()


def test_a_longer_corpus_keeps_every_state(spark):
    rare = ["some odd words follow one another here"] * 4
    for more in (0, 3000):
        texts = rare + [f"a{k % 50} b{k % 31} " * 30 for k in range(more)]
        train = spark.createDataFrame([(t,) for t in texts], "text string")
        _, root = suffix_tree.vocabulary(train)
        found = suffix_tree.states(train, root)
        assert found.pairs.where("n = 4 and explicit <> 0").count() >= 7 and found.triples.where("n = 4").count() >= 6


def test_lookups_find_all_keys_and_no_others():
    random = np.random.default_rng(0)
    keys = np.unique(random.integers(0, 1 << 51, 5000).astype(np.uint64))
    asked = np.concatenate([keys, keys + np.uint64(1)])
    assert (suffix_tree.Lookup(keys)(asked) == suffix_tree.find(keys, asked)).all()
    assert (suffix_tree.Lookup(keys[:0])(asked) == -1).all()


# --- url filter ---------------------------------------------------------------------------


def universe(spark, n, every):
    return spark.range(n).select(F.concat(F.lit("host"), "id").alias("key"), (F.col("id") % every == 0).alias("listed"))


@pytest.mark.parametrize("n, every, shard_keys", [(3000, 3, 1 << 14), (3000, 100, 200), (3000, 3, 100), (50, 1, 7), (50, 1000, 7), (0, 1, 7)])
def test_the_cascade_is_exact_over_its_universe(spark, n, every, shard_keys):
    keys = universe(spark, n, every)
    found = url_cascade.listed_among(keys.withColumnRenamed("listed", "truth"), F.col("key"), keys, shard_keys)
    assert found.count() == n and found.where("listed <> truth").isEmpty()


def test_crowded_shards_take_more_levels(spark):
    """Four times as many keys as bits: every level errs often, and the cascade still comes to an end."""
    keys = universe(spark, 130_000, 2)
    filters, shards = url_cascade.build(keys, shard_keys=1 << 17)
    assert shards == 1 and len(filters.first()["levels"]) > 4
    found = url_cascade.listed_among(keys.withColumnRenamed("listed", "truth"), F.col("key"), keys, 1 << 17)
    assert found.where("listed <> truth").isEmpty()


def test_filters_stay_off_the_driver_and_pages_meet_them_by_shard(spark):
    """A universe whose filters exceed eight million bytes, with one address on a third of the pages."""
    n = 2_600_000
    keys = spark.range(n).select(F.concat(F.lit("k"), "id").alias("key"), (F.col("id") % 3 == 0).alias("listed"))
    filters, shards = url_cascade.build(keys)
    size = filters.select(F.sum(F.size("levels"))).first()[0] * url_cascade.BITS // 8
    assert shards == -(-n // url_cascade.SHARD_KEYS) and size > 1 << 20
    pages = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "k9").otherwise(F.concat(F.lit("k"), "id")).alias("key"), (F.col("id") % 3 == 0).alias("truth")
    )
    found = url_cascade.listed_among(pages, F.col("key"), keys)
    assert found.where("listed <> truth").isEmpty()
    text = found._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in text.split("\n") if "Join" in line]
    assert len(joins) == 1 and "_shard" in joins[0] and "_salt" in joins[0] and "key" not in joins[0].split("(")[1]


def test_urls_of_every_shape(spark, rows):
    urls = [
        None, "", "no scheme", "http://", "http://ORG/x", "https://a.Example.org/es/x?q", "https://example.org/en/12",
        "https://example.org/en/2#f", "http://notexample.org/es/", "ftp://x.com/fr/a://b", "http://x.com/de", "http://x.com?a=/fr/",
        "http://x.com/de/#", "http://É.com/de/\nx", "http://x.com/de/#",
    ]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("key", F.lit(1))
    found = url_cascade.judge(pages, url_cascade.plain_http_addresses(pages))
    got = {r["page_id"]: tuple(r)[1:] for r in found.collect()}
    assert got[0] == got[1] == got[2] == got[3] == ("", "", None, "block", True)
    assert got[4] == ("org", "/x", "org/", "allow", True)
    assert got[5][:4] == ("a.example.org", "/es/x", "example.org/es/", "block")
    assert got[6][2:4] == ("example.org/en/1", "block") and got[7][2:4] == ("org/", "allow")
    assert got[8][2] == "org/" and got[9][:4] == ("x.com", "/fr/a://b", "com/fr/", "allow")
    assert got[10][2] is None and got[11][:3] == ("x.com", "", None) and got[12] == got[14]
    assert got[13][:4] == ("É.com", "/de/\nx", "com/de/", "block")
    assert url_cascade.judge(pages.limit(0), url_cascade.plain_http_addresses(pages.limit(0))).count() == 0


# --- token files and packing --------------------------------------------------------------


def encoded(path, text):
    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids + [2]


def test_sequences_round_trip_through_their_files(spark, provided):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    manifest = arrow_sequences.write_sequences(docs, scratch_path(spark, "test"), BYTES, length=64, rows=4)
    found = sorted(tuple(r) for r in arrow_sequences.read_documents(spark, manifest).collect())
    whole = Tokenizer.from_file(BYTES)
    expected, flat = [], []
    for r in sorted(provided("documents"), key=lambda r: r["doc_id"]):
        ids = whole.encode(r["text"], add_special_tokens=False).ids + [2]
        expected.append((r["doc_id"], len(flat), len(ids), crc(ids)))
        flat += ids
    assert found == expected
    shard, _, n, first = manifest[0]
    reader = arrow_sequences.ShardReader(shard)
    assert reader.file.schema.field("ids").type == pa.list_(pa.uint16(), 64)
    ids, mask = reader.sequence(5)
    assert ids.tolist() == flat[5 * 64 : 6 * 64] and mask.all() and ids.base is not None
    last = -(-n // 64) - 1
    ids, mask = reader.sequence(last)
    assert mask.sum() == n - 64 * last and ids[mask].tolist() == flat[64 * last : n] and not ids[~mask].any()


def test_sequences_of_messy_rows(messy, nothing, rows):
    found = rows(arrow_sequences.sequences_of(messy, BYTES))
    by_id = sorted(((-1 if i is None else i), t is not None, t or "") for i, t, _ in MESSY)
    starts = {}
    for i, _, t in by_id:
        ids = encoded(BYTES, t)
        starts.setdefault(None if i < 0 else i, []).append((len(ids), crc(ids)))
    assert sorted((r[0] is not None, r[0], r[2], r[3]) for r in found if r[0] is not None) == sorted(
        (True, i, *x) for i, xs in starts.items() if i is not None for x in xs
    )
    ordered = sorted(found, key=lambda r: r[1])
    assert [r[1] for r in ordered] == [sum(x[2] for x in ordered[:k]) for k in range(len(ordered))]
    assert [-1 if r[0] is None else r[0] for r in ordered] == sorted(-1 if i is None else i for i, _, _ in MESSY)
    assert rows(arrow_sequences.sequences_of(nothing, BYTES)) == []


def test_pieces_are_powers_of_two_that_make_up_each_document(messy, nothing):
    found = packing.pack(messy, WORDS).collect()
    assert len({r["sequence_id"] for r in found}) == len(found)
    assert all(r["length"] == 1 << r["bucket"] <= 4096 and r["offset"] == 0 == r["length"] - len(r["ids"]) for r in found)
    assert all(r["ids_crc32"] == crc(r["ids"]) for r in found)
    got, ids = [], []
    for r in sorted(found, key=lambda r: r["sequence_id"]):
        assert r["start"] == len(ids)
        ids += r["ids"]
        if len(ids) == r["doc_tokens"]:
            got.append((r["doc_id"], tuple(ids)))
            ids = []
    assert sorted(got, key=repr) == sorted(((i, tuple(encoded(WORDS, t))) for i, t, _ in MESSY), key=repr)
    assert packing.pack(nothing, WORDS).count() == 0
    assert packing.lengths(4096 * 2 + 5) == [4096, 4096, 4, 1] and packing.lengths(0) == []


def test_buckets_hold_one_length_each(spark, messy):
    path = scratch_path(spark, "buckets")
    packing.write_buckets(packing.pack(messy, WORDS), path)
    back = spark.read.parquet(path)
    assert back.where("size(ids) <> shiftleft(1, bucket)").isEmpty() and back.count() == packing.pack(messy, WORDS).count()


# --- classifiers --------------------------------------------------------------------------


def test_languages_of_held_out_documents(spark, provided):
    found = {r["doc_id"]: r for r in REGISTRY["op5_language_id"](spark, FOLDER.replace("0.001", "0.01")).collect()}
    docs = pq.read_table(FOLDER.replace("0.001", "0.01") + "/documents.parquet").to_pylist()
    held = [r for r in docs if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert all(found[r["doc_id"]]["held_out"] for r in held)
    assert np.mean([found[r["doc_id"]]["lang_pred"] == r["lang"] for r in held]) > 0.98
    assert np.mean([r["rejected"] for r in found.values()]) < 0.005
    assert all(0 <= r["score"] <= 1 for r in found.values())


def test_training_texts_are_views_of_four_bytes_a_bucket_on_the_driver(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"text {i} " * (i + 1), "xy"[i % 2]) for i in range(20)], "doc_id long, text string, lang string")
    seen = []
    monkeypatch.setattr(language_id, "train", lambda bags, languages: seen.append((bags, languages)))
    language_id.learn(docs, F.col("doc_id") >= 0)
    [(bags, languages)] = seen
    assert len(bags) == 20 and sorted(languages) == ["x"] * 10 + ["y"] * 10
    assert all(a.dtype == np.int32 and not a.flags.owndata and not b.flags.owndata for a, b in bags)


def test_languages_of_messy_rows(spark, messy, nothing):
    model = language_id.learn(messy, F.lit(True))
    found = language_id.identify(messy, model)
    assert set(found.columns) == set(messy.columns) | {"lang_pred", "score", "rejected"}
    for r in found.select("text", "lang_pred", "score", "rejected").collect():
        lettered = any(x.isalpha() for x in r["text"] or "")
        assert (r["lang_pred"] != "und") == lettered and (lettered or (r["score"] == 0 and r["rejected"]))
    kept = language_id.accepted(messy, model)
    assert kept.columns == messy.columns
    assert language_id.learn(nothing, F.lit(True)) is None
    nobody = language_id.identify(messy, None)
    assert nobody.where("lang_pred <> 'und' OR NOT rejected").isEmpty() and nobody.count() == len(MESSY)
    assert language_id.identify(nothing, model).count() == 0


def test_quality_of_held_out_documents(spark):
    folder = FOLDER.replace("0.001", "0.01")
    found = {r["doc_id"]: r for r in REGISTRY["op7_pu_quality"](spark, folder).collect()}
    marks = [r for r in pq.read_table(f"{folder}/labels.parquet").to_pylist() if found[r["doc_id"]]["held_out"]]
    assert np.mean([found[r["doc_id"]]["predicted"] == r["quality"] for r in marks]) > 0.93
    good = [found[r["doc_id"]]["score"] for r in marks if r["quality"] == 1]
    bad = [found[r["doc_id"]]["score"] for r in marks if r["quality"] == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.95


def test_quality_of_messy_rows(spark, messy, nothing):
    labels = spark.createDataFrame([(7, 1), (3, 1), (3, 0), (16, 0), (None, 1), (5, None)], "doc_id long, quality int")
    found = pu_quality.scored(messy, pu_quality.learn(messy, labels, F.lit(True)))
    assert found.count() == len(MESSY) and found.where("NOT score BETWEEN 0 AND 1").isEmpty()
    assert found.where("doc_id IN (11, 12) AND score <> 0").isEmpty()
    assert pu_quality.learn(messy, labels.limit(0), F.lit(True)) is None
    assert pu_quality.scored(messy, None).where("score <> 0").isEmpty()
    assert pu_quality.scored(nothing, None).count() == 0


def test_the_risk_is_kept_from_going_below_zero():
    """Positives that also make up most of the unlabelled are told from the rest."""
    random = np.random.default_rng(1)
    good = random.normal(1, 0.5, (600, pu_quality.WIDTH)).astype(np.float32)
    bad = random.normal(-1, 0.5, (300, pu_quality.WIDTH)).astype(np.float32)
    model = pu_quality.train(good[:300], np.concatenate([good[300:], bad]), prior=0.5, epochs=40)
    assert (model.logits(good) > 0).mean() > 0.97 and (model.logits(bad) < 0).mean() > 0.97


def test_the_prior_of_planted_mixtures_is_estimated():
    random = np.random.default_rng(2)
    for prior in (0.2, 0.5, 0.85):
        for apart in (1.0, 0.7):
            n = int(4000 * prior)
            good = random.normal(apart, 0.5, (2000 + n, pu_quality.WIDTH)).astype(np.float32)
            bad = random.normal(-apart, 0.5, (4000 - n, pu_quality.WIDTH)).astype(np.float32)
            found = pu_quality.prior_of(good[:2000], np.concatenate([good[2000:], bad]))
            assert abs(found - prior) < 0.05
    assert pu_quality.prior_of(good[:3], bad) == 0.5


@pytest.mark.parametrize("prior", [0.3, 0.9])
def test_slopes_are_those_of_the_risk(prior):
    """Against differences of the risk, written out text by text."""
    random = np.random.default_rng(3)
    layers = [random.normal(0, 0.5, (pu_quality.WIDTH, 3)), random.normal(0, 0.5, 3), random.normal(0, 1, 3), np.array([0.2])]
    good, web = random.normal(0.4, 1, (7, pu_quality.WIDTH)), random.normal(-0.2, 1, (11, pu_quality.WIDTH))

    def logit(x):
        hidden = [np.tanh(sum(x[k] * layers[0][k][j] for k in range(len(x))) + layers[1][j]) for j in range(3)]
        return sum(h * w for h, w in zip(hidden, layers[2], strict=True)) + layers[3][0]

    def parts():
        p, u = [logit(x) for x in good], [logit(x) for x in web]
        as_good = prior * sum(np.log(1 + np.exp(-z)) for z in p) / len(p)
        as_bad = sum(np.log(1 + np.exp(z)) for z in u) / len(u) - prior * sum(np.log(1 + np.exp(z)) for z in p) / len(p)
        return as_good, as_bad

    negative = parts()[1] < 0
    found = pu_quality.slopes(layers, good, web, prior)
    for layer, slope in zip(layers, found, strict=True):
        for place in [np.unravel_index(k, layer.shape) for k in range(0, layer.size, 5)]:
            values = []
            for d in (1e-5, -1e-5):
                layer[place] += d
                as_good, as_bad = parts()
                values.append(-as_bad if negative else as_good + as_bad)
                layer[place] -= d
            assert slope[place] == pytest.approx((values[0] - values[1]) / 2e-5, abs=1e-6)


def test_scores_are_means_over_subwords():
    """Language scores against n-grams that are hashed and looked up one by one."""
    random = np.random.default_rng(4)
    bits = 8
    model = language_id.Model(["a", "b", "c"], random.normal(0, 1, (3, 1 << bits)), random.normal(0, 1, 3), bits, 1.7)
    texts = ["Plain text\tof  words", "", "É\n\nü x", "ab", "A", "  lead and trail  "]
    top = (1 << 64) - 1
    for text, found in zip(texts, model.score(pa.array(texts)), strict=True):
        data = re.sub(rb"[\x20\x09-\x0D]+", b" ", re.sub(rb"[A-Z]", lambda m: m[0].lower(), text.encode()))
        values = [0x9E3779B97F4A7C15 if x == 32 else int(BYTE_VALUES[True][x]) for x in data]
        rows = []
        for n in language_id.SIZES:
            for i in range(len(values) - n + 1):
                code = values[i]
                for v in values[i + 1 : i + n]:
                    code = (code * 0x2545F4914F6CDD1D + v) & top
                rows.append(model.logits[:, code >> (64 - bits)])
        z = (sum(rows) / max(1, len(rows)) + model.bias) * 1.7
        p = np.exp(z - z.max())
        assert found == pytest.approx(p / p.sum())


# --- queries and pipeline -----------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_equal_their_sql(spark, name):
    import duckdb

    db = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "labels"):
        db.sql(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    expected = db.sql(ORACLE[name])
    found = REGISTRY[name](spark, FOLDER).select(*expected.columns)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected.fetchall(), key=repr)


def test_there_is_a_query_for_each_operator():
    assert {name.split("_")[0] for name in REGISTRY} == {f"op{n}" for n in range(1, 14)}
