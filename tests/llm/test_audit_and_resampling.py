"""Survival audit and importance resampling against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter
from itertools import permutations
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from samples import EXTRA, MESSY, sentence
from tidemark.llm import importance_resampling, survival_audit

FILTERS = "ABCDE"


# --- survival audit ------------------------------------------------------------------------


def failed(rows):
    """The filters that each (doc_id, text, lang) fails."""
    out = []
    for i, text, _ in rows:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        bad = {
            "A": len(w) < 200,
            "B": 100 * len(set(w)) < 50 * len(w),
            "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
            "D": bool(re.search("[#$%&*|]", t)),
            "E": i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in rows),
        }
        out.append({k for k, v in bad.items() if v})
    return out


def audit_by_brute_force(rows, labels):
    bad = failed(rows)
    marks = [
        tuple(any(j == i and i is not None and marks[k] == 1 for j, *marks in labels) for k in (0, 1)) for i, _, _ in rows
    ]
    out = []
    for part in {lang or "" for _, _, lang in rows}:
        inside = [(b, m) for b, m, r in zip(bad, marks, rows, strict=True) if (r[2] or "") == part]
        shapley = Counter()
        steps = []
        for order in permutations(FILTERS):
            alive = inside
            for step, f in enumerate(order, 1):
                gone = [x for x in alive if f in x[0]]
                alive = [x for x in alive if f not in x[0]]
                shapley[f] += len(gone)
                fails = sum(f in b for b, _ in inside)
                unique = sum(b == {f} for b, _ in inside)
                lost = [sum(m[k] for _, m in gone) for k in (0, 1)]
                steps.append(("".join(order), step, len(alive), len(gone), fails - len(gone), unique, *lost, f))
        out += [(part, *s[:-1], shapley[s[-1]]) for s in steps]
    return sorted(out, key=repr)


NAMES = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def marked(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("part", F.lit("extra"))


def oddities(seed, n=150):
    picks = random.Random(seed)
    out = []
    for i in range(n):
        w = sentence(picks.randrange(40), picks.choice([0, 1, 150, 199, 200, 201, 260])).split()
        if picks.random() < 0.3:
            w = (w[:20] * 20)[: len(w)]
        if picks.random() < 0.3:
            w = [x.upper() for x in w]
        if picks.random() < 0.2:
            w.append(picks.choice("#$%&*|"))
        doc_id = None if picks.random() < 0.05 else picks.randrange(100)
        out.append((doc_id, picks.choice([" ".join(w), None, ""]) if picks.random() < 0.1 else " ".join(w), picks.choice(["en", "de", None, ""])))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_the_audit_equals_brute_force(spark, rows, seed):
    texts = oddities(seed)
    picks = random.Random(seed)
    labels = [(picks.choice([None, *range(100)]), picks.choice([0, 1, None]), picks.choice([0, 1, None])) for _ in range(120)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string").repartition(4)
    found = survival_audit.audit(docs, marked(spark, labels))
    assert rows(found, *NAMES) == audit_by_brute_force(texts, labels)


def test_the_audit_of_messy_rows_and_of_nothing(spark, messy, nothing, rows):
    labels = [(7, 1, 0), (4, 1, 1), (4, 0, 0), (None, 1, 1), (99, 1, 1)]
    found = survival_audit.audit(messy, marked(spark, labels))
    assert rows(found, *NAMES) == audit_by_brute_force(MESSY, labels)
    assert rows(survival_audit.audit(messy, marked(spark, [])), *NAMES) == audit_by_brute_force(MESSY, [])
    assert rows(survival_audit.audit(nothing, marked(spark, labels))) == []


def test_counts_beyond_the_groups_of_a_task_and_a_hot_group_of_copies(spark, rows, monkeypatch):
    monkeypatch.setattr(survival_audit, "GROUPS", 3)
    texts = [(i, "the same text", f"p{i % 7}") for i in range(900)]
    run = survival_audit._survivors(5)
    import pyarrow as pa

    def batch(part):
        n = len(part)
        return pa.RecordBatch.from_arrays(
            [pa.array(part), pa.array([True] * n), pa.array([False] * n), pa.array([1] * n, pa.int32())],
            names=["part", "good", "toxic", "failed"],
        )

    out = list(run(batch([f"p{k}"] * 5 + ["p0"]) for k in range(9)))
    assert len(out) > 1
    total = sum(x[0] for b in out for x in b.column(3).to_pylist())
    assert total == 54
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string").repartition(8)
    assert rows(survival_audit.audit(docs, marked(spark, [])), *NAMES) == audit_by_brute_force(texts, [])


def test_survival_words_and_carry_save_counts():
    words = survival_audit.survival_words(5)
    for failing in range(32):
        assert [bool(int(words[failing]) >> s & 1) for s in range(32)] == [s & failing == 0 for s in range(32)]
    draw = np.random.default_rng(3)
    for n in (0, 1, 2, 3, 4, 7, 1000, 65_537):
        some = draw.integers(0, 1 << 32, n, dtype=np.uint32)
        plain = [int((some >> np.uint32(s) & np.uint32(1)).sum()) for s in range(32)]
        assert survival_audit.positional_popcounts(some).tolist() == plain


def test_fewer_filters_have_their_own_orders(spark, rows):
    docs = spark.createDataFrame([("p", True, False, 1), ("p", False, False, 3), ("p", False, True, 5)], "part string, good boolean, toxic boolean, n int")
    found = survival_audit.interactions(docs, {"X": F.col("n") > 2, "Y": F.col("n") > 4})
    assert rows(found, "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "shapley") == [
        ("XY", 1, 1, 2, 0, 1, 3), ("XY", 2, 1, 0, 1, 0, 1), ("YX", 1, 2, 1, 0, 0, 1), ("YX", 2, 1, 1, 1, 1, 3),
    ]
    with pytest.raises(ValueError):
        survival_audit.interactions(docs, {x: F.lit(True) for x in "UVWXYZ"})


# --- importance resampling -----------------------------------------------------------------


def words_of(text):
    folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded)


def runs(text, longest=1):
    w = words_of(text)
    return [" ".join(w[i : i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1)]


def resampled_by_brute_force(texts, target, longest=1, buckets=10_000, percent=10, least=20):
    def bucket(run):
        return crc32(run.encode()) % buckets

    s = Counter(bucket(r) for _, t in texts for r in runs(t, longest))
    t_ = Counter(bucket(r) for t in target for r in runs(t, longest))
    all_s, all_t = sum(s.values()), sum(t_.values())
    out = []
    for i, text in texts:
        found = [bucket(r) for r in runs(text, longest)]
        gain = [math.floor(1000 * math.log((t_[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in found]
        weight = sum(gain) // len(gain) if gain else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((i, len(found), weight, score, len(words_of(text))))
    fit = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, -r[2], -r[1]))
    ranks = {}
    for k, r in enumerate(fit[: percent * len(fit) // 100], 1):
        ranks.setdefault(r, []).append(k)
    return sorted(((*r[:4], ranks[r].pop(0) if ranks.get(r) else None) for r in out), key=repr)


@pytest.mark.parametrize("longest, buckets, percent", [(1, 10_000, 10), (3, 97, 35)])
def test_resampling_equals_brute_force(spark, rows, provided, longest, buckets, percent):
    texts = [(r["doc_id"], r["text"]) for r in provided("documents")]
    texts += [texts[3], texts[3], (None, texts[5][1]), (-4, texts[8][1]), (-4, texts[9][1])]
    target = [r["text"] for r in provided("benchmark")]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    bench = spark.createDataFrame([(t,) for t in target], "text string").repartition(2)
    found = importance_resampling.resampled(docs, bench, longest, buckets, percent)
    assert rows(found) == resampled_by_brute_force(texts, target, longest, buckets, percent)


def test_resampling_of_messy_rows_and_of_nothing(spark, messy, nothing, rows):
    texts = [(i, t) for i, t, _ in MESSY]
    target = spark.createDataFrame([("w1 w2 Wörd",), (None,), ("",)], "text string")
    found = importance_resampling.resampled(messy, target, percent=60)
    assert rows(found) == resampled_by_brute_force(texts, ["w1 w2 Wörd", None, ""], percent=60)
    empty = spark.createDataFrame([], "text string")
    assert rows(importance_resampling.resampled(messy, empty)) == resampled_by_brute_force(texts, [])
    assert rows(importance_resampling.resampled(nothing, target)) == []
    kept = importance_resampling.drawn(messy, target, percent=60)
    ids = {r[0] for r in resampled_by_brute_force(texts, ["w1 w2 Wörd", None, ""], percent=60) if r[4]}
    assert kept.columns == messy.columns and {r["doc_id"] for r in kept.collect()} == ids and ids
    assert rows(kept.select(EXTRA[0]).distinct()) == [("extra id",)]


@pytest.mark.parametrize("piece", [1, 2, 3, 7, 64])
def test_words_are_never_cut_by_pieces(piece):
    picks = random.Random(piece)
    for _ in range(200):
        text = "".join(picks.choice("aB9é \n-_.") for _ in range(picks.randrange(60))).encode()
        found = [w for words in importance_resampling.split(text, piece) for w in words]
        assert [w.decode() for w in found] == words_of(text.decode())


def test_runs_go_on_from_piece_to_piece(monkeypatch):
    monkeypatch.setattr(importance_resampling, "PIECE", 9)
    text = "One two-three FOUR five, " * 9
    monkeypatch.setattr(importance_resampling.split, "__defaults__", (9,))
    found = [b for _, buckets in importance_resampling.features(text.encode(), 3, 1 << 31) for b in buckets]
    assert sorted(found) == sorted(crc32(r.encode()) % (1 << 31) for r in runs(text, 3))


def test_a_text_of_one_long_word(spark, rows):
    texts = [(1, "x" * 3_000_000), (2, "y " * 700_000)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    assert rows(importance_resampling.resampled(docs, docs.limit(0))) == resampled_by_brute_force(texts, [])


def test_equal_scores_go_to_smaller_ids_over_many_partitions(spark, rows):
    scored = spark.createDataFrame([(i, 30, 30, 0, i % 3) for i in range(200)], "doc_id long, n_words long, n_features long, weight long, score long")
    found = importance_resampling.ranked(scored.repartition(7), 50, 20).where("rank is not null")
    expected = sorted(range(200), key=lambda i: (-(i % 3), i))[:100]
    assert rows(found, "rank", "doc_id") == sorted(((k, i) for k, i in enumerate(expected, 1)), key=repr)
