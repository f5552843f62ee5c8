"""Quality rules: counts and distances against plain versions, references against exact counts."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from samples import EXTRA, MESSY, sentence
from tidemark.llm import language_divergence as ld

COUNTS = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def counts_by_brute_force(doc_id, text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {i + k for i in range(len(w) - 4) if windows[tuple(w[i : i + 5])] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return doc_id, len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered), failed


def folded(text):
    return re.sub(r"""[.,;:!?'"()\-]""", " ", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def class_of(c):
    if re.match(r"[\x20\x09-\x0D]", c):
        return "space"
    if c < "\x80":
        for name, pattern in (("lower", "[a-z]"), ("upper", "[A-Z]"), ("digit", "[0-9]"), ("sentence", r"""[.,;:!?'"()\-]""")):
            if re.match(pattern, c):
                return name
        return "sign" if " " < c < "\x7f" else "control"
    bounds = [(0x280, "latin"), (0x380, "marks"), (0x800, "alphabets"), (0x3000, "scripts"), (0x10000, "ideographs")]
    return next((name for most, name in bounds if ord(c) < most), "astral")


def distance(counts, shares):
    """Jensen-Shannon distance of a histogram from shares, both by name."""
    total = sum(counts.values())
    if not total:
        return 1.0
    p = {k: n / total for k, n in counts.items()}

    def part(x, y):
        return sum(v * math.log2(v / ((v + y.get(k, 0)) / 2)) for k, v in x.items() if v)

    return math.sqrt(max(0.0, (part(p, shares) + part(shares, p)) / 2))


def references_by_brute_force(rows, share, least):
    out = {}
    for lang in {r[2] for r in rows if r[2] is not None}:
        texts = [r[1] or "" for r in rows if r[2] == lang]
        words = Counter(w for t in texts for w in re.findall(r"[^\x20\x09-\x0D]+", folded(t)))
        n = sum(words.values())
        if n < least or not n:
            continue
        common = {w: c / n for w, c in words.items() if c >= share * n}
        classes = Counter(class_of(c) for t in texts for c in t)
        out[lang] = {k: c / classes.total() for k, c in classes.items()}, common | {None: 1 - sum(common.values())}
    return out


def judged_by_brute_force(rows, known):
    out = []
    for i, text, lang in rows:
        base = counts_by_brute_force(i, text)
        text = text or ""
        classes, words = Counter(map(class_of, text)), re.findall(r"[^\x20\x09-\x0D]+", folded(text))
        fits, nearest = not known, None
        for of in [lang] if lang in known else known:
            shares, common = known[of]
            c, w = distance(classes, shares), distance(Counter(x if x in common else None for x in words), common)
            chars = classes.total() - classes["space"]
            fits |= (c <= ld.CLASS_LIMIT or chars < ld.LEAST_CHARS) and (w <= ld.WORD_LIMIT or len(words) < ld.LEAST_WORDS)
            nearest = min(nearest or (9, 9), (c, w), key=sum)
        out.append((*base, *(nearest or (None, None)), fits and not base[-1]))
    return out


def same(found, expected):
    def rounded(rows):
        return sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in rows), key=repr)

    assert rounded(map(tuple, found.collect())) == rounded(expected)


@pytest.fixture(scope="module")
def prose(provided):
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in provided("documents")]
    odd = [("", None), ("wort " * 9, "de"), ("a b c d e " * 2, "en"), ("a b c d e f " * 2 + "x\n" * 30, "xx"), ("# $ <b>&amp;</b> | \n\n \n|", None)]
    return rows + [(900 + k, *x) for k, x in enumerate(odd)] + [(None, rows[3][1], None), rows[4], (rows[4][0], rows[5][1], "fr")]


def test_counts_distances_and_verdicts_equal_brute_force(spark, prose):
    docs = spark.createDataFrame(prose, "doc_id long, text string, lang string").repartition(4)
    known = ld.references(docs, least=2000)
    plain = references_by_brute_force(prose, ld.SHARE, 2000)
    assert set(known) == set(plain) and len(known) > 1
    for lang, (classes, common) in plain.items():
        r = known[lang]
        assert dict(zip(ld.CLASSES, r.classes.tolist(), strict=True)) == pytest.approx({c: 0 for c in ld.CLASSES} | classes)
        assert dict(zip([*r.words, None], r.shares.tolist(), strict=True)) == pytest.approx(common)
    expected = judged_by_brute_force(prose, plain)
    assert {r[-1] for r in expected} == {True, False}
    same(ld.judged(docs, known), expected)


def test_messy_rows_and_nothing(spark, messy, nothing):
    assert ld.references(messy) .keys() == references_by_brute_force(MESSY, ld.SHARE, ld.REFERENCE).keys()
    plain = references_by_brute_force(MESSY, 0.01, 1)
    same(ld.judged(messy, ld.references(messy, 0.01, least=1)), judged_by_brute_force(MESSY, plain))
    same(ld.judged(messy, {}), judged_by_brute_force(MESSY, {}))
    assert ld.references(nothing) == {} and ld.judged(nothing, {}).count() == 0
    assert messy.select(EXTRA[0]).distinct().count() == 1


@pytest.mark.parametrize("seed", range(4))
def test_repeated_windows_and_lines(seed):
    picks = random.Random(seed)
    texts = []
    for _ in range(60):
        words = [picks.choice("ab" if picks.random() < 0.5 else "abcdefgh") for _ in range(picks.randrange(40))]
        texts.append("".join(w + picks.choice([" ", "\n", "\n\n", "\t", " \r", "\x0b", " "]) for w in words))
    data = "".join(texts).encode()
    offsets = np.cumsum([0, *(len(t.encode()) for t in texts)])
    facts, _ = ld._facts(np.frombuffer(data, np.uint8), offsets)
    found = list(zip(*(x.tolist() for x in facts.values()), strict=True))
    assert found == [counts_by_brute_force(None, t)[1:] for t in texts]


def test_a_long_text_and_rare_signs(spark):
    long = sentence(3, 250_000) + " " + sentence(3, 30) + "\nline\nline\n"
    rows = [(1, long, "en"), (2, "ɐ é ß ж 中 😀 \x00\x7f ͡a ก " * 30, "en"), (3, "x" * 3_000_000, "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    same(ld.judged(docs, {}).select(*COUNTS), [counts_by_brute_force(i, t) for i, t, _ in rows])
    plain = references_by_brute_force(rows, ld.SHARE, 1)
    same(ld.judged(docs, ld.references(docs, least=1)), judged_by_brute_force(rows, plain))


def test_common_words_that_few_blocks_name(spark):
    """A word just above the share everywhere, one only in some tasks, and one just below."""
    rows = []
    for k in range(40):
        w = [f"u{k}x{i}" for i in range(1000)]
        w[:6] = ["even"] * 6
        w[6:10] = ["under"] * 4
        if k < 10:
            w[10:40] = ["lumpy"] * 30
        rows.append((k, " ".join(w), "en"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(20)
    assert ld.references(docs)["en"].words == ["even", "lumpy"]
    few = ld.references(docs.withColumn("lang", F.when(F.col("doc_id") < 30, "en").otherwise("de")), languages=1, least=1)
    assert list(few) == ["en"]
