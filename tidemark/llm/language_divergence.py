"""Quality rules by divergence from language references.

A document's histograms of character classes and of common words are compared with those of its language by
the Jensen-Shannon distance (base 2, from 0 to 1). A document is kept if neither is further off than its limit;
text of too few characters or words to have a shape is not judged by that histogram. Documents of no language, or of
one without a reference, are kept if any language accepts them. Plain counts of words, symbols, repeated
lines and repeated windows come with the verdict; a document that fails them is never kept.

Common words of a language are those with at least ``SHARE`` of all its words, after A-Z are lower-cased and sentence
punctuation is blanked. They are found exactly in two passes. Every block of text names the words with half of
that share within the block, so a word left unnamed in a block has less than half of it there; words whose
named counts come to less than half of the share of all words cannot reach it, and at most ``2 / SHARE`` a language
can. The second pass counts these, and the characters, over all text. References are the sums over all documents of a
language: ``LANGUAGES`` languages at most, those of the most words, each with at least ``REFERENCE`` words, so that
their size is bounded however much text there is. Only they pass through the driver. The third pass judges.

No text is shuffled. Null and empty texts have no words and fail. Repeated rows are judged alike, and null ids as any
others. Empty tables are empty. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.common import blocks

#: Share of a language's words that makes a word common; languages with a reference; words that a reference needs.
SHARE, LANGUAGES, REFERENCE = 1 / 200, 1000, 5000
#: Greatest distances of a kept document, and the characters and words from which a histogram counts.
CLASS_LIMIT, WORD_LIMIT = 0.25, 0.4
LEAST_CHARS, LEAST_WORDS = 200, 40
WINDOW = 5

SPACES = {0x20, *range(0x09, 0x0E)}
SYMBOLS = set(b"#*$%&|<>")
SENTENCE = set(b".,;:!?'\"()-")
CLASSES = ["lower", "upper", "digit", "space", "sentence", "sign", "control", "latin", "marks", "alphabets", "scripts", "ideographs", "astral"]


def _class(byte: int) -> int | None:
    """Class of the character that begins with this byte; continuation bytes have none."""
    if 0x61 <= byte <= 0x7A:
        return 0
    if 0x41 <= byte <= 0x5A:
        return 1
    if 0x30 <= byte <= 0x39:
        return 2
    if byte in SPACES:
        return 3
    if byte in SENTENCE:
        return 4
    if byte < 0x80:
        return 6 if byte < 0x20 or byte == 0x7F else 5
    if byte < 0xC0:
        return None
    starts = [0xCA, 0xCE, 0xE0, 0xE3, 0xF0]
    return 7 + sum(byte >= x for x in starts)


#: A byte histogram times this: characters by class.
BY_CLASS = np.array([[_class(b) == c for c in range(len(CLASSES))] for b in range(256)], np.int64)
_IN_WORDS = BY_CLASS.sum(axis=1) - BY_CLASS[:, CLASSES.index("space")]
_IS_SYMBOL = np.array([b in SYMBOLS for b in range(256)], np.int64)
_FOLDED = np.array([0x20 if b in SENTENCE else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], np.uint8)


def _texts(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.large_string(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The text of every word, and the words."""
    lists = pc.ascii_split_whitespace(texts)
    flat = lists.flatten()
    full = pc.greater(pc.binary_length(flat), 0)
    return pc.list_parent_indices(lists).filter(full).to_numpy(), flat.filter(full)


def _histograms(data: np.ndarray, offsets: np.ndarray, piece: int = 1 << 20) -> np.ndarray:
    """Bytes by value, of each text."""
    out = np.zeros((len(offsets) - 1, 256), np.int64)
    for t, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        for i in range(a, b, piece):
            out[t] += np.bincount(data[i : min(b, i + piece)], minlength=256)
    return out


def _ranks(*keys: np.ndarray) -> np.ndarray:
    """Numbers from 0 that are equal where all keys are."""
    out = keys[0]
    for key in keys[1:]:
        out = out.astype(np.int64) * (int(key.max(initial=0)) + 1) + key
        out = pd.factorize(out)[0]
    return out


def _repeat_words(parent: np.ndarray, word: np.ndarray, n: int) -> np.ndarray:
    """Words of each text within windows that the text has twice or more."""
    if len(word) < WINDOW:
        return np.zeros(n, np.int64)
    code = _ranks(parent, word)
    two = _ranks(code[:-1], code[1:])
    four = _ranks(two[:-2], two[2:])
    window = _ranks(four[: len(code) - 4], code[4:])
    inside = parent[: len(window)] == parent[WINDOW - 1 :]
    again = (np.bincount(window[inside], minlength=len(window))[window] > 1) & inside
    marks = np.zeros(len(code) + 1, np.int64)
    marks[: len(again)] += again
    marks[WINDOW : WINDOW + len(again)] -= again
    return np.bincount(parent[np.cumsum(marks[:-1]) > 0], minlength=n)


def _dup_lines(texts: pa.Array) -> np.ndarray:
    """Lines with a word that equal an earlier line of their text."""
    lists = pc.split_pattern(texts, "\n")
    flat, parent = lists.flatten(), pc.list_parent_indices(lists)
    full = pc.greater(pc.binary_length(pc.ascii_trim_whitespace(flat)), 0)
    line, parent = flat.filter(full).dictionary_encode().indices.to_numpy(), parent.filter(full).to_numpy()
    later = pd.DataFrame({"parent": parent, "line": line}).duplicated().to_numpy()
    return np.bincount(parent[later], minlength=len(texts))


def _facts(data: np.ndarray, offsets: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Plain counts of each text of a block, and its characters by class."""
    texts, n, counts = _texts(data, offsets), len(offsets) - 1, _histograms(data, offsets)
    parent, words = _words(texts)
    n_words = np.bincount(parent, minlength=n)
    repeated = _repeat_words(parent, words.dictionary_encode().indices.to_numpy(), n)
    return {
        "n_words": n_words,
        "word_chars": counts @ _IN_WORDS,
        "n_symbols": counts @ _IS_SYMBOL,
        "n_dup_lines": _dup_lines(texts),
        "n_repeat_words": repeated,
        "base_failed": (n_words < 10) | (100 * repeated > 20 * n_words),
    }, counts @ BY_CLASS


# --- references ----------------------------------------------------------------------------


class Reference(NamedTuple):
    """Shares of character classes, the common words, and their shares, with that of all other words last."""

    classes: np.ndarray
    words: list[str]
    shares: np.ndarray


def _named(share: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang = batch.column(0).dictionary_encode()
            code = lang.indices.to_numpy()
            for i, j, data, offsets in blocks(batch.column(1), 1 << 22):
                parent, words = _words(_texts(_FOLDED[data], offsets))
                of = code[i:j][parent]
                for c in np.unique(of).tolist():
                    found = pc.value_counts(words.filter(pa.array(of == c)))
                    word, n = found.field(0), found.field(1).to_numpy()
                    often = n >= share / 2 * n.sum()
                    word = pa.concat_arrays([word.filter(pa.array(often)), pa.nulls(1, word.type)]).cast(pa.string())
                    names = pa.array([lang.dictionary[c].as_py()] * len(word), pa.string())
                    counts = pa.array([*n[often].tolist(), int(n.sum())], pa.int64())
                    yield pa.RecordBatch.from_arrays([names, word, counts], names=["lang", "word", "n"])

    return run


def _candidates(docs: DataFrame, share: float, languages: int, least: int) -> dict[str, list[str]]:
    """Words that may be common, at most ``2 / share`` of each of the languages of the most words."""
    named = docs.mapInArrow(_named(share), "lang string, word string, n long")
    # The row without a word has all words of the language.
    counts = named.groupBy("lang", "word").agg(F.sum("n").alias("n"))
    all_words = F.max(F.when(F.col("word").isNull(), F.col("n"))).over(Window.partitionBy("lang"))
    told = counts.withColumn("all", all_words).where((F.col("n") >= share / 2 * F.col("all")) & (F.col("all") >= least))
    kept = told.groupBy("lang").agg(F.max("all").alias("all"), F.collect_list("word").alias("words"))
    return {row["lang"]: sorted(row["words"]) for row in kept.orderBy(F.desc("all"), "lang").limit(languages).collect()}


def _tallied(candidates: dict[str, list[str]]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = {lang: pa.array(words, pa.large_string()) for lang, words in candidates.items()}
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            lang = batch.column(0).to_numpy(zero_copy_only=False)
            for i, j, data, offsets in blocks(batch.column(1)):
                classes = _histograms(data, offsets) @ BY_CLASS
                parent, words = _words(_texts(_FOLDED[data], offsets))
                for name in set(lang[i:j].tolist()) & set(sets):
                    own = lang[i:j] == name
                    at = pc.index_in(words.filter(pa.array(own[parent])), value_set=sets[name])
                    at = at.fill_null(len(sets[name])).to_numpy()
                    row = [classes[own].sum(axis=0), np.bincount(at, minlength=len(sets[name]) + 1)]
                    totals[name] = totals.get(name, 0) + np.concatenate(row)
        names = ["lang", "counts"]
        counts = pa.array([x.tolist() for x in totals.values()], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(list(totals), pa.string()), counts], names=names)

    return run


def references(
    docs: DataFrame, share: float = SHARE, languages: int = LANGUAGES, least: int = REFERENCE
) -> dict[str, Reference]:
    """The reference of every language of ``docs`` (``lang`` and ``text``) with enough words."""
    rows = docs.select("lang", "text").where("lang is not null")
    candidates = _candidates(rows, share, languages, least)
    tallied = rows.mapInArrow(_tallied(candidates), "lang string, counts array<long>")
    sums = tallied.select("lang", F.posexplode("counts")).groupBy("lang", "pos").agg(F.sum("col").alias("n"))
    counts = {lang: np.zeros(len(CLASSES) + len(words) + 1, np.int64) for lang, words in candidates.items()}
    for lang, pos, n in sums.collect():
        counts[lang][pos] = n
    out = {}
    for lang, words in candidates.items():
        classes, found = np.split(counts[lang], [len(CLASSES)])
        common = np.flatnonzero(found[:-1] >= share * found.sum())
        shares = np.append(found[common], found.sum() - found[common].sum()) / found.sum()
        out[lang] = Reference(classes / classes.sum(), [words[i] for i in common], shares)
    return out


# --- distances -----------------------------------------------------------------------------


def distances(counts: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of every row of counts from the shares; 1 for rows without counts."""
    total = counts.sum(axis=1, keepdims=True)
    p = counts / np.maximum(total, 1)
    middle = (p + shares) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / middle), 0).sum(axis=1)
        right = np.where(shares > 0, shares * np.log2(shares / middle), 0).sum(axis=1)
    return np.where(total[:, 0] > 0, np.sqrt(np.clip((left + right) / 2, 0, 1)), 1.0)


def _judged(known: dict[str, Reference], class_limit: float, word_limit: float, least_chars: int, least_words: int) -> Callable:
    """Rows of facts, distances and verdicts of (doc_id, lang, text)."""
    sets = {lang: pa.array(r.words, pa.large_string()) for lang, r in known.items()}

    def compared(lang: str, classes: np.ndarray, parent: np.ndarray, words: pa.Array):
        """Distances of all texts from a language, and whether it accepts them."""
        n, k = len(classes), len(sets[lang])
        at = pc.index_in(words, value_set=sets[lang]).fill_null(k).to_numpy()
        counts = np.bincount(parent * (k + 1) + at, minlength=n * (k + 1)).reshape(n, k + 1)
        by_class, by_word = distances(classes, known[lang].classes), distances(counts, known[lang].shares)
        chars = classes.sum(axis=1) - classes[:, CLASSES.index("space")]
        fits = ((by_class <= class_limit) | (chars < least_chars)) & ((by_word <= word_limit) | (counts.sum(axis=1) < least_words))
        return by_class, by_word, fits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang = batch.column(1).to_numpy(zero_copy_only=False)
            for i, j, data, offsets in blocks(batch.column(2)):
                facts, classes = _facts(data, offsets)
                parent, words = _words(_texts(_FOLDED[data], offsets))
                n, own = j - i, lang[i:j]
                by_class, by_word, fits = np.full(n, np.nan), np.full(n, np.nan), np.full(n, not known)
                unknown = np.array([x not in known for x in own.tolist()], bool)
                for name in known:
                    mine = np.flatnonzero((own == name) | unknown)
                    if not len(mine):
                        continue
                    place = np.full(n, -1)
                    place[mine] = np.arange(len(mine))
                    of = place[parent]
                    c, w, ok = compared(name, classes[mine], of[of >= 0], words.filter(pa.array(of >= 0)))
                    # Of several languages the nearest one is told.
                    nearer = np.isnan(by_class[mine]) | (c + w < by_class[mine] + by_word[mine])
                    by_class[mine], by_word[mine] = np.where(nearer, [c, w], [by_class[mine], by_word[mine]])
                    fits[mine] |= ok
                columns = [batch.column(0).slice(i, n), *map(pa.array, facts.values())]
                told = [pa.array(x, pa.float64(), mask=np.isnan(x)) for x in (by_class, by_word)]
                columns += [*told, pa.array(fits & ~facts["base_failed"])]
                names = ["doc_id", *facts, "class_distance", "word_distance", "kept"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


JUDGED = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, class_distance double, word_distance double, kept boolean"
)


def judged(
    docs: DataFrame,
    known: dict[str, Reference],
    class_limit: float = CLASS_LIMIT,
    word_limit: float = WORD_LIMIT,
    least_chars: int = LEAST_CHARS,
    least_words: int = LEAST_WORDS,
) -> DataFrame:
    """Counts, distances from the language (null without references) and verdict of every row of ``docs``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text")
    return rows.mapInArrow(_judged(known, class_limit, word_limit, least_chars, least_words), JUDGED)
