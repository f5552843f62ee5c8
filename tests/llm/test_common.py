"""Words, hashes and encodings of whole texts."""

from __future__ import annotations

import random
from types import SimpleNamespace as Stub

import numpy as np
import pyarrow as pa
import pytest
from tidemark.llm.common import BLOCK, blocks, grams, relieve, words, written
from tidemark.llm.encoding import Encoder
from tidemark.llm.queries import vocabulary


def spelt(texts):
    out = []
    for _, _, data, offsets in blocks(pa.array(texts)):
        w = words(data, offsets)
        found = [bytes(data[s:e]) for s, e in zip(w.start, w.end)]
        out += [found[a:b] for a, b in zip(w.first[:-1], w.first[1:])]
    return out


def test_words_end_at_white_space_and_at_texts():
    picks = random.Random(1)
    texts = ["".join(picks.choice("ab é \t\n\r\x0b\x0c") for _ in range(picks.randrange(12))) for _ in range(300)]
    texts += [None, "", "tail", "head"]
    assert spelt(texts) == [(t or "").encode().split() for t in texts]


def test_long_texts_are_cut_at_white_space_only():
    text = "word " * (BLOCK // 2) + "x" * (3 * BLOCK) + " end"
    assert spelt([text, "next"]) == [text.encode().split(), [b"next"]]


def test_a_word_of_any_length_stays_one_word(monkeypatch):
    texts = ["a " + "xY" * 999 + " b", "z" * 700, "z" * 650, "", "end " + "q" * 1281]
    [(_, _, data, offsets)] = blocks(pa.array(texts))
    whole = words(data, offsets, lower=True)
    monkeypatch.setattr("tidemark.llm.common.BLOCK", 5)
    assert spelt(texts) == [t.encode().split() for t in texts]
    assert all((a == b).all() for a, b in zip(words(data, offsets, lower=True), whole))


def test_equal_words_have_equal_hashes_and_lower_case_is_an_option():
    [(_, _, data, offsets)] = blocks(pa.array(["The cat the CAT", "cat é É"]))
    plain, lower = words(data, offsets).hash, words(data, offsets, lower=True).hash
    assert plain[1] == plain[4] and len(set(plain)) == 6
    assert lower[0] == lower[2] and lower[1] == lower[3] == lower[4] and lower[5] != lower[6]


def test_grams_depend_on_order_and_place_only_in_their_entries():
    code = np.array([1, 2, 3, 1, 2, 3, 3, 2, 1], np.uint64)
    found = grams(code, 3)
    assert found[0] == found[3] and found[0] != found[6] and len(found) == 7
    assert len(grams(code, 10)) == 0


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pieces_give_the_library_s_ids(name, provided):
    encode = Encoder(vocabulary(name))
    texts = [r["text"] for r in provided("documents")]
    texts += ["a  b", "a \n b  ", "  x", "tab\tx y", "don't  we'll 's", "x\x00y z", "<|endoftext|> hi", "a b c"]
    texts += ["ΑΣ ΣΑΣ.", "İx y", "é ́x", "123 4a5 .,x ,, !a", "\n\n\n", "word.\n\nnext  line ", "it's' x_y_ q''"]
    assert [encode.ids(t) for t in texts] == encode.library(texts)
    assert encode.ids(None) == encode.ids("") == b""


def test_a_full_memory_changes_nothing(monkeypatch, provided):
    monkeypatch.setattr("tidemark.llm.encoding.MOST_PIECES", 50)
    encode = Encoder(vocabulary("byte_bpe_50k.json"))
    texts = [r["text"] for r in provided("documents")][:40]
    assert [encode.ids(t) for t in texts] == encode.library(texts)


def test_frequent_pieces_stay_when_the_memory_is_full(monkeypatch):
    monkeypatch.setattr("tidemark.llm.encoding.MOST_PIECES", 20)
    found = Encoder(vocabulary("byte_bpe_50k.json"))
    found.ids("the of and")
    for i in range(100):
        found.ids("a" + "b" * i)
    assert {"the", " of", " and"} <= set(found.pieces) and len(found.pieces) <= 22
    for text in ("a  b", "a \nb", "\na", "a ", "a\t b", "a\tb", "a　\nb", " ", "\n"):
        assert found.ids(text) == found.library([text])[0]


def driver(local, heap, asked):
    """What ``relieve`` reads of a session, with so much of 1,000 bytes of heap in use; gets a row for each collection."""
    runtime = Stub(totalMemory=lambda: heap, maxMemory=lambda: 1000)
    lang = Stub(Runtime=Stub(getRuntime=lambda: runtime), System=Stub(gc=lambda: asked.append(heap)))
    context = Stub(_jsc=Stub(sc=lambda: Stub(isLocal=lambda: local)))
    return Stub(sparkContext=context, _jvm=Stub(java=Stub(lang=lang)))


def test_a_grown_heap_of_the_driver_is_collected():
    asked = []
    assert [relieve(driver(False, heap, asked)) for heap in (300, 600, 601, 1000)] == [False, False, True, True]
    assert not relieve(driver(True, 1000, asked)) and asked == [601, 1000]


def test_the_driver_is_relieved_after_every_written_table(spark, monkeypatch):
    seen = []
    monkeypatch.setattr("tidemark.llm.common.relieve", seen.append)
    assert written(spark.range(3), "three").count() == 3 and seen == [spark]
