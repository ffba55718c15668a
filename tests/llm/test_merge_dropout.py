import random

import numpy as np
import public_tokenizers
import pytest
import xxhash
from helpers import no_documents, odd_documents, plain, prose
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor

from aferir.llm import merge_dropout as md

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["  a  b\n\nc é ", "\n", " ", "日本 x\ty", "▁", "a▁ ▁b\n▁▁  c", "\x00", "😀 ok", "x" * 300, "<s> </s> <0x41>"]


@pytest.mark.parametrize("text", [t for t in ODD if "▁" not in t and "<" not in t] + [prose(2, 50)])
def test_without_dropout_it_is_the_library(text):
    library = SentencePieceProcessor(model_file=PATH)
    assert md.segmenter(PATH, 0.0, 1, 1).ids(text, "k").tolist() == library.encode(text)


@pytest.mark.parametrize("rate", [0.0, 0.1, 0.9, 1.0])
@pytest.mark.parametrize("text", [*ODD, prose(3, 80), ""])
def test_every_text_decodes(rate, text):
    segment = md.segmenter(PATH, rate, 5, 3)
    ids = segment.ids(text, "doc")
    assert (segment.text(ids) if len(ids) else "") == text


@settings(max_examples=200, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=40), st.integers(0, 3))
def test_any_text_decodes(text, key):
    segment = md.segmenter(PATH)
    assert (segment.text(segment.ids(text, key)) if text else "") == text


def test_both_agendas_agree():
    pieces = md.Pieces(PATH)
    for word in {*prose(4, 60).split(), "internationalization", "aaaaaaaaaaaa"}:
        base = xxhash.xxh32_intdigest(word)
        for limit in (0, 1 << 30, 3 << 30):
            assert pieces._short(word, limit, base) == pieces._long(word, limit, base)


def test_dropout_varies_by_seed_and_document_and_repeats():
    text = prose(6, 200)
    one = md.segmenter(PATH, 0.1, 1, 4)
    assert one.ids(text, "a").tolist() == md.Segmenter(PATH, 0.1, 1, 4).ids(text, "a").tolist()
    assert one.ids(text, "a").tolist() != one.ids(text, "b").tolist()
    assert one.ids(text, "a").tolist() != md.segmenter(PATH, 0.1, 2, 4).ids(text, "a").tolist()
    assert len(md.segmenter(PATH, 1.0, 1, 1).ids(text, "a")) > len(one.ids(text, "a")) > len(md.segmenter(PATH, 0.0, 1, 1).ids(text, "a"))


def test_odd_rows(spark):
    docs = odd_documents(spark, ODD)
    rows = md.segmentation_report(docs, PATH).collect()
    assert len(rows) == docs.count() and all(r["lossless"] for r in rows)
    assert {r["n_pieces"] for r in rows if r["doc_id"] in (2, 3)} == {0}
    decoded = md.decode_pieces(md.encode_texts(docs, PATH), PATH)
    assert plain(decoded) == plain(docs.selectExpr("doc_id", "coalesce(text, '')"))
    assert plain(md.segmentation_report(no_documents(spark), PATH)) == []


def test_every_occurrence_is_drawn_on_its_own():
    segment = md.segmenter(PATH)
    word = "▁international"
    assert segment.pieces.skipping(word, ())[0] == segment.pieces._short(word, 0, 0)
    found = segment.drawn([word] * 20_000, segment.draws("doc", 20_000))
    whole = segment.whole[word][0]
    assert len(set(found)) > 4
    # Several ways lead to one piece; each candidate skipped by a coin of its own gives the same share.
    rng = random.Random(3)
    coins = [tuple(t for t in range(100) if rng.random() < 0.1) for _ in range(20_000)]
    expected = sum(segment.pieces.numbers(segment.pieces.skipping(word, skips)[0]) == whole for skips in coins) / 20_000
    assert abs(found.count(whole) / len(found) - expected) < 0.02
    one = next(w for w in ("▁of", "▁in", "▁to", "▁a") if segment.pieces.skipping(w, ())[1] == 1)
    again = segment.drawn([one] * 20_000, segment.draws("doc", 20_000))
    share = sum(ids != segment.whole[one][0] for ids in again) / 20_000
    assert 0.09 < share < 0.11


def test_many_words_at_once_are_what_one_word_is():
    """Each word again by definition: the agenda is run anew for every further skip that is drawn."""
    segment = md.segmenter(PATH)
    words = ["▁" + w for w in prose(11, 3000).split()] + ["▁de", "▁internationalisation", "日本x", "▁", "é", "q" * 60] * 200
    own = segment.draws("doc", len(words))
    expected = []
    for word, state, gap in zip(words, own.tolist(), segment.gaps(own).tolist()):
        if len(word) > md.SHORT:
            expected.append(segment.pieces.numbers(segment.pieces.cut(word, segment.dropout, state & md.MASK)))
            continue
        skips, state = (), np.array([state], np.uint64)
        symbols, turns = segment.pieces.skipping(word, ())
        while gap < turns:
            skips += (gap,)
            symbols, turns = segment.pieces.skipping(word, skips)
            further, state = segment.draw(state)
            gap += 1 + int(further[0])
        expected.append(segment.pieces.numbers(symbols))
    assert segment.drawn(words, own) == expected


def test_units_and_memory_change_nothing(monkeypatch):
    texts = [prose(i, 30) + " ▁ x" for i in range(12)] + [""]
    whole = [ids.tolist() for ids in md.Segmenter(PATH, 0.1, 3, 0).ids_of(texts, range(13))]
    monkeypatch.setattr(md, "UNIT_CHARS", 200)
    monkeypatch.setattr(md, "WORDS", 20)
    monkeypatch.setattr(md, "BLOCK", 7)
    assert [ids.tolist() for ids in md.Segmenter(PATH, 0.1, 3, 0).ids_of(texts, range(13))] == whole


def test_rates_of_nothing_and_everything():
    text = prose(5, 60)
    assert md.Segmenter(PATH, 0.0, 1, 0).ids(text, "k").tolist() == SentencePieceProcessor(model_file=PATH).encode(text)
    assert len(md.Segmenter(PATH, 1.0, 1, 0).ids(text, "k")) == len(text) + 1


def test_encoding_passes_on_some_rows_at_a_time(spark, monkeypatch):
    texts = [f"some words {i} of a text, {i * 7919}" for i in range(1200)]
    docs = odd_documents(spark, texts).coalesce(1)
    plan = md.encode_texts(docs, PATH)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "ArrowEvalPython" not in plan
    # Other units and a small memory give the same pieces.
    few, many = md.Segmenter(PATH, 0.1, 17, 0, 50), md.Segmenter(PATH, 0.1, 17, 0)
    for a, b in zip(few.ids_of(texts, range(1200), 900), many.ids_of(texts, range(1200)), strict=True):
        assert a.tolist() == b.tolist()
