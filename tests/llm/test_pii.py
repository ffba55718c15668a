import hashlib
import re

import pytest
from helpers import no_documents, odd_documents, plain

from aferir.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_matches(text):
    """The stated patterns, run as they are written."""
    digits = lambda s: re.sub("[^0-9]", "", s)
    found = [("email", *m.span()) for m in EMAIL.finditer(text)]
    found += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    found += [("card", *m.span()) for m in CARD.finditer(text) if 12 <= len(digits(m[0])) <= 19 and pii.luhn(digits(m[0]))]
    found += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m[0])) <= 15]
    return sorted(found)


CASES = [
    "a@b.c@d.e x@y @z.com q@w. e@r.t.y-u.",
    "1.1.1.1.1 300.1.1.1 10.0.0.255 010.1.1.1 1.2.3 0000255.1.1.1",
    "4539 1488 0343 6467, 4539-1488-0343-6467 and 4539148803436468 0000 0000 0000",
    "+1 (447) 555-9198 + 12 +123456789012345 +1234567890123456 +1 2 3",
    "",
    "@" * 50 + "." * 50 + "1" * 400 + "-" * 30,
]


@pytest.mark.parametrize("text", CASES)
def test_base_spans_are_the_stated_patterns(text):
    assert sorted(pii.detect(text)) == plain_matches(text)
    assert sorted(pii.find(text)[0]) == plain_matches(text)


@pytest.mark.parametrize(
    ("text", "kind", "part"),
    [
        ("write to jane [at] example (dot) org today", "email", "jane [at] example (dot) org"),
        ("jane at example dot org", "email", "jane at example dot org"),
        ("jane at example (dot) org", "email", "jane at example (dot) org"),
        ("mail ｊane＠example．org now", "email", "ｊane＠example．org"),
        ("mail jаne@example.org", "email", "jаne@example.org"),
        ("j​ane@example.org", "email", "j​ane@example.org"),
        ("host one nine two dot one six eight dot one dot nine up", "ip", "one nine two dot one six eight dot one dot nine"),
        ("call plus four four seven five five five one two three four", "phone", "plus four four seven five five five one two three four"),
        ("card four five three nine 1488 0343 6467.", "card", "four five three nine 1488 0343 6467"),
        ("card 4539 1488 O343 6467.", "card", "4539 1488 O343 6467"),
    ],
)
def test_disguises_point_into_the_source(text, kind, part):
    spans = [(k, text[s:e]) for k, s, e in pii.find(text)[1]]
    assert (kind, part) in spans


@pytest.mark.parametrize(
    "text", ["they met at the house dot by dot", "one two buckle my shoe", "look at example.com", "un deux trois", "a (at) b"]
)
def test_plain_prose_has_no_spans(text):
    assert pii.find(text)[1] == []


def test_edits_map_back_through_layers():
    text = pii.Rewritten("abcdef")
    text.apply([(1, 3, "X")])  # aXdef
    text.apply([(0, 1, ""), (1, 2, "YZ")])  # YZdef
    assert text.text == "YZdef"
    assert text.source(0, 2) == (1, 3)
    assert text.source(2, 5) == (3, 6)


def test_odd_rows(spark):
    docs = odd_documents(spark, ["a@b.cd"])
    rows = pii.pii_spans(docs).collect()
    assert len(rows) == docs.count()
    empty = hashlib.sha256(b"").hexdigest()
    assert {r["base_sha256"] for r in rows if r["doc_id"] in (2, 3)} == {empty}
    assert [r["spans"] for r in rows if r["doc_id"] == 100] == ["email:0:6"]
    assert plain(pii.pii_spans(no_documents(spark))) == []


def test_masking_keeps_other_columns_and_nulls(spark):
    docs = odd_documents(spark, ["to a@b.cd or +1 (447) 555-9198"])
    masked = pii.mask_texts(docs)
    assert masked.columns == docs.columns
    texts = {r["doc_id"]: r["text"] for r in masked.collect()}
    assert texts[100] == "to <email> or <phone>" and texts[2] is None
