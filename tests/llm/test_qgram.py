import random

import pytest
from helpers import no_documents, odd_documents, plain, prose

from aferir.llm import qgram

ITEM = prose(11, 60)


def brute_distance(part, text):
    """Least edits of part against any substring of the text."""
    before = [0] * (len(text) + 1)
    for i, char in enumerate(part, 1):
        row = [i]
        for j, other in enumerate(text, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (char != other)))
        before = row
    return min(before)


def edited(text, n, rng):
    chars = list(text)
    for _ in range(n):
        place, kind = rng.randrange(len(chars)), rng.randrange(3)
        if kind == 0:
            chars[place] = "#"
        elif kind == 1:
            del chars[place]
        else:
            chars.insert(place, "#")
    return "".join(chars)


def test_alignment_against_brute_force():
    rng = random.Random(1)
    for _ in range(200):
        part, text = ("".join(rng.choice("abc") for _ in range(n)) for n in (rng.randint(1, 12), rng.randint(0, 20)))
        best = qgram.align(qgram.codes(part), qgram.codes(text), -len(part), len(text))
        assert best[0] == brute_distance(part, text)


@pytest.mark.parametrize("m", [8, 20, 40, 95, 96])
def test_every_place_within_the_budget_is_found(m):
    """The lemma loses nothing: whatever brute force finds within the budget, the index finds."""
    rng = random.Random(m)
    part = prose(m, 60)[:m]
    index = qgram.Index([(1, part)])
    k = qgram.budget(m)
    assert qgram.needed(m) >= 1
    for n in range(2 * k + 2):
        text = prose(rng.random(), 40) + edited(part, n, rng) + prose(rng.random(), 40)
        found = index.matches(text)
        assert bool(found) == (brute_distance(part, text) <= k)
        assert all(edits <= k for *_, edits in found)


def test_passages_of_long_items():
    index = qgram.Index([(7, ITEM), (8, prose(12, 60))])
    passage = ITEM[40 : 40 + qgram.SEGMENT + qgram.STRIDE]
    found = index.matches("Before it. " + passage.upper() + " after it")
    assert found and {m[0] for m in found} == {7}
    assert not index.matches(prose(13, 500))
    most = len("Before it. ") + len(passage) + qgram.budget(qgram.SEGMENT)
    assert all(e <= most for _, _, e, _ in found)


def test_short_items_and_odd_characters():
    index = qgram.Index([(1, "abc"), (2, ""), (3, "İİİİİİİİ😀é")])
    assert [m[0] for m in index.matches("xx ABC")] == [1]
    assert {m[0] for m in index.matches("xx İİİİİİİİ😀é")} == {3}
    assert qgram.Index([]).matches("anything") == []


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(qgram, "BLOCK_CHARS", 300)  # several blocks
    bench = spark.createDataFrame([(i, prose(20 + i, 40), "x") for i in range(4)] + [(None, None, "x"), (9, "", "x")], "item_id long, text string, end string")
    leak = f"some words {prose(21, 40)} and more"
    docs = odd_documents(spark, [leak, prose(50, 300), leak])
    assert plain(qgram.leaked_regions(docs, bench).select("doc_id", "item_id")) == [(100, 1), (102, 1)]
    row = qgram.leaked_regions(docs, bench).first()
    assert leak[row["start"] : row["end"]] == prose(21, 40) and row["edits"] == 0
    kept = qgram.without_leaks(docs, bench)
    assert kept.columns == docs.columns and plain(kept) == plain(docs.where("doc_id is null or doc_id not in (100, 102)"))
    assert plain(qgram.leaked_regions(no_documents(spark), bench)) == []
    assert plain(qgram.without_leaks(docs, bench.limit(0))) == plain(docs)


def test_every_excerpt_of_71_characters_is_found():
    item = prose(14, 70)
    index = qgram.Index([(1, item)])
    for start in range(0, len(item) - 70, 9):
        assert index.matches(f"{prose(15, 20)} {item[start : start + 71]} {prose(16, 20)}"), start


def test_excerpts_apart_are_regions_of_their_own(spark):
    item, between = prose(17, 70), prose(18, 100)
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = spark.createDataFrame([(5, f"{item[:100]} {between} {item[-100:]}")], "doc_id long, text string")
    rows = sorted(qgram.leaked_regions(docs, bench).collect(), key=lambda r: r["start"])
    assert len(rows) == 2 and rows[0]["end"] <= 110 and rows[1]["start"] >= 90 + len(between)


def test_windows_and_hot_grams_lose_nothing(monkeypatch):
    """A q-gram of very many places and items is looked up in stretches; the result is the same."""
    item, hot = prose(17, 60), "ab ab ab " * 40
    items = [(1, item), (2, hot), (3, hot + prose(18, 30)), (4, prose(19, 10)[:20])]
    text = f"{prose(20, 60)} {hot * 3} {item[30:160]} {hot} {prose(19, 10)[:20]} {prose(18, 30)}"
    whole = set(qgram.Index(items).matches(text))
    assert {m[0] for m in whole} == {1, 2, 3, 4}
    monkeypatch.setattr(qgram, "WINDOW_POSTINGS", 50)
    cut = set(qgram.Index(items).matches(text))
    # A repeated passage may align in another place of a smaller band; every item is found again.
    assert {m[0] for m in cut} == {1, 2, 3, 4}
    assert {m for m in whole if m[0] in (1, 4)} == {m for m in cut if m[0] in (1, 4)}


def test_one_posting_a_character():
    index = qgram.Index([(1, ITEM), (2, prose(30, 80))])
    assert len(index.place) <= sum(len(text) for text in index.texts)
