import random

import numpy as np
import pytest
from helpers import no_documents, odd_documents, plain, prose

from aferir.llm import order_minhash as omh


def brute_distance(a, b):
    before = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
        before = row
    return before[-1]


def changed(words, n, rng):
    words = list(words)
    for _ in range(n):
        place, kind = rng.randrange(len(words)), rng.randrange(3)
        if kind == 0:
            words[place] = "zz"
        elif kind == 1 and len(words) > 1:
            del words[place]
        else:
            words.insert(place, "yy")
    return words


def test_alignment_against_brute_force():
    rng = random.Random(2)
    for _ in range(600):
        a = [rng.randrange(12) for _ in range(rng.randint(1, 25))]
        b = [w if isinstance(w, int) else 99 for w in changed(a, rng.randint(0, 8), rng)]
        x, y, d = np.array(a, dtype=np.uint64), np.array(b, dtype=np.uint64), brute_distance(a, b)
        assert all(omh.distance_in_band(x, y, most) == min(d, most + 1) for most in (0, 2, 5, 30))
        assert omh.similar(x, y) == (1 - d / max(len(a), len(b)) >= 0.8 - 1e-12)


def test_order_matters_to_a_sketch():
    a, b = prose(1, 40).split(), prose(2, 40).split()
    one, _ = omh.sketch(omh.word_hashes(" ".join(a + b)))
    same, _ = omh.sketch(omh.word_hashes(" ".join(a + b)))
    swapped, _ = omh.sketch(omh.word_hashes(" ".join(b + a)))
    assert (one == same).all() and 0 < (one == swapped).sum() < omh.SKETCHES


def test_repeated_shingles_are_labelled():
    words = omh.word_hashes("a b c d e " * 6)
    assert len(set(omh.shingles(words).tolist())) == len(words) - 4


def brute_classes(docs):
    words = {doc: omh.word_hashes(text or "") for doc, text in docs.items()}
    parent = {doc: doc for doc in docs}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in docs:
        for b in docs:
            same = omh.similar(words[a], words[b]) if len(words[a]) and len(words[b]) else (docs[a] or "") == (docs[b] or "")
            if a < b and same:
                parent[max(root(a), root(b))] = min(root(a), root(b))
    return {doc: root(doc) for doc in docs}


@pytest.mark.parametrize("group_rows", [omh.GROUP_ROWS, 3])
def test_classes_against_brute_force(spark, monkeypatch, group_rows):
    """Copies, near copies, a shared passage, tiny and empty texts; also with groups that must be split."""
    monkeypatch.setattr(omh.links, "__defaults__", ("text", group_rows))
    rng = random.Random(7)
    passage = prose(99, 60)
    texts = {}
    for base in range(12):
        words = prose(base, 100).split()
        for copy in range(4):
            texts[base * 10 + copy] = " ".join(changed(words, copy * 2, rng))
    texts |= {200 + i: f"{passage} {prose(300 + i, 60)}" for i in range(25)}
    texts |= {400: "", 401: None, 402: "!!", 403: "!!", 404: "??", 405: "one two", 406: "one two", 407: "one", 408: prose(0, 100).upper()}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in omh.classes(docs).collect()}
    assert got == brute_classes(texts)


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = omh.classes(docs).collect()
    assert len(rows) == docs.count()
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], set()).add(r["class_id"])
    assert by[1] == by[4] == {1} and by[2] == by[3] == {2} and by[5] == {5}
    kept = omh.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == [1, 2, 5]
    assert sum(r["doc_id"] is None for r in kept.collect()) == 2
    assert plain(omh.classes(no_documents(spark))) == []


@pytest.mark.parametrize("group_rows", [omh.GROUP_ROWS, 3])
def test_a_source_and_copies_of_other_places_are_one_class(spark, monkeypatch, group_rows):
    """Each copy is near the source and not near the other copies; whichever node heads a bucket, none is lost."""
    monkeypatch.setattr(omh.links, "__defaults__", ("text", group_rows))
    texts = []
    for run in range(12):
        words = prose(1000 + run, 100).split()
        texts.append((run * 100, " ".join(words)))
        for copy in range(6):
            block = prose(2000 + run * 10 + copy, 15).split()
            texts.append((run * 100 + copy + 1, " ".join(words[: copy * 15] + block + words[copy * 15 + 15 :])))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = omh.classes(docs).select("class_id").distinct().count()
    assert got == 12


def test_spread_edits_at_the_threshold_are_found(spark):
    """A source and copies with 13 of 100 words changed anywhere: every copy is near the source only."""
    rng = random.Random(11)
    texts = []
    for run in range(20):
        words = prose(3000 + run, 100).split()
        texts.append((run * 100, " ".join(words)))
        for copy in range(5):
            places = set(rng.sample(range(100), 13))
            texts.append((run * 100 + copy + 1, " ".join("zz%d" % copy if i in places else w for i, w in enumerate(words))))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = omh.classes(docs).collect()
    assert sum(r["class_id"] == r["doc_id"] // 100 * 100 for r in got) >= 0.97 * len(texts)


def test_the_bound_turns_no_similar_pair_away():
    rng = random.Random(5)
    for _ in range(300):
        a = [rng.randrange(30) for _ in range(rng.randint(1, 60))]
        b = [w if isinstance(w, int) else 99 for w in changed(a, rng.randint(0, 12), rng)]
        x, y = np.array(a, dtype=np.uint64), np.array(b, dtype=np.uint64)
        held, sizes = omh.profiles([x, y]), np.array([len(x), len(y)])
        assert not omh.similar(x, y) or omh.may_be_similar(held[0], sizes[0], held[1:], sizes[1:])[0]


def test_partners_lose_no_similar_pair():
    """The rarest words of two similar texts meet, repeats included; of texts with a common passage few do."""
    rng = random.Random(6)
    for _ in range(60):
        texts = []
        for _ in range(4):
            words = [rng.randrange(40) for _ in range(rng.randint(1, 40))]
            texts += [[w if isinstance(w, int) else 99 for w in changed(words, rng.randint(0, 10), rng)] for _ in range(4)]
        texts = [np.array(words, dtype=np.uint64) for words in texts]
        found = omh.partners(texts)
        for i, others in enumerate(found):
            assert {j for j in range(i + 1, len(texts)) if omh.similar(texts[i], texts[j])} <= set(others.tolist())
    passage = list(range(60))
    texts = [np.array(passage + [rng.randrange(10**6) for _ in range(60)], dtype=np.uint64) for _ in range(100)]
    assert sum(map(len, omh.partners(texts))) < 100


def test_recall_at_the_threshold():
    """Pairs at a similarity of 0.8, single words replaced anywhere, share a sketch in nine of ten cases or more."""
    rng, found = random.Random(8), 0
    for _ in range(400):
        a = [rng.getrandbits(63) for _ in range(200)]
        b = list(a)
        for place in rng.sample(range(200), 40):
            b[place] = rng.getrandbits(63)
        a, b = (omh.sketch(np.array(words, dtype=np.uint64))[0] for words in (a, b))
        found += bool((a == b).any())
    assert found >= 0.88 * 400  # 0.9 but for three deviations of the trial


def test_pairs_of_many_buckets_are_compared_in_one(spark):
    """Near copies share most buckets: every pair meets in one of them, and the pairs are dealt over several."""
    rng = np.random.default_rng(5)
    n, keys = 40, np.array([-7, 3, 11, 1 << 60, -(1 << 62)], dtype=np.int64)
    held = [np.sort(rng.choice(keys, rng.integers(1, 6), replace=False)) for _ in range(n)]
    nodes = [rng.bytes(16) for _ in range(n)]
    meetings = np.zeros((n, n), dtype=int)
    dealt = []
    for key in keys.tolist():
        here = [i for i in range(n) if key in held[i]]
        met = omh.met_elsewhere(key, [held[i] for i in here], [nodes[i] for i in here])
        for a, i in enumerate(here):
            for b in np.flatnonzero(~met(a)):
                meetings[i, here[b]] += 1
        dealt.append(meetings.sum())
    share = np.array([[bool(set(a.tolist()) & set(b.tolist())) for b in held] for a in held])
    assert (meetings == share).all()
    assert (np.diff([0, *dealt]) > 0).all()


def test_components_of_a_chain_and_a_dense_group(spark):
    chain = [(bytes([0, i]), bytes([0, i + 1])) for i in range(60)]
    dense = [(bytes([1, i]), bytes([1, j])) for i in range(12) for j in range(i)]
    edges = spark.createDataFrame(chain + dense + dense[:5], "node binary, other binary")
    found = {bytes(r["node"]): bytes(r["label"]) for r in omh.components(edges).collect()}
    assert found == {bytes([0, i]): bytes([0, 0]) for i in range(61)} | {bytes([1, i]): bytes([1, 0]) for i in range(12)}
