import hashlib
import random

import numpy as np
from helpers import no_documents, odd_documents, plain
from hypothesis import given, settings
from hypothesis import strategies as st

from aferir.llm import queries, runs


def brute_force(words):
    """Every stretch with smallest period q and max(12, 2q) words or more that cannot be extended."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(12, 2 * q):
                found.setdefault((start, i + q), q)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def by_grammar(texts):
    return [found for _, found, _ in runs._unit(texts)]


ALPHABETS = st.sampled_from(["a", "ab", "abc", "abcdefgh"])


@settings(max_examples=400, deadline=None)
@given(st.lists(ALPHABETS.flatmap(lambda letters: st.lists(st.sampled_from(letters), max_size=70)), min_size=1, max_size=4))
def test_runs_of_small_texts(texts):
    assert by_grammar(texts) == [brute_force(words) for words in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.text("abc", min_size=1, max_size=9), st.integers(1, 9)), max_size=8))
def test_runs_of_repeated_blocks(blocks):
    words = list("".join(block * times for block, times in blocks))
    assert by_grammar([words, words[1:], []]) == [brute_force(words), brute_force(words[1:]), []]


def test_runs_of_longer_texts():
    rng = random.Random(5)
    texts = []
    for size in (300, 700):
        words = [rng.choice("abcdefghijklmno") for _ in range(size)]
        for _ in range(4):
            at, period = rng.randrange(size // 2), rng.randint(1, 40)
            for i in range(at + period, min(size, at + period * rng.randint(2, 5) + rng.randrange(period))):
                words[i] = words[i - period]
        texts.append(words)
    texts += [list("abaababaabaab" * 8), list("a" * 500), list("aab" * 100 + "aab" * 3 + "b" + "aab" * 40)]
    assert by_grammar(texts) == [brute_force(words) for words in texts]


def test_candidates_in_blocks(monkeypatch):
    monkeypatch.setattr(runs, "CANDIDATES", 7)
    words = list("abcab" * 30 + "xy" * 20)
    assert by_grammar([words]) == [brute_force(words)]


def test_each_nonterminal_is_looked_at_once():
    words = np.zeros(4096, np.int64)
    grammar = runs.Grammar(words, np.array([4096]))
    assert grammar.n_nodes < 20 and sum(len(p) for _, p in grammar.places) > 400


def test_kept_words_and_longest():
    words = "x a b a b a b a b a b a b y".split()
    (n, found, collapsed), = runs._unit([words])
    assert (n, found, collapsed) == (14, [(1, 12, 2)], "x a b y")


def test_odd_rows(spark):
    docs = odd_documents(spark, ["la " * 20, " \x0b\x0c ", "a b " * 12, "x" + " de la" * 7])
    found = {}
    for row in runs.word_runs(docs).collect():
        found.setdefault(row.doc_id, []).append((row.n_words, [tuple(r) for r in row.runs], row.collapsed))
    assert found[2] == [(0, [], "")] and found[3] == [(0, [], "")] and len(found[4]) == 2 and len(found[None]) == 2
    assert found[100] == [(20, [(0, 20, 1)], "la")] and found[101] == [(0, [], "")]
    assert found[102] == [(12, [(0, 12, 1)], "a b")]
    assert found[103] == [(15, [(1, 14, 2)], "x de la")]
    assert found[5] == [(3001, [(1, 3000, 1)], "x" * 5000 + " word")]
    assert runs.word_runs(no_documents(spark)).collect() == []


def test_units_end_within_a_batch(spark, monkeypatch):
    docs = odd_documents(spark, ["la " * 20] * 5)
    whole = plain(runs.word_runs(docs))
    monkeypatch.setattr(runs, "UNIT_WORDS", 15)
    assert plain(runs.word_runs(docs)) == whole


def test_query_against_brute_force(spark):
    import zlib

    folder = "/root/testdata/sf0.001"
    found = {row.doc_id: row for row in queries.QUERIES["op11_grammar_runs"](spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    assert len(found) == len(docs) and any(row.n_runs for row in found.values())
    for doc in docs:
        words = runs.WORD.findall(doc.text or "")
        if len(words) > 1500:
            continue
        h = zlib.crc32(str(doc.doc_id).encode())
        if h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        expected = brute_force(words)
        dropped = {i for s, length, q in expected for i in range(s + q, s + length)}
        row = found[doc.doc_id]
        longest = min(expected, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        assert (row.n_runs, row.start, row.length, row.period) == (len(expected), *longest)
        assert row.exponent_milli == (1000 * longest[1] // longest[2] if expected else None)
        listed = "".join(f"{s},{length},{q}\n" for s, length, q in expected)
        assert row.runs_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
        assert row.collapsed_sha256 == hashlib.sha256(kept.encode()).hexdigest()
