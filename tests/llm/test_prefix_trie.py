import hashlib
import random
import zlib

import pytest
from helpers import plain


from aferir.llm import prefix_trie as trie

SCHEMA = "conv_id long, turn long, role string, text string, part string, pos long, a string"


def brute_force(convs):
    """Rows of the trie of ``convs``: number (None is largest) to turns (role, text)."""
    by_size = lambda c: (c is None, c or 0)
    members = {}
    for number, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(number)
    members.setdefault((), [])
    smallest = {node: min((c for c in found if c is not None), default=None) for node, found in members.items()}
    children = {node: sum(len(other) == len(node) + 1 and other[: len(node)] == node for other in members) for node in members}
    rows = []
    for node, found in members.items():
        below = [other for other in members if other[: len(node)] == node]
        ends = sorted((c for c in found if len(convs[c]) == len(node)), key=by_size)
        listed = ",".join("" if c is None else str(c) for c in ends)
        saved = sum((len(members[other]) - 1) * len(other[-1][1].split()) for other in below if other)
        rows.append((
            smallest[node], len(node), smallest[node[:-1]] if node else None, len(found), children[node],
            sum(children[other] == 0 for other in below), saved, hashlib.sha256(listed.encode()).hexdigest(),
        ))
    return sorted(rows, key=repr)


def table(spark, convs):
    rows = [(c, t, role, text, "p", 5, "a") for c, turns in convs.items() for t, (role, text) in enumerate(turns)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA)


def random_convs(seed, n, words="abc", depth=6):
    rng = random.Random(seed)
    return {c: [(rng.choice(["user", "bot"]), " ".join(rng.choices(words, k=rng.randint(0, 2)))) for _ in range(rng.randint(1, depth))] for c in range(n)}


def found(spark, convs, **options):
    result = trie.prefix_trie(*trie.conversations(table(spark, convs)), **options)
    return plain(result.drop("entered")), result


@pytest.mark.parametrize("seed", [1, 2])
def test_random_tries(spark, seed):
    convs = random_convs(seed, 150)
    assert found(spark, convs)[0] == brute_force(convs)


def test_list_ranking_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(trie, "PART_ROWS", 40)
    convs = random_convs(3, 60, words="abcd")
    rows, result = found(spark, convs, rest=40)
    assert rows == brute_force(convs)
    assert result.selectExpr("count(distinct entered) = count(*)", "min(entered) = 0").first() == (True, True)


def test_ranks_of_a_shuffled_list(spark):
    n = 3000
    order = list(range(n))
    random.Random(4).shuffle(order)
    rows = [(order[i] // 7, order[i], *((order[i + 1] // 7, order[i + 1]) if i + 1 < n else (None, None)), 1, i % 3, 2, order[i] % 50, 0) for i in range(n)]
    arcs = spark.createDataFrame(rows, "x long, y long, nx long, ny long, w0 long, w1 long, w2 long, conv_id long, depth long")
    ranks = {r.y: (r.w0, r.w1, r.w2) for r in trie.list_ranks(arcs, rest=200).collect()}
    before = 0
    for i, y in enumerate(order):
        assert ranks[y] == (i, before, 2 * i)
        before += i % 3


def test_one_long_conversation_and_one_wide_node(spark):
    convs = {0: [("user", f"w{i}") for i in range(300)]} | {i: [("user", "hi"), ("bot", f"b {i}")] for i in range(1, 200)}
    assert found(spark, convs)[0] == brute_force(convs)


def test_ranges_are_joined(spark):
    # A conversation and a parent that lie in several ranges.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        convs = {7: [("user", str(i % 5)) for i in range(200)]} | {i: [("bot", f"x{i}")] for i in range(20, 220)}
        rows = trie.numbered(table(spark, convs))
        assert sorted(r.pos for r in rows.where("conv = 7").collect()) == list(range(200))
        assert found(spark, convs)[0] == brute_force(convs)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_odd_rows(spark):
    rows = [
        (1, 2, "user", "b c", "p", 0, "a"), (1, None, "user", None, "p", 0, "a"), (1, 2, "user", "a", "p", 0, "a"),
        (2, 0, "user", "", "p", 0, "a"), (2, 5, "user", "a", "p", 0, "a"), (2, 5, "user", "a", "p", 0, "a"),
        (None, 1, None, "x" * 20000, "p", 0, "a"), (None, 2, "user", "a", "p", 0, "a"), (None, 2, "user", "a", "p", 0, "a"),
        (4, 0, "user", "", "p", 0, "a"),
    ]
    convs = {
        1: [("user", ""), ("user", "a"), ("user", "b c")], 2: [("user", ""), ("user", "a"), ("user", "a")],
        None: [("", "x" * 20000), ("user", "a"), ("user", "a")], 4: [("user", "")],
    }
    turns = spark.createDataFrame(rows, SCHEMA)
    result = trie.prefix_trie(*trie.conversations(turns)).drop("entered")
    assert plain(result) == brute_force(convs)


def test_lists_in_parts(spark, monkeypatch):
    monkeypatch.setattr(trie, "LIST_IDS", 3)
    convs = {i: [("user", "same")] for i in range(25)}
    assert found(spark, convs)[0] == brute_force(convs)


def test_empty_table(spark):
    result = trie.prefix_trie(*trie.conversations(spark.createDataFrame([], SCHEMA))).drop("entered")
    assert plain(result) == [(None, 0, None, 0, 0, 1, 0, hashlib.sha256(b"").hexdigest())]


def test_rebuilt(spark):
    convs = random_convs(9, 70) | {500: [("user", "z")], 513: [("user", "z"), ("bot", "y"), ("bot", "x"), ("bot", "w")], 613: [("user", "k")] * 5}
    convs |= {c: [("user", "q")] for c in range(701, 720)}  # without a source
    expected = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        expected[c] = convs.get(c - c % 20, [])[:h] + turns[h:]
    turns, lengths = trie.rebuilt(*trie.conversations(table(spark, convs)))
    made = {c: [] for c in convs}
    for row in turns.orderBy("conv", "pos").collect():
        assert row.pos == len(made[row.conv])
        made[row.conv].append(row.said)
    said = lambda role, text: hashlib.md5(f"{len(role)}|{role}|{text}".encode()).hexdigest()
    assert made == {c: [said(*turn) for turn in turns] for c, turns in expected.items()}
    assert {r.conv: r.n for r in lengths.collect()} == {c: len(t) for c, t in expected.items()}
    assert any(not t for t in expected.values())
    assert plain(trie.prefix_trie(turns, lengths).drop("entered")) == brute_force(expected)

