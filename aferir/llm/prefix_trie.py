"""Prefix trie of conversations, with sums over subtrees by the Euler-tour technique.

**Nodes.** Every distinct sequence of first turns is a node. A sequence is known by two 60-bit numbers: the
exclusive or of the md5 of its (position, role, text), so it is a running value in the order of turns.
Positions and running values come from rows dealt by ranges of (conversation, turn) with a carry for the
few conversations that lie in several ranges: a conversation of any length is spread.

**Tour.** Each node has an enter and an exit arc. An enter arc is followed by the enter arc of the first child,
or the node's own exit; an exit arc by the enter arc of the next sibling, or the exit of the parent. Siblings
are linked over ranges too, so a parent with any number of children is spread.

**List ranking.** Arcs are dealt by ranges of (conversation, depth); each partition joins its own chains into
one element each (pointer doubling in numpy). While more than ``REST`` elements are left, elements are spliced
out where a hash gives their predecessor heads and them tails, a quarter a round, in joins; the rest, at most
``REST`` whatever the input, is ranked in one task, and the spliced elements and the chains get their ranks back
in reverse order. Ranks are vectors: position, leaves and savings before the arc.

**Sums.** The difference of the prefix sums at a node's exit and enter arcs is the sum over its subtree.

Edge cases: null roles and texts are empty; a null turn is first; equal turns are ordered by role and text;
rows with a null conv_id form one conversation, whose number is written as an empty string and counts as
larger than all others; repeated rows are repeated turns; an empty table has the root only, without members;
further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aferir.llm.common import stored
from aferir.operators.join import join_unique

#: Elements of the list that one task ranks; a partition's arcs; ids of one part of a member list.
REST, PART_ROWS, LIST_IDS = 100_000, 400_000, 4096

NODE = ["a", "b"]


def dealt(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows dealt by ranges of the keys, with the number of their range in ``part``; kept, as several passes
    must see the same ranges."""
    return stored(df.repartitionByRange(*keys).withColumn("part", F.spark_partition_id()))


def carried(rows: DataFrame, group: list[str], sums: dict[str, Column]) -> DataFrame:
    """For groups that lie in several ranges: what the ranges before hold, as one row for each later range.

    A range border lies in one group, so there are fewer rows than ranges and they may be broadcast.
    """
    before = Window.partitionBy(*group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy(*group, "part").agg(*[value.alias(name) for name, value in sums.items()])
    return F.broadcast(
        parts.withColumn("_earlier", F.count("*").over(before))
        .withColumns({name: F.expr(f"{'bit_xor' if name.startswith('x') else 'sum'}({name})").over(before) for name in sums})
        .where("_earlier > 0")
        .drop("_earlier")
    )


def numbered(turns: DataFrame) -> DataFrame:
    """conv, ``pos`` (the place of each turn in its conversation, from 0), ``said`` (md5 of role and text) and
    the words of the text. The texts themselves go no further."""
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    order = ["turn", "role", "text"]
    rows = dealt(rows, ["conv", *order])
    here = Window.partitionBy("conv", "part").orderBy(*order)
    ahead = carried(rows, ["conv"], {"more": F.count("*")}).withColumnsRenamed({"conv": "_conv", "part": "_part"})
    rows = rows.withColumn("pos", (F.row_number().over(here) - 1).cast("long"))
    rows = rows.join(ahead, F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("part") == F.col("_part")), "left")
    said = F.md5(F.concat_ws("|", F.length("role"), F.col("role"), F.col("text")).cast("binary"))
    words = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    place = F.col("pos") + F.coalesce("more", F.lit(0))
    return rows.select("conv", place.alias("pos"), said.alias("said"), words.alias("words"))


def _short_hash(value: Column, at: int) -> Column:
    """Sixty bits of an md5, as a long."""
    return F.conv(F.substring(value, at, 15), 16, 10).cast("long")


def prefixes(turns: DataFrame) -> DataFrame:
    """A row for each turn (conv, pos, said, words) with the node it reaches (a, b), the node before (pa, pb)."""
    tagged = F.md5(F.concat_ws("|", "pos", "said").cast("binary"))
    rows = turns.select("conv", "pos", tagged.alias("h"), "words")
    rows = rows.select("conv", "pos", "words", _short_hash(F.col("h"), 1).alias("ta"), _short_hash(F.col("h"), 16).alias("tb"))
    rows = dealt(rows, ["conv", "pos"])
    here = Window.partitionBy("conv", "part").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    ahead = carried(rows, ["conv"], {"xa": F.bit_xor("ta"), "xb": F.bit_xor("tb")})
    ahead = ahead.withColumnsRenamed({"conv": "_conv", "part": "_part"})
    rows = rows.withColumns({"a": F.bit_xor("ta").over(here), "b": F.bit_xor("tb").over(here)})
    rows = rows.join(ahead, F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("part") == F.col("_part")), "left")
    for name in NODE:
        rows = rows.withColumn(name, F.col(name).bitwiseXOR(F.coalesce(f"x{name}", F.lit(0))))
        rows = rows.withColumn(f"p{name}", F.col(name).bitwiseXOR(F.col(f"t{name}")))
    return rows.select("conv", "pos", "words", "a", "b", "pa", "pb")


def member_lists(ends: DataFrame) -> DataFrame:
    """SHA-256 of the comma-joined ascending ids that end at each node (a, b).

    Lists are put together in parts of at most ``LIST_IDS`` ids, which one digest then reads in order.
    """
    part = F.floor(F.col("conv") / LIST_IDS)
    ids = F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string"))
    # A null id is last and an empty string.
    last = F.max(F.col("conv").isNull())
    joined = F.array_join(F.when(last, F.concat(ids, F.array(F.lit("")))).otherwise(ids), ",")
    parts = ends.groupBy(*NODE, part.alias("part")).agg(joined.alias("ids"))
    parts = parts.repartition(*NODE).sortWithinPartitions(*NODE, F.col("part").asc_nulls_last())

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, state = None, None
        for batch in batches:
            done = []
            for a, b, ids in zip(batch["a"], batch["b"], batch["ids"], strict=True):
                if (a, b) == current:
                    state.update(b"," + ids.encode())
                else:
                    if state is not None:
                        done.append((*current, state.hexdigest()))
                    current, state = (a, b), hashlib.sha256(ids.encode())
            yield pd.DataFrame(done, columns=["a", "b", "ends_sha256"])
        if state is not None:
            yield pd.DataFrame([(*current, state.hexdigest())], columns=["a", "b", "ends_sha256"])

    return parts.mapInPandas(hashed, "a long, b long, ends_sha256 string")


def trie_nodes(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """All nodes of the trie of ``turns`` (conv, pos, said, words); ``convs`` (conv, n: number of its turns)
    has every member, those without turns included.

    Columns: a, b, pa, pb (null for the root), conv_id, depth, n_convs, words, ends_sha256.
    """
    rows = stored(prefixes(turns))
    nodes = rows.groupBy("a", "b", "pa", "pb", F.col("pos").alias("at")).agg(
        F.min("conv").alias("conv_id"), F.count("*").alias("n_convs"), F.max("words").alias("words")
    )
    nodes = nodes.select("a", "b", "pa", "pb", "conv_id", (F.col("at") + 1).alias("depth"), "n_convs", "words")
    nothing = F.lit(None).cast("long")
    zero = F.lit(0).cast("long")
    root = convs.agg(F.min("conv").alias("conv_id"), F.count("*").alias("n_convs")).select(
        zero.alias("a"), zero.alias("b"), nothing.alias("pa"), nothing.alias("pb"), "conv_id", zero.alias("depth"), "n_convs", zero.alias("words")
    )
    last = rows.groupBy("conv").agg(F.max_by(F.struct("a", "b"), "pos").alias("end")).select("conv", "end.a", "end.b")
    without = convs.where("n = 0").select("conv", zero.alias("a"), zero.alias("b"))
    ends = member_lists(last.unionByName(without))
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return nodes.unionByName(root).join(ends, NODE, "left").withColumn("ends_sha256", F.coalesce("ends_sha256", empty))


def enter(a: str = "a", b: str = "b") -> Column:
    return F.struct((F.col(a) * 2).alias("x"), F.col(b).alias("y"))


def leave(a: str = "a", b: str = "b") -> Column:
    return F.struct((F.col(a) * 2 + 1).alias("x"), F.col(b).alias("y"))


def tour(nodes: DataFrame) -> DataFrame:
    """The arcs of the Euler tour: x, y; the next arc nx, ny (null at the end); leaf and saved, which count at
    enter arcs; conv_id and depth. Siblings come in the order of their conv_id, then a and b."""
    order = ["conv_id", "a", "b"]
    inner = dealt(nodes.where("depth > 0").select("pa", "pb", *order), ["pa", "pb", *order])
    here = Window.partitionBy("pa", "pb", "part").orderBy(*order)
    sibling = inner.withColumn("next", F.lead(F.struct("a", "b")).over(here))
    # The first child in the next range of the same parent: at most one row for each range border.
    firsts = inner.groupBy("pa", "pb", "part").agg(F.min(F.struct(*order)).alias("first"))
    after = Window.partitionBy("pa", "pb").orderBy("part")
    firsts = firsts.withColumn("over", F.lead(F.struct("first.a", "first.b")).over(after))
    borders = F.broadcast(firsts.where("over IS NOT NULL").select("pa", "pb", "part", "over"))
    sibling = sibling.join(borders, ["pa", "pb", "part"], "left").withColumn("next", F.coalesce("next", "over"))
    following = F.coalesce(F.when(F.col("next").isNotNull(), enter("next.a", "next.b")), leave("pa", "pb"))
    following = sibling.select("a", "b", following.alias("after"))
    first = firsts.groupBy("pa", "pb").agg(F.min_by("first", "part").alias("child"))
    first = first.select(F.col("pa").alias("a"), F.col("pb").alias("b"), F.col("child.a").alias("ca"), F.col("child.b").alias("cb"))
    linked = nodes.join(first, NODE, "left").join(following, NODE, "left")
    into = F.when(F.col("ca").isNotNull(), enter("ca", "cb")).otherwise(leave())
    leaf = F.col("ca").isNull().cast("long")
    saved = (F.col("n_convs") - 1) * F.col("words")
    zero = F.lit(0).cast("long")
    arc = lambda key, then, *sums: F.struct(
        key.alias("key"), then.alias("then"), sums[0].alias("leaf"), sums[1].alias("saved")
    )
    arcs = F.array(arc(enter(), into, leaf, F.greatest(saved, zero)), arc(leave(), F.col("after"), zero, zero))
    return linked.select("conv_id", "depth", F.explode(arcs).alias("arc")).select(
        "arc.key.x", "arc.key.y", F.col("arc.then.x").alias("nx"), F.col("arc.then.y").alias("ny"), "arc.leaf", "arc.saved", "conv_id", "depth"
    )


# --- list ranking ---

ELEMENT = ["x", "y", "nx", "ny", "w0", "w1", "w2"]
CHAINS = "kind int, x long, y long, nx long, ny long, w0 long, w1 long, w2 long"


def chains(x: np.ndarray, y: np.ndarray, nx: np.ndarray, ny: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Chains of elements that follow each other among those given.

    Returns the head of each element, the weights of its chain before it, and the last element of each.
    """
    n = len(x)
    # Numbers of elements by key; -1 where the next one is not here.
    order = np.lexsort((y, x))
    key_x, key_y = x[order], y[order]
    at, end = np.searchsorted(key_x, nx), np.searchsorted(key_x, nx, side="right")
    following = np.full(n, -1, np.int64)
    rows = np.flatnonzero(at < end)
    while len(rows):  # keys that agree in x are very few
        here = key_y[at[rows]] == ny[rows]
        following[rows[here]] = order[at[rows[here]]]
        rows = rows[~here]
        at[rows] += 1
        rows = rows[at[rows] < end[rows]]
    before = np.full(n, -1, np.int64)
    linked = np.flatnonzero(following >= 0)
    before[following[linked]] = linked
    head = np.where(before >= 0, before, np.arange(n))
    offset = np.where((before >= 0)[:, None], weights[before], 0)
    # Pointer doubling: each round reaches twice as far back.
    while True:
        further = head[head]
        if np.array_equal(further, head):
            break
        offset, head = offset + offset[head], further
    tails = np.flatnonzero(following < 0)
    return head, offset, tails


def _joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Chains of a partition: kind 0, an element with its head (nx, ny) and the weights before it in the
    chain; kind 1, a chain as an element of its own with the next key and all its weights."""
    frames = [batch for batch in batches if len(batch)]
    if not frames:
        return
    rows = pd.concat(frames, ignore_index=True)
    x, y, nx, ny = (rows[c].to_numpy(np.int64) for c in ("x", "y", "nx", "ny"))
    weights = rows[["w0", "w1", "w2"]].to_numpy(np.int64)
    head, offset, tails = chains(x, y, nx, ny, weights)
    names = [field.split()[0] for field in CHAINS.split(", ")]
    placed = np.column_stack([np.zeros(len(x), np.int64), x, y, x[head], y[head], offset])
    total = offset[tails] + weights[tails]
    whole = np.column_stack([np.ones(len(tails), np.int64), x[head[tails]], y[head[tails]], nx[tails], ny[tails], total])
    yield pd.DataFrame(np.concatenate([placed, whole]), columns=names)


def _coin(x: str, y: str, round_number: int) -> Column:
    return F.pmod(F.xxhash64(x, y, F.lit(round_number)), F.lit(2)) == 1


def list_ranks(arcs: DataFrame, rest: int | None = None) -> DataFrame:
    """x, y and the sums of the weights w0, w1, w2 of all elements before it in the list.

    ``arcs``: x, y, nx, ny (null at the end of the list), w0, w1, w2, and conv_id and depth to deal them by.
    """
    rest = REST if rest is None else rest
    # The end of the list is a key of -1, as a column with nulls would lose digits on its way to numpy.
    end = F.lit(-1).cast("long")
    rows = stored(arcs.withColumns({"nx": F.coalesce("nx", end), "ny": F.coalesce("ny", end)}))
    n_parts = max(rows.count() // PART_ROWS + 1, arcs.sparkSession.sparkContext.defaultParallelism)
    spread = rows.repartitionByRange(n_parts, "conv_id", "depth", "x", "y").select(*ELEMENT)
    # Adaptive execution may join small ranges; a wide range is bounded by PART_ROWS on average.
    local = stored(spread.mapInPandas(_joined, CHAINS))
    left = local.where("kind = 1").drop("kind")
    left_rows = left.count()
    rounds, removed = 0, []
    while left_rows > rest:
        heads = ~_coin("x", "y", rounds)
        # A key of -1 ends the list and is never spliced out.
        takes = heads & _coin("nx", "ny", rounds) & (F.col("nx") >= 0)
        takers = left.where(takes)
        others = left.where(~takes)
        tails = others.where(~heads).select(*[F.col(c).alias(f"t_{c}") for c in ELEMENT])
        met = stored(takers.join(tails, (F.col("nx") == F.col("t_x")) & (F.col("ny") == F.col("t_y")), "full"))
        removed.append(met.where("x IS NOT NULL").select("t_x", "t_y", "x", "y", "w0", "w1", "w2"))
        grown = met.where("x IS NOT NULL").select(
            "x", "y", F.col("t_nx").alias("nx"), F.col("t_ny").alias("ny"), *[(F.col(w) + F.col(f"t_{w}")).alias(w) for w in ELEMENT[4:]]
        )
        kept = met.where("x IS NULL").select(*[F.col(f"t_{c}").alias(c) for c in ELEMENT])
        left = stored(others.where(heads).unionByName(grown).unionByName(kept))
        rounds, left_rows = rounds + 1, left.count()
    # At most ``rest`` elements: one task links them.
    ranks = left.coalesce(1).mapInPandas(_joined, CHAINS).where("kind = 0").select("x", "y", "w0", "w1", "w2")
    for gone in reversed(removed):
        ranks = stored(ranks)
        before = ranks.select("x", "y", *[F.col(w).alias(f"r_{w}") for w in ELEMENT[4:]])
        back = gone.join(before, ["x", "y"]).select(
            F.col("t_x").alias("x"), F.col("t_y").alias("y"), *[(F.col(w) + F.col(f"r_{w}")).alias(w) for w in ELEMENT[4:]]
        )
        ranks = ranks.unionByName(back)
    placed = local.where("kind = 0").withColumnsRenamed({"nx": "hx", "ny": "hy"})
    before = stored(ranks).select(F.col("x").alias("hx"), F.col("y").alias("hy"), *[F.col(w).alias(f"r_{w}") for w in ELEMENT[4:]])
    found = join_unique(placed, before, ["hx", "hy"], "inner")
    return found.select("x", "y", *[(F.col(w) + F.col(f"r_{w}")).alias(w) for w in ELEMENT[4:]])


def prefix_trie(turns: DataFrame, convs: DataFrame, rest: int | None = None) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256, and entered: the position of its enter arc in the tour.

    ``turns``: conv, pos, said, words; ``convs``: conv and n, the number of its turns.
    """
    nodes = stored(trie_nodes(turns, convs))
    one = F.lit(1).cast("long")
    arcs = tour(nodes).select("x", "y", "nx", "ny", one.alias("w0"), F.col("leaf").alias("w1"), F.col("saved").alias("w2"), "conv_id", "depth")
    ranks = list_ranks(arcs, rest)
    out = F.col("x") % 2 == 1
    signed = lambda w: F.sum(F.when(out, F.col(w)).otherwise(-F.col(w)))
    sums = ranks.groupBy(F.expr("x div 2").alias("a"), F.col("y").alias("b")).agg(
        F.min("w0").alias("entered"), signed("w1").alias("n_leaves"), signed("w2").alias("saved_tokens")
    )
    children = nodes.where("depth > 0").groupBy(F.col("pa").alias("a"), F.col("pb").alias("b")).agg(F.count("*").alias("n_children"))
    whole = nodes.join(sums, NODE).join(children, NODE, "left")
    parents = nodes.select(F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("parent_conv_id"))
    inner = join_unique(whole.where("depth > 0"), parents, ["pa", "pb"])
    root = whole.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    return inner.unionByName(root).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"),
        "n_leaves", "saved_tokens", "ends_sha256", "entered",
    )


def conversations(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Numbered turns of a table (conv_id, turn, role, text), and its conversations with their lengths."""
    rows = stored(numbered(turns))
    return rows, rows.groupBy("conv").agg(F.count("*").alias("n"))


def rebuilt(turns: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first h turns come from conversation c - c % 20, with h = crc32(c) % 4."""
    h = F.coalesce(F.crc32(F.col("conv").cast("string").cast("binary")) % 4, F.lit(0)).cast("long")
    plan = convs.select("conv", "n", h.alias("h"), F.expr("conv - conv % 20").alias("source"))
    lengths = convs.where("conv % 20 = 0").select(F.col("conv").alias("source"), F.col("n").alias("given"))
    taken = F.least("h", F.coalesce("given", F.lit(0).cast("long")))
    plan = plan.join(lengths, "source", "left").withColumn("taken", taken)
    plan = stored(plan.withColumn("own", F.greatest(F.col("n") - F.col("h"), F.lit(0).cast("long"))))
    donors = turns.where("conv % 20 = 0 AND pos < 3").withColumnRenamed("conv", "source")
    # A source serves at most twenty conversations from either side of zero, with three turns each.
    first = plan.select("conv", "source", "taken").join(donors, "source").where("pos < taken").select("conv", "pos", "said", "words")
    # The shift of a conversation's own turns follows from its number and its source's length.
    own = turns.withColumn("h", h).where("pos >= h")
    shift = plan.where("taken < h").select("conv", (F.col("h") - F.col("taken")).alias("less"))
    own = join_unique(own, shift, ["conv"])
    own = own.select("conv", (F.col("pos") - F.coalesce("less", F.lit(0).cast("long"))).alias("pos"), "said", "words")
    return first.unionByName(own), plan.select("conv", (F.col("taken") + F.col("own")).alias("n"))
