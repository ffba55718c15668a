"""Near-duplicate classes by Order MinHash.

A text is its words in lower case. Its shingles of five words are labelled with their occurrence, so a
repeated shingle counts each time. A sketch takes, under one hash order, the two smallest labelled
shingles and keeps them in the order of the text; texts agree on it the more often, the higher their
edit similarity. Texts that agree on one of 72 sketches are candidates; banded alignment of the words must
show a similarity of 0.8 or more. Before that, only bounds that no similar pair fails turn candidates away.

Copies (equal words) become one node first. In each bucket all nodes are compared with the bucket's
smallest node; then any two of a bucket that are not linked by that are compared, in groups of bounded
size. Larger buckets are cut by length and joined block by block, so no pair of a bucket is left out.
Linked nodes form a class by passing on the smallest label.

Edge cases: texts without words are classes of equal texts; a null text is an empty one; a text below
five words has one shingle of all its words; null and repeated doc ids keep a row each; a class is named
by its smallest doc_id (null if all are null); an empty table gives no rows; other columns are ignored,
or kept by ``one_of_each``.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aferir.llm.common import Remembered, stored, whole_text
from aferir.operators.join import join_unique
from aferir.session import broadcast_if_small

WORDS, SKETCHES, PER_SKETCH = 5, 72, 2
SIMILARITY = 0.8
GROUP_ROWS = 2048
#: Orders of buckets, by which the pairs of a group that shares many are dealt over them.
ORDERS = 8
#: Ids that may be broadcast to pick texts; 24 bytes each.
PICKED_ROWS = 500_000
WORD = re.compile(r"\w+")
BASE, STEP, MULTIPLIER = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    for _ in range(2):
        x = (x ^ (x >> np.uint64(32))) * MULTIPLIER
    return x ^ (x >> np.uint64(32))


SEEDS = mix(np.arange(1, SKETCHES + 1, dtype=np.uint64) * STEP)
#: Odd factors; the order of a sketch is that of factor times shingle plus seed, as shingles are mixed already.
FACTORS = mix(SEEDS) | np.uint64(1)


class WordHashes(Remembered):
    """Hashes of words, kept for the life of a worker; a hash is cheap, so only common words are worth it."""

    def make(self, word: str) -> int:
        return xxhash.xxh64_intdigest(word)


_hashes = WordHashes(100_000)


def word_hashes(text: str) -> np.ndarray:
    words = WORD.findall(text.lower())
    return np.fromiter(map(_hashes.__getitem__, words), dtype=np.uint64, count=len(words))


def fingerprint(words: np.ndarray, text: str) -> bytes:
    """128 bits of the words, or of the text if it has none."""
    return xxhash.xxh3_128_digest(words.tobytes() if len(words) else b"\0" + text.encode("utf-8", "surrogatepass"))


def shingles(words: np.ndarray) -> np.ndarray:
    """Hashes of the shingles, each labelled with its occurrence."""
    k = min(WORDS, len(words))
    n = len(words) - k + 1
    hashes = words[:n].copy()
    for place in range(1, k):
        hashes = hashes * BASE + words[place : place + n]
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order]
    begins = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    counter = np.arange(n)
    occurrence = np.empty(n, dtype=np.uint64)
    occurrence[order] = counter - np.maximum.accumulate(np.where(begins, counter, 0))
    return mix(hashes) + occurrence * STEP


def sketch(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order sketches of a text, and the places of their shingles."""
    labelled = shingles(words)
    size = min(PER_SKETCH, len(labelled))
    places = np.empty((SKETCHES, size), dtype=np.int64)
    # Some orders at a time, so that a text needs little memory and the values stay in the cache.
    step = max(1, 30_000 // len(labelled))
    for begin in range(0, SKETCHES, step):
        part = slice(begin, begin + step)
        values = labelled[None, :] * FACTORS[part, None]
        values += SEEDS[part, None]
        every = np.arange(len(values))
        # A few searches for the smallest value are faster than a partition.
        for column in range(size):
            places[part, column] = values.argmin(axis=1)
            values[every, places[part, column]] = np.uint64(0xFFFFFFFFFFFFFFFF)
    places.sort(axis=1)
    ordered = SEEDS.copy()
    for column in range(size):
        ordered = mix(ordered * BASE + labelled[places[:, column]])
    return ordered, places


# --- alignment ---------------------------------------------------------------------------------


def distance_in_band(a: np.ndarray, b: np.ndarray, most: int) -> int:
    """Edit distance of two word sequences, or ``most + 1`` if it is higher: diagonals up to ``most``.

    The band of a column is one integer with a bit for each row (Myers' differences of neighbouring cells), which
    moves down a row with each column. Cells outside count one more than their neighbour inside, which no path
    within ``most`` edits needs. Rows above the first hold their distance to it.
    """
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > most:
        return most + 1
    places: dict[int, list[int]] = {}
    for place, word in enumerate(a.tolist()):
        places.setdefault(word, []).append(place)
    # Of each word the rows of the band that hold it, the row of bit 0, and how many of its places were entered.
    rows = {word: (0, 0, 0) for word in places}
    width = 2 * most + 1
    full = (1 << width) - 1
    falls = (1 << (most + 1)) - 1
    rises = full ^ falls
    cell = most - (len(b) - len(a))  # the diagonal that ends in the last cell
    distance = len(b) - len(a)
    for column, word in enumerate(b.tolist()):
        low = column - most  # the word of ``a`` at bit 0
        match = 0
        if word in rows:
            match, base, entered = rows[word]
            match >>= low - base if entered else 0
            mine = places[word]
            while entered < len(mine) and mine[entered] <= low + 2 * most:
                if mine[entered] >= low:
                    match |= 1 << (mine[entered] - low)
                entered += 1
            rows[word] = match, low, entered
        # The column before, seen from the rows of this one.
        rises, falls = rises >> 1 | 1 << (width - 1), falls >> 1
        equal = ((((match & rises) + rises) ^ rises) | match | falls) & full
        right_up = falls | (full & ~(equal | rises))
        right_down = (equal & rises) << 1 & full
        right_up = (right_up << 1 | 1) & full
        rises, falls = right_down | (full & ~(equal | right_up)), equal & right_up
        distance += not equal >> cell & 1
        if distance > most:
            return most + 1
    return distance


def anchors(a: np.ndarray, b: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of word pairs that are single in both texts, on near diagonals, in increasing order."""
    pairs = []
    for words in (a, b):
        grams = words[:-1] * BASE + words[1:]
        values, first, count = np.unique(grams, return_index=True, return_counts=True)
        pairs.append((values[count == 1], first[count == 1]))
    _, left, right = np.intersect1d(pairs[0][0], pairs[1][0], assume_unique=True, return_indices=True)
    left, right = pairs[0][1][left], pairs[1][1][right]
    near = np.abs(left - right) <= most
    order = np.argsort(left[near], kind="stable")
    left, right = left[near][order], right[near][order]
    # Places that are above all before and below all after cannot cross another.
    if len(right):
        before = np.concatenate([[-1], np.maximum.accumulate(right)[:-1]])
        after = np.concatenate([np.minimum.accumulate(right[::-1])[::-1][1:], [len(b)]])
        keep = (right > before) & (right < after)
        left, right = left[keep], right[keep]
    return left, right


def triples(words: np.ndarray) -> np.ndarray:
    return (words[:-2] * BASE + words[1:-1]) * BASE + words[2:]


def counted(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(words, return_counts=True)


def shared_words(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray]) -> int:
    """Words in common, with repeats, of two counted texts."""
    _, i, j = np.intersect1d(left[0], right[0], assume_unique=True, return_indices=True)
    return int(np.minimum(left[1][i], right[1][j]).sum())


def profiles(texts: list[np.ndarray]) -> np.ndarray:
    """Per text how many of its three-word shingles fall in each of a number of bins."""
    sizes = [len(words) for words in texts]
    bits = min(12, max(8, (2 * sum(sizes) // len(sizes)).bit_length()))
    found = np.zeros((len(texts), 1 << bits), dtype=np.uint16 if max(sizes) < 1 << 16 else np.uint32)
    for row, words in zip(found, texts, strict=True):
        if len(words) > 2:
            grams = mix(triples(words)) >> np.uint64(64 - bits)
            row[:] = np.bincount(grams.astype(np.int64), minlength=1 << bits)
    return found


def may_be_similar(profile: np.ndarray, size: int, others: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Bound that no similar text fails: each edit takes three shingles at most, and bins share no fewer than texts."""
    longer = np.maximum(sizes, size)
    most = ((1 - SIMILARITY) * longer + 1e-9).astype(np.int64)
    good = longer - np.minimum(sizes, size) <= most
    at = np.flatnonzero(good)
    good[at] = np.minimum(others[at], profile).sum(axis=1, dtype=np.int64) >= longer[at] - 2 - 3 * most[at]
    return good


def numbered(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All words of the texts as numbers, a word's repeats inside a text apart, and how many texts hold each."""
    owner = np.repeat(np.arange(len(texts)), [len(words) for words in texts])
    words = np.concatenate(texts)
    order = np.lexsort((words, owner))
    fresh = np.concatenate([[True], (words[order][1:] != words[order][:-1]) | (owner[order][1:] != owner[order][:-1])])
    counter = np.arange(len(words))
    repeat = np.empty(len(words), dtype=np.uint64)
    repeat[order] = counter - np.maximum.accumulate(np.where(fresh, counter, 0))
    _, kind, counts = np.unique(mix(words * BASE + repeat), return_inverse=True, return_counts=True)
    return kind, counts


def partners(texts: list[np.ndarray], kinds: tuple[np.ndarray, np.ndarray] | None = None) -> list[np.ndarray]:
    """Per text the later ones that may be similar, by the rarest words.

    A text of n words shares all but a fifth of the longer one's words with a similar text. With all words,
    repeats numbered, in one order, such a pair has a word in common among the first floor(n / 5) + 1 of each.
    Rare words come first, so texts of a common passage seldom meet.
    """
    sizes = np.array([len(words) for words in texts])
    owner = np.repeat(np.arange(len(texts)), sizes)
    kind, counts = kinds or numbered(texts)
    order = np.lexsort((kind, counts[kind], owner))
    place = np.arange(len(kind)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    # One more than the bound asks for, against rounding.
    first = order[place <= (1 - SIMILARITY) * np.repeat(sizes, sizes) + 1]
    by_kind = first[np.argsort(kind[first], kind="stable")]
    ends = np.cumsum(np.bincount(kind[by_kind], minlength=len(counts)))
    texts_of = owner[by_kind]  # increasing inside each kind
    kinds_of, ends_of = kind[first], np.cumsum(np.bincount(owner[first], minlength=len(texts)))
    found = []
    for i, end in enumerate(ends_of.tolist()):
        mine = kinds_of[ends_of[i - 1] if i else 0 : end]
        lists = [texts_of[ends[k - 1] if k else 0 : ends[k]] for k in mine[counts[mine] > 1].tolist()]
        flags = np.zeros(len(texts), dtype=bool)
        for others in lists:
            flags[others] = True
        found.append(np.flatnonzero(flags[i + 1 :]) + i + 1)
    return found


def similar(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> bool:
    """Whether 1 - edit distance / longer length is at least ``least``."""
    longer = max(len(a), len(b))
    most = int((1 - least) * longer + 1e-9)
    if longer - min(len(a), len(b)) > most or longer - shared_words(counted(a), counted(b)) > most:
        return False
    # Each edit takes three shingles of three words at most.
    if min(len(a), len(b)) > 2 and shared_words(counted(triples(a)), counted(triples(b))) < longer - 2 - 3 * most:
        return False
    if min(len(a), len(b)) > 1:
        # Aligning the stretches between anchors one by one costs at least the distance of the whole.
        left, right = anchors(a, b, most)
        left, right = np.concatenate([[-1], left, [len(a)]]), np.concatenate([[-1], right, [len(b)]])
        cost = 0
        for k in np.flatnonzero((np.diff(left) > 1) | (np.diff(right) > 1)):
            x, y = a[left[k] + 1 : left[k + 1]], b[right[k] + 1 : right[k + 1]]
            size = max(len(x), len(y))
            if len(x) == len(y):
                cost += int((x != y).sum())
            elif min(len(x), len(y)) == 0 or size > 64:
                cost += size
            else:
                cost += distance_in_band(x, y, size)
            if cost > most:
                break
        if cost <= most:
            return True
    return distance_in_band(a, b, most) <= most


# --- buckets -----------------------------------------------------------------------------------

SKETCHED = "doc_id long, text_hash long, node binary, n_words int, sketches array<long>"


def sketched(docs: DataFrame, text: str = "text") -> DataFrame:
    """Node of every document; its sketches once for each batch it is in, so that copies add few rows to a bucket."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows, seen = [], set()
            for doc, text_hash, body in zip(batch["doc_id"], batch["text_hash"], batch["text"], strict=True):
                words = word_hashes(body)
                node = fingerprint(words, body)
                fresh = len(words) and node not in seen
                ordered = np.unique(sketch(words)[0]) if fresh else np.zeros(0, dtype=np.uint64)
                seen.add(node)
                rows.append((doc, text_hash, node, len(words), ordered.view(np.int64)))
            frame = pd.DataFrame(rows, columns=[field.split()[0] for field in SKETCHED.split(", ")])
            yield frame.astype({"doc_id": "Int64"})

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text(text).alias("text"))
    return source.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInPandas(work, SKETCHED)


def sequences(docs: DataFrame, wanted: DataFrame, text: str = "text") -> DataFrame:
    """The word hashes of the wanted nodes (doc_id, text_hash, node), one row each."""

    @F.pandas_udf("node binary, words binary")
    def work(texts: pd.Series) -> pd.DataFrame:
        found = [(word_hashes(body), body) for body in texts]
        return pd.DataFrame(
            {
                "node": [fingerprint(words, body) for words, body in found],
                "words": [(words >> np.uint64(32)).astype("<u4").tobytes() for words, _ in found],
            }
        )

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text(text).alias("text"))
    source = source.withColumn("text_hash", F.xxhash64("text"))
    picked = broadcast_if_small(stored(wanted.select("doc_id", "text_hash").distinct()), PICKED_ROWS)
    on = F.col("d.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("d.text_hash") == F.col("w.text_hash"))
    texts = source.alias("d").join(picked.alias("w"), on, "left_semi")
    return texts.select(work("text").alias("s")).select("s.*").dropDuplicates(["node"])


def verified(pairs: DataFrame, nodes: DataFrame, words: DataFrame) -> DataFrame:
    """The pairs (node, other) whose words align."""

    @F.pandas_udf("boolean")
    def close(left: pd.Series, right: pd.Series) -> pd.Series:
        read = lambda data: np.frombuffer(data, dtype="<u4").astype(np.uint64)
        return pd.Series([similar(read(a), read(b)) for a, b in zip(left, right, strict=True)], dtype=bool)

    one = words.select("node", F.col("words").alias("a"))
    two = words.select(F.col("node").alias("other"), F.col("words").alias("b"))
    return pairs.join(one, "node").join(two, "other").where(close("a", "b")).select("node", "other")


def screened(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs that are near enough in length."""
    one = nodes.select("node", F.col("n_words").alias("n1"))
    two = nodes.select(F.col("node").alias("other"), F.col("n_words").alias("n2"))
    near = F.least("n1", "n2") >= F.floor(SIMILARITY * F.greatest("n1", "n2"))
    found = pairs.join(one, "node").join(two, "other")
    return found.where(near).select("node", "other")


def met_elsewhere(bucket: int, keys: list[np.ndarray], nodes: list[bytes]) -> Callable[[int], np.ndarray]:
    """For a member of a bucket, flags of the members that it is compared with in another one, by all buckets' keys.

    A pair is compared in the lowest bucket that both are in, under one of several orders, which the nodes' hashes
    choose. So the pairs of a group that shares many buckets are dealt over them.
    """
    owner = np.repeat(np.arange(len(keys)), [len(found) for found in keys])
    values, kind, counts = np.unique(np.concatenate(keys).view(np.uint64), return_inverse=True, return_counts=True)
    shared = counts > 1
    owner, kind, values = owner[shared[kind]], (np.cumsum(shared) - 1)[kind[shared[kind]]], values[shared]
    # Members of each bucket as bits: whom a member meets is the union over its buckets.
    bits = np.zeros((len(values), (len(keys) + 7) // 8), dtype=np.uint8)
    np.bitwise_or.at(bits, (kind, owner // 8), (128 >> owner % 8).astype(np.uint8))
    ends = np.cumsum(np.bincount(owner, minlength=len(keys)))
    orders = SEEDS[:ORDERS, None]
    lower = mix(values[None, :] ^ orders) < mix(np.array([bucket]).view(np.uint64)[None, :] ^ orders)
    turn = np.array([int.from_bytes(node[:4], "little") for node in nodes], dtype=np.int64)

    def met(i: int) -> np.ndarray:
        mine = kind[ends[i - 1] if i else 0 : ends[i]]
        rows = np.array([np.bitwise_or.reduce(bits[mine[low[mine]]], axis=0) for low in lower])
        flags = np.unpackbits(rows, axis=1, count=len(keys))
        return flags[(turn + turn[i]) % ORDERS, np.arange(len(keys))].astype(bool)

    return met


def linked_within(members: DataFrame, buckets: DataFrame, words: DataFrame) -> DataFrame:
    """Links among the members (key, bucket, side, node, label) of each key; a key has at most GROUP_ROWS members.

    Members of one label are linked already. Members of one side meet under another key; side -1 meets all.
    Near copies share most of their ``buckets`` (key, node), but two nodes are compared in one of them only.
    """

    def links(rows: list) -> Iterator[tuple[bytes, bytes]]:
        sides = np.array([row[1] for row in rows])
        numbers = {label: number for number, label in enumerate(dict.fromkeys(row[3] for row in rows))}
        labels = np.array([numbers[row[3]] for row in rows])
        met = met_elsewhere(rows[0][5], [np.asarray(row[6], dtype=np.int64) for row in rows], [row[2] for row in rows])
        wanted = []
        for i in range(len(rows)):
            others = np.arange(i + 1, len(rows))
            others = others[(labels[others] != labels[i]) & ((sides[i] == -1) | (sides[others] != sides[i]))]
            wanted.append(others[~met(i)[others]] if len(others) else others)
        n_wanted = sum(map(len, wanted))
        if not n_wanted:
            return
        texts = [np.frombuffer(row[4], dtype="<u4").astype(np.uint64) for row in rows]
        sizes, held = np.array([len(words) for words in texts]), profiles(texts)
        kind, counts = numbered(texts)
        ends, held_here = np.cumsum(sizes).tolist(), np.zeros(len(counts), dtype=bool)
        runs = [triples(words) if len(words) > 2 else words[:0] for words in texts]
        run, run_counts = numbered(runs) if any(map(len, runs)) else (kind[:0], counts[:0])
        run_ends, run_here = np.cumsum([len(found) for found in runs]).tolist(), np.zeros(len(run_counts), dtype=bool)
        # Where few of the pairs are left, looking for partners costs more than the next bound.
        if n_wanted > 64 * len(rows):
            wanted = map(np.intersect1d, wanted, partners(texts, (kind, counts)))
        for i, others in enumerate(wanted):
            others = others[labels[others] != labels[i]]
            if not len(others):
                continue
            mine = kind[ends[i] - sizes[i] : ends[i]]
            mine_runs = run[run_ends[i] - len(runs[i]) : run_ends[i]]
            held_here[mine], run_here[mine_runs] = True, True
            for j in others[may_be_similar(held[i], sizes[i], held[others], sizes[others])].tolist():
                if labels[i] == labels[j]:
                    continue  # linked by way of others since
                # Most pairs of a common passage end here.
                shared = np.count_nonzero(held_here[kind[ends[j] - sizes[j] : ends[j]]])
                longer = int(max(sizes[i], sizes[j]))
                most = int((1 - SIMILARITY) * longer + 1e-9)
                if shared < longer - most:
                    continue
                # Each edit takes three shingles of three words at most.
                if np.count_nonzero(run_here[run[run_ends[j] - len(runs[j]) : run_ends[j]]]) < longer - 2 - 3 * most:
                    continue
                if similar(texts[i], texts[j]):
                    labels[labels == labels[j]] = labels[i]
                    yield rows[i][2], rows[j][2]
            held_here[mine], run_here[mine_runs] = False, False

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group: list = []
        for batch in batches:
            found = []
            for row in batch.itertuples(index=False, name=None):
                if group and (row[0], row[5]) != (group[0][0], group[0][5]):
                    found += links(group)
                    group = []
                group.append(row)
            yield pd.DataFrame(found, columns=["node", "other"])
        if group:
            yield pd.DataFrame(list(links(group)), columns=["node", "other"])

    every = buckets.groupBy("node").agg(F.collect_list("key").alias("keys"))
    rows = members.join(every.join(words, "node"), "node")
    # A number of its own: groups are small in bytes but not in work, so adaptive execution must not merge them.
    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.select("key", "side", "node", "label", "words", "bucket", "keys").repartition(parts, "key")
    return rows.sortWithinPartitions("key", "bucket", "node").mapInPandas(work, "node binary, other binary").distinct()


def unlinked(members: DataFrame) -> DataFrame:
    """The members (key, node, label) of keys with more than one label, with the key's size and its first label."""
    first = F.min_by("label", "node").alias("main")
    sizes = members.groupBy("key").agg(F.count("*").alias("n"), first, F.min("label").alias("low"), F.max("label").alias("high"))
    return members.join(sizes.where("low <> high").drop("low", "high"), "key")


def in_blocks(large: DataFrame, nodes: DataFrame, group_rows: int) -> DataFrame:
    """Members of buckets of any size under keys of at most about ``group_rows``, where all that may be alike still meet.

    Lengths of similar texts lie in one band or in two next to each other. What is larger still is cut into
    blocks, and each pair of blocks is a key; members of the first label need not meet among themselves.
    """
    sized = large.select("key", "node", "label").join(nodes.select("node", "n_words"), "node")
    band = F.floor(F.log("n_words") / -math.log(SIMILARITY))
    banded = sized.select("node", "label", F.col("key").alias("bucket"), F.explode(F.array(band, band - 1)).alias("band"))
    banded = stored(unlinked(banded.select(F.xxhash64("bucket", "band").alias("key"), "bucket", "node", "label")))
    small = banded.where(F.col("n") <= group_rows).select("key", "bucket", F.lit(-1).alias("side"), "node", "label")
    large = banded.where(F.col("n") > group_rows)
    part = max(1, group_rows // 2)
    is_main = F.col("label") == F.col("main")
    blocks = [F.ceil(F.sum(test.cast("int")) / part).alias(name) for test, name in ((is_main, "b_main"), (~is_main, "b_rest"))]
    dealt = large.join(large.groupBy("key").agg(*blocks), "key")
    place = F.xxhash64("node", F.lit(1))
    block = F.when(is_main, F.pmod(place, "b_main")).otherwise(F.col("b_main") + F.pmod(place, "b_rest"))
    least = F.when(is_main, F.col("b_main")).otherwise(F.lit(0).cast("long"))
    partners = F.explode(F.sequence(least, F.col("b_main") + F.col("b_rest") - 1))
    dealt = dealt.withColumn("block", block).withColumn("partner", partners)
    pair = F.xxhash64("key", F.least("block", "partner"), F.greatest("block", "partner"))
    side = F.when(F.col("block") == F.col("partner"), -1).otherwise(F.col("block")).cast("int")
    return small.unionByName(dealt.select(pair.alias("key"), "bucket", side.alias("side"), "node", "label"))


def links(docs: DataFrame, nodes: DataFrame, sketches: DataFrame, text: str = "text", group_rows: int = GROUP_ROWS) -> DataFrame:
    """Links (node, other) between nodes that share a bucket and align."""
    wide = nodes.where("n_words > 0")
    placed = sketches.select(F.explode("sketches").alias("key"), F.xxhash64("node").alias("short"))
    # Two hashes of nodes tell whether a bucket has more than one; partial results keep a hot bucket out of one task.
    heads = placed.groupBy("key").agg(F.min("short").alias("head"), F.max("short").alias("last")).where("head <> last")
    shared = placed.join(heads.drop("last"), "key")
    named = wide.select(F.xxhash64("node").alias("short"), "node")
    # Distinct after the second join, so that adaptive execution may split a hot bucket in the first.
    members = stored(shared.join(named, "short").select("key", "node", "short", "head").distinct())
    # The bucket's node with the smallest hash stands for it.
    heads = named.select(F.col("short").alias("head"), F.col("node").alias("other"))
    pairs = members.where("short <> head").select("node", "head").distinct().join(heads, "head").select("node", "other")
    pairs = stored(screened(pairs, wide))
    words = stored(sequences(docs, wide.join(members.select("node").distinct(), "node", "left_semi"), text))
    close = stored(verified(pairs, wide, words))
    # All members of a bucket that are not linked by now meet, the ones that are like their head included.
    labels = components(close)
    labelled = members.select("key", "node").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    rest = stored(unlinked(labelled))
    small = rest.where(F.col("n") <= group_rows)
    small = small.select("key", F.col("key").alias("bucket"), F.lit(-1).alias("side"), "node", "label")
    buckets = rest.select("key", "node")
    # The labels stand for the links that gave them: one for each node, however many heads it is like.
    found = labels.where("node <> label").select("node", F.col("label").alias("other"))
    found = found.unionByName(stored(linked_within(small, buckets, words)))
    large = rest.where(F.col("n") > group_rows)
    if large.isEmpty():
        return found
    return found.unionByName(stored(linked_within(stored(in_blocks(large, wide, group_rows)), buckets, words)))


def components(edges: DataFrame) -> DataFrame:
    """The smallest node (label) that each linked node can reach.

    Each node moves to its least neighbour and on to that one's; links between the places then reached are what is
    left. So a group of many links shrinks to a few with every round.
    """
    edges = stored(edges.select(F.least("node", "other").alias("node"), F.greatest("node", "other").alias("other")).distinct())
    labels = None
    while True:
        both = edges.select("node", "other").union(edges.select(F.col("other").alias("node"), F.col("node").alias("other")))
        least = both.groupBy("node").agg(F.min("other").alias("other")).select("node", F.least("node", "other").alias("label"))
        least = stored(least)
        ahead = least.select(F.col("node").alias("label"), F.col("label").alias("ahead"))
        moved = stored(least.join(ahead, "label").select("node", F.col("ahead").alias("label")))
        if labels is None:
            labels = moved
        else:
            on = moved.select(F.col("node").alias("label"), F.col("label").alias("ahead"))
            labels = labels.join(on, "label", "left").select("node", F.coalesce("ahead", "label").alias("label"))
            labels = stored(labels)
        to = moved.select(F.col("node").alias("other"), F.col("label").alias("far"))
        edges = edges.join(moved, "node").join(to, "other").where("label <> far")
        edges = edges.select(F.least("label", "far").alias("node"), F.greatest("label", "far").alias("other"))
        edges = stored(edges.distinct())
        if edges.isEmpty():
            return labels


def classes(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per document: doc_id, text_hash, its class by label and by smallest doc_id, and the class size."""
    every = stored(sketched(docs, text))
    # One row per node; copies have equal sketches, which stay where they are.
    first = F.min(F.struct("doc_id", "text_hash")).alias("first")
    nodes = every.groupBy("node").agg(
        first, F.min("doc_id").alias("least_id"), F.count("*").alias("copies"), F.first("n_words").alias("n_words")
    )
    nodes = stored(nodes.select("node", "first.*", "least_id", "copies", "n_words"))
    labels = components(links(docs, nodes, every.select("node", "sketches"), text))
    labelled = nodes.select("node", "least_id", "copies").join(labels, "node", "left")
    labelled = labelled.withColumn("label", F.coalesce("label", "node"))
    named = labelled.groupBy("label").agg(F.min("least_id").alias("class_id"), F.sum("copies").alias("class_size"))
    # A class may hold a third of all nodes: they meet its one row in several tasks.
    named = join_unique(labelled.select("node", "label"), named, ["label"], "inner")
    return every.select("doc_id", "text_hash", "node").join(named, "node").drop("node")


def one_of_each(docs: DataFrame, text: str = "text") -> DataFrame:
    """One document of each class: the first by doc_id, with all its columns."""
    docs = docs.select(F.struct("*").alias("_row"), F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))
    docs = docs.withColumn("text_hash", F.xxhash64(whole_text()))
    found = classes(docs.select("doc_id", "text"))
    # Of equal ids the smallest text hash; a null id only where a class has no other.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("first")
    kept = found.groupBy("label").agg(first).select("first.doc_id", "first.text_hash")
    on = F.col("d.doc_id").eqNullSafe(F.col("k.doc_id")) & (F.col("d.text_hash") == F.col("k.text_hash"))
    left = docs.alias("d").join(kept.alias("k"), on, "left_semi")
    same = Window.partitionBy("doc_id", "text_hash").orderBy("doc_id")
    return left.withColumn("_place", F.row_number().over(same)).where("_place = 1").select("_row.*")
