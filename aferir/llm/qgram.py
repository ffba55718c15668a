"""Passages of a benchmark inside documents, allowing edits.

Each benchmark item is cut into overlapping segments. A segment of m characters that occurs with at most
k edits shares at least ``m + 1 - q - k * q`` q-grams with the place (the q-gram lemma), and those lie on
at most 2k + 1 neighbouring diagonals. So shared q-grams are counted in overlapping bands of diagonals
twice as wide, bands below the bound are dropped, and the rest is verified by an alignment inside the
band. A first pass over a text only asks whether any stretch has enough q-grams of the benchmark at all.

The benchmark is read in blocks of a bounded number of characters; each block is one pass over the
documents, which stay where they are.

Edge cases: null texts and items are empty and match nothing; an item shorter than q is looked for as it
is; letters are compared in lower case; repeated documents are judged alike, repeated items count as
items of their own; of alignments with equally few edits the first counts; an empty benchmark matches nothing; other columns are ignored, or kept by
``without_leaks``.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aferir.llm.common import whole_text
from aferir.llm.pii import lower

Q = 8
SEGMENT, STRIDE = 96, 48
#: Shorter segments besides, so close that any excerpt of 71 characters of a longer item holds one.
PART, STEP = 64, 8
#: One edit in so many characters is allowed.
CHARS_PER_EDIT = 12
BLOCK_CHARS = 4_000_000
#: Postings that are looked at together.
WINDOW_POSTINGS = 2_000_000
BITS = 24
MIX, BASE = 0x9E3779B97F4A7C15, 0x100000001B3


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)


def gram_hashes(text: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the q-gram at each place, built by doubling its length."""
    if len(text) < Q:
        return text[:0]
    hashes, size = text, 1
    while size < Q:
        power = np.uint64(pow(BASE, size, 1 << 64))
        hashes = hashes[:-size] * power + hashes[size:]
        size *= 2
    return hashes * np.uint64(MIX)


def budget(m: int) -> int:
    """Edits allowed in m characters: by rate, and so few that the lemma still asks for a q-gram."""
    return max(0, min(m // CHARS_PER_EDIT, (m - Q) // Q))


def needed(m: int) -> int:
    return m + 1 - Q - Q * budget(m)


def segments(m: int) -> list[tuple[int, int]]:
    """Start and end of the segments of an item; the last one ends with the item."""
    if m <= SEGMENT:
        return [(0, m)]
    sizes = (SEGMENT, STRIDE), (PART, STEP)
    return [(start, start + size) for size, step in sizes for start in [*range(0, m - size, step), m - size]]


class Index:
    """The q-grams of a block of items: each is posted once with its item and its place there.

    Segments are ranges of places: a segment and its item meet a text on the same diagonals.
    """

    def __init__(self, items: list[tuple[int | None, str]]) -> None:
        self.owner, self.texts, self.parts = [], [], []
        self.tiny: list[tuple[int | None, str]] = []
        hashes = []
        for item, text in items:
            text = lower(text)
            if 0 < len(text) < Q:
                self.tiny.append((item, text))
            if len(text) < Q:
                continue
            hashes.append(gram_hashes(codes(text)))
            self.owner.append(item)
            self.texts.append(text)
            cuts = np.array(segments(len(text)), dtype=np.int32)
            sizes = (cuts[:, 1] - cuts[:, 0]).tolist()
            numbers = [(budget(m), needed(m)) for m in sizes]
            self.parts.append(np.concatenate([cuts, np.array(numbers, dtype=np.int32)], axis=1))
        if not self.texts:
            return
        #: Width of a band, and the q-grams asked for at least, by item.
        self.step = np.array([2 * int(parts[:, 2].max()) + 1 for parts in self.parts], dtype=np.int64)
        self.least = np.array([parts[:, 3].min() for parts in self.parts], dtype=np.int64)
        self.span = max(map(len, self.texts))
        sizes = [len(grams) for grams in hashes]
        owner = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        place = np.concatenate([np.arange(n, dtype=np.int32) for n in sizes])
        hashes = np.concatenate(hashes)
        order = np.argsort(hashes, kind="stable")
        self.item, self.place, hashes = owner[order], place[order], hashes[order]
        # Postings of the n-th different hash are first[n] to first[n + 1].
        begins = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
        self.hashes, self.first = hashes[begins], np.append(begins, len(hashes))
        self.known = np.zeros(1 << BITS, dtype=bool)
        self.known[(self.hashes >> np.uint64(64 - BITS)).astype(np.int64)] = True
        longest = max(int((parts[:, 1] - parts[:, 0] + parts[:, 2]).max()) for parts in self.parts)
        self.reach, self.fewest = longest - Q + 1, int(self.least.min())

    def matches(self, source: str) -> list[tuple[int | None, int, int, int]]:
        """Item, start, end and edits of each segment found in a text."""
        text = lower(source)
        found = [
            (item, match.start(1), match.end(1), 0)
            for item, part in self.tiny
            for match in re.finditer(f"(?=({re.escape(part)}))", text)
        ]
        if not self.texts or len(text) < Q:
            return found
        grams = gram_hashes(codes(text))
        at = np.flatnonzero(self.known[(grams >> np.uint64(64 - BITS)).astype(np.int64)])
        at = at[self.crowded(at)]
        if not len(at):
            return found
        entry = np.minimum(np.searchsorted(self.hashes, grams[at]), len(self.hashes) - 1)
        real = self.hashes[entry] == grams[at]
        at, entry = at[real], entry[real]
        near = self.crowded(at)
        at, entry = at[near], entry[near]
        for window in self.windows(at, self.first[entry + 1] - self.first[entry]):
            for item, band in self.bands(at[window], entry[window]):
                found += self.verified(text, item, *band)
        return found

    def crowded(self, at: np.ndarray) -> np.ndarray:
        """Which places lie in a stretch as long as the longest segment that holds enough of them."""
        spare = self.fewest - 1
        if len(at) <= spare:
            return np.zeros(len(at), dtype=bool)
        dense = at[spare:] - at[: len(at) - spare] < self.reach
        cover = np.zeros(len(at) + 1, dtype=np.int64)
        cover[: len(dense)] += dense
        cover[spare + 1 :] -= dense
        return np.cumsum(cover[:-1]) > 0

    def windows(self, at: np.ndarray, postings: np.ndarray) -> Iterator[slice]:
        """Stretches of a text with a bounded number of postings; what a segment can reach is whole in one of them."""
        total = np.concatenate([[0], np.cumsum(postings)])
        waiting = [(0, len(at))]
        while waiting:
            low, high = waiting.pop()
            if low >= high:
                continue
            length = int(at[high - 1] - at[low]) + 1
            if total[high] - total[low] <= WINDOW_POSTINGS or length <= 4 * self.reach:
                yield slice(low, high)
                continue
            middle = int(at[low]) + length // 2
            waiting.append((low, int(np.searchsorted(at, middle + self.reach))))
            waiting.append((int(np.searchsorted(at, middle)), high))

    def bands(self, at: np.ndarray, entry: np.ndarray) -> Iterator[tuple[int, tuple[int, int, np.ndarray]]]:
        """Items, bands of diagonals (low, high) and the segments that share enough q-grams there."""
        low, n = self.first[entry], self.first[entry + 1] - self.first[entry]
        if not len(n):
            return
        hit = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
        item, place = self.item[hit].astype(np.int64), self.place[hit].astype(np.int64)
        band = (np.repeat(at, n) - place) // self.step[item]
        lowest = int(band.min())
        band -= lowest
        width = int(band.max()) + 2
        keys = (item * width + band) * self.span + place
        keys.sort()
        keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])]
        cell = keys // self.span
        begins = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
        cells, ends = cell[begins], np.append(begins[1:], len(cell))
        # A band is two steps wide, so that it holds all diagonals of a segment wherever they begin.
        follows = np.append(cells[1:] == cells[:-1] + 1, False)
        ends = np.where(follows, np.append(ends[1:], len(cell)), ends)
        for c in np.flatnonzero(ends - begins >= self.least[cells // width]).tolist():
            number = int(cells[c] // width)
            parts, step = self.parts[number], int(self.step[number])
            places = np.unique(keys[begins[c] : ends[c]] % self.span)
            shared = np.searchsorted(places, parts[:, 1] - Q + 1) - np.searchsorted(places, parts[:, 0])
            good = parts[shared >= parts[:, 3]]
            if len(good):
                diagonal = (int(cells[c] % width) + lowest) * step
                yield number, (diagonal, diagonal + 2 * step, good)

    def verified(self, text: str, item: int, low: int, high: int, parts: np.ndarray) -> Iterator[tuple[int | None, int, int, int]]:
        """The segments that align with the text inside the band within their edits."""
        for begin, end, edits, _ in parts.tolist():
            part = self.texts[item][begin:end]
            # A segment's own diagonals are its item's, moved by its start.
            start = max(0, low + begin - edits)
            region = text[start : max(0, high + end + edits)]
            exact = region.find(part)
            if exact >= 0:
                yield self.owner[item], start + exact, start + exact + len(part), 0
                continue
            best = align(codes(part), codes(region), low + begin - edits - start, high + begin + edits - start)
            if best is not None and best[0] <= edits:
                yield self.owner[item], max(0, start + best[1] - len(part)), start + best[1], best[0]


def align(part: np.ndarray, region: np.ndarray, low: int, high: int) -> tuple[int, int] | None:
    """Least edits of ``part`` against a substring of ``region``, and the end of that substring.

    Cell (i, d) compares the first i characters of the part with the region up to i + d; only diagonals
    from low to high are filled, and the alignment may start on any of them.
    """
    diagonals = np.arange(low, high + 1)
    far = len(part) + len(region) + 1
    inside = lambda i: (i + diagonals >= 0) & (i + diagonals <= len(region))
    padded = np.concatenate([region, [np.uint64(0)]])
    slope = np.arange(len(diagonals))
    row = np.where(inside(0), 0, far)
    for i, char in enumerate(part.tolist(), start=1):
        column = np.clip(i + diagonals - 1, 0, len(region))
        step = row + (padded[column] != char)
        step[i + diagonals - 1 < 0] = far
        step[:-1] = np.minimum(step[:-1], row[1:] + 1)  # a character of the part is left out
        step = np.where(inside(i), step, far)
        row = np.minimum.accumulate(step - slope) + slope  # characters of the region are left out
        row = np.where(inside(i), np.minimum(step, row), far)
    best = int(row.argmin())
    return None if row[best] >= far else (int(row[best]), len(part) + low + best)


def benchmark_blocks(benchmark: DataFrame, text: str = "text") -> Iterator[Index]:
    """Indexes of the items, a bounded number of characters each."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), whole_text(text).alias("text"))
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-total // BLOCK_CHARS)
    for block in range(n):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == block).collect()
        yield Index([(row["item_id"], row["text"]) for row in rows])


REGIONS = "doc_id long, item_id long, start long, end long, n_segments long, edits long"


def clusters(parts: dict[tuple[int, int], int]) -> list[tuple[int, int, int, int]]:
    """Start, end, number of segments and sum of their edits of each stretch of overlapping segments."""
    found: list[list[int]] = []
    for (start, end), edits in sorted(parts.items()):
        if found and start < found[-1][1]:
            last = found[-1]
            last[1], last[2], last[3] = max(last[1], end), last[2] + 1, last[3] + edits
        else:
            found.append([start, end, 1, edits])
    return [tuple(stretch) for stretch in found]


def leaked_regions(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """One row per document, item and stretch of overlapping segments found: its place in code points and what was verified."""
    spark = docs.sparkSession
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text(text).alias("text"))
    found = spark.createDataFrame([], REGIONS)
    for index in benchmark_blocks(benchmark, text):
        shared = spark.sparkContext.broadcast(index)

        def search(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            for batch in batches:
                rows = []
                for doc, body in zip(batch["doc_id"], batch["text"], strict=True):
                    regions = defaultdict(dict)
                    for item, start, end, edits in shared.value.matches(body):
                        # Two bands may show one region.
                        regions[item][start, end] = edits
                    for item, parts in regions.items():
                        rows += [(doc, item, *cluster) for cluster in clusters(parts)]
                frame = pd.DataFrame(rows, columns=[field.split()[0] for field in REGIONS.split(", ")])
                yield frame.astype("Int64")

        found = found.unionByName(source.mapInPandas(search, REGIONS))
    return found


def clean_of(index: Broadcast):
    """A filter for texts that hold nothing of an index."""

    @F.pandas_udf("boolean")
    def clean(texts: pd.Series) -> pd.Series:
        return texts.map(lambda body: not index.value.matches(body)).astype(bool)

    return clean


def without_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents that hold no passage of the benchmark, with all their columns."""
    for index in benchmark_blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(index)
        docs = docs.where(clean_of(shared)(whole_text(text)))
    return docs
