"""Runs (maximal repetitions) of words, found on a grammar of each text.

The word ids of a text are compressed by Re-Pair: pairs of neighbouring symbols that occur twice or more
become nonterminals, most frequent first. A pass replaces every pair that is more frequent than the pairs
it overlaps, so the passes of many texts go together in numpy; the symbols that are left get a balanced
tree. Every run lies across the boundary of exactly one lowest node. For each nonterminal the runs across
its boundary are computed once, within its own expansion: a run of period q and at least twelve words has
six or more matches at distance q around the boundary, so three words that start or end there occur again
at distance q, and the run's ends follow from exact longest common extensions. These runs are moved to all
positions of the nonterminal, overlapping ones of a period are merged, and of equal intervals the smallest
period stays.

A text is handled by one task, texts in units of about ``UNIT_WORDS`` words (a longer text is a unit of
its own), so memory is bounded by the longest text. No shuffle.

Edge cases: a null text is empty and has no runs; null and repeated ids give a row each; equal texts give
equal runs; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aferir.llm.common import whole_text

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: A run has at least so many words, and at least twice its period.
LEAST = 12
#: Words that form an anchor beside a boundary: half of LEAST / 2 matches, as they may lie on either side.
ANCHOR = 3
#: Words of a unit, and candidates that are extended at once.
UNIT_WORDS, CANDIDATES = 400_000, 2_000_000

SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def shared_ids(codes: np.ndarray) -> np.ndarray:
    """A number for each value that occurs twice or more; -1 for values that occur once."""
    if not len(codes):
        return np.empty(0, np.int64)
    order = np.argsort(codes, kind="stable")
    found = codes[order]
    first = np.empty(len(found), bool)
    first[0] = True
    np.not_equal(found[1:], found[:-1], out=first[1:])
    group = np.cumsum(first) - 1
    sizes = np.diff(np.append(np.flatnonzero(first), len(found)))
    out = np.empty(len(codes), np.int64)
    out[order] = np.where(sizes[group] > 1, group, -1)
    return out


class Extensions:
    """Exact longest common extensions: numbers of all blocks of 1, 2, 4, ... words that occur again."""

    def __init__(self, words: np.ndarray) -> None:
        self.n = n = len(words)
        self.levels = [shared_ids(words)]
        size = 1
        while True:
            below = self.levels[-1]
            at = np.flatnonzero(below[: max(n - size, 0)] >= 0)
            at = at[below[at + size] >= 0]
            found = shared_ids(below[at] * n + below[at + size])
            if not (found >= 0).any():
                break
            level = np.full(n, -1, np.int64)
            level[at] = found
            self.levels.append(level)
            size *= 2

    def anchors(self) -> np.ndarray:
        """A number for each position whose next ANCHOR words occur again; -1 for others."""
        out = np.full(self.n, -1, np.int64)
        if len(self.levels) > 1:
            pairs, words = self.levels[1], self.levels[0]
            at = np.flatnonzero(pairs[: self.n - 2] >= 0)
            at = at[words[at + 2] >= 0]
            out[at] = shared_ids(pairs[at] * self.n + words[at + 2])
        return out

    def forward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Equal words from i and from j on."""
        i, j, begun = i.copy(), j.copy(), i
        for k in range(len(self.levels) - 1, -1, -1):
            level, inside = self.levels[k], np.maximum(i, j) < self.n
            a, b = level[np.where(inside, i, 0)], level[np.where(inside, j, 0)]
            step = np.where(inside & (a >= 0) & (a == b), 1 << k, 0)
            i, j = i + step, j + step
        return i - begun

    def backward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Equal words before i and before j."""
        i, j, begun = i.copy(), j.copy(), i
        for k in range(len(self.levels) - 1, -1, -1):
            level, size = self.levels[k], 1 << k
            inside = np.minimum(i, j) >= size
            a, b = level[np.where(inside, i - size, 0)], level[np.where(inside, j - size, 0)]
            step = np.where(inside & (a >= 0) & (a == b), size, 0)
            i, j = i - step, j - step
        return begun - i


class Grammar:
    """Re-Pair grammar of the texts of a unit: nodes (start, boundary, end) of their first place in the
    unit, and the places of each. Nodes too short for a run are left out."""

    def __init__(self, words: np.ndarray, ends: np.ndarray) -> None:
        self.nodes: list[np.ndarray] = []  # rows of start, boundary, end
        self.places: list[tuple[np.ndarray, np.ndarray]] = []  # node number, start
        self.n_nodes = 0
        self._tree(*self._pairs(words), ends)

    def _keep(self, start: np.ndarray, boundary: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Number the nodes long enough for a run; -1 for others."""
        long = end - start >= LEAST
        number = np.where(long, self.n_nodes + np.cumsum(long) - 1, -1)
        self.nodes.append(np.stack([start[long], boundary[long], end[long]]))
        self.n_nodes += int(long.sum())
        return number

    def _pairs(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        symbols, starts = words.copy(), np.arange(len(words) + 1)
        following = int(words.max(initial=-1)) + 1
        live = np.ones(max(len(symbols) - 1, 0), bool)  # pairs that may occur again
        while True:
            usable = live.copy()
            same = symbols[:-1] == symbols[1:]
            if same.any():
                # In a stretch of equal symbols every second pair counts, as the others overlap.
                index = np.arange(len(same))
                begins = same & ~np.concatenate([[False], same[:-1]])
                usable &= ~same | ((index - np.maximum.accumulate(np.where(begins, index, 0))) % 2 == 0)
            at = np.flatnonzero(usable)
            if not len(at):
                break
            kinds, inverse, counts = np.unique(
                symbols[at] * following + symbols[at + 1], return_inverse=True, return_counts=True
            )
            weight = np.zeros(len(symbols) + 1, np.int64)  # of the pair at i, at place i + 1
            weight[at + 1] = np.where(counts > 1, counts * len(kinds) + np.arange(len(kinds)), 0)[inverse]
            chosen = (weight[at + 1] > 0) & (weight[at + 1] > weight[at]) & (weight[at + 1] > weight[at + 2])
            taken = np.bincount(inverse[chosen], minlength=len(kinds))
            chosen &= taken[inverse] > 1
            if not chosen.any():
                break
            live[at] = counts[inverse] > 1
            rules, rule, first = self._rules(inverse[chosen], at[chosen])
            where = at[chosen]
            numbers = self._keep(starts[first], starts[first + 1], starts[first + 2])
            long = numbers[rule] >= 0
            self.places.append((numbers[rule][long], starts[where][long]))
            symbols[where] = following + rule
            following += len(rules)
            live[where[where < len(live)]] = True
            live[where[where > 0] - 1] = True
            keep = np.ones(len(symbols), bool)
            keep[where + 1] = False
            symbols, starts = symbols[keep], starts[np.append(keep, True)]
            live = live[keep[:-1]][: len(symbols) - 1]
        return symbols, starts

    @staticmethod
    def _rules(kind: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The kinds, the rule of each chosen pair, and the first place of each rule."""
        rules, first, rule = np.unique(kind, return_index=True, return_inverse=True)
        return rules, rule, at[first]

    def _tree(self, symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        """A balanced tree over the symbols left of each text; no symbol lies in two texts."""
        if not len(symbols):
            return
        text = np.searchsorted(ends, starts[:-1], side="right")
        begins = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
        stops = np.append(begins[1:], len(symbols))
        size = 2
        while True:
            halves = (stops - begins + size // 2 - 1) // size  # blocks with something in their second half
            if not halves.any():
                break
            block = np.arange(halves.sum()) - np.repeat(np.cumsum(halves) - halves, halves)
            left = np.repeat(begins, halves) + block * size
            right = np.minimum(left + size, np.repeat(stops, halves))
            numbers = self._keep(starts[left], starts[left + size // 2], starts[right])
            long = numbers >= 0
            self.places.append((numbers[long], starts[left][long]))
            size *= 2


def _ranges(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers low <= i < high of each row, and the row of each."""
    sizes = np.maximum(high - low, 0)
    row = np.repeat(np.arange(len(low)), sizes)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + low[row]


def crossing(ext: Extensions, nodes: np.ndarray) -> np.ndarray:
    """Runs across the boundary of each node, inside the node: rows of node, start, end, period."""
    anchor = ext.anchors()
    marked = np.flatnonzero(anchor >= 0)
    by_anchor = marked[np.argsort(anchor[marked], kind="stable")]
    key = anchor[by_anchor] * (ext.n + 1) + by_anchor
    left, middle, right = nodes
    found = []
    # Anchors that start at the boundary, and those that end there.
    for shift in (0, ANCHOR):
        place = middle - shift
        usable = (place >= left) & (place + ANCHOR <= right)
        usable[usable] = anchor[place[usable]] >= 0
        rows = np.flatnonzero(usable)
        code = anchor[place[rows]] * (ext.n + 1)
        low = np.searchsorted(key, code + left[rows])
        high = np.searchsorted(key, code + right[rows] - ANCHOR + 1)
        total = np.cumsum(high - low)
        # In blocks, so that texts of few words need no more memory than others.
        for block in np.split(np.arange(len(rows)), np.searchsorted(total, np.arange(CANDIDATES, total[-1], CANDIDATES)) if len(rows) else []):
            part, other = _ranges(low[block], high[block])
            node = rows[block][part]
            period = by_anchor[other] - place[node]
            fits = (period != 0) & (2 * np.abs(period) <= right[node] - left[node])
            node, period = node[fits], period[fits]
            at = middle[node]
            ahead, behind = ext.forward(at, at + period), ext.backward(at, at + period)
            start = np.maximum(at - behind + np.minimum(period, 0), left[node])
            end = np.minimum(at + ahead + np.maximum(period, 0), right[node])
            period = np.abs(period)
            enough = end - start >= np.maximum(2 * period, LEAST)
            found.append(smallest(np.stack([node, start, end, period])[:, enough]))
    return smallest(np.concatenate(found, axis=1)) if found else np.empty((4, 0), np.int64)


def smallest(rows: np.ndarray) -> np.ndarray:
    """One row for each node, start and end: that with the smallest period."""
    rows = rows[:, np.lexsort((rows[3], rows[2], rows[1], rows[0]))]
    new = np.ones(rows.shape[1], bool)
    new[1:] = (rows[:3, 1:] != rows[:3, :-1]).any(axis=0)
    return rows[:, new]


def unit_runs(words: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All runs of a unit, rows of start, end and period, by start and period.

    ``words`` are numbers that differ between texts, ``ends`` the end of each text.
    """
    if not len(words):
        return np.empty((3, 0), np.int64)
    grammar, ext = Grammar(words, ends), Extensions(words)
    nodes = np.concatenate(grammar.nodes, axis=1) if grammar.nodes else np.empty((3, 0), np.int64)
    node, start, end, period = crossing(ext, nodes)
    if not len(node):
        return np.empty((3, 0), np.int64)
    # To all places of each node that has runs.
    number = np.concatenate([n for n, _ in grammar.places])
    place = np.concatenate([p for _, p in grammar.places])
    wanted = np.zeros(grammar.n_nodes, bool)
    wanted[node] = True
    number, place = number[wanted[number]], place[wanted[number]]
    low, high = np.searchsorted(node, number), np.searchsorted(node, number, side="right")
    which, run = _ranges(low, high)
    moved = place[which] - nodes[0][node[run]]
    return merged(start[run] + moved, end[run] + moved, period[run])


def merged(start: np.ndarray, end: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Join intervals of one period that overlap by a period or more; of equal intervals the smallest period stays."""
    order = np.lexsort((-end, start, period))
    start, end, period = start[order], end[order], period[order]
    kind = np.cumsum(np.append(False, period[1:] != period[:-1]))
    span = int(end.max()) + 1
    reach = np.maximum.accumulate(end + kind * span) - kind * span
    new = np.append(True, (period[1:] != period[:-1]) | (start[1:] > reach[:-1] - period[1:]))
    first = np.flatnonzero(new)
    rows = np.stack([np.zeros(len(first), np.int64), start[first], np.maximum.reduceat(end, first), period[first]])
    rows = smallest(rows)[1:]
    return rows[:, np.lexsort((rows[2], rows[0]))]


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Whether each word stays: those of a run after its first period go."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, runs[0] + runs[2], 1)
    np.add.at(change, runs[1], -1)
    return np.cumsum(change[:-1]) == 0


def _unit(texts: list[list[str]]) -> Iterator[tuple[int, list[tuple[int, int, int]], str]]:
    """Number of words, runs and collapsed text of each text of a unit."""
    sizes = np.array([len(words) for words in texts])
    ends = np.cumsum(sizes)
    numbers = {word: i for i, word in enumerate(dict.fromkeys(chain.from_iterable(texts)))}
    ids = np.fromiter(map(numbers.__getitem__, chain.from_iterable(texts)), np.int64, int(sizes.sum()))
    ids += np.repeat(np.arange(len(texts)), sizes) * len(numbers)
    runs = unit_runs(np.unique(ids, return_inverse=True)[1].astype(np.int64), ends)
    stay = kept_words(len(ids), runs)
    cuts = np.searchsorted(runs[0], np.append(0, ends))
    for i, words in enumerate(texts):
        begin, mine = int(ends[i] - sizes[i]), runs[:, cuts[i] : cuts[i + 1]]
        if mine.shape[1]:
            words = [word for word, here in zip(words, stay[begin : int(ends[i])].tolist(), strict=True) if here]
        rows = list(zip((mine[0] - begin).tolist(), (mine[1] - mine[0]).tolist(), mine[2].tolist(), strict=True))
        yield int(sizes[i]), rows, " ".join(words)


def word_runs(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, the runs (start, length, period; by start, then period) and the text without the
    words of a run after its first period, for every row of ``docs``."""

    def units(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            at, texts, size = 0, [], 0
            for i, text in enumerate(batch["text"]):
                texts.append(WORD.findall(text))
                size += len(texts[-1])
                if size >= UNIT_WORDS or i == len(batch) - 1:
                    found = pd.DataFrame(_unit(texts), columns=["n_words", "runs", "collapsed"])
                    found["runs"] = [[dict(zip(("start", "length", "period"), run, strict=True)) for run in runs] for runs in found["runs"]]
                    found.insert(0, "doc_id", batch["doc_id"].iloc[at : i + 1].astype("Int64").array)
                    yield found
                    at, texts, size = i + 1, [], 0

    return docs.select(F.col("doc_id").cast("long"), whole_text().alias("text")).mapInPandas(units, SCHEMA)


def longest_run() -> F.Column:
    """The run of ``runs`` with the greatest length; ties: smallest start, then period. Null without runs."""
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    return F.struct(best["start"].alias("start"), (-best["less"]).alias("length"), best["period"].alias("period"))


def planted_tails(docs: DataFrame) -> DataFrame:
    """Documents whose number says so get a periodic tail; the others stay as they are.

    With h the crc32 of the decimal id: if h ends in 0, each word i >= a becomes word a + (i - a) % p,
    where a = (h / 10) % n and p = 1 + (n - a) / (3 + (h / 10) % 8), in whole numbers.
    """
    number = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split(whole_text(), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    tailed = docs.withColumns({"_h": number, "_w": F.when(number % 10 == 0, words)}).withColumn("_n", F.size("_w"))
    tailed = tailed.withColumn("_a", F.expr("if(_n > 0, (_h div 10) % _n, 0)"))
    tailed = tailed.withColumn("_p", F.expr("1 + (_n - _a) div (3 + (_h div 10) % 8)"))
    moved = F.expr("transform(_w, (w, i) -> if(i < _a, w, _w[int(_a + (i - _a) % _p)]))")
    text = F.when(F.col("_n") > 0, F.array_join(moved, " ")).otherwise(F.col("text"))
    return tailed.withColumn("text", text).drop("_h", "_w", "_n", "_a", "_p")
