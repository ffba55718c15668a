"""Subword segmentation with seeded merge-dropout, and decoding that gives the text back.

A merge-type model (pieces with scores, byte fallback) is applied by an agenda of candidate merges, best
score first. Each candidate is skipped with the dropout rate, by a hash of seed, document and the word's
place; a skipped candidate may come up again only when a neighbour changes. Every occurrence of a word is
drawn on its own: the number of candidates up to the next skipped one is geometric, so what is remembered
is a word's pieces for given skips, while every run with the same seed gives the same pieces.

No piece spans the start of a word, a line feed or the end of a word before a sign (the pieces are
checked for it), so words are segmented on their own and remembered.
A blank is written as U+2581 with one in front of the text; U+2581 itself and characters that are no
piece are written as bytes, so decoding is lossless for every text.

Edge cases: a null or empty text has no pieces; of candidates with equal scores the leftmost comes first;
repeated rows with one key give the same pieces; other columns are ignored; lone surrogates cannot occur in a table of UTF-8 text.
"""

from __future__ import annotations

import heapq
import math
import re
import zlib
from array import array
from collections.abc import Callable, Iterable, Iterator, Sequence
from operator import itemgetter

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aferir.llm.common import Remembered, whole_text

SPACE = "▁"
LETTER = re.compile(r"[^\W\d_]")
REMEMBERED = 600_000
#: No variants: each occurrence of a word is drawn on its own. A number is the most ways to cut a word.
DROPOUT, SEED, VARIANTS = 0.1, 17, 0
#: Words up to this length are cut side by side, so many at a time; longer ones one by one with a heap.
SHORT, BLOCK = 48, 6_000
#: Words remembered, and characters of the texts that are cut together.
WORDS, UNIT_CHARS = 400_000, 1_500_000
#: The same, and the texts that are encoded at once, where workers also hold what other operators left.
WORDS_BESIDE, UNIT_BESIDE, ENCODED_ROWS = 150_000, 300_000, 500
NEVER = 1 << 30
#: Odd numbers that mix bits.
STEP, PLACE, PIECE, SPREAD, MASK = 0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x2C1B3C6D, 0xFFFFFFFF
STEP_64, MIX_64, MASK_64 = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xFFFFFFFFFFFFFFFF


def chunks(pieces: Iterable[str]) -> re.Pattern:
    """Parts of a text that no piece can cross: blanks and signs with the word after them, or alone.

    A text may be cut in front of a blank after anything else, around line feeds, and after a letter in
    front of anything but a letter. Letters that some piece has in front of another character are not
    cut from it.
    """
    pairs = {pair for piece in pieces for pair in zip(piece, piece[1:])}
    if any(b == SPACE != a or "\n" in (a, b) for a, b in pairs):
        raise ValueError("pieces of this model cross the starts of words or lines")
    odd = "".join(sorted(re.escape(a) for a, b in pairs if b != SPACE and LETTER.match(a) and not LETTER.match(b)))
    letter, other = rf"[^\W\d_{odd}]", rf"(?:[\d_{odd}]|[^\w{SPACE}\n])"
    return re.compile(rf"{SPACE}*+{other}*+{letter}++|{SPACE}*+{other}++|{SPACE}++|\n++")


class Pieces:
    """The pieces of a model file: ids, scores, and what each decodes to."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        scores: dict[str, float] = {}
        self.id: dict[str, int] = {}
        self.data: list[bytes] = []
        self.byte = [0] * 256
        for number in range(model.vocab_size()):
            name = model.id_to_piece(number)
            if model.is_byte(number):
                self.byte[int(name[3:5], 16)] = number
                self.data.append(bytes([int(name[3:5], 16)]))
            elif model.is_control(number) or model.is_unknown(number) or model.is_unused(number):
                self.data.append(b"")
            else:
                self.id[name], scores[name] = number, model.get_score(number)
                self.data.append(name.replace(SPACE, " ").encode())
        # The best score has rank 0; equal scores have one rank.
        places = {score: place for place, score in enumerate(sorted(set(scores.values()), reverse=True))}
        self.rank = {name: places[score] for name, score in scores.items()}

        self.chunk = chunks(self.rank)
        self.agendas = Agendas(self)

    def spelled(self, symbol: str) -> list[int]:
        """Ids of the bytes of a symbol."""
        return [self.byte[b] for b in symbol.encode("utf-8", "surrogatepass")]

    def cut(self, word: str, dropout: float, key: int) -> list[str]:
        """Symbols of a word after all merges that the agenda offers and the hash does not skip.

        A merge is skipped when a mix of the word's hash, its place and the piece's rank is below the limit.
        """
        limit = int(dropout * 2**32)
        base = xxhash.xxh32_intdigest(word.encode("utf-8", "surrogatepass"), key) if limit else 0
        return self._short(word, limit, base) if len(word) <= SHORT else self._long(word, limit, base)

    def _short(self, word: str, limit: int, base: int) -> list[str]:
        """The agenda as a list with a place for each pair of neighbours."""
        rank = self.rank
        symbols, starts = list(word), list(range(len(word)))
        agenda = [rank.get(a + b, NEVER) for a, b in zip(symbols, symbols[1:])]
        while agenda and (least := min(agenda)) < NEVER:
            at = agenda.index(least)
            if limit:
                mixed = (base ^ starts[at] * PLACE ^ least * PIECE) & MASK
                if (mixed ^ mixed >> 15) * SPREAD & MASK < limit:
                    agenda[at] = NEVER
                    continue
            merged = symbols[at] + symbols.pop(at + 1)
            symbols[at] = merged
            del agenda[at], starts[at + 1]
            if at:
                agenda[at - 1] = rank.get(symbols[at - 1] + merged, NEVER)
            if at < len(agenda):
                agenda[at] = rank.get(merged + symbols[at + 1], NEVER)
        return symbols

    def skipping(self, word: str, skips: tuple[int, ...]) -> tuple[list[str], int]:
        """Symbols of a word without the candidates at the given turns, and the number of turns."""
        rank = self.rank
        symbols = list(word)
        agenda = [rank.get(a + b, NEVER) for a, b in zip(symbols, symbols[1:])]
        turn = 0
        while agenda and (least := min(agenda)) < NEVER:
            at = agenda.index(least)
            turn += 1
            if turn - 1 in skips:
                agenda[at] = NEVER
                continue
            merged = symbols[at] + symbols.pop(at + 1)
            symbols[at] = merged
            del agenda[at]
            if at:
                agenda[at - 1] = rank.get(symbols[at - 1] + merged, NEVER)
            if at < len(agenda):
                agenda[at] = rank.get(merged + symbols[at + 1], NEVER)
        return symbols, turn

    def numbers(self, symbols: list[str]) -> bytes:
        """Ids of symbols as bytes."""
        ids = []
        for symbol in symbols:
            found = self.id.get(symbol)
            if found is None:
                ids += self.spelled(symbol)
            else:
                ids.append(found)
        return array("H", ids).tobytes()

    def _long(self, word: str, limit: int, base: int) -> list[str]:
        """The same with a heap, for words of any length."""
        symbols: list[str | None] = list(word)
        n = len(symbols)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda: list[tuple[int, int, str]] = []

        def offer(left: int) -> None:
            right = after[left]
            if right < n and (rank := self.rank.get(symbols[left] + symbols[right])) is not None:
                heapq.heappush(agenda, (rank, left, symbols[left] + symbols[right]))

        for place in range(n - 1):
            offer(place)
        while agenda:
            rank, left, merged = heapq.heappop(agenda)
            right = after[left] if symbols[left] is not None else n
            if right >= n or symbols[left] + symbols[right] != merged:
                continue  # one of the two has merged with another since
            mixed = (base ^ left * PLACE ^ rank * PIECE) & MASK
            if (mixed ^ mixed >> 15) * SPREAD & MASK < limit:
                continue
            symbols[left], symbols[right] = merged, None
            after[left] = after[right]
            if after[left] < n:
                before[after[left]] = left
            if before[left] >= 0:
                offer(before[left])
            offer(left)
        return [symbol for symbol in symbols if symbol is not None]


class Agendas:
    """The agendas of many words side by side: a row of symbols for each, one turn of all words at a time.

    Symbols are numbers: pieces and the characters of pieces; a character of no piece is its negative code
    point. What two neighbours merge to, and its rank, is looked up in a table by open addressing.
    """

    def __init__(self, pieces: Pieces) -> None:
        self.pieces = pieces
        names = list(dict.fromkeys([*pieces.rank, *sorted({c for piece in pieces.rank for c in piece})]))
        self.names, number = names, {name: i for i, name in enumerate(names)}
        self.size = len(names)
        # Ids of pieces; a character that is no piece is written as bytes.
        self.ids = np.array([pieces.id.get(name, -1) for name in names], np.int64)
        self.of_character = -np.arange(0x110000, dtype=np.int32) - 1
        for name in names:
            if len(name) == 1:
                self.of_character[ord(name)] = number[name]
        merges = {}
        for piece, rank in pieces.rank.items():
            for cut in range(1, len(piece)):
                left, right = number.get(piece[:cut]), number.get(piece[cut:])
                if left is not None and right is not None:
                    merges[left * self.size + right] = (rank, number[piece])
        self.bits = max(4, (4 * len(merges)).bit_length())
        self.keys = np.full((1 << self.bits) + 64, -1, np.int64)
        self.rank, self.merged = np.full(len(self.keys), NEVER, np.int32), np.full(len(self.keys), -1, np.int32)
        for key, (rank, into) in merges.items():
            slot = ((key * STEP_64) & MASK_64) >> (64 - self.bits)
            while self.keys[slot] >= 0:
                slot += 1
            self.keys[slot], self.rank[slot], self.merged[slot] = key, rank, into

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and number of what each pair merges to; NEVER where it does not."""
        key = np.where((left >= 0) & (right >= 0), left.astype(np.int64) * self.size + right, -2).ravel()
        slot = ((key.astype(np.uint64) * np.uint64(STEP_64)) >> np.uint64(64 - self.bits)).astype(np.int64)
        found = self.keys[slot]
        rows = np.flatnonzero((found != key) & (found >= 0))
        while len(rows):
            slot[rows] += 1
            found = self.keys[slot[rows]]
            rows = rows[(found != key[rows]) & (found >= 0)]
        hit = self.keys[slot] == key
        return (
            np.where(hit, self.rank[slot], NEVER).reshape(left.shape),
            np.where(hit, self.merged[slot], -1).reshape(left.shape),
        )

    def cut(self, words: list[str], gaps: np.ndarray, own: np.ndarray, draw: Callable) -> tuple[list[bytes], np.ndarray]:
        """Ids of each word as bytes, and how many symbols it has; a gap below zero means no skip at all."""
        out: list[bytes] = [b""] * len(words)
        left = np.zeros(len(words), np.int64)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(sizes, kind="stable")
        # Words of like length together, so that short ones are not padded to the longest.
        for rows in np.split(order, np.searchsorted(sizes[order], (5, 8, 11, 15, 22, 33))):
            for block in (rows[i : i + BLOCK] for i in range(0, len(rows), BLOCK)):
                self._block(block, [words[i] for i in block.tolist()], gaps[block], own[block], draw, out, left)
        return out, left

    def _block(self, rows, words, gaps, own, draw, out, left) -> None:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        width = int(sizes.max()) + 1
        places = np.arange(width)
        symbols = np.full((len(words), width), -NEVER, np.int32)
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        symbols[places < sizes[:, None]] = self.of_character[codes]
        ranks, merged = self.look_up(symbols[:, :-1], symbols[:, 1:])
        while len(rows):
            at = ranks.argmin(axis=1)
            here = np.arange(len(rows))
            going = ranks[here, at] < NEVER
            if not going.all():
                self._write(rows[~going], symbols[~going], sizes[~going], out, left)
                rows, symbols, ranks, merged, sizes, gaps, own, at = (
                    x[going] for x in (rows, symbols, ranks, merged, sizes, gaps, own, at)
                )
                here = np.arange(len(rows))
                if not len(rows):
                    break
            skip = np.flatnonzero(gaps == 0)
            take = np.flatnonzero(gaps != 0)
            if len(skip):
                ranks[skip, at[skip]] = NEVER
                gaps[skip], own[skip] = draw(own[skip])
            gaps[take] -= 1
            # The pair becomes one symbol; what follows moves one place to the left.
            spot = at[take]
            whole = symbols[take]
            into = merged[take, spot]
            moved = places + (places > spot[:, None])
            moved[:, -1] = width - 1
            whole = np.take_along_axis(whole, moved, axis=1)
            whole[:, -1] = -NEVER
            line = here[: len(take)]
            whole[line, spot] = into
            symbols[take] = whole
            ranks[take] = np.take_along_axis(ranks[take], np.minimum(moved[:, :-1], width - 2), axis=1)
            merged[take] = np.take_along_axis(merged[take], np.minimum(moved[:, :-1], width - 2), axis=1)
            sizes[take] -= 1
            ranks[take, sizes[take] - 1] = NEVER
            new_rank, new_into = self.look_up(into, whole[line, spot + 1])
            ranks[take, spot], merged[take, spot] = new_rank, new_into
            inner = np.flatnonzero(spot > 0)
            new_rank, new_into = self.look_up(whole[inner, spot[inner] - 1], into[inner])
            ranks[take[inner], spot[inner] - 1], merged[take[inner], spot[inner] - 1] = new_rank, new_into

    def _write(self, rows, symbols, sizes, out, left) -> None:
        left[rows] = sizes
        filled = np.arange(symbols.shape[1]) < sizes[:, None]
        ids = np.where(symbols >= 0, self.ids[np.maximum(symbols, 0)], -1)
        odd = (filled & (ids < 0)).any(axis=1)
        flat, ends = ids[filled & ~odd[:, None]].astype("<u2").tobytes(), np.cumsum(np.where(odd, 0, sizes)) * 2
        for row, end, size in zip(rows[~odd].tolist(), ends[~odd].tolist(), sizes[~odd].tolist(), strict=True):
            out[row] = flat[end - 2 * size : end]
        for i in np.flatnonzero(odd).tolist():
            found = [self.names[x] if x >= 0 else chr(-x - 1) for x in symbols[i, : sizes[i]].tolist()]
            out[rows[i]] = self.pieces.numbers(found)


class Segmenter(dict):
    """Ids of (variant, word) as bytes (unsigned 16-bit integers), kept for the life of a worker."""

    def __init__(self, path: str, dropout: float, seed: int, variants: int, remembered: int = WORDS) -> None:
        super().__init__()
        self.remembered = remembered
        self.pieces, self.dropout, self.seed, self.variants = Pieces(path), dropout, seed, variants
        # One memory per variant, so that a word is the only key to look up.
        self.memories = [Memory(self, variant) for variant in range(variants)]
        self.whole: dict[str, tuple[bytes, int]] = {}
        self.scale = math.log1p(-dropout) if 0 < dropout < 1 else 0.0

    def ids(self, text: str, key: object) -> np.ndarray:
        """Ids of a whole text; ``key`` (a document's id) chooses the skips."""
        return next(self.ids_of([text], [key]))

    def ids_of(self, texts: Sequence[str], keys: Sequence[object], unit: int = UNIT_CHARS) -> Iterator[np.ndarray]:
        """Ids of many texts, in units of about so many characters that are cut together."""
        begun, size = 0, 0
        for i, text in enumerate(texts):
            size += len(text)
            if size >= unit or i == len(texts) - 1:
                yield from self._unit(texts[begun : i + 1], keys[begun : i + 1])
                begun, size = i + 1, 0

    def _unit(self, texts: Sequence[str], keys: Sequence[object]) -> Iterator[np.ndarray]:
        find = self.pieces.chunk.findall
        # A blank goes in front of each text, and is dropped again by decoding.
        split = [
            [find((SPACE if place == 0 else "") + part.replace(" ", SPACE)) for place, part in enumerate(text.split(SPACE))]
            if text else []
            for text in texts
        ]
        if self.variants:
            data = [b for parts, key in zip(split, keys, strict=True) for b in self._by_variant(parts, key)]
        else:
            words = [word for parts in split for part in parts for word in part]
            states = [self.draws(f"{place} {key!r}", len(part)) for parts, key in zip(split, keys, strict=True) for place, part in enumerate(parts)]
            data = self.drawn(words, np.concatenate(states) if states else np.zeros(0, np.uint64))
        at = 0
        for parts in split:
            found = []
            for place, part in enumerate(parts):
                found += [self.raw] if place else []
                found += data[at : at + len(part)]
                at += len(part)
            yield np.frombuffer(b"".join(found), dtype="<u2")

    def _by_variant(self, parts: list[list[str]], key: object) -> Iterator[bytes]:
        """The same with one of a few variants for each occurrence."""
        state = xxhash.xxh32_intdigest(repr(key), self.seed)
        for words in parts:
            mixed = (np.arange(len(words), dtype=np.uint64) + np.uint64(state)) * np.uint64(STEP) >> np.uint64(16)
            for pick, word in zip((mixed % np.uint64(self.variants)).tolist(), words, strict=True):
                yield self.memories[pick][word]

    def gaps(self, bits: np.ndarray) -> np.ndarray:
        """Candidates taken before the next skipped one: geometric, from 53 hashed bits."""
        if not self.scale:
            return np.full(len(bits), 0 if self.dropout >= 1 else NEVER << 20, np.int64)
        uniform = ((bits >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
        return (np.log(uniform) / self.scale).astype(np.int64)

    def draws(self, key: str, n: int) -> np.ndarray:
        """A number of its own for each of the n words of a part of a document."""
        state = xxhash.xxh64_intdigest(key.encode("utf-8", "surrogatepass"), self.seed)
        mixed = (np.arange(1, n + 1, dtype=np.uint64) * np.uint64(STEP_64)) ^ np.uint64(state)
        for _ in range(2):
            mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(MIX_64)
        return mixed ^ (mixed >> np.uint64(32))

    def draw(self, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Candidates up to the next skip, and the numbers that the ones after are drawn from."""
        own = own * np.uint64(MIX_64) + np.uint64(STEP_64)
        own = own ^ (own >> np.uint64(32))
        return self.gaps(own * np.uint64(MIX_64)), own

    def drawn(self, words: list[str], own: np.ndarray) -> list[bytes]:
        """Ids of each word, with skips of its own, drawn from its number."""
        known = self.whole
        fresh = [word for word in dict.fromkeys(words) if word not in known and len(word) <= SHORT]
        found, left = self.pieces.agendas.cut(fresh, np.full(len(fresh), -1), np.zeros(len(fresh), np.uint64), self.draw)
        # Without skips every candidate of the agenda is a merge.
        known.update(zip(fresh, zip(found, (np.fromiter(map(len, fresh), np.int64, len(fresh)) - left).tolist(), strict=True), strict=True))
        known.update(dict.fromkeys({word for word in words if len(word) > SHORT}, (b"", NEVER << 20)))
        found = [*map(known.__getitem__, words)]
        data, turns = [*map(itemgetter(0), found)], np.fromiter(map(itemgetter(1), found), np.int64, len(found))
        gaps = self.gaps(own)
        # Only these occurrences have a skip among their candidates.
        long = turns >= NEVER
        rows = np.flatnonzero((gaps < turns) & ~long)
        again, _ = self.pieces.agendas.cut([words[i] for i in rows.tolist()], gaps[rows], own[rows], self.draw)
        for row, ids in zip(rows.tolist(), again, strict=True):
            data[row] = ids
        for row in np.flatnonzero(long).tolist():
            data[row] = self.pieces.numbers(self.pieces.cut(words[row], self.dropout, int(own[row]) & MASK))
        if len(known) > self.remembered:
            self.whole = {word: known[word] for word in words[-self.remembered :] if len(word) <= SHORT}
        return data

    @property
    def raw(self) -> bytes:
        """The bytes of U+2581, which must not be read as a blank."""
        return np.array([self.pieces.byte[b] for b in SPACE.encode()], dtype="<u2").tobytes()

    def text(self, ids: np.ndarray) -> str:
        data = self.pieces.data
        return b"".join([data[i] for i in ids.tolist()]).decode("utf-8", "surrogatepass")[1:]


class Memory(Remembered):
    """Ids of the words of one variant."""

    def __init__(self, owner: Segmenter, variant: int) -> None:
        super().__init__(REMEMBERED // owner.variants)
        self.owner, self.key = owner, xxhash.xxh32_intdigest(str(variant), owner.seed)

    def make(self, word: str) -> bytes:
        pieces = self.owner.pieces
        return pieces.numbers(pieces.cut(word, self.owner.dropout, self.key))


_segmenters: dict[tuple, Segmenter] = {}


def segmenter(
    path: str, dropout: float = DROPOUT, seed: int = SEED, variants: int = VARIANTS, remembered: int = WORDS
) -> Segmenter:
    key = path, dropout, seed, variants if dropout else 1, remembered
    if key not in _segmenters:
        _segmenters[key] = Segmenter(*key)
    return _segmenters[key]


def encode_texts(
    docs: DataFrame, path: str, dropout: float = DROPOUT, seed: int = SEED, variants: int = VARIANTS, text: str = "text"
) -> DataFrame:
    """doc_id and piece ids of every document; they are decoded and compared with the text."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment = segmenter(path, dropout, seed, variants, WORDS_BESIDE)
        for batch in batches:
            # Some rows at a time, so that neither side holds the pieces of a whole batch.
            for rows in (batch.slice(at, ENCODED_ROWS) for at in range(0, batch.num_rows, ENCODED_ROWS)):
                texts = rows.column("text").to_pylist()
                found = list(segment.ids_of(texts, rows.column("key").to_pylist(), UNIT_BESIDE))
                if any((segment.text(ids) if len(ids) else "") != t for ids, t in zip(found, texts, strict=True)):
                    raise ValueError("pieces do not decode to their text")
                ends = np.cumsum([0, *map(len, found)])
                values = pa.array(np.concatenate(found).astype(np.int32), type=pa.int32())
                pieces = pa.ListArray.from_arrays(pa.array(ends, type=pa.int32()), values)
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pieces], names=["doc_id", "pieces"])

    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("key")
    source = docs.select("doc_id", key, whole_text(text).alias("text"))
    return source.mapInArrow(encode, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, pieces array<int>")


def decode_pieces(pieces: DataFrame, path: str) -> DataFrame:
    """doc_id and text of encoded documents."""

    @F.pandas_udf("string")
    def decode(ids: pd.Series) -> pd.Series:
        segment = segmenter(path)
        return ids.map(lambda found: segment.text(np.asarray(found)) if len(found) else "")

    return pieces.select("doc_id", decode("pieces").alias("text"))


SUMMARY = "doc_id long, n_chars long, n_pieces long, pieces_crc32 long, lossless boolean"


def segmentation_report(
    docs: DataFrame, path: str, dropout: float = DROPOUT, seed: int = SEED, variants: int = VARIANTS, text: str = "text"
) -> DataFrame:
    """Per document: size, checksum of the ids, and whether decoding gives the text."""

    def summarise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        varied = segmenter(path, dropout, seed, variants)
        for batch in batches:
            rows = []
            found = varied.ids_of(batch["text"].tolist(), batch["key"].tolist())
            for doc, source, ids in zip(batch["doc_id"], batch["text"], found, strict=True):
                lossless = varied.text(ids) == source
                crc = zlib.crc32(ids.astype("<u4").tobytes())
                rows.append((doc, len(source), len(ids), crc, lossless))
            frame = pd.DataFrame(rows, columns=[field.split()[0] for field in SUMMARY.split(", ")])
            yield frame.astype({"doc_id": "Int64"})

    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), key.alias("key"), whole_text(text).alias("text"))
    return source.mapInPandas(summarise, SUMMARY)
