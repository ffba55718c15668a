"""Token ids in files: frequency-ranked, with one to four bytes an id and separate control bytes.

Ids are replaced by their rank in the whole corpus (most frequent first), so common ids take one byte.
Texts are tokenized once and their ids kept as they are until the ranks are known; then they are spread by ranges of doc_id and written in that order as blocks: the doc ids, the number
of ids of each document, the control bytes (two bits an id, four ids a byte) and the data bytes. A block
is a row of a Parquet table; the ranks are a table beside it. Reading expands control bytes by a table
of 256 rows in numpy.

Word pieces do not cross white space, so a word is encoded once and remembered, in a memory of
bounded size.

Edge cases: a null or empty text holds the end id only; null doc ids come first; repeated doc ids are
ordered by a hash of the text; a document is never split over blocks, so a block is as large as its longest document;
an empty table gives files without blocks; other columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aferir.llm.common import Remembered, stored, whole_text

END_ID = 1
BLOCK_IDS = 1 << 18
#: Signs that may close a word.
CLOSING = tuple(".,;:!?")
#: Letters that the tokenizer neither changes nor cuts, and the sign of each byte that is not its own sign.
LETTERS = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+")
BYTE_SIGNS = {b: 256 + i for i, b in enumerate([*range(33), *range(127, 161), 173])}


class Encoder(Remembered):
    """Ids of words as bytes (unsigned 32-bit integers, low byte first), kept for the life of a worker."""

    def __init__(self, path: str) -> None:
        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize

    def make(self, word: str) -> bytes:
        """Ids of a word, by way of its lower case and its part before a closing sign if it is plain.

        The tokenizer lowers case and cuts between letters and signs itself; characters up to U+00FF
        are the same in its normal form. The model takes letters as the signs of their bytes.
        """
        if (word.isascii() or max(word) < "\u0100") and "<|" not in word:
            low = word.lower()
            closed = low[-1:] in CLOSING and low[-2:-1].isalnum()
            base = low[:-1] if closed else low
            if base != word:
                found = self.get(base)
                if found is None:
                    found = self[base]
                return found + self[low[-1]] if closed else found
            if LETTERS.fullmatch(word):
                spelled = word if word.isascii() else word.encode().decode("latin-1").translate(BYTE_SIGNS)
                return array("I", [token.id for token in self.tokenize(spelled)]).tobytes()
        return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()

    def ids(self, text: str) -> np.ndarray:
        """Ids of a whole text and the end id."""
        for blank in "\t\n\x0b\x0c\r":
            text = text.replace(blank, " ")
        data = b"".join([*map(self.__getitem__, text.split(" ")), END_BYTES])
        return np.frombuffer(data, dtype="<u4")


END_BYTES = END_ID.to_bytes(4, "little")
_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def vocabulary_size(path: str) -> int:
    return encoder(path).tokenizer.get_vocab_size()


# --- coding ------------------------------------------------------------------------------------

PLACES = np.arange(4, dtype=np.uint8)
#: Bytes of each of the four ids of a control byte.
LENGTHS = ((np.arange(256, dtype=np.uint16)[:, None] >> (2 * PLACES)[None, :]) & 3).astype(np.uint8) + 1


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit integers."""
    values = np.ascontiguousarray(values, dtype="<u4")
    codes = np.zeros(-(-len(values) // 4) * 4, dtype=np.uint8)
    for limit in (1 << 8, 1 << 16, 1 << 24):
        codes[: len(values)] += values >= limit
    control = (codes.reshape(-1, 4) << (2 * PLACES)).sum(axis=1, dtype=np.uint8)
    data = values.view(np.uint8).reshape(-1, 4)[PLACES <= codes[: len(values), None]]
    return control.tobytes(), data.tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    lengths = LENGTHS[np.frombuffer(control, dtype=np.uint8)].ravel()[:n]
    out = np.zeros((n, 4), dtype=np.uint8)
    out[PLACES < lengths[:, None]] = np.frombuffer(data, dtype=np.uint8)
    return out.reshape(-1).view("<u4")


# --- writing and reading -----------------------------------------------------------------------


ENCODED = "doc_id long, tie long, n long, data binary"


def id_type(size: int) -> str:
    """How ids are kept until their ranks are known: two bytes where the vocabulary allows."""
    return "<u2" if size <= 1 << 16 else "<u4"


def encoded(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """The ids of every document as the tokenizer numbers them: each text is tokenized once."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, kind = encoder(path), id_type(vocabulary_size(path))
        for batch in batches:
            found = [encode.ids(source) for source in batch["text"]]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"].astype("Int64"),
                    "tie": batch["tie"],
                    "n": [len(ids) for ids in found],
                    "data": [ids.astype(kind).tobytes() for ids in found],
                }
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text(text).alias("text"))
    # The text's hash splits a doc_id that very many rows share.
    return rows.withColumn("tie", F.xxhash64("text")).mapInPandas(work, ENCODED)


def frequencies(rows: DataFrame, size: int) -> DataFrame:
    """How often each id occurs in all documents: at most a row for each id of the vocabulary."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            for data in batch["data"]:
                total += np.bincount(np.frombuffer(data, id_type(size)), minlength=size) if len(data) > size else 0
            short = b"".join(data for data in batch["data"] if len(data) <= size)
            total += np.bincount(np.frombuffer(short, id_type(size)), minlength=size)
        seen = np.flatnonzero(total)
        yield pd.DataFrame({"id": seen, "n": total[seen]})

    counted = rows.select("data").mapInPandas(count, "id int, n long")
    return counted.groupBy("id").agg(F.sum("n").alias("n"))


BLOCKS = "shard int, block int, first long, doc_ids array<long>, sizes array<long>, control binary, data binary"


def write_blocks(docs: DataFrame, path: str, text: str = "text") -> tuple[DataFrame, np.ndarray]:
    """Write all documents; the blocks as read back, and the id of each rank."""
    size = vocabulary_size(path)
    rows = stored(encoded(docs, path, text), "zstd")
    # A row for each id of the vocabulary at most.
    counted = frequencies(rows, size).toPandas()
    total = np.zeros(size, dtype=np.int64)
    total[counted["id"]] = counted["n"]
    ids = np.lexsort((np.arange(size), -total)).astype("<u4")
    ranks = np.empty(size, dtype="<u4")
    ranks[ids] = np.arange(size, dtype="<u4")

    kind = id_type(size)

    def block(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard = TaskContext.get().partitionId()
        number, first, doc_ids, parts, waiting = 0, 0, [], [], 0

        def row() -> pd.DataFrame:
            control, data = pack(ranks[np.concatenate(parts)])
            sizes = [len(part) for part in parts]
            return pd.DataFrame(
                [(shard, number, first, list(doc_ids), sizes, control, data)],
                columns=[field.split()[0] for field in BLOCKS.split(", ")],
            )

        for batch in batches:
            for doc, n, data in zip(batch["doc_id"], batch["n"], batch["data"], strict=True):
                if waiting and waiting + n > BLOCK_IDS:
                    yield row()
                    number, first, doc_ids, parts, waiting = number + 1, first + waiting, [], [], 0
                doc_ids.append(None if pd.isna(doc) else int(doc))
                parts.append(np.frombuffer(data, kind))
                waiting += n
        if waiting:
            yield row()

    ordered = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "n")
    blocks = stored(ordered.mapInPandas(block, BLOCKS))
    spark = docs.sparkSession
    ranked = stored(spark.createDataFrame(pd.DataFrame({"rank": np.arange(size), "id": ids.astype(np.int64)})))
    table = ranked.orderBy("rank").toPandas()["id"].to_numpy(dtype="<u4")
    return blocks, table


def shard_starts(blocks: DataFrame) -> DataFrame:
    """Ids in the shards before each shard; a row per written partition."""
    sizes = blocks.groupBy("shard").agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, b: a + b)).alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shard_start"))


DOCUMENTS = "doc_id long, start long, n_tokens long, ids_crc32 long, ids array<long>"


def read_blocks(blocks: DataFrame, ids: np.ndarray, with_ids: bool = False) -> DataFrame:
    """One row per document from its block: place, size and checksum of its ids, and on request the ids."""
    # One row for each partition of the writing job.
    placed = blocks.join(F.broadcast(shard_starts(blocks)), "shard")
    schema = DOCUMENTS if with_ids else DOCUMENTS.rpartition(", ")[0]

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                sizes = np.asarray(row.sizes, dtype=np.int64)
                found = ids[unpack(row.control, row.data, int(sizes.sum()))]
                ends = np.cumsum(sizes)
                parts = [found[end - size : end] for end, size in zip(ends, sizes, strict=True)]
                out = {
                    "doc_id": pd.array([None if pd.isna(d) else int(d) for d in row.doc_ids], dtype="Int64"),
                    "start": row.shard_start + row.first + ends - sizes,
                    "n_tokens": sizes,
                    "ids_crc32": [zlib.crc32(part.tobytes()) for part in parts],
                }
                if with_ids:
                    out["ids"] = [part.astype(np.int64) for part in parts]
                yield pd.DataFrame(out)

    return placed.mapInPandas(decode, schema)
