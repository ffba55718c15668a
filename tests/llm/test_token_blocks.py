import zlib

import numpy as np
import public_tokenizers
import pytest
from helpers import no_documents, odd_documents
from tokenizers import Tokenizer

from aferir.llm import token_blocks

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("n", [0, 1, 3, 4, 5, 1000])
def test_coding_round_trip(n):
    rng = np.random.default_rng(n)
    values = (rng.integers(0, 1 << 32, n, dtype=np.uint64) >> rng.integers(0, 32, n, dtype=np.uint64)).astype("<u4")
    control, data = token_blocks.pack(values)
    assert len(control) == -(-n // 4)
    assert (token_blocks.unpack(control, data, n) == values).all()


def test_edges_of_the_lengths():
    values = np.array([0, 255, 256, 65535, 65536, (1 << 24) - 1, 1 << 24, (1 << 32) - 1], dtype="<u4")
    control, data = token_blocks.pack(values)
    assert len(data) == 2 * (1 + 2 + 3 + 4) and (token_blocks.unpack(control, data, 8) == values).all()


def test_files_hold_what_the_library_encodes(spark, monkeypatch):
    monkeypatch.setattr(token_blocks, "BLOCK_IDS", 50)
    odd = ["it's 12 o'clock!! <|endoftext|> x", "a b\x1cc d\x85e", "é İstanbul ΣΣ", "a\r\n\tb\x0bc"]
    docs = odd_documents(spark, odd)
    blocks, ids = token_blocks.write_blocks(docs, PATH)
    rows = token_blocks.read_blocks(blocks, ids, with_ids=True).collect()
    library = Tokenizer.from_file(PATH)
    source = docs.selectExpr("doc_id", "coalesce(text, '') AS text", "xxhash64(coalesce(text, '')) AS tie").collect()
    source.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["tie"]))
    rows.sort(key=lambda r: (r["start"], r["n_tokens"]))
    start = 0
    assert len(rows) == len(source)
    for row, doc in zip(rows, source, strict=True):
        want = [*library.encode(doc["text"], add_special_tokens=False).ids, 1]
        assert (row["doc_id"], row["start"], list(row["ids"])) == (doc["doc_id"], start, want)
        assert row["ids_crc32"] == zlib.crc32(np.array(want, dtype="<u4").tobytes())
        start += len(want)


@pytest.mark.parametrize(
    "word", ["The", "THE.", "end.", "end..", "x.y,", "it's,", "<|ENDOFTEXT|>", "<|endoftext|>.", "É.", "ÿ!", "a1.", "1,", "²;", "", ".", "..", "ªº", "ǅ.", "é."]
)
def test_words_are_encoded_as_by_the_library(word):
    want = Tokenizer.from_file(PATH).encode(word, add_special_tokens=False).ids
    assert token_blocks.encoder(PATH).ids(word).tolist() == [*want, 1]


def test_ranks_follow_frequency(spark):
    docs = odd_documents(spark)
    blocks, ids = token_blocks.write_blocks(docs, PATH)
    assert ids[0] == Tokenizer.from_file(PATH).encode("word", add_special_tokens=False).ids[0]
    assert sorted(ids.tolist()) == list(range(len(ids)))


def test_no_documents(spark):
    blocks, ids = token_blocks.write_blocks(no_documents(spark), PATH)
    assert token_blocks.read_blocks(blocks, ids).count() == 0
