import importlib

import corpus_pipeline
import public_tokenizers
import pytest
from helpers import prose

from aferir.llm import chat, merge_dropout, order_minhash, pii, qgram
from aferir.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def test_every_operator_has_a_query():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    entry = importlib.import_module("__spark_entry__")
    assert {"pipeline", *QUERIES} <= set(entry.queries())


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage returned, written and read again, the documents first."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, FOLDER).write.parquet(str(folder / name))
        docs = spark.read.parquet(str(folder / name))
        found.append(docs)
    return found


def ids(df):
    return {r["doc_id"] for r in df.select("doc_id").collect()}


def test_stages_keep_the_columns(stages):
    assert all(df.schema.names == stages[0].schema.names for df in stages[:-1])
    counts = [df.count() for df in stages]
    assert counts[0] > counts[1] > counts[2] > counts[3] == counts[4] == counts[5] > 0


def test_near_dedup_keeps_one_of_each_class(spark, stages):
    texts = {r["doc_id"]: order_minhash.word_hashes(r["text"]) for r in stages[1].collect()}
    kept = ids(stages[2])
    for doc in kept:
        assert not any(o < doc and order_minhash.similar(texts[o], texts[doc]) for o in kept if o != doc)
    for doc in set(texts) - kept:
        assert any(order_minhash.similar(texts[o], texts[doc]) for o in texts if o != doc)


def test_decontamination_against_plain_search(spark, stages):
    items = [r["text"] for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    gone = ids(stages[2]) - ids(stages[3])
    texts = {r["doc_id"]: r["text"] for r in stages[2].collect()}
    assert {doc for doc, text in texts.items() if any(item in text for item in items)} <= gone
    index = qgram.Index(list(enumerate(items)))
    assert all(index.matches(texts[doc]) for doc in gone)


def test_masking_and_encoding_take_effect(stages):
    before = {r["doc_id"]: r["text"] for r in stages[3].collect()}
    after = {r["doc_id"]: r for r in stages[4].collect()}
    for doc, text in before.items():
        assert after[doc]["text"] == pii.masked(text, pii.find(text)[1]) and after[doc]["n_chars"] == len(after[doc]["text"])
    segment = merge_dropout.segmenter(public_tokenizers.path("piece_bpe_32k.model"))
    for row in stages[5].collect():
        import numpy as np

        assert segment.text(np.array(row["pieces"])) == after[row["doc_id"]]["text"]


def test_chat_query_has_the_hostile_conversation(spark):
    row = QUERIES["op2_chat_round_trip"](spark, FOLDER).where("conv_id = -1").first()
    assert (row["n_turns"], row["loss_chars"]) == (2, 21) and chat.escape("</s>") != "</s>"


def test_odd_and_empty_tables(spark, tmp_path):
    """Null and repeated ids, null and empty texts, repeated rows; then tables without rows."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [
        (1, prose(1, 90), "en", "a", 0), (1, prose(2, 90), "en", "a", 0), (2, prose(3, 90), None, None, None), (2, prose(3, 90), None, None, None),
        (None, prose(4, 90), "fr", "b", 1), (None, prose(5, 90), "fr", "b", 1), (3, None, "en", "a", 0), (4, "", "en", "a", 0),
    ]
    for name, docs in (("odd", rows), ("empty", [])):
        folder = str(tmp_path / name)
        spark.createDataFrame(docs, schema).write.parquet(f"{folder}/documents.parquet")
        items = [(1, None), (None, prose(9, 40))] if docs else []
        spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
        spark.createDataFrame([], "doc_id long, quality long, toxic long").write.parquet(f"{folder}/labels.parquet")
        found = corpus_pipeline.run(spark, folder).collect()
        # Short and empty texts fail the quality rules; equal rows are one class; the others stay.
        assert sorted((r["doc_id"] or 0) for r in found) == ([0, 0, 1, 1, 2] if docs else [])
        assert all(len(r["pieces"]) > 90 for r in found)
