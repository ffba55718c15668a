import math
import random
import re

import pytest
from helpers import no_documents, odd_documents, plain, prose
from pyspark.sql import functions as F

from aferir.llm import quality_rules as rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text or "")
    windows = list(zip(words, words[1:], words[2:]))
    covered = {i + j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(3)}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    return len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_counts_against_brute_force(spark):
    rng = random.Random(5)
    texts = [" ".join(rng.choice("a b c # x|y \n \t é".split(" ")) for _ in range(n)) for n in (0, 1, 2, 3, 4, 10, 60, 200)]
    texts += ["a b c a b c a b c", "a a a a", "x\n x\nx\n\n\n", "\x0b\x0c\x1c  ", "one two one two one"]
    docs = odd_documents(spark, texts)
    got = rules.quality_report(docs, labels(spark, []))
    rows = got.join(docs.select("doc_id", "text"), "doc_id").distinct().collect()
    assert len(rows) >= len(texts)
    for row in rows:
        found = (row["n_words"], row["word_chars"], row["n_symbols"], row["n_dup_lines"], row["n_repeat_words"])
        if row["n_words"] < 1000:
            assert found == brute(row["text"]), row["text"]
        assert row["base_failed"] == (found[0] < 50 or 100 * found[4] > 50 * found[0])
        assert row["kept"] == (not row["base_failed"])  # without labels there are no cutoffs
    assert got.count() == docs.count()


@pytest.mark.parametrize(("k", "n", "p"), [(0, 100, 0.01), (1, 100, 0.05), (3, 2000, 0.005), (40, 5000, 0.01), (900, 200_000, 0.005), (7, 10, 0.1)])
def test_binomial_tail(spark, k, n, p):
    got = spark.range(1).select(rules.binomial_tail(F.lit(k).cast("long"), F.lit(n).cast("long"), p)).first()[0]
    log_c = lambda i: math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1)
    exact = sum(math.exp(log_c(i) + i * math.log(p) + (n - i) * math.log1p(-p)) for i in range(k + 1))
    assert got == (1.0 if k >= n * p else pytest.approx(exact, rel=1e-6)) and got >= exact * (1 - 1e-9)


def corpus(spark, n=600):
    """Clean text, and junk full of symbols that a base rule does not see."""
    rows = []
    for i in range(n):
        text = prose(i, 80)
        rows.append((i, " ".join(w + "##" for w in text.split()) if i % 5 == 0 else text, "en"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    return docs, labels(spark, [(i, int(i % 5 != 0), 0) for i in range(n) if i % 2])


def test_cutoffs_reject_junk_and_keep_clean_text(spark):
    docs, known = corpus(spark)
    kept = {r["doc_id"]: r["kept"] for r in rules.quality_report(docs, known, risk=0.05).collect()}
    assert all(kept[i] == (i % 5 != 0) for i in kept)
    # With fewer labels than the bound needs, no cutoff is safe and nothing more is rejected.
    assert all(r["kept"] for r in rules.quality_report(docs, known, risk=0.001).collect())


def test_cutoffs_hold_the_risk_on_the_sample(spark):
    docs, known = corpus(spark)
    cuts = rules.chosen_cutoffs(docs, known, risk=0.05).collect()
    assert [r["stratum"] for r in cuts] == ["en"]
    assert cuts[0]["symbol_rate_cut"] == rules.CUTOFFS["symbol_rate"][0]
    # A cutoff that would reject a good share of good text is passed over.
    assert cuts[0]["word_length_gap_cut"] is None or cuts[0]["word_length_gap_cut"] > 0.5


def test_keeping_returns_the_same_columns(spark):
    docs = odd_documents(spark, [prose(1, 90)])
    kept = rules.keep_good(docs, labels(spark, [(1, 1, 0), (1, 1, 0), (None, 1, 0)]))
    assert kept.columns == docs.columns and [r["doc_id"] for r in kept.collect()] == [100]
    assert plain(rules.keep_good(no_documents(spark), labels(spark, []))) == []


def test_labels_are_met_without_limit_or_broadcast(spark, monkeypatch):
    docs, known = corpus(spark)
    plans = []
    keep = lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or df
    monkeypatch.setattr(rules, "stored", keep)
    rules.chosen_cutoffs(docs, known, risk=0.05)
    assert "SortMergeJoin" in plans[0] and not any(name in plans[0] for name in ("Limit", "TakeOrdered", "Broadcast"))
