"""Quality rules whose cutoffs are chosen on labelled documents with a bounded risk.

Each rule measures something that is high in bad text. For every stratum, rule and candidate cutoff the
good labelled documents beyond the cutoff are counted; an exact binomial test (equivalent to the upper
Clopper-Pearson bound) must show that the rule rejects less than ``risk`` of the good documents, at a
level divided by the number of all tests (Bonferroni). The lowest cutoff that passes is used; a rule
without one rejects nothing in that stratum. Everything is a DataFrame expression.

All labelled documents are counted. Every document is measured once: the measures are stored, and meet the
labels by a shuffle without the texts. Only strata with a cutoff are joined back; a stratum needs more than
a thousand good labelled documents for one (at the default risk and level), so these are few.

Edge cases: a null or empty text has no words and fails the base rules; a null stratum is a stratum
like any other; a stratum without enough labels has no cutoffs; repeated rows are measured alike;
columns beside the named ones are ignored, or kept by ``keep_good``.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aferir.llm.common import BLANK_RUN, BLANKS, stored, whole_text
from aferir.session import broadcast_if_small

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
#: Candidate cutoffs of each rule, as a share or rate.
CUTOFFS = {
    "symbol_rate": (0.02, 0.05, 0.1, 0.2, 0.4, 0.8, 1.6),
    "dup_line_rate": (0.2, 0.3, 0.35, 0.4, 0.5, 0.6, 0.8),
    "repeat_rate": (0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.45),
    "upper_rate": (0.05, 0.1, 0.2, 0.3, 0.4, 0.5),
    "word_length_gap": (1.0, 1.5, 2.0, 2.5, 3.0, 4.0),
}
USUAL_WORD_LENGTH = 5.0
RISK, LEVEL = 0.005, 0.05
#: Labels that the SQL counterpart reads at most; the operator has no such limit.
SAMPLE = 50_000
#: Terms of the binomial sum that are added up one by one; the rest is bounded by a geometric series.
TERMS = 1000


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once however often the body names it."""
    return F.transform(F.array(value), body)[0]


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the counts of each text in a struct column ``m``.

    The struct is a generated column, so that the optimizer does not copy its expression into each use.
    """
    words = lambda source: F.array_remove(F.split(source, BLANK_RUN), "")
    lines = lambda source: F.filter(F.split(source, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    counts = lambda source: let(
        words(source), lambda w: let(lines(source), lambda ln: let(_hashes(w), lambda h: _counts(source, w, ln, h)))
    )
    return docs.withColumn("m", F.explode_outer(F.transform(F.array(whole_text(text)), counts)))


def _hashes(words: Column) -> Column:
    """A hash of each window of three words."""
    windows = F.arrays_zip(
        words.alias("a"),
        F.slice(words, F.lit(2), F.size(words)).alias("b"),
        F.slice(words, F.lit(3), F.size(words)).alias("c"),
    )
    # The last two have no third word.
    windows = F.slice(windows, F.lit(1), F.greatest(F.size(words) - 2, F.lit(0)))
    return F.transform(windows, lambda w: F.xxhash64(w["a"], w["b"], w["c"]))


def _counts(source: Column, words: Column, lines: Column, hashes: Column) -> Column:
    unique = F.size(F.array_distinct(hashes)) == F.size(hashes)
    return F.struct(
        F.size(words).cast("long").alias("n_words"),
        F.length(F.translate(source, BLANKS, "")).cast("long").alias("word_chars"),
        (F.length(source) - F.length(F.translate(source, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.when(unique, F.lit(0)).otherwise(_covered(hashes)).cast("long").alias("n_repeat_words"),
        F.size(lines).alias("n_lines"),
        F.length(F.regexp_replace(source, r"\P{Lu}+", "")).alias("n_upper"),
    )


def _covered(hashes: Column) -> Column:
    """Words inside a window of three whose hash occurs twice or more.

    Windows are sorted by hash, so equal ones are neighbours; the places of those are sorted again, and
    each adds the words up to the next place, three at most.
    """
    after = lambda column: F.slice(column, F.lit(2), F.size(column))

    def places(placed: Column) -> Column:
        pairs = F.arrays_zip(placed.alias("l"), after(placed).alias("r"))
        # Both windows of an equal pair are repeated.
        equal = F.filter(pairs, lambda p: p["l"]["h"] == p["r"]["h"])
        both = F.transform(equal, lambda p: F.array(p["l"]["i"], p["r"]["i"]))
        return F.sort_array(F.array_distinct(F.flatten(both)))

    def total(found: Column) -> Column:
        steps = F.arrays_zip(found.alias("l"), after(found).alias("r"))
        gaps = F.transform(steps, lambda p: F.least(F.coalesce(p["r"] - p["l"], F.lit(3)), F.lit(3)))
        return F.aggregate(gaps, F.lit(0), lambda sum_, gap: sum_ + gap)

    placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return let(placed, lambda p: let(places(p), total))


def base_failed() -> Column:
    return (F.col("m.n_words") < MIN_WORDS) | (100 * F.col("m.n_repeat_words") > 50 * F.col("m.n_words"))


def rates() -> dict[str, Column]:
    """The measure of each rule; of a text without words, zero."""
    per = lambda part, whole: F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(0.0)
    return {
        "symbol_rate": per("m.n_symbols", "m.n_words"),
        "dup_line_rate": per("m.n_dup_lines", "m.n_lines"),
        "repeat_rate": per("m.n_repeat_words", "m.n_words"),
        "upper_rate": per("m.n_upper", "m.word_chars"),
        "word_length_gap": F.abs(per("m.word_chars", "m.n_words") - USUAL_WORD_LENGTH),
    }


def log_factorial(n: Column) -> Column:
    """Natural logarithm of n!: exact up to 20, then Stirling's series (error below 1e-12)."""
    x = F.greatest(n, F.lit(21)).cast("double")
    series = x * F.log(x) - x + 0.5 * F.log(2 * math.pi * x) + 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * F.pow(x, F.lit(5)))
    return F.when(n <= 20, F.log(F.factorial(F.least(n, F.lit(20)).cast("int")).cast("double"))).otherwise(series)


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) of the binomial distribution, never too low; 1 from the mean on."""
    log_top = log_factorial(n) - log_factorial(k) - log_factorial(n - k) + k * math.log(p) + (n - k) * math.log1p(-p)
    odds = (1 - p) / p
    ratio = lambda i: (k - i) / (n - k + i + 1) * odds  # noqa: E731  of the term below to the one at k - i
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total"))

    def add(state: Column, i: Column) -> Column:
        term = state["term"] * ratio(i)
        return F.struct(term.alias("term"), (state["total"] + term).alias("total"))

    steps = F.when(k > 0, F.sequence(F.lit(0), F.least(k, F.lit(TERMS)).cast("int") - 1)).otherwise(F.array().cast("array<int>"))
    summed = F.aggregate(steps, start, add)
    rest = F.when(k > TERMS, summed["term"] * ratio(F.lit(TERMS)) / (1 - ratio(F.lit(TERMS)))).otherwise(0.0)
    return F.when(k >= n * p, F.lit(1.0)).otherwise(F.exp(log_top) * (summed["total"] + rest))


def of_stratum(stratum: str) -> Column:
    return F.coalesce(F.col(stratum), F.lit(""))


def chosen_cutoffs(
    docs: DataFrame, labels: DataFrame, stratum: str = "lang", text: str = "text", risk: float = RISK, level: float = LEVEL
) -> DataFrame:
    """One row per stratum of the labelled documents: the cutoff of each rule, null where none is safe."""
    return cutoffs_of(measured(docs, text), labels, stratum, risk, level)


def cutoffs_of(found: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = RISK, level: float = LEVEL) -> DataFrame:
    """The same from documents that are measured already."""
    good = labels.where("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct()
    holdout = found.where(~base_failed()).select("doc_id", of_stratum(stratum).alias("stratum"), "m")
    # The ids grow with the corpus: never broadcast.
    holdout = holdout.join(good.hint("merge"), "doc_id", "left_semi")
    measures = rates()
    beyond = [
        F.sum((measures[rule] > cutoff).cast("long")).alias(f"{rule}_{place}")
        for rule, cutoffs in CUTOFFS.items()
        for place, cutoff in enumerate(cutoffs)
    ]
    counts = stored(holdout.groupBy("stratum").agg(F.count("*").alias("n"), *beyond))
    allowed = level / max(1, counts.count() * sum(map(len, CUTOFFS.values())))
    safe = lambda rule, place: binomial_tail(F.col(f"{rule}_{place}"), F.col("n"), risk) <= allowed
    return counts.select(
        "stratum",
        *(
            F.coalesce(*(F.when(safe(rule, i), F.lit(cutoff)) for i, cutoff in enumerate(cutoffs))).alias(f"{rule}_cut")
            for rule, cutoffs in CUTOFFS.items()
        ),
    )


def judged(docs: DataFrame, labels: DataFrame, stratum: str = "lang", text: str = "text", **limits: float) -> DataFrame:
    """``docs`` without the text, with counts ``m``, ``base_failed`` and ``kept``."""
    found = stored(measured(docs, text).drop(text))
    cuts = cutoffs_of(found, labels, stratum, **limits)
    names = [f"{rule}_cut" for rule in CUTOFFS]
    cuts = cuts.where(F.coalesce(*names).isNotNull()).select(F.col("stratum").alias("_stratum"), F.struct(*names).alias("_cuts"))
    found = found.withColumn("base_failed", base_failed())
    found = found.join(broadcast_if_small(stored(cuts)), of_stratum(stratum) == F.col("_stratum"), "left")
    bad = F.col("base_failed")
    for rule, measure in rates().items():
        bad = bad | F.coalesce(measure > F.col(f"_cuts.{rule}_cut"), F.lit(False))
    return found.withColumn("kept", ~bad).drop("_stratum", "_cuts")


def quality_report(docs: DataFrame, labels: DataFrame, **limits: float) -> DataFrame:
    """Counts and verdict of every document."""
    found = judged(docs.select("doc_id", "lang", "text"), labels, **limits)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return found.select("doc_id", *(f"m.{name}" for name in names), "base_failed", "kept")


def keep_good(docs: DataFrame, labels: DataFrame, **limits: float) -> DataFrame:
    """The documents that pass, with their own columns."""
    clear = docs.select(F.struct("*").alias("_row"), "doc_id", "lang", "text")
    return judged(clear, labels, **limits).where("kept").select("_row.*")
