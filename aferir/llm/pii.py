"""Personal data found through disguises, with spans that point into the source text.

A chain of transducers rewrites the text (look-alike characters, spelled digits, "at" and "dot"
disguises, digits joined after spelling) and records each edit. The identifiers are detected in the
rewritten text and their spans are mapped back, edit by edit, to the characters they came from.

Edge cases: a null or empty text has no spans; very long texts are scanned in time linear in their
length; repeated rows give repeated results; columns beside id and text are not touched.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aferir.llm.common import sha256, whole_text

KINDS = ("email", "ip", "card", "phone")

# --- identifiers -------------------------------------------------------------------------------

DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A failed match cannot succeed further inside the same digits, so only their start is tried.
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for place, char in enumerate(reversed(digits)):
        value = ord(char) - 48
        if place % 2:
            value = value * 2 - 9 * (value > 4)
        total += value
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of local part, @ and domain: each @ is extended to the left, so no run is read twice."""
    last = 0
    for match in DOMAIN.finditer(text):
        start = match.start()
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        if start < match.start():
            last = match.end()
            yield start, last


def detect(text: str) -> list[tuple[str, int, int]]:
    """Valid identifiers, leftmost and non-overlapping within each kind."""
    found = [("email", s, e) for s, e in emails(text)] if "@" in text else []
    for match in IP.finditer(text):
        parts = (part.lstrip("0") for part in match[0].split("."))
        if all(len(part) < 3 or len(part) == 3 and part <= "255" for part in parts):
            found.append(("ip", *match.span()))
    for match in CARD.finditer(text):
        if 12 <= match.end() - match.start() <= 37:
            digits = NOT_DIGIT.sub("", match[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *match.span()))
    if "+" in text:
        for match in PHONE.finditer(text):
            if 9 <= len(NOT_DIGIT.sub("", match[0])) <= 15:
                found.append(("phone", *match.span()))
    return found


# --- transducers -------------------------------------------------------------------------------

# Cyrillic and Greek letters that look like Latin ones, and signs that look like ASCII.
LOOK_ALIKE = dict(
    zip(
        "аеорсухіјѕһԁԛԝвкмнтАВЕКМНОРСТУХІЈЅαονρτικυΑΒΕΖΗΙΚΜΝΟΡΤΥΧ․。｡‐‑‒–—−",
        "aeopcyxijshdqwbkmhtABEKMHOPCTYXIJSaovptikuABEZHIKMNOPTYX...------",
        strict=True,
    )
)
# Characters without width.
NO_WIDTH = "­​‌‍⁠﻿"
# Digit names by language (en, fr, de, es), 0 to 9.
DIGIT_NAMES = {
    "en": "zero one two three four five six seven eight nine",
    "fr": "zéro un deux trois quatre cinq six sept huit neuf",
    "de": "null eins zwei drei vier fünf sechs sieben acht neun",
    "es": "cero uno dos tres cuatro cinco seis siete ocho nueve",
}
DIGIT_OF = {name: str(n) for names in DIGIT_NAMES.values() for n, name in enumerate(names.split())}
DIGIT_OF["oh"] = "0"


def _single(char: str) -> str:
    """The ASCII character that a compatibility form (full-width, circled, mathematical) stands for."""
    plain = unicodedata.normalize("NFKC", char)
    return plain if len(plain) == 1 and plain.isascii() and plain.isprintable() and plain != " " else ""


def _homoglyphs() -> dict[int, str]:
    blocks = ((0x2070, 0x209F), (0x2460, 0x24FF), (0xFE50, 0xFE6F), (0xFF01, 0xFF5E), (0x1D400, 0x1D7FF))
    table = {code: _single(chr(code)) for low, high in blocks for code in range(low, high + 1)}
    for zero in (0x0660, 0x06F0, 0x0966):  # Arabic, Persian and Devanagari digits
        table |= {zero + n: str(n) for n in range(10)}
    table |= {ord(a): b for a, b in LOOK_ALIKE.items()}
    return {code: char for code, char in table.items() if char}


HOMOGLYPHS = _homoglyphs()
INVISIBLE = re.compile(f"[{NO_WIDTH}]+")
_NAME = "|".join(sorted(map(re.escape, DIGIT_OF), key=len, reverse=True))
# All patterns below read lower-case text.
# Three names in a row, or names beside digits, are a spelled number; one alone is a word.
SPELLED = re.compile(
    rf"(?:\bplus[ -]{{1,2}})?\b(?:{_NAME})"
    rf"(?:(?:[ ,-]{{1,2}}|[ ]?(?:\bdot\b|\bpoint\b|\.)[ ]?)(?:(?:{_NAME})\b|[0-9]+)){{2,}}"
)
SPELLED_ITEM = re.compile(rf"(plus)|({_NAME})|([0-9]+)|(dot|point|\.)")
JOINERS = frozenset(("dot", "point"))
BRACKETED = re.compile(r"[\[({<][ ]?(at|@|arroba|chez|dot|punto|point|punkt|\.)[ ]?[\])}>]")
AT_NAMES = frozenset(("at", "@", "arroba", "chez"))
# A bare "at" counts only before a name that goes on with a disguised dot; a bare @ also before a plain one.
_DOT_AHEAD = r"[a-z0-9-]+(?:[ ](?:dot|punto)[ ][a-z0-9]|[ ]?[\[({<][ ]?(?:dot|punto|point|punkt|\.)[ ]?[\])}>])"
BARE_AT = re.compile(rf"[ ](?:at|arroba)[ ](?={_DOT_AHEAD})|[ ]@[ ](?={_DOT_AHEAD}|[a-z0-9-]+\.[a-z]{{2}})")
# A bare "dot" counts only in a name that already has an @ sign.
BARE_DOT = re.compile(r"[ ](?:dot|punto)[ ](?=[a-z0-9])")
ADDRESS = re.compile(r"@[a-z0-9-]+(?:[ ](?:dot|punto)[ ][a-z0-9-]+|\.[a-z0-9-]+)+")
# Letters that stand for digits between digits.
LETTER_DIGIT = re.compile(r"[0-9][ -]?([oli|])(?=[ -]?[0-9])")


def lower(text: str) -> str:
    """Lower case, one character for each character."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def may_spell(low: str) -> bool:
    """Whether three digit names, digits or joiners stand in a row: far cheaper than the pattern."""
    words = low.replace("-", " ").replace(",", " ").replace(".", " dot ").split()
    if DIGIT_OF.keys().isdisjoint(words):
        return False
    return "111" in "".join(["1" if w in DIGIT_OF or w in JOINERS or w.isdecimal() else "0" for w in words])


class Rewritten:
    """A text and the edits that lead back to its source: one list of edits for each transducer."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.layers: list[tuple[list[int], list[tuple[int, int, int, int]]]] = []

    def apply(self, edits: list[tuple[int, int, str]]) -> str:
        """Replace [start, end) by a string, for edits in order that do not overlap.

        Returns the new text in lower case, empty if there was nothing to do.
        """
        if not edits:
            return ""
        out, at, size, spans = [], 0, 0, []
        for start, end, new in edits:
            out += (self.text[at:start], new)
            size += start - at
            spans.append((size, size + len(new), start, end))
            size += len(new)
            at = end
        self.text = "".join([*out, self.text[at:]])
        self.layers.append(([span[0] for span in spans], spans))
        return lower(self.text)

    def source(self, start: int, end: int) -> tuple[int, int]:
        """The span of the source that became [start, end) of the text."""
        for keys, spans in reversed(self.layers):
            start, end = self._back(keys, spans, start, False), self._back(keys, spans, end - 1, True)
        return start, end

    @staticmethod
    def _back(keys: list[int], spans: list, at: int, last: bool) -> int:
        k = bisect_right(keys, at) - 1
        # An edit that left no character has nothing to point at: the one before holds the place.
        while k >= 0 and spans[k][0] == spans[k][1] > at:
            k -= 1
        if k < 0:
            return at + last
        new_start, new_end, old_start, old_end = spans[k]
        if at < new_end:
            return old_end if last else old_start
        return old_end + at - new_end + last


def spelled(low: str) -> list[tuple[int, int, str]]:
    """Edits that write each spelled number in digits, without the blanks between its names."""
    edits = []
    for match in SPELLED.finditer(low):
        number, names = [], 0
        for item in SPELLED_ITEM.finditer(match[0]):
            names += bool(item[2])
            number.append("+" if item[1] else DIGIT_OF[item[2]] if item[2] else item[3] or ".")
        if names >= 3:
            edits.append((*match.span(), "".join(number)))
    return edits


def bracketed(low: str) -> list[tuple[int, int, str]]:
    """Edits for "[at]" and "(dot)", with a blank on either side."""
    edits = []
    for match in BRACKETED.finditer(low):
        start, end = match.span()
        start -= start > 0 and low[start - 1] == " " and (not edits or start - 1 >= edits[-1][1])
        end += low[end : end + 1] == " "
        edits.append((start, end, "@" if match[1] in AT_NAMES else "."))
    return edits


def bare_dots(low: str) -> list[tuple[int, int, str]]:
    return [
        (m.start() + d.start(), m.start() + d.end(), ".")
        for m in ADDRESS.finditer(low)
        for d in BARE_DOT.finditer(m[0])
    ]


def normalise(text: str) -> Rewritten:
    """Run the transducers one after another; a text without a disguise passes unchanged."""
    out = Rewritten(text)
    try:
        text.encode("latin-1")  # a fast way to see that none of the look-alikes can be there
        plain = "\xad" not in text
    except UnicodeEncodeError:
        plain = False
    if not plain:
        out.apply([(*m.span(), "") for m in INVISIBLE.finditer(out.text)])
        out.text = out.text.translate(HOMOGLYPHS)  # one character for one: no span moves
    low = lower(out.text)
    if may_spell(low):
        low = out.apply(spelled(low)) or low
    low = out.apply([(*m.span(), "@") for m in BARE_AT.finditer(low)]) or low
    low = out.apply(bracketed(low)) or low
    if "@" in low:
        low = out.apply(bare_dots(low)) or low
    out.apply([(*m.span(1), "0" if m[1] == "o" else "1") for m in LETTER_DIGIT.finditer(low)])
    return out


def find(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Spans of the text as it is, and all spans: those and what only the rewritten text shows."""
    order = {kind: place for place, kind in enumerate(KINDS)}
    sort_key = lambda span: (span[1], order[span[0]], span[2])
    base = sorted(detect(text), key=sort_key)
    rewritten = normalise(text)
    if rewritten.text == text:
        return base, base
    # Per kind the base spans do not overlap, so only the last one that starts no later can hold a new span.
    known = {kind: [(s, e) for k, s, e in base if k == kind] for kind in KINDS}
    added = set()
    for kind, start, end in detect(rewritten.text):
        start, end = rewritten.source(start, end)
        spans = known[kind]
        place = bisect_right(spans, (start, float("inf")))
        if place == 0 or spans[place - 1][1] < end:
            added.add((kind, start, end))
    return base, sorted([*base, *added], key=sort_key)


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span replaced by its kind in angle brackets; overlapping spans merge."""
    out, at = [], 0
    for kind, start, end in spans:
        if start >= at:
            out += (text[at:start], f"<{kind}>")
        at = max(at, end)
    return "".join([*out, text[at:]])


def mask_texts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with personal data replaced by markers; null texts stay null, other columns as they are."""

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else masked(t, find(t)[1]))

    return docs.withColumn(text, clean(F.col(text)))


SPANS = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def pii_spans(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: base counts, digest of the base spans, and all spans."""

    @F.pandas_udf(SPANS)
    def scan(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for source in texts:
            base, spans = find(source)
            counts = [sum(kind == k for k, _, _ in base) for kind in KINDS]
            rows.append((*counts, sha256(joined(base)), joined(spans)))
        return pd.DataFrame(rows, columns=[field.split()[0] for field in SPANS.split(", ")])

    found = docs.select(F.col(id_column).alias("doc_id"), scan(whole_text(text)).alias("found"))
    return found.select("doc_id", "found.*")
