"""Chat formatting that is checked by reading it back.

Template: ``<s>[INST] `` user ``[/INST]``, ``<s>[SYS] `` system ``[/SYS]``, ``<s>[ANS] `` assistant ``</s>``
and ``<s>[ROLE] name[:] text[/ROLE]`` for any other role. A control string inside a text gets a
backslash after its first character, and one that already has backslashes there gets one more, so every
text can be written and read back. A turn is first written as it is, read back by the parser and
compared; only if that differs is it written with escapes.

Rows are spread by conversation and sorted by turn within partitions, so a conversation of any length
streams through one task in bounded memory and is never gathered in a row.

Edge cases: null text and null role are empty; a null conversation id is a conversation of its own;
null turns come first; equal turns are ordered by role and text; repeated rows are repeated turns; an
empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START = "<s>"
# What opens and closes the text of each role.
MARKS = {"user": ("[INST] ", "[/INST]"), "system": ("[SYS] ", "[/SYS]"), "assistant": ("[ANS] ", "</s>")}
OTHER, NAME_END, OTHER_END = "[ROLE] ", "[:] ", "[/ROLE]"
CONTROLS = (START, OTHER, NAME_END, OTHER_END, *(mark for pair in MARKS.values() for mark in pair))
# The first character of a control string, the backslashes after it, and the rest.
_PARTS = "|".join(re.escape(c[0]) + r"\\*" + re.escape(c[1:]) for c in sorted(CONTROLS, key=len, reverse=True))
CONFLICT = re.compile(rf"(?:{_PARTS})")
ESCAPED = re.compile(rf"(?:{_PARTS.replace(r'\\*', r'\\+')})")
OPENERS = {opener: (role, closer) for role, (opener, closer) in MARKS.items()}
OPENING = re.compile("|".join(map(re.escape, [*OPENERS, OTHER])))


def escape(text: str) -> str:
    return CONFLICT.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return ESCAPED.sub(lambda m: m[0][0] + m[0][2:], text)


def written(role: str, text: str) -> tuple[str, int, int]:
    """A turn with its marks; start and end of its text."""
    if role in MARKS:
        opener, closer = MARKS[role]
        head = START + opener
    else:
        head, closer = START + OTHER + role + NAME_END, OTHER_END
    return head + text + closer, len(head), len(head) + len(text)


def parse(text: str, at: int = 0) -> tuple[str, str, int, int, int] | None:
    """The turn that starts at ``at``: role, text, start and end of the written text, end of the turn.

    None if no whole turn starts there.
    """
    if not text.startswith(START, at):
        return None
    mark = OPENING.match(text, at + len(START))
    if not mark:
        return None
    start = mark.end()
    if mark[0] == OTHER:
        end = text.find(NAME_END, start)
        if end < 0:
            return None
        role, closer, start = unescape(text[start:end]), OTHER_END, end + len(NAME_END)
    else:
        role, closer = OPENERS[mark[0]]
    end = text.find(closer, start)
    return None if end < 0 else (role, unescape(text[start:end]), start, end, end + len(closer))


def render(role: str, text: str) -> tuple[str, int, int]:
    """Write a turn, escaping more until the parser gives back the same role and text."""
    for name, body in ((role, text), (role, escape(text)), (escape(role), escape(text))):
        out, start, end = written(name, body)
        # A mark inside a text must not be read as one even when it does not disturb this turn.
        if body is text and CONFLICT.search(text):
            continue
        if parse(out) == (role, text, start, end, len(out)):
            return out, start, end
    raise ValueError("a turn does not read back as written")


PIECES = "conv_id long, piece long, formatted string, loss_start long, loss_end long"


def format_conversations(turns: DataFrame) -> DataFrame:
    """Formatted conversations in pieces, one per turn, in order within each partition.

    A conversation's pieces joined in order are its formatted text; ``loss_start`` and ``loss_end`` are
    code points in the whole formatted text, null for turns that carry no loss.
    """
    turns = turns.select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, piece, size = object(), 0, 0
        for batch in batches:
            rows = []
            for conv, role, text in zip(batch["conv_id"], batch["role"], batch["text"], strict=True):
                conv = None if pd.isna(conv) else int(conv)
                if conv != current:
                    current, piece, size = conv, 0, 0
                out, start, end = render(role, text)
                loss = (size + start, size + end) if role == "assistant" else (None, None)
                rows.append((conv, piece, out, *loss))
                piece, size = piece + 1, size + len(out)
            yield _frame(rows, PIECES)

    return ordered.mapInPandas(write, PIECES)


def _frame(rows: list[tuple], schema: str) -> pd.DataFrame:
    fields = [field.split() for field in schema.split(", ")]
    frame = pd.DataFrame(rows, columns=[name for name, _ in fields])
    return frame.astype({name: "Int64" for name, kind in fields if kind == "long"})


class Reader:
    """Reads a formatted conversation as its pieces arrive and sums up what it finds."""

    def __init__(self) -> None:
        self.n_turns, self.size, self.n_loss = 0, 0, 0
        self.rest = ""
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, piece: str) -> None:
        self.rest += piece
        at = 0
        while turn := parse(self.rest, at):
            role, text, _, _, at = turn
            self.n_turns += 1
            self.turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            if role == "assistant":
                self.n_loss += len(text)
                self.loss.update(text.encode("utf-8", "surrogatepass"))
        self.size += len(piece)
        self.rest = self.rest[at:]

    def row(self, conv: int | None) -> tuple:
        if self.rest:
            raise ValueError("a formatted conversation does not end with a whole turn")
        return conv, self.n_turns, self.turns.hexdigest(), self.n_loss, self.loss.hexdigest(), self.size


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(pieces: DataFrame) -> DataFrame:
    """One row per conversation, from pieces as ``format_conversations`` leaves them."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, reader, begun = None, Reader(), False
        for batch in batches:
            rows = []
            for conv, piece, text in zip(batch["conv_id"], batch["piece"], batch["formatted"], strict=True):
                if piece == 0:
                    if begun:
                        rows.append(reader.row(current))
                    current, reader, begun = None if pd.isna(conv) else int(conv), Reader(), True
                reader.add(text)
            yield _frame(rows, DIGESTS)
        if begun:
            yield _frame([reader.row(current)], DIGESTS)

    return pieces.mapInPandas(read, DIGESTS)


def recovered_turns(pieces: DataFrame) -> DataFrame:
    """The turns that the formatted pieces hold: conv_id, turn number, role and text."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            turns = [parse(text)[:2] for text in batch["formatted"]]
            yield pd.DataFrame(
                {
                    "conv_id": batch["conv_id"].astype("Int64"),
                    "turn": batch["piece"],
                    "role": [role for role, _ in turns],
                    "text": [text for _, text in turns],
                }
            )

    return pieces.mapInPandas(read, "conv_id long, turn long, role string, text string")
