"""Operator 3: chat formatting by a finite-state machine over roles.

A ``Template`` says declaratively, per role, what stands before and after a
turn's text, whether the text counts for the loss, and which roles may follow which
(the machine's transitions).  Formatting walks each conversation once in the order of its
turns and emits segments: (conversation, number, role, part, text, loss), where
``part`` is ``open``, ``text`` or ``close``; the segments' texts in order are the formatted
conversation.  Control strings inside texts are broken by an escape mark after their first
character, and marks in texts are doubled, so that a text never holds a
control string and ``read`` gives back roles and texts exactly.

Turns of a conversation are brought together by a shuffle and a sort on
(conversation, turn); tasks stream over them with the state of one conversation, so memory doesn't
depend on a conversation's length.  The digests of a conversation are sequential by
definition: its rows are read by one task, one after another.

Invalid orders (a role after one that it may not follow, a wrong first or
last role, unknown or null roles) are formatted all the same, with the template's fallback
marks for unknown roles, and reported: ``problem`` names the first
transition that isn't allowed (``role`` for unknown ones).

Defined results: a null role is the empty role, a null text the empty text; null
turns come first; ties of a turn are ordered by role and text; repeated rows are turns each; rows with
a null conversation id form one conversation; extra columns are ignored; empty tables give empty results.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<start>", "<end>"


@dataclass(frozen=True)
class Template:
    """``marks``: role -> (before, after); ``{role}`` in ``other`` stands for an unknown role's escaped name."""

    marks: dict
    loss: frozenset
    follows: dict
    other: tuple = ("[ROLE]{role}[:ROLE] ", " [/ROLE]")
    more: tuple = ()
    mark: str = "\\"
    _controls: re.Pattern = field(init=False, repr=False, default=None)

    def __post_init__(self):
        words = {c.strip() for pair in self.marks.values() for c in pair} | set(self.more)
        words |= {c for part in self.other for c in re.split(r"\{role\}", part.strip()) if c.strip()}
        words = {c.strip() for c in words} - {""}
        if any(self.mark in c or len(c) < 2 for c in words) or len(self.mark) != 1:
            raise ValueError("control strings need two characters and no escape mark")
        every = "|".join(re.escape(c) for c in sorted(words, key=lambda c: (-len(c), c)))
        # the look-ahead also finds control strings that overlap
        object.__setattr__(self, "_controls", re.compile(rf"(?=(?:{every}))(.)|({re.escape(self.mark)})", re.S))

    def escape(self, text: str) -> str:
        m = self.mark
        return self._controls.sub(lambda x: m + m if x[2] else x[1] + m, text)

    def unescape(self, text: str) -> str:
        m = re.escape(self.mark)
        return re.sub(rf"{m}({m}?)", r"\1" if self.mark != "\\" else lambda x: x[1], text)

    def turn(self, role: str, text: str) -> list[tuple[str, str, bool]]:
        """Segments (part, text, loss) of one turn."""
        before, after = self.marks.get(role, self.other)
        if role not in self.marks:
            before = before.replace("{role}", self.escape(role))
        return [("open", before, False), ("text", self.escape(text), role in self.loss), ("close", after, False)]

    def step(self, state: str, role: str) -> str | None:
        """What is wrong with ``role`` after ``state``, if anything."""
        if role not in self.marks and role != END:
            return f"role {role}"
        return None if role in self.follows.get(state, ()) else f"{state} > {role}"

    def read(self, text: str) -> list[tuple[str, str]]:
        """Roles and texts of formatted turns; the inverse of formatting."""
        out, at = [], 0
        opens = sorted(((b, a, r) for r, (b, a) in self.marks.items()), key=lambda x: -len(x[0]))
        left, right = self.other[0].split("{role}")
        while at < len(text):
            hit = next(((b, a, r) for b, a, r in opens if text.startswith(b, at)), None)
            if hit:
                before, after, role = hit
                at += len(before)
            elif text.startswith(left, at):
                stop = text.index(right, at + len(left))
                role, after = self.unescape(text[at + len(left):stop]), self.other[1]
                at = stop + len(right)
            else:
                raise ValueError(f"no turn starts at {at}")
            stop = text.index(after.strip(), at) - (len(after) - len(after.lstrip()))
            out.append((role, self.unescape(text[at:stop])))
            at = stop + len(after)
        return out


#: The bracketed instruction format.
INSTRUCTION = Template(
    marks={"system": ("<<SYS>>\n", "\n<</SYS>>\n"), "user": ("[INST] ", " [/INST]"), "assistant": (" ", " </s>")},
    loss=frozenset({"assistant"}),
    follows={START: ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user", END)},
    more=("<s>",),
)


def _ordered(df: DataFrame) -> DataFrame:
    rows = df.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                     F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def segments(df: DataFrame, template: Template = INSTRUCTION) -> DataFrame:
    """(conv_id, segment, role, part, text, loss, problem): the formatted conversations in parts."""
    import pyarrow as pa

    def run(batches):
        conv, state, n, started = None, START, 0, False
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                rb, out = whole.slice(at, 1024), []
                for c, role, text in zip(*(rb.column(k).to_pylist() for k in (0, 2, 3)), strict=True):
                    if not started or c != conv:
                        conv, state, n, started = c, START, 0, True
                    problem, state = template.step(state, role), role
                    for part, s, loss in template.turn(role, text):
                        out.append((c, n, role, part, s, loss, problem))
                        n += 1
                cols = list(zip(*out, strict=True)) if out else [[]] * 7
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.bool_(), pa.string())
                names = ["conv_id", "segment", "role", "part", "text", "loss", "problem"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)

    return _ordered(df).mapInArrow(run, "conv_id long, segment long, role string, part string, text string, loss boolean, problem string")


class _Reader:
    """Reads a conversation's segments one after another and sums them up."""

    def __init__(self, conv, template: Template):
        self.conv, self.t = conv, template
        self.turns = self.loss_chars = self.chars = 0
        self.all, self.loss, self.state, self.problem = hashlib.sha256(), hashlib.sha256(), START, None

    def turn(self, parts: list[tuple[str, str, bool]]) -> None:
        formatted = "".join(s for _, s, _ in parts)
        (role, text), = self.t.read(formatted)
        self.turns += 1
        self.chars += len(formatted)
        self.all.update(f"{role}\n{text}\n".encode())
        masked = "".join(self.t.unescape(s) for _, s, loss in parts if loss)
        self.loss_chars += len(masked)
        self.loss.update(masked.encode())
        self.problem = self.problem or self.t.step(self.state, role)
        self.state = role

    def row(self):
        return (self.conv, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, self.problem or self.t.step(self.state, END))


def digests(df: DataFrame, template: Template = INSTRUCTION) -> DataFrame:
    """Formats, reads the output back and sums it up per conversation."""
    import pyarrow as pa

    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "problem"]
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string())

    def rows(done):
        cols = list(zip(*(r.row() for r in done), strict=True)) if done else [[]] * 7
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)

    def run(batches):
        reader, parts = None, []
        for rb in batches:
            done = []
            for c, part, s, loss in zip(*(rb.column(k).to_pylist() for k in (0, 3, 4, 5)), strict=True):
                if reader is None or reader.conv != c:
                    if reader:
                        done.append(reader)
                    reader = _Reader(c, template)
                parts.append((part, s, loss))
                if part == "close":
                    reader.turn(parts)
                    parts = []
            yield rows(done)
        if reader:
            yield rows([reader])

    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, problem string"
    return segments(df, template).mapInArrow(run, schema)
