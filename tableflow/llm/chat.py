"""Chat formatting whose output is proved by reading it back with a deterministic parser."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableflow.llm.common import table

# The grammar, with alternatives told apart by how a turn begins:
#   conversation := turn*
#   turn := "<<SYS>>" body "<</SYS>>"                      role system
#         | "<s>[INST] " body " [/INST]"                   role user
#         | " " body "</s>"                                role assistant
#         | "<<ROLE>>" body "<</ROLE>>" body "</s>"        any other role, named by the first body
# A body holds no control string; one in a text gets a backslash behind its first character, and so does every
# string that already looks like that, so taking one backslash away gives the text again.
_TURN = re.compile(
    r"<<SYS>>(?P<system>.*?)<</SYS>>|<s>\[INST\] (?P<user>.*?) \[/INST\]| (?P<assistant>.*?)</s>"
    r"|<<ROLE>>(?P<role>.*?)<</ROLE>>(?P<other>.*?)</s>",
    re.DOTALL,
)
_CONTROL = re.compile(r"(<|\[)(\\*)(/?s>|/?INST\]|<(?:/?SYS|/?ROLE)>>)")
_CONTROL_RAW = re.compile(r"</?s>|\[/?INST\]|<</?(?:SYS|ROLE)>>")
_ROLES = ("system", "user", "assistant")
_ESCAPED = re.compile(r"(<|\[)\\(\\*)(/?s>|/?INST\]|<(?:/?SYS|/?ROLE)>>)")


def escape(text: str) -> str:
    return _CONTROL.sub(r"\1\\\2\3", text)


def unescape(body: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", body)


def _render(role: str, text: str) -> tuple[str, str]:
    """What comes before the body of a turn, and what comes after."""
    if role == "system":
        return "<<SYS>>", "<</SYS>>"
    if role == "user":
        return "<s>[INST] ", " [/INST]"
    if role == "assistant":
        return " ", "</s>"
    return f"<<ROLE>>{role}<</ROLE>>", "</s>"


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns ``(role, text)`` of formatted text; ``ValueError`` if it is not a conversation of the grammar."""
    turns, at = turns_of(formatted)
    if at < len(formatted):
        raise ValueError(f"no turn at character {at}")
    return turns


def turns_of(formatted: str) -> tuple[list[tuple[str, str]], int]:
    """The whole turns that formatted text begins with, and where they end."""
    turns, at = [], 0
    while match := _TURN.match(formatted, at):
        kind = match.lastgroup
        role = unescape(match["role"]) if kind == "other" else kind
        turns.append((role, unescape(match[kind])))
        at = match.end()
    return turns, at


def render(role: str, text: str) -> tuple[str, int, int]:
    """A turn as formatted text, and where its body begins and ends.

    The plain rendering is parsed; if other turns come back than went in, or the text holds a control string, what
    conflicts is escaped and it is parsed again. So no control string of an output comes from a text.
    """
    for name, body in ((role, text), (role, escape(text)), (escape(role), escape(text))):
        if _CONTROL_RAW.search(body) or (role not in _ROLES and _CONTROL_RAW.search(name)):
            continue
        before, after = _render(name, body)
        formatted = before + body + after
        try:
            if parse(formatted) == [(role, text)]:
                return formatted, len(before), len(before) + len(body)
        except ValueError:
            pass
    raise ValueError(f"a turn that cannot be formatted: {role!r}")


_FORMATTED = "conv_id long, position long, formatted string, is_loss boolean, loss_start long, loss_end long"


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, position, at = object(), 0, 0
    for batch in batches:
        rows = []
        for conv_id, role, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
            if conv_id != now:
                now, position, at = conv_id, 0, 0
            formatted, first, last = render(role or "", text or "")
            rows.append((conv_id, position, formatted, role == "assistant", at + first, at + last))
            position, at = position + 1, at + len(formatted)
        columns = list(zip(*rows)) or [()] * 6
        types = (pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.int64(), pa.int64())
        yield pa.record_batch(
            [pa.array(c, t) for c, t in zip(columns, types)],
            names=["conv_id", "position", "formatted", "is_loss", "loss_start", "loss_end"],
        )


def format_chat(conversations: DataFrame) -> DataFrame:
    """Each turn as formatted text: ``conv_id, position, formatted, is_loss, loss_start, loss_end``.

    The formatted conversation is its ``formatted`` in order of ``position``; the loss mask covers the characters from
    ``loss_start`` to ``loss_end`` of it where ``is_loss``, the texts of assistants and nothing else. Turns are streamed
    in order of ``turn`` (null first; ties by role and text), so a conversation of any length needs the memory of one
    turn. The rows of a conversation stay together and in order. Null texts and roles are empty, repeated rows are
    repeated turns, a null ``conv_id`` is a conversation, and other columns are ignored.
    """
    rows = conversations.select("conv_id", "role", "text", "turn").repartition("conv_id")
    ordered = rows.sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
    return ordered.mapInArrow(_format, _FORMATTED)


_DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    class Reader:
        def __init__(self, conv_id):
            self.conv_id, self.n, self.chars, self.loss_chars = conv_id, 0, 0, 0
            # What has come of the joined conversation and is no whole turn yet.
            self.held = ""
            self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

        def read(self, formatted, is_loss, first, last):
            self.held += formatted
            turns, at = turns_of(self.held)
            self.held = self.held[at:]
            for role, text in turns:
                self.n += 1
                self.turns.update(f"{role}\n{text}\n".encode())
            if is_loss:
                learnt = unescape(formatted[first - self.chars : last - self.chars])
                self.loss_chars += len(learnt)
                self.loss.update(learnt.encode())
            self.chars += len(formatted)

        def row(self):
            if self.held:
                raise ValueError(f"conversation {self.conv_id} does not end with a turn")
            return self.conv_id, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars

    def out(rows):
        columns = list(zip(*rows)) or [()] * 6
        types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    reader = None
    for batch in batches:
        done = []
        for conv_id, position, *rest in zip(*(batch.column(k).to_pylist() for k in range(6))):
            if position == 0:
                if reader:
                    done.append(reader.row())
                reader = Reader(conv_id)
            reader.read(*rest)
        yield out(done)
    if reader:
        yield out([reader.row()])


def read_chat(formatted: DataFrame) -> DataFrame:
    """Per conversation of ``format_chat``'s rows, as they come: digests of the turns and of the text under the mask.

    The joined conversation is parsed as a stream, turn by turn, with no regard to the rows it comes in.
    """
    return formatted.mapInArrow(_read_back, _DIGEST)


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    control = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-7, 0, "user", control), (-7, 1, "assistant", control)], "conv_id long, turn long, role string, text string"
    )
    given = table(spark, sf_dir, "conversations").select(*[F.col(c) for c in extra.columns])
    return read_chat(format_chat(given.unionByName(extra)))
