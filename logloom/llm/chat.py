"""Chat formatting: a state machine over roles, a declarative template, text segments with loss flags."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START = ""


@dataclass(frozen=True)
class Template:
    """What a formatted conversation looks like.

    ``turns`` has the marks before and after the text of each known role; other roles use ``other``, whose first mark
    names the role in place of ``{role}``. ``next_roles`` is the state machine: which roles may follow a role, from
    ``START`` on. Text of ``loss_roles`` is trained on. A control string inside a text or role gets ``\\-`` after its first
    character, and each backslash is doubled; reading takes both back. No control string may begin and end alike.
    """

    turns: dict[str, tuple[str, str]] = field(default_factory=lambda: {
        "system": ("<<SYS>>\n", "\n<</SYS>>\n"), "user": ("[INST] ", " [/INST]"), "assistant": ("<s>", "</s>")})
    other: tuple[str, str] = ("<|turn {role}|>", "<|end|>")
    next_roles: dict[str, frozenset] = field(default_factory=lambda: {
        START: frozenset({"system", "user"}), "system": frozenset({"user"}), "user": frozenset({"assistant"}), "assistant": frozenset({"user"})})
    loss_roles: frozenset = frozenset({"assistant"})

    def controls(self) -> list[str]:
        before, after = self.other
        marks = [mark for pair in self.turns.values() for mark in pair] + [before.split("{role}")[0], before.split("{role}")[1], after]
        return [mark.strip() for mark in marks]

    def escape(self, text: str) -> str:
        text = text.replace("\\", "\\\\")
        for control in self.controls():
            if control in text:
                text = text.replace(control, f"{control[0]}\\-{control[1:]}")
        return text

    @staticmethod
    def unescape(text: str) -> str:
        return re.sub(r"\\(\\|-)", lambda found: "\\" if found[1] == "\\" else "", text)

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        """(text, loss) of one turn, in order."""
        if role in self.turns:
            before, after = self.turns[role]
        else:
            before, after = self.other[0].replace("{role}", self.escape(role)), self.other[1]
        return [(before, False), (self.escape(text), role in self.loss_roles), (after, False)]

    def read(self, formatted: str) -> list[tuple[str, str]]:
        """(role, text) of each turn of a formatted text."""
        turns, at = [], 0
        head, tail = self.other[0].split("{role}")
        while at < len(formatted):
            role = next((role for role, (before, _) in self.turns.items() if formatted.startswith(before, at)), None)
            if role is not None:
                start, after = at + len(self.turns[role][0]), self.turns[role][1]
            elif formatted.startswith(head, at):
                close = formatted.index(tail, at + len(head))
                role, start, after = self.unescape(formatted[at + len(head) : close]), close + len(tail), self.other[1]
            else:
                raise ValueError(f"no turn begins at character {at}")
            end = formatted.index(after, start)
            turns.append((role, self.unescape(formatted[start:end])))
            at = end + len(after)
        return turns


def format_conversations(conversations: DataFrame, template: Template = Template()) -> DataFrame:
    """One row per turn: conv_id, position (from 0), segments (array of text and loss), valid, in order within a partition.

    Turns are in order of ``turn``, nulls last, ties by role and text; repeated rows are repeated turns. A null text or role is
    empty; rows with a null conv_id are one conversation. ``valid`` says whether the roles up to here are in an
    order that the state machine allows; what it does not allow is formatted all the same. A conversation passes one
    task, turn by turn, and is never held as a whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, role_before, position, valid = object(), START, 0, True
        for batch in batches:
            conv_ids, positions, segments, valids = batch.column(0).to_pylist(), [], [], []
            for conv_id, role, text in zip(conv_ids, batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                role, text = role or "", text or ""
                if conv_id != here:
                    here, role_before, position, valid = conv_id, START, 0, True
                valid = valid and role in template.next_roles.get(role_before, ())
                positions.append(position)
                segments.append([{"text": part, "loss": loss} for part, loss in template.segments(role, text)])
                valids.append(valid)
                role_before, position = role, position + 1
            kind = pa.list_(pa.struct([("text", pa.string()), ("loss", pa.bool_())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(positions, pa.int64()), pa.array(segments, kind), pa.array(valids, pa.bool_())],
                ["conv_id", "position", "segments", "valid"])

    ordered = conversations.select("conv_id", "turn", "role", "text").repartition("conv_id").sortWithinPartitions(
        F.col("conv_id").asc(), F.col("turn").asc_nulls_last(), "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(
        run, "conv_id long, position long, segments array<struct<text: string, loss: boolean>>, valid boolean")


def conversation_digests(formatted: DataFrame, template: Template = Template()) -> DataFrame:
    """What can be read back of each formatted conversation, from rows as ``format_conversations`` orders them.

    conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, valid. Turns are parsed out of the formatted
    text, and hashed as they come.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for batch in batches:
            done = []
            for conv_id, position, segments, valid in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if state is None or position == 0:
                    done += [state] if state else []
                    state = _Digest(conv_id)
                state.add(segments, valid, template)
            if done:
                yield _digest_batch(done)
        if state:
            yield _digest_batch([state])

    return formatted.mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean")


class _Digest:
    def __init__(self, conv_id):
        self.conv_id, self.n_turns, self.loss_chars, self.chars, self.valid = conv_id, 0, 0, 0, True
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, segments, valid, template):
        text = "".join(segment["text"] for segment in segments)
        for role, content in template.read(text):
            self.n_turns += 1
            self.turns.update(f"{role}\n{content}\n".encode())
        under_loss = "".join(template.unescape(segment["text"]) for segment in segments if segment["loss"])
        self.loss.update(under_loss.encode())
        self.loss_chars += len(under_loss)
        self.chars += len(text)
        self.valid = self.valid and valid


def _digest_batch(done: list[_Digest]) -> pa.RecordBatch:
    rows = [(d.conv_id, d.n_turns, d.turns.hexdigest(), d.loss_chars, d.loss.hexdigest(), d.chars, d.valid) for d in done]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "valid"]
    return pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)], names)
