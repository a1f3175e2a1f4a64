"""Fill-in-middle texts by a piece table.

A document is a list of descriptors (buffer, start, length) over two buffers that never change: the UTF-8 bytes of its
text, and the sentinels. Cutting splits a descriptor, an arrangement puts descriptors in another order, and the inverse order
gives the text back. Text is copied only once, when the output is written down; digests are fed descriptor by descriptor.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from logloom.llm.common import pieces as slices

TEXT, SENTINELS = 0, 1
# The sentinels before prefix, suffix and middle.
SENTINEL = {"prefix": b"<P>", "suffix": b"<S>", "middle": b"<M>"}
# Order of the three parts in each form. In the output each part follows its sentinel.
FORMS = {"psm": ("prefix", "suffix", "middle"), "spm": ("suffix", "prefix", "middle")}
TEXT_ORDER = ("prefix", "middle", "suffix")

SENTINEL_BUFFER = b"".join(SENTINEL.values())
OUTPUT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, pieces array<struct<buffer:int,start:long,length:long>>, output string"
DIGESTS = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"


class Piece(NamedTuple):
    buffer: int
    start: int
    length: int


def cut(table: list[Piece], at: int) -> tuple[list[Piece], list[Piece]]:
    """The descriptors before and after byte ``at`` of what the table describes; one that holds it is split."""
    before, after = [], []
    for piece in table:
        left = min(max(at, 0), piece.length)
        if left:
            before.append(Piece(piece.buffer, piece.start, left))
        if left < piece.length:
            after.append(Piece(piece.buffer, piece.start + left, piece.length - left))
        at -= piece.length
    return before, after


def sentinel(part: str) -> Piece:
    return Piece(SENTINELS, SENTINEL_BUFFER.index(SENTINEL[part]), len(SENTINEL[part]))


def arrange(parts: dict[str, list[Piece]], form: str) -> list[Piece]:
    """The descriptors of an output: each part of the form's order behind its sentinel."""
    return [piece for part in FORMS[form] for piece in (sentinel(part), *parts[part])]


def restore(output: bytes, form: str) -> list[Piece]:
    """Descriptors over an output (buffer 0) that give its text: parts between sentinels, in the order of the text."""
    whole = [Piece(TEXT, 0, len(output))]
    if form not in FORMS:
        return whole
    parts, rest, start = {}, whole, 0
    for i, part in enumerate(FORMS[form]):
        _, rest = cut(rest, len(SENTINEL[part]))
        start += len(SENTINEL[part])
        following = FORMS[form][i + 1 : i + 2]
        end = output.index(SENTINEL[following[0]], start) if following else len(output)
        parts[part], rest = cut(rest, end - start)
        start = end
    return [piece for part in TEXT_ORDER for piece in parts[part]]


def stream(table: Iterable[Piece], text: bytes) -> Iterator[memoryview]:
    """The bytes of each descriptor, without a copy."""
    buffers = (memoryview(text), memoryview(SENTINEL_BUFFER))
    for piece in table:
        yield buffers[piece.buffer][piece.start : piece.start + piece.length]


def digest(table: Iterable[Piece], text: bytes) -> str:
    """SHA-256 (lowercase hex) of what the table describes."""
    state = hashlib.sha256()
    for data in stream(table, text):
        state.update(data)
    return state.hexdigest()


def draws(doc_id: int | None, seed: int) -> list[int]:
    """Four numbers of 32 bits that belong to a document id (a null id counts as no digits)."""
    name = f"{seed}:{'' if doc_id is None else doc_id}"
    digits = hashlib.sha256(name.encode()).hexdigest()
    return [int(digits[8 * i : 8 * i + 8], 16) for i in range(4)]


def transformed(doc_id: int | None, text: bytes, seed: int, percent: int, spm_percent: int):
    """(code points, form, code points of prefix and middle or None, descriptors) of one document."""
    chars = text.decode("utf-8", "surrogateescape")
    n = len(chars)
    whole = [Piece(TEXT, 0, len(text))] if text else []
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not text or any(mark in text for mark in SENTINEL.values()) or h3 % 100 >= percent:
        return n, "plain", None, None, whole
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    size = (lambda s: len(s)) if n == len(text) else (lambda s: len(s.encode("utf-8", "surrogateescape")))
    end_of_prefix = size(chars[:first])
    prefix, rest = cut(whole, end_of_prefix)
    middle, suffix = cut(rest, size(chars[first:second]))
    form = "spm" if h4 % 100 < spm_percent else "psm"
    return n, form, first, second - first, arrange({"prefix": prefix, "middle": middle, "suffix": suffix}, form)


def _binary(column: pa.Array) -> list[bytes]:
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]


def fill_in_middle(documents: DataFrame, seed: int = 1, percent: int = 90, spm_percent: int = 20) -> DataFrame:
    """Each document (doc_id, text) with its descriptors and its output, a row for a row.

    Returns doc_id, n (code points of the text), form (``plain``, ``psm`` or ``spm``), prefix_chars, middle_chars (code points, null
    for ``plain``), pieces (buffer 0 is the text, 1 the sentinels; start and length in bytes) and output. Cuts and form follow from
    the doc_id and ``seed`` alone, so that a task that is run again gives the same rows; repeated ids get the same draws,
    and rows that are alike the same output. A null text counts as empty; an empty text, or one that holds a sentinel
    itself, stays plain. Further columns go. Work is narrow: one document at a time, no shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            rows = {name: [] for name in ("n", "form", "prefix_chars", "middle_chars", "pieces", "output")}
            for doc_id, text in zip(batch.column(0).to_pylist(), _binary(batch.column(1))):
                n, form, prefix, middle, table = transformed(doc_id, text, seed, percent, spm_percent)
                for name, value in zip(rows, (n, form, prefix, middle, [piece._asdict() for piece in table], b"".join(stream(table, text)))):
                    rows[name].append(value)
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), PIECES, pa.binary())
            columns = [pa.array(values, kind) for values, kind in zip(rows.values(), kinds)]
            columns[-1] = columns[-1].view(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", *rows])

    return documents.selectExpr("cast(doc_id AS bigint) AS doc_id", "text").mapInArrow(run, OUTPUT)


PIECES = pa.list_(pa.struct([("buffer", pa.int32()), ("start", pa.int64()), ("length", pa.int64())]))


def fim_digests(outputs: DataFrame) -> DataFrame:
    """Digests of outputs and of the texts that come back from output and form alone, both fed descriptor by descriptor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 5):
            written, back = [], []
            for form, output in zip(batch.column(2).to_pylist(), _binary(batch.column(5))):
                written.append(digest([Piece(TEXT, 0, len(output))], output))
                back.append(digest(restore(output, form), output))
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(written, pa.string()), pa.array(back, pa.string())],
                                             [*batch.schema.names[:5], "output_sha256", "restored_sha256"])

    return outputs.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output").mapInArrow(run, DIGESTS)
