"""Text as positioned lines.

A *lines* frame has the columns ``stream, part, block, pos, line``. ``(part, block, pos)`` gives the
order of the lines inside a stream. Blocks hold at most ``2**BLOCK_BITS`` lines and parts a bounded
number of blocks, so work per block or per part stays small however long one stream is.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logloom.functions.settle import settle
from logloom.functions.text import charset_name, decode_bytes, split_lines

BLOCK_BITS = 14
PART_BITS = 26

# Bytes in a unit of the wide charsets; where files are cut, and the rest of a newline before that. With the low byte
# first a newline is all one mark; with the low byte last it starts with zeros like so much else, and the cut is at its last byte.
WIDE_NEWLINES = {"utf-16-le": (2, b"\n\0", b""), "utf-16-be": (2, b"\n", b"\0"), "utf-32-le": (4, b"\n\0\0\0", b""), "utf-32-be": (4, b"\n", b"\0\0\0")}

# Columns of pieces whose cuts are placed in their file, and of pieces joined inside their split.
JOINED = ("file", "order", "start", "before", "closed")
JOINED_NAMES = [*JOINED, "piece", "ended", "side"]
JOINED_SCHEMA = "file string, `order` string, start bigint, before bigint, closed boolean, piece binary, ended boolean, side int"
# Far over all ids of rows: puts lines before all others of their split, or behind them.
FAR = 1 << 62

# Endings of names of compressed files.
COMPRESSED = r"\.(gz|bz2|zst|xz|lz4|snappy|deflate)\z"


def number_lines(lines: DataFrame, block_bits: int = BLOCK_BITS, part_bits: int = PART_BITS) -> DataFrame:
    """Lines frame from ``stream, pos, line`` rows, where ``pos`` is a whole number unique in its stream."""
    pos = F.col("pos").cast("bigint")
    return lines.select(
        "stream",
        F.shiftright(pos, part_bits).alias("part"),
        F.shiftright(pos, block_bits).alias("block"),
        pos.alias("pos"),
        "line",
    )


def parent_directory(path: Column) -> Column:
    """Stream key for rolled logs: all files of a directory are one stream, in name order."""
    return F.regexp_replace(path, r"/[^/]*\z", "")


def _natural(path: Column, falling: bool) -> Column:
    """Sort key of a file's name: its numbers count as numbers of any length, an ending of compression does not count.

    A name that goes on after another one ends (``log.1`` and ``log``) is the older file.
    """
    name = F.regexp_replace(F.regexp_extract(path, r"([^/]*)\z", 1), COMPRESSED, "")
    turned = (lambda digits: F.translate(digits, "0123456789", "9876543210")) if falling else (lambda digits: digits)

    def part(text: Column) -> Column:
        digits = F.regexp_replace(text, r"\A0+(?=[0-9])", "")
        # The number's length comes first, so that numbers are in order as text.
        return F.when(text.rlike("[0-9]"), turned(F.concat(F.lpad(F.length(digits).cast("string"), 6, "0"), digits))).otherwise(text)

    return F.concat(F.array_join(F.transform(F.regexp_extract_all(name, F.lit(r"([0-9]+|[^0-9]+)"), F.lit(1)), part), ""), F.lit("~"))


def rising_suffix(path: Column, modified: Column) -> Column:
    """Order of rolled files whose numbers rise (``log.1, log.2.gz, log.10, log`` or ``log-2024-01-31, log-2024-02-01.gz, log``)."""
    return _natural(path, False)


def falling_suffix(path: Column, modified: Column) -> Column:
    """Order of rolled files that are renamed as they age (``log.10.gz, log.2.gz, log.1, log``)."""
    return _natural(path, True)


def modification_order(path: Column, modified: Column) -> Column:
    """Order by modification time, as text of fixed width."""
    return F.lpad(F.unix_micros(modified).cast("string"), 20, "0")


def read_lines(
    spark: SparkSession,
    path: str | list[str],
    charset: str = "UTF-8",
    stream_of=None,
    block_bits: int = BLOCK_BITS,
    order_of=None,
) -> DataFrame:
    """Read text files as lines; ``\\n``, ``\\r`` and ``\\r\\n`` end a line.

    ``stream_of`` maps the file path column to the stream key; by default each file is a stream of
    its own. Files are cut into splits as usual: the row id rises inside a split, so (file, start of
    the split, row id) is the order of the file, whichever task reads which split.

    The files of a stream follow each other by path, as text. ``order_of`` maps the columns of file path and modification
    time to another order, such as :func:`rising_suffix`; the path then decides ties.
    """
    name = charset_name(charset)
    if name in WIDE_NEWLINES:
        return read_wide_lines(spark, path, name, stream_of, block_bits, order_of)
    if name in ("utf-16", "utf-32"):
        # Only the start of a file tells the order of its bytes. Name it (``UTF-16LE``) to have files read in splits.
        return read_whole_files(spark, path, charset, stream_of, block_bits, order_of)
    stream = stream_of or (lambda file: file)
    row = F.monotonically_increasing_id()
    raw = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        _order(order_of, F.col("_metadata.file_path"), F.col("_metadata.file_modification_time")).alias("order"),
        F.col("_metadata.file_block_start").alias("start"),
        row.alias("pos"),
        "value",
    )
    return raw.select(
        stream(F.col("file")).alias("stream"),
        F.struct("order", "file", "start").alias("part"),
        F.shiftright("pos", block_bits).alias("block"),
        "pos",
        decode_bytes(F.col("value"), charset).alias("line"),
    )


def _order(order_of, path: Column, modified: Column) -> Column:
    return F.lit("") if order_of is None else order_of(path, modified)


def read_wide_lines(
    spark: SparkSession, path: str | list[str], charset: str, stream_of=None, block_bits: int = BLOCK_BITS, order_of=None
) -> DataFrame:
    """Lines of files whose characters have two or four bytes, read in splits like others.

    Files are cut at the bytes of a newline wherever they stand. Such bytes may also be part of other characters, or the end of one and the
    start of the next. In a file where every piece is a whole number of units and ends like a line, every cut is a newline; its lines
    are ready, without a shuffle. In the others (some scripts have such characters) lengths are added up, by split and
    over splits, and pieces are joined up to the next cut that is a newline: inside a split where it is read, so that only
    what stands at the edges of splits is shuffled.
    """
    unit, mark, rest = WIDE_NEWLINES[charset]
    stream = stream_of or (lambda file: file)
    size = F.octet_length("piece")
    ends = F.substring("piece", -len(rest), len(rest)) == F.lit(rest) if rest else F.lit(True)
    raw = spark.read.text(path, lineSep=mark.decode()).select(
        F.col("_metadata.file_path").alias("file"),
        _order(order_of, F.col("_metadata.file_path"), F.col("_metadata.file_modification_time")).alias("order"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("value").cast("binary").alias("piece"),
    )
    regular = ends & ((size + len(mark)) % unit == 0)
    splits = raw.select("file", "start", size.alias("size"), ends.alias("ends")).mapInArrow(
        _split_facts(unit, mark), "file string, start bigint, bytes bigint, odd bigint, regular boolean, whole boolean, cuts int")
    by_file = Window.partitionBy("file")
    earlier = by_file.orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    end = F.max(F.struct("start", "regular", "whole")).over(by_file)
    # The last piece of a file need not end like a line.
    plain = F.sum("odd").over(by_file) <= F.when(end["whole"] & ~end["regular"], 1).otherwise(0)
    placed = splits.select("file", "start", "cuts", F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("before"),
                           (F.sum("bytes").over(by_file) % unit == 0).alias("closed"), plain.alias("plain"))
    placed = placed.withColumn("newline", F.getbit("cuts", (F.col("before") % unit).cast("int")).cast("int"))
    placed = placed.withColumn("ahead", F.coalesce(F.sum("newline").over(earlier), F.lit(0)))
    mixed = placed.where("NOT plain").select(F.col("file").alias("_file"), F.col("start").alias("_start"), "before", "closed", "newline", "ahead")
    # So that what the joins below take of it is the same, and computed once.
    mixed = settle(mixed, *mixed.columns)
    # A row for each split, which the driver has planned one by one. Broadcast, as pieces must stay in the order they are read.
    of_split = (F.col("file") == F.col("_file")) & (F.col("start") == F.col("_start"))
    ready = raw.join(F.broadcast(mixed), of_split, "left_anti").withColumn("ended", regular)
    placed = raw.withColumn("ends", ends).join(F.broadcast(mixed), of_split)
    joined = lambda edges: placed.select(*JOINED, "piece", "ends").mapInArrow(_join_in_splits(unit, mark, edges), JOINED_SCHEMA)
    parts = []
    # Ids given to the rows rise in the order of the lines. What was joined at the start of a split is before its other lines, at its end behind them.
    for pieces, first in ((ready.withColumn("side", F.lit(0)), 0), (joined(False), 0), (_joined_edges(joined(True).join(F.broadcast(mixed.drop("before", "closed")), of_split), mark), FAR)):
        line = F.when(F.col("ended"), F.substr(F.col("piece"), F.lit(1), F.octet_length("piece") - len(rest))).otherwise(F.col("piece"))
        texts = pieces.select("file", "order", "start", "side", decode_bytes(line, charset).alias("text"))
        lines = texts.select("file", "order", "start", "side", _wide_lines(F.col("text")))
        parts.append(lines.withColumn("pos", F.monotonically_increasing_id() + F.col("side") * F.lit(first)))
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).select(
        stream(F.col("file")).alias("stream"), F.struct("order", "file", "start").alias("part"),
        F.shiftright("pos", block_bits).alias("block"), "pos", "line")


def _wide_lines(text: Column) -> Column:
    r"""The lines of a text between newlines; ``\r`` ends a line too, and one at the end belongs to the newline."""
    lines = F.split(F.regexp_replace(text, r"\r\z", ""), r"\r", -1)
    return F.explode(F.when(F.contains(text, F.lit("\r")), lines).otherwise(F.array(text))).alias("line")


def _split_facts(unit: int, mark: bytes):
    """Of each split, by the sizes of its pieces: its bytes, how many of its pieces are not ``regular``, whether the last one is and whether it is whole
    units, and in which places of a unit it may start so that one of its cuts is a newline (a bit for each)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, bytes_, odd, last, cuts = None, 0, 0, (False, False), 0
        for batch in batches:
            out = []
            for *key, size, ends in zip(*[column.to_pylist() for column in batch.columns]):
                if key != of:
                    if of:
                        out.append((*of, bytes_, odd, *last, cuts))
                    of, bytes_, odd, cuts = key, 0, 0, 0
                bytes_ += size + len(mark)
                last = (ends and (size + len(mark)) % unit == 0, size % unit == 0)
                odd += not last[0]
                if ends:
                    cuts |= 1 << -bytes_ % unit
            yield _record_batch(out)
        if of:
            yield _record_batch([(*of, bytes_, odd, *last, cuts)])

    def _record_batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) if rows else [()] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(columns, kinds.values())], list(kinds))

    kinds = {"file": pa.string(), "start": pa.int64(), "bytes": pa.int64(), "odd": pa.int64(), "regular": pa.bool_(), "whole": pa.bool_(), "cuts": pa.int32()}
    return run


def _join_in_splits(unit: int, mark: bytes, edges: bool):
    """Pieces of splits, in order, joined up to the next cut that is a newline: those at the edges of splits, or all others.

    ``side`` is -1 for what ends with the first newline of its split, 1 for what has none behind it in its split, 0 for the rest.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, place, held, side = None, 0, [], -1
        for batch in batches:
            names = batch.schema.names
            out = []
            for *of, piece, ends in zip(*[batch.column(name).to_pylist() for name in names]):
                if of != key:
                    if held and edges:
                        out.append((*key, mark.join(held), False, 1))
                    key, place, held, side = of, of[names.index("before")], [], -1
                held.append(piece)
                place += len(piece) + len(mark)
                if ends and place % unit == 0:
                    if edges == (side != 0):
                        out.append((*key, mark.join(held), True, side))
                    held, side = [], 0
            yield _record_batch(out)
        if held and edges:
            yield _record_batch([(*key, mark.join(held), False, 1)])

    def _record_batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) if rows else [()] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(columns, kinds)], JOINED_NAMES)

    kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.bool_(), pa.int32()]
    return run


def _joined_edges(edges: DataFrame, mark: bytes) -> DataFrame:
    """Edges of splits joined up to the next newline: ``file, order, start, piece, ended, side``, in order.

    ``ahead`` is the number of earlier splits of the file that have a newline, ``newline`` tells of the split itself. The last edge of a
    ``closed`` file has a cut behind it, which is part of its text if it is no newline.
    """
    # A split has at most one edge that ended, before one that did not.
    number = F.col("ahead") + F.when(F.col("ended"), 0).otherwise(F.col("newline"))
    groups = edges.withColumn("number", number).groupBy("file", "order", "number").agg(
        F.sort_array(F.collect_list(F.struct("start", "side", "piece"))).alias("pieces"), F.max("ended").alias("ended"), F.first("closed").alias("closed"))
    between = mark.hex().upper()
    hexes = F.array_join(F.transform("pieces", lambda p: F.hex(p["piece"])), between)
    hexes = F.concat(hexes, F.when(~F.col("ended") & F.col("closed"), between).otherwise(""))
    first = F.element_at("pieces", 1)
    whole = groups.select("file", "order", first["start"].alias("start"), first["side"].alias("side"), "number", F.unhex(hexes).alias("piece"), "ended")
    # By file and split, so that ids given to the rows rise in the order of the lines.
    return whole.repartition("file", "start").sortWithinPartitions("file", "start", "number").drop("number")


def read_whole_files(
    spark: SparkSession, path: str | list[str], charset: str = "UTF-8", stream_of=None, block_bits: int = BLOCK_BITS, order_of=None
) -> DataFrame:
    """Lines of files that are read in one piece each: lookup files, and charsets that cannot be split.

    Unlike :func:`read_lines` it may stand on the static side of a streaming join.
    """
    stream = stream_of or (lambda file: file)
    paths = [path] if isinstance(path, str) else path
    files = spark.read.format("binaryFile").load(paths)
    order = _order(order_of, F.col("path"), F.col("modificationTime"))
    text = files.select(F.col("path").alias("file"), order.alias("order"), decode_bytes(F.col("content"), charset).alias("text"))
    rows = text.select("file", "order", F.posexplode(split_lines(F.col("text"))).alias("pos", "line"))
    pos = F.col("pos").cast("bigint")
    return rows.select(
        stream(F.col("file")).alias("stream"),
        F.struct("order", "file", F.lit(0).cast("bigint").alias("start")).alias("part"),
        F.shiftright(pos, block_bits).alias("block"),
        pos.alias("pos"),
        "line",
    )


def chunk_rows(files: DataFrame, stream_of=parent_directory, order_of=None) -> DataFrame:
    """Chunks frame (``stream, chunk, lines``) from whole-text rows that carry ``_metadata``.

    Chunks are in order of their name, or of the text that ``order_of`` gives (:func:`rising_suffix`,
    :func:`modification_order`), which then comes before the path in ``chunk``.
    """
    file = F.col("_metadata.file_path")
    chunk = file
    if order_of is not None:
        chunk = F.concat(order_of(file, F.col("_metadata.file_modification_time")), F.lit(" "), file)
    return files.select(
        stream_of(file).alias("stream"), chunk.alias("chunk"), split_lines(F.col("value")).alias("lines")
    )


def read_chunk_stream(
    spark: SparkSession, path: str, max_files_per_trigger: int = 20, stream_of=parent_directory, order_of=None
) -> DataFrame:
    """Rolled log chunks as a stream: one row per file with its lines in order.

    Chunks must end at a line end and be named in order inside their directory, or be put in order by ``order_of`` (see
    :func:`chunk_rows`). A micro-batch takes at most ``max_files_per_trigger`` of them.
    """
    files = (
        spark.readStream.format("text")
        .option("wholetext", True)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .load(path)
    )
    return chunk_rows(files, stream_of, order_of)
