"""Multi-line assembly: physical lines to logical events.

A line that ends with the terminator closes an event. After that the next empty line is dropped as a
separator, even when other lines come first; in a segment that follows no terminator nothing is
dropped. Lines after the last terminator of a stream belong to no event.

A stream may be far too long for one task, so it is never sorted or folded as a whole. Each block of
lines is cut by itself into a head (up to its first terminator), whole events, and a tail (after its
last one). Only heads and tails meet again, grouped by the event they belong to; which event that is
follows from counting the blocks that hold a terminator. The text is read and shuffled once, by block;
whole events, edges and marks of blocks all come from that one exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from logloom.functions.settle import settle

# Fixed value: the default glue between the lines of an event.
LINE_GLUE = " § "


def check_terminator(terminator: str) -> str:
    if not terminator:
        raise ValueError("an event terminator is required and must not be empty")
    return terminator


def cut_block(blocks: DataFrame, terminator: str) -> DataFrame:
    """Cut the array column ``lines`` of each row at its terminators.

    ``at`` holds the positions of the lines. Both are replaced by ``head``, ``whole`` (array of
    ``pos, lines``, with the position of the closing line), ``tail`` and ``tail_at`` (positions of the
    tail's lines), ``head_end`` (position of the head's closing line, null when the block is open)
    and ``closed``.
    """
    end_at = F.transform("lines", lambda line, i: F.when(line.endswith(terminator), i + 1))
    # Settled, as an array that is copied into the loops below would be built anew for every event.
    marked = settle(blocks.withColumn("ends", F.array_compact(end_at)), "lines", "at", "ends")
    n_ends = F.size("ends")
    first, last = F.get("ends", F.lit(0)), F.get("ends", n_ends - 1)
    lines, at, ends = F.col("lines"), F.col("at"), F.col("ends")
    whole = F.transform(
        F.slice(ends, F.lit(2), F.greatest(n_ends - 1, F.lit(0))),
        lambda end, i: F.struct(
            F.get(at, end - 1).alias("pos"), F.slice(lines, F.get(ends, i) + 1, end - F.get(ends, i)).alias("lines")
        ),
    )
    closed = n_ends > 0

    def after_last(values: Column) -> Column:
        return F.when(closed, F.slice(values, last + 1, F.size(lines) - last)).otherwise(F.slice(values, F.lit(1), F.lit(0)))

    return (
        marked.withColumn("closed", closed)
        .withColumn("head", F.when(closed, F.slice(lines, F.lit(1), first)).otherwise(lines))
        .withColumn("head_end", F.get(at, first - 1))
        .withColumn("whole", whole)
        .withColumn("tail", after_last(lines))
        .withColumn("tail_at", after_last(at))
        .drop("lines", "ends")
    )


def event_lines(lines: Column, leading: Column) -> Column:
    """The lines of an event without its separator blank; ``leading`` marks a stream's first event."""
    at = F.array_position(lines, "")
    rest = F.concat(F.slice(lines, F.lit(1), at.cast("int") - 1), F.slice(lines, at.cast("int") + 1, F.size(lines)))
    return F.when(~leading & (at > 0), rest).otherwise(lines)


def glue_lines(events: DataFrame, glue: str, keep: tuple[str, ...]) -> DataFrame:
    """Turn ``lines`` and ``leading`` into the event's ``body`` and its number of lines."""
    kept = events.withColumn("kept", event_lines(F.col("lines"), F.col("leading")))
    return kept.select(*keep, F.array_join("kept", glue).alias("body"), F.size("kept").alias("n_lines"))


def _blocks(lines: DataFrame) -> DataFrame:
    """One row per block with its lines in order, and their positions ``at``."""
    rows = F.sort_array(F.collect_list(F.struct("pos", F.coalesce("line", F.lit("")).alias("line"))))
    blocks = lines.groupBy("stream", "part", "block").agg(rows.alias("rows"))
    return blocks.select("stream", "part", "block", F.col("rows.pos").alias("at"), F.col("rows.line").alias("lines"))


def _event_numbers(blocks: DataFrame, terminator: str) -> DataFrame:
    """Per block: how many earlier blocks of its stream hold a terminator, and how many hold one in all.

    Summed up in two steps, inside parts and over parts, on one small row per block.
    """
    closes = F.exists("lines", lambda line: line.endswith(terminator)).cast("bigint")
    marks = blocks.select("stream", "part", "block", closes.alias("closes"))
    in_part = Window.partitionBy("stream", "part").orderBy("block")
    inner = marks.withColumn(
        "inside", F.coalesce(F.sum("closes").over(in_part.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    by_stream = Window.partitionBy("stream")
    ahead = F.sum("closes").over(by_stream.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = (
        marks.groupBy("stream", "part")
        .agg(F.sum("closes").alias("closes"))
        .select(
            F.col("stream").alias("s"),
            F.col("part").alias("p"),
            F.coalesce(ahead, F.lit(0)).alias("ahead"),
            F.sum("closes").over(by_stream).alias("total"),
        )
    )
    same = F.col("stream").eqNullSafe(F.col("s")) & F.col("part").eqNullSafe(F.col("p"))
    return inner.join(parts, same).select(
        F.col("stream").alias("s"),
        F.col("part").alias("p"),
        F.col("block").alias("b"),
        (F.col("inside") + F.col("ahead")).alias("number"),
        "total",
    )


def _edges(blocks: DataFrame, numbers: DataFrame) -> DataFrame:
    """Heads and tails of all blocks with the number of the event they belong to.

    Rows that are not ``in_event`` belong to none: their stream has no terminator after them.
    """
    head_at = F.slice("at", F.lit(1), F.size("head"))
    head = F.struct(F.lit(0).alias("piece"), F.col("head").alias("lines"), F.col("head_end").alias("end"), head_at.alias("at"))
    no_end = F.lit(None).cast("bigint")
    tail = F.struct(F.lit(1).alias("piece"), F.col("tail").alias("lines"), no_end.alias("end"), F.col("tail_at").alias("at"))
    pieces = blocks.select("stream", "part", "block", F.inline(F.array(head, tail)))
    # Null-safe equality throughout: a plain one would push a not-null filter below the shuffle of the
    # text on this side only, and the readers of the blocks could then not share that shuffle.
    same = (
        F.col("stream").eqNullSafe(F.col("s"))
        & F.col("part").eqNullSafe(F.col("p"))
        & F.col("block").eqNullSafe(F.col("b"))
    )
    joined = pieces.where(F.size("lines") > 0).join(numbers, same)
    number = F.col("number") + F.col("piece")
    placed = joined.withColumn("in_event", number < F.col("total")).withColumn("number", number)
    return settle(placed, "number", "in_event").drop("s", "p", "b", "total")


def assemble_events(lines: DataFrame, terminator: str, glue: str = LINE_GLUE) -> DataFrame:
    """Events of a lines frame: ``stream, part, block, pos`` of the closing line, ``body``, ``n_lines``."""
    whole_blocks = _blocks(lines)
    blocks = cut_block(whole_blocks, check_terminator(terminator))
    inside = blocks.select("stream", "part", "block", F.inline("whole")).withColumn("leading", F.lit(False))
    piece = F.struct("part", "block", "piece", "end", "lines")
    crossing = (
        _edges(blocks, _event_numbers(whole_blocks, terminator))
        .where("in_event")
        .groupBy("stream", "number")
        .agg(F.sort_array(F.collect_list(piece)).alias("pieces"))
        .withColumn("close", F.element_at("pieces", -1))
        .select(
            "stream",
            "close.part",
            "close.block",
            F.col("close.end").alias("pos"),
            F.flatten("pieces.lines").alias("lines"),
            (F.col("number") == 0).alias("leading"),
        )
    )
    return glue_lines(inside.unionByName(crossing), glue, ("stream", "part", "block", "pos"))


def unterminated_lines(lines: DataFrame, terminator: str) -> DataFrame:
    """Lines after the last terminator of their stream, which no event holds: ``stream, part, block, pos, line``."""
    blocks = _blocks(lines)
    numbers = _event_numbers(blocks, check_terminator(terminator))
    edges = _edges(cut_block(blocks, terminator), numbers).where("NOT in_event")
    zipped = F.arrays_zip(F.col("at").alias("pos"), F.col("lines").alias("line"))
    return edges.select("stream", "part", "block", F.inline(zipped)).toDF("stream", "part", "block", "pos", "line")


def to_events(assembled: DataFrame, headers: Column | None = None, *extra: str) -> DataFrame:
    """Assembled bodies as events: ``headers, body``, plus any columns to carry along."""
    start = F.create_map().cast("map<string,string>") if headers is None else headers
    return assembled.select(start.alias("headers"), "body", *extra)


def count_events(events: DataFrame, name: str = "assembly") -> tuple[DataFrame, Observation]:
    """Count events as they pass; read the result with ``observation.get['events_read']`` after an action."""
    observation = Observation(name)
    return events.observe(observation, F.count(F.lit(1)).alias("events_read")), observation
