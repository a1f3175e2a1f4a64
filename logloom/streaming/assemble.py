"""Multi-line assembly of an endless stream of log chunks, over tables that are carried from batch to batch.

A micro-batch cuts each chunk by itself. Whole events leave at once; the edges of a chunk (its lines up to the first terminator and
those after the last one) belong to events that have a number in their stream: how many terminators came before. That count
goes on across batches, in the *positions* table (one small row per stream and batch). Edges of events that are still open are appended
to the *open* table, keyed by stream and event number, and are read again only in the batch that closes their event. No state is rewritten,
no task holds a stream, and a stream that never closes only adds rows.

Each batch writes folders of its own, named by the batch id, with its positions last: they commit it. A batch that is run again reads what
was committed before it and replaces its own folders.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from logloom.operators.assemble import LINE_GLUE, check_terminator, cut_block, glue_lines
from logloom.plans.scratch import exists, remove_children
from logloom.streaming.jobs import trigger_of

POSITIONS = "stream string, closed long, last string, since long, batch long"
OPEN = "stream string, number long, chunk string, piece int, end long, lines array<string>, batch long"
EVENT_COLUMNS = ("stream", "chunk", "pos", "status", "body", "n_lines")
# Every so many batches the positions of all streams are written, so that a batch reads few folders.
SNAPSHOT_EVERY = 50


class Assembled(NamedTuple):
    """What a batch gives: its events, the pieces of events it leaves open, the positions of its streams."""

    events: DataFrame
    open: DataFrame
    positions: DataFrame


def _same_stream(left: str, right: str) -> Column:
    return F.col(left).eqNullSafe(F.col(right))


def cut_chunks(chunks: DataFrame, terminator: str) -> DataFrame:
    """Chunks (``stream, chunk, lines``) cut at their terminators, each with a number ``id`` of its own."""
    index = F.transform("lines", lambda _, i: i.cast("bigint"))
    named = chunks.select(F.col("stream").cast("string").alias("stream"), "chunk", "lines", index.alias("at"))
    return cut_block(named, check_terminator(terminator)).withColumn("id", F.monotonically_increasing_id())


def place_chunks(cut: DataFrame, positions: DataFrame) -> DataFrame:
    """One small row per chunk: ``id, stream, chunk, has_head, has_tail, late, since, carried, number, after``.

    ``number`` is that of the event its head belongs to, ``carried`` and ``after`` are the terminators of the stream before and after
    this batch, ``since`` is the batch in which the event that is open before it began. A batch has as many rows as it has files, so
    they can be counted up stream by stream. A chunk that comes after a later one of its stream is late and counts nothing.
    """
    known = positions.select(F.col("stream").alias("_stream"), F.col("closed").alias("carried"), "last", "since")
    sizes = [(F.size(name) > 0).alias(f"has_{name}") for name in ("head", "tail")]
    marks = cut.select("id", "stream", "chunk", F.col("closed").alias("closes"), *sizes).join(known, _same_stream("stream", "_stream"), "left")
    marks = marks.withColumn("carried", F.coalesce("carried", F.lit(0).cast("bigint")))
    again = F.row_number().over(Window.partitionBy("stream", "chunk").orderBy("id")) > 1
    marks = marks.withColumn("late", again | F.coalesce(F.col("chunk") <= F.col("last"), F.lit(False)))
    closes = (F.col("closes") & ~F.col("late")).cast("bigint")
    in_stream = Window.partitionBy("stream")
    before = F.sum(closes).over(in_stream.orderBy("chunk", "id").rowsBetween(Window.unboundedPreceding, -1))
    return marks.select(
        "id", "stream", "chunk", "has_head", "has_tail", "late", "since", "carried",
        (F.col("carried") + F.coalesce(before, F.lit(0))).alias("number"),
        (F.col("carried") + F.sum(closes).over(in_stream)).alias("after"),
    )


def assemble_batch(cut: DataFrame, placed: DataFrame, earlier: DataFrame, batch: int, glue: str = LINE_GLUE) -> Assembled:
    """Assemble one batch, given its placed chunks and the pieces of events that were open before it (``earlier``)."""
    no_end = F.lit(None).cast("bigint")
    head = F.struct(F.lit(0).alias("piece"), F.col("head").alias("lines"), F.col("head_end").alias("end"))
    tail = F.struct(F.lit(1).alias("piece"), F.col("tail").alias("lines"), no_end.alias("end"))
    pieces = cut.select("id", "stream", "chunk", F.inline(F.array(head, tail))).where(F.size("lines") > 0).join(placed.drop("stream", "chunk"), "id")
    pieces = pieces.withColumn("number", F.col("number") + F.col("piece"))

    late = pieces.where("late").select("stream", "chunk", no_end.alias("pos"), F.lit("late").alias("status"), "lines", F.lit(True).alias("leading"))
    inside = cut.select("stream", "chunk", F.inline("whole")).select(
        "stream", "chunk", "pos", F.lit("event").alias("status"), "lines", F.lit(False).alias("leading"))
    columns = ("stream", "number", "chunk", "piece", "end", "lines")
    closed = pieces.where("NOT late AND number < after").select(*columns)
    # Of the events that end here only the first one of each stream can have begun in an earlier batch.
    ending = placed.where("NOT late AND after > carried").select(F.col("stream").alias("_stream"), F.col("carried").alias("_number")).distinct()
    begun = earlier.join(ending, _same_stream("stream", "_stream") & (F.col("number") == F.col("_number")), "left_semi").select(*columns)
    crossing = (
        closed.unionByName(begun)
        .groupBy("stream", "number")
        .agg(F.sort_array(F.collect_list(F.struct("chunk", "piece", "end", "lines"))).alias("pieces"))
        .withColumn("close", F.element_at("pieces", -1))
        .select("stream", "close.chunk", F.col("close.end").alias("pos"), F.lit("event").alias("status"),
                F.flatten("pieces.lines").alias("lines"), (F.col("number") == 0).alias("leading"))
    )
    events = glue_lines(inside.unionByName(crossing).unionByName(late), glue, ("stream", "chunk", "pos", "status"))

    left = pieces.where("NOT late AND number >= after").select(*columns)
    is_open = (F.col("has_head") & (F.col("number") == F.col("after"))) | (F.col("has_tail") & (F.col("number") + 1 == F.col("after")))
    now = placed.where("NOT late").groupBy("stream").agg(
        F.first("after").alias("closed"), F.max("chunk").alias("last"), F.first("carried").alias("carried"),
        F.first("since").alias("before"), F.bool_or(is_open).alias("opens"))
    since = F.coalesce(F.when(F.col("closed") == F.col("carried"), F.col("before")), F.when(F.col("opens"), F.lit(batch).cast("bigint")))
    return Assembled(events.select(*EVENT_COLUMNS), left, now.select("stream", "closed", "last", since.alias("since")))


class CarriedTables:
    """The carried tables of one assembly, in a folder that belongs to its checkpoint."""

    def __init__(self, spark: SparkSession, folder: str, snapshot_every: int = SNAPSHOT_EVERY):
        self.spark, self.folder, self.snapshot_every = spark, folder, snapshot_every

    def _read(self, name: str, schema: str, first: int, end: int) -> DataFrame:
        path = f"{self.folder}/{name}"
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path).where((F.col("batch") >= first) & (F.col("batch") < end))

    def positions(self, batch: int) -> DataFrame:
        """Positions of all streams as they were before the batch."""
        snapshot = max(batch - 1, 0) // self.snapshot_every * self.snapshot_every
        rows = self._read("positions", POSITIONS, snapshot, batch)
        latest = rows.groupBy("stream").agg(F.max_by(F.struct("closed", "last", "since"), "batch").alias("p"))
        return latest.select("stream", "p.*")

    def open_pieces(self, first: int, batch: int) -> DataFrame:
        return self._read("open", OPEN, first, batch)

    def commit(self, batch: int, done: Assembled, positions: DataFrame) -> None:
        done.open.write.mode("overwrite").parquet(f"{self.folder}/open/batch={batch}")
        rows = done.positions
        if batch % self.snapshot_every == 0:
            rows = rows.unionByName(positions.join(rows.select(F.col("stream").alias("_s")), _same_stream("stream", "_s"), "left_anti"))
        rows.write.mode("overwrite").parquet(f"{self.folder}/positions/batch={batch}")
        if batch % self.snapshot_every == 0 and batch:
            self._forget(batch)

    def _forget(self, batch: int) -> None:
        """Remove what no later batch reads: positions before the snapshot before this one, pieces from before any open event."""
        # Of this batch too, as it may be run again.
        oldest = self.positions(batch).unionByName(self.positions(batch + 1)).agg(F.min("since")).first()[0]
        keep = batch if oldest is None else oldest
        remove_children(self.spark, f"{self.folder}/open", lambda name: int(name.removeprefix("batch=")) < keep)
        remove_children(self.spark, f"{self.folder}/positions", lambda name: int(name.removeprefix("batch=")) < batch - self.snapshot_every)


def run_batch(chunks: DataFrame, batch: int, tables: CarriedTables, terminator: str, write: Callable[[DataFrame, int], None], glue: str = LINE_GLUE) -> None:
    """Assemble the chunks of a batch, ``write`` its events, commit it."""
    # Read several times below: the batch is bounded by the files it admits.
    cut = cut_chunks(chunks, terminator).persist()
    positions = tables.positions(batch).persist()
    placed = place_chunks(cut, positions).persist()
    try:
        first = placed.where("NOT late AND after > carried").agg(F.min("since")).first()[0]
        earlier = tables.open_pieces(batch if first is None else first, batch)
        done = assemble_batch(cut, placed, earlier, batch, glue)
        write(done.events, batch)
        tables.commit(batch, done, positions)
    finally:
        for table in (placed, positions, cut):
            table.unpersist()


def assemble_to(
    chunks: DataFrame,
    terminator: str,
    path: str,
    checkpoint: str,
    glue: str = LINE_GLUE,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    available_now: bool = False,
    interval: str = "10 seconds",
    snapshot_every: int = SNAPSHOT_EVERY,
) -> StreamingQuery:
    """Write the events of a streaming chunks frame (``stream, chunk, lines``) under ``path``, one folder per batch.

    Events have ``stream, chunk, pos`` (index of the closing line in its chunk), ``status, body, n_lines``; ``transform`` may enrich and parse
    them. Chunks of a stream must come in name order; ``status`` is ``late`` for edge lines of a chunk that comes after a later one, else
    ``event``. Lines that are not yet closed wait in the carried tables under ``checkpoint`` and live on over restarts from
    it. Read the events with :func:`read_events`.
    """
    check_terminator(terminator)

    def write(events: DataFrame, batch: int) -> None:
        (transform(events) if transform else events).write.mode("overwrite").parquet(f"{path}/batch={batch}")

    def handle(batch_chunks: DataFrame, batch: int) -> None:
        tables = CarriedTables(batch_chunks.sparkSession, f"{checkpoint}/assembly", snapshot_every)
        run_batch(batch_chunks, batch, tables, terminator, write, glue)

    writer = chunks.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger_of(available_now, interval)).start()


def read_events(spark: SparkSession, path: str, checkpoint: str) -> DataFrame:
    """Events of committed batches, with their ``batch``. Batches that were cut short do not show until they are run again."""
    folder = f"{checkpoint}/assembly/positions"
    newest = spark.read.schema(POSITIONS).parquet(folder).agg(F.max("batch")).first()[0] if exists(spark, folder) else None
    if newest is None:
        raise FileNotFoundError(f"no committed batch of {checkpoint}")
    events = spark.read.parquet(path)
    return events.withColumn("batch", F.col("batch").cast("bigint")).where(F.col("batch") <= newest)
