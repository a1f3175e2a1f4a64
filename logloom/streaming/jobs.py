"""Start streaming jobs: file sink, lookups read once or per batch, counts of each batch."""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from logloom.plans.scratch import exists

REFRESH = ("per_batch", "once")


def trigger_of(available_now: bool, interval: str) -> dict:
    """Trigger options: handle what is there and stop, or go on at the interval."""
    return {"availableNow": True} if available_now else {"processingTime": interval}


def append_to(
    table: DataFrame, path: str, checkpoint: str, available_now: bool = False, interval: str = "10 seconds"
) -> StreamingQuery:
    """Append a streaming frame to Parquet files, exactly once per checkpoint."""
    writer = table.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger_of(available_now, interval)).start(path)


# --- lookups --------------------------------------------------------------------------------------


def pinned(spark: SparkSession, checkpoint: str, name: str, load: Callable[[], DataFrame]) -> DataFrame:
    """A lookup as it was when the job first started: kept in the checkpoint, where a restarted job finds it again."""
    path = f"{checkpoint}/lookups/{name}"
    if not exists(spark, f"{path}/_SUCCESS"):
        load().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def lookup_version(lookup: DataFrame) -> str:
    """A name for the content of a lookup, whatever the order of its rows: their number and the sum of their hashes."""
    hashes = F.sum(F.xxhash64(*lookup.columns).cast("decimal(38,0)"))
    return lookup.agg(F.concat_ws("-", F.count(F.lit(1)), F.coalesce(hashes, F.lit(0)))).first()[0]


def append_refreshed(
    table: DataFrame,
    transform: Callable[..., DataFrame],
    path: str,
    checkpoint: str,
    available_now: bool = False,
    interval: str = "10 seconds",
    lookups: dict[str, Callable[[], DataFrame]] | None = None,
    refresh: str = "per_batch",
) -> StreamingQuery:
    """Apply ``transform`` to each micro-batch and write the result under ``path``, one folder per batch.

    ``transform`` takes the batch, and as keyword arguments the ``lookups`` that the given functions load. With ``refresh="per_batch"`` they are
    loaded anew for every micro-batch, so edits to their files count from the next batch on. With ``refresh="once"`` they are loaded when the
    job first starts, and kept in the checkpoint: later batches and restarts see the same rows. To take up edits, start
    from a new checkpoint. A batch that is repeated after a failure replaces its own output.
    """
    if refresh not in REFRESH:
        raise ValueError(f"refresh is one of {REFRESH}, not {refresh!r}")
    loaders = dict(lookups or {})
    if refresh == "once":
        spark = table.sparkSession
        frames = {name: pinned(spark, checkpoint, name, load) for name, load in loaders.items()}
        loaders = {name: (lambda frame=frame: frame) for name, frame in frames.items()}

    def write(batch: DataFrame, batch_id: int) -> None:
        found = {name: load() for name, load in loaders.items()}
        transform(batch, **found).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    writer = table.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger_of(available_now, interval)).start()


# --- counts ---------------------------------------------------------------------------------------


def count_stream_events(events: DataFrame, name: str = "events") -> DataFrame:
    """Count events per micro-batch; :class:`BatchCounts` writes the counts to a table."""
    return events.observe(name, F.count(F.lit(1)).alias("events_read"))


class BatchCounts(StreamingQueryListener):
    """Writes what was observed in each micro-batch to a table, one folder per batch.

    Takes the observation ``name`` of all queries of the session that have one; rows are ``input_rows`` and the observed counts, with the
    partition column ``batch``. Use it as a context around queries: at its end all counts of finished queries are written.
    """

    def __init__(self, spark: SparkSession, path: str, name: str = "events", patience: float = 60.0):
        self.spark, self.path, self.name, self.patience = spark, path, name, patience
        self._running: set = set()
        self._changed = threading.Condition()

    def __enter__(self) -> BatchCounts:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *error) -> None:
        with self._changed:
            self._changed.wait_for(lambda: not self._running, self.patience)
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        with self._changed:
            self._running.add(event.runId)

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        observed = progress.observedMetrics.get(self.name)
        if observed is not None:
            row = {"input_rows": progress.numInputRows, **observed.asDict()}
            counts = self.spark.range(1).select(*[F.lit(value).cast("bigint").alias(name) for name, value in row.items()])
            counts.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/batch={progress.batchId}")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._changed:
            self._running.discard(event.runId)
            self._changed.notify_all()
