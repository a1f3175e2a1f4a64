"""Application log: ``[#|time|level|server|class|thread|message|#]`` events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.functions.settle import settle
from logloom.functions.times import READABLE_ZONE, app_time_millis, readable_time
from logloom.operators.events import text_body
from logloom.schemas import conform

END_MARK = "|#]"


def parse_app_log(
    events: DataFrame,
    display_tz: str = READABLE_ZONE,
    message_to_last_marker: bool = False,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Parse ``headers, body`` by the pipes in the body.

    Text before the first pipe is dropped. A field counts only if a pipe follows it; the message is
    the text after the last counted field, up to its own first pipe. ``message_to_last_marker`` lets
    a message hold pipes: it then runs up to the last end mark. ``keep`` names columns to carry along.
    """
    # Seven pipes decide everything, so the rest of a long message is left in one piece.
    cut = text_body(events).withColumn("_p", F.split("body", r"\|", 8)).withColumn("_pipes", F.size("_p") - 1)

    def field(at: int):
        return F.when(F.col("_pipes") > at, F.get("_p", F.lit(at)))

    message = F.get("_p", F.least(F.col("_pipes"), F.lit(6)))
    if message_to_last_marker:
        rest = F.get(F.split("body", r"\|", 7), F.lit(6))
        whole = F.when(rest.contains(END_MARK), F.substring_index(rest, END_MARK, -1))
        upto = F.substr(rest, F.lit(1), F.char_length(rest) - F.char_length(whole) - len(END_MARK))
        message = F.when(F.col("_pipes") >= 6, F.coalesce(upto, rest)).otherwise(message)
    timed = settle(cut.withColumn("_ms", app_time_millis(field(1))), "_ms")
    status = F.when(F.col("_ms").isNotNull(), "ok").when(F.col("_pipes") >= 2, "bad_time").otherwise("no_match")
    fields = timed.select(
        "headers",
        F.col("body").alias("original"),
        F.col("_ms").alias("timestamp"),
        readable_time(F.col("_ms"), display_tz).alias("datetime"),
        field(2).alias("loglevel"),
        field(3).alias("appservername"),
        field(4).alias("classname"),
        field(5).alias("thread"),
        message.alias("message"),
        status.alias("parse_status"),
        *keep,
    )
    return conform(fields, "app", ("parse_status", *keep))
