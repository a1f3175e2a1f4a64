"""String events: the body as text, headers kept."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.functions.text import decode_bytes
from logloom.schemas import conform


def string_events(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``headers, body`` with the bytes of the body read as UTF-8; ``keep`` names columns to carry along."""
    return conform(text_body(events), "event", keep)


def text_body(events: DataFrame) -> DataFrame:
    """The same events with a string body; parse jobs start with this, so they take bytes too."""
    if dict(events.dtypes)["body"] == "binary":
        events = events.withColumn("body", decode_bytes(F.col("body")))
    return events.withColumn("body", F.coalesce("body", F.lit("")))
