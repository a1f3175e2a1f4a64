"""What did not parse, and the view with real types."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def rejects(parsed: DataFrame) -> DataFrame:
    """Rows that did not parse in full. No parse job drops them from its own output."""
    return parsed.where(F.col("parse_status") != "ok")


def count_rejects(parsed: DataFrame, name: str = "parse") -> tuple[DataFrame, Observation]:
    """Count rows and rejects as they pass; read them from the observation after an action."""
    observation = Observation(name)
    bad = F.count_if(F.col("parse_status") != "ok")
    return parsed.observe(observation, F.count(F.lit(1)).alias("rows"), bad.alias("rejects")), observation


def with_event_time(parsed: DataFrame) -> DataFrame:
    """Application and system log tables with ``event_time`` as a timestamp (null when there is none)."""
    known = F.when(F.col("datetime") != "", F.timestamp_millis("timestamp"))
    return parsed.withColumn("event_time", known)
