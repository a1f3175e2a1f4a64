"""Web access log: one line per request to 20 typed fields."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.functions.settle import settle_on_demand
from logloom.functions.times import access_time
from logloom.operators.events import text_body
from logloom.schemas import ACCESS_FIELDS, conform

# Fixed value: the log format, one group per field of ACCESS_FIELDS.
LINE_PATTERN = (
    r'^([\d.]+) (\S+) (\S+) \[([\w:/]+\s[+\-]\d{4})\] "([^ ]*) ([^ ]*) ([^ ]*)" (\d{3}) (\d+|-) '
    r'"([^"]+)" "([^"]+)" (\S+)? "(\S+)" (\d+|-)? (\d+|-)? ([+|\-|X])? "([^"]+)"? "([^"]+)"? (\d+|-)? (\d+|-)?'
)

# A break between rewritten fields must not occur in them. The control character is the fast choice; for a
# line that holds it, a quote followed by a space is safe too, since every group excludes one of the two.
FAST_BREAK = "\x01"
SAFE_BREAK = '" '


def parse_access_log(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Parse ``headers, body``; a line of another form keeps ``original`` and gets defaults and ``no_match``.

    ``keep`` names further columns to carry along. The line is matched at most once, and not at all where no field is read: the match is
    rewritten to its groups with breaks between them, and a line that does not match comes back unchanged.
    """
    lines = text_body(events).withColumnRenamed("body", "original")
    original, flat = F.col("original"), F.col("_flat")
    odd = F.contains(original, F.lit(FAST_BREAK))

    def rewritten(mark: str):
        groups = mark.join(f"${i}" for i in range(1, len(ACCESS_FIELDS) + 1))
        return F.regexp_replace(original, LINE_PATTERN + r"\z", groups)

    cut = F.when(odd, F.split(flat, SAFE_BREAK, -1)).otherwise(F.split(flat, FAST_BREAK, -1))
    matched = lines.withColumn("_flat", F.when(odd, rewritten(SAFE_BREAK)).otherwise(rewritten(FAST_BREAK)))
    flattened = settle_on_demand(matched, "_flat")
    parts = settle_on_demand(flattened.withColumn("_parts", F.when(flat != original, cut)), "_parts")
    fields = [F.get("_parts", F.lit(i)) for i in range(len(ACCESS_FIELDS))]
    typed = [
        (value.try_cast("int") if name == "statuscode" else value).alias(name)
        for name, value in zip(ACCESS_FIELDS, fields)
    ]
    status = F.when(F.col("_parts").isNull(), "no_match").otherwise("ok").alias("parse_status")
    return conform(parts.select("headers", "original", *typed, status, *keep), "access", ("parse_status", *keep))


def typed_access_log(parsed: DataFrame) -> DataFrame:
    """The parsed table with real types: ``event_time`` and whole-number sizes and durations (null for ``-``)."""
    counts = ("bytesSend", "bytesIn", "bytesOut", "timeSecond", "timeMicro")
    numbers = {name: F.col(name).try_cast("bigint") for name in counts}
    return parsed.withColumns({**numbers, "event_time": access_time(F.col("time"))})
