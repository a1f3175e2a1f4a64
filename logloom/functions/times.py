"""Log times to epoch milliseconds and back to readable text.

No expression here depends on the session time zone or on a clock read at run time, so a
recomputed task gives the same result as the first one.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.functions.settle import settle

# The accepted time grammars.
APP_TIME = r"(?i)\A\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}:\d{1,2}\.\d{1,3}(?:Z|[+-]\d{2}(?::?\d{2})?)\z"
SYSLOG_TIME = (
    r"(?i)\A(jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?"
    r"|sep(?:tember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)"
    r" {1,2}(\d{1,2}) (\d{1,2}):(\d{1,2}):(\d{1,2})\z"
)
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
READABLE_ZONE = "UTC"

DAY_MS = 86_400_000


def app_time_millis(text: Column) -> Column:
    """``yyyy-MM-dd'T'HH:mm:ss.SSS`` with a zone offset to epoch milliseconds, else null."""
    return F.when(text.rlike(APP_TIME), F.unix_millis(F.upper(text).try_cast("timestamp")))


def access_time(text: Column) -> Column:
    """``dd/MMM/yyyy:HH:mm:ss Z`` to a timestamp, else null."""
    return F.try_to_timestamp(text, F.lit("dd/MMM/yyyy:HH:mm:ss Z"))


def _clock(as_of: datetime | Column | None, streaming: bool = False) -> tuple[Column, Column]:
    """The reference clock as (epoch milliseconds, year), both in UTC.

    A stream without a given clock goes by the time of its micro-batch, which stays the same when the batch is repeated.
    """
    if as_of is None and streaming:
        millis = F.unix_millis(F.current_timestamp())
        return millis, F.year(F.date_from_unix_date(F.floor(millis / DAY_MS).cast("int")))
    if isinstance(as_of, Column):
        moment = as_of.cast("timestamp_ntz")
        of_day = F.hour(moment) * 3_600_000 + F.minute(moment) * 60_000
        of_minute = F.floor(F.date_part(F.lit("SECOND"), moment) * 1000)
        millis = F.unix_date(moment.cast("date")).cast("bigint") * DAY_MS + of_day + of_minute
        return millis, F.year(moment)
    now = as_of or datetime.now(timezone.utc)
    if now.tzinfo is None:
        now = now.replace(tzinfo=timezone.utc)
    now = now.astimezone(timezone.utc)
    since = now - datetime(1970, 1, 1, tzinfo=timezone.utc)
    millis = since.days * DAY_MS + since.seconds * 1000 + since.microseconds // 1000
    return F.lit(millis).cast("bigint"), F.lit(now.year)


def add_syslog_time(
    df: DataFrame, text: Column, name: str, as_of: datetime | Column | None = None, year_rule: str = "reference"
) -> DataFrame:
    """Add epoch milliseconds (UTC) of a ``MMM d HH:mm:ss`` time as column ``name``, null if it is no such time.

    The year is taken from ``as_of`` (a UTC clock: a ``datetime`` or a zone-less timestamp column; by
    default the clock of the moment the query is built) and repaired:

    * ``reference``: one year back if the time is over a month ahead of the clock, one year on if it
      is over a month behind it;
    * ``nearest``: the year that brings the time closest to the clock.
    """
    now, year = _clock(as_of, df.isStreaming)
    # The rewritten text differs from a time (no colons) and equals anything else, so one match does both.
    flat = df.withColumn("_text", text).withColumn("_flat", F.regexp_replace("_text", SYSLOG_TIME, "$1 $2 $3 $4 $5"))
    cut = flat.withColumn("_cut", F.when(F.col("_flat") != F.col("_text"), F.split("_flat", " ", -1)))
    month = F.array_position(F.array(*map(F.lit, MONTHS)), F.lower(F.substring(F.get("_cut", F.lit(0)), 1, 3)))
    day, hour, minute, second = (F.get("_cut", F.lit(i)).try_cast("int") for i in range(1, 5))
    first = F.make_date(F.lit(2000), month.cast("int"), F.lit(1))  # a leap year, so Feb 29 exists
    day_in_month = day.between(1, F.dayofmonth(F.last_day(F.col("_first"))))
    in_day = (hour <= 23) & (minute <= 59) & (second <= 59)
    of_day = F.when(in_day, (hour * 3600 + minute * 60 + second).cast("bigint") * 1000)
    dated = (
        cut.withColumn("_first", first)
        .withColumn("_day", F.when(day_in_month, F.date_add(F.col("_first"), day - 1)))
        .withColumn("_of_day", of_day)
    )

    def at(years: int, months: int = 0) -> Column:
        # add_months clamps to the month's end (Feb 29 becomes Feb 28 in common years)
        moved = F.add_months(F.col("_day"), (year + (years - 2000)) * 12)
        if months:
            moved = F.add_months(moved, months)
        return F.unix_date(moved).cast("bigint") * DAY_MS + F.col("_of_day")

    this, before, after = F.col("_this"), F.col("_before"), F.col("_after")
    if year_rule == "reference":
        ahead = (this > now) & (at(0, -1) > now)
        behind = (this < now) & (at(0, 1) < now)
        picked = F.when(ahead, before).when(behind, after).otherwise(this)
    elif year_rule == "nearest":
        gap, gap_before, gap_after = F.abs(this - now), F.abs(before - now), F.abs(after - now)
        picked = (
            F.when((gap_before < gap) & (gap_before <= gap_after), before).when(gap_after < gap, after).otherwise(this)
        )
    else:
        raise ValueError(f"unknown year_rule: {year_rule!r}")
    placed = dated.withColumns({"_this": at(0), "_before": at(-1), "_after": at(1)})
    # Millisecond 0 is the mark for "no time" in the output schema.
    timed = placed.withColumn(name, F.nullif(picked, F.lit(0).cast("bigint")))
    return settle(timed, name).drop("_text", "_flat", "_cut", "_first", "_day", "_of_day", "_this", "_before", "_after")


def readable_time(millis: Column, zone: str = READABLE_ZONE) -> Column:
    """Epoch milliseconds as ``yyyy-MM-dd HH:mm:ss`` in the given zone."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    utc = epoch + millis * F.expr("INTERVAL '0 00:00:00.001' DAY TO SECOND")
    local = utc if zone.upper() == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)
    return F.substring_index(local.cast("string"), ".", 1)
