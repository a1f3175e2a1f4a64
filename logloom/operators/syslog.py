"""Syslog: ``MMM dd HH:mm:ss host message`` lines, with the customer of the sending host."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.functions.headers import header_get, header_put, headers_put
from logloom.functions.text import short_host
from logloom.functions.times import READABLE_ZONE, add_syslog_time, readable_time
from logloom.operators.enrich import CUSTOMER_HEADER, HOST_HEADER, UNKNOWN
from logloom.operators.events import text_body
from logloom.schemas import conform

TIME_CHARS = 15


def parse_syslog(
    events: DataFrame,
    registry: DataFrame,
    as_of: datetime | Column | None = None,
    year_rule: str = "reference",
    display_tz: str = READABLE_ZONE,
    customer_header: str = CUSTOMER_HEADER,
    host_header: str = HOST_HEADER,
    shorten_host: bool = False,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Parse ``headers, body`` and set the customer header.

    The host in the body replaces the host header. The customer is looked up by the full host name,
    lowered (``shorten_host`` cuts it at the first dot). A body shorter than a time is kept as it is.
    ``keep`` names columns to carry along.
    """
    body = F.col("body")
    long_enough = F.char_length(body) >= TIME_CHARS
    stamp = F.when(long_enough, F.substring(body, 1, TIME_CHARS))
    timed = add_syslog_time(text_body(events), stamp, "_ms", as_of, year_rule)
    known_time = F.col("_ms").isNotNull()
    start = TIME_CHARS + 2  # one character, whatever it is, stands between time and host
    cut = timed.withColumn("_space", F.when(known_time, F.locate(" ", body, start)))
    has_host = F.coalesce(F.col("_space") > 0, F.lit(False))
    named = cut.withColumn("_name", F.when(has_host, F.substr(body, F.lit(start), F.col("_space") - start)))
    message = (
        F.when(~long_enough, "")
        .when(has_host, F.substr(body, F.col("_space") + 1))
        .when(known_time, F.substr(body, F.lit(start)))
        .otherwise(body)
    )
    status = (
        F.when(~long_enough, "too_short")
        .when(~known_time, "bad_time")
        .when(F.char_length(body) == TIME_CHARS, "no_message")
        .otherwise("ok")
    )
    host = F.lower(F.coalesce("_name", header_get(F.col("headers"), host_header)))
    if shorten_host:
        host = short_host(host)
    known = registry.select(F.col("host").alias("_host"), F.col("customer").alias("_customer"))
    joined = named.withColumn("_key", F.when(long_enough, host)).join(known, F.col("_key") == F.col("_host"), "left")
    h, customer = F.col("headers"), F.coalesce("_customer", F.lit(UNKNOWN))
    headers = (
        F.when(~long_enough, h)
        .when(has_host, headers_put(h, {host_header: F.col("_name"), customer_header: customer}))
        .otherwise(header_put(h, customer_header, customer))
    )
    fields = joined.select(
        headers.alias("headers"),
        body.alias("original"),
        F.col("_ms").alias("timestamp"),
        readable_time(F.col("_ms"), display_tz).alias("datetime"),
        F.col("_name").alias("hostname"),
        message.alias("message"),
        status.alias("parse_status"),
        *keep,
    )
    return conform(fields, "syslog", ("parse_status", *keep))
