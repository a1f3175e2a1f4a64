"""From log files to typed tables: the operators in their usual order."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.functions.headers import no_headers
from logloom.operators.access_log import parse_access_log
from logloom.operators.app_log import parse_app_log
from logloom.operators.assemble import LINE_GLUE, assemble_events
from logloom.operators.enrich import HOST_HEADER, add_customer, add_statics, load_registry, load_static_pairs
from logloom.operators.syslog import parse_syslog
from logloom.sources.lines import read_lines

Key = Callable[[Column], Column]


def _headers(host_of: Key | None) -> Column:
    if host_of is None:
        return no_headers()
    return F.create_map(F.lit(HOST_HEADER), host_of(F.col("stream")))


def line_events(spark: SparkSession, path, charset: str = "UTF-8", stream_of: Key | None = None, host_of: Key | None = None) -> DataFrame:
    """Each line of the files as an event. ``host_of`` takes the host header from the stream key (the file path)."""
    return read_lines(spark, path, charset, stream_of).select(_headers(host_of).alias("headers"), F.col("line").alias("body"))


def multi_line_events(
    spark: SparkSession,
    path,
    terminator: str,
    glue: str = LINE_GLUE,
    charset: str = "UTF-8",
    stream_of: Key | None = None,
    host_of: Key | None = None,
    order_of=None,
) -> DataFrame:
    """Events of the files, each closed by a line that ends with the terminator. ``order_of`` puts rolled files in order."""
    events = assemble_events(read_lines(spark, path, charset, stream_of, order_of=order_of), terminator, glue)
    return events.select(_headers(host_of).alias("headers"), "body")


def enriched(
    events: DataFrame, registry_path: str | None = None, statics_path: str | None = None, preserve_existing: bool = True
) -> DataFrame:
    """Add the customer and the static pairs, as far as files for them are named."""
    spark = events.sparkSession
    if registry_path:
        events = add_customer(events, load_registry(spark, registry_path))
    if statics_path:
        events = add_statics(events, load_static_pairs(spark, statics_path), preserve_existing)
    return events


def app_log_table(spark: SparkSession, path, registry_path=None, statics_path=None, terminator: str = "|#]", **source) -> DataFrame:
    """Application logs: assembled, enriched, parsed."""
    return parse_app_log(enriched(multi_line_events(spark, path, terminator, **source), registry_path, statics_path))


def access_log_table(spark: SparkSession, path, registry_path=None, statics_path=None, **source) -> DataFrame:
    """Web access logs: one line per request, enriched, parsed."""
    return parse_access_log(enriched(line_events(spark, path, **source), registry_path, statics_path))


def syslog_table(
    spark: SparkSession, path, registry_path: str, statics_path=None, as_of: datetime | Column | None = None, **source
) -> DataFrame:
    """System logs: one line per message; the customer comes from the host named in it."""
    events = enriched(line_events(spark, path, **source), None, statics_path)
    return parse_syslog(events, load_registry(spark, registry_path), as_of)
