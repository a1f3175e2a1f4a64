"""Header enrichment by lookup: customers of hosts, static key/value pairs.

The lookups carry no broadcast hint. A registry is a config file of a few thousand hosts, so its size
estimate puts it under ``spark.sql.autoBroadcastJoinThreshold`` and Spark broadcasts it; one that is
larger than that is joined by shuffle, where adaptive execution splits the partition of a hot host.
"""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.functions.headers import header_get, header_put, merge_keep, merge_overwrite, no_headers
from logloom.functions.text import short_host, trim_controls
from logloom.sources.lines import read_whole_files

log = logging.getLogger(__name__)

# Default header names, and the name for hosts of no customer.
HOST_HEADER = "host"
CUSTOMER_HEADER = "customer"
UNKNOWN = "UNKNOWN"

REGISTRY_LINE = r"\A(.*):(.*)\z"


def _lines_or_none(spark: SparkSession, path: str, charset: str) -> DataFrame | None:
    try:
        return read_whole_files(spark, path, charset)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


# --- customers of hosts ---------------------------------------------------------------------------


def registry_from_lines(lines: DataFrame) -> DataFrame:
    """Host registry ``host, customer`` from ``customer:host host ...`` lines.

    The customer is all text before the last colon. Hosts are cut at their first dot and lowered. A
    host listed twice belongs to the later entry. Lines without a colon are ignored.
    """
    order = F.struct("stream", "part", "block", "pos")
    entries = lines.where(F.col("line").rlike(REGISTRY_LINE)).select(
        order.alias("order"),
        F.regexp_extract("line", REGISTRY_LINE, 1).alias("customer"),
        trim_controls(F.regexp_extract("line", REGISTRY_LINE, 2)).alias("hosts"),
    )
    hosts = entries.select("order", "customer", F.posexplode(F.split("hosts", r"\s", -1)).alias("at", "host"))
    return (
        hosts.select(short_host(trim_controls(F.col("host"))).alias("host"), "customer", F.struct("order", "at").alias("order"))
        .groupBy("host")
        .agg(F.max_by("customer", "order").alias("customer"))
    )


def load_registry(
    spark: SparkSession, path: str, charset: str = "UTF-8", missing_ok: bool = False
) -> DataFrame:
    """Read the registry file. With ``missing_ok`` a missing file makes every host unknown."""
    lines = _lines_or_none(spark, path, charset)
    if lines is None:
        if not missing_ok:
            raise FileNotFoundError(f"no host registry at {path}")
        log.warning("no host registry at %s: all customers will be %s", path, UNKNOWN)
        return spark.createDataFrame([], "host string, customer string")
    return registry_from_lines(lines)


def look_up_customer(events: DataFrame, registry: DataFrame, host: Column, customer_header: str) -> DataFrame:
    """Set the customer header from the registry entry of ``host``, ``UNKNOWN`` when there is none."""
    known = registry.select(F.col("host").alias("_host"), F.col("customer").alias("_customer"))
    joined = events.withColumn("_key", host).join(known, F.col("_key") == F.col("_host"), "left")
    customer = F.coalesce("_customer", F.lit(UNKNOWN))
    return joined.withColumn("headers", header_put(F.col("headers"), customer_header, customer)).select(*events.columns)


def add_customer(
    events: DataFrame,
    registry: DataFrame,
    customer_header: str = CUSTOMER_HEADER,
    host_header: str = HOST_HEADER,
) -> DataFrame:
    """Set the customer header by the short name of the host header."""
    events = events.withColumn("headers", F.coalesce("headers", no_headers()))
    host = short_host(header_get(F.col("headers"), host_header))
    return look_up_customer(events, registry, host, customer_header)


# --- static pairs ---------------------------------------------------------------------------------


def _well_formed(line: Column) -> Column:
    # Empty parts at the end do not count, so there must be text after some "=".
    return F.regexp_replace(line, r"=+\z", "").contains("=")


def first_bad_static(lines: DataFrame) -> DataFrame:
    """Per stream the first line that is no ``key=value`` pair: ``stream, stop``."""
    order = F.struct("part", "block", "pos")
    return lines.where(~_well_formed(F.col("line"))).groupBy("stream").agg(F.min(order).alias("stop"))


def static_pairs(lines: DataFrame) -> DataFrame:
    """Pairs of static files: ``stream, part, block, pos, key, value``.

    The first bad line ends its file; the pairs before it count. Text after a second ``=`` is lost.
    """
    stops = first_bad_static(lines).select(F.col("stream").alias("_stream"), "stop")
    parts = F.split("line", "=", -1)
    return (
        lines.where(_well_formed(F.col("line")))
        .join(stops, F.col("stream") == F.col("_stream"), "left")
        .where(F.col("stop").isNull() | (F.struct("part", "block", "pos") < F.col("stop")))
        .select("stream", "part", "block", "pos", F.get(parts, F.lit(0)).alias("key"), F.get(parts, F.lit(1)).alias("value"))
    )


def load_static_pairs(spark: SparkSession, path: str, charset: str = "UTF-8") -> DataFrame | None:
    """Read a static file; None with a warning when it is missing."""
    lines = _lines_or_none(spark, path, charset)
    if lines is None:
        log.warning("no static pairs at %s: headers stay as they are", path)
        return None
    return static_pairs(lines)


def fold_pairs(pairs: DataFrame, preserve_existing: bool) -> DataFrame:
    """One row with the pairs as a map; of a repeated key the first stays when preserving, else the last."""
    pick = F.min_by if preserve_existing else F.max_by
    chosen = pairs.groupBy("key").agg(pick("value", F.struct("stream", "part", "block", "pos")).alias("value"))
    # Every event carries the whole map, so one task can hold it.
    return chosen.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("key", "value")))).alias("statics"))


def add_statics(events: DataFrame, pairs: DataFrame | None, preserve_existing: bool = True) -> DataFrame:
    """Merge static pairs into the headers; by default an existing header stays."""
    if pairs is None:
        return events
    statics = F.coalesce(fold_pairs(pairs, preserve_existing).scalar(), no_headers())
    merge = merge_keep if preserve_existing else merge_overwrite
    with_statics = events.withColumn("_statics", statics)
    return with_statics.withColumn("headers", merge(F.col("headers"), F.col("_statics"))).drop("_statics")
