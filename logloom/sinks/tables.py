"""Write parsed tables as typed files and read them back by field name."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from logloom.functions.headers import header_get
from logloom.operators.enrich import CUSTOMER_HEADER, UNKNOWN
from logloom.schemas import PARSE_STATUSES, TABLES, conform
from logloom.sinks.avro import read_avro, write_avro
from logloom.streaming.jobs import trigger_of

log = logging.getLogger(__name__)


# The container format where none is asked for. Avro containers are :mod:`logloom.sinks.avro`'s.
DEFAULT_FORMAT = "parquet"
# Directory names that Spark gives a meaning of its own: "" and its name for null would both be read back as null. Such names, and
# those that start like this mark, are written behind the mark.
NO_NAME = "__EMPTY__"
SPECIAL_NAMES = ("", "__HIVE_DEFAULT_PARTITION__")


def customer_column(table: DataFrame, customer_header: str = CUSTOMER_HEADER) -> DataFrame:
    """Add the customer header as a column, so that the table can be laid out and pruned by it."""
    customer = F.coalesce(header_get(F.col("headers"), customer_header), F.lit(UNKNOWN))
    marked = customer.isin(*SPECIAL_NAMES) | customer.startswith(NO_NAME)
    return table.withColumn("customer", F.when(marked, F.concat(F.lit(NO_NAME), customer)).otherwise(customer))


def _customer_name(directory: Column) -> Column:
    return F.when(directory.startswith(NO_NAME), F.substr(directory, F.lit(len(NO_NAME) + 1))).otherwise(directory)


def write_table(
    table: DataFrame,
    path: str,
    kind: str,
    fmt: str | None = None,
    by_customer: bool = False,
    mode: str = "append",
    namespace: str | None = None,
    sync_interval: int | None = None,
) -> str:
    """Write a parsed table (``event``, ``access``, ``app`` or ``syslog``); returns the format used.

    ``sync_interval`` is the bytes of a block of ``avro`` containers. ``by_customer`` lays the table out in one directory per customer. Rows are first rebalanced by customer:
    small customers end up in one file each, a customer with much data is split over many tasks.
    """
    if kind not in TABLES:
        raise ValueError(f"unknown table kind: {kind!r}")
    fmt = fmt or DEFAULT_FORMAT
    if fmt == "avro":
        if by_customer:
            raise ValueError("container files are not laid out by customer")
        write_avro(table, path, kind, mode, namespace, sync_interval)
        return fmt
    if sync_interval is not None:
        log.info("block size is set by the %s writer: sync_interval=%s is not used", fmt, sync_interval)
    if by_customer:
        out = conform(customer_column(table), kind, ("customer",)).hint("rebalance", "customer")
        out.write.format(fmt).mode(mode).partitionBy("customer").save(path)
    else:
        conform(table, kind).write.format(fmt).mode(mode).save(path)
    return fmt


def read_table(spark: SparkSession, path: str, kind: str, fmt: str | None = None, by_customer: bool = False) -> DataFrame:
    """Read a written table by field name, whether a job or a stream wrote it."""
    if fmt == "avro":
        return read_avro(spark, path, kind)
    _, schema = TABLES[kind]
    if by_customer:
        schema = StructType(schema.fields + [StructField("customer", StringType())])
    table = spark.read.format(fmt or DEFAULT_FORMAT).schema(schema).load(path).select(*schema.names)
    return table.withColumn("customer", _customer_name(F.col("customer"))) if by_customer else table


def stream_table(
    table: DataFrame,
    path: str,
    kind: str,
    checkpoint: str,
    fmt: str | None = None,
    by_customer: bool = False,
    available_now: bool = False,
    interval: str = "10 seconds",
    namespace: str | None = None,
):
    """Append a streaming parsed table to files; returns the running query.

    ``by_customer`` writes each micro-batch like :func:`write_table`, in a folder of its own: a customer with little in a batch gets one
    file, one with much is split over tasks. A batch that is run again replaces its folder. Container files (``fmt="avro"``) have a folder
    for each batch as well, each a table of its own.
    """
    if kind not in TABLES:
        raise ValueError(f"unknown table kind: {kind!r}")
    fmt = fmt or DEFAULT_FORMAT
    if by_customer or fmt == "avro":

        def write(batch: DataFrame, batch_id: int) -> None:
            write_table(batch, f"{path}/batch={batch_id}", kind, fmt, by_customer, "overwrite", namespace)

        writer = table.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        return writer.trigger(**trigger_of(available_now, interval)).start()
    writer = conform(table, kind).writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger_of(available_now, interval)).start(path)


# --- good rows and rejects ------------------------------------------------------------------------


def write_with_rejects(parsed: DataFrame, path: str, kind: str, mode: str = "append", fmt: str | None = None) -> dict[str, int]:
    """Write a parsed table with what did not parse beside it, in one pass; returns the rows of each parse status.

    Rows are parsed once and laid out by their status, which is the reason of a reject; counts are observed in the same job.
    """
    if kind not in PARSE_STATUSES:
        raise ValueError(f"no parse job for tables of kind {kind!r}")
    statuses = PARSE_STATUSES[kind]
    seen = Observation(f"write {kind}")
    counts = [F.count_if(F.col("parse_status") == status).alias(status) for status in statuses]
    counted = parsed.observe(seen, *counts, F.count(F.lit(1)).alias("rows"))
    conform(counted, kind, ("parse_status",)).write.format(fmt or DEFAULT_FORMAT).mode(mode).partitionBy("parse_status").save(path)
    return {name: seen.get[name] for name in (*statuses, "rows")}


def _by_status(spark: SparkSession, path: str, kind: str, fmt: str | None) -> DataFrame:
    schema = StructType(TABLES[kind][1].fields + [StructField("parse_status", StringType())])
    return spark.read.format(fmt or DEFAULT_FORMAT).schema(schema).load(path).select(*schema.names)


def read_good(spark: SparkSession, path: str, kind: str, fmt: str | None = None) -> DataFrame:
    """Rows that parsed in full; the files of others are not opened."""
    return _by_status(spark, path, kind, fmt).where("parse_status = 'ok'").drop("parse_status")


def read_rejects(spark: SparkSession, path: str, kind: str, fmt: str | None = None) -> DataFrame:
    """Rows that did not, each with the reason in ``parse_status``."""
    return _by_status(spark, path, kind, fmt).where("parse_status <> 'ok'")
