"""Output schemas. Every column is non-null; what did not parse holds ``""`` or ``0``."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HEADERS = T.StructField("headers", T.MapType(T.StringType(), T.StringType(), False), False)


def _record(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([HEADERS] + [T.StructField(name, kind, False) for name, kind in fields])


# Field names and order of the four record types.
ACCESS_FIELDS = [
    "ip", "identd", "user", "time", "method", "uri", "protocol", "statuscode", "bytesSend", "referer",
    "useragent", "servername", "extraservername", "timeSecond", "timeMicro", "connectionstatus",
    "connectiontype", "sessioncookie", "bytesIn", "bytesOut",
]
APP_FIELDS = ["datetime", "loglevel", "appservername", "classname", "thread", "message"]
SYSLOG_FIELDS = ["datetime", "hostname", "message"]

EVENT = _record(("body", T.StringType()))
ACCESS = _record(
    ("original", T.StringType()),
    *[(name, T.IntegerType() if name == "statuscode" else T.StringType()) for name in ACCESS_FIELDS],
)
APP = _record(
    ("original", T.StringType()), ("timestamp", T.LongType()), *[(name, T.StringType()) for name in APP_FIELDS]
)
SYSLOG = _record(
    ("original", T.StringType()), ("timestamp", T.LongType()), *[(name, T.StringType()) for name in SYSLOG_FIELDS]
)

# Table kind -> (record name, schema)
TABLES = {
    "event": ("Event", EVENT),
    "access": ("ApacheEvent", ACCESS),
    "app": ("JavaEvent", APP),
    "syslog": ("SyslogEvent", SYSLOG),
}

# What a parse job says of a row.
PARSE_STATUSES = {
    "access": ("ok", "no_match"),
    "app": ("ok", "bad_time", "no_match"),
    "syslog": ("ok", "too_short", "bad_time", "no_message"),
}

_AVRO_TYPES = {"string": "string", "int": "int", "bigint": "long"}


def avro_schema(kind: str, namespace: str | None = None) -> str:
    """Avro JSON of a table kind, for writing containers without nullable unions."""
    name, schema = TABLES[kind]
    fields = [
        {
            "name": field.name,
            "type": {"type": "map", "values": "string"}
            if isinstance(field.dataType, T.MapType)
            else _AVRO_TYPES[field.dataType.simpleString()],
        }
        for field in schema
    ]
    record = {"type": "record", "name": name, "fields": fields}
    if namespace:
        record["namespace"] = namespace
    return json.dumps(record)


def filled(value: Column, kind: T.DataType) -> Column:
    """The value in the given type, with the type's default for null. (Values inside headers are never null.)"""
    if isinstance(kind, T.MapType):
        return F.coalesce(value, F.create_map().cast(kind))
    return F.coalesce(value.cast(kind), F.lit("" if isinstance(kind, T.StringType) else 0).cast(kind))


def conform(df: DataFrame, kind: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """Select exactly the columns of a table kind, typed and with defaults filled in."""
    _, schema = TABLES[kind]
    columns = [filled(F.col(f.name), f.dataType).alias(f.name) for f in schema]
    return df.select(*columns, *extra)
