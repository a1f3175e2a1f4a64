"""Avro container files, written and read by Spark's text files.

A container is a header and blocks, each followed by the same 16 bytes, the sync marker. With the marker as the line separator, the
header and the blocks are the *lines* of a text file: Spark writes them under its commit protocol and reads them in splits, cut
at markers. Records are encoded by expressions; Python only packs encoded records into blocks, and decodes blocks.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, MapType, StringType, StructType

from logloom.plans.scratch import exists, remove_path
from logloom.schemas import TABLES, avro_schema, conform

# Fixed values of the format: first bytes, names in the header, codecs without a package of their own.
MAGIC = b"Obj\x01"
CODECS = ("null", "deflate")
# Bytes of records in a block where no other number is asked for.
SYNC_INTERVAL = 16_000
# Bytes of blocks that pass between Spark and Python at a time: a batch for every small block costs more than its records.
BATCH_BYTES = 1 << 20
# File that keeps the table's marker; readers of the data pass it by.
MARKER_FILE = "_sync_marker"


# --- encoding -------------------------------------------------------------------------------------


def _bytes(*parts: Column) -> Column:
    """Bytes one after the other. Strings are not looked into, so a string may hold any bytes."""
    return F.concat(*[part.cast("string") for part in parts])


def _varint(number: Column, most_bytes: int) -> Column:
    """A number that is not negative, seven bits to a byte, lowest first; all but the last byte have the high bit set."""

    def byte(i: int, last: bool) -> Column:
        low = F.shiftrightunsigned(number, 7 * i).bitwiseAND(127)
        return F.lpad(F.hex(low if last else low + 128), 2, "0")

    def of(n: int) -> Column:
        return F.unhex(F.concat(*[byte(i, i == n - 1) for i in range(n)]))

    out = of(most_bytes)
    for n in reversed(range(1, most_bytes)):
        out = F.when(F.shiftrightunsigned(number, 7 * n) == 0, of(n)).otherwise(out)
    return out


def _long(number: Column) -> Column:
    number = number.cast("bigint")
    return _varint(F.shiftleft(number, 1).bitwiseXOR(F.shiftright(number, 63)), 10)


def _size(number: Column) -> Column:
    return _varint(number.cast("bigint") * 2, 5)


def _string(text: Column) -> Column:
    return _bytes(_size(F.octet_length(text)), text)


def _map(entries: Column) -> Column:
    pairs = F.transform(F.map_entries(entries), lambda entry: _bytes(_string(entry["key"]), _string(entry["value"])))
    end = F.lit(bytearray(b"\0"))
    return F.when(F.size(entries) > 0, _bytes(_size(F.size(entries)), F.array_join(pairs, ""), end)).otherwise(_bytes(end))


def encode_record(schema: StructType) -> Column:
    """The bytes of a row as an Avro record with the fields of the schema."""
    encoders = {MapType: _map, StringType: _string, IntegerType: _long, LongType: _long}
    return _bytes(*[encoders[type(field.dataType)](F.col(field.name)) for field in schema]).cast("binary")


def _python_long(number: int) -> bytes:
    number = (number << 1) ^ (number >> 63)
    out = bytearray()
    while number > 127:
        out.append(number & 127 | 128)
        number >>= 7
    out.append(number)
    return bytes(out)


def _python_string(data: bytes) -> bytes:
    return _python_long(len(data)) + data


def _header(schema: str, codec: str) -> bytes:
    """Everything of a file before its first marker."""
    pairs = {b"avro.schema": schema.encode(), b"avro.codec": codec.encode()}
    return MAGIC + _python_long(len(pairs)) + b"".join(_python_string(k) + _python_string(v) for k, v in pairs.items()) + b"\0"


def _blocks(header: bytes, codec: str, sync_interval: int):
    def block(records: list[bytes]) -> bytes:
        data = b"".join(records)
        if codec == "deflate":
            packer = zlib.compressobj(wbits=-15)
            data = packer.compress(data) + packer.flush()
        return _python_long(len(records)) + _python_string(data)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        done, ready = [header], len(header)
        for batch in batches:
            for record in batch.column(0).to_pylist():
                held.append(record)
                size += len(record)
                if size >= sync_interval:
                    done.append(block(held))
                    ready += len(done[-1])
                    held, size = [], 0
                    if ready >= BATCH_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(done, pa.binary())], ["block"])
                        done, ready = [], 0
        if held:
            done.append(block(held))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(done, pa.binary())], ["block"])

    return run


def _marker(spark: SparkSession, path: str, new: bool) -> str:
    """The table's marker: 16 characters drawn once, so that no text holds them but by their being copied."""
    file = f"{path}/{MARKER_FILE}"
    if not exists(spark, f"{file}/_SUCCESS"):
        if not new:
            raise FileNotFoundError(f"no container files at {path}")
        spark.range(1).select(F.lit(uuid.uuid4().hex[:16]).alias("value")).coalesce(1).write.mode("overwrite").text(file)
    return spark.read.text(file).first()[0]


def write_avro(
    table: DataFrame,
    path: str,
    kind: str,
    mode: str = "append",
    namespace: str | None = None,
    sync_interval: int | None = None,
    codec: str = "null",
) -> None:
    """Write a parsed table as Avro container files.

    A block is closed once its records have ``sync_interval`` bytes, so a block is that long and a record more at most. An overwritten table is
    removed first; a task that is run again writes its file again, and files show when the whole job is done.
    """
    if codec not in CODECS:
        raise ValueError(f"codec is one of {CODECS}, not {codec!r}")
    if mode not in ("append", "overwrite"):
        raise ValueError(f"mode is append or overwrite, not {mode!r}")
    spark = table.sparkSession
    if mode == "overwrite":
        remove_path(spark, path)
    marker = _marker(spark, path, True)
    header = _header(avro_schema(kind, namespace), codec)
    records = conform(table, kind).select(encode_record(TABLES[kind][1]).alias("record"))
    blocks = records.mapInArrow(_blocks(header, codec, SYNC_INTERVAL if sync_interval is None else sync_interval), "block binary")
    blocks.select(F.col("block").cast("string").alias("value")).write.mode("append").text(path, lineSep=marker)


# --- decoding -------------------------------------------------------------------------------------


class _Reader:
    """Reads the values of a block one after the other."""

    def __init__(self, data: bytes):
        self.data, self.at = data, 0

    def long(self) -> int:
        number = shift = 0
        while True:
            byte = self.data[self.at]
            self.at += 1
            number |= (byte & 127) << shift
            if byte < 128:
                return (number >> 1) ^ -(number & 1)
            shift += 7

    def bytes(self) -> bytes:
        size = self.long()
        start, self.at = self.at, self.at + size
        if size < 0 or self.at > len(self.data):
            raise ValueError("a block of the container is cut short")
        return self.data[start : self.at]

    def string(self) -> str:
        return self.bytes().decode("utf-8", "replace")

    def map(self) -> list[tuple[str, str]]:
        pairs = []
        while n := self.long():
            if n < 0:  # then the size of the entries in bytes comes first
                n = -n
                self.long()
            pairs += [(self.string(), self.string()) for _ in range(n)]
        return pairs


def _read_records(data: bytes, n: int, kinds: list[str], columns: list[list]) -> None:
    """Append the values of ``n`` records with fields of these kinds to their columns."""
    at, size = 0, len(data)
    fields = [(kind == "string", kind == "map", column.append) for kind, column in zip(kinds, columns)]
    for _ in range(n):
        for is_string, is_map, add in fields:
            if is_map:
                reader = _Reader(data)
                reader.at = at
                add(reader.map())
                at = reader.at
                continue
            byte = data[at]
            at += 1
            number = byte & 127
            shift = 7
            while byte > 127:
                byte = data[at]
                at += 1
                number |= (byte & 127) << shift
                shift += 7
            number = (number >> 1) ^ -(number & 1)
            if is_string:
                start, at = at, at + number
                if number < 0 or at > size:
                    raise ValueError("a block of the container is cut short")
                add(data[start:at].decode("utf-8", "replace"))
            else:
                add(number)


def _decoded(fields: list[tuple[str, str]], wanted: list[str], codec: str):
    """Rows of blocks whose records have ``fields`` (name, type), with the ``wanted`` ones by name."""
    places = {name: i for i, (name, _) in enumerate(fields)}
    kinds = [kind for _, kind in fields]
    arrow = {"map": pa.map_(pa.string(), pa.string()), "string": pa.string(), "int": pa.int32(), "long": pa.int64()}

    def rows_of(columns: list[list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(columns[places[name]], arrow[kinds[places[name]]]) for name in wanted], wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns, held = [[] for _ in fields], 0
        for batch in batches:
            for data in batch.column(0).to_pylist():
                block = _Reader(data)
                n, packed = block.long(), block.bytes()
                if block.at != len(data):
                    raise ValueError("a block of the container holds its marker")
                unpacked = zlib.decompress(packed, wbits=-15) if codec == "deflate" else packed
                _read_records(unpacked, n, kinds, columns)
                held += len(unpacked)
                if held >= BATCH_BYTES:
                    yield rows_of(columns)
                    columns, held = [[] for _ in fields], 0
        if held:
            yield rows_of(columns)

    return run


def _writer_schema(header: bytes) -> tuple[list[tuple[str, str]], str]:
    """Fields (name, type) and codec that a header names."""
    reader = _Reader(header)
    reader.at = len(MAGIC)
    found = dict(reader.map())
    fields = json.loads(found["avro.schema"])["fields"]
    return [(field["name"], field["type"] if isinstance(field["type"], str) else field["type"]["type"]) for field in fields], found["avro.codec"]


def read_avro(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """A table of container files, by field name: fields that were not written have their defaults, further ones are passed by.

    Files are read in splits, cut at markers. All files of a table have one schema and codec, those of its first header.
    """
    lines = spark.read.text(path, lineSep=_marker(spark, path, False)).select(F.col("value").cast("binary").alias("block"))
    is_header = F.substring("block", 1, len(MAGIC)) == F.lit(bytearray(MAGIC))
    first = lines.where(is_header).first()
    _, schema = TABLES[kind]
    if first is None:
        return conform(spark.createDataFrame([], schema), kind)
    fields, codec = _writer_schema(bytes(first[0]))
    wanted = [name for name in schema.names if name in dict(fields)]
    kinds = StructType([schema[name] for name in wanted])
    rows = lines.where(~is_header).mapInArrow(_decoded(fields, wanted, codec), kinds)
    missing = {field.name: F.lit(None).cast(field.dataType) for field in schema if field.name not in wanted}
    return conform(rows.withColumns(missing), kind)
