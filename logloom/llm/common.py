"""What several corpus operators share: tables, words, Arrow batches in bounded pieces."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BLANK_CHARS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def columns_of(df: DataFrame) -> list[Column]:
    """All columns, whatever characters their names have."""
    return [F.col("`" + name.replace("`", "``") + "`") for name in df.columns]


def row_hash(df: DataFrame) -> Column:
    """A hash of all columns of a row, maps among them (as JSON, for Spark does not hash maps)."""
    kinds = [field.dataType.simpleString() for field in df.schema]
    return F.xxhash64(*[F.to_json(F.struct(column.alias("c"))) if "map<" in kind else column for column, kind in zip(columns_of(df), kinds)])


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z, all other characters as they are."""
    return F.translate(text, UPPER, LOWER)


def count_words(text: Column) -> Column:
    """Number of runs of characters other than ASCII blanks; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def split_words(text: Column) -> Column:
    """The runs of characters other than ASCII blanks; null gives none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANK_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))


def doc_crc(doc_id: Column) -> Column:
    """CRC-32 of the id as text; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary"))


def pieces(batches: Iterator[pa.RecordBatch], text: int, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in slices of about ``most_bytes`` of column number ``text`` (at least one row each).

    At the end, memory that Arrow holds in reserve goes back, as the worker may wait for its next task.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        offsets = _sizes(batch.column(text))
        start, held = 0, 0
        for i, size in enumerate(offsets):
            if held and held + size > most_bytes:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size + 64
        yield batch.slice(start)
    pa.default_memory_pool().release_unused()


def _sizes(column: pa.Array) -> list[int]:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(column), 0).to_pylist()
