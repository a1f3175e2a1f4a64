"""Keep a costly expression from being copied by the optimizer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def settle_on_demand(df: DataFrame, *names: str) -> DataFrame:
    """The same rows, with the named columns computed at most once per row, and not at all where no later step reads them.

    They are held back by a condition that is always true but may not be moved or copied. Filters, on whatever column, then stay
    above them; use :func:`settle` where filters on other columns should come first.
    """
    held = {name: F.when(F.spark_partition_id() >= 0, F.col(name)) for name in names}
    return df.select(*[held[name].alias(name) if name in held else F.col(name) for name in df.columns])


def settle(df: DataFrame, *names: str) -> DataFrame:
    """The same rows, with the named columns computed exactly once per row.

    A filter on a computed column is moved below the projection that computes it, with the whole
    expression put in its place at every mention. For a parser that is a chain of steps this repeats
    the first ones many times over. A generator over a single row keeps its output columns in place.
    """
    others = [name for name in df.columns if name not in names]
    return df.select(*others, F.inline(F.array(F.struct(*names))))
