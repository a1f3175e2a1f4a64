"""Header maps: read, test, set and merge keys of a ``map<string,string>`` column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def no_headers() -> Column:
    return F.create_map().cast("map<string,string>")


def header_get(headers: Column, name: str) -> Column:
    """Value of a header, null when it is absent."""
    return F.element_at(headers, F.lit(name))


def header_has(headers: Column, name: str) -> Column:
    return F.map_contains_key(headers, name)


def header_put(headers: Column, name: str, value: Column) -> Column:
    """Set a header, replacing what it held."""
    return headers_put(headers, {name: value})


def headers_put(headers: Column, values: dict[str, Column]) -> Column:
    """Set several headers, replacing what they held."""
    names = [F.lit(name) for name in values]
    present = F.arrays_overlap(F.map_keys(headers), F.array(*names))
    others = F.map_filter(headers, lambda key, _: ~key.isin(*names))
    pairs = [part for name, value in zip(names, values.values()) for part in (name, value)]
    # Taking keys out means a loop over the map, so it is done only where one is there.
    return F.map_concat(F.when(present, others).otherwise(headers), F.create_map(*pairs))


def merge_keep(headers: Column, statics: Column) -> Column:
    """Add the static pairs whose key is not in the headers yet."""
    new = F.map_filter(statics, lambda k, _: ~F.map_contains_key(headers, k))
    return F.map_concat(headers, new)


def merge_overwrite(headers: Column, statics: Column) -> Column:
    """Add all static pairs; a static pair wins over an existing header."""
    others = F.map_filter(headers, lambda k, _: ~F.map_contains_key(statics, k))
    return F.map_concat(others, statics)


def headers_text(headers: Column) -> Column:
    """Headers as ``k=v;k=v`` in key order, for comparing and grouping (maps can do neither)."""
    entries = F.array_sort(F.map_entries(headers))
    return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
