"""SimHash near-dedup by a segment-popcount embedding and a grid range join.

A 64-bit fingerprint is cut into segments of ``SEGMENT`` bits, and each segment is mapped to its bit count. The Manhattan distance
of two such count vectors is never above the Hamming distance of the fingerprints. A count is written in unary in the
bits of its segment (0: 00, 1: 01, 2: 11), so that a vector is a 64-bit word again and the Manhattan distance is the
popcount of an exclusive or.

Grid: the segments are dealt to ``blocks`` groups. Vectors within distance d differ in d groups at most, hence agree
on at least ``blocks - d`` groups: each choice of that many groups is a grid whose cells hold the vectors that agree on it. Pairs of a
cell are first tested by Manhattan distance and then by Hamming distance.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from logloom.llm.common import columns_of, pieces, row_hash
from logloom.llm.components import connected_components
from logloom.plans.scratch import saved

SEED = 42
SEGMENT = 2
UNIT = 2048
SMALL = 24


def fingerprints(texts: list[str | None], shingle: int) -> np.ndarray:
    """SimHash of each text, unsigned: a bit is set where over half of the shingles' hashes have it; no words: 0."""
    digest = xxhash.xxh64_intdigest
    hashes: list[int] = []
    counts = np.zeros(len(texts), dtype=np.int64)
    for i, text in enumerate(texts):
        words = (text or "").encode().lower().split()
        if not words:
            continue
        line = b" ".join(words)
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        n = max(1, len(words) - shingle + 1)
        last = ends[min(shingle, len(words)) - 1 :]
        hashes += [digest(line[a:b], SEED) for a, b in zip(starts[:n].tolist(), last.tolist())]
        counts[i] = n
    out = np.zeros(len(texts), dtype=np.uint64)
    held = np.flatnonzero(counts)
    if not len(held):
        return out
    set_bits = _bit_sums(np.array(hashes, dtype=np.uint64), counts[held])
    over_half = 2 * set_bits > counts[held][:, None]
    out[held] = np.packbits(over_half, axis=1, bitorder="little").view("<u8").reshape(-1)
    return out


def _bit_sums(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """How many of each run of ``counts`` hashes have each of the 64 bits set."""
    sums = np.zeros((len(counts), 64), dtype=np.int64)
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    start = 0
    for row, n in enumerate(counts.tolist()):
        sums[row] = bits[start : start + n].sum(axis=0, dtype=np.int32)
        start += n
    return sums


def with_fingerprints(documents: DataFrame, shingle: int, **hashes: Column) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long) and the given long columns of each row."""
    names = ["doc_id", "fp", *hashes]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 1, 2 << 20):
            found = fingerprints(batch.column(1).to_pylist(), shingle)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64)), *batch.columns[2:]], names)

    rows = documents.select("doc_id", "text", *[column.alias(name) for name, column in hashes.items()])
    return rows.mapInArrow(run, ", ".join(f"{name} long" for name in names))


def embed(fps: np.ndarray, segment: int = SEGMENT) -> np.ndarray:
    """Bit counts per segment, in unary within the segment's bits; ``segment`` divides 8."""
    table = np.zeros(256, dtype=np.uint8)
    for byte in range(256):
        for at in range(0, 8, segment):
            ones = ((byte >> at) & ((1 << segment) - 1)).bit_count()
            table[byte] |= ((1 << ones) - 1) << at
    return table[np.ascontiguousarray(fps).view(np.uint8)].view(np.uint64)


def grid_masks(distance: int, blocks: int, segment: int = SEGMENT) -> list[int]:
    """The bits that vectors of one cell share, for each choice of groups of segments."""
    segments = 64 // segment
    groups = [0] * blocks
    for s in range(segments):
        groups[s * blocks // segments] |= ((1 << segment) - 1) << (s * segment)
    return [sum(chosen) for chosen in combinations(groups, blocks - distance)]


def blocks_for(n: int, distance: int, cell: int = 256) -> int:
    """Fewest groups for which an average cell holds ``cell`` of ``n`` vectors at most; any number gives the same pairs."""
    for blocks in range(distance + 2, 32 // 2):
        if n * 0.375 ** (32 * (blocks - distance) / blocks) <= cell:
            return blocks
    return 16


def _links(fps: np.ndarray, distance: int, split: int | None) -> list[tuple[int, int]]:
    """Pairs within the distance that join all components of the given fingerprints (a spanning forest, not all pairs).

    With ``split``, only pairs of one of the first ``split`` and one of the others are looked at.
    """
    vectors = embed(fps)
    component = np.arange(len(fps))
    found = []
    last = len(fps) if split is None else split
    for i in range(last):
        rest = slice(i + 1, None) if split is None else slice(split, None)
        near = np.flatnonzero(np.bitwise_count(vectors[rest] ^ vectors[i]) <= distance) + rest.start
        near = near[np.bitwise_count(fps[near] ^ fps[i]) <= distance]
        for j in near[component[near] != component[i]].tolist():
            if component[j] != component[i]:
                found.append((i, j))
                component[component == component[j]] = component[i]
    return found


def near_links(fps: DataFrame, distance: int, blocks: int, unit: int = UNIT) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` that join whatever is within ``distance`` bits, directly or by others.

    Cells of more than ``unit`` vectors, which are counted first, are dealt to pairs of sub-cells, each pair a unit of
    work of its own; a unit gives no more links than it has vectors.
    """
    masks = grid_masks(distance, blocks)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            vectors = embed(values.view(np.uint64))
            for grid, mask in enumerate(masks):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(values), grid, np.int32)), pa.array((vectors & np.uint64(mask)).view(np.int64)), pa.array(values)], ["grid", "cell", "fp"])

    rows = fps.select("fp").mapInArrow(cells, "grid int, cell long, fp long")
    crowded = rows.groupBy("grid", "cell").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > unit)
    rows = rows.join(crowded, ["grid", "cell"], "left")
    parts = F.coalesce(F.ceil(2 * F.col("_n") / unit), F.lit(1)).cast("int")
    rows = rows.withColumn("_parts", parts).withColumn("_part", F.pmod(F.xxhash64("fp"), F.col("_parts")).cast("int"))
    units = F.when(F.col("_parts") == 1, F.array(F.struct(F.lit(0).alias("low"), F.lit(0).alias("high")))).otherwise(
        F.transform(F.sequence(F.lit(0), F.col("_parts") - 1), lambda other: F.struct(F.least("_part", other).alias("low"), F.greatest("_part", other).alias("high"))))
    dealt = rows.select("grid", "cell", "_part", "fp", F.inline(units))
    dealt = dealt.repartition("grid", "cell", "low", "high").sortWithinPartitions("grid", "cell", "low", "high", "_part", "fp")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            held.append(np.stack([batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(6)]))
            done, rest = _whole_units(np.concatenate(held, axis=1))
            held = [rest]
            if done.shape[1]:
                yield _compare_units(done, distance)
        if held and held[0].shape[1]:
            yield _compare_units(held[0], distance)

    return dealt.select("grid", "cell", "low", "high", "_part", "fp").mapInArrow(compare, "a long, b long").distinct()


def _unit_starts(rows: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.flatnonzero((rows[:4, 1:] != rows[:4, :-1]).any(axis=0)) + 1)) if rows.shape[1] else np.zeros(0, np.int64)


def _whole_units(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows but those of the last unit, which may go on in the next batch; and these."""
    starts = _unit_starts(rows)
    cut = starts[-1] if len(starts) else 0
    return rows[:, :cut], rows[:, cut:]


def _compare_units(rows: np.ndarray, distance: int) -> pa.RecordBatch:
    """Links of whole units: all of those of units of up to ``SMALL`` rows, which are compared at once by their offset, else a forest."""
    starts = _unit_starts(rows)
    sizes = np.diff(np.append(starts, rows.shape[1]))
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    small = rows[5, np.repeat(sizes <= SMALL, sizes)]
    unit = np.repeat(np.arange((sizes <= SMALL).sum()), sizes[sizes <= SMALL])
    fps = small.view(np.uint64)
    vectors = embed(fps)
    for offset in range(1, SMALL):
        left = np.flatnonzero(unit[offset:] == unit[: len(unit) - offset])
        if not len(left):
            break
        left = left[np.bitwise_count(vectors[left] ^ vectors[left + offset]) <= distance]
        left = left[np.bitwise_count(fps[left] ^ fps[left + offset]) <= distance]
        a.append(small[left])
        b.append(small[left + offset])
    for start, size in zip(starts[sizes > SMALL].tolist(), sizes[sizes > SMALL].tolist()):
        own = rows[:, start : start + size]
        split = None if own[2, 0] == own[3, 0] else int((own[4] == own[2, 0]).sum())
        pairs = np.array(_links(own[5].view(np.uint64), distance, split), dtype=np.int64).reshape(-1, 2)
        a.append(own[5, pairs[:, 0]])
        b.append(own[5, pairs[:, 1]])
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])


def simhash_groups(documents: DataFrame, shingle: int = 4, distance: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 lowercase hex digits) and component_id (smallest doc_id linked, directly or by others), a row per row.

    Equal fingerprints are one node, whatever their number of documents. Texts without words have fingerprint 0 and are linked
    like any other. A null doc_id never names a component unless all its documents have none.
    """
    docs = saved(with_fingerprints(documents, shingle), "simhash-documents")
    placed = _placed(docs, distance)
    linked = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    named = placed.select("fp", "component").join(linked, "component").select("fp", "component_id")
    return docs.join(named, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def _placed(docs: DataFrame, distance: int) -> DataFrame:
    """fp, component (smallest fingerprint linked) and least (smallest doc_id) of each distinct fingerprint of ``docs``."""
    nodes = saved(docs.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    blocks = blocks_for(nodes.count(), distance)
    links = near_links(nodes.repartition("fp"), distance, blocks)
    found = connected_components(links).withColumnRenamed("node", "fp")
    return nodes.join(found, "fp", "left").withColumn("component", F.coalesce("component", "fp"))


def one_of_each_group(documents: DataFrame, shingle: int = 4, distance: int = 4) -> DataFrame:
    """One row of each SimHash group: that with the smallest doc_id, null last, then the first by hashes of text and row.

    Groups are told apart by their fingerprints, so ids may be null or repeated. The choice is made on hashes, in
    aggregations only; whole rows are looked up by them.
    """
    row = F.struct(*columns_of(documents))
    hashes = {"_text_hash": F.xxhash64("text"), "_row_hash": row_hash(documents)}
    docs = saved(with_fingerprints(documents, shingle, **hashes), "simhash-documents")
    key = ["doc_id", *hashes]
    counted = docs.groupBy("fp", *key).agg(F.count(F.lit(1)).alias("_n"))
    in_groups = counted.join(_placed(docs, distance).select("fp", "component"), "fp")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("_last"), *key, "_n"))
    chosen = in_groups.groupBy("component").agg(first.alias("_first")).select("component", *[F.col(f"_first.{k}").alias(f"_of_{k}") for k in [*key, "_n"]])
    rows = documents.select(row.alias("row"), "doc_id", *[column.alias(name) for name, column in hashes.items()])
    same = F.col("_row_hash") == F.col("_of__row_hash")
    found = rows.join(chosen, same & (F.col("_text_hash") == F.col("_of__text_hash")) & F.col("doc_id").eqNullSafe(F.col("_of_doc_id")))
    several = found.where("_of__n > 1").groupBy("component").agg(F.first("row").alias("row"))  # equal rows
    return found.where("_of__n = 1").select("row").unionByName(several.select("row")).select("row.*")


def first_of_groups(documents: DataFrame, groups: DataFrame) -> DataFrame:
    """One document for each id that names a group; ``one_of_each_group`` tells groups with the same or no id apart.

    Of rows that share that id, the first by hashes of text and row stays. Rows without an id are in no group that has one; if some
    group has none at all, one of them stays in all.
    """
    names = F.max(F.col("doc_id").eqNullSafe(F.col("component_id")))
    kept = groups.groupBy(F.col("doc_id").alias("_id")).agg(F.count(F.lit(1)).alias("_n"), names.alias("_names")).where("_names")
    rows = documents.select(F.struct(*columns_of(documents)).alias("row"), F.col("doc_id").alias("_of"), row_hash(documents).alias("_hash"))
    joined = rows.join(kept, F.col("_of").eqNullSafe(F.col("_id")))
    by_content = Window.partitionBy("_of").orderBy(F.xxhash64("row.text"), "_hash")
    several = joined.where("_n > 1").withColumn("_at", F.row_number().over(by_content)).where("_at = 1")
    return joined.where("_n = 1").select("row").unionByName(several.select("row")).select("row.*")
