"""Removal of passages that repeat across documents, by prefix-free parsing.

Texts are cut into phrases at rolling-hash triggers (``parsing``). The dictionary holds the distinct phrases that share a key with another
document, the parse says where each lies. Only the dictionary's suffixes are sorted, in shards by key: strings that are
equal over LENGTH bytes have the same key and so meet in one shard. The order of all positions of the corpus follows from
both: a position is where its phrase is in the parse, and its suffix is where that suffix is in the dictionary.

Texts travel in packs of about a megabyte, compressed, and stay where they are: what is found out about a pack comes to it by
a join on its number. A pack has its phrases in one order each time it is parsed, so that a shard answers by bits in the order
in which it was asked. A pack asks a shard in one row, of packed columns.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm.common import pieces
from logloom.llm.parsing import LENGTH, all_phrases, suffix_groups
from logloom.plans.scratch import new_folder, saved, shuffles_dropped

PACK_BYTES = 1 << 20
LAST = (1 << 63) - 1
KEY_BYTES = 5
SHARD = 512
PACKS_PER_SHARD = 16
_BITS = 63  # of a mask, more than a phrase has windows


def _packed(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(pa.RecordBatch.from_arrays([pa.concat_arrays([c]) for c in batch.columns], names=batch.schema.names))
    return sink.getvalue().to_pybytes()


class Pack:
    """The documents of a pack: ids (null last), texts one after the other, ends."""

    def __init__(self, blob: bytes):
        table = pa.ipc.open_stream(blob).read_all()
        self.doc_ids = table.column(0).to_pylist()
        texts = [text.encode() if text else b"" for text in table.column(1).to_pylist()]
        self.buffer = b"".join(texts)
        self.data = np.frombuffer(self.buffer, dtype=np.uint8)
        self.ends = np.cumsum([len(text) for text in texts], dtype=np.int64)
        self.order = np.array([LAST if d is None else d for d in self.doc_ids], dtype=np.int64)

    def phrases(self, shards: int) -> Phrases:
        at, n, keys = all_phrases(self.data, self.ends)
        keys >>= np.uint64(64 - 8 * KEY_BYTES)
        docs = np.searchsorted(self.ends, at, side="right")
        order = np.lexsort((self.order[docs], keys, keys % np.uint64(shards)))
        return Phrases(self, shards, at[order], n[order], keys[order], self.order[docs[order]])


class Phrases:
    """The phrases of a pack by shard, key and document, and the place where those of each key begin."""

    def __init__(self, pack: Pack, shards: int, at: np.ndarray, n: np.ndarray, keys: np.ndarray, docs: np.ndarray):
        self.pack, self.shards, self.at, self.n, self.keys, self.docs = pack, shards, at, n, keys, docs
        self.firsts = _changes(keys)

    def by_shard(self, firsts: np.ndarray) -> list[tuple[int, slice]]:
        """The shards that have any of the groups that begin at these places, and which."""
        bounds = np.searchsorted(self.keys[firsts] % np.uint64(self.shards), np.arange(self.shards + 1))
        return [(s, slice(a, b)) for s, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())) if a < b]

    def distinct(self, shared: dict[int, bytes]) -> Distinct:
        """Those with the keys that are marked by bits, shard by shard."""
        marks = np.zeros(len(self.firsts), dtype=bool)
        for shard, keys in self.by_shard(self.firsts):
            if shard in shared:
                marks[keys] = _from_bits(shared[shard], keys.stop - keys.start)
        wanted = np.repeat(marks, np.diff(np.append(self.firsts, len(self.keys))))
        return Distinct(self.pack, self.shards, self.at[wanted], self.n[wanted], self.keys[wanted], self.docs[wanted])


class Distinct(Phrases):
    """Phrases in the order of their hashes within a key; equal ones have one entry, which begins with the smallest document."""

    def __init__(self, pack: Pack, shards: int, at: np.ndarray, n: np.ndarray, keys: np.ndarray, docs: np.ndarray):
        digest, buffer = xxhash.xxh64_intdigest, pack.buffer
        hashes = np.array([digest(buffer[a:b]) for a, b in zip(at.tolist(), (at + n + LENGTH - 1).tolist())], dtype=np.uint64)
        order = np.lexsort((docs, hashes, keys, keys % np.uint64(shards)))
        super().__init__(pack, shards, at[order], n[order], keys[order], docs[order])
        self.hashes = hashes[order]
        self.firsts = _changes(self.keys, self.hashes)


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Where rows begin that differ from the one before."""
    if not len(columns[0]):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate(([True], np.logical_or.reduce([c[1:] != c[:-1] for c in columns]))))


def _to_bits(marks: np.ndarray) -> bytes:
    return np.packbits(marks).tobytes()


def _from_bits(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=n).astype(bool)


def pack_texts(documents: DataFrame) -> DataFrame:
    """pack and blob, in a table that is bucketed by pack: joins on it move the other side only."""
    spark = documents.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, number = TaskContext.get().partitionId() << 32, 0
        for batch in pieces(batches, 1, PACK_BYTES):
            yield pa.RecordBatch.from_arrays([pa.array([base + number]), pa.array([_packed(batch)], pa.binary())], ["pack", "blob"])
            number += 1

    packs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "pack long, blob binary")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"texts_{uuid.uuid4().hex}"
    packs.repartition(buckets, "pack").write.bucketBy(buckets, "pack").option("compression", "uncompressed").option(
        "path", new_folder(spark, "texts")).saveAsTable(name)
    return spark.table(name)


def _to_bytes(keys: np.ndarray) -> bytes:
    return np.ascontiguousarray(keys.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES].tobytes()


def _from_bytes(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // KEY_BYTES, 8), dtype=np.uint8)
    wide[:, :KEY_BYTES] = np.frombuffer(data, dtype=np.uint8).reshape(-1, KEY_BYTES)
    return wide.view("<u8").reshape(-1)


def _doc_bytes(docs: np.ndarray) -> bytes:
    """Document numbers, as many: the distinct ones by their differences, then the place of each among them."""
    values, where = np.unique(docs, return_inverse=True)
    steps = np.diff(values, prepend=np.int64(0))
    return np.concatenate(([len(values)], steps)).astype("<i8").tobytes() + where.astype("<u4").reshape(-1, 1).view(np.uint8).T.tobytes()


def _from_doc_bytes(data: bytes) -> np.ndarray:
    n = int(np.frombuffer(data, "<i8", 1)[0])
    values = np.cumsum(np.frombuffer(data, "<i8", n, 8))
    where = np.ascontiguousarray(np.frombuffer(data, np.uint8, offset=8 * (n + 1)).reshape(4, -1).T).view("<u4").reshape(-1)
    return values[where]


def shared_keys(packs: DataFrame, shards: int) -> DataFrame:
    """pack, shard and a bit for each distinct key of the pack in that shard: whether several documents have it.

    A pack tells each shard its distinct keys once, with those that two of its own documents have; a shard adds up packs.
    """

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pack, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = Pack(blob.as_py()).phrases(shards)
                keys = found.keys[found.firsts]
                several = found.docs[found.firsts] != found.docs[np.append(found.firsts[1:], len(found.keys)) - 1] if len(keys) else np.zeros(0, bool)
                rows = found.by_shard(found.firsts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([s for s, _ in rows], pa.int32()), pa.array([pack] * len(rows), pa.int64()), pa.array([_to_bytes(keys[r]) for _, r in rows], pa.binary()),
                     pa.array([_to_bits(several[r]) for _, r in rows], pa.binary())], ["shard", "pack", "keys", "several"])

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches, 1):
            keys = [_from_bytes(k) for k in rows.column(2).to_pylist()]
            several = np.concatenate([_from_bits(s, len(k)) for s, k in zip(rows.column(3).to_pylist(), keys)])
            found, where, counts = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
            shared = counts > 1
            shared[where[several]] = True
            keep = shared[where]
            ends = np.cumsum([len(k) for k in keys])
            marks = [keep[e - len(k) : e] for k, e in zip(keys, ends)]
            yield pa.RecordBatch.from_arrays(
                [rows.column(1), rows.column(0), pa.array([_to_bits(m) if m.any() else None for m in marks], pa.binary())], ["pack", "shard", "shared"])

    told = packs.mapInArrow(tell, "shard int, pack long, keys binary, several binary")
    added = told.repartition("shard").sortWithinPartitions("shard", "pack").mapInArrow(add_up, "pack long, shard int, shared binary")
    return added.where("shared IS NOT NULL")


def _runs(batches: Iterator[pa.RecordBatch], columns: int) -> Iterator[pa.RecordBatch]:
    """Rows that agree in the first columns, from batches in their order."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = list(zip(*(batch.column(k).to_pylist() for k in range(columns))))
        start = 0
        for i, key in enumerate(keys):
            if key != last:
                if i > start:
                    held.append(batch.slice(start, i - start))
                if held:
                    yield _one(held)
                held, start, last = [], i, key
        held.append(batch.slice(start))
    if held:
        yield _one(held)


def _whole_shards(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Rows of several whole shards (equal key and part) together, ``least`` rows at least but for the last."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) < least:
            continue
        rows = _one(held)
        key, part = rows.column(0).to_numpy(), rows.column(1).to_numpy()
        change = np.flatnonzero((key[1:] != key[:-1]) | (part[1:] != part[:-1]))
        if len(change):
            yield rows.slice(0, change[-1] + 1)
            rows = rows.slice(change[-1] + 1)
        held = [rows]
    if held and (rows := _one(held)).num_rows:
        yield rows


def _one(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return batches[0] if len(batches) == 1 else pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def _with_packs(packs: DataFrame, news: DataFrame, how: str = "inner") -> DataFrame:
    """blob and news of each pack; ``news`` is gathered per pack, which bounds it."""
    gathered = news.groupBy("pack").agg(F.collect_list("news").alias("news"))
    return packs.hint("merge").join(gathered.hint("merge"), "pack", how).select("pack", "blob", "news")


def _per_pack(step: Callable[[int, Pack, pa.Array | None], pa.RecordBatch]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pack, blob, news in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                yield step(pack, Pack(blob.as_py()), news.values)

    return run


def _shared(news: pa.Array) -> dict[int, bytes]:
    return {s: bits for s, bits in zip(news.field("shard").to_pylist(), news.field("shared").to_pylist()) if bits is not None}


def decided_phrases(packs: DataFrame, shared: DataFrame, shards: int) -> DataFrame:
    """pack, shard, shared as they were, and what the shard says of the distinct phrases of the pack with these keys, in their order.

    ``whole`` has a bit for each: whether a smaller document than the pack's smallest has the phrase. If none has, strings of the phrase may
    still be in others with its key: ``open`` has the places of such phrases, ``parts`` into how many the key is split, by SHARD phrases each.
    """
    most = SHARD

    def ask(number: int, pack: Pack, news: pa.Array) -> pa.RecordBatch:
        bits = _shared(news)
        found = pack.phrases(shards).distinct(bits)
        rows = found.by_shard(found.firsts)
        keys, hashes, docs = found.keys[found.firsts], found.hashes[found.firsts], found.docs[found.firsts]
        return pa.RecordBatch.from_arrays(
            [pa.array([s for s, _ in rows], pa.int32()), pa.array([number] * len(rows), pa.int64()), pa.array([bits[s] for s, _ in rows], pa.binary()),
             pa.array([_to_bytes(keys[r]) for _, r in rows], pa.binary()), pa.array([hashes[r].astype("<u8").tobytes() for _, r in rows], pa.binary()),
             pa.array([_doc_bytes(docs[r]) for _, r in rows], pa.binary())], ["shard", "pack", "shared", "keys", "hashes", "docs"])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches, 1):
            keys = [_from_bytes(k) for k in rows.column(3).to_pylist()]
            ends = np.cumsum([len(k) for k in keys])
            keys = np.concatenate(keys)
            hashes = np.frombuffer(b"".join(rows.column(4).to_pylist()), "<u8")
            docs = np.concatenate([_from_doc_bytes(d) for d in rows.column(5).to_pylist()])
            order = np.lexsort((docs, hashes, keys))
            firsts = _changes(keys[order], hashes[order])
            sizes = np.diff(np.append(firsts, len(order)))
            whole = np.empty(len(order), dtype=bool)
            whole[order] = docs[order] > np.repeat(docs[order][firsts], sizes)
            of_key = _changes(keys[order][firsts])
            variants = np.diff(np.append(of_key, len(firsts)))
            parts = np.empty(len(order), np.int32)
            parts[order] = np.repeat(np.repeat(np.where(variants > 1, -(-variants // most), 0), variants), sizes)
            parts[whole] = 0
            out = []
            for a, b in zip(np.append(0, ends[:-1]).tolist(), ends.tolist()):
                places = np.flatnonzero(parts[a:b])
                out.append((_to_bits(whole[a:b]), places.astype("<u4").tobytes(), parts[a:b][places].astype("<i4").tobytes()))
            yield pa.RecordBatch.from_arrays(
                [rows.column(1), rows.column(0), rows.column(2), *(pa.array(list(c), pa.binary()) for c in zip(*out))], ["pack", "shard", "shared", "whole", "open", "parts"])

    joined = _with_packs(packs, shared.select("pack", F.struct("shard", "shared").alias("news")))
    asked = joined.mapInArrow(_per_pack(ask), "shard int, pack long, shared binary, keys binary, hashes binary, docs binary")
    return asked.repartition("shard").sortWithinPartitions("shard", "pack").mapInArrow(
        answer, "pack long, shard int, shared binary, whole binary, open binary, parts binary")


def phrase_strings(packs: DataFrame, decided: DataFrame, shards: int) -> DataFrame:
    """key, part, pack, entry (place among the distinct phrases of the pack), doc, first (window within the phrase) and bytes of the phrases that are open.

    A key with more than SHARD phrases is split by the strings themselves, each a row of its own; other phrases are one row.
    """

    def step(number: int, pack: Pack, news: pa.Array) -> pa.RecordBatch:
        found = pack.phrases(shards).distinct(_shared(news))
        begins = {s: r.start for s, r in found.by_shard(found.firsts)}
        entries = np.concatenate([np.frombuffer(o, "<u4").astype(np.int64) + begins[s] for s, o in zip(news.field("shard").to_pylist(), news.field("open").to_pylist())])
        parts = np.frombuffer(b"".join(news.field("parts").to_pylist()), "<i4")
        at, n, keys, docs = (c[found.firsts[entries]] for c in (found.at, found.n, found.keys, found.docs))
        buffer, whole = pack.buffer, np.flatnonzero(parts == 1)
        rows = [whole, np.zeros(len(whole), np.int64), np.zeros(len(whole), np.int64), [buffer[a:b] for a, b in zip(at[whole].tolist(), (at + n + LENGTH - 1)[whole].tolist())]]
        split = np.flatnonzero(parts > 1)
        each = np.repeat(split, n[split])
        first = np.arange(len(each)) - np.repeat(np.cumsum(n[split]) - n[split], n[split])
        strings = [buffer[a : a + LENGTH] for a in (at[each] + first).tolist()]
        digest = xxhash.xxh32_intdigest
        part = np.fromiter((digest(s) for s in strings), np.int64, len(strings)) % np.maximum(parts[each], 1)
        row, part, first = (np.concatenate(c) for c in ((rows[0], each), (rows[1], part), (rows[2], first)))
        return pa.RecordBatch.from_arrays(
            [pa.array(keys[row].astype(np.int64)), pa.array(part.astype(np.int32)), pa.array(np.full(len(row), number, np.int64)), pa.array(entries[row].astype(np.int32)),
             pa.array(docs[row]), pa.array(first.astype(np.int32)), pa.array(rows[3] + strings, pa.binary())],
            ["key", "part", "pack", "entry", "doc", "first", "bytes"])

    # All rows of a pack are needed, as entries are counted over its shards.
    news = decided.select("pack", F.struct("shard", "shared", "open", "parts").alias("news"))
    return _with_packs(packs, news).mapInArrow(_per_pack(step), "key long, part int, pack long, entry int, doc long, first int, bytes binary")


def covered_windows(strings: DataFrame) -> DataFrame:
    """pack, entry and mask: bit i is set where window i of the phrase equals a string of a phrase that a smaller document has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_shards(batches, 16_384):
            texts = rows.column(6).to_pylist()
            lengths = np.fromiter(map(len, texts), np.int64, len(texts))
            sizes = lengths - LENGTH + 1
            starts = np.cumsum(sizes) - sizes
            inside = np.arange(sizes.sum()) - np.repeat(starts, sizes)
            place = np.repeat(np.cumsum(lengths) - lengths, sizes) + inside
            windows = np.lib.stride_tricks.sliding_window_view(np.frombuffer(b"".join(texts), np.uint8), LENGTH)[place]
            covered = suffix_groups(windows.view(f"S{LENGTH}").reshape(-1), np.repeat(rows.column(4).to_numpy(), sizes))
            bit = inside + np.repeat(rows.column(5).to_numpy(), sizes)
            masks = np.add.reduceat(np.where(covered, np.int64(1) << bit, 0), starts)
            yield pa.RecordBatch.from_arrays([rows.column(2), rows.column(3), pa.array(masks)], ["pack", "entry", "mask"]).filter(pa.array(masks != 0))

    ordered = strings.repartition("key", "part").sortWithinPartitions("key", "part")
    return ordered.mapInArrow(run, "pack long, entry int, mask long").groupBy("pack", "entry").agg(F.bit_or("mask").alias("mask"))


def removed_spans(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """(start, end) of the maximal runs covered by windows whose first and last starts are given, in order."""
    if not len(starts):
        return np.zeros((0, 2), np.int64)
    reach = ends + LENGTH
    new = np.concatenate(([True], starts[1:] > np.maximum.accumulate(reach)[:-1]))
    firsts = np.flatnonzero(new)
    return np.stack([starts[firsts], np.maximum.reduceat(reach, firsts)], axis=1)


def _covered(pack: Pack, news: pa.Array | None, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last start of runs of windows that a smaller document has as well."""
    if news is None:
        return (np.zeros(0, np.int64),) * 2
    found = pack.phrases(shards).distinct(_shared(news))
    answers = dict(zip(news.field("shard").to_pylist(), news.field("whole").to_pylist()))
    whole, mask = np.zeros(len(found.firsts), dtype=bool), np.zeros(len(found.firsts), np.int64)
    for shard, entries in found.by_shard(found.firsts):
        whole[entries] = _from_bits(answers[shard], entries.stop - entries.start)
    marked = news.filter(news.field("mask").is_valid())
    mask[marked.field("entry").to_numpy(zero_copy_only=False)] = marked.field("mask").to_numpy(zero_copy_only=False)
    of = np.repeat(np.arange(len(found.firsts)), np.diff(np.append(found.firsts, len(found.at))))
    # A document after the smallest that has the phrase loses all of it, the smallest what other phrases have.
    runs = whole[of] | (found.docs > found.docs[found.firsts][of])
    at, mask = found.at[~runs], mask[of][~runs]
    some = np.flatnonzero(mask)
    row, bit = np.nonzero((mask[some][:, None] >> np.arange(_BITS)) & 1)
    single = at[some[row]] + bit
    return np.concatenate([found.at[runs], single]), np.concatenate([(found.at + found.n - 1)[runs], single])


def _kept(pack: Pack, news: pa.Array | None, shards: int) -> list[tuple]:
    """(doc_id, bytes, removed, spans, kept bytes) of each document."""
    starts, ends = _covered(pack, news, shards)
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], ends[order]
    doc = np.searchsorted(pack.ends, starts, side="right")
    bounds = np.searchsorted(doc, np.arange(len(pack.ends) + 1))
    out, begin = [], 0
    for i, (doc_id, end) in enumerate(zip(pack.doc_ids, pack.ends.tolist())):
        own = slice(bounds[i], bounds[i + 1])
        spans = removed_spans(starts[own], ends[own]).tolist()
        kept, at = [], begin
        for a, b in spans:
            kept.append(pack.buffer[at:a])
            at = b
        kept.append(pack.buffer[at:end])
        out.append((doc_id, end - begin, sum(b - a for a, b in spans), len(spans), b"".join(kept)))
        begin = end
    return out


def _per_document(documents: DataFrame, step: Callable[[list[tuple]], pa.RecordBatch], schema: str) -> DataFrame:
    """``step`` of what ``_kept`` says of the documents of each pack."""
    with shuffles_dropped(documents.sparkSession):
        packs = pack_texts(documents)
        shards = max(8, packs.count() // PACKS_PER_SHARD)
        shared = saved(shared_keys(packs, shards), "triggers")
        decided = saved(decided_phrases(packs, shared, shards), "dictionary")
        masks = saved(covered_windows(phrase_strings(packs, decided, shards)), "windows")
    news = decided.select("pack", "shard", "shared", "whole").unionByName(masks, allowMissingColumns=True)
    joined = _with_packs(packs, news.select("pack", F.struct("shard", "shared", "whole", "entry", "mask").alias("news")), "left")
    return joined.mapInArrow(_per_pack(lambda number, pack, news: step(_kept(pack, news, shards))), schema)


def remove_repeats(documents: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of each text as UTF-8 bytes, null as empty.

    Every byte covered by a string of LENGTH bytes that also starts in a document with a smaller doc_id is removed; strings are
    looked up in the texts as they came. Rows that share a doc_id do not remove anything from one another; a null doc_id is
    larger than all others.
    """
    def step(found: list[tuple]) -> pa.RecordBatch:
        rows = [(doc_id, size, removed, spans, hashlib.sha256(kept).hexdigest()) for doc_id, size, removed, spans, kept in found]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return _per_document(documents, step, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def kept_texts(documents: DataFrame) -> DataFrame:
    """doc_id and text of what ``remove_repeats`` keeps; bytes that are no whole character any more become U+FFFD."""
    def step(found: list[tuple]) -> pa.RecordBatch:
        rows = [(row[0], row[4].decode("utf-8", "replace")) for row in found]
        return pa.RecordBatch.from_arrays([pa.array([d for d, _ in rows], pa.int64()), pa.array([t for _, t in rows], pa.string())], ["doc_id", "text"])

    return _per_document(documents, step, "doc_id long, text string")
