"""Token ids in a byte-aligned variable-length format, ranked by frequency, decoded by table lookup.

A shard holds a range of documents in order, and a block is one document: ``control`` has four 2-bit lengths a byte,
``data`` has the ranks' bytes, 1 to 4 for each, least significant first. Ranks follow from frequency in the corpus, so that the 256 commonest ids take one
byte. ``vocabulary.parquet`` gives the id of each rank. Blocks are rows of a Parquet table, so that Spark's writers
commit them on any store, and a lost executor only costs the repetition of its tasks.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from logloom.llm.common import pieces
from logloom.plans.scratch import new_folder, remove_folder, saved

# Bytes of texts that are encoded together, words that the library gets in one call, and the most bytes of each.
BATCH_BYTES, AT_ONCE, JOINED = 8 << 20, 1 << 14, 64
# Words that a worker remembers from batch to batch, and the most bytes of each.
KNOWN, SHORT = 1 << 19, 32
# Bytes of ids in a shard, where more shards than shuffle partitions are needed for it.
SHARD_BYTES = 128 << 20

# What a byte of a text can be, as bits: a tab, newline or blank; the first byte of a character that is no blank in any table of Unicode
# (some that are none are left out); an ASCII letter or digit; other printable ASCII.
BLANK, SOLID, ALNUM, MARK = 1, 2, 4, 8
RANGES = {
    BLANK: [(0x09, 0x0A), (0x20, 0x20)],
    SOLID: [(0x21, 0x7E), (0xC3, 0xE0), (0xE4, 0xEE), (0xF0, 0xF4)],
    ALNUM: [(0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A)],
    MARK: [(0x21, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E)],
}
KINDS = bytes(sum(kind for kind, ranges in RANGES.items() if any(first <= b <= last for first, last in ranges)) for b in range(256))

LENGTHS = np.array([[(c >> (2 * k)) % 4 + 1 for k in range(4)] for c in range(256)], dtype=np.uint8)


def _padded(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Control bytes of each block, and the place of each of its ranks among the lengths of all control bytes."""
    controls = -(-n // 4)
    shift = 4 * (np.cumsum(controls) - controls) - (np.cumsum(n) - n)
    return controls, np.arange(n.sum()) + np.repeat(shift, n)


def encode_blocks(ranks: np.ndarray, n: np.ndarray) -> tuple[bytes, np.ndarray, bytes, np.ndarray]:
    """Blocks of ``n`` ranks each, one behind the other: control bytes, their number by block, data, its bytes by block."""
    ranks, n = np.ascontiguousarray(ranks, dtype="<u4"), n.astype(np.int64)
    length = 1 + (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    data = ranks.view(np.uint8).reshape(-1, 4)[np.arange(4, dtype=np.uint8) < length[:, None]]
    controls, places = _padded(n)
    codes = np.zeros(4 * controls.sum(), dtype=np.uint8)
    codes[places] = length - 1
    codes = codes.reshape(-1, 4)
    control = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    ends = np.concatenate([[0], np.cumsum(length, dtype=np.int64)])[np.concatenate([[0], np.cumsum(n)])]
    return control.astype(np.uint8).tobytes(), controls, data.tobytes(), np.diff(ends)


def decode_blocks(control: bytes, data: bytes, n: np.ndarray) -> np.ndarray:
    """The ranks of all blocks: lengths by table lookup from the control bytes, then one gather for each byte place."""
    controls, places = _padded(n.astype(np.int64))
    if controls.sum() != len(control):
        raise ValueError("control and number of ranks of a block do not agree")
    length = LENGTHS[np.frombuffer(control, dtype=np.uint8)].reshape(-1)[places].astype(np.int64)
    ends = np.cumsum(length)
    if (ends[-1] if len(ends) else 0) != len(data):
        raise ValueError("control and data of a block do not agree")
    starts = ends - length
    source = np.frombuffer(data + b"\0\0\0", dtype=np.uint8)
    out = source[starts].astype(np.uint32)
    for place in (1, 2, 3):
        more = np.flatnonzero(length > place)
        out[more] |= source[starts[more] + place].astype(np.uint32) << np.uint32(8 * place)
    return out


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """(control, data) of one block."""
    control, _, data, _ = encode_blocks(ranks, np.array([len(ranks)]))
    return control, data


def decode_ranks(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` ranks of one block."""
    return decode_blocks(control, data, np.array([n]))


def _binaries(data: bytes | np.ndarray, sizes: np.ndarray) -> pa.Array:
    """An Arrow column of byte strings of the given sizes, one behind the other."""
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data)])


def _parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where each byte string of a column starts, with the end of the last, and the bytes of all."""
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int32, len(column) + 1, 4 * column.offset) if len(column) else np.zeros(1, np.int32)
    return offsets - offsets[0], np.frombuffer(data or b"", np.uint8)[offsets[0] : offsets[-1]]


def _kinds(data: np.ndarray) -> np.ndarray:
    """What each byte is, by the bits of KINDS."""
    return np.frombuffer(bytearray(data).translate(KINDS), np.uint8)


class Encoder:
    """Ids of texts by the tokenizers library; a word is encoded once for all texts of a batch, and remembered for the next ones.

    The byte-level tokenizer cuts a text by its pattern and its model encodes each piece by itself, so that a piece has
    the same ids in every text. The pattern always cuts before the last blank of a run that something follows, and between a
    letter or digit and a mark; texts are cut into words there. A text that holds an added token's string goes to the library whole.

    Texts, words and ids are Arrow columns. Words are remembered in two of them, at most KNOWN words of SHORT bytes.
    """

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.packed = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self.added = [str(token.content) for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.cut = regex.compile(public_tokenizers.PATTERN).findall
        letters = byte_letters()
        plain = re.compile(" ?[!-~]+").fullmatch  # stands for itself, but for the blank
        self.as_letters = lambda piece: piece.replace(" ", letters[32]) if plain(piece) else piece.encode().decode("latin-1").translate(letters)
        vocabulary, blanks = self.tokenizer.get_vocab(), [letters[b] for b in range(256) if KINDS[b] & BLANK]
        self.begins = np.zeros(max(vocabulary.values()) + 1, bool)  # ids whose bytes start with a blank
        self.begins[[i for token, i in vocabulary.items() if token[0] in blanks]] = True
        self.words = self.ids = pa.array([], pa.binary())
        self.uses = np.zeros(0, np.int64)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The packed ids of all texts, one behind the other, and the number of ids of each; null has none."""
        texts = pc.fill_null(texts, "").cast(pa.binary())
        offsets, data = _parts(texts)
        starts = self.word_starts(texts, offsets, data)
        words = _binaries(data, np.diff(starts, append=len(data)))
        words = pa.concat_arrays([self.words, words]).dictionary_encode()  # the known ones first, so that they keep their places
        all_words, places = words.dictionary, words.indices.slice(len(self.words))
        all_ids = pa.concat_arrays([self.ids, self.of_words(all_words.slice(len(self.ids)))])
        ends, ids = _parts(all_ids.take(places))
        self.remember(all_words, all_ids, places)
        return ids.view(self.packed), np.diff(ends[np.searchsorted(starts, offsets)]) // np.dtype(self.packed).itemsize

    def word_starts(self, texts: pa.Array, offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
        """Where texts begin, and where they may be cut. No text is cut before its last character if that is a blank."""
        kinds = _kinds(data)
        begins = offsets[:-1][np.diff(offsets) > 0]
        kinds[begins] &= ~np.uint8(SOLID)
        starts = np.zeros(len(data), bool)
        starts[:-1] = kinds[:-1] & kinds[1:] >> 1 & 1
        starts[1:] |= (kinds[1:] >> 3 & kinds[:-1] >> 2 & 1).view(bool)
        for i in np.flatnonzero(self.holds_added(texts)):
            starts[offsets[i] : offsets[i + 1]] = False
        starts[begins] = True
        return np.flatnonzero(starts)

    def remember(self, words: pa.Array, ids: pa.Array, places: pa.Array) -> None:
        """Keep the ids of short words for the next batches; when these are too many, of the half of them that were met most."""
        uses = np.bincount(places.to_numpy(), minlength=len(words))
        uses[: len(self.uses)] += self.uses
        kept = np.diff(_parts(words)[0]) <= SHORT
        if kept.sum() > KNOWN:
            kept[np.argsort(np.where(kept, -uses, 1), kind="stable")[KNOWN // 2 :]] = False
        self.uses = uses[kept]
        self.words, self.ids = (column.filter(pa.array(kept)) for column in (words, ids))

    def holds_added(self, texts: pa.Array) -> np.ndarray:
        """Whether a text holds an added token's string."""
        held = np.zeros(len(texts), bool)
        for token in self.added:
            held |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        return held

    def of_words(self, words: pa.Array) -> pa.Array:
        """The packed ids of each word. Short ones with one blank, which they start with, go to the library one behind the other."""
        offsets, data = _parts(words)
        starts, sizes, kinds = offsets[:-1], np.diff(offsets), _kinds(data)
        blanks = np.concatenate([[0], np.cumsum(kinds & BLANK, dtype=np.int64)])
        added = self.holds_added(words)
        joined = (sizes > 1) & (sizes <= JOINED) & (blanks[offsets[1:]] - blanks[starts] == 1) & (kinds[starts] & BLANK).view(bool) & ~added
        joined[joined] = kinds[starts[joined] + 1] & SOLID
        of_joined = self.of_joined(words.filter(pa.array(joined)))
        known: dict[str, bytes] = {}
        others = []
        for word, whole in zip(words.filter(pa.array(~joined)).cast(pa.string()).to_pylist(), added[~joined]):
            others.append(self._pack(self.tokenizer.encode(word, add_special_tokens=False).ids) if whole else self.of_pieces(word, known))
        places = np.empty(len(words), np.int64)
        places[joined], places[~joined] = np.arange(joined.sum()), np.arange(len(others)) + joined.sum()
        return pa.concat_arrays([of_joined, pa.array(others, pa.binary())]).take(pa.array(places))

    def of_joined(self, words: pa.Array) -> pa.Array:
        """The packed ids of words that start with their only blank: where an id's bytes start with a blank, a word begins."""
        found, sizes = [], []
        for k in range(0, len(words), AT_ONCE):
            offsets, data = _parts(words.slice(k, AT_ONCE))
            ids = np.array(self.tokenizer.encode_batch_fast([data.tobytes().decode()], add_special_tokens=False)[0].ids, np.uint32)
            starts = np.flatnonzero(self.begins[ids])
            if len(starts) != len(offsets) - 1:
                raise ValueError("words and their ids do not agree")
            found.append(ids.astype(self.packed).tobytes())
            sizes.append(np.diff(np.append(starts, len(ids))) * np.dtype(self.packed).itemsize)
        return _binaries(b"".join(found), np.concatenate([np.zeros(0, np.int64), *sizes]))

    def of_pieces(self, text: str, known: dict[str, bytes]) -> bytes:
        """The packed ids of a text that is cut by the pattern here; those of its pieces are kept in ``known``."""
        pieces, tokenize = self.cut(text), self.tokenizer.model.tokenize
        for piece in pieces:
            if piece not in known:
                known[piece] = self._pack([token.id for token in tokenize(self.as_letters(piece))])
        return b"".join(map(known.__getitem__, pieces))

    def _pack(self, ids: list[int]) -> bytes:
        return array("H" if self.packed == "<u2" else "I", ids).tobytes()


@lru_cache(1)
def shared_encoder(path: str) -> Encoder:
    """The encoder of a worker process, with what it remembers."""
    return Encoder(path)


def byte_letters() -> dict[int, str]:
    """The printable letter for each byte in the byte-level vocabulary: itself if printable, else from U+0100 on, in order."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}


def tokenize(documents: DataFrame, path: str, end_id: int) -> DataFrame:
    """doc_id, n, crc (of the ids as little-endian unsigned 32-bit integers) and ids (packed) of each document with the end id.

    Null text has the end id only. Packed ids take two bytes where the tokenizer's vocabulary allows it, else four.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = shared_encoder(path)
        for batch in pieces(batches, 1, BATCH_BYTES):
            ids, n = coder.encode(batch.column(1))
            ids, n = np.insert(ids, np.cumsum(n), end_id), n + 1
            ends, bytes_of = np.cumsum(4 * n), memoryview(ids.astype("<u4")).cast("B")
            crcs = [zlib.crc32(bytes_of[end - size : end]) for end, size in zip(ends.tolist(), (4 * n).tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(crcs, pa.int64()), _binaries(ids, n * ids.itemsize)], ["doc_id", "n", "crc", "ids"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n long, crc long, ids binary")


def id_counts(tokens: DataFrame, packed: str) -> DataFrame:
    """id and its number of occurrences, counted per task before they are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(0, np.int64)
        for batch in pieces(batches, 0):
            more = np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), packed), minlength=len(counts))
            more[: len(counts)] += counts
            counts = more
        ids = np.flatnonzero(counts)
        if len(ids):
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(counts[ids])], ["id", "n"])

    return tokens.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write_tokens(documents: DataFrame, folder: str, path: str | None = None, end_id: int = 2, shards: int | None = None) -> None:
    """Write the whole corpus to ``folder`` in ascending doc_id order (nulls first): blocks, and the ids by rank.

    Ids are made once, kept in a working table, counted, and then written as ranks. The vocabulary, of which the
    tokenizer bounds the size, is the only thing that every task gets. Rows that repeat a doc_id follow one another in
    order of their ids' checksum.
    """
    spark = documents.sparkSession
    path = path or public_tokenizers.path("byte_bpe_50k.json")
    packed = Encoder(path).packed
    work = new_folder(spark, "token-ids")
    tokenize(documents, path, end_id).write.option("compression", "zstd").parquet(work)
    tokens = spark.read.parquet(work)
    by_rank = id_counts(tokens, packed).orderBy(F.desc("n"), "id").toPandas()["id"].to_numpy(np.uint32)
    rank_of = np.zeros(int(by_rank.max()) + 1 if len(by_rank) else 1, np.uint32)
    rank_of[by_rank] = np.arange(len(by_rank), dtype=np.uint32)
    spark.createDataFrame([(by_rank.astype("<u4").tobytes(),)], "ids binary").write.parquet(f"{folder}/vocabulary.parquet")
    held = spark.sparkContext.broadcast(rank_of)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 3):
            ids = np.frombuffer(b"".join(batch.column(3).to_pylist()), packed)
            control, controls, data, sizes = encode_blocks(held.value[ids], batch.column(1).to_numpy())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], _binaries(control, controls), _binaries(data, sizes)], ["doc_id", "n", "control", "data"])

    # Put in order before the ids are coded, as the sampling of the order's limits runs all that stands before it.
    n_ids = tokens.agg(F.sum("n")).first()[0] or 0
    shards = shards or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_ids * np.dtype(packed).itemsize // SHARD_BYTES))
    ordered = tokens.select("doc_id", "n", "crc", "ids").repartitionByRange(shards, "doc_id").sortWithinPartitions("doc_id", "crc")
    coded = ordered.mapInArrow(encode, "doc_id long, n long, control binary, data binary")
    coded = coded.withColumn("shard", F.spark_partition_id()).withColumn("seq", F.monotonically_increasing_id())
    coded.write.option("compression", "zstd").parquet(f"{folder}/blocks.parquet")
    remove_folder(spark, work)


def read_vocabulary(spark: SparkSession, folder: str) -> np.ndarray:
    """Id of each rank; as many as the tokenizer knows at most."""
    return np.frombuffer(spark.read.parquet(f"{folder}/vocabulary.parquet").first()["ids"], "<u4")


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, shard, seq (ascending through the corpus, as is shard), ids (unsigned 32-bit little-endian), decoded from the files."""
    held = spark.sparkContext.broadcast(read_vocabulary(spark, folder))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 5):
            n = batch.column(3).to_numpy()
            control, data = (b"".join(batch.column(k).to_pylist()) for k in (4, 5))
            ids = held.value[decode_blocks(control, data, n)].astype("<u4")
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], _binaries(ids.tobytes(), 4 * n)], ["doc_id", "shard", "seq", "ids"])

    blocks = spark.read.parquet(f"{folder}/blocks.parquet").select("doc_id", "shard", "seq", "n", "control", "data")
    return blocks.mapInArrow(decode, "doc_id long, shard int, seq long, ids binary")


def token_index(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32, read back from the files.

    The running sum goes within each shard and over the shards' sums, so that no task sees the whole corpus.
    """
    found = read_tokens(spark, folder).select(
        "doc_id", "shard", "seq", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
    found = saved(found, "token-index")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = found.groupBy("shard").agg(F.sum("n_tokens").alias("_n")).select("shard", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shard_start"))
    inside = Window.partitionBy("shard").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    placed = found.withColumn("_before", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(shards, "shard")
    return placed.select("doc_id", (F.col("_shard_start") + F.col("_before")).alias("start"), "n_tokens", "ids_crc32")
