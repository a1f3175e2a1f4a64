"""Collocations per language, from exact n-gram counts in counting quotient filters.

Documents are cut into packs: ids of words in order, and the words that a pack has. Words get global numbers; a pack learns
only the numbers of its own words. Each pack counts its n-grams in a filter (:mod:`logloom.llm.cqf`), cut into parts by the top bits of the
permuted keys, and the filters of a part are merged, in rounds where there are many packs. Everything after that is joins over the
phrases that are left.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from logloom.llm import cqf
from logloom.llm.common import pieces as slices
from logloom.plans.scratch import saved

# Characters that end a piece, and those between words.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
MOST_WORDS = 3
# Bytes of text in a pack, and in all packs a task has begun.
PACK_BYTES, HELD_BYTES = 16 << 20, 24 << 20
# Long texts are cut into words in steps of so many bytes.
STEP_BYTES = 1 << 20
# About so many n-grams meet in a task that merges filters, from at most 2 to the power of ROUND_BITS shards.
PART_ENTRIES, ROUND_BITS = 1 << 21, 8
SALTS = 64

PACKS = "pack long, lang string, n long, words array<string>, counts array<long>, stream binary"
FILTERS = "n int, shard long, part long, filter binary"
PHRASES = "n int, w1 long, w2 long, w3 long, f long"

_SEPARATOR = re.compile(rb"[ \t" + re.escape(PIECE_ENDS) + rb"]")
_TABLE = bytes.maketrans(PIECE_ENDS + b"\t", b"\n" * len(PIECE_ENDS) + b" ")


class _Numbers(dict):
    """Numbers of words from 1 on, in order of their first use; 0 stands for the end of a piece, -1 for no word."""

    def __init__(self):
        super().__init__({b"\n": 0, b"": -1})

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self) - 1
        return number


class _Pack:
    def __init__(self):
        self.numbers, self.streams, self.held = _Numbers(), [], 0

    def add(self, text: bytes) -> None:
        start = 0
        while start <= len(text):
            cut = _SEPARATOR.search(text, start + STEP_BYTES)
            end = cut.start() if cut else len(text)
            tokens = text[start:end].lower().translate(_TABLE).replace(b"\n", b" \n ").split(b" ")
            if not cut:
                tokens.append(b"\n")
            numbers = np.fromiter(map(self.numbers.__getitem__, tokens), np.int32, len(tokens))
            self.streams.append(numbers[numbers >= 0])
            start = end if cut else len(text) + 1
        self.held += len(text)

    def row(self, pack: int, lang: str) -> tuple:
        stream = np.concatenate(self.streams)
        words = list(self.numbers)[2:]
        counts = np.bincount(stream, minlength=len(words) + 1)[1:]
        return pack, lang, int(counts.sum()), words, counts, stream.tobytes()


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task, n_packs, packs = TaskContext.get().partitionId(), 0, {}

    def out(lang: str) -> pa.RecordBatch:
        nonlocal n_packs
        n_packs += 1
        pack, lang, n, words, counts, stream = packs.pop(lang).row((task << 32) + n_packs, lang)
        ends = pa.array([0, len(words)], pa.int32())
        return pa.RecordBatch.from_arrays(
            [pa.array([pack], pa.int64()), pa.array([lang], pa.string()), pa.array([n], pa.int64()),
             pa.ListArray.from_arrays(ends, pa.array(words, pa.binary()).view(pa.string())),
             pa.ListArray.from_arrays(ends, pa.array(counts, pa.int64())), pa.array([stream], pa.binary())],
            ["pack", "lang", "n", "words", "counts", "stream"])

    for batch in slices(batches, 1):
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
            pack = packs.setdefault(lang, _Pack())
            pack.add(text or b"")
            if pack.held >= PACK_BYTES:
                yield out(lang)
            while sum(p.held for p in packs.values()) >= HELD_BYTES:
                yield out(max(packs, key=lambda name: packs[name].held))
    for lang in list(packs):
        yield out(lang)


def pack_words(documents: DataFrame) -> DataFrame:
    """Packs of the documents (text, lang): their words with counts, and the stream of word numbers in the pack (0 ends a piece).

    A-Z counts as a-z, a null language as ``und``, a null text as empty.
    """
    return documents.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").mapInArrow(_packed, PACKS)


def number_words(packs: DataFrame, least: int) -> DataFrame:
    """Words of each language with ``least`` or more occurrences: lang, word, f, id (1, 2, ... over all languages, without gaps).

    A phrase has no more occurrences than any of its words, so rarer words are in no phrase that counts.
    """
    each = packs.select("lang", F.inline(F.arrays_zip(F.col("words").alias("word"), F.col("counts").alias("count"))))
    frequent = each.groupBy("lang", "word").agg(F.sum("count").alias("f")).where(F.col("f") >= least)
    placed = saved(frequent.withColumn("at", F.monotonically_increasing_id()), "words")
    task, row = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    sizes = placed.groupBy(task.alias("task")).agg(F.count(F.lit(1)).alias("size"))
    # One row per task of the job above.
    before = sizes.select("task", (F.sum("size").over(Window.orderBy("task")) - F.col("size")).alias("before"))
    return placed.withColumn("task", task).join(before, "task").select("lang", "word", "f", (F.col("before") + row + 1).alias("id"))


def _filters(id_bits: int, part_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                stream = np.frombuffer(batch.column(1)[i].as_py(), np.int32)
                known = batch.column(2)[i].values
                local, ids = (known.field(name).to_numpy(zero_copy_only=False) for name in ("local", "id"))
                numbers = np.zeros(int(stream.max(initial=0)) + 1, np.int64)
                numbers[local] = ids
                stream = numbers[stream]
                for n in range(2, MOST_WORDS + 1):
                    yield from _cut(n, batch.column(0)[i].as_py(), n * id_bits, part_bits, *_counted(stream, n, id_bits)).to_batches()

    return run


def _counted(stream: np.ndarray, n: int, id_bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Permuted keys of a stream's n-grams, in order, with their counts."""
    places = [stream[i : len(stream) - n + 1 + i] for i in range(n)] if len(stream) >= n else [stream[:0]] * n
    whole = np.logical_and.reduce([place > 0 for place in places])
    return cqf.summed(*cqf.permute(*cqf.pack([place[whole] for place in places], id_bits), n * id_bits))


def _cut(n: int, shard: int, bits: int, part_bits: int, high: np.ndarray, low: np.ndarray, counts: np.ndarray) -> pa.Table:
    """Filters of the keys of each part."""
    used = min(part_bits, bits)
    parts = cqf.top_bits(high, low, bits, used).astype(np.int64) if used else np.zeros(len(low), np.int64)
    names, starts = np.unique(parts, return_index=True)
    ends = np.append(starts[1:], len(parts))
    data = [cqf.encode(high[a:b], low[a:b], counts[a:b], bits, int(part), used) for part, a, b in zip(names, starts, ends)]
    return pa.table([pa.array([n] * len(names), pa.int32()), pa.array([shard] * len(names), pa.int64()), pa.array(names, pa.int64()), pa.array(data, pa.binary())],
                    ["n", "shard", "part", "filter"])


def _merged(id_bits: int, part_bits: int):
    """Merge the filters of a part and cut the result into the parts of the next round."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        n, shard = key[0].as_py(), key[1].as_py()
        return _cut(n, shard, n * id_bits, part_bits, *cqf.merge(table.column("filter").to_pylist()))

    return run


def _frequent(id_bits: int, least: int):
    """Merge the filters of a part and give back the ids of its frequent keys."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        n = key[0].as_py()
        high, low, counts = cqf.merge(table.column("filter").to_pylist())
        often = counts >= least
        ids = cqf.unpack(*cqf.restore(high[often], low[often], n * id_bits), n, id_bits)
        ids += [np.zeros(len(ids[0]), np.int64)] * (MOST_WORDS - n)
        found = counts[often].astype(np.int64)
        return pa.table([pa.array([n] * len(found), pa.int32()), *map(pa.array, ids), pa.array(found)], ["n", "w1", "w2", "w3", "f"])

    return run


def merge_rounds(part_bits: int, round_bits: int = ROUND_BITS) -> list[int]:
    """Top bits that name a part in each round of merging, at most ``round_bits`` more than in the round before."""
    rounds = max(1, -(-part_bits // round_bits))
    return [-(-part_bits * (i + 1) // rounds) for i in range(rounds)]


def count_phrases(packs: DataFrame, words: DataFrame, least: int, part_entries: int = PART_ENTRIES, round_bits: int = ROUND_BITS) -> DataFrame:
    """Phrases of 2 and 3 numbered words with ``least`` or more occurrences: n, w1, w2, w3 (0 where there is none), f.

    The number of parts follows from the number of words, so that what meets in a task stays bounded. A pack has at most one entry for an
    n-gram, however frequent it is, and the permutation spreads n-grams evenly over parts. One round of merging would
    deal (packs x parts) slices; with many parts the packs are first merged in shards, by few top bits, and cut further in each round.
    """
    n_ids, n_words = words.agg(F.max("id")).scalar(), packs.agg(F.sum("n")).scalar()
    sizes = packs.sparkSession.range(1).select(F.coalesce(n_ids, F.lit(0)).alias("ids"), F.coalesce(n_words, F.lit(0)).alias("words")).first()
    id_bits = max(1, int(sizes["ids"]).bit_length())
    part_bits = min(30, (int(sizes["words"]) // part_entries).bit_length())
    local = packs.select("pack", "lang", F.posexplode("words").alias("at", "word"))
    known = local.join(words, ["lang", "word"]).groupBy("pack").agg(F.collect_list(F.struct((F.col("at") + 1).alias("local"), "id")).alias("known"))
    shard = F.pmod(F.xxhash64("pack"), F.lit(1 << part_bits)).alias("shard")
    numbered = packs.select("pack", "stream").join(known, "pack").select(shard, "stream", "known")
    used, *more = merge_rounds(part_bits, round_bits)
    filters = numbered.mapInArrow(_filters(id_bits, used), FILTERS)
    for bits in more:
        filters = filters.withColumn("shard", F.pmod("shard", F.lit(1 << (part_bits - used))))
        filters = saved(filters.groupBy("n", "shard", "part").applyInArrow(_merged(id_bits, bits), FILTERS), "filters")
        used = bits
    return filters.groupBy("n", "part").applyInArrow(_frequent(id_bits, least), PHRASES)


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)), exact: products are decimals of up to 38 digits."""
    a, left, right = (x.cast("decimal(15,0)") for x in (a, left, right))
    return F.call_function("div", F.lit(1000000).cast("decimal(7,0)") * (a * a), left * right)


def score_phrases(phrases: DataFrame, words: DataFrame, share: int) -> DataFrame:
    """Scores of phrases: lang, phrase, a, l, r, score, of those that no longer one covers to ``share`` percent."""

    def word(i: int, count: bool = False) -> DataFrame:
        kept = [F.col("id").alias(f"w{i}"), F.col("word").alias(f"word{i}")]
        return words.select(*kept, *([F.col("f").alias(f"f{i}")] if count else []))

    two = phrases.where("n = 2").select("w1", "w2", F.col("f").alias("a"))
    three = phrases.where("n = 3").select("w1", "w2", "w3", F.col("f").alias("a"))
    longer = three.select("w1", "w2", "a").unionByName(three.select(F.col("w2").alias("w1"), F.col("w3").alias("w2"), "a"))
    covers = longer.groupBy("w1", "w2").agg(F.max("a").alias("covered"))
    short = two.join(covers, ["w1", "w2"], "left").where(F.col("covered").isNull() | (100 * F.col("covered") < share * F.col("a")))
    first = words.select("lang", F.col("id").alias("w1"), F.col("word").alias("word1"), F.col("f").alias("f1"))
    short = short.join(first, "w1").join(word(2, True), "w2")
    short = short.select("lang", F.concat_ws(" ", "word1", "word2").alias("phrase"), "a", F.col("f1").alias("l"), F.col("f2").alias("r"),
                         _score(F.col("a"), F.col("f1"), F.col("f2")).alias("score"))
    heads = two.select("w1", "w2", F.col("a").alias("f12"))
    tails = two.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("f23"))
    long = three.join(heads, ["w1", "w2"]).join(tails, ["w2", "w3"]).join(first, "w1").join(word(2), "w2").join(word(3, True), "w3")
    cut = lambda k, left, right: F.struct(_score(F.col("a"), F.col(left), F.col(right)).alias("score"), F.lit(k).alias("k"), F.col(left).alias("l"), F.col(right).alias("r"))
    long = long.withColumn("cut", F.least(cut(1, "f1", "f23"), cut(2, "f12", "f3")))
    long = long.select("lang", F.concat_ws(" ", "word1", "word2", "word3").alias("phrase"), "a", "cut.l", "cut.r", "cut.score")
    return short.unionByName(long)


def top_phrases(scored: DataFrame, top: int) -> DataFrame:
    """The first ``top`` phrases of each language, with their rank.

    A language is first cut into groups by hash, each of which gives its first ones, so that no task sorts a whole language.
    """
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    salted = scored.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    few = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top)
    return few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top).drop("salt")


def mine_collocations(documents: DataFrame, least: int = 10, share: int = 50, top: int = 2000) -> DataFrame:
    """The strongest collocations of 2 and 3 words of each language (text, lang): lang, rank, phrase, a, l, r, n, score.

    Candidates have at least ``least`` occurrences (a); those that a longer candidate covers to ``share`` percent go. The score is
    floor(10^6 a^2 / (l r)) at the cut into two parts where it is lowest, the first of equal cuts; l and r count the parts, n all
    words of the language. Rank is by score, then a, then the phrase's bytes. Null texts have no words, a null language is ``und``,
    rows that are repeated count each time, texts of any length are read whole, and without words there are no rows.
    """
    packs = saved(pack_words(documents), "packs")
    words = saved(number_words(packs, least), "numbers")
    phrases = saved(count_phrases(packs, words, least), "phrases")
    sizes = packs.groupBy("lang").agg(F.sum("n").alias("n")).withColumnRenamed("lang", "_lang")
    best = top_phrases(score_phrases(phrases, words, share), top)
    return best.join(sizes, F.col("lang") == F.col("_lang")).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
