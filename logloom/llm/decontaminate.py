"""Benchmark decontamination with a generalised suffix automaton of the test items."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm.common import columns_of, lower_ascii, pieces
from logloom.plans.scratch import saved

MAX_ITEM_WORDS = 1_000_000

# Words are runs of ASCII digits and letters and of all bytes over 0x7F; A-Z count as a-z.
_WORD_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_WORD_BYTES).split()


class SuffixAutomaton:
    """All runs of words of a set of items, with the items that hold each run.

    The words of an item are added one by one, and an item starts at the root again. A state stands for the runs that end at the same
    places; ``length`` is its longest one, ``link`` the state of its longest suffix that ends in more places.
    """

    def __init__(self, items: dict, window: int):
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.items = [-1], [0], [set()]
        self.short: dict[tuple, set] = {}
        for item, words in items.items():
            last = 0
            run = [self.ids.setdefault(word, len(self.ids)) for word in words]
            for word in run:
                last = self._add(last, word)
                self.items[last].add(item)
            if 0 < len(run) < window:
                self.short.setdefault(tuple(run), set()).add(item)
        for state in sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True):
            if self.length[self.link[state]] >= window:  # shorter runs are never asked for
                self.items[self.link[state]] |= self.items[state]
        self.short_lengths = sorted({len(run) for run in self.short})
        self.least = min([window, *self.short_lengths])
        runs = [[self.ids[word] for word in words] for words in items.values()]
        pairs = {(a << 32) | b for run in runs for a, b in zip(run, run[1:])}
        self.pairs = np.array(sorted(pairs), dtype=np.int64)

    def _state(self, length: int, next_: dict, link: int) -> int:
        self.length.append(length)
        self.next.append(next_)
        self.link.append(link)
        self.items.append(set())
        return len(self.length) - 1

    def _add(self, last: int, word: int) -> int:
        there = self.next[last].get(word)
        if there is not None and self.length[there] == self.length[last] + 1:
            return there
        if there is not None:
            return self._clone(last, word, there)
        new = self._state(self.length[last] + 1, {}, 0)
        while last != -1 and word not in self.next[last]:
            self.next[last][word] = new
            last = self.link[last]
        if last != -1:
            there = self.next[last][word]
            self.link[new] = there if self.length[there] == self.length[last] + 1 else self._clone(last, word, there)
        return new

    def _clone(self, last: int, word: int, there: int) -> int:
        copy = self._state(self.length[last] + 1, dict(self.next[there]), self.link[there])
        self.items[copy] = set(self.items[there])
        self.link[there] = copy
        while last != -1 and self.next[last].get(word) == there:
            self.next[last][word] = copy
            last = self.link[last]
        return copy

    def candidate_runs(self, ids: np.ndarray) -> list[tuple[int, int]]:
        """Maximal runs of words of which each neighbouring pair is one of an item: all that can hold a window."""
        known = ids >= 0
        joined = np.zeros(len(ids), dtype=bool)  # with the next word
        if len(ids) > 1 and len(self.pairs):
            pair = (ids[:-1] << 32) | ids[1:]
            at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
            joined[:-1] = known[:-1] & known[1:] & (self.pairs[at] == pair)
        starts = np.flatnonzero(known & ~np.concatenate(([False], joined[:-1])))
        ends = np.flatnonzero(known & ~joined) + 1
        return [(a, b) for a, b in zip(starts.tolist(), ends.tolist()) if b - a >= self.least]

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Merged (start, end) word spans that lie in windows of items, and those items.

        The words are streamed through the automaton, which knows the longest run that ends at each word.
        """
        get = self.ids.get
        ids = np.fromiter((get(word, -1) for word in words), dtype=np.int64, count=len(words))
        spans: list[tuple[int, int]] = []
        found: set = set()
        for start, end in self.candidate_runs(ids):
            run = ids[start:end].tolist()
            state, matched = 0, 0
            for i, word in enumerate(run):
                while state and word not in self.next[state]:
                    state = self.link[state]
                    matched = self.length[state]
                state = self.next[state].get(word, 0)
                matched = matched + 1 if state else 0
                covered = 0
                if matched >= self.window:
                    covered = matched
                    at = state
                    while self.length[self.link[at]] >= self.window:
                        at = self.link[at]
                    found |= self.items[at]
                for length in self.short_lengths:
                    if matched >= length and (held := self.short.get(tuple(run[i + 1 - length : i + 1]))):
                        found |= held
                        covered = max(covered, length)
                if covered:
                    begin = start + i + 1 - covered
                    while spans and spans[-1][1] >= begin:
                        begin = min(begin, spans.pop()[0])
                    spans.append((begin, start + i + 1))
        return spans, found


def _automata(benchmark: DataFrame, window: int, max_item_words: int, nameless: bool) -> Iterator[SuffixAutomaton]:
    """Automata of the items, each of at most ``max_item_words`` words (or one longer item)."""
    items = benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("text"))
    if not nameless:
        items = items.where("item_id IS NOT NULL")
    size = F.regexp_count(lower_ascii(F.col("text")), F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"))
    total = items.agg(F.sum(size)).first()[0] or 0
    parts = max(1, -(-total // max_item_words))
    for part in range(parts):
        mine = items if parts == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part)
        by_item: dict = {}
        for row in mine.orderBy("item_id", "text").toLocalIterator():
            by_item[(row["item_id"], len(by_item))] = words_of(row["text"])
        yield SuffixAutomaton(by_item, window)


def benchmark_hits(documents: DataFrame, benchmark: DataFrame, window: int = 10, max_item_words: int = MAX_ITEM_WORDS, nameless: bool = False) -> DataFrame:
    """``documents`` with n_words (long), spans (array of start and end, in words, merged and in order) and items (sorted ids).

    A window is ``window`` consecutive words of an item; an item of fewer words, but not none, is one window. Null texts have no
    words. Items with a null id are left out, unless ``nameless``: then their windows are hit like any other, and together they are
    one item, null, at the end of the ids. The automaton is sent to every task; it is built from at most
    ``max_item_words`` words. A larger benchmark is cut into parts that go over the documents one after the other, each
    pass adding its spans; the rows are written between passes, so that one automaton is held at a time.
    """
    spark = documents.sparkSession
    columns = list(documents.columns)
    out = documents.withColumns({
        "n_words": F.lit(0).cast("long"), "spans": F.array().cast("array<struct<start: int, end: int>>"), "items": F.array().cast("array<bigint>")})
    schema = out.schema
    text_at = columns.index("text")

    def searched(df: DataFrame, automaton: SuffixAutomaton) -> DataFrame:
        held = spark.sparkContext.broadcast(automaton)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in pieces(batches, text_at):
                n_words, spans, items = [], [], []
                for text, before, had in zip(batch.column(text_at).to_pylist(), batch.column(len(columns) + 1).to_pylist(), batch.column(len(columns) + 2).to_pylist()):
                    words = words_of(text)
                    more, found = held.value.hits(words)
                    n_words.append(len(words))
                    spans.append(merged([(s["start"], s["end"]) for s in before], more))
                    items.append(sorted({*had, *(item for item, _ in found)}, key=lambda item: (item is None, item or 0)))
                kinds = batch.schema.types[len(columns):]
                values = (n_words, [[{"start": a, "end": b} for a, b in s] for s in spans], items)
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(columns)], *[pa.array(v, k) for v, k in zip(values, kinds)]], names=batch.schema.names)

        return df.mapInArrow(run, schema)

    for i, automaton in enumerate(_automata(benchmark, window, max_item_words, nameless)):
        out = searched(saved(out, "benchmark-pass") if i else out, automaton)
    return out


def merged(a: list[tuple[int, int]], b: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of two lists of spans."""
    def join(done, span):
        if done and span[0] <= done[-1][1]:
            done[-1] = (done[-1][0], max(done[-1][1], span[1]))
        else:
            done.append(span)
        return done

    return reduce(join, sorted([*a, *b]), [])


def hit_digests(hits: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items (a null one counts), items_sha256 (of the ids but null), contaminated."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, span: total + span["end"] - span["start"])
    names = F.array_join(F.array_sort(F.transform("items", lambda item: item.cast("string"))), ",")
    return hits.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                       F.sha2(names, 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def decontaminate(documents: DataFrame, benchmark: DataFrame, window: int = 10, max_coverage: float = 0.5) -> DataFrame:
    """The documents without what they share with the benchmark.

    Spans of ``window`` words and more that occur in an item, with or without an id, are cut out of the text, with the separators inside them. A document
    of whose words more than ``max_coverage`` lie in spans goes as a whole. Other texts stay as they are; n_chars,
    where there, is counted anew for texts that were cut.
    """
    columns, schema = documents.columns, documents.schema
    hits = benchmark_hits(documents.select(F.struct(*columns_of(documents)).alias("row"), "text"), benchmark, window, nameless=True)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, span: total + span["end"] - span["start"])
    left = hits.where((n_hit == 0) | (n_hit <= max_coverage * F.col("n_words"))).select("row.*", "spans")
    left = left.toDF(*[f"_c{i}" for i in range(len(columns))], "_spans")  # mapInArrow takes no names with dots
    text_at = columns.index("text")
    chars_at = columns.index("n_chars") if "n_chars" in columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text_at):
            texts, spans = batch.column(text_at).to_pylist(), batch.column(len(columns)).to_pylist()
            cut = [without(text, [(s["start"], s["end"]) for s in found]) if found else text for text, found in zip(texts, spans)]
            arrays = list(batch.columns[: len(columns)])
            arrays[text_at] = pa.array(cut, arrays[text_at].type)
            if chars_at is not None:
                counts = [len(new) if found else n for new, found, n in zip(cut, spans, arrays[chars_at].to_pylist())]
                arrays[chars_at] = pa.array(counts, arrays[chars_at].type)
            yield pa.RecordBatch.from_arrays(arrays, names=columns)

    return left.mapInArrow(run, schema)


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the given spans of words."""
    data = text.encode()
    marks = data.translate(_WORD_BYTES)
    is_word = np.frombuffer(marks, dtype=np.uint8) != 0x20
    edge = np.diff(np.concatenate(([False], is_word, [False])).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    kept, at = [], 0
    for first, last in spans:
        kept.append(data[at : starts[first]])
        at = ends[last - 1]
    kept.append(data[at:])
    return b"".join(kept).decode()

