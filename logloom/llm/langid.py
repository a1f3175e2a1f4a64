"""Language identification of spans: script ranges, per-word scores, and Viterbi with a penalty for each switch."""

from __future__ import annotations

import bisect
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from logloom.llm.common import columns_of, doc_crc, pieces

UNKNOWN = "und"
SAMPLE_DOCUMENTS = 1_500
# Characters of a training text that are read, in so many pieces spread evenly over the whole of it.
SAMPLE_CHARS, SAMPLE_PIECES = 3_000, 10
WORDS_KEPT = 100_000
PIECE = 40  # letters; longer runs are cut into pieces of this length at most

# First code point of ranges and the script that letters from there on have ("" for none in particular).
SCRIPTS = [
    (0x0000, "Latin"), (0x0250, ""), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"), (0x0600, "Arabic"), (0x0700, ""),
    (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, ""), (0x0B80, "Tamil"), (0x0C00, ""), (0x0E00, "Thai"), (0x0E80, ""), (0x10A0, "Georgian"),
    (0x1100, "Hangul"), (0x1200, ""), (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, ""), (0x3040, "Kana"), (0x3100, ""), (0x3400, "Han"), (0xA000, ""),
    (0xAC00, "Hangul"), (0xD7B0, ""),
]
_STARTS = [start for start, _ in SCRIPTS]
# Letters by category, each with the marks (such as vowel signs) that belong to it.
_WORD = regex.compile(r"(?:\p{L}\p{M}*)+")
_IMPOSSIBLE = -60.0


@lru_cache(1 << 16)
def _script_at(letter: str) -> str | None:
    """Script of a letter; None for phonetic, modifier and sign-like letters, which go with those before them."""
    if 0x0250 <= ord(letter) < 0x0370 or 0x2000 <= ord(letter) < 0x3040:
        return None
    return SCRIPTS[bisect.bisect_right(_STARTS, ord(letter)) - 1][1]


def script_of(word: str) -> str:
    """Script of the word's first letter that has one of its own."""
    return next((script for script in map(_script_at, word) if script is not None), "")


@lru_cache(1 << 16)
def _is_letter(c: str) -> bool:
    return _WORD.match(c) is not None


def words_of(text: str | None) -> list[str]:
    """The words of a text, lower-case: its runs of letters, cut where the script changes, and long ones into even pieces."""
    lowered = text.lower() if text else ""
    words = _WORD.findall(lowered)
    if not words:
        return words
    if lowered.isascii() or len({_script_at(c) for c in set(lowered) if _is_letter(c)} - {None}) < 2:
        return words if max(map(len, words)) <= PIECE else [piece for word in words for piece in _even_pieces(word)]
    return [piece for word in words for part in _one_script_each(word) for piece in _even_pieces(part)]


def _one_script_each(word: str) -> list[str]:
    if word.isascii():
        return [word]
    parts, start, script = [], 0, None
    for i, letter in enumerate(word):
        own = _script_at(letter)
        if own is None:
            continue
        if script is not None and own != script:
            parts.append(word[start:i])
            start = i
        script = own
    return [*parts, word[start:]]


def _even_pieces(word: str) -> list[str]:
    if len(word) <= PIECE:
        return [word]
    n = -(-len(word) // PIECE)
    return [word[len(word) * k // n : len(word) * (k + 1) // n] for k in range(n)]


class LanguageModel:
    """Log probabilities of words' letter n-grams by language, and the scripts that each language is written in.

    A word's score in a language is the sum over its letters of log P(letter | two letters before), with the word's edges as
    letters. What a language has not shown is smoothed by the shorter context. Only languages seen with the word's script
    are candidates; a script that no language has shown leaves all of them open, all alike.
    """

    def __init__(self, samples: pd.DataFrame, switch: float = 4.0):
        self.languages = sorted(samples["lang"].unique())
        self.switch = switch
        counts: list[dict[int, dict[str, int]]] = []
        self.scripts: dict[str, set[int]] = {}
        for k, lang in enumerate(self.languages):
            mine: dict[int, dict[str, int]] = {1: {}, 2: {}, 3: {}}
            tally: dict[str, int] = {}
            for text in samples.loc[samples["lang"] == lang, "text"]:
                for word in words_of(text):
                    tally[word] = tally.get(word, 0) + 1
            shown: dict[str, int] = {}
            for word, n in tally.items():
                shown[script_of(word)] = shown.get(script_of(word), 0) + n
                padded = f"  {word} "
                for end in range(3, len(padded) + 1):
                    for size in (1, 2, 3):
                        gram = padded[end - size : end]
                        mine[size][gram] = mine[size].get(gram, 0) + n
            for script, n in shown.items():
                if n > 0.001 * sum(shown.values()):
                    self.scripts.setdefault(script, set()).add(k)
            counts.append(mine)
        letters = max(30, len({gram for mine in counts for gram in mine[1]}))
        before: list[dict[int, dict[str, int]]] = []
        for mine in counts:
            sums: dict[int, dict[str, int]] = {1: {"": sum(mine[1].values())}, 2: {}, 3: {}}
            for size in (2, 3):
                for gram, n in mine[size].items():
                    sums[size][gram[:-1]] = sums[size].get(gram[:-1], 0) + n
            before.append(sums)
        self.counts, self.before, self.letters = counts, before, letters
        self.gram_rows: dict[str, int] = {}
        self.gram_table: list[list[float]] = []
        # Per script: 1 for a candidate, 0 for none; all 2 where no language has the script.
        self.open_to = {script: [int(k in mine) for k in range(len(self.languages))] for script, mine in self.scripts.items()}
        self.all_open = [2] * len(self.languages)
        self.known: dict[str, int] = {}
        self.table = np.zeros((1024, len(self.languages)), dtype=np.float32)

    def _gram(self, gram: str) -> list[float]:
        """log P(last letter | the two before) per language."""
        row = []
        for counts, before in zip(self.counts, self.before):
            p = 1.0 / self.letters
            for size, weight in ((1, 2.0), (2, 4.0), (3, 8.0)):
                part = gram[3 - size :]
                p = (counts[size].get(part, 0) + weight * p) / (before[size].get(part[:-1], 0) + weight)
            row.append(math.log(p))
        return row

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Scores of lower-case words per language, the best one of each word 0."""
        rows, grams = self.gram_rows, []
        if len(rows) > WORDS_KEPT:
            rows.clear()
            self.gram_table.clear()
        padded = [f"  {word} " for word in words]
        for word in padded:
            grams += [word[i : i + 3] for i in range(len(word) - 2)]
        for gram in set(grams) - rows.keys():
            rows[gram] = len(rows)
            self.gram_table.append(self._gram(gram))
        at = np.fromiter(map(rows.__getitem__, grams), dtype=np.int64, count=len(grams))
        sizes = np.fromiter(map(len, padded), dtype=np.int64, count=len(padded)) - 2
        scores = np.add.reduceat(np.array(self.gram_table)[at], np.cumsum(sizes) - sizes, axis=0)
        open_to = self.open_to
        possible = np.array([open_to.get(script_of(word), self.all_open) for word in words])
        scores = np.where(possible == 1, scores, -np.inf)
        scores -= scores.max(axis=1, keepdims=True)
        return np.where(possible == 2, 0.0, np.maximum(scores, _IMPOSSIBLE)).astype(np.float32)

    def word_rows(self, words: list[str]) -> np.ndarray:
        """Row of ``table`` for each word; scores are made once per word and kept for a bounded number of words."""
        known = self.known
        if len(known) > WORDS_KEPT:
            known.clear()
        new = list(set(words) - known.keys())
        if new:
            first = len(known)
            while first + len(new) > len(self.table):
                self.table = np.concatenate([self.table, np.zeros_like(self.table)])
            for start in range(0, len(new), 20_000):
                part = new[start : start + 20_000]
                self.table[first + start : first + start + len(part)] = self.word_scores(part)
            known.update(zip(new, range(first, first + len(new))))
        return np.fromiter(map(known.__getitem__, words), dtype=np.int64, count=len(words))

    def label(self, texts: list[str | None]) -> list[tuple[str, float, list[tuple[int, int, str]]]]:
        """(language, score, spans) of each text; spans are (first word, end word, language) over its words (``words_of``).

        The words of all texts go through Viterbi side by side, the longest texts first, so that a step is one array
        operation over the texts that still have words. The language is that of most letters; the score is its share of them.
        """
        found = [words_of(text) for text in texts]
        sizes = np.array([len(words) for words in found], dtype=np.int64)
        n_lang = len(self.languages)
        if not sizes.sum() or not n_lang:
            return [(UNKNOWN, 0.0, []) for _ in texts]
        flat = [word for words in found for word in words]
        rows = self.word_rows(flat)
        lengths = np.fromiter(map(len, flat), dtype=np.int64, count=len(flat))
        begins = np.cumsum(sizes) - sizes
        order = np.argsort(-sizes, kind="stable")
        begin, size = begins[order], sizes[order]
        active = np.searchsorted(-size, -np.arange(1, size[0] + 1), side="right")  # texts with at least so many words
        best = np.zeros((active[0], n_lang), dtype=np.float32)
        came_best = np.zeros(len(flat), dtype=np.int32)  # the best language before each word
        switched = np.zeros((len(flat), n_lang), dtype=bool)
        final = np.zeros((len(order), n_lang), dtype=np.float32)
        for step, n in enumerate(active.tolist()):
            at = begin[:n] + step
            if n < len(best):
                final[n : len(best)] = best[n:]
                best = best[:n]
            if step:
                top = best.argmax(axis=1)
                jump = best[np.arange(n), top][:, None] - self.switch
                came_best[at] = top
                take = best < jump
                switched[at] = take
                best = np.where(take, jump, best)
            best = best + self.table[rows[at]]
            best -= best.max(axis=1, keepdims=True)
        final[: len(best)] = best
        labels = np.zeros(len(flat), dtype=np.int32)
        state = final.argmax(axis=1)
        for step in range(len(active) - 1, -1, -1):
            n = active[step]
            at = begin[:n] + step
            now = state[:n]
            labels[at] = now
            if step:
                state[:n] = np.where(switched[at, now], came_best[at], now)
        doc = np.repeat(np.arange(len(texts)), sizes)
        share = np.bincount(doc * n_lang + labels, weights=lengths, minlength=len(texts) * n_lang).reshape(len(texts), n_lang)
        change = np.flatnonzero(np.concatenate(([True], (labels[1:] != labels[:-1]) | (doc[1:] != doc[:-1]))))
        span_doc, ends = doc[change], np.append(change[1:], len(flat))
        first_span = np.searchsorted(span_doc, np.arange(len(texts) + 1))
        main = share.argmax(axis=1)
        out = []
        for i in range(len(texts)):
            if not sizes[i]:
                out.append((UNKNOWN, 0.0, []))
                continue
            own = range(first_span[i], first_span[i + 1])
            spans = [(int(change[s] - begins[i]), int(ends[s] - begins[i]), self.languages[labels[change[s]]]) for s in own]
            out.append((self.languages[main[i]], float(share[i, main[i]] / share[i].sum()), spans))
        return out


def spread_pieces(text: Column, most_chars: int, n: int = SAMPLE_PIECES) -> Column:
    """A text of up to ``most_chars`` characters, or ``n`` pieces of a longer one, from its start to its end, cut between words."""
    size = most_chars // n
    start = lambda i: (F.floor((F.length(text) - size) * i / (n - 1)) + 1).cast("int")
    piece = lambda i: F.regexp_replace(F.substr(text, start(i), F.lit(size)), r"\A\S{1,40}\s|\s\S{1,40}\z", " ")
    return F.when(F.length(text) <= most_chars, text).otherwise(F.array_join(F.transform(F.sequence(F.lit(0), F.lit(n - 1)), piece), " "))


def train_languages(documents: DataFrame, most_documents: int = SAMPLE_DOCUMENTS, most_chars: int = SAMPLE_CHARS) -> LanguageModel:
    """A model from the text and lang of documents that are not held out (crc32 of the id as text, mod 4, is not 2).

    Fitted on at most ``most_documents`` texts per language, all where there are no more, those with the lowest hash, equal texts counted
    once: a bounded sample, the same in every run. Of a text longer than ``most_chars`` characters so many are read, in pieces spread over
    the whole of it. Rows without text or lang are left out.
    """
    rows = documents.where("text IS NOT NULL AND lang IS NOT NULL").where(~_held_out())
    rows = rows.select("lang", "text", F.xxhash64("text").alias("_h"))
    n = rows.select("lang", "_h").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("_n"))
    # Of the range of hashes, with eight standard deviations to spare, so that no language falls short by chance.
    share = F.lit(most_documents + 8 * math.sqrt(most_documents) + 32) / F.col("_n")
    # One row per language, far less than the driver holds in a model of it: the texts are filtered where they are.
    sample = rows.join(F.broadcast(n), "lang").where(F.col("_h") / F.lit(2.0**64) + 0.5 <= share)
    sample = sample.select("lang", "_h", spread_pieces(F.col("text"), most_chars).alias("text"))
    by_hash = Window.partitionBy("lang").orderBy("_h", "text")
    sample = sample.dropDuplicates(["lang", "_h"])
    sample = sample.withColumn("_at", F.row_number().over(by_hash)).where(F.col("_at") <= most_documents)
    return LanguageModel(sample.select("lang", "text").toPandas())


def _held_out():
    return F.coalesce(F.pmod(doc_crc(F.col("doc_id")), F.lit(4)) == 2, F.lit(False))


def label_languages(documents: DataFrame, model: LanguageModel) -> DataFrame:
    """``documents`` with lang_pred, score (0 to 1) and spans (first word, end word, language) from whole texts.

    Only the text is looked at. Null texts and texts without letters are ``und`` with score 0 and no spans.
    """
    columns = list(documents.columns)
    text_at = columns.index("text")
    held = documents.sparkSession.sparkContext.broadcast(model)
    span = "array<struct<start: int, end: int, lang: string>>"
    schema = documents.withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0), "spans": F.lit(None).cast(span)}).schema
    kinds = [pa.string(), pa.float64(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text_at, 2 << 20):
            found = held.value.label(batch.column(text_at).to_pylist())
            spans = [[{"start": a, "end": b, "lang": lang} for a, b, lang in s] for _, _, s in found]
            values = [[lang for lang, _, _ in found], [score for _, score, _ in found], spans]
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(v, k) for v, k in zip(values, kinds)]], names=[*batch.schema.names, "lang_pred", "score", "spans"])

    return documents.mapInArrow(run, schema)


def identify_languages(documents: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score: languages of whole texts by a model of the documents that are not held out."""
    model = train_languages(documents)
    held_out = documents.select("doc_id", "text", _held_out().alias("held_out"))
    return label_languages(held_out, model).select("doc_id", "held_out", "lang_pred", "score")


def documents_with_language(documents: DataFrame, least_score: float = 0.5) -> DataFrame:
    """The documents that have a language: it is not ``und``, and at least ``least_score`` of their letters are in it."""
    model = train_languages(documents)
    labelled = label_languages(documents.select(F.struct(*columns_of(documents)).alias("row"), "text"), model)
    return labelled.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least_score)).select("row.*")
