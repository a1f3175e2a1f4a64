"""Toxicity of whole texts: a bidirectional gated recurrent network with attention pooling over overlapping windows, in numpy.

A word's input joins an embedding of the word and the mean embedding of its character n-grams, so that a word never seen is
read by its parts. The network scores windows of ``WINDOW`` words, each starting ``STRIDE`` after the one before; a document's score
is that of its highest window.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm.common import doc_crc, pieces

WINDOW, STRIDE = 32, 16
HIDDEN, WORD_SIZE, CHAR_SIZE = 8, 8, 16
WORD_ROWS, GRAM_ROWS = 1 << 12, 1 << 14
SAMPLE_TOXIC, SAMPLE_OTHERS = 1_000, 3_000
PIECE, PIECE_STEP = 40, 20  # characters of the pieces that longer runs are read by, and from one to the next
WORDS_KEPT = 150_000
GRAM = 4
STEP = 4096
DECAY = 0.3  # of the embeddings, per unit of learning rate
_WORD = re.compile(r"[^\s.,;:?\"()\[\]{}/…–—]+")


def words_of(text: str | None) -> list[str]:
    """Runs of letters, digits and symbols, lower-case, cut at blanks and at the punctuation of sentences, without marks at their ends.

    Spellings such as ``1d10t`` or ``f*ck`` are one word. Long runs become overlapping pieces, so that what is short lies whole in one of them.
    """
    words = [word for word in (run.strip("!'-") for run in _WORD.findall(text.lower())) if word] if text else []
    if not words or max(map(len, words)) <= PIECE:
        return words
    return [word[at : at + PIECE] for word in words for at in range(0, max(1, len(word) - PIECE + PIECE_STEP), PIECE_STEP)]


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of the words' embeddings; rows of those of their character n-grams (``GRAM`` bytes, edges marked), and how many each word has."""
    crc, rows, grams, sizes = zlib.crc32, [], [], []
    for word in words:
        marked = f"<{word}>".encode()
        n = max(1, len(marked) - GRAM + 1)
        rows.append(crc(marked))
        grams += [crc(marked[i : i + GRAM]) for i in range(n)]
        sizes.append(n)
    return np.array(rows, np.int64) % WORD_ROWS, np.array(grams, np.int64) % GRAM_ROWS, np.array(sizes, np.int64)


def _sum_rows(rows: np.ndarray, values: np.ndarray, total: int) -> np.ndarray:
    """(total, width) sums of the values by row."""
    out = np.zeros((total, values.shape[1]), dtype=np.float32)
    if len(rows):
        order = np.argsort(rows, kind="stable")
        ordered = rows[order]
        firsts = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
        out[ordered[firsts]] = np.add.reduceat(values[order], firsts, axis=0)
    return out


def window_index(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, first word within it, words) of all windows; each document has one at least, and each word is in one."""
    per_doc = np.maximum(1, -(-(sizes - (WINDOW - STRIDE)) // STRIDE))
    doc = np.repeat(np.arange(len(sizes)), per_doc)
    start = (np.arange(len(doc)) - np.repeat(np.cumsum(per_doc) - per_doc, per_doc)) * STRIDE
    return doc, start, np.minimum(sizes[doc] - start, WINDOW)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """Parameters and passes. ``gates`` of a word are its inputs to the three gates in both directions."""

    def __init__(self, seed: int = 1):
        rng = np.random.default_rng(seed)
        draw = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
        inputs = WORD_SIZE + CHAR_SIZE
        self.p = {
            "word": draw(WORD_ROWS, WORD_SIZE, scale=0.02), "gram": draw(GRAM_ROWS, CHAR_SIZE, scale=0.02),
            "in": draw(inputs, 6 * HIDDEN, scale=inputs**-0.5), "in_b": np.zeros(6 * HIDDEN, np.float32),
            "u0": draw(HIDDEN, 3 * HIDDEN, scale=HIDDEN**-0.5), "u1": draw(HIDDEN, 3 * HIDDEN, scale=HIDDEN**-0.5),
            "att": draw(2 * HIDDEN, scale=0.3), "out": draw(2 * HIDDEN, scale=0.3), "out_b": np.zeros(1, np.float32)}
        self.scale = (1.0, 0.0)  # of document logits
        self.forget()

    def __getstate__(self):
        return {"p": self.p, "scale": self.scale}

    def __setstate__(self, state):
        self.p, self.scale = state["p"], state["scale"]
        self.forget()

    def forget(self) -> None:
        """Drop the words' remembered gates; row 0 is the padding, which leaves a state as it is."""
        self.known: dict[str, int] = {}
        self.table = np.zeros((4096, 6 * HIDDEN), dtype=np.float32)
        self.table[0] = self._padding()

    @staticmethod
    def _padding() -> np.ndarray:
        row = np.zeros((2, 3, HIDDEN), dtype=np.float32)
        row[:, 0] = 30
        return row.reshape(-1)

    def inputs(self, rows: np.ndarray, grams: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        char = np.add.reduceat(self.p["gram"][grams], np.cumsum(sizes) - sizes, axis=0) / np.sqrt(sizes)[:, None].astype(np.float32)
        return np.concatenate([self.p["word"][rows], char], axis=1)

    def gate_rows(self, words: list[str]) -> np.ndarray:
        """Rows of ``table`` for words, made once for each and kept for a bounded number."""
        if len(self.known) > WORDS_KEPT:
            self.forget()
        new = list(set(words) - self.known.keys())
        first = len(self.known) + 1
        while first + len(new) > len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        for start in range(0, len(new), 8192):
            part = new[start : start + 8192]
            x = self.inputs(*word_features(part))
            self.table[first + start : first + start + len(part)] = x @ self.p["in"] + self.p["in_b"]
        self.known.update(zip(new, range(first, first + len(new))))
        return np.fromiter(map(self.known.__getitem__, words), dtype=np.int64, count=len(words))

    def _direction(self, gates: np.ndarray, u: np.ndarray, backward: bool, keep: bool):
        """Hidden states (window word, window, HIDDEN) of one direction; with ``keep`` also what the way back needs."""
        steps, n = gates.shape[0], gates.shape[1]
        states = np.zeros((steps, n, HIDDEN), dtype=np.float32)
        h = np.zeros((n, HIDDEN), dtype=np.float32)
        kept = []
        for t in range(steps - 1, -1, -1) if backward else range(steps):
            x, hu = gates[t], h @ u
            zr = _sigmoid(x[:, : 2 * HIDDEN] + hu[:, : 2 * HIDDEN])
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            c = np.tanh(x[:, 2 * HIDDEN :] + r * hu[:, 2 * HIDDEN :])
            if keep:
                kept.append((t, h, z, r, c, hu[:, 2 * HIDDEN :]))
            h = c + z * (h - c)
            states[t] = h
        return states, kept

    def forward(self, gates: np.ndarray, lengths: np.ndarray, keep: bool = False):
        """Logits of windows; ``gates`` is (window word, window, 6 * HIDDEN)."""
        one, kept_one = self._direction(gates[:, :, : 3 * HIDDEN], self.p["u0"], False, keep)
        two, kept_two = self._direction(gates[:, :, 3 * HIDDEN :], self.p["u1"], True, keep)
        h = np.concatenate([one, two], axis=2)
        score = h @ self.p["att"]
        score[np.arange(len(h))[:, None] >= np.maximum(lengths, 1)[None, :]] = -1e9
        weight = np.exp(score - score.max(axis=0))
        weight /= weight.sum(axis=0)
        pooled = np.einsum("tn,tnh->nh", weight, h)
        logits = pooled @ self.p["out"] + self.p["out_b"][0]
        return (logits, (h, weight, pooled, kept_one, kept_two)) if keep else logits

    def logits(self, texts: list[str | None]) -> np.ndarray:
        """Of each text, that of the highest of all its windows."""
        found = [words_of(text) for text in texts]
        sizes = np.array([len(words) for words in found], dtype=np.int64)
        rows = np.append(self.gate_rows([word for words in found for word in words]), 0)
        doc, start, length = window_index(sizes)
        begin = (np.cumsum(sizes) - sizes)[doc] + start
        place = np.arange(WINDOW)[:, None]
        best = np.full(len(texts), -np.inf)
        for at in range(0, len(doc), STEP):
            part = slice(at, at + STEP)
            word = np.where(place < length[part], begin[part] + place, len(rows) - 1)
            np.maximum.at(best, doc[part], self.forward(self.table[rows[word]], length[part]))
        return best

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Calibrated score of each text."""
        return _sigmoid(self.scale[0] * self.logits(texts) + self.scale[1])

    def gradients(self, at: np.ndarray, lengths: np.ndarray, features, labels: np.ndarray, weights: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the weighted mean log loss over windows; ``at`` has their words (window word, window), 0 for padding, as
        rows from 1 on of ``features``."""
        used, at = np.unique(at, return_inverse=True)
        at = at.reshape(WINDOW, -1)
        if used[0] == 0:
            used = used[1:]
        else:
            at = at + 1
        rows, grams, sizes = features(used - 1)
        x = self.inputs(rows, grams, sizes)
        table = np.concatenate([self._padding()[None], x @ self.p["in"] + self.p["in_b"]])
        logits, (h, weight, pooled, kept_one, kept_two) = self.forward(table[at], lengths, keep=True)
        d_logit = ((_sigmoid(logits) - labels) * weights / weights.sum()).astype(np.float32)
        g = {"out": pooled.T @ d_logit, "out_b": d_logit.sum(keepdims=True)}
        d_pooled = d_logit[:, None] * self.p["out"]
        d_weight = np.einsum("nh,tnh->tn", d_pooled, h)
        d_score = weight * (d_weight - (weight * d_weight).sum(axis=0))
        g["att"] = np.einsum("tn,tnh->h", d_score, h)
        d_h = weight[:, :, None] * d_pooled[None] + d_score[:, :, None] * self.p["att"]
        d_gates = np.zeros((*at.shape, 6 * HIDDEN), dtype=np.float32)
        for k, kept in enumerate((kept_one, kept_two)):
            own = slice(k * HIDDEN, (k + 1) * HIDDEN)
            d_gates[:, :, k * 3 * HIDDEN : (k + 1) * 3 * HIDDEN], g[f"u{k}"] = self._back(kept, d_h[:, :, own], self.p[f"u{k}"])
        d_table = _sum_rows(at.reshape(-1), d_gates.reshape(-1, 6 * HIDDEN), len(table))[1:]  # the padding has no parameters
        g["in"], g["in_b"] = x.T @ d_table, d_table.sum(axis=0)
        d_x = d_table @ self.p["in"].T
        g["word"] = _sum_rows(rows, d_x[:, :WORD_SIZE], WORD_ROWS)
        g["gram"] = _sum_rows(grams, np.repeat(d_x[:, WORD_SIZE:] / np.sqrt(sizes)[:, None].astype(np.float32), sizes, axis=0), GRAM_ROWS)
        return g

    @staticmethod
    def _back(kept, d_states, u):
        d_u = np.zeros_like(u)
        d_gates = np.zeros((*d_states.shape[:2], 3 * HIDDEN), dtype=np.float32)
        d_h = np.zeros(d_states.shape[1:], dtype=np.float32)
        for t, h, z, r, c, hc in reversed(kept):
            d = d_states[t] + d_h
            d_c = d * (1 - z) * (1 - c * c)
            d_z = d * (h - c) * z * (1 - z)
            d_r = d_c * hc * r * (1 - r)
            inner = np.concatenate([d_z, d_r, d_c * r], axis=1)
            d_gates[t] = np.concatenate([d_z, d_r, d_c], axis=1)
            d_u += h.T @ inner
            d_h = d * z + inner @ u.T
        return d_gates, d_u


class Adam:
    """Adam; the embeddings share one second moment a table, so that words seen once hardly move."""

    def __init__(self, parameters: dict[str, np.ndarray], rate: float):
        self.p, self.rate, self.t = parameters, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in parameters.items()}
        self.v = {k: np.zeros(1, np.float32) if k in ("word", "gram") else np.zeros_like(v) for k, v in parameters.items()}

    def step(self, gradients: dict[str, np.ndarray]) -> None:
        self.t += 1
        rate = self.rate * (1 - 0.999**self.t) ** 0.5 / (1 - 0.9**self.t)
        for k, g in gradients.items():
            square = (g * g).max(axis=0).mean() if k in ("word", "gram") else g * g
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.001 * (square - self.v[k])
            if k in ("word", "gram"):
                self.p[k] *= 1 - DECAY * self.rate
            self.p[k] -= rate * self.m[k] / (np.sqrt(self.v[k]) + 1e-8)


def train_network(sample: pd.DataFrame, rounds: int = 6, batch: int = 256, rate: float = 0.01, seed: int = 1) -> Network:
    """Fit on labelled texts (columns text, toxic).

    Labels are of documents, windows inherit them. After one pass over all windows, a round takes from each toxic document
    its highest window and those that are over 0.5, and from each other document its three highest windows and three drawn ones: what a
    document's score, the highest of its windows, is decided by. Every fifth document is left out and gives the
    scale of the final scores.
    """
    rng = np.random.default_rng(seed)
    network = Network(seed)
    sample = sample.sort_values(["toxic", "text"]).reset_index(drop=True)
    aside = sample.index % 5 == 4
    texts = [words_of(text) for text in sample["text"][~aside]]
    toxic = sample["toxic"][~aside].to_numpy(np.float32)
    if not len(toxic) or toxic.min() == toxic.max():
        network.p["out"][:] = 0
        network.p["out_b"][:] = 3.0 if len(toxic) and toxic[0] else -3.0
        return network
    sizes = np.array([len(words) for words in texts], dtype=np.int64)
    vocabulary = {word: i for i, word in enumerate(sorted({word for words in texts for word in words}))}
    word_ids = np.array([vocabulary[word] + 1 for words in texts for word in words] + [0], dtype=np.int64)
    docs, start, lengths = window_index(sizes)
    begin, place = (np.cumsum(sizes) - sizes)[docs] + start, np.arange(WINDOW)[:, None]
    windows = word_ids[np.where(place < lengths, begin + place, len(word_ids) - 1)]
    labels = toxic[docs]
    all_rows, all_grams, all_sizes = word_features(list(vocabulary)) if vocabulary else [np.zeros(0, np.int64)] * 3
    gram_start = np.cumsum(all_sizes) - all_sizes

    def features(used: np.ndarray):
        n = all_sizes[used]
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return all_rows[used], all_grams[np.repeat(gram_start[used], n) + inside], n

    def window_logits() -> np.ndarray:
        everything = features(np.arange(len(vocabulary)))
        table = np.concatenate([network._padding()[None], network.inputs(*everything) @ network.p["in"] + network.p["in_b"]]) if vocabulary else network._padding()[None]
        parts = [slice(k, k + STEP) for k in range(0, len(docs), STEP)]
        return np.concatenate([network.forward(table[windows[:, part]], lengths[part]) for part in parts])

    adam = Adam(network.p, rate)
    least = 60 * batch  # windows to train on in a round, so that small samples are gone over more often
    for number in range(rounds + 1):
        chosen = np.arange(len(docs)) if not number else _deciding(window_logits(), labels, docs, rng)
        positive = max(labels[chosen].sum(), 1.0)
        weight = np.where(labels == 1, np.clip((len(chosen) - positive) / positive, 1, 20), 1.0).astype(np.float32)
        for _ in range(max(1 if not number else 2, -(-least // len(chosen)))):
            order = rng.permutation(chosen)
            for first in range(0, len(order), batch):
                part = order[first : first + batch]
                adam.step(network.gradients(windows[:, part], lengths[part], features, labels[part], weight[part]))
    network.forget()
    held = sample["text"][aside].tolist()
    found = [network.logits(held[k : k + 64]) for k in range(0, len(held), 64)]
    network.scale = _platt(np.concatenate([np.zeros(0), *found]), sample["toxic"][aside].to_numpy(np.float64))
    network.forget()
    return network


def _deciding(found: np.ndarray, labels: np.ndarray, docs: np.ndarray, rng) -> np.ndarray:
    """Windows that decide documents' scores, and some more of documents that are not toxic."""
    order = np.lexsort((-found, docs))
    rank = np.empty(len(docs), dtype=np.int64)
    firsts = np.flatnonzero(np.concatenate(([True], docs[1:] != docs[:-1])))
    rank[order] = np.arange(len(docs)) - np.repeat(firsts, np.diff(np.append(firsts, len(docs))))
    drawn = rng.random(len(docs)) < 3 / np.bincount(docs)[docs]
    return np.flatnonzero(np.where(labels == 1, (rank == 0) | (found > 0), (rank < 3) | drawn))


def _platt(logits: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset that turn logits into probabilities, by Newton steps on smoothed labels."""
    if not len(labels) or labels.min() == labels.max():
        return 1.0, 0.0
    ones, zeros = (labels == 1).sum(), (labels == 0).sum()
    target = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    middle, spread = logits.mean(), logits.std() + 1e-6
    x = np.stack([(logits - middle) / spread, np.ones_like(logits)], axis=1)
    w = np.array([0.0, 0.0])
    for _ in range(100):
        p = _sigmoid(x @ w)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (p - target) + 1e-2 * w)
        w -= step * min(1.0, 1.0 / np.abs(step).max())
    slope = max(w[0], 0.05) / spread
    return float(slope), float(w[1] - slope * middle)


def _held_out():
    return F.coalesce(F.pmod(doc_crc(F.col("doc_id")), F.lit(5)) == 0, F.lit(False))


def training_sample(documents: DataFrame, labels: DataFrame, most_toxic: int = SAMPLE_TOXIC, most_others: int = SAMPLE_OTHERS) -> pd.DataFrame:
    """text and toxic of at most ``most_toxic`` toxic and ``most_others`` other documents whose crc32 of the id, mod 5, is not 0.

    The labelled ids with the lowest hashes, the same in every run; they are few by this bound, and so are sent to the
    documents. An id that any label row calls toxic is toxic. Texts are whole: a label may
    be due to any part of its text.
    """
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~_held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    parts = [known.where(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most) for k, most in ((0, most_others), (1, most_toxic))]
    chosen = parts[0].unionByName(parts[1])
    texts = documents.select(F.col("doc_id").alias("_id"), "text").where("text IS NOT NULL")
    joined = texts.join(F.broadcast(chosen), F.col("_id") == F.col("doc_id"))
    return joined.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")).select("text", "toxic").toPandas()


def score_toxicity(documents: DataFrame, network: Network) -> DataFrame:
    """``documents`` with score (0 to 1) of each whole text, null as empty. Only the text is looked at."""
    text_at = documents.columns.index("text")
    held = documents.sparkSession.sparkContext.broadcast(network)
    schema = documents.withColumn("score", F.lit(0.0)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text_at, 2 << 20):
            scores = held.value.scores(batch.column(text_at).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=[*batch.schema.names, "score"])

    return documents.mapInArrow(run, schema)


def toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted: toxicity by a network trained on the labelled documents that are not held out."""
    network = train_network(training_sample(documents, labels))
    scored = score_toxicity(documents.select("doc_id", "text", _held_out().alias("held_out")), network)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
