import random
import re
from collections import Counter

import numpy as np
import pytest
from conftest import prose

from logloom.llm import collocations, cqf
from logloom.plans.scratch import saved

PIECES, WORD = re.compile("[.,;:!?\x0a-\x0d]"), re.compile("[^\x20\x09]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def n_grams(rows):
    """Counts of phrases of 1 to 3 words per language."""
    counts = {}
    for _, text, lang, _ in rows:
        seen = counts.setdefault(lang if lang is not None else "und", Counter())
        for piece in PIECES.split(lower(text or "")):
            words = WORD.findall(piece)
            for n in (1, 2, 3):
                seen.update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    return counts


def slow(rows, least=10, share=50, top=2000):
    out = []
    for lang, f in n_grams(rows).items():
        n = sum(count for phrase, count in f.items() if len(phrase) == 1)
        longer = Counter()
        for phrase, count in f.items():
            if len(phrase) == 3 and count >= least:
                for part in (phrase[:2], phrase[1:]):
                    longer[part] = max(longer[part], count)
        found = []
        for phrase, a in f.items():
            if len(phrase) == 1 or a < least or (phrase in longer and 100 * longer[phrase] >= share * a):
                continue
            cuts = [(10**6 * a * a // (f[phrase[:k]] * f[phrase[k:]]), k) for k in range(1, len(phrase))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(phrase).encode(), f[phrase[:k]], f[phrase[k:]]))
        out += [(lang, i, p.decode(), -a, left, right, n, -s) for i, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1)]
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(((r["lang"], r["rank"], r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]) for r in df.collect()), key=repr)


def corpus(seed, n=250, vocabulary=25):
    rng = random.Random(seed)
    words = ["New", "york", "NEW", "é", "漢字", "x y", "a-b", "﻿", "\x00", "\x85"] + [f"w{i}" for i in range(vocabulary)]
    marks = [" ", "  ", "\t", ". ", ",", "\n", "\r", "\x0b", "!", " ", " "]
    rows = []
    for i in range(n):
        text = "".join(rng.choice(words[: rng.randint(2, len(words))]) + rng.choice(marks) for _ in range(rng.randint(0, 60)))
        rows.append((i, text, rng.choice(["en", "en", "en", "de", None, "und", ""]), "src"))
    return rows + [(900, None, "en", None), (901, "", None, None), (None, " \t\n.", "fr", None), *[(902, "new york new york city", "en", "s")] * 12]


@pytest.mark.parametrize("seed, extra", [(1, False), (2, True)])
def test_phrases_against_counting(documents, seed, extra):
    rows = corpus(seed)
    assert rows_of(collocations.mine_collocations(documents(rows, extra).repartition(5))) == slow(rows)


def test_limits_and_ties(documents):
    rows = [(i, f"p{i % 9} q{i % 9} r{i % 3}; é a; z a", "en", "s") for i in range(300)]
    df = documents(rows)
    for options in ({"top": 5}, {"least": 34, "top": 3}, {"share": 101}, {"least": 1, "share": 1}):
        assert rows_of(collocations.mine_collocations(df, **options)) == slow(rows, **options)


@pytest.mark.parametrize("part_entries, round_bits", [(50, 8), (50, 1), (7, 3), (10**9, 8)])
def test_rounds_of_merging(spark, documents, monkeypatch, part_entries, round_bits):
    monkeypatch.setattr(collocations, "PACK_BYTES", 300)
    rows = corpus(3)
    packs = saved(collocations.pack_words(documents(rows).coalesce(2)), "packs")
    words = saved(collocations.number_words(packs, 4), "words")
    named = {r["id"]: (r["lang"], r["word"]) for r in words.collect()}
    assert sorted(named) == list(range(1, len(named) + 1))
    got = {}
    for r in collocations.count_phrases(packs, words, 4, part_entries, round_bits).collect():
        ids = [r["w1"], r["w2"], r["w3"]][: r["n"]]
        assert len({named[i][0] for i in ids}) == 1
        got[named[ids[0]][0], tuple(named[i][1] for i in ids)] = r["f"]
    assert got == {(lang, p): f for lang, counts in n_grams(rows).items() for p, f in counts.items() if len(p) > 1 and f >= 4}


def test_rounds():
    assert collocations.merge_rounds(0) == [0] and collocations.merge_rounds(7) == [7] and collocations.merge_rounds(9) == [5, 9]
    for bits in range(31):
        steps = collocations.merge_rounds(bits, 8)
        assert steps[-1] == bits and all(0 <= b - a <= 8 for a, b in zip([0, *steps], steps))


def test_long_texts_and_scores_beyond_64_bits(documents, monkeypatch):
    monkeypatch.setattr(collocations, "STEP_BYTES", 50)
    rows = [(1, prose(4, 20_000, 30), "en", "s"), (2, "ab " * 5_000 + "." + "ab cd" * 3_000, "en", "s"), (3, "x" * 500 + " y", "en", "s")]
    assert rows_of(collocations.mine_collocations(documents(rows))) == slow(rows)


def test_large_products(spark):
    big = 3_000_000_000
    words = spark.createDataFrame([("en", "a", 3 * big, 1), ("en", "b", 2 * big, 2)], "lang string, word string, f long, id long")
    phrases = spark.createDataFrame([(2, 1, 2, 0, big)], collocations.PHRASES)
    row = collocations.score_phrases(phrases, words, 50).first()
    assert row["score"] == 10**6 * big * big // (6 * big * big)


def test_nothing(documents):
    assert collocations.mine_collocations(documents([])).collect() == []
    assert collocations.mine_collocations(documents([(1, None, None, None), (2, "a b", "en", "s")])).collect() == []


@pytest.mark.parametrize("id_bits", [1, 2, 7, 18, 21, 22, 25, 31, 32])
@pytest.mark.parametrize("n", [1, 2, 3])
def test_filters_lose_nothing(id_bits, n):
    rng = np.random.default_rng(id_bits)
    ids = [rng.integers(0, 1 << id_bits, 3000) for _ in range(n)]
    ids = [np.concatenate([column, column[:500], column[:1].repeat(700)]) for column in ids]
    want, bits = Counter(zip(*[column.tolist() for column in ids])), n * id_bits
    keys = cqf.pack(ids, id_bits)
    permuted = cqf.permute(*keys, bits)
    assert all((a == b).all() for a, b in zip(cqf.restore(*permuted, bits), keys))
    high, low, counts = cqf.summed(*permuted)
    for part_bits in (0, 3):
        if part_bits > bits:
            continue
        found = Counter()
        parts = cqf.top_bits(high, low, bits, part_bits) if part_bits else np.zeros(len(low), np.uint64)
        for part in range(1 << part_bits):
            own = parts == part
            data = cqf.encode(high[own], low[own], counts[own], bits, part, part_bits)
            for total, again in ((1, cqf.decode(data)), (3, cqf.merge([data] * 3))):
                assert (again[0] == high[own]).all() and (again[1] == low[own]).all() and (again[2] == total * counts[own]).all()
            back = cqf.unpack(*cqf.restore(*cqf.decode(data)[:2], bits), n, id_bits)
            found.update(dict(zip(zip(*[column.tolist() for column in back]), cqf.decode(data)[2].tolist())))
        assert found == want


def test_filters_are_compact_and_even():
    rng = np.random.default_rng(0)
    ids = [np.arange(100_000) // 300, np.arange(100_000) % 300, rng.integers(0, 50, 100_000)]
    high, low, counts = cqf.summed(*cqf.permute(*cqf.pack(ids, 18), 54))
    assert len(cqf.encode(high, low, counts, 54, 0, 0)) < 6.5 * len(low)
    per_part = np.bincount(cqf.top_bits(high, low, 54, 6).astype(int), minlength=64)
    assert per_part.max() < 1.3 * per_part.mean()
    with pytest.raises(ValueError):
        cqf.pack(ids, 33)
