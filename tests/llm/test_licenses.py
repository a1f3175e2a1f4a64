"""License scans against a scorer in plain Python, wrapped notices, and talk about licences."""

import re
import struct
from collections import Counter

import numpy as np
import pytest
import xxhash
from conftest import prose

from logloom.llm import licenses

GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version."""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions
are met:"""
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this
software and associated documentation files (the "Software"), to deal in the Software
without restriction, including without limitation the rights to use, copy, modify"""


def word_hash(*words):
    """XXH64 of the first word's bytes or number, the result being the seed of the next."""
    seed = 42
    for word in words:
        seed = xxhash.xxh64_intdigest(word.encode() if isinstance(word, str) else struct.pack("<q", word), seed)
    return seed - (1 << 64) if seed >> 63 else seed


def murmur_of_long(number):
    """32-bit Murmur3 of the eight bytes of a number, seed 42."""
    mask = 0xFFFFFFFF
    rotate = lambda x, n: ((x << n) | (x >> (32 - n))) & mask
    h = 42
    for part in struct.unpack("<II", struct.pack("<q", number)):
        k = rotate(part * 0xCC9E2D51 & mask, 15) * 0x1B873593 & mask
        h = (rotate(h ^ k, 13) * 5 + 0xE6546B64) & mask
    h ^= 8
    h = (h ^ (h >> 16)) * 0x85EBCA6B & mask
    h = (h ^ (h >> 13)) * 0xC2B2AE35 & mask
    h ^= h >> 16
    return h - (1 << 32) if h >> 31 else h


def tokens_of(unit):
    return re.sub(r"[^a-z0-9.+\-\x80-\U0010FFFF]+|[.+\-]+(?![a-z0-9])", " ", unit.lower()).strip(" ").split()


def grams_of(tokens, sizes=(1, 2, 3)):
    return {tuple(tokens[i : i + n]) for n in sizes for i in range(len(tokens) - n + 1)}


def probabilities(model, tokens):
    hashes = [word_hash(token) for token in tokens]
    places = {murmur_of_long(h) % licenses.FEATURES for h in hashes}
    places |= {murmur_of_long(word_hash(*hashes[i : i + n])) % licenses.FEATURES for n in (2, 3) for i in range(len(hashes) - n + 1)}
    margins = model.interceptVector.toArray() + model.coefficientMatrix.toArray()[:, sorted(places)].sum(axis=1)
    scores = np.exp(margins - margins.max())
    return scores / scores.sum()


def passages_of(text, model, limit, unknown_limit):
    """(start, n_units, text, family) of a text's passages."""
    found = []
    for number, unit in enumerate(re.split(r"\n|(?<=[.!?;:])[ \t]+(?=[A-Z(\"])", text or "")):
        tokens = tokens_of(unit)
        if tokens and (p := probabilities(model, tokens))[0] < limit:
            if not found or found[-1][-1][0] != number - 1:
                found.append([])
            found[-1].append((number, unit, tokens, p[0], licenses.CLASSES[1 + int(np.argmax(p[1:]))]))
    rows = []
    for run in found:
        grams = grams_of([token for unit in run for token in unit[2]])
        families = []
        for family in {unit[4] for unit in run} - {licenses.UNKNOWN}:
            templates = [tokens_of(t) for t in licenses.TEMPLATES[family]]
            own = [grams_of(t, (min(3, len(t)),)) for t in templates]
            if max(len(o & grams) / len(o) for o in own) >= licenses.LEAST_OVERLAP:
                families.append(family)
        if not families and min(unit[3] for unit in run) < unknown_limit:
            families = [licenses.UNKNOWN]
        rows += [(run[0][0], len(run), " ".join(unit[1] for unit in run), family) for family in families]
    return rows


@pytest.fixture(scope="module")
def trained(spark, documents):
    corpus = documents([(i, prose(i, 40) + ".\n" + prose(i + 500, 30) + "\n") for i in range(80)])
    return licenses.train_classifier(corpus)


def test_passages_against_plain_python(spark, documents, odd_rows, trained):
    texts = [GPL, f"{prose(1, 30)}\n{BSD}\n\n{MIT}\n{prose(2, 20)}", "Released under the MIT License.\nLicensed under the Apache License, Version 2.0.",
             "Released under the MIT License.\n\nReleased under the MIT License.", "All rights reserved. " + prose(3, 12), f"{prose(4, 3000)}. Licensed under CC BY-NC 4.0. {prose(5, 2000)}",
             "# Licensed under the Acme Widget License 2.1.\n#\n# No part of this may be copied.", *licenses.TALK, *(t for ts in licenses.TEMPLATES.values() for t in ts)]
    rows = [(100 + i, text) for i, text in enumerate(texts)] + [(r[0], r[1]) for r in odd_rows] + [(None, texts[1]), (None, texts[1]), (None, texts[2])]
    got = licenses.license_passages(documents(rows, extra=True), *trained).collect()
    want = [(doc_id, *row) for doc_id, text in set(rows) for row in passages_of(text, *trained)]
    assert sorted([(r["doc_id"], r["start"], r["n_units"], r["text"], r["family"]) for r in got], key=repr) == sorted(want, key=repr)
    assert all(0.5 <= r["probability"] <= 1 and 0 <= r["overlap"] <= 1 for r in got)


def test_wrapped_notices_have_their_family_and_talk_has_none(spark, documents, trained):
    talk = ["The museum's copyright office discussed the license of a taxi driver and granted permission.", "Our new license plate arrived. The copyright question is still open.",
            "The law on licenses was changed under the last government."]
    rows = list(enumerate([GPL, BSD, MIT, GPL.replace("\n", "\n# "), *talk, "This code is licensed under the Acme Widget License 2.1."]))
    got = {r["doc_id"]: r["family"] for r in licenses.license_passages(documents(rows), *trained).collect()}
    assert got == {0: "gpl", 1: "bsd", 2: "mit", 3: "gpl", 7: "unknown"}


def test_repeated_rows_count_once(spark, documents):
    rows = [(1, "Released under the MIT License.")] * 5 + [(1, prose(1, 30)), (None, "Licensed under CC BY 4.0."), (None, None), (2, None), (3, "")] + [(i, prose(i, 40)) for i in range(4, 30)]
    got = [tuple(r) for r in licenses.scan_licenses(documents(rows, extra=True)).collect()]
    assert sorted(got, key=repr) == sorted([(1, "mit", 1, 0)] * 6 + [(None, "cc-by", 1, 0)] * 2 + [(i, "", 0, 0) for i in range(2, 30)], key=repr)


def places_of(tokens):
    hashes = [word_hash(token) for token in tokens]
    grams = hashes + [word_hash(*hashes[i : i + n]) for n in (2, 3) for i in range(len(hashes) - n + 1)]
    return {murmur_of_long(gram) % licenses.FEATURES for gram in grams}


def test_every_distinct_unit_counts_in_the_fit(spark, documents):
    texts = [f"{prose(i, 4, 60)} the license of number {i}\n{prose(i, 3, 60)}. {i}" for i in range(9_000)]
    rows = [(i, "\n".join(texts[100 * i : 100 * i + 100])) for i in range(90)]
    rows += [(90, texts[0]), (91, None), (92, ""), (93, "Released under the MIT License."), (None, texts[1])]
    fixed = [v for ts in licenses.TEMPLATES.values() for t in ts for v in licenses._variants(t, licenses.FRAMES)]
    fixed += [v for t in licenses.TALK for v in licenses._variants(t, ["{}"])]
    known = set().union(*(places_of(tokens_of(text)) for text in fixed))
    units = {unit for _, text in rows[:90] for unit in re.split(r"\n|(?<=[.!?;:])[ \t]+(?=[A-Z(\"])", text) if tokens_of(unit)}
    assert len(units) > 16_000
    want = Counter(tuple(sorted(places_of(tokens_of(unit)) & known)) for unit in units)
    got = {tuple(r["places"]): r["n"] for r in licenses.ordinary_vectors(licenses.unit_rows(documents(rows))).collect()}
    assert got == want


def test_only_units_that_may_be_below_the_limit_are_scored(spark, documents, trained):
    model, limit, _ = trained
    talk = [f"{prose(i, 12)}." for i in range(300)] + [f"{prose(i, 5)} the license {prose(i + 1, 5)}" for i in range(50)]
    texts = [*talk, *licenses.TALK, GPL, BSD, MIT, *(t for ts in licenses.TEMPLATES.values() for t in ts)]
    rows = licenses.unit_rows(documents(list(enumerate(texts)))).where("size(places) > 0")
    exact = {r["unit"]: probabilities(model, tokens_of(r["unit"]))[0] for r in rows.collect()}
    for level in (1e-9, 0.01, limit, 0.5, 0.9):
        kept = {r["unit"] for r in rows.where(licenses.below_limit(model, level)).collect()}
        assert {unit for unit, p in exact.items() if p < level} <= kept
        if level <= 0.5:
            assert len(kept) < 0.5 * len(exact)
    assert rows.where(licenses.below_limit(model, 0.0)).count() == 0
    assert rows.where(licenses.below_limit(model, 1.0)).count() == rows.count()
