import hashlib
import random

import pytest
from conftest import prose

from logloom.llm import fim


def slow(doc_id, text, seed=1):
    """Form, prefix and middle length and output, by slices of the text."""
    n = len(text)
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return "plain", None, None, text
    a, b = min(h1 % (n + 1), h2 % (n + 1)), max(h1 % (n + 1), h2 % (n + 1))
    if h4 % 100 < 20:
        return "spm", a, b - a, f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}"
    return "psm", a, b - a, f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def text_rows():
    rng = random.Random(3)
    rows = [(i, "".join(rng.choice("aé漢😀 \n<P") for _ in range(rng.randint(0, 60)))) for i in range(300)]
    rows += [(1000, "one <P> inside"), (1001, "<S>"), (1002, "x<M>"), (1003, ""), (1004, None), (None, "nameless"), (None, None), (-1, "negative é"),
             (7, "the same id"), (7, "the same id"), (1005, prose(3, 60_000)), (1006, "é\u0000﻿")]
    return rows


@pytest.mark.parametrize("extra", [False, True])
def test_outputs_against_slices(documents, extra):
    rows = text_rows()
    got = fim.fill_in_middle(documents(rows, extra)).repartition(3).collect()
    want = sorted(((i, len(t or ""), *slow(i, t or "")) for i, t in rows), key=repr)
    assert sorted(((r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in got), key=repr) == want
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}


def test_pieces_describe_the_output(documents):
    texts = dict(text_rows()[:300])
    for r in fim.fill_in_middle(documents(list(texts.items()))).collect():
        text = texts[r["doc_id"]].encode()
        table = [fim.Piece(*p) for p in r["pieces"]]
        assert b"".join(fim.stream(table, text)).decode() == r["output"]
        if r["form"] == "plain":
            continue
        assert len([p for p in table if p.buffer == fim.SENTINELS]) == 3
        assert sum(p.length for p in table if p.buffer == fim.TEXT) == len(text)


def test_texts_come_back_from_outputs(documents):
    rows = text_rows()
    got = fim.fim_digests(fim.fill_in_middle(documents(rows))).collect()
    assert sorted((r["doc_id"], r["restored_sha256"]) if r["doc_id"] is not None else (-9, r["restored_sha256"]) for r in got) == \
        sorted((i if i is not None else -9, sha(t or "")) for i, t in rows)
    assert sorted(r["output_sha256"] for r in got) == sorted(sha(slow(i, t or "")[3]) for i, t in rows)


def test_cut_and_restore():
    table = [fim.Piece(0, 0, 5), fim.Piece(1, 3, 3), fim.Piece(0, 5, 4)]
    for at in range(13):
        before, after = fim.cut(table, at)
        assert b"".join(fim.stream(before + after, b"123456789")) == b"".join(fim.stream(table, b"123456789"))
        assert sum(p.length for p in before) == at and all(p.length for p in before + after)
    for form, output in (("psm", b"<P>a<S>c<M>b"), ("spm", b"<S>c<P>a<M>b"), ("plain", b"abc"), ("psm", b"<P><S><M>"), ("plain", b"")):
        assert b"".join(fim.stream(fim.restore(output, form), output)) in (b"abc", b"")


def test_other_rates(documents):
    rows = [(i, prose(i, 20)) for i in range(400)]
    forms = [r["form"] for r in fim.fill_in_middle(documents(rows), seed=5, percent=50, spm_percent=50).collect()]
    assert 150 < forms.count("plain") < 250 and 60 < forms.count("spm") < 140
    assert {r["form"] for r in fim.fill_in_middle(documents(rows), percent=0).collect()} == {"plain"}


def test_nothing(documents):
    assert fim.fim_digests(fim.fill_in_middle(documents([]))).collect() == []
