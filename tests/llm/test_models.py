import random
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from conftest import prose
from pyspark.sql import functions as F

from logloom.llm import langid, licenses, toxicity

SF = "/root/testdata/sf0.01"


@pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")
def test_languages_of_held_out_documents(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    found = langid.identify_languages(documents).join(documents.select("doc_id", "lang"), "doc_id").where("held_out AND lang IS NOT NULL")
    assert found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0] >= 0.97


def test_letters_by_category():
    model = small_model()
    assert [lang for lang, _, _ in model.label(["½ ²", "① 5 _ !", "́", None, "baka ½"])] == ["und"] * 4 + ["xx"]
    assert langid.words_of("हिन्दी में ½ x² عَرَبِيّ") == ["हिन्दी", "में", "x", "عَرَبِيّ"]


def test_many_languages():
    rows = [(f"l{i:03d}", " ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26)}{c}" for c in "aeiou")) for i in range(200)]
    model = langid.LanguageModel(pd.DataFrame(rows, columns=["lang", "text"]))
    assert [lang for lang, _, _ in model.label([text for _, text in rows])] == [lang for lang, _ in rows]


def test_training_texts_are_read_to_their_end(documents):
    texts = [prose(1, 30), " ".join(f"w{i:05d}" for i in range(5000)), "漢" * 9000]
    df = documents([(i, text) for i, text in enumerate(texts)]).select("doc_id", langid.spread_pieces(F.col("text"), 3000).alias("text"))
    short, spread, run = [row["text"] for row in df.orderBy("doc_id").collect()]
    numbers = [int(word[1:]) for word in spread.split()]
    assert short == texts[0] and 2900 <= len(spread) <= 3010 and numbers == sorted(numbers) and len(run) >= 3000
    assert numbers[0] < 10 and numbers[-1] > 4990 and all(any(n // 500 == part for n in numbers) for part in range(10)) and set(map(len, spread.split())) == {6}


def small_model():
    rows = [("xx", " ".join(f"{a}{b}ka" for a in "bdg" for b in "aio")), ("yy", " ".join(f"{a}{b}sch" for a in "bdg" for b in "eu")), ("gr", "λογος και ανθρωπος")]
    return langid.LanguageModel(pd.DataFrame(rows, columns=["lang", "text"]))


def test_spans_against_all_paths():
    model, rng = small_model(), random.Random(1)
    words = ["baka", "dika", "besch", "guka", "dusch", "λογος", "кот", "a1b"]
    for n in (1, 2, 5, 6):
        texts = [" ".join(rng.choice(words) for _ in range(n)) for _ in range(8)]
        for text, (lang, score, spans) in zip(texts, model.label(texts)):
            found = langid._WORD.findall(text)
            scores = model.word_scores(found)
            labels = [model.languages.index(l) for a, b, l in spans for _ in range(a, b)]
            value = lambda path: sum(scores[i][k] for i, k in enumerate(path)) - model.switch * sum(a != b for a, b in zip(path, path[1:]))  # noqa: E731, B023
            best = max(value(path) for path in np.ndindex(*[3] * len(found)))
            assert value(labels) == pytest.approx(best, abs=1e-3) and 0 <= score <= 1


def test_every_letter_of_long_runs_counts():
    model = small_model()
    texts = ["baka" * 30 + "λογος" * 40 + "besch" * 100, "baka" * 100 + "besch" * 200, "bakaλογος", "кот" + "besch" * 90]
    got = model.label(texts)
    assert [[lang for _, _, lang in spans] for _, _, spans in got[:3]] == [["xx", "gr", "yy"], ["xx", "yy"], ["xx", "gr"]]
    assert [lang for lang, _, _ in got] == ["yy", "yy", "gr", "yy"] and got[0][1] == pytest.approx(500 / 820)
    assert got[1][1] == pytest.approx(1000 / 1400, abs=0.03)
    for text in texts:
        words = langid.words_of(text)
        assert "".join(words) == text and max(map(len, words)) <= langid.PIECE and len(model.word_scores(words)) == len(words)


def test_copies_do_not_shrink_the_sample(documents, monkeypatch):
    monkeypatch.setattr(langid, "LanguageModel", lambda samples: samples)
    rows = [(i, prose(i % 8, 20), "aa") for i in range(3000)] + [(5000 + i, prose(100 + i % 60, 20), "bb") for i in range(900)] + [(9000 + i, prose(500 + i, 20), "cc") for i in range(400)]
    df = documents([(*row, "src") for row in rows])
    got = langid.train_languages(df, 30)
    assert got.groupby("lang").size().to_dict() == {"aa": 8, "bb": 30, "cc": 30} and not got["text"].duplicated().any()


def test_language_of_odd_rows(spark, documents, odd_rows):
    df = documents(odd_rows, extra=True)
    got = {r["doc_id"]: r["lang_pred"] for r in langid.identify_languages(df).collect()}
    assert got[1] == got[2] == got[3] == "und" and got[4] in ("en", "fr")
    kept = langid.documents_with_language(df)
    assert kept.columns == df.columns and {r["doc_id"] for r in kept.collect()} >= {4, 5, 6}
    assert langid.identify_languages(documents([])).collect() == []


def test_gradients_against_differences():
    network = toxicity.Network(3)
    for key in ("word", "gram"):
        network.p[key] *= 20
    network.p = {k: v.astype(np.float64) for k, v in network.p.items()}
    words = prose(1, 40).split()
    rows, grams, sizes = toxicity.word_features(words)
    begin = np.cumsum(sizes) - sizes
    features = lambda used: (rows[used], np.concatenate([grams[begin[u] : begin[u] + sizes[u]] for u in used]), sizes[used])
    at = np.random.default_rng(0).integers(1, 41, (toxicity.WINDOW, 4))
    lengths = np.array([32, 20, 1, 32])
    at[np.arange(32)[:, None] >= lengths] = 0
    labels, weights = np.array([1.0, 0, 1, 0]), np.array([1.0, 2, 1, 1])

    def loss():
        table = np.concatenate([network._padding()[None], network.inputs(*features(np.arange(40))) @ network.p["in"] + network.p["in_b"]])
        logits = network.forward(table[at], lengths)
        return (weights * (np.log1p(np.exp(logits)) - labels * logits)).sum() / weights.sum()

    gradients = network.gradients(at, lengths, features, labels, weights)
    for key, where in (("u0", (2, 5)), ("u1", (1, 20)), ("att", (3,)), ("out", (7,)), ("in", (4, 30)), ("word", (rows[at[0, 0] - 1], 2)), ("gram", (grams[begin[at[0, 0] - 1]], 5))):
        old, step = network.p[key][where], 1e-2
        network.p[key][where] = old + step
        up = loss()
        network.p[key][where] = old - step
        down = loss()
        network.p[key][where] = old
        assert gradients[key][where] == pytest.approx((up - down) / (2 * step), rel=0.05, abs=2e-4), key


def test_every_word_is_in_a_window():
    doc, start, length = toxicity.window_index(np.array([0, 1, 32, 33, 48, 49, 500]))
    for d, n in enumerate([0, 1, 32, 33, 48, 49, 500]):
        seen = {w for s, k in zip(start[doc == d], length[doc == d]) for w in range(s, s + max(k, 0))}
        assert seen == set(range(n))


def test_no_part_of_a_text_is_left_out(documents, spark, monkeypatch):
    network = toxicity.Network(3)
    clean, other = network.logits(["a" * 70 + "bbbbbb" + "a" * 30, "a" * 70 + "zorgel" + "a" * 30])
    assert clean != other
    for n in (1, 40, 41, 60, 61, 500):
        run = "".join(chr(97 + i * i % 23) for i in range(n))
        pieces = toxicity.words_of(run)
        assert max(map(len, pieces)) <= 40 and all(any(run[i : i + 20] in piece for piece in pieces) for i in range(max(1, n - 19)))
    rows = [(i, prose(i, 3000)) for i in range(1, 11)]
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, toxic int")
    sample = toxicity.training_sample(documents(rows), labels)
    assert len(sample) and set(sample["text"]) <= {text for _, text in rows}

    class Seen(Exception):
        pass

    def seen(sizes):
        raise Seen(sizes.tolist())

    monkeypatch.setattr(toxicity, "window_index", seen)
    with pytest.raises(Seen) as sizes:
        toxicity.train_network(sample)
    assert min(sizes.value.args[0]) >= 3000


def test_digits_and_symbols_are_read():
    assert toxicity.words_of("You 1D10T! f*ck, a$$ (don't) -- x/y end.Next 7") == ["you", "1d10t", "f*ck", "a$$", "don't", "x", "y", "end", "next", "7"]
    rng = random.Random(6)
    texts = []
    for i in range(320):
        words = prose(i % 40, rng.randint(8, 50), 200).split()
        if i % 4 == 0:
            words.insert(rng.randrange(len(words)), rng.choice(["z0rg*l", "z0rg*ma", "z0rg*st", "z0rg*"]))
            words.insert(rng.randrange(len(words)), rng.choice(["z0rg*l", "z0rg*x"]))
        texts.append(" ".join(words))
    network = toxicity.train_network(pd.DataFrame({"text": texts[:240], "toxic": [int(i % 4 == 0) for i in range(240)]}))
    found = network.scores([*texts[240:], prose(90, 30, 200) + " z0rg*new " + prose(91, 30, 200)]) >= 0.5
    assert np.mean(found == [i % 4 == 0 for i in range(240, 320)] + [True]) > 0.9


def test_toxicity_of_new_documents(spark, documents):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(500):
        words = prose(i % 40, rng.randint(5, 90), 200).split()
        toxic = i % 4 == 0
        for _ in range(2 * toxic):
            words.insert(rng.randrange(len(words)), f"zorg{rng.choice(['el', 'ima', 'o', 'ust'])}")
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    rows += [(900, None), (901, ""), (None, "zorgel zorgo")]
    table = spark.createDataFrame(labels + [(None, 1), (3, None)], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.toxicity(documents(rows, extra=True), table).collect()}
    assert all(0 <= r["score"] <= 1 for r in got.values()) and len(got) == 503
    held = [i for i in range(500) if got[i]["held_out"]]
    assert np.mean([got[i]["predicted"] == labels[i][1] for i in held]) > 0.9
    assert toxicity.toxicity(documents([]), table.limit(0)).collect() == []


def test_licenses(spark, documents, odd_rows):
    rows = [(i, prose(i, 40) + "\n" + prose(i + 500, 30)) for i in range(60)]
    rows += [(100, prose(1, 20) + "\nReleased under the MIT License."), (101, "Licensed under CC BY-NC 4.0.\n" + prose(2, 9)), (102, "Released under the MIT License.\n\nLicensed under the Apache License, Version 2.0.")]
    got = {r["doc_id"]: r for r in licenses.scan_licenses(documents(rows + [(r[0] and r[0] + 1000, r[1]) for r in odd_rows], extra=True)).collect()}
    assert (got[100]["licenses"], got[101]["licenses"], got[102]["licenses"]) == ("mit", "cc-by-nc", "apache-2.0,mit")
    assert not any(got[i]["n_licenses"] for i in range(60)) and got[1001]["licenses"] == ""
    assert licenses.scan_licenses(documents([])).collect() == []
