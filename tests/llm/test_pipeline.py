"""The pipeline over small tables against a chain of its stages in plain Python."""

import random
import re
import zlib

import numpy as np
import public_tokenizers
import xxhash
from conftest import prose
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from logloom.llm import common, langid, mixing
from logloom.llm.queries import LLM_ORACLES

WORD, BENCH = re.compile(r"[^\x20\x09-\x0D]+"), re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def fingerprint(text):
    words = WORD.findall(lower(text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    counts = np.zeros(64, int)
    for shingle in shingles:
        h = xxhash.xxh64_intdigest(shingle.encode(), 42)
        counts += [(h >> bit) & 1 for bit in range(64)]
    return sum(1 << bit for bit in range(64) if 2 * counts[bit] > len(shingles)) if shingles else 0


def groups(rows):
    """The rows of each group whose fingerprints are linked at four bits or fewer."""
    fps = [fingerprint(row["text"]) for row in rows]
    of = list(range(len(rows)))

    def root(i):
        while of[i] != i:
            i = of[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                of[root(i)] = root(j)
    found = {}
    for i, row in enumerate(rows):
        found.setdefault(root(i), []).append(row)
    return list(found.values())


def without_benchmark(text, items):
    """The text without its spans of ten and more item words, or None where most of its words lie in them."""
    places = [(m.start(), m.end()) for m in BENCH.finditer(lower(text))]
    words = [lower(text)[a:b] for a, b in places]
    windows = set()
    for item in items:
        own = BENCH.findall(lower(item or ""))
        size = min(10, len(own))
        windows |= {tuple(own[i : i + size]) for i in range(len(own) - size + 1) if size}
    hit = set()
    for size in {len(window) for window in windows}:
        for i in range(len(words) - size + 1):
            if tuple(words[i : i + size]) in windows:
                hit |= set(range(i, i + size))
    return len(hit), len(words), hit


def tables(spark, folder):
    rng = random.Random(4)
    languages = {"aa": "abcdefgh", "bb": "mnopqrst"}
    vocabulary = {lang: ["".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(300)] for lang, letters in languages.items()}
    text = lambda lang, n: " ".join(rng.choice(vocabulary[lang]) for _ in range(n))
    items = [text("aa", 25), text("bb", 12), None, "", text("aa", 3)]
    rows = []
    for i in range(160):
        lang = rng.choice(["aa", "aa", "bb"])
        rows.append((i, text(lang, rng.randint(15, 90)), lang, rng.choice(["web", "web", "web", "book", None])))
    rows += [(200 + i, rows[7][1], "aa", "web") for i in range(20)] + [(240 + i, rows[8][1] + f" {rows[9][1].split()[0]}" * (i % 2), "aa", "book") for i in range(4)]
    rows += [(300, text("aa", 40) + " " + items[0] + " " + text("aa", 40), "aa", "web"), (301, items[1], "bb", "web")]
    rows += [(400, None, "aa", "web"), (401, "", None, None), (402, " 123 ½ !", "aa", "web"), (None, text("bb", 30), "bb", "web"), (None, text("aa", 31), "aa", None), (5, text("bb", 33), "bb", "book")]
    frame = spark.createDataFrame([(*r, None if r[1] is None else len(r[1]), {"a": str(r[0])}, 1.5) for r in rows],
                                  "doc_id long, text string, lang string, source string, n_chars long, extra map<string,string>, `a.b` double")
    frame.repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return items


def plain(rows):
    return sorted(((r["doc_id"], r["text"]) for r in rows), key=repr)


def test_stages_one_after_the_other(spark, tmp_path):
    items = tables(spark, tmp_path)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near_copies", "benchmark", "mix", "tokens"]
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns, kept = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        found = stage(spark, docs, str(tmp_path))
        if name != "tokens":
            assert found.columns == columns
            found.write.parquet(f"{tmp_path}/{name}")
            docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept.append((name, before, found.collect() if name == "tokens" else docs.collect()))

    _, before, after = kept[0]
    model = langid.train_languages(spark.read.parquet(f"{tmp_path}/documents.parquet"))
    want = [r for r, (lang, score, _) in zip(before, model.label([r["text"] for r in before])) if lang != "und" and score >= 0.5]
    assert plain(after) == plain(want) and len(before) - len(after) == 3

    _, before, after = kept[1]
    for group in groups(before):
        assert len([r for r in group if (r["doc_id"], r["text"]) in {(a["doc_id"], a["text"]) for a in after}]) >= 1
    assert len(after) == len(groups(before)) < len(before)
    firsts = {min((r["doc_id"] for r in group if r["doc_id"] is not None), default=None) for group in groups(before)}
    assert firsts == {r["doc_id"] for r in after}

    _, before, after = kept[2]
    texts = {(r["doc_id"], r["extra"]["a"]): r for r in after}
    assert {k for k, r in texts.items() if r["n_chars"] != len(r["text"])} == set()
    n_cut = 0
    for r in before:
        n_hit, n, hit = without_benchmark(r["text"], items)
        if n_hit > 0.5 * n:
            assert (r["doc_id"], r["text"]) not in plain(after)
        elif not n_hit:
            assert (r["doc_id"], r["text"]) in plain(after)
        else:
            own = BENCH.findall(lower(r["text"]))
            left = [w for i, w in enumerate(own) if i not in hit]
            assert left in [BENCH.findall(lower(a["text"])) for a in after if a["doc_id"] == r["doc_id"]]
            n_cut += 1
    assert n_cut

    _, before, after = kept[3]
    copies = {}
    for r in mixing.mix_sources(spark.read.parquet(f"{tmp_path}/benchmark")).collect():
        copies.setdefault(r["doc_id"], []).append(r["copies"])
    taken = {}
    for r in after:
        taken[r["doc_id"]] = taken.get(r["doc_id"], 0) + 1
    assert taken == {k: sum(v) for k, v in copies.items() if sum(v)} and {r["text"] for r in after} <= {r["text"] for r in before}

    _, before, after = kept[4]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = [(r["doc_id"], np.array(library.encode(r["text"], add_special_tokens=False).ids + [2], "<u4")) for r in before]
    assert sorted(((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in after), key=repr) == sorted(((d, len(x), zlib.crc32(x.tobytes())) for d, x in ids), key=repr)
    start = 0
    for r in sorted(after, key=lambda r: r["start"]):
        assert r["start"] == start
        start += r["n_tokens"]

    ran = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, ran), key=repr) == sorted(map(tuple, after), key=repr)


def test_names_of_columns(spark):
    df = spark.createDataFrame([(1, {"k": "v"})], "`a.b` int, `c``d` map<string,string>")
    row = df.select(F.struct(*common.columns_of(df)).alias("row"), common.row_hash(df).alias("h")).first()
    assert row["row"].asDict() == {"a.b": 1, "c`d": {"k": "v"}} and isinstance(row["h"], int) and LLM_ORACLES and prose(1, 2)
