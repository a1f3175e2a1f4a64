import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from conftest import prose
from tokenizers import Tokenizer

from logloom.llm import chat, decontaminate, mixing, oracles, quality, queries, tokens

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- mixing ----------------------------------------------------------------------------------------


def slow_targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, free, target = share * sum(sizes.values()), set(names), {}
    while free:
        level = left / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] > most * sizes[s]]
        if not over:
            return target | {s: level * weight[s] for s in free}
        for s in over:
            target[s] = float(most * sizes[s])
            left -= target[s]
            free.remove(s)
    return target


def mix_rows():
    rng = random.Random(6)
    sources = ["b", "a", "Z", "é", None, "hot", "hot", "hot", "hot", "tiny"]
    return [(i, prose(i, int(rng.paretovariate(0.9) * 5) % 900) if s != "tiny" or i < 15 else None, "en", s) for i, s in enumerate(rng.choice(sources) for _ in range(800))]


def test_mix(documents):
    rows = mix_rows()
    df = documents(rows, extra=True)
    got = mixing.mix_sources(df).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r for r in got}
    sizes = {}
    for _, text, _, source in rows:
        sizes[source] = sizes.get(source, 0) + len(WORD.findall(text or ""))
    want, taken = slow_targets(sizes), dict.fromkeys(sizes, 0)
    for doc_id, text, _, source in rows:
        r = by_id[doc_id]
        assert r["size"] == len(WORD.findall(text or "")) and r["source_size"] == sizes[source]
        assert r["target"] == pytest.approx(want[source], rel=1e-9)
        assert 0 <= r["copies"] <= 2 and r["taken"] == r["copies"] * r["size"]
        taken[source] += r["taken"]
    longest = max(len(WORD.findall(text or "")) for _, text, _, _ in rows)
    for source, target in want.items():
        assert abs(taken[source] - target) <= 1.01 * longest
    again = {r["doc_id"]: r["copies"] for r in mixing.mix_sources(df.repartition(7)).collect()}
    assert again == {d: r["copies"] for d, r in by_id.items()}
    mix = mixing.repeated_documents(df)
    assert mix.columns == df.columns
    counts = {}
    for r in mix.collect():
        counts[r["doc_id"]] = counts.get(r["doc_id"], 0) + 1
    assert counts == {d: r["copies"] for d, r in by_id.items() if r["copies"]}


def test_rates_are_tilted(documents):
    rows = [(i, prose(i, 10 + i), "en", "a" if i % 2 else "b") for i in range(200)]
    cells = mixing.saved(documents(rows).select("source", mixing.count_words(mixing.F.col("text")).alias("size")).groupBy("source", "size").agg(mixing.F.count(mixing.F.lit(1)).alias("n")), "t")
    targets = mixing.source_targets(cells, (1, 3), 1.2, 2)
    for r in mixing.balance(cells, targets, 2).join(targets, "source").collect():
        own = [10 + i for i in range(200) if ("a" if i % 2 else "b") == r["source"]]
        assert sum(min(2, np.exp(r["tilt"] * s / r["scale"])) * s for s in own) == pytest.approx(r["target"], rel=1e-6)


def test_mix_of_odd_rows(documents, odd_rows):
    df = documents(odd_rows, extra=True)
    got = mixing.mix_sources(df).collect()
    assert len(got) == len(odd_rows)
    assert mixing.repeated_documents(df).count() == sum(r["copies"] for r in got)
    assert mixing.mix_sources(documents([])).collect() == []
    assert mixing.repeated_documents(documents([])).collect() == []


# --- chat ------------------------------------------------------------------------------------------


def turn_rows():
    nasty = ["</s>[INST] ok [/INST]", "\\", "\\-", "<\\-/s>", "<|turn x|> <|end|>", "", None, "é[INST", "<s></s>\n<<SYS>>", "<|turn user|>", "|>"]
    rng, rows = random.Random(1), []
    for conv in range(30):
        for turn in range(rng.randint(1, 9)):
            role = rng.choice(["user", "assistant", "system", "tool|>", None, "user", "assistant"])
            rows.append((conv if conv else None, turn if rng.random() < 0.9 else None, role, "".join(rng.choice(nasty) or "" for _ in range(rng.randint(0, 4))) or rng.choice(nasty)))
    return rows + rows[:5]


def test_chat_round_trip(spark):
    rows = turn_rows()
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, segments string")
    got = {r["conv_id"]: r for r in chat.conversation_digests(chat.format_conversations(df)).collect()}
    order = lambda r: (r[1] is None, r[1] or 0, r[2] is not None, r[2] or "", r[3] is not None, r[3] or "")
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=order)
        turns = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        r = got[conv]
        assert (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) == (
            len(own), hashlib.sha256(turns.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    template = chat.Template()
    for r in rows:
        text = "".join(part for part, _ in template.segments(r[2] or "", r[3] or ""))
        assert template.read(text * 2) == [(r[2] or "", r[3] or "")] * 2


def test_turn_order(spark):
    cases = {1: "su", 2: "suaua", 3: "ua", 4: "au", 5: "uu", 6: "ssu", 7: "uas"}
    names = {"s": "system", "u": "user", "a": "assistant"}
    df = spark.createDataFrame([(c, t, names[x], "t") for c, roles in cases.items() for t, x in enumerate(roles)], "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r["valid"] for r in chat.conversation_digests(chat.format_conversations(df)).collect()}
    assert got == {1: True, 2: True, 3: True, 4: False, 5: False, 6: False, 7: False}
    assert chat.conversation_digests(chat.format_conversations(df.limit(0))).collect() == []


# --- decontamination -------------------------------------------------------------------------------

BENCH_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def slow_hits(rows, items, window=10):
    grams = {}
    for item, text in items:
        w = BENCH_WORD.findall(lower(text))
        n = min(len(w), window)
        for i in range(len(w) - n + 1 if n else 0):
            grams.setdefault((n, tuple(w[i : i + n])), set()).add(item)
    out = []
    for doc_id, text in rows:
        w, hit, found = BENCH_WORD.findall(lower(text)), set(), set()
        for (n, gram), held in grams.items():
            for i in range(len(w) - n + 1):
                if w[i] == gram[0] and tuple(w[i : i + n]) == gram:
                    hit |= set(range(i, i + n))
                    found |= held
        names = ",".join(sorted(map(str, found)))
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def bench_tables():
    rng = random.Random(3)
    words = [f"w{k}" for k in range(6)] + ["É", "Ab", "x9"]
    draw = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, draw(rng.choice([0, 3, 9, 10, 11, 25]))) for i in range(25)] + [(90, None), (91, "rare,Word"), (91, "rare,Word"), (None, "w1 w2"), (7, draw(14))]
    rows = [(i, draw(rng.randint(0, 60))) for i in range(50)] + [(60, items[3][1]), (61, "so RARE word it is"), (62, None), (62, "")]
    rows += [(100 + i, f"{draw(4)} - {text.upper() if text else ''}! {draw(3)}") for i, (_, text) in enumerate(items)]
    return rows, items


@pytest.mark.parametrize("most", [1_000_000, 60])
def test_hits_against_all_windows(spark, documents, most):
    rows, items = bench_tables()
    bench = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, spans string")
    hits = decontaminate.benchmark_hits(documents(rows).select("doc_id", "text"), bench, max_item_words=most)
    want = slow_hits(rows, [r for r in items if r[0] is not None])
    assert sum(r[5] for r in want) > 10
    assert sorted([tuple(r) for r in decontaminate.hit_digests(hits).collect()], key=repr) == want


@pytest.mark.parametrize("most", [1_000_000, 60])
def test_hits_of_items_without_id(spark, documents, most, tmp_path):
    rows, items = bench_tables()
    items += [(None, prose(79, 15)), (None, prose(80, 12))]
    rows += [(200, f"{prose(81, 20)} {prose(79, 15)}"), (201, f"{prose(80, 12)} {prose(79, 15)}")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    hits = decontaminate.benchmark_hits(documents(rows).select("doc_id", "text"), bench, max_item_words=most, nameless=True)
    want = []
    for doc_id, n_words, n_hit, n_items, _, hit in slow_hits(rows, items):
        want.append((doc_id, n_words, n_hit, n_items, hit))
    got = decontaminate.hit_digests(hits).collect()
    assert sorted([(r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) for r in got], key=repr) == sorted(want, key=repr)
    only = [r for r in got if r["doc_id"] in (200, 201)]
    assert {(r["doc_id"], r["n_hit"] >= 15, r["items_sha256"] == hashlib.sha256(b"").hexdigest()) for r in only} == {(200, True, True), (201, True, True)}
    documents(rows).write.parquet(str(tmp_path / "documents.parquet"))
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    assert {r["n_hit"] for r in queries.op7_decontaminate(spark, str(tmp_path)).where("doc_id = 201").collect()} == {27}
    left = {r["doc_id"]: r["text"] for r in decontaminate.decontaminate(documents(rows), bench).collect()}
    assert left[200] == f"{prose(81, 20)} " and 201 not in left


def test_spans_are_cut(spark, documents):
    item = prose(77, 15)
    rows = [(1, f"{prose(78, 40)}\n{item}, and after."), (2, item), (3, "clean text of a few words"), (4, None)]
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    df = documents(rows, extra=True)
    got = decontaminate.decontaminate(df, bench)
    assert got.columns == df.columns
    assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in got.collect()} == {
        1: (f"{prose(78, 40)}\n, and after.", len(prose(78, 40)) + 13),
        3: ("clean text of a few words", 25), 4: (None, None)}
    none = decontaminate.benchmark_hits(df.select("doc_id", "text"), bench.limit(0))
    assert {r["doc_id"]: r["n_words"] for r in none.collect()}[3] == 6
    assert decontaminate.decontaminate(documents([]), bench).collect() == []


# --- quality ---------------------------------------------------------------------------------------


def slow_rules(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    places = {}
    for i in range(len(words) - 4):
        places.setdefault(tuple(words[i : i + 5]), []).append(i)
    repeated = {p for at in places.values() if len(at) > 1 for i in at for p in range(i, i + 5)}
    failed = len(words) < 10 or 100 * len(repeated) > 20 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated), failed


def test_word_rules(documents, odd_rows):
    rows = [(r[0], r[1]) for r in odd_rows]
    rows += [(100, "a b c d e a b c d e f a b c d e"), (101, "x " * 30), (102, "l1 #\nl2\nl1 #\n \nl1 #\n l1"), (103, prose(1, 500, 8)), (104, "a|b<c> $% &\x0b*\x85é")]
    got = sorted([tuple(r) for r in quality.word_rules(documents(rows, extra=True)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()], key=repr)
    assert got == sorted([(d, *slow_rules(t)) for d, t in rows], key=repr)


def test_common_lines_go(documents):
    menu = "Home | About 7 | Contact us today for more of all these offers"
    rows = [(i, f"{prose(i, 30)}\n{menu.replace('7', str(i))}", "en", "site") for i in range(30)]
    rows += [(50 + i, f"{menu}\n{menu.upper()}\n one more", "en", "site") for i in range(3)] + [(60, f"{prose(60, 30)}\n{menu}", "en", None), (61, None, "en", None)]
    got = {r["doc_id"]: r for r in quality.quality_rules(documents(rows, extra=True), 0.1, 10).collect()}
    assert all(got[i]["kept"] and got[i]["n_left_words"] == 30 for i in range(30))
    assert not any(got[50 + i]["kept"] for i in range(3)) and got[60]["n_left_words"] == got[60]["n_words"]
    cleaned = {r["doc_id"]: r["text"] for r in quality.clean_documents(documents(rows), 0.1, 10).collect()}
    assert cleaned[3] == prose(3, 30) and cleaned[50] == " one more" and cleaned[60] == rows[33][1]
    assert quality.quality_rules(documents([])).collect() == []


def slow_quality(rows, share=quality.MAX_SHARE, least=quality.MIN_DOCUMENTS):
    """(doc_id, n_left_words, kept) of each row."""
    def lines_of(text):
        return [re.sub("[0-9]+", "0", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in " ".join(WORD.findall(line))))
                for line in (text or "").split("\n") if WORD.search(line)]

    holders, hosts = {}, {}
    for doc_id, text, _, source in rows:
        key = (doc_id, text or "") if doc_id is None else doc_id
        for line in lines_of(text):
            holders.setdefault((source, line), set()).add(key)
            hosts.setdefault(source, set()).add(key)
    out = []
    for doc_id, text, _, source in rows:
        n, *_, failed = slow_rules(text)
        gone = sum(len(line.split(" ")) for line in lines_of(text) if len(found := holders[source, line]) > least and len(found) > share * len(hosts[source]))
        out.append((doc_id, n - gone, not failed and n - gone >= 10 and n - gone >= quality.MIN_LEFT * n))
    return out


def quality_rows():
    menu, notice = "Home | About 7 | Contact us today for more of all these offers", "All rights of this site are kept by those who made it"
    rows = [(i, f"{prose(i, 30)}\n{menu}\n{prose(i + 1000, 12)}", "en", "site") for i in range(60)]
    rows += [(None, f"{prose(2000 + i, 25)}", "en", "site") for i in range(4)] + [(None, f"{notice}\n{menu}\n{i}", "en", "site") for i in range(4)]
    rows += [(70, prose(70, 20), "en", "site"), (70, f"{menu}\n{menu.upper()}\n one more", "en", "site"), (70, f"{menu}\n{menu.upper()}\n one more", "en", "site")]
    rows += [(71, f"{notice}\n{prose(71, 11)}", "en", None), *[(72, notice, "en", None)] * 9, (73, None, "en", None), (None, None, None, None), (None, "", "en", "site")]
    rows += [(80 + i, f"{prose(80 + i, 14)}\n{notice}" if i % 2 else f"{notice}\n{notice}", "en", "small") for i in range(7)]
    return rows + [(90 + i, f"{prose(5, 40)}\n{prose(6, 40)}", "en", "site") for i in range(9)]


def test_quality_against_counting(spark, documents):
    """At the registered limits, with ids that are null or repeated: also by the registered SQL."""
    rows = quality_rows()
    want = sorted(slow_quality(rows), key=repr)
    got = quality.quality_rules(documents(rows, extra=True)).select("doc_id", "n_left_words", "kept").collect()
    assert sorted(map(tuple, got), key=repr) == want
    assert any(left < slow_rules(t)[0] and not kept and not slow_rules(t)[-1] for (_, left, kept), (_, t, _, _) in zip(slow_quality(rows), rows))
    db = duckdb.connect()
    frame = documents(rows).toPandas()  # noqa: F841
    db.execute("CREATE TABLE documents AS SELECT CAST(doc_id AS BIGINT) AS doc_id, text, source FROM frame")
    assert sorted(db.sql(oracles.OP9).select("doc_id", "n_left_words", "kept").fetchall(), key=repr) == want


def test_cleaned_documents(documents):
    rows = quality_rows()
    cleaned = quality.clean_documents(documents(rows, extra=True))
    assert cleaned.columns == documents(rows, extra=True).columns
    left = sorted(((r["doc_id"], len(WORD.findall(r["text"] or "")), r["n_chars"] == (None if r["text"] is None else len(r["text"]))) for r in cleaned.collect()), key=repr)
    assert left == sorted(((d, n, True) for d, n, _ in slow_quality(rows)), key=repr)


# --- tokens ----------------------------------------------------------------------------------------


def test_codes_round_trip():
    rng = np.random.default_rng(0)
    for n in (0, 1, 3, 4, 5, 1000):
        ranks = rng.integers(0, 2 ** rng.integers(1, 32, n), dtype=np.uint32) if n else np.zeros(0, np.uint32)
        assert (tokens.decode_ranks(*tokens.encode_ranks(ranks), n) == ranks).all()


def test_tokens_are_the_librarys(spark, documents, odd_rows, tmp_path):
    rng = random.Random(5)
    letters = [chr(c) for c in [*range(0, 0x250), 0x2028, 0x3000, 0x4E2D, 0x1F600, 0x0301, 0x2163]] + list("  ''s'll t\n\n\t")
    rows = [(r[0], r[1]) for r in odd_rows] + [(20 + i, "".join(rng.choice(letters) for _ in range(80))) for i in range(200)]
    rows += [(300, "a<|endoftext|>b"), (-5, "it's two  blanks\n and\nlines "), (301, prose(4, 300))]
    folder = str(tmp_path / "tokens")
    tokens.write_tokens(documents(rows, extra=True), folder)
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {}
    for d, t in rows:
        ids.setdefault(d, []).append(np.array(library.encode(t or "", add_special_tokens=False).ids + [2], dtype="<u4"))
    got = tokens.token_index(spark, folder).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == sorted((d for d, _ in rows), key=lambda d: (d is not None, d or 0))
    start, seen = 0, {}
    for r in got:
        assert r["start"] == start
        start += r["n_tokens"]
        seen.setdefault(r["doc_id"], []).append((r["n_tokens"], r["ids_crc32"]))
    assert {d: sorted(v) for d, v in seen.items()} == {d: sorted((len(x), zlib.crc32(x.tobytes())) for x in v) for d, v in ids.items()}


class Counting:
    """A tokenizer that counts calls of the library, and the characters that it gets."""

    def __init__(self, inner):
        self.inner, self.model, self.calls, self.chars = inner, self, 0, 0

    def __getattr__(self, name):
        return getattr(self.inner, name)

    def _count(self, call, texts, *args, **options):
        self.calls, self.chars = self.calls + 1, self.chars + sum(map(len, texts))
        return call(*args, **options)

    def tokenize(self, piece):
        return self._count(self.inner.model.tokenize, [piece], piece)

    def encode(self, text, **options):
        return self._count(self.inner.encode, [text], text, **options)

    def encode_batch_fast(self, texts, **options):
        return self._count(self.inner.encode_batch_fast, texts, texts, **options)


def test_new_words_go_to_the_library_together_and_once():
    coder = tokens.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    coder.tokenizer = counting = Counting(library := coder.tokenizer)
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 9))) for _ in range(3000)]
    for mark in ".", ",", "!":  # one batch after the other
        texts = ["the " + " ".join(rng.choices(words, k=200)) + mark + "\n" + " ".join(words[k : k + 100]) + mark for k in range(0, 3000, 100)]
        ids, n = coder.encode(pa.array(texts))
        want = [library.encode(text, add_special_tokens=False).ids for text in texts]
        assert n.tolist() == list(map(len, want)) and ids.tolist() == [i for one in want for i in one]
    assert counting.calls < 300 and counting.chars < 4 * sum(map(len, words))


def test_ids_where_blanks_are_odd_and_little_is_remembered(monkeypatch):
    monkeypatch.setattr(tokens, "KNOWN", 100)
    monkeypatch.setattr(tokens, "AT_ONCE", 7)
    monkeypatch.setattr(tokens, "JOINED", 12)
    coder = tokens.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(4)
    parts = [" ", " ", "\n", "  ", "\t", "\r\n", " \n", "\xa0", "\u3000", "\u2028", "\x85", "\x1c", "a", "the", "It", "'s", "'ll", "é", "中文", "12", "²", "…", ".", "!!", " (", "_", "😀", "<|endoftext|>", "x" * 40]
    for _ in range(30):
        texts = [None, "", *("".join(rng.choices(parts, k=rng.randint(1, 30))) for _ in range(40))]
        ids, n = coder.encode(pa.array(["a", *texts]).slice(1))
        want = [coder.tokenizer.encode(text or "", add_special_tokens=False).ids for text in texts]
        assert n.tolist() == list(map(len, want)) and ids.tolist() == [i for one in want for i in one]
    assert len(coder.words) <= 100 and coder.encode(pa.array([], pa.string()))[0].size == 0


def test_no_documents(spark, documents, tmp_path):
    tokens.write_tokens(documents([]), str(tmp_path / "none"))
    assert tokens.token_index(spark, str(tmp_path / "none")).collect() == []
