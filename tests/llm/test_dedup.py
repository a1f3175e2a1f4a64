import hashlib
import random

import numpy as np
import pytest
import xxhash
from conftest import prose  # noqa: F401 - tests/llm/conftest.py

from logloom.llm import phrases, simhash
from logloom.llm.components import connected_components


def slow_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_groups(rows, distance=4):
    fps = [slow_fingerprint(text) for _, text in rows]
    least = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                a, b = least[i], least[j]
                least = [min(a, b) if x in (a, b) else x for x in least]
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if least[j] == least[i] and rows[j][0] is not None]
        out.append((doc_id, f"{fps[i]:016x}", min(ids) if ids else None))
    return sorted(out, key=repr)


def near_rows(n=120):
    rng, rows = random.Random(2), []
    base = prose(1, 400).split()
    for i in range(n):
        words = list(base) if i % 3 else prose(i, 60).split()
        for _ in range(rng.randint(0, 12) if i % 2 else 0):
            words[rng.randrange(len(words))] = f"w{rng.randrange(99)}"
        rows.append((i * 3, " ".join(words)))
    return rows


def found_groups(df):
    return sorted([tuple(r) for r in simhash.simhash_groups(df).collect()], key=repr)


def test_groups_against_all_pairs(documents):
    rows = near_rows()
    assert found_groups(documents(rows, extra=True)) == slow_groups(rows)


def test_odd_rows(documents, odd_rows):
    rows = [(r[0], r[1]) for r in odd_rows]
    assert found_groups(documents(odd_rows, extra=True)) == slow_groups(rows)


def test_empty(documents):
    df = documents([])
    assert found_groups(df) == []
    assert phrases.remove_repeats(df).collect() == []
    assert simhash.first_of_groups(df, simhash.simhash_groups(df)).collect() == []


@pytest.mark.parametrize("blocks", [6, 8])
def test_crowded_cells_are_split(spark, blocks):
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**63, 3, dtype=np.uint64)
    fps = {int(base[i % 3]) ^ sum(1 << int(b) for b in rng.integers(0, 63, int(rng.integers(0, 5)))) for i in range(1500)}
    fps |= {int(x) for x in rng.integers(0, 2**63, 300, dtype=np.uint64)}
    df = spark.createDataFrame([(fp,) for fp in fps], "fp long")
    got = connected_components(simhash.near_links(df, 4, blocks, unit=64))
    values = np.array(sorted(fps), dtype=np.uint64)
    label = np.arange(len(values))
    for i in range(len(values)):
        near = np.flatnonzero(np.bitwise_count(values ^ values[i]) <= 4)
        label[np.isin(label, label[near])] = label[near].min()
    want = {int(v): int(values[k]) for v, k in zip(values, label) if (label == k).sum() > 1}
    assert {r["node"]: r["component"] for r in got.collect()} == want


def test_manhattan_is_a_lower_bound():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**63, 5000, dtype=np.uint64)
    b = a ^ (rng.integers(0, 2**63, 5000, dtype=np.uint64) & rng.integers(0, 2**63, 5000, dtype=np.uint64))
    for segment in (1, 2, 4, 8):
        counts = lambda x: np.stack([np.bitwise_count((x >> np.uint64(s)) & np.uint64((1 << segment) - 1)) for s in range(0, 64, segment)]).astype(int)  # noqa: E731, B023
        manhattan = np.abs(counts(a) - counts(b)).sum(axis=0)
        assert (np.bitwise_count(simhash.embed(a, segment) ^ simhash.embed(b, segment)) == manhattan).all()
        assert (manhattan <= np.bitwise_count(a ^ b)).all()


def test_one_of_each_group_stays(documents, odd_rows):
    df = documents(odd_rows, extra=True)
    kept = simhash.first_of_groups(df, simhash.simhash_groups(df))
    assert kept.columns == df.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted({c for _, _, c in slow_groups([(r[0], r[1]) for r in odd_rows])}, key=repr)


def test_one_of_each_group_with_odd_ids(documents, odd_rows):
    rows = [*odd_rows, *[(None, prose(900 + i, 30), "en", "a") for i in range(6)], *[(None, prose(900, 30), "en", "a")] * 4, (7, prose(901, 30), "en", "b"), (5, prose(950, 40), "en", "b")]
    fps = [slow_fingerprint(r[1]) for r in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                group = [min(group[i], group[j]) if g in (group[i], group[j]) else g for g in group]
    kept = simhash.one_of_each_group(documents(rows, extra=True))
    assert kept.columns == documents(rows, extra=True).columns
    got = [tuple(r)[:2] for r in kept.collect()]
    assert len(got) == len(set(group)) and len(set(got)) == len(got)
    least = lambda g: min((r[0] is None, r[0] or 0) for r, own in zip(rows, group) if own == g)
    assert sorted((d is None, d or 0) for d, _ in got) == sorted(least(g) for g in set(group))
    texts = {g: {r[:2] for r, own in zip(rows, group) if own == g} for g in set(group)}
    assert all(sum(pair in own for pair in got) == 1 for own in texts.values())
    assert simhash.one_of_each_group(documents([])).collect() == []


def test_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001)], "a long, b long")
    got = {r["node"]: r["component"] for r in connected_components(edges).collect()}
    assert got == {**{i: 0 for i in range(301)}, 1000: 1000, 1001: 1000}


def slow_removal(rows, length=50):
    first = {}
    data = [(float("inf") if d is None else d, (t or "").encode()) for d, t in rows]
    for d, b in data:
        for i in range(len(b) - length + 1):
            s = b[i : i + length]
            first[s] = min(first.get(s, float("inf")), d)
    out = []
    for (doc_id, _), (d, b) in zip(rows, data):
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - length + 1):
            if first[b[i : i + length]] < d:
                gone[i : i + length] = True
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        out.append((doc_id, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def found_removal(df):
    return sorted([tuple(r) for r in phrases.remove_repeats(df).collect()], key=repr)


def repeat_rows():
    rng, rows = random.Random(8), []
    shared = [prose(100 + k, 30) for k in range(6)]
    for i in range(60):
        parts = [prose(i, rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            passage = rng.choice(shared)
            a = rng.randrange(0, 40)
            parts += [passage[a : a + rng.randint(45, 140)], prose(1000 + i, rng.randint(0, 5))]
        rows.append((rng.randrange(40), "".join(parts)))
    rows += [(50, "a" * 300), (51, "a" * 120), (52, "ab" * 60), (53, "é" * 49), (54, "é" * 30 + "b"), (55, "x" * 50), (56, "yx" + "x" * 49), (57, "x" * 49)]
    return rows


def test_removal_against_all_strings(documents, monkeypatch):
    rows = repeat_rows()
    want = slow_removal(rows)
    assert sum(r[2] > 0 for r in want) > 20
    assert found_removal(documents(rows, extra=True)) == want
    monkeypatch.setattr(phrases, "SHARD", 3)
    assert found_removal(documents(rows)) == want


def test_removal_of_odd_rows(documents, odd_rows):
    rows = [(r[0], r[1]) for r in odd_rows]
    assert found_removal(documents(odd_rows, extra=True)) == slow_removal(rows)


def test_long_texts_are_parsed_in_parts():
    from logloom.llm.parsing import all_phrases

    data = np.frombuffer(prose(3, 20_000).encode(), dtype=np.uint8)
    ends = np.array([10, 40_000, 40_030, len(data)])
    covered = lambda found: sorted(i for a, n in zip(found[0], found[1]) for i in range(a, a + n))
    assert covered(all_phrases(data, ends, most=7_001)) == covered(all_phrases(data, ends))


def test_equal_windows_have_one_key():
    from logloom.llm.parsing import GRAM, LENGTH, REACH, all_phrases

    words = [prose(k, 12, 3) for k in range(5)]
    rng = random.Random(2)
    data = " ".join(rng.choice(words) for _ in range(200)).encode()
    ends = np.array([30, 4_000, len(data)])
    at, n, keys = all_phrases(np.frombuffer(data, dtype=np.uint8), ends)
    key_of, bytes_of = {}, {}
    for a, m, key in zip(at.tolist(), n.tolist(), keys.tolist()):
        common = data[a + m - 1 : a + LENGTH]
        assert len(common) >= GRAM + REACH
        held = {common[i : i + GRAM + REACH] for i in range(len(common) - GRAM - REACH + 1)}
        bytes_of[key] = bytes_of.get(key, held) & held
        for i in range(m):
            assert key_of.setdefault(data[a + i : a + i + LENGTH], key) == key
    # What phrases of a key have in common is as long as the key's bytes.
    assert all(bytes_of.values())
    windows = {data[i : i + LENGTH] for b, e in ((30, 4_000), (4_000, len(data))) for i in range(b, e - LENGTH + 1)}
    assert set(key_of) == windows


def test_grams_in_common_are_no_candidates(documents):
    """Texts of words that all others have, in an order of their own, say little to the shards of keys."""
    rng = random.Random(3)
    words = [prose(k, 9)[:24] for k in range(300)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(40))) for i in range(30)] + [(99, prose(7, 60)), (100, prose(7, 60))]
    packs = phrases.pack_texts(documents(rows))
    answers = phrases.shared_keys(packs, 8).collect()
    marked = sum(int.from_bytes(r["shared"], "big").bit_count() for r in answers)
    pack = phrases.Pack(packs.first()["blob"]).phrases(8)
    assert 0 < marked < len(pack.firsts) / 10
    grams = {}
    for doc, text in rows[:30]:
        for i in range(len(text) - 15):
            grams.setdefault(text[i : i + 16], set()).add(doc)
    assert sum(len(d) > 1 for d in grams.values()) > len(grams) / 8


def test_removal_leaves_no_shuffles(spark, documents):
    import time

    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        files = manager.getAllFiles()
        return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}

    before = shuffles()
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(key)
    found = phrases.remove_repeats(documents(repeat_rows()))
    until = time.time() + 20
    while shuffles() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffles() - before
    assert spark.conf.get(key) == was
    assert sorted([tuple(r) for r in found.collect()], key=repr) == slow_removal(repeat_rows())
