import random

import pytest

from logloom.functions import headers as H
from logloom.operators.enrich import (
    add_customer, add_statics, first_bad_static, load_registry, load_static_pairs, registry_from_lines, static_pairs,
)
from logloom.sources.lines import number_lines
from pyspark.sql import functions as F

REGISTRY = "Blue Lake:pump7 valve9.plant.test Pump8\nnorth:gate3\n"


@pytest.fixture()
def registry(spark, tmp_path):
    path = tmp_path / "registry.txt"
    path.write_text(REGISTRY)
    return load_registry(spark, str(path))


def one_stream(spark, lines):
    return number_lines(spark.createDataFrame([("f", i, x) for i, x in enumerate(lines)], "stream string, pos bigint, line string"))


def events(spark, *headers):
    rows = [(i, h, "body") for i, h in enumerate(headers)]
    return spark.createDataFrame(rows, "id int, headers map<string,string>, body string")


def headers_of(df):
    return [row.headers for row in df.orderBy("id").collect()]


def test_registry_file(registry):
    assert {r.host: r.customer for r in registry.collect()} == {
        "pump7": "Blue Lake", "valve9": "Blue Lake", "pump8": "Blue Lake", "gate3": "north",
    }


@pytest.mark.parametrize(
    "lines, expected",
    [
        (["a:b:h1"], {"h1": "a:b"}),
        (["A b : H1.x.example"], {"h1": "A b "}),
        (["no colon"], {}),
        (["c:h1  h2"], {"h1": "c", "": "c", "h2": "c"}),
        (["c:"], {"": "c"}),
        (["c:\t h1\th2 \x01"], {"h1": "c", "h2": "c"}),
        (["c1:h1", "c2:h1"], {"h1": "c2"}),
        (["c1:h1.b h1.a", "c2:h2", "c3:h2 h1"], {"h1": "c3", "h2": "c3"}),
        (["a\u2028b:h1"], {}),
    ],
)
def test_registry_lines(spark, lines, expected):
    table = registry_from_lines(one_stream(spark, lines)).collect()
    assert {r.host: r.customer for r in table} == expected


def test_lookup(spark, registry):
    found = add_customer(
        events(
            spark, {"host": "gate3"}, {"host": "GATE3"}, {"host": "valve9.other.test"}, {"host": "nobody"}, None,
            {"host": "gate3", "customer": "x"},
        ),
        registry,
    )
    customers = [h["customer"] for h in headers_of(found)]
    assert customers == ["north", "north", "Blue Lake", "UNKNOWN", "UNKNOWN", "north"]
    assert found.columns == ["id", "headers", "body"]


def test_lookup_with_other_headers(spark, registry):
    found = add_customer(events(spark, {"h": "gate3"}), registry, customer_header="app", host_header="h")
    assert headers_of(found) == [{"h": "gate3", "app": "north"}]


def test_large_registry_needs_no_broadcast(spark, registry):
    many = events(spark, *[{"host": f"test{i % 5}"} for i in range(50)])
    small = headers_of(add_customer(many, registry))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert headers_of(add_customer(many, registry)) == small
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_small_registry_is_broadcast(spark, registry):
    plan = add_customer(events(spark, {"host": "bla"}), registry)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_missing_registry(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        load_registry(spark, str(tmp_path / "none"))
    empty = load_registry(spark, str(tmp_path / "none"), missing_ok=True)
    assert headers_of(add_customer(events(spark, {"host": "bla"}), empty)) == [{"host": "bla", "customer": "UNKNOWN"}]


STATICS = ["env=prod", "dc=ams", "dc=fra", "x=1=2", "bad", "late=1"]


@pytest.mark.parametrize(
    "preserve, expected",
    [(True, {"env": "test", "dc": "ams", "x": "1"}), (False, {"env": "prod", "dc": "fra", "x": "1"})],
)
def test_static_pairs(spark, tmp_path, preserve, expected):
    path = tmp_path / "statics.txt"
    path.write_text("\n".join(STATICS))
    merged = add_statics(events(spark, {"env": "test"}), load_static_pairs(spark, str(path)), preserve)
    assert headers_of(merged) == [expected]


def test_missing_statics(spark, tmp_path):
    pairs = load_static_pairs(spark, str(tmp_path / "none"))
    assert pairs is None
    assert headers_of(add_statics(events(spark, {"env": "test"}), pairs)) == [{"env": "test"}]


@pytest.mark.parametrize(
    "lines, pairs, bad",
    [
        (["a=1", "k=", "b=2"], [("a", "1")], 1),
        (["a=1", "", "b=2"], [("a", "1")], 1),
        (["k==v"], [("k", "")], None),
        (["=v"], [("", "v")], None),
        (["=", "a=1"], [], 0),
        (["k==", "a=1"], [], 0),
        (["a=1=", "b=2=="], [("a", "1"), ("b", "2")], None),
    ],
)
def test_static_lines(spark, lines, pairs, bad):
    frame = one_stream(spark, lines)
    assert [(r.key, r.value) for r in static_pairs(frame).orderBy("pos").collect()] == pairs
    stops = first_bad_static(frame).collect()
    assert [r.stop.pos for r in stops] == ([] if bad is None else [bad])


def read_statics(lines):
    pairs = []
    for line in lines:
        parts = line.split("=")
        while parts and parts[-1] == "":
            parts.pop()
        if len(parts) < 2:
            break
        pairs.append((parts[0], parts[1]))
    return pairs


def test_random_static_files(spark):
    rng = random.Random(17)
    files = {
        f"f{i}": ["".join(rng.choice("ab=") for _ in range(rng.randrange(1, 7))) + rng.choice(["=v", "=v", "=v", ""]) for _ in range(12)]
        for i in range(120)
    }
    rows = [(name, at, line) for name, lines in files.items() for at, line in enumerate(lines)]
    rng.shuffle(rows)
    frame = number_lines(spark.createDataFrame(rows, "stream string, pos bigint, line string"), 1, 2)
    got = {name: [] for name in files}
    for row in static_pairs(frame).orderBy("stream", "pos").collect():
        got[row.stream].append((row.key, row.value))
    assert got == {name: read_statics(lines) for name, lines in files.items()}


def test_no_pairs_at_all(spark):
    merged = add_statics(events(spark, {"env": "test"}), static_pairs(one_stream(spark, ["bad"])))
    assert headers_of(merged) == [{"env": "test"}]


def test_many_static_keys(spark):
    lines = one_stream(spark, [f"k{i}={i}" for i in range(12_000)])
    row = add_statics(events(spark, {"k5": "own"}), static_pairs(lines)).first()
    assert len(row.headers) == 12_000 and row.headers["k5"] == "own" and row.headers["k11999"] == "11999"


def test_header_functions(spark):
    h = F.col("headers")
    row = events(spark, {"a": "1"}).select(
        H.header_get(h, "a").alias("a"), H.header_get(h, "b").alias("b"), H.header_has(h, "b").alias("has"),
        H.header_put(h, "a", F.lit("2")).alias("put"), H.headers_text(H.header_put(h, "B", F.lit("x"))).alias("text"),
    ).first()
    assert (row.a, row.b, row.has, row.put, row.text) == ("1", None, False, {"a": "2"}, "B=x;a=1")
