import json
import re
from datetime import datetime

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from logloom.operators.access_log import parse_access_log
from logloom.operators.app_log import parse_app_log
from logloom.plans.tables import access_log_table, app_log_table, syslog_table
from logloom.schemas import TABLES, avro_schema
from logloom.sinks.avro import _blocks, _decoded, read_avro, write_avro
from logloom.sinks.tables import read_good, read_rejects, read_table, stream_table, write_table, write_with_rejects

BODIES = ["[#|2021-09-17T04:05:59.041+0230|FINE|s|c|t|one|#]", "plain", "", "x|bad|INFO|rest"]


def app_rows(spark):
    rows = [({"customer": f"c{i % 2}"} if i < 3 else {}, body) for i, body in enumerate(BODIES)]
    return parse_app_log(spark.createDataFrame(rows, "headers map<string,string>, body string"))


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
def test_write_and_read_back(spark, tmp_path, fmt):
    table = app_rows(spark)
    assert write_table(table, str(tmp_path / "t"), "app", fmt, sync_interval=4096) == fmt
    back = read_table(spark, str(tmp_path / "t"), "app", fmt)
    assert back.columns == TABLES["app"][1].names
    key = F.col("original")
    assert back.orderBy(key).collect() == table.drop("parse_status").orderBy(key).collect()


def test_by_customer_reads_one_directory(spark, tmp_path):
    path = str(tmp_path / "t")
    fmt = write_table(app_rows(spark), path, "app", "parquet", by_customer=True)
    one = read_table(spark, path, "app", fmt, by_customer=True).where("customer = 'c1'")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*customer", plan)
    assert [row.original for row in one.collect()] == ["plain"]
    names = read_table(spark, path, "app", fmt, by_customer=True).groupBy("customer").count().collect()
    assert {row.customer: row["count"] for row in names} == {"c0": 2, "c1": 1, "UNKNOWN": 1}


def test_format_without_avro(spark, tmp_path):
    assert write_table(app_rows(spark), str(tmp_path / "d"), "app") == "parquet"
    assert read_table(spark, str(tmp_path / "d"), "app").count() == len(BODIES)
    with pytest.raises(ValueError):
        stream_table(app_rows(spark), str(tmp_path / "s"), "nothing", str(tmp_path / "c"))


def test_avro_schema_has_no_unions():
    for kind, (name, schema) in TABLES.items():
        record = json.loads(avro_schema(kind, "com.example"))
        assert (record["name"], record["namespace"]) == (name, "com.example")
        assert [field["name"] for field in record["fields"]] == schema.names
        assert {str(field["type"]) for field in record["fields"]} <= {"string", "int", "long", str({"type": "map", "values": "string"})}


def test_unknown_kind(spark, tmp_path):
    with pytest.raises(ValueError):
        write_table(app_rows(spark), str(tmp_path / "t"), "other")


def test_streaming_sink(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a").write_text("nope\n")
    lines = spark.readStream.text(str(tmp_path / "in"))
    events = lines.select(F.create_map(F.lit("customer"), F.lit("x")).alias("headers"), F.col("value").alias("body"))
    query = stream_table(
        parse_access_log(events), str(tmp_path / "t"), "access", str(tmp_path / "cp"), "parquet", by_customer=True, available_now=True
    )
    query.awaitTermination()
    back = read_table(spark, str(tmp_path / "t"), "access", "parquet", by_customer=True).collect()
    assert [(row.original, row.statuscode, row.customer) for row in back] == [("nope", 0, "x")]


def test_tables_from_files(spark, tmp_path):
    registry = tmp_path / "registry"
    registry.write_text("shop:web1 web2\n")
    statics = tmp_path / "statics"
    statics.write_text("dc=ams\n")
    logs = tmp_path / "logs"
    for host in ("web1.example.com", "db"):
        (logs / host).mkdir(parents=True)
        (logs / host / "server.log").write_text("[#|2013-03-01T11:23:50.765+0100|INFO|s|c|t|one\n\tat x\n|#]\n\nx|#]\nlost\n")
    host_of = lambda file: F.element_at(F.split(file, "/"), -2)
    table = app_log_table(spark, str(logs / "*"), str(registry), str(statics), host_of=host_of)
    got = {(row.headers["host"], row.headers["customer"], row.headers["dc"], row.message) for row in table.collect()}
    assert got == {
        (host, customer, "ams", message)
        for host, customer in (("web1.example.com", "shop"), ("db", "UNKNOWN"))
        for message in ("one § \tat x § ", "#]")
    }
    (tmp_path / "sys").write_text("Mar  1 11:23:24 web2 hello\n")
    row = syslog_table(spark, str(tmp_path / "sys"), str(registry), as_of=datetime(2013, 3, 2)).first()
    assert (row.headers, row.message) == ({"host": "web2", "customer": "shop"}, "hello")
    assert access_log_table(spark, str(tmp_path / "sys")).first().parse_status == "no_match"


def test_customer_without_a_name(spark, tmp_path):
    rows = parse_app_log(spark.createDataFrame([({"customer": ""}, "one"), ({}, "two")], "headers map<string,string>, body string"))
    write_table(rows, str(tmp_path / "t"), "app", by_customer=True)
    back = read_table(spark, str(tmp_path / "t"), "app", by_customer=True)
    assert [row.original for row in back.where("customer = ''").collect()] == ["one"]
    assert {row.customer for row in back.select("customer").collect()} == {"", "UNKNOWN"}


def test_names_that_directories_treat_otherwise(spark, tmp_path):
    names = ["", "__EMPTY__", "__EMPTY____EMPTY__", "__HIVE_DEFAULT_PARTITION__", "a/b=c %", "UNKNOWN", "__EMPTY", " "]
    events = spark.createDataFrame([({"customer": name}, f"body {i}") for i, name in enumerate(names)], "headers map<string,string>, body string")
    write_table(parse_app_log(events), str(tmp_path / "t"), "app", by_customer=True)
    back = read_table(spark, str(tmp_path / "t"), "app", by_customer=True)
    assert {row.original: row.customer for row in back.collect()} == {f"body {i}": name for i, name in enumerate(names)}
    for i, name in enumerate(names):
        assert [row.original for row in back.where(F.col("customer") == name).collect()] == [f"body {i}"]


def test_streamed_files_by_customer(spark, tmp_path):
    """Rows are gathered by customer before they are written; a hot customer is split over tasks."""
    source = tmp_path / "in"
    source.mkdir()
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100000")
    try:
        for batch in range(2):
            spark.range(6000).selectExpr(f"concat(if(id % 3 = 0, 'hot', concat('c', id % 30)), '|', sha2(string(id + {batch * 6000}), 256)) AS value").repartition(8).write.mode("append").text(str(source))
            lines = spark.readStream.text(str(source))
            customer = F.substring_index("value", "|", 1)
            events = lines.select(F.create_map(F.lit("customer"), customer).alias("headers"), F.col("value").alias("body"))
            for _ in range(2):  # the second run finds nothing new
                stream_table(parse_app_log(events), str(tmp_path / "t"), "app", str(tmp_path / "cp"), by_customer=True, available_now=True).awaitTermination()
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    assert read_table(spark, str(tmp_path / "t"), "app", by_customer=True).count() == 12000
    for batch in range(2):
        files = {folder.name: len(list(folder.glob("part-*"))) for folder in (tmp_path / "t" / f"batch={batch}").iterdir() if folder.is_dir()}
        assert len(files) == 31 - 10 and files["customer=hot"] > 1
        # Eight tasks with all customers each would write 168 files.
        assert sum(files.values()) < 3 * len(files) and max(files.values()) == files["customer=hot"]


def test_rejects_in_one_pass(spark, tmp_path):
    events = spark.createDataFrame([({}, "nope"), ({}, "")], "headers map<string,string>, body string")
    for mode in ("overwrite", "append"):
        counts = write_with_rejects(app_rows(spark), str(tmp_path / "t"), "app", mode)
        assert counts == {"ok": 1, "bad_time": 1, "no_match": 2, "rows": 4}
    good, bad = read_good(spark, str(tmp_path / "t"), "app"), read_rejects(spark, str(tmp_path / "t"), "app")
    assert good.columns == TABLES["app"][1].names and [row.original for row in good.collect()] == [BODIES[0]] * 2
    assert sorted((row.original, row.parse_status) for row in bad.collect()) == sorted([("plain", "no_match"), ("", "no_match"), ("x|bad|INFO|rest", "bad_time")] * 2)
    assert re.search(r"PartitionFilters: \[[^\]]*parse_status", good._jdf.queryExecution().executedPlan().toString())
    assert write_with_rejects(parse_access_log(events), str(tmp_path / "a"), "access") == {"ok": 0, "no_match": 2, "rows": 2}
    assert read_good(spark, str(tmp_path / "a"), "access").count() == 0
    with pytest.raises(ValueError):
        write_with_rejects(events, str(tmp_path / "b"), "event")


def decoded(data):
    """Blocks of a container file by the letter of the format: (schema, codec, marker, [(count, bytes of records)])."""
    at = 4

    def number():
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value, shift = value | (byte & 127) << shift, shift + 7
            if byte < 128:
                return (value >> 1) ^ -(value & 1)

    def text():
        nonlocal at
        size = number()
        at += size
        return data[at - size : at]

    assert data[:4] == b"Obj\x01"
    n = number()
    header = {text(): text() for _ in range(n)}
    assert number() == 0
    marker, blocks = data[at : at + 16], []
    at += 16
    while at < len(data):
        blocks.append((number(), text()))
        assert data[at : at + 16] == marker
        at += 16
    return json.loads(header[b"avro.schema"]), header[b"avro.codec"].decode(), marker, blocks


ODD_TEXTS = ["", "é漢😀", "\n\r\0", "x" * 63, "x" * 64, "y" * 8191, "y" * 8192, "z" * 1_100_000, "Obj\x01"]


@pytest.mark.parametrize("codec", ["null", "deflate"])
def test_containers(spark, tmp_path, codec):
    numbers = [0, -1, 1, 63, 64, -64, -65, 2**31 - 1, 2**62, -(2**63), 2**63 - 1]
    rows = [({f"k{j}": ODD_TEXTS[j] for j in range(i % 7)}, text, numbers[i % 11], *[f"f{i}"] * 6) for i, text in enumerate(ODD_TEXTS * 12)]
    table = spark.createDataFrame(rows, TABLES["app"][1]).repartition(3)
    path = tmp_path / "t"
    for _ in range(2):
        write_avro(table, str(path), "app", namespace="com.example", sync_interval=1000, codec=codec)
    back = read_avro(spark, str(path), "app")
    assert back.schema == TABLES["app"][1]
    key = lambda row: repr(sorted(row["headers"].items())) + repr(row[1:])
    assert sorted(back.collect(), key=key) == sorted(table.collect() * 2, key=key)
    markers, n = set(), 0
    for file in path.glob("part-*"):
        schema, name, marker, blocks = decoded(file.read_bytes())
        assert schema == json.loads(avro_schema("app", "com.example")) and name == codec
        markers.add(marker)
        n += sum(count for count, _ in blocks)
        if codec == "null":  # closed by the record that reaches the interval
            assert all(len(data) >= 1000 for _, data in blocks[:-1]) and all(count == 1 or len(data) < 2_300_000 for count, data in blocks)
    assert len(markers) == 1 and n == 2 * len(rows)
    write_avro(table.limit(1), str(path), "app", "overwrite")
    assert read_avro(spark, str(path), "app").count() == 1


def test_containers_in_splits_and_by_name(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    table = parse_app_log(spark.createDataFrame([({"customer": "c"}, f"x|y|{i}") for i in range(5000)], "headers map<string,string>, body string")).coalesce(1)
    assert write_table(table, path, "app", "avro", sync_interval=500) == "avro"
    splits = spark.newSession()
    splits.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    splits.conf.set("spark.sql.files.openCostInBytes", "1")
    back = read_table(splits, path, "app", "avro")
    assert back.rdd.getNumPartitions() > 20 and back.select("original").distinct().count() == back.count() == 5000
    # A reader of another kind takes the fields it knows; the others have their defaults.
    other = read_table(spark, path, "syslog", "avro").where("original = 'x|y|7'").collect()
    assert [(row.headers, row.message, row.hostname) for row in other] == [({"customer": "c"}, "7", "")]
    assert read_table(spark, path, "access", "avro").where("statuscode <> 0 OR ip <> ''").count() == 0
    small, large = tmp_path / "small", tmp_path / "large"
    for folder, interval in ((small, 300), (large, 30_000)):
        write_table(table, str(folder), "app", "avro", sync_interval=interval)
    counts = [len(decoded(next(folder.glob("part-*")).read_bytes())[3]) for folder in (small, large)]
    assert counts[0] > 50 * counts[1]


def test_empty_and_refused_containers(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(app_rows(spark).where("false"), path, "app", "avro")
    assert read_table(spark, path, "app", "avro").collect() == []
    with pytest.raises(FileNotFoundError):
        read_table(spark, str(tmp_path / "none"), "app", "avro")
    for options in ({"codec": "snappy"}, {"mode": "ignore"}):
        with pytest.raises(ValueError):
            write_avro(app_rows(spark), path, "app", **options)
    with pytest.raises(ValueError):
        write_table(app_rows(spark), path, "app", "avro", by_customer=True)
    # A text that holds the table's marker is refused when read, not read wrongly.
    marker = spark.read.text(f"{path}/_sync_marker").first()[0]
    write_table(parse_app_log(spark.createDataFrame([({}, f"a {marker} b")], "headers map<string,string>, body string")), path, "app", "avro")
    with pytest.raises(Exception, match="container"):
        read_table(spark, path, "app", "avro").collect()


def test_small_blocks_pass_in_large_batches():
    """Batches between Spark and Python are as many as the bytes call for, however small the blocks."""
    records = [bytes([0, 4]) + b"%02d" % (i % 100) for i in range(500)]
    given = [pa.RecordBatch.from_pydict({"record": pa.array(part, pa.binary())}) for part in (records[:123], records[123:])]
    written = list(_blocks(b"header", "null", 10)(iter(given)))
    assert len(written) == 1
    header, *blocks = written[0].column(0).to_pylist()
    assert header == b"header" and len(blocks) > 100
    batch = pa.RecordBatch.from_pydict({"block": pa.array(blocks, pa.binary())})
    read = list(_decoded([("headers", "map"), ("body", "string")], ["headers", "body"], "null")(iter([batch])))
    assert [row for found in read for row in found.to_pylist()] == [{"headers": [], "body": "%02d" % (i % 100)} for i in range(500)]
    assert len(read) == 1
