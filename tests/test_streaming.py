import os
import random
from datetime import datetime
from pathlib import Path

import pytest
from model import assemble
from pyspark.sql import functions as F

from logloom.operators.enrich import add_customer, add_statics, load_registry, load_static_pairs
from logloom.operators.syslog import parse_syslog
from logloom.plans.scratch import children
from logloom.sources.lines import chunk_rows, read_chunk_stream, rising_suffix
from logloom.streaming.assemble import CarriedTables, assemble_to, read_events, run_batch
from logloom.streaming.jobs import BatchCounts, append_refreshed, append_to, count_stream_events, lookup_version, pinned


def put(folder: Path, stream: str, chunk: str, lines):
    (folder / stream).mkdir(parents=True, exist_ok=True)
    (folder / stream / chunk).write_text("".join(line + "\n" for line in lines))


def run(spark, source, out, per_batch=20, order_of=None, **options):
    chunks = read_chunk_stream(spark, f"{source}/*", per_batch, order_of=order_of)
    query = assemble_to(chunks, "#", str(out / "events"), str(out / "checkpoint"), "~", available_now=True, **options)
    query.awaitTermination()
    return query


def rows(spark, out):
    events = read_events(spark, str(out / "events"), str(out / "checkpoint"))
    return events.withColumn("stream", F.substring_index("stream", "/", -1)).orderBy("stream", "chunk", "pos").collect()


def bodies(spark, out):
    got = {}
    for row in rows(spark, out):
        assert row.status == "event"
        got.setdefault(row.stream, []).append(row.body)
    return got


def as_chunks(rng, streams, sizes=(1, 3, 10, 30)):
    """Files of the streams, (name, stream, lines), in order of their names."""
    chunks = []
    for name, lines in streams.items():
        at, number = 0, 0
        while at < len(lines):
            size = rng.choice(sizes)
            chunks.append((f"{number:03d}", name, lines[at : at + size]))
            at, number = at + size, number + 1
    return sorted(chunks, key=lambda chunk: chunk[:2])


def expected(streams):
    found = {name: [body for _, body in assemble(lines, "#", "~")[0]] for name, lines in streams.items()}
    return {name: events for name, events in found.items() if events}


def random_streams(seed, sizes):
    rng = random.Random(seed)
    streams = {f"s{i}": [rng.choice(["", "", "a", "b", "c#", "x#y"]) for _ in range(n)] for i, n in enumerate(sizes)}
    # One that never closes, one that closes once at its end.
    return rng, streams | {"open": ["x"] * 40, "once": ["y", ""] * 20 + ["z#"]}


@pytest.mark.parametrize("seed, sizes, every", [(5, (120, 120, 120), 50), (6, (600, 20, 5), 2)])
def test_stream_equals_batch_over_restarts(spark, tmp_path, seed, sizes, every):
    """Also with a hot stream, one that never closes, and positions that are written as a whole every second batch."""
    rng, streams = random_streams(seed, sizes)
    chunks = as_chunks(rng, streams)
    for i in range(3):
        for chunk, name, lines in chunks[len(chunks) * i // 3 : len(chunks) * (i + 1) // 3]:
            put(tmp_path / "in", name, chunk, lines)
        run(spark, tmp_path / "in", tmp_path / "out", 1000, snapshot_every=every)
    assert bodies(spark, tmp_path / "out") == expected(streams)


def test_open_lines_are_written_once(spark, tmp_path):
    """Lines of a stream that never closes are appended by the batch that reads them and not touched again."""
    folder = f"{tmp_path}/out/checkpoint/assembly"
    for i in range(4):
        put(tmp_path / "in", "open", f"{i}", [f"x{i}"] * 5)
        put(tmp_path / "in", "other", f"{i}", ["a", "b#"])
        run(spark, tmp_path / "in", tmp_path / "out")
    pieces = spark.read.parquet(f"{folder}/open")
    assert sorted((r.batch, r.chunk[-1], len(r.lines)) for r in pieces.collect()) == [(i, str(i), 5) for i in range(4)]
    put(tmp_path / "in", "open", "4", ["end#"])
    run(spark, tmp_path / "in", tmp_path / "out")
    assert bodies(spark, tmp_path / "out")["open"] == ["~".join([f"x{i}" for i in range(4) for _ in range(5)] + ["end#"])]


def test_old_folders_go(spark, tmp_path):
    streams = {"s": [f"{i}#" if i % 3 == 2 else f"{i}" for i in range(24)]}
    for i, line in enumerate(streams["s"]):
        put(tmp_path / "in", "s", f"{i:03d}", [line])
        os.utime(tmp_path / "in" / "s" / f"{i:03d}", (1000 + i, 1000 + i))  # files are admitted by time
    run(spark, tmp_path / "in", tmp_path / "out", 2, snapshot_every=3)
    assert bodies(spark, tmp_path / "out") == expected(streams)
    left = children(spark, f"{tmp_path}/out/checkpoint/assembly/positions")
    assert "batch=0" not in left and "batch=11" in left and len(left) <= 6


def batches_of(spark, tmp_path, chunks, parts):
    for i in range(parts):
        for chunk, name, lines in chunks[len(chunks) * i // parts : len(chunks) * (i + 1) // parts]:
            put(tmp_path / f"in{i}", name, chunk, lines)
        files = spark.read.text(f"{tmp_path}/in{i}/*", wholetext=True)
        yield i, chunk_rows(files, lambda file: F.element_at(F.split(file, "/"), -2)).withColumn("chunk", F.substring_index("chunk", "/", -1))


def test_replayed_batches_add_nothing(spark, tmp_path):
    rng, streams = random_streams(7, (90, 200))
    tables = CarriedTables(spark, f"{tmp_path}/out/checkpoint/assembly", 2)

    def write(events, batch):
        events.write.mode("overwrite").parquet(f"{tmp_path}/out/events/batch={batch}")

    def fail(events, batch):
        write(events, batch)
        raise OSError("lost")

    for i, batch in batches_of(spark, tmp_path, as_chunks(rng, streams), 5):
        with pytest.raises(OSError):
            run_batch(batch, i, tables, "#", fail, "~")
        if i:  # what was written before the failure does not show
            assert {row.batch for row in read_events(spark, f"{tmp_path}/out/events", f"{tmp_path}/out/checkpoint").select("batch").collect()} <= set(range(i))
        for _ in range(2):
            run_batch(batch, i, tables, "#", write, "~")
    assert bodies(spark, tmp_path / "out") == expected(streams)


def test_late_chunks(spark, tmp_path):
    for chunk, lines in (("2", ["a", "b#", "c"]), ("1", ["l#", "m#", "n"]), ("3", ["d", "e", "f"]), ("4", ["g#"])):
        put(tmp_path / "in", "s", chunk, lines)
        run(spark, tmp_path / "in", tmp_path / "out")
    got = {(row.body, row.status) for row in rows(spark, tmp_path / "out")}
    assert got == {("a~b#", "event"), ("l#", "late"), ("m#", "event"), ("n", "late"), ("c~d~e~f~g#", "event")}


def test_rolled_chunks_in_order(spark, tmp_path):
    for step in (range(1, 8), range(8, 13)):
        for i in step:
            put(tmp_path / "in", "s", f"log.{i}", [f"x{i}", "end#"] if i % 3 == 0 else [f"x{i}"])
        run(spark, tmp_path / "in", tmp_path / "out", order_of=rising_suffix)
    assert bodies(spark, tmp_path / "out") == {"s": ["x1~x2~x3~end#", "x4~x5~x6~end#", "x7~x8~x9~end#", "x10~x11~x12~end#"]}


def test_events_are_transformed(spark, tmp_path):
    put(tmp_path / "in", "s", "1", ["a#", "b#", "c"])
    run(spark, tmp_path / "in", tmp_path / "out", transform=lambda events: events.select("stream", F.upper("body").alias("body")))
    assert {row.body for row in read_events(spark, str(tmp_path / "out" / "events"), str(tmp_path / "out" / "checkpoint")).collect()} == {"A#", "B#"}
    with pytest.raises(FileNotFoundError):
        read_events(spark, str(tmp_path / "out" / "events"), str(tmp_path / "none"))
    with pytest.raises(ValueError):
        assemble_to(spark.readStream.text(str(tmp_path / "in" / "s")), "", "x", "y")


def test_counts_of_admitted_batches(spark, tmp_path):
    for i in range(1, 12):
        put(tmp_path / "in", "s", f"{i:02d}", ["a"] * i)
    chunks = read_chunk_stream(spark, f"{tmp_path / 'in'}/*", 4)
    events = count_stream_events(chunks.select(F.explode("lines").alias("body")), "lines")
    with BatchCounts(spark, f"{tmp_path}/counts", "lines"):
        append_to(events, f"{tmp_path}/events", f"{tmp_path}/checkpoint", available_now=True).awaitTermination()
    counts = spark.read.parquet(f"{tmp_path}/counts").orderBy("batch").collect()
    assert [row.input_rows for row in counts] == [4, 4, 3]
    assert sum(row.events_read for row in counts) == sum(range(12)) == spark.read.parquet(f"{tmp_path}/events").count()


@pytest.mark.parametrize("refresh", ["per_batch", "once"])
def test_registry_refresh(spark, tmp_path, refresh):
    path = tmp_path / "registry.txt"
    lookups = {"registry": lambda: load_registry(spark, str(path))}

    def enrich(batch, registry):
        return add_customer(batch.select(F.create_map(F.lit("host"), F.lit("h")).alias("headers"), "value"), registry)

    versions = set()
    for step, registry in enumerate(("one:h\n", "two:h\n", "three:h k\n")):
        path.write_text(registry)
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / str(step)).write_text("x\n")
        source = spark.readStream.text(str(tmp_path / "in"))
        append_refreshed(source, enrich, str(tmp_path / "out"), str(tmp_path / "cp"), True, lookups=lookups, refresh=refresh).awaitTermination()
        if refresh == "once":
            versions.add(lookup_version(pinned(spark, str(tmp_path / "cp"), "registry", lookups["registry"])))
    got = spark.read.parquet(str(tmp_path / "out")).orderBy("batch").select("headers.customer").collect()
    assert [row.customer for row in got] == (["one", "two", "three"] if refresh == "per_batch" else ["one"] * 3)
    if refresh == "once":
        path.write_text("one:h\n")
        assert versions == {lookup_version(load_registry(spark, str(path)))}
        path.write_text("two:h\n")
        assert versions != {lookup_version(load_registry(spark, str(path)))}
    with pytest.raises(ValueError):
        append_refreshed(source, enrich, str(tmp_path / "out"), str(tmp_path / "cp"), True, refresh="daily")


def test_lookups_on_a_stream(spark, tmp_path):
    """The batch functions for syslog, customers and static pairs take a streaming frame as it is."""
    (tmp_path / "registry").write_text("shop:web1\n")
    (tmp_path / "statics").write_text("dc=ams\nhost=no\n")
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a").write_text("Mar  1 11:23:24 web1 hello\nshort\n")
    lines = spark.readStream.text(str(tmp_path / "in"))
    events = lines.select(F.create_map(F.lit("host"), F.lit("WEB1.example.com")).alias("headers"), F.col("value").alias("body"))
    registry = load_registry(spark, str(tmp_path / "registry"))
    pairs = load_static_pairs(spark, str(tmp_path / "statics"))
    table = parse_syslog(add_statics(add_customer(events, registry), pairs), registry, datetime(2013, 3, 2))
    append_to(table, str(tmp_path / "out" / "events"), str(tmp_path / "out" / "cp"), available_now=True).awaitTermination()
    got = {row.original: (row.headers, row.message) for row in spark.read.parquet(str(tmp_path / "out" / "events")).collect()}
    assert got == {
        "Mar  1 11:23:24 web1 hello": ({"host": "web1", "customer": "shop", "dc": "ams"}, "hello"),
        "short": ({"host": "WEB1.example.com", "customer": "shop", "dc": "ams"}, ""),
    }
