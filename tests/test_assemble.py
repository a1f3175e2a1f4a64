import gzip
import os
import random
import re
import time

import pyarrow as pa
import pytest
from model import assemble
from pyspark.sql import functions as F

from logloom.operators.assemble import assemble_events, count_events, to_events, unterminated_lines
from logloom.sources.lines import _join_in_splits, falling_suffix, modification_order, number_lines, parent_directory, read_lines, rising_suffix

SMALL_CASES = {
    "leading blank is kept": (["", "a#"], ["~a#"]),
    "one separator dropped": (["a#", "", "b#"], ["a#", "b#"]),
    "only one dropped": (["a#", "", "", "b#"], ["a#", "~b#"]),
    "flag lives on": (["a#", "b1", "", "b2#"], ["a#", "b1~b2#"]),
    "first segment keeps inner blank": (["a1", "", "a2#"], ["a1~~a2#"]),
    "tail lost": (["a#", "b"], ["a#"]),
    "terminator inside a line": (["a#b", "c#"], ["a#b~c#"]),
    "no terminator": (["a", "b"], []),
    "lone terminator": (["x", "#", "", "#"], ["x~#", "#"]),
}


def as_lines(spark, streams, block_bits=14, part_bits=26):
    rows = [(key, pos, line) for key, lines in streams.items() for pos, line in enumerate(lines)]
    random.Random(7).shuffle(rows)
    return number_lines(spark.createDataFrame(rows, "stream string, pos bigint, line string"), block_bits, part_bits)


def bodies(events):
    out = {}
    for row in events.orderBy("stream", "part", "block", "pos").collect():
        out.setdefault(row.stream, []).append(row.body)
    return out


@pytest.mark.parametrize("block_bits", [0, 1, 14])
def test_small_cases(spark, block_bits):
    lines = as_lines(spark, {name: case for name, (case, _) in SMALL_CASES.items()}, block_bits, block_bits + 1)
    assert bodies(assemble_events(lines, "#", "~")) == {name: events for name, (_, events) in SMALL_CASES.items() if events}


def test_entry_of_many_lines_is_one_event(spark):
    rng = random.Random(23)
    short = "entry 0 |#]"
    long = ["entry 1", *[f"  detail {rng.randrange(1000)} of step {k}" for k in range(40)], "end of entry 1 |#]"]
    got = bodies(assemble_events(as_lines(spark, {"s": [short, "", *long, ""]}), "|#]"))
    assert got == {"s": [short, " § ".join(long)]}


@pytest.mark.parametrize("bits", [(2, 4), (3, 3), (14, 26)])
def test_random_streams_match_the_loop(spark, bits):
    rng = random.Random(11)
    streams = {
        f"s{i}": [rng.choice(["", "", "a", "b", "c#", "#", "x#y"]) for _ in range(rng.choice([1, 5, 60, 500]))]
        for i in range(25)
    }
    streams["never closed"] = ["x"] * 200
    lines = as_lines(spark, streams, *bits)
    expected = {key: assemble(value, "#", "~") for key, value in streams.items()}
    events = assemble_events(lines, "#", "~")
    got = {}
    for row in events.collect():
        got.setdefault(row.stream, []).append((row.pos, row.body))
    assert {k: sorted(v) for k, v in got.items()} == {k: e for k, (e, _) in expected.items() if e}
    left = {}
    for row in unterminated_lines(lines, "#").collect():
        left.setdefault(row.stream, []).append(row.pos)
    assert {k: sorted(v) for k, v in left.items()} == {k: rest for k, (_, rest) in expected.items() if rest}


def test_one_text_shuffle(spark):
    """All readers of the blocks share one scan and one shuffle of the text."""
    lines = as_lines(spark, {"s": ["a", "b#", "", "c"] * 50}, 2, 4)
    events = assemble_events(lines, "#")
    events.collect()
    plan = events._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("partial_collect_list(struct(pos") == 1 and "ReusedExchange" in plan
    assert plan.count("Scan ExistingRDD") == 1


def test_full_blocks_take_linear_time(spark):
    """Copying a block for each of its events would take minutes here."""
    lines = number_lines(spark.range(1 << 17).select(F.lit("s").alias("stream"), F.col("id").alias("pos"), F.lit("x#").alias("line")))
    start = time.monotonic()
    assert assemble_events(lines, "#").agg(F.sum("n_lines")).first()[0] == 1 << 17
    assert time.monotonic() - start < 60


def test_changing_source_loses_nothing(spark):
    """Blocks that differ each time they are computed are read once, so that pieces and their numbers agree."""
    lines = as_lines(spark, {"s": ["a", "b#", "c", "d#"] * 20}, 2, 4)
    anything = F.udf(lambda: random.SystemRandom().randrange(1 << 30), "bigint").asNondeterministic()
    shaky = lines.withColumn("block", F.col("block") + anything())
    events = assemble_events(shaky, "#", "~").collect()
    assert len(events) == 40 and all(row.body.endswith("#") and row.body.count("#") == 1 for row in events)


def test_files_over_many_splits(spark, tmp_path):
    rng = random.Random(3)
    expected = {}
    for name in ("a.log", "b.log", "c.log"):
        lines = [rng.choice(["", "line", "é more#", "#", "tail"]) for _ in range(400)]
        ending = rng.choice(["\n", "\r\n"])
        (tmp_path / name).write_text(ending.join(lines) + ending, encoding="utf-8", newline="")
        expected[name] = assemble(lines, "#", "~")[0]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        lines = read_lines(spark, str(tmp_path), block_bits=3)
        assert lines.select("part").distinct().count() > 9
        events = assemble_events(lines, "#", "~").orderBy("stream", "part", "block", "pos").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    got = {}
    for row in events:
        got.setdefault(row.stream.rsplit("/", 1)[1], []).append(row.body)
    assert got == {name: [body for _, body in events] for name, events in expected.items()}


def test_rolled_files_are_one_stream(spark, tmp_path):
    (tmp_path / "app").mkdir()
    (tmp_path / "app" / "log.1").write_text("a\nb#\n\nc\n")
    (tmp_path / "app" / "log.2").write_text("d#\n\n\ne#\n")
    lines = read_lines(spark, str(tmp_path / "app"), stream_of=parent_directory)
    events = assemble_events(lines, "#", "~").orderBy("part", "block", "pos").collect()
    assert [row.body for row in events] == ["a~b#", "c~d#", "~e#"]


@pytest.mark.parametrize("charset", ["UTF-8", "ISO-8859-1", "UTF-16LE", "UTF-16"])
def test_charsets(spark, tmp_path, charset):
    (tmp_path / "in.log").write_bytes("één\nregel § #\n\nnog een#\n".replace("§", "x").encode(charset))
    events = assemble_events(read_lines(spark, str(tmp_path), charset), "#", "~").orderBy("pos").collect()
    assert [row.body for row in events] == ["één~regel x #", "nog een#"]


def test_malformed_bytes_are_replaced(spark, tmp_path):
    (tmp_path / "in.log").write_bytes(b"a\xffb\n")
    assert read_lines(spark, str(tmp_path)).first().line == "a�b"
    assert read_lines(spark, str(tmp_path), "US-ASCII").first().line == "a�b"


def test_terminator_is_required(spark):
    lines = as_lines(spark, {"s": ["a"]})
    for bad in ("", None):
        with pytest.raises(ValueError):
            assemble_events(lines, bad)


def test_count_and_headers(spark):
    events = assemble_events(as_lines(spark, {"s": ["a#", "", "b", "c#", "d"]}), "#", "~")
    counted, seen = count_events(to_events(events, F.create_map(F.lit("host"), F.col("stream"))))
    rows = counted.collect()
    assert seen.get["events_read"] == 2
    assert {row.headers["host"] for row in rows} == {"s"}


@pytest.mark.parametrize("charset", ["UTF-8", "UTF-16LE"])
@pytest.mark.parametrize("order", [rising_suffix, falling_suffix, modification_order])
def test_rolled_files_in_time_order(spark, tmp_path, order, charset):
    names = [f"server.log.{i}" for i in range(1, 13)]
    names = (names[::-1] if order is falling_suffix else names) + ["server.log"]
    for i, name in enumerate(names):
        (tmp_path / name).write_bytes(f"x{i}\n{'end#' + chr(10) if i % 4 == 0 else ''}".encode(charset))
        os.utime(tmp_path / name, (1_000_000 + i, 1_000_000 + i))
    lines = read_lines(spark, str(tmp_path), charset, stream_of=parent_directory, order_of=order)
    got = [row.body for row in assemble_events(lines, "#", "~").orderBy("part", "block", "pos").collect()]
    assert got == ["x0~end#", "x1~x2~x3~x4~end#", "x5~x6~x7~x8~end#", "x9~x10~x11~x12~end#"]


WIDE = ["UTF-16LE", "UTF-16BE", "UTF-32LE", "UTF-32BE"]


@pytest.mark.parametrize("charset", WIDE)
def test_wide_charsets_in_splits(spark, tmp_path, charset):
    """Files cut into splits of a few characters, some with characters that hold the bytes of a newline, alone or together."""
    rng = random.Random(charset)
    wanted = {}
    for i, size in enumerate((0, 1, 2, 50, 400, 600, 500, 300)):
        alphabet = ["a", "é", "漢", "😀", "\n", "\n", "\r\n", "\r"] + ["\u0a05", "\u0100", "\u0a8a", "\u0a0a", "\u0a00", "\u010a", "\u6f0a", "\U0001040a"] * (3 * (i % 2))
        text = "".join(rng.choice(alphabet) for _ in range(size)) + ("\n" if i == 6 else "")
        (tmp_path / f"f{i}").write_bytes(text.encode(charset))
        lines = re.split("\r\n|\n|\r", text)
        wanted[f"f{i}"] = lines[:-1] if lines[-1] == "" else lines
    splits = spark.newSession()
    splits.conf.set("spark.sql.files.maxPartitionBytes", "97")
    splits.conf.set("spark.sql.files.openCostInBytes", "1")
    lines = read_lines(splits, str(tmp_path), charset)
    got = {}
    for row in lines.orderBy("stream", "part", "block", "pos").collect():
        got.setdefault(row.stream.rsplit("/", 1)[1], []).append(row.line)
    assert got == {name: lines for name, lines in wanted.items() if lines}
    assert lines.select("stream", "part", "block", "pos").distinct().count() == sum(map(len, wanted.values()))


@pytest.mark.parametrize("charset", WIDE)
def test_plain_wide_files_need_no_shuffle_of_text(spark, tmp_path, charset):
    (tmp_path / "in").write_bytes("one\ntwo\n\nthree".encode(charset))
    lines = read_lines(spark, str(tmp_path), charset)
    assert [row.line for row in lines.orderBy("part", "pos").collect()] == ["one", "two", "", "three"]
    assert "ArrowEvalPython" not in lines._jdf.queryExecution().executedPlan().toString()


def test_mixed_wide_files_are_read_four_times(spark, tmp_path):
    """For the places of their splits, for plain files, for lines inside of splits and for those at their edges."""
    (tmp_path / "in").write_bytes("one\nĊ漊ĀਅĀ\n\nthree".encode("UTF-16LE") * 20)
    splits = spark.newSession()
    splits.conf.set("spark.sql.files.maxPartitionBytes", "97")
    splits.conf.set("spark.sql.files.openCostInBytes", "1")
    counted = read_lines(splits, str(tmp_path), "UTF-16LE").groupBy("line").count()
    assert sum(row["count"] for row in counted.collect()) == 61
    final = counted._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("FileScan text") == 4


def test_only_edges_of_splits_are_joined_over_splits():
    """Pieces of UTF-16BE in two splits, the first one cut inside its third line; the second one's first cut is no newline."""
    names = ["file", "order", "start", "before", "closed", "piece", "ends"]
    first = [("f", "", 0, 0, True, piece, piece != b"\0c") for piece in (b"\0a\0", b"\0b\0", b"\0c")]
    second = [("f", "", 9, 12, True, piece, piece != b"x") for piece in (b"x", b"\0y\0", *[b"\0z\0"] * 50)]
    batch = pa.RecordBatch.from_pylist([dict(zip(names, row)) for row in first + second])

    def joined(edges):
        out = _join_in_splits(2, b"\n", edges)(iter([batch.slice(0, 2), batch.slice(2, 2), batch.slice(4)]))
        return [(row["start"], row["piece"], row["ended"], row["side"]) for found in out for row in found.to_pylist()]

    assert joined(True) == [(0, b"\0a\0", True, -1), (0, b"\0c", False, 1), (9, b"x\n\0y\0", True, -1)]
    assert joined(False) == [(0, b"\0b\0", True, 0)] + [(9, b"\0z\0", True, 0)] * 50


def test_text_is_read_once(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"f{i}").write_text("a\nb#\n" * 50)
    for frame in (assemble_events(read_lines(spark, str(tmp_path)), "#"), unterminated_lines(read_lines(spark, str(tmp_path)), "#")):
        frame.collect()
        plan = frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert len(re.findall("FileScan text", plan)) == 1
        assert "ReusedExchange" in plan


@pytest.mark.parametrize("order, names", [
    (rising_suffix, ["log.1", "log.2.gz", "log.10", "log.11.gz", "log"]),
    (rising_suffix, ["log-2023-12-31.gz", "log-2024-01-31", "log-2024-02-01.2.gz", "log-2024-02-01.10", "log-2024-02-01.gz", "log"]),
    (rising_suffix, ["server2.log.09", "server2.log.10.bz2", "server2.log.99999999999999999999998", "server2.log.99999999999999999999999.zst", "server2.log"]),
    (falling_suffix, ["log.100.gz", "log.12.gz", "log.11", "log.2.gz", "log.1", "log"]),
    (falling_suffix, ["server2.log.10.xz", "server2.log.9.xz", "server2.log.1", "server2.log"]),
])
def test_order_of_names(spark, order, names):
    shuffled = random.Random(1).sample(names, len(names))
    paths = spark.createDataFrame([(f"/logs/5/{name}",) for name in shuffled], "path string")
    got = [row.path.rsplit("/", 1)[1] for row in paths.orderBy(order(F.col("path"), F.lit(None))).collect()]
    assert got == names


def test_compressed_files_in_order(spark, tmp_path):
    names = [f"log.{i}.gz" for i in range(12, 1, -1)] + ["log.1", "log"]
    for i, name in enumerate(names):
        data = f"x{i}\n{'end#' + chr(10) if i % 4 == 0 else ''}".encode()
        (tmp_path / name).write_bytes(gzip.compress(data) if name.endswith("gz") else data)
    lines = read_lines(spark, str(tmp_path), stream_of=parent_directory, order_of=falling_suffix)
    got = [row.body for row in assemble_events(lines, "#", "~").orderBy("part", "block", "pos").collect()]
    assert got == ["x0~end#", "x1~x2~x3~x4~end#", "x5~x6~x7~x8~end#", "x9~x10~x11~x12~end#"]
