import random
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from logloom.functions.text import decode_bytes
from logloom.functions.times import add_syslog_time, readable_time
from logloom.operators.access_log import parse_access_log, typed_access_log
from logloom.operators.app_log import parse_app_log
from logloom.operators.enrich import registry_from_lines
from logloom.operators.events import string_events
from logloom.operators.rejects import count_rejects, rejects, with_event_time
from logloom.operators.syslog import parse_syslog
from logloom.schemas import ACCESS, ACCESS_FIELDS
from logloom.sources.lines import number_lines


def events(spark, rows, body="string"):
    return spark.createDataFrame(
        [(i, h, b) for i, (h, b) in enumerate(rows)], f"id int, headers map<string,string>, body {body}"
    )


def parsed(frame):
    return {row.original: row for row in frame.collect()}


REQUEST = dict(
    ip="203.0.113.9", identd="id7", user="maria", time="17/Sep/2021:04:05:59 +0230", method="PUT", uri="/cart/77", protocol="HTTP/2.0",
    statuscode=503, bytesSend="90411", referer="http://ref.test/start?x=1", useragent="robot/7 (test)", servername="shop.test",
    extraservername="alias.shop.test", timeSecond="12", timeMicro="4087", connectionstatus="X", connectiontype="image/png", sessioncookie="s5", bytesIn="88", bytesOut="1207")


def access_line(**changes):
    """A line of the access-log grammar from its fields."""
    f = REQUEST | changes
    return (f'{f["ip"]} {f["identd"]} {f["user"]} [{f["time"]}] "{f["method"]} {f["uri"]} {f["protocol"]}" {f["statuscode"]} {f["bytesSend"]} "{f["referer"]}" '
            f'"{f["useragent"]}" {f["servername"]} "{f["extraservername"]}" {f["timeSecond"]} {f["timeMicro"]} {f["connectionstatus"]} '
            f'"{f["connectiontype"]}" "{f["sessioncookie"]}" {f["bytesIn"]} {f["bytesOut"]}')


A1 = access_line()
A2 = access_line(bytesSend="-", timeSecond="3", timeMicro="640", bytesOut="15")


def test_access_log(spark):
    rows = parsed(parse_access_log(events(spark, [({"h": "1"}, A1), ({}, A2)])))
    row = rows[A1]
    assert [row[name] for name in ACCESS_FIELDS] == [REQUEST[name] for name in ACCESS_FIELDS]
    assert (row.parse_status, row.headers) == ("ok", {"h": "1"})
    assert (rows[A2].bytesSend, rows[A2].timeSecond, rows[A2].bytesOut) == ("-", "3", "15")


def test_access_log_edges(spark):
    no_flag = access_line(connectionstatus="")
    trailing = A1 + " more"
    control = access_line(uri="/ca\x01rt\"77")
    spaced = A1.replace('"s5" 88', '" s5  88')
    no_numbers = access_line(timeSecond="", timeMicro="", bytesIn="", bytesOut="")
    rows = parsed(parse_access_log(events(spark, [({}, x) for x in ("nope", no_flag, trailing, control, spaced, no_numbers, "")])))
    nope = rows["nope"]
    assert [nope[name] for name in ACCESS_FIELDS] == [0 if name == "statuscode" else "" for name in ACCESS_FIELDS]
    assert nope.parse_status == "no_match" and rows[trailing].parse_status == "no_match"
    assert rows[""].parse_status == "no_match"
    assert (rows[no_flag].connectionstatus, rows[no_flag].parse_status) == ("", "ok")
    assert rows[control].uri == '/ca\x01rt"77'
    assert rows[spaced].sessioncookie == " s5 " and rows[spaced].bytesIn == "88"
    assert [rows[no_numbers][x] for x in ("timeSecond", "timeMicro", "bytesIn", "bytesOut")] == [""] * 4


def test_access_log_types(spark):
    row = typed_access_log(parse_access_log(events(spark, [({}, A2)]))).first()
    assert row.event_time == datetime(2021, 9, 17, 1, 35, 59)
    assert (row.bytesSend, row.bytesOut, row.timeMicro) == (None, 15, 640)
    out = parse_access_log(events(spark, [({}, A2)])).drop("parse_status")
    assert [(f.name, f.dataType.typeName()) for f in out.schema] == [(f.name, f.dataType.typeName()) for f in ACCESS]
    assert not any(f.nullable for f in out.schema)


J1 = "[#|2021-09-17T04:05:59.041+0230|FINE|node-b|test.shop.Cart|_ThreadID=3;|Cart 77 has 4 items.|#]"
J1_TIME = datetime(2021, 9, 17, 1, 35, 59, 41000)


def test_app_log(spark):
    bodies = [
        J1, "", "plain", "x|rest", "x|bad|rest", "x|bad|INFO|rest", "x|bad|INFO|app|cls|thr|one|two|#]",
        J1.replace("items.", "items. § \tof two kinds § "),
    ]
    rows = parsed(parse_app_log(events(spark, [({"a": "b"}, b) for b in bodies])))
    row = rows[J1]
    assert row.asDict() == {
        "headers": {"a": "b"}, "original": J1, "timestamp": 1631842559041, "datetime": "2021-09-17 01:35:59",
        "loglevel": "FINE", "appservername": "node-b", "classname": "test.shop.Cart",
        "thread": "_ThreadID=3;", "message": "Cart 77 has 4 items.",
        "parse_status": "ok",
    }
    messages = [rows[b].message for b in bodies[1:7]]
    assert messages == ["", "plain", "rest", "rest", "rest", "one"]
    assert [rows[b].loglevel for b in bodies[1:7]] == ["", "", "", "", "INFO", "INFO"]
    assert [rows[b].thread for b in bodies[1:7]] == ["", "", "", "", "", "thr"]
    assert [rows[b].parse_status for b in bodies[1:7]] == ["no_match"] * 3 + ["bad_time"] * 3
    assert all(rows[b].timestamp == 0 and rows[b].datetime == "" for b in bodies[1:7])
    assert rows[bodies[7]].message.endswith("of two kinds § ")


def walk_pipes(body):
    """Fields of an application-log body, taken one by one from the left."""
    fields, rest = {}, body.partition("|")[2] if "|" in body else body
    for name in ("datetime", "loglevel", "appservername", "classname", "thread"):
        value, pipe, after = rest.partition("|")
        fields[name] = value if pipe else ""
        rest = after if pipe else rest
    return fields | {"datetime": "", "message": rest.partition("|")[0]}


def test_app_log_random_pipes(spark):
    rng = random.Random(13)
    bodies = {"".join(rng.choice("ab||# é") for _ in range(rng.randrange(24))) for _ in range(600)}
    rows = parsed(parse_app_log(events(spark, [({}, body) for body in bodies])))
    got = {body: {name: row[name] for name in walk_pipes("")} for body, row in rows.items()}
    assert got == {body: walk_pipes(body) for body in bodies}


APP_TIMES = {
    "2021-09-17T02:35:59.041+0100": 1631842559041,
    "2021-09-17T02:35:59.041+01:00": 1631842559041,
    "2021-09-17T02:35:59.041+01": 1631842559041,
    "2021-09-17T01:35:59.041Z": 1631842559041,
    "2013-3-1t10:23:50.7-0000": 1362133430700,
    "2021-09-17T02:35:59.041": 0,
    "2013-03-01T11:23:50+0100": 0,
    "2013-02-30T11:23:50.765+0100": 0,
    "2013-03-01T24:23:50.765+0100": 0,
    "2021-09-17 03:35:59.765+0100": 0,
    "2021-09-17T02:35:59.0411+0100": 0,
}


def test_app_log_times(spark):
    rows = parsed(parse_app_log(events(spark, [({}, f"[#|{text}|INFO|x") for text in APP_TIMES])))
    assert {text: rows[f"[#|{text}|INFO|x"].timestamp for text in APP_TIMES} == APP_TIMES
    assert all((row.datetime != "") == (row.timestamp != 0) for row in rows.values())


def test_app_log_message_to_last_marker(spark):
    bodies = ["a|bad|b|c|d|e|one|two|#]", "a|bad|b|c|d|e|one", "a|bad|b|c|d|e|x|#]y|#]", "a|rest"]
    rows = parsed(parse_app_log(events(spark, [({}, b) for b in bodies]), message_to_last_marker=True))
    assert [rows[b].message for b in bodies] == ["one|two", "one", "x|#]y", "rest"]


def test_times_do_not_depend_on_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    syslog = "Mar  1 11:23:24 h m"
    try:
        for zone in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            row = parse_app_log(events(spark, [({}, J1)]), display_tz="Europe/Amsterdam").first()
            assert (row.timestamp, row.datetime) == (1631842559041, "2021-09-17 03:35:59")
            row = parse_syslog(events(spark, [({}, syslog)]), registry(spark), datetime(2013, 3, 2)).first()
            assert (row.timestamp, row.datetime) == (1362137004000, "2013-03-01 11:23:24")
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def registry(spark):
    lines = [("f", 0, "north:gate3 pump7"), ("f", 1, "Blue Lake:valve9 long.plant.test")]
    return registry_from_lines(number_lines(spark.createDataFrame(lines, "stream string, pos bigint, line string")))


def test_syslog(spark):
    at, day = 1718413504000, "2024-06-15 01:05:04"
    stamp = "Jun 15 01:05:04"
    cases = [  # headers, body: time, host, headers after, message, status
        ({"host": "pump7"}, f"{stamp} valve9 dial: 7\\9 bar", at, "valve9", {"host": "valve9", "customer": "Blue Lake"}, "dial: 7\\9 bar", "ok"),
        ({}, f"{stamp} gate3 opened", at, "gate3", {"host": "gate3", "customer": "north"}, "opened", "ok"),
        ({}, f"{stamp} VALVE9 first\nsecond", at, "VALVE9", {"host": "VALVE9", "customer": "Blue Lake"}, "first\nsecond", "ok"),
        ({"host": "pump7"}, "words that begin without a time", 0, "", {"host": "pump7", "customer": "north"}, "words that begin without a time", "bad_time"),
        ({}, "other words without any time", 0, "", {"customer": "UNKNOWN"}, "other words without any time", "bad_time"),
        ({}, "", 0, "", {}, "", "too_short"),
        ({"host": "gate3"}, f"{stamp} alone", at, "", {"host": "gate3", "customer": "north"}, "alone", "ok"),
        ({"k": "v"}, stamp, at, "", {"k": "v", "customer": "UNKNOWN"}, "", "no_message"),
        ({"k": "v"}, stamp[:-1], 0, "", {"k": "v"}, "", "too_short"),
        ({}, f"{stamp} far.plant.test m", at, "far.plant.test", {"host": "far.plant.test", "customer": "UNKNOWN"}, "m", "ok"),
        ({"host": "GATE3"}, f"{stamp}  after two blanks", at, "", {"host": "", "customer": "UNKNOWN"}, "after two blanks", "ok"),
    ]
    got = parsed(parse_syslog(events(spark, [case[:2] for case in cases]), registry(spark), datetime(2024, 6, 20)))
    for _, body, time, host, headers, message, status in cases:
        row = got[body]
        wanted = (time, day if time else "", host, headers, message, status)
        assert (row.timestamp, row.datetime, row.hostname, row.headers, row.message, row.parse_status) == wanted


def test_syslog_short_host_lookup(spark):
    body = "Jun 15 01:05:04 LONG.plant.test m"
    row = parse_syslog(events(spark, [({}, body)]), registry(spark), datetime(2024, 6, 20), shorten_host=True).first()
    assert row.headers == {"host": "LONG.plant.test", "customer": "Blue Lake"}


YEARS = {  # clock: year of a March 1 by the reference rule and by the nearest rule
    "2013-03-02": (2013, 2013),
    "2013-02-15": (2013, 2013),
    "2013-01-20": (2012, 2013),
    "2013-04-15": (2014, 2013),
    "2013-12-31": (2014, 2014),
    "2013-09-05": (2014, 2014),
    "2013-08-20": (2014, 2013),
}


def test_year_repair(spark):
    rows = spark.createDataFrame([(clock, "Mar  1 00:00:00") for clock in YEARS], "clock string, text string")
    clock = F.col("clock").cast("timestamp_ntz")
    for at, rule in enumerate(("reference", "nearest")):
        timed = add_syslog_time(rows, F.col("text"), "ms", clock, rule)
        got = {r.clock: r.at for r in timed.select("clock", readable_time(F.col("ms")).alias("at")).collect()}
        assert got == {clock: f"{years[at]}-03-01 00:00:00" for clock, years in YEARS.items()}


def test_clock_as_column_or_datetime(spark):
    for moment in (datetime(2013, 4, 1), datetime(2013, 4, 1, 0, 0, 0, 1000), datetime(2013, 1, 31, 23, 59, 59)):
        one = spark.createDataFrame([("Mar  1 00:00:00",)], "text string")
        by_value = add_syslog_time(one, F.col("text"), "ms", moment)
        by_column = add_syslog_time(one, F.col("text"), "ms", F.lit(moment.isoformat()).cast("timestamp_ntz"))
        assert by_value.first().ms == by_column.first().ms


SYSLOG_TIMES = {
    "Feb 29 10:00:00": "2013-02-28 10:00:00", "Feb 30 10:00:00": None, "FEB 28 10:00:00": "2013-02-28 10:00:00",
    "Mar  0 10:00:00": None, "Mar  1 24:00:00": None, "Mar  1 10:60:00": None, "Foo  1 10:00:00": None,
    "June 1 10:00:00": "2012-06-01 10:00:00", "Mar-01 10:00:00": None, "Mar  1 10:00:00": "2013-03-01 10:00:00",
}


def test_syslog_times(spark):
    rows = spark.createDataFrame([(text,) for text in SYSLOG_TIMES], "text string")
    timed = add_syslog_time(rows, F.col("text"), "ms", datetime(2013, 3, 2))
    got = timed.select("text", readable_time(F.col("ms")).alias("at")).collect()
    assert {r.text: r.at for r in got} == SYSLOG_TIMES


def test_string_events(spark):
    frame = events(spark, [({"a": "b"}, "é".encode()), ({}, b"a\xffb"), ({}, b"")], "binary")
    assert {r.body for r in string_events(frame).collect()} == {"é", "a�b", ""}
    assert string_events(frame).columns == ["headers", "body"]


def test_bytes_parse_like_text(spark):
    row = parse_app_log(events(spark, [({}, J1.encode())], "binary")).first()
    assert row.timestamp == 1631842559041


def test_rejects(spark):
    counted, seen = count_rejects(parse_app_log(events(spark, [({}, J1), ({}, "x|bad|rest"), ({}, "plain")])))
    assert {r.original for r in rejects(counted).collect()} == {"x|bad|rest", "plain"}
    assert (seen.get["rows"], seen.get["rejects"]) == (3, 2)
    times = {r.original: r.event_time for r in with_event_time(counted).collect()}
    assert times == {J1: J1_TIME, "x|bad|rest": None, "plain": None}


@pytest.mark.parametrize("zone", ["UTC", "Pacific/Kiritimati", "America/Los_Angeles"])
def test_a_stream_goes_by_its_own_clock(spark, tmp_path, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        day = datetime.now(timezone.utc)
        stamp = f"{day:%b} {day.day:2d} 00:00:00"
        spark.createDataFrame([(stamp,)], "text string").write.parquet(str(tmp_path / "in"))
        stream = add_syslog_time(spark.readStream.schema("text string").parquet(str(tmp_path / "in")), F.col("text"), "at")
        query = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(str(tmp_path / "out"))
        query.awaitTermination()
        midnight = datetime(day.year, day.month, day.day, tzinfo=timezone.utc)
        assert [row["at"] for row in spark.read.parquet(str(tmp_path / "out")).collect()] == [int(midnight.timestamp() * 1000)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_other_charsets(spark):
    cases = [("windows-1252", "“€”é"), ("ISO-8859-15", "€ž"), ("Shift_JIS", "日本"), ("UTF-16", "aé日"), ("UTF-16LE", "aé日"), ("US-ASCII", "abc")]
    for charset, text in cases:
        df = spark.createDataFrame([(text.encode(charset),), (b"\x81\xff\xfe",), (None,)], "b binary")
        got = [row[0] for row in df.select(decode_bytes(F.col("b"), charset)).collect()]
        assert got[0] == text and got[2] is None and isinstance(got[1], str)


@pytest.mark.parametrize("charset", ["UTF-16LE", "UTF-16BE", "UTF-32LE", "UTF-32BE", "UTF-16", "UTF-32", "windows-1252", "KOI8-R", "cp037", "US-ASCII", "latin1"])
def test_decoding_against_codecs(spark, charset):
    """Well-formed, cut short and random bytes; no Python in the plan."""
    rng = random.Random(1)
    values = [b"", b"\xff\xfe", b"\xfe\xff\x00a", b"\xff\xfea\x00", b"\xff\xfe\x00\x00a\x00\x00\x00", b"\x00\x00\xfe\xff\x00\x00\x00a"]
    for text in ("héllo 漢字 😀\n", "\ufeffx", "a😀b"):
        for other in ("utf-16-le", "utf-16-be", "utf-32-le", "utf-32-be"):
            data = text.encode(other)
            values += [data, data[:-1], data[1:], data[:3] + data[4:]]
    values += [bytes(rng.choice([0, 0, 0, 0xD8, 0xDC, 0xDF, 0x41, 0x0A, rng.randrange(256)]) for _ in range(rng.randint(0, 17))) for _ in range(300)]
    values.append("x😀".encode("utf-16-le") * 100_000)
    decoded = spark.createDataFrame([(i, bytearray(value)) for i, value in enumerate(values)], "i int, b binary").select("i", decode_bytes(F.col("b"), charset).alias("s"))
    assert "ArrowEvalPython" not in decoded._jdf.queryExecution().executedPlan().toString()
    for row in decoded.collect():
        assert row.s == values[row.i].decode(charset, "replace")


def test_access_fields_are_parsed_on_demand(spark):
    events = spark.createDataFrame([({"a": "b"}, "nope")], "headers map<string,string>, body string")

    def plan(df):
        df.collect()
        return df._jdf.queryExecution().optimizedPlan().toString()

    parsed = parse_access_log(events)
    assert "regexp_replace" not in plan(parsed.select("headers")) and "regexp_replace" not in plan(parsed.agg(F.count(F.lit(1))))
    # Once for each of the two breaks, however many fields are read and filtered by.
    for df in (parsed, parsed.where("statuscode > 1 AND method = 'GET' AND parse_status = 'ok'").select("ip", "uri")):
        assert plan(df).count("regexp_replace(") == 2
