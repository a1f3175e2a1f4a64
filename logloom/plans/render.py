"""Raw log text rendered from the analytic test tables, which hold no logs themselves.

Every rendering covers its whole table. Some rows are rendered malformed on purpose, chosen by their id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.sources.lines import BLOCK_BITS, number_lines

DOC_PART_BITS = 6  # documents in a part of a lines frame, as a power of two


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table as a stream, be it one file or a folder of files."""
    # As a pattern: a plain path of a stream has to be a folder, and a filter on names would be one on the files inside it.
    return spark.readStream.schema(table(spark, sf_dir, name).schema).parquet(f"{sf_dir}/{{{name}}}.parquet")


def text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def doc_line_array(blanks: int = 1) -> Column:
    """Lines of a document's text with that many empty lines between two lines."""
    return F.split(F.replace("text", F.lit("\n"), F.lit("\n" * (blanks + 1))), "\n", -1)


def doc_lines(spark: SparkSession, sf_dir: str, blanks: int = 1, stream: str = "source") -> DataFrame:
    """All documents of a source as one stream, in document order (or each as its own, by ``doc_id``).

    A line's place is its document (``block.doc_id``) and its number in it (``pos``).
    """
    docs = table(spark, sf_dir, "documents").select(
        F.col(stream).alias("stream"), "doc_id", F.posexplode(doc_line_array(blanks)).alias("i", "line")
    )
    pos = F.col("i").cast("bigint")
    return docs.select(
        "stream",
        F.shiftright("doc_id", DOC_PART_BITS).alias("part"),
        F.struct("doc_id", F.shiftright(pos, BLOCK_BITS).alias("block")).alias("block"),
        pos.alias("pos"),
        "line",
    )


def doc_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One text per document: a title event, then its lines as one event, terminated by ``|#]``."""
    body = F.replace("text", F.lit("\n"), F.lit("\n\n"))
    return table(spark, sf_dir, "documents").select(text("document ", F.col("doc_id"), " |#]\n", body, "\n|#]").alias("value"))


def doc_chunks(docs: DataFrame) -> DataFrame:
    """Each document as one log chunk of its source."""
    return docs.select(
        F.col("source").alias("stream"),
        F.lpad(F.col("doc_id").cast("string"), 18, "0").alias("chunk"),
        doc_line_array().alias("lines"),
    )


def supplier_registry_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry lines from all suppliers, with hosts listed several times and some lines without a colon."""
    key = F.col("s_suppkey")
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    entry = text(
        F.col("n_name"), ":", key % 3, ":  ", F.col("s_name"), ".example.com Host", key % 40, "\th", key % 7, ".a.b "
    )
    line = F.when(key % 11 == 5, text("no entry ", F.col("s_name"))).otherwise(entry)
    rows = table(spark, sf_dir, "supplier").join(nation, "s_nationkey", "left")
    return number_lines(rows.select(F.lit("registry").alias("stream"), key.cast("bigint").alias("pos"), line.alias("line")))


def nation_registry_lines(spark: SparkSession, sf_dir: str, prefix: str = "") -> DataFrame:
    """Registry lines ``region:nation.example.com nation-b`` for all nations."""
    region = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    rows = table(spark, sf_dir, "nation").join(region, "n_regionkey")
    line = text(prefix, F.col("r_name"), ":", F.col("n_name"), ".example.com ", F.col("n_name"), "-b")
    return number_lines(rows.select(F.lit("registry").alias("stream"), F.col("n_nationkey").cast("bigint").alias("pos"), line.alias("line")))


def event_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events with headers: a host on most (full name on even ids), an old customer on some."""
    key = F.col("event_id")
    host = text("Nation_", F.col("user_id") % 30, F.when(key % 2 == 0, ".example.com").otherwise(""))
    old = F.when(key % 5 == 0, F.create_map(F.lit("customer"), F.lit("old")))
    with_host = F.when(key % 13 != 0, F.create_map(F.lit("host"), host))
    empty = F.create_map().cast("map<string,string>")
    headers = F.map_concat(
        F.create_map(F.lit("type"), F.col("event_type")), F.coalesce(old, empty), F.coalesce(with_host, empty)
    )
    return table(spark, sf_dir, "events").select("event_id", headers.alias("headers"), F.col("props").alias("body"))


def user_static_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's events as a static-pairs file; some lines are no pair and end their file."""
    key = F.col("event_id")
    line = (
        F.when(key % 101 == 7, text(F.col("event_type"), "=="))
        .when(key % 97 == 3, F.col("event_type"))
        .when(key % 10 == 4, text(F.col("event_type"), "=", key, "=lost"))
        .when(key % 10 == 5, text("=", key))
        .otherwise(text(F.col("event_type"), "=", key))
    )
    rows = table(spark, sf_dir, "events").select(F.col("user_id").alias("stream"), key.alias("pos"), line.alias("line"))
    return number_lines(rows)


def nation_static_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Static pairs from the nations: one key per region (so keys repeat), two that clash with event headers."""
    key = F.col("n_nationkey")
    line = (
        F.when(key == 3, text("type=static-", F.col("n_name")))
        .when(key == 4, text("host=static-", F.col("n_name"), "=lost"))
        .when(key == 21, "bad")
        .otherwise(text("region", F.col("n_regionkey"), "=", F.col("n_name")))
    )
    rows = table(spark, sf_dir, "nation")
    return number_lines(rows.select(F.lit("statics").alias("stream"), key.cast("bigint").alias("pos"), line.alias("line")))


def access_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An access-log line per event, for a page of the page table; some cut short or with parts left out."""
    pages = table(spark, sf_dir, "pages")
    key = F.col("event_id")
    rows = table(spark, sf_dir, "events").withColumn("n_pages", pages.agg(F.count(F.lit(1))).scalar())
    rows = rows.withColumn("page_id", key % F.col("n_pages")).join(pages.select("page_id", "url"), "page_id", "left")
    size = F.when(key % 4 == 0, "-").otherwise((key * 17 % 100000).cast("string"))
    line = text(
        "10.", F.col("user_id") % 256, ".0.", key % 256, " - user", F.col("user_id"),
        " [", F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"), ' +0100] "GET ', F.col("url"), ' HTTP/1.1" ', key % 5 * 100 + 100,
        " ", size, ' "', F.col("url"), '" "Mozilla/5.0 (', F.col("event_type"), ' x)" ',
        F.when(key % 6 == 0, "").otherwise("www.example.com"), ' "www.example.com" ',
        F.when(key % 9 == 0, "").otherwise((key % 60).cast("string")), " ", key % 1000000, " ",
        F.when(key % 8 == 0, "").when(key % 3 == 0, "X").otherwise("+"), ' "text/html"',
        F.when(key % 12 == 0, ' "-').otherwise(' "-"'), " ", key % 777, " ",
        F.when(key % 10 == 0, "").otherwise((key % 999).cast("string")),
    )
    cut = F.when(key % 7 == 6, F.substring(line, 1, 60)).otherwise(line)
    return rows.select("event_id", F.create_map(F.lit("type"), F.col("event_type")).alias("headers"), cut.alias("body"))


def log_level() -> Column:
    kind = F.col("event_type")
    return F.when(kind == "error", "SEVERE").when(kind == "click", "WARNING").otherwise("INFO")


def app_time(offset: str = "+0100") -> Column:
    return text(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS"), offset)


def app_events(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """An application-log event per event row (of a stream, if given); some with too few pipes, a bad time or pipes in the message."""
    key = F.col("event_id")
    tail = text("|app", F.col("user_id") % 5, "|com.example.", F.col("event_type"), "|_ThreadID=", F.col("user_id"), ";|")
    full = text("[#|", app_time(), "|", log_level(), tail, "did ", F.col("props"), " § ok|#]")
    line = (
        F.when(key % 23 == 1, text("no pipes for ", key))
        .when(key % 23 == 2, text("x|only rest ", key))
        .when(key % 23 == 3, text("x|", app_time(), "|", log_level(), "|rest"))
        .when(key % 23 == 4, text("[#|yesterday|", log_level(), tail, "bad time|#]"))
        .when(key % 23 == 5, text("[#|", app_time(), "|", log_level(), tail, "a|b|c|#]"))
        .when(key % 23 == 6, "")
        .otherwise(full)
    )
    host = text("NATION_", F.col("user_id") % 30, ".example.com")
    rows = table(spark, sf_dir, "events") if events is None else events
    return rows.select("event_id", F.create_map(F.lit("host"), host).alias("headers"), line.alias("body"))


def app_customer() -> Column:
    """A customer for an event id: one with a third of all events, some with names that directories treat in a way of their own."""
    key = F.col("event_id")
    odd = F.when(key % 7 == 1, "").when(key % 7 == 2, "__EMPTY__").when(key % 7 == 3, "__HIVE_DEFAULT_PARTITION__").when(key % 7 == 4, "a/b=c %")
    return F.when(key % 3 == 0, "HOT").otherwise(F.coalesce(odd, text("C", key % 11)))


def syslog_time(moment: Column, zero_padded: Column) -> Column:
    day = F.dayofmonth(moment).cast("string")
    padded = F.when(zero_padded, F.lpad(day, 2, "0")).otherwise(F.lpad(day, 2, " "))
    return text(F.date_format(moment, "MMM"), " ", padded, F.date_format(moment, " HH:mm:ss"))


def syslog_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A syslog line per event; some short, without a time, without a host or without a message."""
    key = F.col("event_id")
    stamp = syslog_time(F.col("ts"), key % 3 == 0)
    host = text("NATION_", F.col("user_id") % 30, F.when(key % 4 == 0, ".example.com").otherwise("-b"))
    line = (
        F.when(key % 29 == 1, F.substring(stamp, 1, 9))
        .when(key % 29 == 2, text("no time here, event ", key))
        .when(key % 29 == 3, stamp)
        .when(key % 29 == 4, text(stamp, " onlymessage"))
        .when(key % 29 == 5, text(stamp, "  blank host"))
        .otherwise(text(stamp, " ", host, " app: ", F.col("event_type"), " ", F.col("props")))
    )
    headers = F.when(key % 2 == 0, F.create_map(F.lit("host"), text("nation_", F.col("user_id") % 30, "-B"))).otherwise(
        F.create_map().cast("map<string,string>")
    )
    return table(spark, sf_dir, "events").select("event_id", headers.alias("headers"), line.alias("body"))
