"""Quality rules from cross-document line frequency, as DataFrame expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.functions.settle import settle
from logloom.llm.common import BLANK_CHARS, lower_ascii, split_words
from logloom.plans.scratch import saved

SYMBOLS = "#*$%&|<>"
WINDOW = 5
# A line of more than this share of a host's documents, and of more than so many, is common; a document must keep this share of its words.
MAX_SHARE, MIN_DOCUMENTS, MIN_LEFT = 0.05, 3, 0.5


def _lines(text: Column) -> Column:
    """Lines with at least one word."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: F.btrim(line, F.lit(BLANK_CHARS)) != "")


def normal_line(line: Column) -> Column:
    """What two lines must share to count as one: case, digits and the width of blanks do not matter."""
    one_blank = F.regexp_replace(F.btrim(line, F.lit(BLANK_CHARS)), r"[\x20\x09-\x0D]+", " ")
    return F.regexp_replace(lower_ascii(one_blank), "[0-9]+", "0")


def word_rules(documents: DataFrame, *keep: Column) -> DataFrame:
    """Per document: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (all long), and base_failed.

    A null text has no words. The columns doc_id and source stay and those of ``keep`` are computed, further ones go. Each array is computed once
    per row; positions of repeated windows come from one sort of a document's own window hashes.
    """
    kept = [f"_k{i}" for i in range(len(keep))]
    text = F.coalesce(F.col("text"), F.lit(""))
    df = documents.select(
        "doc_id", "source",
        F.length(F.translate(text, BLANK_CHARS, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        _lines(text).alias("_lines"),
        *[column.alias(name) for column, name in zip(keep, kept)],
        F.transform(split_words(text), lambda word: F.xxhash64(word)).alias("_words"),
    )
    df = settle(df, "_lines", "_words")
    n = F.size("_words")
    window = lambda i: F.xxhash64(*[F.get("_words", i + F.lit(k)) for k in range(WINDOW)])
    df = df.select(
        "doc_id", "source", *kept, "word_chars", "n_symbols", n.cast("long").alias("n_words"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.when(n >= WINDOW, F.transform(F.sequence(F.lit(0), n - WINDOW), window)).alias("_windows"),
    )
    df = settle(df, "_windows")
    repeated = F.size(F.array_distinct("_windows")) < F.size("_windows")
    df = df.withColumn("_sorted", F.when(repeated, F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    df = settle(df.drop("_windows"), "_sorted")

    def at(j: Column) -> Column:
        return F.get("_sorted", j)["h"]

    again = F.filter("_sorted", lambda x, j: (x["h"] == F.coalesce(at(j - 1), F.bitwise_not(x["h"]))) | (x["h"] == F.coalesce(at(j + 1), F.bitwise_not(x["h"]))))
    df = settle(df.withColumn("_starts", F.sort_array(F.transform(again, lambda x: x["i"]))).drop("_sorted"), "_starts")
    steps = F.transform("_starts", lambda start, j: F.least(F.coalesce(F.get("_starts", j + 1) - start, F.lit(WINDOW)), F.lit(WINDOW)))
    covered = F.coalesce(F.aggregate(steps, F.lit(0).cast("long"), lambda total, step: total + step), F.lit(0)).cast("long")
    df = df.withColumn("n_repeat_words", covered).drop("_starts")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return df.withColumn("base_failed", failed)


def line_pairs(text: Column) -> Column:
    """Hash of each normalised line of a text that has a word, with its number of words, in order."""
    word_count = lambda line: F.length(line) - F.length(F.replace(line, F.lit(" "))) + 1
    normal = F.transform(_lines(text), normal_line)
    return F.transform(normal, lambda line: F.struct(F.xxhash64(line).alias("line"), word_count(line).alias("words")))


def nameless(documents: DataFrame) -> Column:
    """What tells documents without an id apart: a hash of their text. Null for those that have an id."""
    return F.when(documents["doc_id"].isNull(), F.xxhash64(F.coalesce("text", F.lit(""))))


def common_lines(lines: DataFrame, max_share: float, min_documents: int) -> DataFrame:
    """(source, line) pairs that more than ``max_share`` of a host's documents and more than ``min_documents`` of them hold.

    ``lines`` has source, doc_id, nameless and line, a row for each line of a document or more. Documents are told apart by doc_id, those without
    one by their text; documents without a line do not count. A line's documents are made distinct before they are counted,
    in both steps combined per task first, so that a line that all documents hold is no hot key.
    """
    per_line = lines.select("source", "line", "doc_id", "nameless").distinct().groupBy("source", "line").agg(F.count(F.lit(1)).alias("_n"))
    hosts = lines.select("source", "doc_id", "nameless").distinct().groupBy("source").agg(F.count(F.lit(1)).alias("_documents"))
    hosts = hosts.withColumnRenamed("source", "_host")
    counted = per_line.where(F.col("_n") > min_documents).join(hosts, F.col("source").eqNullSafe(F.col("_host")))
    return counted.where(F.col("_n") > max_share * F.col("_documents")).select(F.col("source").alias("_host"), F.col("line").alias("_line"))


def _is_common() -> Column:
    return F.col("source").eqNullSafe(F.col("_host")) & (F.col("line") == F.col("_line"))


def quality_rules(documents: DataFrame, max_share: float = MAX_SHARE, min_documents: int = MIN_DOCUMENTS, min_left: float = MIN_LEFT) -> DataFrame:
    """Word rules and the verdict of cross-document line frequency, a row for a row.

    A line is common when more than ``max_share`` of its host's documents (``source``; null is a host of its own) and more than
    ``min_documents`` hold it; the second limit only shields hosts of a few documents, so that the rule works alike at every size. Common lines are
    taken out; a document that keeps fewer than 10 words, or less than ``min_left`` of its words, is depleted and rejected.
    Rows that share a doc_id count as one document of their host, rows without one by their text; each row is judged by its
    own lines, so that rows that are alike get the same verdict. A null text has no lines. Adds n_left_words (words outside common lines) and kept.

    Texts are read once: measures and line hashes are written to a working table, and all further steps read that.
    """
    measured = word_rules(documents, line_pairs(F.col("text")), nameless(documents)).withColumn("_row", F.monotonically_increasing_id())
    measured = saved(measured.withColumnRenamed("_k0", "_pairs").withColumnRenamed("_k1", "nameless"), "quality")
    lines = measured.select("_row", "source", "doc_id", "nameless", F.inline("_pairs"))
    hit = lines.join(common_lines(lines, max_share, min_documents), _is_common())
    removed = hit.groupBy("_row").agg(F.sum("words").alias("_removed"))
    judged = measured.drop("_pairs", "nameless").join(removed, "_row", "left")
    left = F.greatest(F.col("n_words") - F.coalesce(F.col("_removed"), F.lit(0)), F.lit(0)).cast("long")
    judged = judged.withColumn("n_left_words", left)
    kept = ~F.col("base_failed") & (F.col("n_left_words") >= 10) & (F.col("n_left_words") >= min_left * F.col("n_words"))
    return judged.select("doc_id", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "n_left_words", kept.alias("kept"))


def clean_documents(documents: DataFrame, max_share: float = MAX_SHARE, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """The documents without their hosts' common lines; n_chars, where there, is counted anew. Documents are told apart as above.

    Only texts with a common line are cut up, and put together again line by line.
    """
    own = documents.columns
    rows = saved(documents.select(*own, nameless(documents).alias("_nameless"), line_pairs(F.col("text")).alias("_pairs"), F.monotonically_increasing_id().alias("_row")), "lines")
    lines = rows.select("_row", "source", "doc_id", F.col("_nameless").alias("nameless"), F.inline("_pairs"))
    common = saved(common_lines(lines, max_share, min_documents), "common-lines")
    touched = lines.join(common, _is_common(), "left_semi").select("_row").distinct()
    parts = rows.join(touched, "_row").select("_row", "source", F.posexplode(F.split("text", "\n")).alias("_at", "_text"))
    parts = parts.withColumn("line", F.xxhash64(normal_line(F.col("_text"))))
    left = parts.join(common, _is_common(), "left_anti").groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("_at", "_text"))).alias("_parts"))
    cleaned = touched.join(left, "_row", "left").select("_row", F.lit(True).alias("_cut"), F.coalesce(F.array_join("_parts._text", "\n"), F.lit("")).alias("_clean"))
    out = rows.join(cleaned, "_row", "left").withColumn("text", F.when(F.col("_cut"), F.col("_clean")).otherwise(F.col("text")))
    if "n_chars" in own:
        out = out.withColumn("n_chars", F.length("text").cast("long"))
    return out.select(*own)
