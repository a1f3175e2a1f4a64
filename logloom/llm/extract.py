"""Main text of web pages by a site style tree.

The pages of a host are merged into one tree: where their elements have the same children, they share a *style* and the nodes in it.
A text node is important when its texts differ from page to page; an element when its styles do, or what lies
below it is important. Branches of low importance are what the site repeats (menus, footers, notices) and go.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.llm.common import pieces as slices
from logloom.llm.html_tree import ASIDE, MAIN, content_hash, page_parts, text_hash
from logloom.plans.scratch import saved

# A branch of lower importance goes.
LEAST_IMPORTANCE = 0.3
# Number of pages that evidence counts against: texts on so many pages are taken as important until shown to repeat.
PRIOR_PAGES = 2.0
# How far an element's importance comes from below it: this to the power of its number of styles.
DAMPING = 0.9
# A text that its page declares to be beside the article counts so much of its importance.
ASIDE_WEIGHT = 0.2

PARTS = ("host string, layout long, page long, nodes array<struct<node:long,style:long,width:int,role:int,is_text:boolean,path:array<long>>>, "
         "texts array<struct<node:long,text:long>>")
BLOCKS = "page_id long, url string, host string, layout long, blocks array<struct<node:long,text:string>>"

_NODES = pa.list_(pa.struct([("node", pa.int64()), ("style", pa.int64()), ("width", pa.int32()), ("role", pa.int32()), ("is_text", pa.bool_()), ("path", pa.list_(pa.int64()))]))
_TEXTS = pa.list_(pa.struct([("node", pa.int64()), ("text", pa.int64())]))
_BLOCKS = pa.list_(pa.struct([("node", pa.int64()), ("text", pa.string())]))


def host_of(url: Column) -> Column:
    """Host name of a URL in lower case; "" where there is none, so that such pages are a site of their own."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def _html(column: pa.Array) -> Iterator[str | None]:
    for value in column.cast(pa.binary()).to_pylist():
        yield None if value is None else value.decode("utf-8", "replace")


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 1):
        layouts, pages, nodes, texts = [], [], [], []
        for page in _html(batch.column(1)):
            layout, found, said = page_parts(page)
            layouts.append(layout)
            pages.append(content_hash(said))
            nodes.append([{"node": key, "style": style, "width": width, "role": role, "is_text": is_text, "path": path}
                          for key, (style, width, role, is_text, path) in found.items()])
            texts.append([{"node": node, "text": text} for node, text in sorted({(node, text_hash(text)) for node, text in said})])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(layouts, pa.int64()), pa.array(pages, pa.int64()), pa.array(nodes, _NODES), pa.array(texts, _TEXTS)],
            ["host", "layout", "page", "nodes", "texts"])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 3):
        layouts, blocks = [], []
        for page in _html(batch.column(3)):
            layout, _, said = page_parts(page)
            layouts.append(layout)
            blocks.append([{"node": node, "text": text} for node, text in said])
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(layouts, pa.int64()), pa.array(blocks, _BLOCKS)],
                                         ["page_id", "url", "host", "layout", "blocks"])


def site_parts(pages: DataFrame) -> DataFrame:
    """What each page brings to the tree of its site: layout, content hash, nodes, hashes of its texts by node."""
    return pages.select(host_of(F.col("url")).alias("host"), "html").mapInArrow(_parts, PARTS)


def style_tree(parts: DataFrame, prior_pages: float = PRIOR_PAGES, damping: float = DAMPING, least: float = LEAST_IMPORTANCE) -> DataFrame:
    """The style trees of all sites: host, node, parent, is_text, role, n_pages, n_styles, importance, noisy.

    Pages of a host that are copies of each other count once. Entropies are taken to the base of the number of pages that have the node:

    * text node: 1 less the mean entropy of its distinct texts over the pages, drawn towards 1 by ``prior_pages`` pages; a share of it
      for texts declared aside, and at least ``least`` for those declared main;
    * element: with n styles, (1 - damping^n) of the entropy of its styles, and the rest from the importance of its styles, weighted
      by their pages; a style's importance is the mean over its nodes.

    A node is noisy when it and all nodes below it stay under ``least``. Counts are aggregated over (host, node, text) and combined before
    they are shuffled; the sums up the tree join each node with the nodes above it, at most 64.
    """
    counts = parts.select("host", "layout", "page").distinct().groupBy("host", "layout").agg(F.count(F.lit(1)).alias("n"))
    layouts = parts.groupBy("host", "layout").agg(F.first("nodes").alias("nodes"))
    each = layouts.join(counts, ["host", "layout"]).select("host", "n", F.inline("nodes"))
    firsts = [F.first(name).alias(name) for name in ("style", "width", "role", "is_text", "path")]
    nodes = saved(each.groupBy("host", "node").agg(F.sum("n").alias("n_pages"), *firsts), "tree-nodes")
    nodes = nodes.withColumn("parent", F.get("path", F.lit(1)))

    # Content: mean of log(pages with the text) over the node's distinct texts.
    once = parts.select("host", "page", "texts").dropDuplicates(["host", "page"]).select("host", F.inline("texts"))
    spread = once.groupBy("host", "node", "text").agg(F.count(F.lit(1)).alias("k"))
    content = spread.groupBy("host", "node").agg(F.avg(F.log("k")).alias("mean_log"))

    # Presentation: entropy of the styles of an element.
    styles = nodes.where("style IS NOT NULL").groupBy("host", "parent", "style").agg(F.max("n_pages").alias("k"))
    shown = styles.groupBy("host", "parent").agg(
        F.count(F.lit(1)).alias("n_styles"), F.sum("k").alias("total"), F.sum(F.col("k") * F.log("k")).alias("spread"))
    own = shown.withColumnRenamed("parent", "node")
    above = shown.select("host", "parent", F.col("n_styles").alias("styles_above"), F.col("total").alias("total_above"))

    log_pages = F.log(F.col("n_pages").cast("double"))
    raw = F.when(F.col("n_pages") > 1, 1 - F.least(F.col("mean_log") / log_pages, F.lit(1.0))).otherwise(1.0)
    held = (F.col("n_pages") * raw + prior_pages) / (F.col("n_pages") + prior_pages)
    text_importance = F.when(F.col("role") == ASIDE, ASIDE_WEIGHT * held).when(F.col("role") == MAIN, F.greatest(held, F.lit(least))).otherwise(held)
    entropy = F.when(F.col("n_pages") > 1, F.least((F.log(F.col("total").cast("double")) - F.col("spread") / F.col("total")) / log_pages, F.lit(1.0))).otherwise(1.0)
    element_share = (1 - F.pow(F.lit(damping), F.col("n_styles"))) * entropy
    step = F.pow(F.lit(damping), F.col("styles_above")) * F.col("n_pages") / F.col("total_above") / F.col("width")
    judged = (
        nodes.join(content, ["host", "node"], "left").join(own, ["host", "node"], "left").join(above, ["host", "parent"], "left")
        .select("host", "node", "parent", "path", "is_text", "role", "n_pages", F.coalesce("n_styles", F.lit(0)).alias("n_styles"),
                F.when(F.col("is_text"), text_importance).otherwise(F.coalesce(element_share, F.lit(0.0))).alias("share"), F.coalesce(step, F.lit(1.0)).alias("step"))
    )
    judged = saved(judged, "tree-shares")

    # Each node's share goes to all nodes above it, lessened by the steps between.
    steps = judged.select("host", F.col("node").alias("up"), "step")
    pairs = judged.select("host", "node", "share", F.posexplode("path").alias("i", "up")).join(steps, ["host", "up"])
    paths = pairs.groupBy("host", "node").agg(F.first("share").alias("share"), F.sort_array(F.collect_list(F.struct("i", "up", "step"))).alias("ups"))
    weight = lambda up, i: F.struct(up["up"].alias("node"), (F.col("share") * F.aggregate(F.slice("ups", F.lit(1), i), F.lit(1.0), lambda w, x: w * x["step"])).alias("part"))
    sums = paths.select("host", F.inline(F.transform("ups", weight))).groupBy("host", "node").agg(F.sum("part").alias("importance"))
    tree = saved(judged.drop("share", "step").join(sums, ["host", "node"]), "tree")
    worst = tree.select("host", "importance", F.explode("path").alias("node")).groupBy("host", "node").agg(F.max("importance").alias("most"))
    return tree.join(worst, ["host", "node"]).withColumn("noisy", F.col("most") < least).drop("path", "most")


def extract_text(pages: DataFrame, prior_pages: float = PRIOR_PAGES, damping: float = DAMPING, least: float = LEAST_IMPORTANCE) -> DataFrame:
    """Main text of each page (page_id, url, html), a row for a row: page_id, url, text, n_chars, n_blocks, n_removed.

    Texts are the runs of text between block tags, with character references decoded and white space turned to one blank; those that lie in no
    noisy branch of the site's tree are joined by newlines in page order. A page of few like it on its host is judged by what it declares
    (``nav``, ``footer``, ``article``, names of classes), as its tree says little. Null and empty html give "", a null url counts as a host of its
    own, repeated rows each get their text; further columns go. Pages are parsed twice rather than shuffled: what is to go is known per host and
    layout (the set of a page's nodes), a small table that is joined with the pages.
    """
    pages = pages.selectExpr("cast(page_id AS bigint) AS page_id", "url", "html")
    parts = saved(site_parts(pages), "page-parts")
    noisy = style_tree(parts, prior_pages, damping, least).where("noisy AND is_text").select("host", "node")
    layouts = parts.groupBy("host", "layout").agg(F.first("nodes.node").alias("nodes")).select("host", "layout", F.explode("nodes").alias("node"))
    out = layouts.join(noisy, ["host", "node"]).groupBy("host", "layout").agg(F.collect_list("node").alias("out"))
    out = saved(out, "page-noise").select(F.col("host").alias("_host"), F.col("layout").alias("_layout"), "out")
    blocks = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), "html").mapInArrow(_blocks, BLOCKS)
    joined = blocks.join(out, (F.col("host") == F.col("_host")) & (F.col("layout") == F.col("_layout")), "left")
    left = F.filter("blocks", lambda block: ~F.coalesce(F.array_contains("out", block["node"]), F.lit(False)))
    kept = joined.select("page_id", "url", F.size("blocks").alias("n_blocks"), F.transform(left, lambda block: block["text"]).alias("kept"))
    text = F.array_join("kept", "\n")
    return kept.select("page_id", "url", text.alias("text"), F.length(text).cast("long").alias("n_chars"),
                       F.col("n_blocks").cast("long").alias("n_blocks"), (F.col("n_blocks") - F.size("kept")).cast("long").alias("n_removed"))
