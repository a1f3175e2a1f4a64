"""Mixing sources to target weights by entropy balancing."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from logloom.llm.common import columns_of, count_words, row_hash
from logloom.plans.scratch import saved

CELL = 4096


def source_targets(sizes: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """source, source_size, target: ``share`` of all words dealt by weight, none above ``most`` times its source's words.

    Sources are in code point order, null last, and the weights repeat. The excess of capped sources goes to the others
    by weight: in order of size per weight, the sources up to some point are capped and the rest share what is left.
    One row per source.
    """
    totals = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).cast("long").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.row_number().over(order) - 1) % len(weights) + 1)
    totals = totals.withColumn("_weight", weight).withColumn("_cap", F.lit(float(most)) * F.col("source_size"))
    by_ratio = Window.orderBy(F.col("_cap") / F.col("_weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(1))
    wanted = F.lit(float(share)) * F.sum("source_size").over(everything)
    level = (wanted - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("_weight").over(rest)
    totals = totals.withColumn("_level", F.greatest(level, F.lit(0.0)))
    capped = F.col("_cap") <= F.col("_level") * F.col("_weight")
    totals = totals.withColumn("_capped", capped)
    water = F.max(F.when(~F.col("_capped"), F.col("_level"))).over(everything)  # that of the first one not capped
    target = F.when(F.col("_capped") | water.isNull(), F.col("_cap")).otherwise(F.least(water * F.col("_weight"), F.col("_cap")))
    return totals.select("source", "source_size", target.alias("target"))


def _rate(tilt: Column, size: Column, scale: Column, most: float) -> Column:
    """The document rate: exponentially tilted by its words, at most ``most``."""
    return F.least(F.exp(F.least(tilt * size / scale, F.lit(50.0))), F.lit(float(most)))


def balance(cells: DataFrame, targets: DataFrame, most: float, tolerance: float = 1e-7, most_steps: int = 60) -> DataFrame:
    """Newton iterations for the dual of entropy balancing: one tilt per source.

    Among all document rates in [0, ``most``] whose words add up to the source's target, those nearest to 1 in relative
    entropy are min(most, exp(tilt * size / scale)). The dual is convex in the tilt, its gradient is
    (words taken - target), and a step is that over the second derivative, halved towards a bracket when it would leave
    it. ``cells`` has (source, size, n), so that a step is one aggregation over distinct sizes, not documents.
    A source whose target is all it may give has every rate at ``most``.
    """
    scale = cells.groupBy("source").agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("scale"))
    state = _same_source(targets, scale).where("scale > 0").select(
        "source", "target", "scale", (F.col("target") >= F.col("source_size") * most * (1 - 1e-9)).alias("full"),
        F.lit(0.0).alias("tilt"), F.lit(-1e6).alias("low"), F.lit(1e6).alias("high"), F.lit(None).cast("double").alias("off"))
    state = saved(state, "mix-start")
    for _ in range(most_steps):
        state = saved(_newton(cells, state, most), "mix-step")
        worst = state.where("NOT full").agg(F.max(F.abs("off"))).first()[0]
        if worst is None or worst <= tolerance:
            break
    else:
        raise RuntimeError(f"off by {worst} after {most_steps} steps")
    tilt = F.when(F.col("full"), F.lit(float("inf"))).otherwise(F.col("tilt"))
    return state.select("source", "scale", tilt.alias("tilt"))


def _newton(cells: DataFrame, state: DataFrame, most: float) -> DataFrame:
    rate = _rate(F.col("tilt"), F.col("size"), F.col("scale"), most)
    inside = F.when(rate < most, F.col("n") * rate * F.col("size") * F.col("size") / F.col("scale")).otherwise(0.0)
    sums = _same_source(cells, state.where("NOT full")).groupBy("source").agg(
        F.sum(F.col("n") * rate * F.col("size")).alias("_taken"), F.sum(inside).alias("_slope"))
    now = _same_source(state, sums, "left")
    over = F.col("_taken") > F.col("target")
    low, high = F.when(over, F.col("low")).otherwise(F.col("tilt")), F.when(over, F.col("tilt")).otherwise(F.col("high"))
    step = F.col("tilt") - F.try_divide(F.col("_taken") - F.col("target"), F.col("_slope"))
    off = F.try_divide(F.col("_taken") - F.col("target"), F.col("target"))
    now = now.select("source", "target", "scale", "full", "tilt", low.alias("low"), high.alias("high"), off.alias("off"), step.alias("_step"))
    middle = F.when(F.col("low") <= -1e6, F.least(F.col("tilt") * 2, F.lit(0.0)) - 1).when(
        F.col("high") >= 1e6, F.greatest(F.col("tilt") * 2, F.lit(0.0)) + 1).otherwise((F.col("low") + F.col("high")) / 2)
    good = F.col("_step").isNotNull() & (F.col("_step") > F.col("low")) & (F.col("_step") < F.col("high")) & (F.abs(F.col("_step") - F.col("tilt")) < 5)
    tilt = F.when(F.col("full") | (F.abs("off") < 1e-12), F.col("tilt")).when(good, F.col("_step")).otherwise(middle)
    return now.select("source", "target", "scale", "full", tilt.alias("tilt"), "low", "high", "off")


def _same_source(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join on source, null to null."""
    right = right.select(F.col("source").alias("_other"), *[c for c in right.columns if c not in ("source", *left.columns)])
    return left.join(right, F.col("source").eqNullSafe(F.col("_other")), how).drop("_other")


def _tie() -> Column:
    return F.xxhash64(F.col("doc_id"), F.col("text"))


def mix_sources(documents: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: int = 2) -> DataFrame:
    """Copies per document such that each source's words come near its target.

    Returns doc_id, source, size (words; null text: 0), source_size, target, copies (0 to ``most``, at least) and taken
    (copies * size), one row per row of ``documents``. Rates are rounded over the (source, size) cells of a source, from the largest size down,
    and what one cell misses is made good by the next, so that a source misses its target by about its smallest document. Which documents of a cell get the further copy is decided by a hash of id and text, in
    buckets of about 4,096 documents, and so is the same in every run. Rows alike in id and text are interchangeable.
    A source without words has target 0.
    """
    return _mixed(documents, weights, share, most).drop("_tie")


def _mixed(documents: DataFrame, weights: tuple[float, ...], share: float, most: int) -> DataFrame:
    sized = saved(documents.select("doc_id", "source", count_words(F.col("text")).alias("size"), _tie().alias("_tie")), "mix-sizes")
    cells = saved(sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "mix-cells")
    targets = saved(source_targets(cells, weights, share, most), "mix-targets")
    tilts = balance(cells, targets, most)
    rate = F.when(F.col("scale").isNull(), F.lit(0.0)).otherwise(_rate(F.col("tilt"), F.col("size"), F.col("scale"), most))
    rate = F.when(F.col("size") == 0, F.lit(0.0)).when(F.col("tilt") == float("inf"), F.lit(float(most))).otherwise(rate)
    rated = _same_source(cells, tilts, "left").select("source", "size", "n", rate.alias("rate"))
    rated = rated.groupBy("source").applyInPandas(lambda cells: _whole_copies(cells, most), "source string, size long, n long, _whole long, _extra long")
    rated = saved(_same_source(rated, targets), "mix-rates")
    joined = _by_cell(sized, rated).withColumn("_bucket", F.pmod("_tie", F.ceil(F.col("n") / CELL)))
    counts = joined.groupBy("source", "size", "_bucket").agg(F.count(F.lit(1)).alias("_in"), F.max("_extra").alias("_of"))
    buckets = Window.partitionBy("source", "size").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.where("_of > 0").withColumn("_quota", F.greatest(F.least(F.col("_of") - F.coalesce(F.sum("_in").over(buckets), F.lit(0)), F.col("_in")), F.lit(0)))
    counts = counts.select("source", "size", F.col("_bucket").alias("_bucket2"), "_quota")
    partly = joined.where("_extra > 0 AND _extra < n")
    ranked = partly.withColumn("_rank", F.row_number().over(Window.partitionBy("source", "size", "_bucket").orderBy("_tie", "doc_id")))
    ranked = ranked.join(
        counts.withColumnRenamed("source", "_s").withColumnRenamed("size", "_z"),
        F.col("source").eqNullSafe(F.col("_s")) & (F.col("size") == F.col("_z")) & (F.col("_bucket") == F.col("_bucket2")), "left")
    one_more = F.when(F.col("_rank") <= F.col("_quota"), 1).otherwise(0)
    columns = ["doc_id", "source", "size", "source_size", "target", "_tie"]
    some = ranked.select(*columns, (F.col("_whole") + one_more).alias("copies"))
    rest = joined.where("NOT (_extra > 0 AND _extra < n)").select(*columns, (F.col("_whole") + F.when(F.col("_extra") > 0, 1).otherwise(0)).alias("copies"))
    out = some.unionByName(rest)
    return out.select(*columns, F.col("copies").cast("int").alias("copies"), (F.col("copies") * F.col("size")).cast("long").alias("taken"))


def _whole_copies(cells: pd.DataFrame, most: int) -> pd.DataFrame:
    """Copies of each cell of one source, as whole copies of all its documents and of how many one more.

    Cells come in falling size, and what a cell takes too much or too little goes on to the next. One row per distinct size.
    """
    cells = cells.sort_values("size", ascending=False)
    carried, whole, extra = 0.0, [], []
    for size, n, rate in zip(cells["size"].tolist(), cells["n"].tolist(), cells["rate"].tolist()):
        base = min(math.floor(rate + 1e-12), most)
        carried += n * (rate - base) * size
        more = round(carried / size) if size else 0
        more = min(max(more, 0), n if base < most else 0)
        carried -= more * size
        whole.append(base)
        extra.append(more)
    return pd.DataFrame({"source": cells["source"], "size": cells["size"], "n": cells["n"], "_whole": whole, "_extra": extra})


def _by_cell(sized: DataFrame, rated: DataFrame) -> DataFrame:
    rated = rated.withColumnRenamed("source", "_s").withColumnRenamed("size", "_z")
    return sized.join(rated, F.col("source").eqNullSafe(F.col("_s")) & (F.col("size") == F.col("_z"))).drop("_s", "_z")


def repeated_documents(documents: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: int = 2) -> DataFrame:
    """The mix itself: every document as often as the mix takes it, with the columns of ``documents``.

    Rows alike in id, source and text are one document here: one of them is repeated for all.
    """
    key = ["doc_id", "source", "_tie"]
    copies = _mixed(documents, weights, share, most).groupBy(*key).agg(F.sum("copies").cast("int").alias("_copies"), F.count(F.lit(1)).alias("_rows"))
    copies = copies.where("_copies > 0").select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(key)], "_copies", "_rows")
    rows = documents.select(F.struct(*columns_of(documents)).alias("row"), row_hash(documents).alias("_hash"), *[c.alias(f"_m{i}") for i, c in enumerate((F.col("doc_id"), F.col("source"), _tie()))])
    same = F.col("_m2") == F.col("_k2")
    for i in (0, 1):
        same = same & F.col(f"_m{i}").eqNullSafe(F.col(f"_k{i}"))
    joined = rows.join(copies, same)
    alike = Window.partitionBy("_m0", "_m1", "_m2").orderBy("_hash")
    several = joined.where("_rows > 1").withColumn("_at", F.row_number().over(alike)).where("_at = 1")
    chosen = joined.where("_rows = 1").select("row", "_copies").unionByName(several.select("row", "_copies"))
    return chosen.select("row", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select("row.*")
