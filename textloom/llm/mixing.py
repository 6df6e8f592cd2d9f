"""Mixing sources to target weights by entropy balancing.

Each document gets a rate between 0 and ``most`` copies.  Among all rates whose words add up to each source's target,
the method takes those closest (in relative entropy, to one copy each) by solving the convex dual: one multiplier
per source, rates ``min(most, exp(multiplier * size / scale))``.  Newton's steps run as Spark aggregations over the
distinct (source, size) groups; a bracket around the root, kept for each source, catches steps that leave it.

Rates become copies in two steps.  For each distinct size of a source, from the largest down, the number of copies
rounds towards whatever brings the source's words so far closest to its target, so later, smaller sizes mend what
larger ones left over.  Within a group of one size, copies go to documents in the order of a hash of the id.

Defined results.  A null text has size 0; documents of size 0 get one copy (they take no words).  A null source is
a source, ordered last.  Repeated rows are documents of their own, but rows of one id and size get the same number of
copies (they share a hash).  With no words at all every target is 0.  An empty table gives no rows.
Other columns are ignored.  Reruns agree: everything depends on ids, sources and sizes only.

Bounds: source rows are assumed to be few (a window over one row per source); a source's distinct sizes, at most the
length of its longest document, go to one task for the rounding.  Groups of documents are never collected.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import Scratch, n_words, stored

WEIGHTS = (3, 1, 2)
GROUP = 4096  # documents of one (source, size) that are ranked together
BROADCAST_ROWS = 1_000_000


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5,
                   most: float = 2.0) -> DataFrame:
    """``source, source_size, target`` from rows of ``source, size, n``.

    Targets share ``share`` times all words by weight and stop at ``most`` times the source's words; what is
    over goes to the others by weight.  In the order of cap / weight the sources that stop come first, so the level of
    the others follows from running sums.
    """
    per = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    per = per.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(most))
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("total", F.sum("source_size").over(every) * share) \
        .withColumn("spent", F.coalesce(F.sum("cap").over(before), F.lit(0.0))) \
        .withColumn("left", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))) \
        .withColumn("level", (F.col("total") - F.col("spent")) / F.col("left"))
    # The level of all is that before the first source that does not reach its cap (of equal ones, the highest).
    free = F.min(F.when(F.col("level") * F.col("weight") < F.col("cap"), F.struct(
        (F.col("cap") / F.col("weight")).alias("at"), (-F.col("level")).alias("down")))).over(every)
    return per.withColumn("free", -free["down"]).select(
        "source", "source_size",
        F.coalesce(F.least(F.col("cap"), F.col("free") * F.col("weight")), F.col("cap")).alias("target"))


def balance(groups: DataFrame, targets: DataFrame, most: float = 2.0, steps: int = 60,
            close: float = 1e-7, stored: Callable[[DataFrame], DataFrame] = stored) -> DataFrame:
    """``source, lam, scale``: multipliers with which the sources' words come to their targets.

    ``groups`` has ``source, size, n`` (sizes over 0).  A source whose target is its cap has no finite multiplier;
    it gets a large one, at which every rate is cut at ``most``.  Sources that are still further off than ``close``
    after ``steps`` steps (each at least halves the interval) are named in a warning.
    """
    state = stored(
        groups.groupBy("source").agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("scale"),
                                     F.min("size").alias("least"))
        .join(targets.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
        .withColumn("full", F.col("target") >= F.col("source_size") * F.lit(most) * (1 - 1e-12))
        .withColumn("high", F.log(F.lit(most)) * F.col("scale") / F.col("least") + 1e-9)
        .withColumn("low", F.lit(-700.0) * F.col("scale") / F.col("least"))
        .withColumn("lam", F.when(F.col("full"), F.col("high")).when(F.col("target") <= 0, F.col("low"))
                    .otherwise(F.lit(0.0)))
        .withColumn("open", ~F.col("full") & (F.col("target") > 0)))
    for _ in range(steps):
        rate = F.exp(F.col("lam") * F.col("size") / F.col("scale"))
        words = F.col("size") * F.col("n")
        sums = groups.join(state.filter("open").select(F.col("source").alias("s"), "lam", "scale"),
                           F.col("source").eqNullSafe(F.col("s"))) \
            .groupBy("s").agg(F.sum(words * F.least(F.lit(most), rate)).alias("got"),
                              F.sum(F.when(rate < most, words * rate * F.col("size") / F.col("scale"))
                                    .otherwise(0.0)).alias("slope"))
        step = state.join(sums, F.col("source").eqNullSafe(F.col("s")), "left") \
            .withColumn("off", F.col("got") - F.col("target")) \
            .withColumn("high", F.when(F.col("off") > 0, F.col("lam")).otherwise(F.col("high"))) \
            .withColumn("low", F.when(F.col("off") < 0, F.col("lam")).otherwise(F.col("low"))) \
            .withColumn("newton", F.col("lam") - F.col("off") / F.col("slope")) \
            .withColumn("open", F.col("open") & (F.abs("off") > F.col("target") * close)) \
            .withColumn("lam", F.when(~F.col("open"), F.col("lam"))
                        .when((F.col("newton") > F.col("low")) & (F.col("newton") < F.col("high")), F.col("newton"))
                        .otherwise((F.col("low") + F.col("high")) / 2))
        state = stored(step.select(*state.columns))
        if not state.filter("open").take(1):
            break
    else:
        some = [r["source"] for r in state.filter("open").orderBy("source").select("source").take(5)]
        warnings.warn(f"after {steps} steps sources are not at their targets, among them {some}", stacklevel=2)
    return state.select("source", "lam", "scale")


def _round(group: pd.DataFrame, most: float) -> pd.DataFrame:
    """Copies of each distinct size of one source: carries the words still owed from large sizes to small ones."""
    group = group.sort_values("size", ascending=False)
    owed, copies = 0.0, []
    for size, n, rate in zip(group["size"], group["n"], group["rate"], strict=True):
        want = n * rate + owed / size
        k = min(max(round(want), 0), int(most * n))
        owed = (want - k) * size
        copies.append(k)
    return group.assign(copies=copies)[["source", "size", "n", "rate", "copies"]]


def decisions(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5,
              most: float = 2.0) -> DataFrame:
    """What becomes of documents (``h, source, size``) of each source and size: one row per distinct pair.

    ``source, size, source_size, target, rate, base, cut``: every document gets ``base`` copies, and one more if its
    hash is at most ``cut``.
    """
    scratch = Scratch(rows.sparkSession)
    groups = scratch.stored(rows.groupBy("source", "size").agg(F.count("*").alias("n")))
    targets = scratch.stored(source_targets(groups, weights, share, most))
    sized = groups.filter("size > 0")
    lam = balance(sized, targets, most, stored=scratch.stored)
    rated = sized.join(lam.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))) \
        .select("source", "size", "n",
                F.least(F.lit(most), F.exp(F.col("lam") * F.col("size") / F.col("scale"))).alias("rate"))
    whole = rated.groupBy("source").applyInPandas(
        lambda g: _round(g, most), "source string, size long, n long, rate double, copies long")
    empty = groups.filter("size = 0").select("source", "size", "n", F.lit(1.0).alias("rate"), F.col("n").alias("copies"))
    plan = scratch.stored(whole.unionByName(empty).withColumn("base", F.floor(F.col("copies") / F.col("n")))
                  .withColumn("extra", F.col("copies") - F.col("base") * F.col("n")))
    # The cut is the extra-th smallest hash.  Hash ranges of about GROUP documents are counted first, so that ranks
    # are only needed within one of them.
    same = lambda a, b: F.col(f"{a}.source").eqNullSafe(F.col(f"{b}.source")) & (F.col(f"{a}.size") == F.col(f"{b}.size"))
    wide = F.lit(2.0**64) / (F.floor(F.col("n") / GROUP) + 1)
    parts = rows.alias("r").join(plan.filter("extra > 0").alias("p"), same("r", "p")).select(
        "r.h", "r.source", "r.size", "p.extra",
        F.floor((F.col("r.h").cast("double") + F.lit(2.0**63)) / wide).alias("part"))
    counts = parts.groupBy("source", "size", "part").agg(F.count("*").alias("m")).withColumn(
        "before", F.sum("m").over(Window.partitionBy("source", "size").orderBy("part")) - F.col("m"))
    rank = F.row_number().over(Window.partitionBy("source", "size", "part").orderBy("h"))
    cuts = parts.alias("a").join(counts.alias("b"), same("a", "b") & (F.col("a.part") == F.col("b.part"))) \
        .filter((F.col("before") < F.col("extra")) & (F.col("extra") <= F.col("before") + F.col("m"))) \
        .select("a.*", "before").withColumn("rank", rank).filter(F.col("before") + F.col("rank") == F.col("extra")) \
        .select("source", "size", F.col("h").alias("cut"))
    out = stored(plan.alias("p").join(cuts.alias("c"), same("p", "c"), "left")
                  .join(targets.alias("t"), F.col("p.source").eqNullSafe(F.col("t.source")))
                  .select("p.source", "p.size", "t.source_size", F.col("t.target").cast("double").alias("target"),
                          "p.rate", "p.base", "c.cut"))
    scratch.clear()
    return out


def _with_copies(rows: DataFrame, weights: tuple[int, ...], share: float, most: float) -> DataFrame:
    """``rows`` (with ``h, source, size``) and their decision, ``copies`` included."""
    table = decisions(stored(rows.select("h", "source", "size")), weights, share, most)
    # A row per source and size: it stops growing when the sizes are all there.  Checked, then broadcast, so that no
    # text moves; a larger one is joined as usual.
    if table.count() <= BROADCAST_ROWS:
        table = F.broadcast(table)
    copies = F.col("d.base") + F.when(F.col("r.h") <= F.col("d.cut"), 1).otherwise(0)
    return rows.alias("r").join(table.alias("d"), F.col("r.source").eqNullSafe(F.col("d.source"))
                                & (F.col("r.size") == F.col("d.size"))) \
        .select("r.*", "d.source_size", "d.target", "d.rate", copies.cast("long").alias("copies"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """One row per row of ``docs``: id_col, source, size, source_size, target, rate, copies, taken."""
    rows = stored(docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(f"`{id_col}`").alias("h"),
                              F.col(f"`{source_col}`").alias("source"), n_words(F.col(f"`{text_col}`")).alias("size")))
    return _with_copies(rows, weights, share, most).select(
        F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target", "rate", "copies",
        (F.col("copies") * F.col("size")).alias("taken"))


def take(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``docs`` with each row as often as the mix takes it."""
    rows = docs.select(F.struct("*").alias("row"), F.xxhash64(f"`{id_col}`").alias("h"),
                       F.col(f"`{source_col}`").alias("source"), n_words(F.col(f"`{text_col}`")).alias("size"))
    return _with_copies(rows, weights, share, most).select(
        "row", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))).select("row.*")
