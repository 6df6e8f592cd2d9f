"""Corpus profiling aggregates (AGG-01..14, WIN-07).

Aggregations are written so that Spark can combine map-side (partial
aggregation) before the shuffle, and so that no group is ever collected into
one task: distinct counts go through a (group, value) pre-aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.session import cut_lineage


def corpus_stats_by(df: DataFrame, group: str, unit_id: str, text_col: str,
                    unit_count_name: str = "n_units") -> DataFrame:
    """Units, sentences (PRJ-04), ``\\w+`` tokens and distinct lower-case words per group.

    One scan of ``df``: every unit is exploded into its words; the unit-level
    counts ride on the unit's first word (or its null row when it has none).
    Stage 1 aggregates (group, word) with a map-side combine; stage 2 folds the
    per-word rows into per-group totals.  A hot group spreads over its words.
    """
    pieces = T.sentence_pieces(F.col(text_col))
    base = df.select(
        F.col(group).alias("g"),
        F.size(F.filter(pieces, lambda p: p != "")).alias("n_sent"),
        T.tokens(F.col(text_col), "word").alias("words"))
    exploded = base.select("g", "n_sent", F.posexplode_outer("words").alias("p", "w"))
    first = F.col("p").isNull() | (F.col("p") == 0)
    per_word = exploded.groupBy("g", F.lower("w").alias("lw")).agg(
        F.count("w").alias("c"),
        F.sum(F.when(first, 1).otherwise(0)).alias("units"),
        F.sum(F.when(first, F.col("n_sent")).otherwise(0)).alias("sents"))
    return per_word.groupBy("g").agg(
        F.sum("units").cast("bigint").alias(unit_count_name),
        F.sum("sents").cast("bigint").alias("n_sentences"),
        F.sum("c").cast("bigint").alias("n_tokens"),
        F.count("lw").cast("bigint").alias("vocab_size"),
    ).withColumnRenamed("g", group)


def share_of_total(df: DataFrame, count_col: str, digits: int = 2) -> Column:
    """WIN-07: percentage of the grand total, rounded.

    The total is a scalar subquery (computed once, inlined as a value), so no
    single-partition window and no join is needed.
    """
    total = df.select(F.sum(count_col)).scalar()
    return F.round(F.col(count_col) * 100.0 / total, digits)


def value_counts(df: DataFrame, col: str, top: int | None = None) -> DataFrame:
    """AGG-05: count per value, descending, ties by value; optional top-N."""
    out = df.groupBy(col).agg(F.count("*").alias("n"))
    if top is not None:
        out = out.orderBy(F.desc("n"), F.asc(col)).limit(top)
    return out


def distinct_per_column(df: DataFrame) -> DataFrame:
    """``column`` (number), ``n_distinct`` and ``n_null`` of every column that has rows, exact up to 128-bit hashes.

    One pass: a row becomes a (column, hash of the value) pair per column, null for a null value, so values themselves
    (texts) never enter a shuffle.  Pairs are combined before the shuffle, and a column's pairs spread over its hashes.
    """
    pairs = []
    for i, f in enumerate(df.schema.fields):
        c = F.col(f"`{f.name}`")
        if f.dataType.simpleString() in ("float", "double"):
            c = c + F.lit(0.0)  # one zero
        pairs.append(F.struct(F.lit(i).alias("column"), F.unhex(F.md5(c.cast("string").cast("binary"))).alias("h")))
    seen = df.select(F.explode(F.array(*pairs)).alias("p")).select("p.column", "p.h") \
        .groupBy("column", "h").agg(F.count(F.lit(1)).alias("n"))
    return seen.groupBy("column").agg(
        F.count("h").cast("bigint").alias("n_distinct"),
        F.coalesce(F.sum(F.when(F.col("h").isNull(), F.col("n"))), F.lit(0)).cast("bigint").alias("n_null"),
        F.sum("n").cast("bigint").alias("n_rows"))


def _named_columns(df: DataFrame, kinds: dict[str, str] | None = None) -> Column:
    """The names (and kinds) of the columns, one row each, as an array."""
    return F.array(*[F.struct(F.lit(i).alias("column"), F.lit(c).alias("column_name"),
                              F.lit((kinds or {}).get(c)).cast("string").alias("kind")) for i, c in enumerate(df.columns)])


def distinct_counts(df: DataFrame, categorical_below: int = 20) -> DataFrame:
    """AGG-06: exact distinct values per column, one row per column (0 where there are no rows)."""
    names = df.sparkSession.range(1).select(F.explode(_named_columns(df)).alias("c")).select("c.*")
    counts = names.join(distinct_per_column(df), "column", "left") \
        .select("column_name", F.coalesce("n_distinct", F.lit(0)).cast("bigint").alias("n_distinct"))
    return counts.withColumn("is_categorical", F.col("n_distinct") < categorical_below)


QUARTILES = (0.25, 0.5, 0.75)


def quantiles(df: DataFrame, col: str, at: tuple[float, ...] = QUARTILES, group: str | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation, per group: ``group`` and the array ``q`` (null without values).

    Distinct values are counted, sorted in ranges over the whole cluster, and given the number of rows before them from
    running counts within each range and one row per range and group; the ranks that are asked for are then picked.  No
    task ever holds a group's values.
    """
    g = F.col(f"`{group}`") if group else F.lit(0)
    values = df.select(g.alias("g"), F.col(f"`{col}`").alias("x")).filter("x IS NOT NULL").groupBy("g", "x") \
        .agg(F.count(F.lit(1)).alias("n"))
    ordered = cut_lineage(values.repartitionByRange("g", "x").withColumn("pid", F.spark_partition_id()))
    running = Window.partitionBy("pid", "g").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    heads = ordered.groupBy("pid", "g").agg(F.sum("n").alias("m"))
    every = Window.partitionBy("g")
    heads = heads.select(F.col("pid").alias("hp"), F.col("g").alias("hg"), F.sum("m").over(every).alias("total"),
                         (F.sum("m").over(every.orderBy("pid")) - F.col("m")).alias("before"))
    placed = ordered.withColumn("run", F.sum("n").over(running)) \
        .join(heads, (F.col("pid") == F.col("hp")) & F.col("g").eqNullSafe(F.col("hg"))) \
        .select("g", F.col("x").cast("double").alias("x"), "total", (F.col("before") + F.col("run") - F.col("n")).alias("a"),
                (F.col("before") + F.col("run")).alias("b"))
    picked, parts = [], []
    for i, p in enumerate(at):
        place = F.lit(float(p)) * (F.col("total") - 1)
        for name, rank in (("low", F.floor(place)), ("high", F.ceil(place))):
            picked.append(F.max(F.when((F.col("a") <= rank) & (rank < F.col("b")), F.col("x"))).alias(f"{name}{i}"))
        parts.append(F.col(f"low{i}") + (F.col(f"high{i}") - F.col(f"low{i}")) * (place - F.floor(place)))
    found = placed.groupBy("g", "total").agg(*picked).select("g", F.array(*parts).alias("q"))
    return found.select(*([F.col("g").alias(group)] if group else []), "q")


def _with_quartiles(df: DataFrame, out: DataFrame, col: str, group: str | None) -> DataFrame:
    q = quantiles(df, col, QUARTILES, group)
    if not group:
        return out.join(q, F.lit(True), "left")
    return out.join(q.withColumnRenamed(group, "_g"), F.col(group).eqNullSafe(F.col("_g")), "left").drop("_g")


def describe(df: DataFrame, col: str, group: str | None = None) -> DataFrame:
    """AGG-07: count, mean, sample std, min, exact quartiles (linear interpolation), max."""
    x = F.col(col)
    aggs = [F.count(x).alias("count"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"),
            F.min(x).cast("double").alias("min"), F.max(x).cast("double").alias("max")]
    out = _with_quartiles(df, df.groupBy(group).agg(*aggs) if group else df.agg(*aggs), col, group)
    return out.select(*([group] if group else []), "count", "mean", "std", "min",
                      F.col("q")[0].alias("p25"), F.col("q")[1].alias("p50"), F.col("q")[2].alias("p75"), "max")


def five_number(df: DataFrame, col: str, group: str) -> DataFrame:
    """AGG-13: min, quartiles, median, max per group (box-plot inputs)."""
    x = F.col(col)
    ends = df.groupBy(group).agg(F.min(x).cast("double").alias("min"), F.max(x).cast("double").alias("max"))
    return _with_quartiles(df, ends, col, group).select(
        group, "min", F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"), "max")


def histogram(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """AGG-12: equal-width bins between min and max; the last bin includes the max."""
    bounds = df.agg(F.min(col).cast("double").alias("lo"), F.max(col).cast("double").alias("hi"))
    lo = bounds.select("lo").scalar()
    hi = bounds.select("hi").scalar()
    width = (hi - lo) / F.lit(float(bins))
    b = F.when(hi == lo, F.lit(0)).otherwise(
        F.least(F.floor((F.col(col) - lo) / width), F.lit(bins - 1))).cast("int")
    counts = df.select(b.alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    return counts.select("bin", (lo + F.col("bin") * width).alias("bin_lo"),
                         (lo + (F.col("bin") + 1) * width).alias("bin_hi"), "n")


def recode(c: Column, mapping: dict[str, str]) -> Column:
    """PRJ-08: replace listed values, keep the rest."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.try_element_at(m, c), c)


def estimated_words(df: DataFrame) -> Column:
    """PRJ-23: ``word_count`` if present, else ``pages * 300``, else null (schema test)."""
    cols = set(df.columns)
    if "word_count" in cols and "pages" in cols:
        return F.coalesce(F.col("word_count"), F.col("pages") * 300)
    if "word_count" in cols:
        return F.col("word_count")
    if "pages" in cols:
        return F.col("pages") * 300
    return F.lit(None).cast("bigint")


_NUMERIC = ("byte", "short", "int", "bigint", "long", "float", "double", "decimal")


def column_profile(df: DataFrame) -> DataFrame:
    """AGG-14: per column kind (numeric/text), nulls and distinct values; rows and columns."""
    kinds = {f.name: ("numeric" if f.dataType.simpleString().startswith(_NUMERIC) else "text")
             for f in df.schema.fields}
    names = df.sparkSession.range(1).select(F.explode(_named_columns(df, kinds)).alias("c")).select("c.*")
    none = F.lit(0).cast("bigint")
    return names.join(distinct_per_column(df), "column", "left").select(
        "column_name", "kind", F.coalesce("n_null", none).alias("n_null"), F.coalesce("n_distinct", none).alias("n_distinct"),
        F.coalesce("n_rows", none).alias("n_rows"), F.lit(len(df.columns)).cast("bigint").alias("n_columns"))
