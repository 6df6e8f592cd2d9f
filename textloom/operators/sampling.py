"""Sampling, head fractions and seeded splits (SMP-01..08).

Every operator is "order rows by a total key, keep a prefix of computed length".
The reference shuffles with a seeded PRNG; here the seeded order is
``md5(seed || ':' || key)`` (portable, so the DuckDB oracle reproduces it) and
the contract is "deterministic for a seed, exact sizes".

Global row numbers are computed without a single-partition window: a range
partitioned sort (the sampled range bounds split hot keys across partitions),
tagged with partition id and in-partition position, then checkpointed so the
ids are fixed (range bounds are sampled per plan, so two branches of one plan
may otherwise cut differently); per-partition row counts (one row per
partition) give prefix offsets, joined back by broadcast — its size is bounded
by the number of partitions, not by the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.session import cut_lineage


def seeded_key(seed: int, *cols) -> Column:
    """Hex md5 of ``seed:k1:k2...`` — the seeded shuffle order."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(c) if isinstance(c, str) else c for c in cols]))


def global_rank(df: DataFrame, order: list[Column], rank_col: str = "rank",
                num_partitions: int | None = None) -> DataFrame:
    """1-based position of each row in ``order`` (which must be a total order)."""
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    tagged = (ordered.withColumn("_pid", F.spark_partition_id())
              .withColumn("_local", F.monotonically_increasing_id()
                          - F.shiftleft(F.col("_pid").cast("long"), 33)))
    tagged = cut_lineage(tagged)
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid", (F.sum("_n").over(Window.orderBy("_pid")) - F.col("_n")).alias("_off"))
    return (tagged.join(F.broadcast(offsets), "_pid")
            .withColumn(rank_col, F.col("_off") + F.col("_local") + 1)
            .drop("_pid", "_local", "_off"))


def hash_rank(df: DataFrame, hash_hex: Column, tie_cols: list[str], rank_col: str = "rank",
              bits: int = 16) -> DataFrame:
    """1-based position in (``hash_hex``, ``tie_cols``) order for a uniform hex hash.

    md5 is uniform, so the order's range boundaries are known without sampling:
    bucket = the leading ``bits`` bits (2^16 buckets: about 15 million rows per
    bucket at 10^12 rows).  Per-bucket counts (at most 2^bits rows — a fixed
    bound) give offsets by a prefix sum and are broadcast; the in-bucket position
    is a window over one bucket.  Everything derives from the data, so a
    recomputed task gives the same ranks; no sort sample, no checkpoint, two
    passes over the input.
    """
    h = df.withColumn("_h", hash_hex).withColumn(
        "_b", F.shiftright(F.conv(F.substring(F.col("_h"), 1, 8), 16, 10).cast("long"), 32 - bits))
    counts = h.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("_b", (F.sum("_n").over(Window.orderBy("_b")) - F.col("_n")).alias("_off"))
    w = Window.partitionBy("_b").orderBy("_h", *tie_cols)
    return (h.join(F.broadcast(offsets), "_b")
            .withColumn(rank_col, F.col("_off") + F.row_number().over(w))
            .drop("_h", "_b", "_off"))


def _seeded_rank(df: DataFrame, key_cols: list[str], seed: int, rank_col: str = "_r") -> DataFrame:
    return hash_rank(df, seeded_key(seed, *key_cols), key_cols, rank_col)


def row_count(df: DataFrame) -> Column:
    """Total row count as a scalar subquery (evaluated once)."""
    return df.select(F.count(F.lit(1))).scalar()


def head_fraction(df: DataFrame, order: list[Column], fraction: float) -> DataFrame:
    """SMP-01: first ``floor(n * fraction)`` rows in ``order``."""
    k = F.floor(row_count(df) * F.lit(float(fraction)))
    return global_rank(df, order, "_r").filter(F.col("_r") <= k).drop("_r")


def seeded_first(df: DataFrame, key_cols: list[str], seed: int, k: Column, bits: int = 16) -> Column:
    """Whether a row of ``df`` is among the first ``k`` in the seeded order.

    The k-th key is found from bucket counts and a rank inside the one bucket it falls into, both over keys only;
    rows are then compared with it where they are, so no row moves.
    """
    h = seeded_key(seed, *key_cols)
    keys = df.select(h.alias("_h"), *key_cols).withColumn(
        "_b", F.shiftright(F.conv(F.substring("_h", 1, 8), 16, 10).cast("long"), 32 - bits))
    counts = keys.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("_b", "_n", (F.sum("_n").over(Window.orderBy("_b")) - F.col("_n")).alias("_off"))
    edge = offsets.filter((F.col("_off") < k) & (k <= F.col("_off") + F.col("_n"))).select("_b", "_off")  # one row
    rank = F.row_number().over(Window.partitionBy("_b").orderBy("_h", *key_cols))
    last = keys.join(F.broadcast(edge), "_b").withColumn("_r", F.col("_off") + rank).filter(F.col("_r") == k) \
        .select(F.struct("_h", *key_cols)).scalar()
    return F.when(k <= 0, False).when(k >= row_count(df), True).otherwise(F.struct(h, *key_cols) <= last)


def head_of_groups(rows: DataFrame, group: str, place: str, fraction: float) -> DataFrame:
    """SMP-01 for rows that come in groups (lines of documents): the first ``floor(n * fraction)`` rows in the order of
    (``group``, ``place``).

    Only the groups' sizes are sorted: running counts find the one group in which the head ends, and the rows are then cut
    where they are.  ``place`` orders the rows of a group, which may have gaps but no ties; groups are not null.
    """
    sizes = rows.groupBy(group).agg(F.count(F.lit(1)).alias("_n"))
    ordered = cut_lineage(sizes.repartitionByRange(group).withColumn("_pid", F.spark_partition_id()))
    parts = ordered.groupBy("_pid").agg(F.sum("_n").alias("_m"))
    offsets = parts.select("_pid", (F.sum("_m").over(Window.orderBy("_pid")) - F.col("_m")).alias("_off"),
                           F.sum("_m").over(Window.partitionBy()).alias("_total"))
    running = Window.partitionBy("_pid").orderBy(group).rowsBetween(Window.unboundedPreceding, 0)
    upto = ordered.withColumn("_run", F.sum("_n").over(running)).join(F.broadcast(offsets), "_pid") \
        .select(group, "_n", (F.col("_off") + F.col("_run")).alias("_upto"),
                F.floor(F.col("_total") * F.lit(float(fraction))).alias("_k"))
    last = upto.filter((F.col("_upto") - F.col("_n") < F.col("_k")) & (F.col("_upto") >= F.col("_k"))) \
        .select(group, (F.col("_k") - F.col("_upto") + F.col("_n")).alias("_left")).first()
    if last is None:
        return rows.limit(0)
    whole = rows.filter(F.col(group) < F.lit(last[group]))
    if not last["_left"]:
        return whole
    cut = rows.filter(F.col(group) == F.lit(last[group])).orderBy(place).limit(last["_left"])
    return whole.unionByName(cut)


def shuffled_fraction(df: DataFrame, key_cols: list[str], fraction: float, seed: int = 42) -> DataFrame:
    """SMP-02: seeded shuffle, then head fraction."""
    k = F.floor(row_count(df) * F.lit(float(fraction)))
    return df.filter(seeded_first(df, key_cols, seed, k))


def train_valid_split(df: DataFrame, key_cols: list[str], train_split: float, seed: int = 42) -> DataFrame:
    """SMP-03: seeded shuffle; the first ``floor(n * train_split)`` rows are train."""
    k = F.floor(row_count(df) * F.lit(float(train_split)))
    return df.withColumn("split", F.when(seeded_first(df, key_cols, seed, k), "train").otherwise("valid"))


def _three_way_sizes(n: Column, split: tuple[float, float, float], repair: bool):
    n_train = F.greatest(F.lit(1), F.floor(n * F.lit(float(split[0]))))
    n_val = F.greatest(F.lit(1), F.floor(n * F.lit(float(split[1]))))
    if not repair:
        return n_train, n_val, None
    n_test = F.greatest(F.lit(1), n - n_train - n_val)
    over = n_train + n_val + n_test - n
    # reduce train, then validation, then test, each keeping at least one row
    r_train = F.when(over > 0, F.least(over, n_train - 1)).otherwise(0)
    over2 = over - r_train
    r_val = F.when(over2 > 0, F.least(over2, n_val - 1)).otherwise(0)
    over3 = over2 - r_val
    r_test = F.when(over3 > 0, F.least(over3, n_test - 1)).otherwise(0)
    return n_train - r_train, n_val - r_val, n_test - r_test


def three_way_split(df: DataFrame, key_cols: list[str], split=(0.8, 0.1, 0.1), seed: int = 42,
                    repair: bool = False) -> DataFrame:
    """SMP-04 (``repair=False``: test = all the rest) and SMP-05 (overflow repair)."""
    n = row_count(df)
    n_train, n_val, n_test = _three_way_sizes(n, split, repair)
    def first(k):
        return seeded_first(df, key_cols, seed, k)

    label = (F.when(n < 3, F.raise_error(F.lit("need at least 3 rows for train/validation/test")))
             .when(first(n_train), "train")
             .when(first(n_train + n_val), "validation"))
    if n_test is None:
        label = label.otherwise("test")
    else:
        label = label.when(first(n_train + n_val + n_test), "test")
    out = df.withColumn("split", label)
    return out.filter(F.col("split").isNotNull())


def sample_n(df: DataFrame, key_cols: list[str], n: int, seed: int = 42) -> DataFrame:
    """SMP-06: exactly ``n`` seeded rows; fails when fewer exist (top-k: sort-limit)."""
    order = [seeded_key(seed, *key_cols)] + [F.col(c) for c in key_cols]
    total = row_count(df)
    picked = df.orderBy(*order).limit(n)
    return picked.filter(
        F.when(total < n, F.raise_error(F.lit("sample larger than population"))).otherwise(F.lit(True)))


def first_n(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """SMP-07: first ``min(n, count)`` rows in order (top-k, sort-limit)."""
    return df.orderBy(*order).limit(n)


def position_cap(df: DataFrame, key_cols: list[str], cap: int, seed: int = 42) -> DataFrame:
    """SMP-08: at most ``cap`` positions, seeded, without replacement."""
    return df.filter(seeded_first(df, key_cols, seed, F.lit(cap).cast("long")))


def rank_within(df: DataFrame, key: str, order: list[str], rank_col: str = "pos") -> DataFrame:
    """WIN-02 ordinals per key, skew-safe: one global rank over (key, order) — range
    partitioned, so a hot key spans many partitions — minus the key's first rank
    (a per-key ``min`` aggregate joined back)."""
    ranked = global_rank(df, [F.col(key)] + [F.col(c) for c in order], "_g")
    first = ranked.groupBy(key).agg(F.min("_g").alias("_g0"))
    return (ranked.join(first, key).withColumn(rank_col, (F.col("_g") - F.col("_g0") + 1).cast("bigint"))
            .drop("_g", "_g0"))
