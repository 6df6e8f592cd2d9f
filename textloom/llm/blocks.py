"""Exact dedup by deterministic block naming, with DataFrame operations only.

The A-Z-lower-cased UTF-8 bytes of each text are cut into blocks of a fixed size.  Blocks are sorted and equal ones
get one integer name, then adjacent names are paired and each distinct pair is named in the same way, until a text
has one name.  Names come from comparing whole blocks and whole pairs, so the last name, together with the number of
blocks, identifies a text without collisions.

Sorting is split over ``BUCKETS`` hash buckets (a name is the rank in its bucket and the bucket), so it needs one
shuffle of the blocks.  Hot keys (a share of over 1 / ``HOT_SHARE`` of all rows, so at most ``HOT_SHARE`` of them)
are found by a hash count, named from a partially aggregated group and looked up in a broadcast of that bounded
size; their rows carry no block into the shuffle.  Written tables in the shared folder cut the lineage.

Defined results.  A null text is empty; all empty texts are equal.  Repeated rows (same id and text) count each;
``kept`` marks every row carrying the largest id of its group (an id identifies a document).  Null ids are never the
largest; a group of null ids only keeps the null id.  An empty table gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import Scratch, lower_ascii, stored

BLOCK_BYTES = 2048
HOT_SHARE = 1000
BUCKETS = 1 << 20


def cut_blocks(docs: DataFrame, id_col: str, text_col: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per block: id, rid (the number of the row), n_blocks, pos, block; the digest goes with the first."""
    text = lower_ascii(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text.alias("text")) \
        .select("id", F.monotonically_increasing_id().alias("rid"), F.sha2(F.col("text"), 256).alias("sha"),
                F.col("text").cast("binary").alias("bytes")) \
        .withColumn("n_blocks", F.greatest(F.lit(1), F.ceil(F.octet_length("bytes") / block_bytes)).cast("int"))
    blocks = F.transform(F.sequence(F.lit(0), F.col("n_blocks") - 1),
                         lambda i: F.substring(F.col("bytes"), i * block_bytes + 1, F.lit(block_bytes)))
    return rows.select("id", "rid", "sha", "n_blocks", F.posexplode(blocks).alias("pos", "block")) \
        .withColumn("sha", F.when(F.col("pos") == 0, F.col("sha")))


def named(rows: DataFrame, key: list[str], hot_share: int = HOT_SHARE, least_hot: int = 100) -> DataFrame:
    """``rows`` with ``name`` in place of ``key``: an integer, equal for equal keys and for no others."""
    counts = rows.groupBy(F.xxhash64(*key).alias("h")).count()
    total = counts.agg(F.sum("count").alias("total"))
    hot = counts.join(F.broadcast(total), F.col("count") * hot_share > F.col("total")) \
        .filter(F.col("count") > least_hot).select("h")
    # At most hot_share hashes have that share, so both broadcasts and the one sorted window are bounded.
    names = rows.join(F.broadcast(hot), F.xxhash64(*key) == F.col("h"), "left_semi").select(*key).distinct() \
        .select(*key, (-F.row_number().over(Window.orderBy(*key))).cast("long").alias("hot_name"))
    same = reduce(lambda a, b: a & b, [F.col(f"r.{k}").eqNullSafe(F.col(f"n.{k}")) for k in key])
    looked = rows.alias("r").join(F.broadcast(names).alias("n"), same, "left").select("r.*", "n.hot_name")
    # Hot rows have their name already: they carry no key further and are spread by their id.
    is_hot = F.col("hot_name").isNotNull()
    rest = [c for c in rows.columns if c not in key]
    bucket = F.when(is_hot, -1 - F.pmod(F.xxhash64("id", "pos"), F.lit(BUCKETS))) \
        .otherwise(F.pmod(F.xxhash64(*key), F.lit(BUCKETS)))
    rank = F.dense_rank().over(Window.partitionBy("bucket").orderBy(*key)).cast("long")
    return looked.select(*rest, "hot_name", bucket.alias("bucket"),
                         *[F.when(~is_hot, F.col(k)).alias(k) for k in key]) \
        .withColumn("name", F.coalesce(F.col("hot_name"), rank * BUCKETS + F.col("bucket"))) \
        .select(*rest, "name")


def text_names(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               block_bytes: int = BLOCK_BYTES, stored: Callable[[DataFrame], DataFrame] = stored) -> DataFrame:
    """One row per row of ``docs``: id, sha, n_blocks, name.  Texts are equal when (n_blocks, name) are.  The result reads
    tables written with ``stored``."""
    first = stored(named(cut_blocks(docs, id_col, text_col, block_bytes), ["block"]))
    done = [first.filter("n_blocks = 1").select("id", "sha", "n_blocks", "name")]
    level = first.filter("n_blocks > 1").groupBy("id", "rid", "n_blocks", "pos").agg(F.min("name").alias("name"))
    span, longest = 1, first.agg(F.max("n_blocks")).first()[0] or 1
    ended = []
    while span < longest:
        span *= 2
        pairs = level.groupBy("id", "rid", "n_blocks", F.floor(F.col("pos") / 2).cast("int").alias("pos")).agg(
            F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("left"),
            F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))).alias("right"))
        level = stored(named(pairs, ["left", "right"]))
        ended.append(level.filter((F.col("n_blocks") <= span)))
        level = level.filter(F.col("n_blocks") > span)
    if ended:
        heads = first.filter("n_blocks > 1 AND pos = 0").select(F.col("id").alias("head_id"), "rid", "sha")
        last = reduce(DataFrame.unionByName, ended)
        done.append(last.join(heads, ["rid"]).filter(F.col("id").eqNullSafe(F.col("head_id")))
                    .select("id", "sha", "n_blocks", "name"))
    return reduce(DataFrame.unionByName, done)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs``: id_col, keep_id, group_size, kept, text_sha256, n_blocks, name."""
    scratch = Scratch(docs.sparkSession)
    rows = scratch.stored(text_names(docs, id_col, text_col, block_bytes, scratch.stored))
    # Written before the join: then both sides are shuffled for it, and Spark can split a hot group.
    groups = scratch.stored(rows.groupBy("n_blocks", "name").agg(F.max("id").alias("keep_id"),
                                                             F.count("*").alias("group_size")))
    out = stored(rows.join(groups, ["n_blocks", "name"]).select(
        F.col("id").alias(id_col), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("sha").alias("text_sha256"), "n_blocks", "name"))
    scratch.clear()
    return out


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that lose to an equal text of a larger id."""
    lost = exact_groups(docs, id_col, text_col).filter("NOT kept").select(id_col, "text_sha256").distinct()
    sha = F.sha2(lower_ascii(F.coalesce(F.col(f"docs.`{text_col}`"), F.lit(""))), 256)
    return docs.alias("docs").join(
        lost.alias("lost"), F.col(f"docs.`{id_col}`").cast("long").eqNullSafe(F.col(f"lost.`{id_col}`"))
        & (sha == F.col("lost.text_sha256")), "left_anti")
