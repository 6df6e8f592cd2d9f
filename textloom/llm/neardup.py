"""MinHash near-duplicates: universal hash minima, banding, signature and set checks, star components.

A document's set holds the hashes (64 bits) of its distinct word shingles.  Equal sets (128-bit fingerprint) form a
class, and only the smallest id of a class goes on.  ``BANDS`` x ``ROWS`` minima of universal hashes a*x+b make the
signature; documents that agree in all rows of a band share a bucket.  With these numbers a pair at similarity 0.85
shares no bucket once in 40 million (``MORE_BANDS`` does the same for 0.8, once in 8 million).

Links inside a bucket are found in two steps that list no pairs:

* star: every bucket compares one member (the one that shares most buckets, so the centre of a group of copies) with
  the others.  These pairs pass the signature check (low bytes of the minima; it drops a true link once in 10^11),
  then the full sets are compared.  Components follow, by alternating large-star and small-star steps.
* blocks: buckets whose other members are not yet in one component (buckets of the same members count once) are cut
  into blocks of bounded size.  A task gets two blocks, multiplies their sets as matrices, and returns one row per
  document that it can join with another component, so what leaves a task grows with its documents, not its pairs.
  Here sets are compared without the signature check.

Together every pair of a bucket that could join two components has its sets compared.

Defined results.  A null text, or one without words, has an empty set and links with nothing; fewer words than a
shingle make one shingle.  Rows of one id are one document: links of any of its texts count.  Null ids link with
nothing and keep a null component.  An empty table gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import Scratch, in_batches, split_words, stored

BANDS, ROWS = 30, 5  # for 0.85
MORE_BANDS = 40  # for 0.8
_SEED = 20240229
SIGNATURE_SLACK = 0.2  # a signature may agree this much less than the similarity asked for
BLOCK_DOCS, BLOCK_SHINGLES = 1024, 1 << 20  # of one block, about
_COLUMNS = 4096


def shingle_hashes(words: list[bytes], width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of ``width`` words."""
    if not words:
        return np.zeros(0, dtype=np.uint64)
    x = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    span = min(width, len(words))
    n = len(x) - span + 1
    mixed = np.full(n, 0x9E3779B97F4A7C15 + span, dtype=np.uint64)
    for k in range(span):
        mixed = (mixed ^ x[k:k + n]) * np.uint64(0xFF51AFD7ED558CCD)
        mixed ^= mixed >> np.uint64(32)
    mixed.sort()
    return mixed[np.concatenate(([True], mixed[1:] != mixed[:-1]))]


def _universal(count: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(_SEED)
    return (rng.integers(0, 2**32, count, dtype=np.uint32) | np.uint32(1),
            rng.integers(0, 2**32, count, dtype=np.uint32))


def signatures(sets: list[np.ndarray], count: int) -> np.ndarray:
    """Minima of ``count`` universal hashes of each (not empty) set, one row per set."""
    a, b = _universal(count)
    x = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((len(sets), count), dtype=np.uint32)
    for k in range(count):
        out[:, k] = np.minimum.reduceat(x * a[k] + b[k], starts)
    return out


def _mark_task(id_col: str, text_col: str, width: int, bands: int, rows: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_batches(batches, 256, text_col, 1 << 20):
            ids = batch.column(batch.schema.get_field_index(id_col))
            texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
            sets = [shingle_hashes(split_words(t), width) for t in texts]
            full = [i for i, s in enumerate(sets) if len(s)]
            prints: list = [None] * len(sets)
            sigs: list = [None] * len(sets)
            keys: list = [None] * len(sets)
            if full:
                made = signatures([sets[i] for i in full], bands * rows)
                for i, sig in zip(full, made, strict=True):
                    prints[i] = xxhash.xxh3_128_digest(sets[i].tobytes())
                    raw = sig.tobytes()
                    keys[i] = [xxhash.xxh3_64_intdigest(raw[4 * rows * k:4 * rows * (k + 1)], seed=k) - 2**63
                               for k in range(bands)]
                    sigs[i] = sig.astype(np.uint8).tobytes()  # low bytes: the high ones of minima are nearly all 0
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array([len(s) for s in sets], pa.int64()), pa.array(prints, pa.binary()),
                 pa.array(sigs, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                ["id", "n", "print", "sig", "keys"])
    return run


def _agree_task(least: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            left, right = (np.stack([np.frombuffer(x, np.uint8) for x in batch.column(c).to_pylist()])
                           for c in ("sig_a", "sig_b"))
            keep = pa.array((left == right).sum(axis=1) >= least)
            yield batch.select(["a", "b"]).filter(keep)
    return run


def least_agreeing(count: int, percent: int) -> int:
    """Rows of ``count`` that must agree: the similarity asked for less the slack, and 1/256 of the others by chance."""
    share = percent / 100 - SIGNATURE_SLACK
    return int(count * (share + (1 - share) / 256))


def _confirm_task(width: int, percent: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, known_set = None, None
        for batch in in_batches(batches, 256, "text_b", 1 << 22):
            keep = []
            for a, b in zip(batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist(), strict=True):
                if a != known:
                    known, known_set = a, shingle_hashes(split_words(a), width)
                own = shingle_hashes(split_words(b), width)
                both = len(np.intersect1d(known_set, own, assume_unique=True))
                keep.append(100 * both >= percent * (len(known_set) + len(own) - both) and both > 0)
            yield batch.select(["a", "b"]).filter(pa.array(keep))
    return run


def _joined(sets: list[np.ndarray], percent: int, apart: np.ndarray) -> np.ndarray:
    """The smallest index that each set is connected with by links between sets that are ``apart``."""
    n = np.array([len(x) for x in sets], dtype=np.float64)
    row = np.repeat(np.arange(len(sets)), n.astype(int))
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times[column] > 1  # the others are in no intersection
    row, column = row[shared], (np.cumsum(times > 1) - 1)[column[shared]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    both = np.zeros((len(sets), len(sets)), dtype=np.float64)
    for at in range(0, int((times > 1).sum()), _COLUMNS):
        a, b = np.searchsorted(column, (at, at + _COLUMNS))
        part = np.zeros((len(sets), _COLUMNS), dtype=np.float32)
        part[row[a:b], column[a:b] - at] = 1
        both += part @ part.T  # sums of at most _COLUMNS ones: exact
    link = (100 * both >= percent * (n[:, None] + n[None, :] - both)) & (both > 0) & apart
    np.fill_diagonal(link, True)
    least = np.arange(len(sets))
    while True:
        new = np.where(link, least[None, :], len(sets)).min(axis=1)
        new = new[new]
        if (new == least).all():
            return least
        least = new


def _block_task(width: int, percent: int) -> Callable:
    def run(block: pa.Table) -> pa.Table:
        # Repeated rows once; an id with two texts comes twice.
        rows = {(i, t): k for k, (i, t) in enumerate(zip(block.column("rep").to_pylist(),
                                                         block.column("text").to_pylist(), strict=True)) if t}
        block = block.select(["rep", "label"]).take(pa.array(list(rows.values()), pa.int64()))
        ids, labels = (block.column(c).to_numpy() for c in ("rep", "label"))
        sets = [shingle_hashes(split_words(t), width) for _, t in rows]
        least = _joined(sets, percent, labels[:, None] != labels[None, :])
        moved = least != np.arange(len(ids))
        return pa.table({"a": pa.array(ids[moved], pa.int64()), "b": pa.array(ids[least[moved]], pa.int64())})
    return run


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, stored: Callable[[DataFrame], DataFrame] = stored) -> DataFrame:
    """``node, label`` of every node of ``links`` (a, b): the smallest node it is connected with."""
    edges = stored(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = _state(edges)
    while before[0]:
        # Large-star: larger neighbours of each node go to the smallest one.  The minima are written so that the joins
        # have plain shuffles on both sides, which Spark can split where a node is hot.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = stored(both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                       .distinct())
        # Small-star: a node and its smaller neighbours go to the smallest of them.
        least = stored(large.groupBy("u").agg(F.min("v").alias("m")))
        edges = stored(large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                       .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        after = _state(edges)
        if after == before:
            break
        before = after
    labels = edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return stored(labels.unionByName(labels.select(F.col("label").alias("node"), "label").distinct()))


def _roughly_among(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """``texts`` without most rows that are not among ``ids``, so that a join moves fewer texts.

    A bitmap of 2^26 hash slots marks the ids.  It is broadcast: its size, 8 MB, is fixed.
    """
    slot = F.pmod(F.xxhash64("id"), F.lit(1 << 26))
    bits = ids.select(F.bitmap_bucket_number(slot).alias("bucket"), F.bitmap_bit_position(slot).alias("bit")) \
        .groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))
    at = F.bitmap_bit_position(slot)
    byte = F.conv(F.hex(F.substring(F.col("bits"), (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return texts.join(F.broadcast(bits), F.bitmap_bucket_number(slot) == F.col("bucket")) \
        .filter(F.getbit(byte, (at % 8).cast("int")) == 1).select(*texts.columns)


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, percent: int = 85,
                bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per row of ``docs``: id_col, n_shingles, component_id, kept."""
    scratch = Scratch(docs.sparkSession)
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    marks = stored(texts.mapInArrow(_mark_task("id", "text", width, bands, rows),
                                    "id long, n long, print binary, sig binary, keys array<long>"))
    classes = scratch.stored(marks.filter("print IS NOT NULL").groupBy("print").agg(
        F.min("id").alias("rep"), F.any_value("sig").alias("sig"), F.any_value("keys").alias("keys"),
        F.any_value("n").alias("n")))
    nodes = classes.filter("rep IS NOT NULL")
    # The key of a bucket is a hash of its band's number and minima.
    members = nodes.select("rep", F.explode("keys").alias("key"))
    shared = members.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1")
    members = scratch.stored(members.join(shared, "key"))
    weight = members.groupBy("rep").agg(F.sum("c").alias("weight"))
    members = scratch.stored(members.join(weight.join(nodes.select("rep", "n"), "rep"), "rep"))
    among = members.select(F.col("rep").alias("id")).distinct()
    texts = scratch.stored(_roughly_among(texts, among).join(among, "id", "left_semi"))

    def linked(pairs: DataFrame) -> DataFrame:
        sig = nodes.select("rep", "sig")
        least = least_agreeing(bands * rows, percent)
        close = scratch.stored(pairs.join(sig.select(F.col("rep").alias("a"), F.col("sig").alias("sig_a")), "a")
                       .join(sig.select(F.col("rep").alias("b"), F.col("sig").alias("sig_b")), "b")
                       .select("a", "b", "sig_a", "sig_b").mapInArrow(_agree_task(least), "a long, b long").distinct())
        return scratch.stored(close.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
                      .join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
                      .select("a", "b", "text_a", "text_b")
                      .mapInArrow(_confirm_task(width, percent), "a long, b long").distinct())

    in_bucket = Window.partitionBy("key").orderBy(F.desc("weight"), "rep")
    centres = scratch.stored(members.withColumn("rank", F.row_number().over(in_bucket)).filter("rank = 1")
                     .select("key", F.col("rep").alias("a")))
    around = members.join(centres, "key").filter("a <> rep")
    links = linked(around.select("a", F.col("rep").alias("b")).distinct())
    labels = components(links, scratch.stored).withColumnRenamed("node", "rep")

    rest = scratch.stored(around.filter("c > 2").join(labels, "rep", "left")
                  .select("key", "rep", "n", F.coalesce("label", "rep").alias("label")))
    # Buckets that hold two components, each set of members once.
    seen = rest.groupBy("key").agg(
        F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("size"), F.sum("n").alias("shingles"),
        *[F.sum(F.xxhash64("rep", F.lit(k)).cast("decimal(38,0)")).alias(f"members{k}") for k in (0, 1)]).filter("lo < hi")
    open_ = seen.groupBy("size", "members0", "members1").agg(
        F.min("key").alias("key"), F.any_value("shingles").alias("shingles")) \
        .select("key", F.greatest(F.ceil(F.col("size") / BLOCK_DOCS),
                                  F.ceil(F.col("shingles") / BLOCK_SHINGLES)).alias("blocks"))
    block = F.pmod(F.xxhash64("rep"), F.col("blocks"))
    todo = rest.join(open_, "key").select(
        "key", "rep", "label", block.alias("own"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
    todo = todo.select("key", "rep", "label", F.least("own", "other").alias("x"),
                       F.greatest("own", "other").alias("y"))
    more = todo.join(texts.withColumnRenamed("id", "rep"), "rep").groupBy("key", "x", "y") \
        .applyInArrow(_block_task(width, percent), "a long, b long").distinct()
    labels = components(links.unionByName(more), scratch.stored)

    names = classes.select("print", "rep").join(labels.withColumnRenamed("node", "rep"), "rep", "left")
    names = stored(names.select("print", F.coalesce("label", "rep").alias("label")))
    scratch.clear()
    return marks.select("id", "n", "print").join(names, "print", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("label", "id")).alias("component_id")) \
        .withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                     percent: int = 80) -> DataFrame:
    """``docs`` with one document of each near-duplicate group, the one of the smallest id."""
    lost = near_groups(docs, id_col, text_col, width, percent, bands=MORE_BANDS).filter("NOT kept") \
        .select(id_col).distinct()
    return docs.alias("docs").join(lost.alias("lost"), F.col(f"docs.`{id_col}`") == F.col(f"lost.`{id_col}`"),
                                   "left_anti")
