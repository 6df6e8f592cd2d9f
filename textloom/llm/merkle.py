"""Merkle manifest of a dataset, with proofs, by a butterfly exchange between partitions.

Each row is a leaf; the leaves of a source, in id order, form a tree of fan-out 16, and the roots of the sources form
one more above them.  H is SHA-256 over inputs joined end to end, digests as lower-case hex.

The leaves of a source are cut into partitions of 16^``LOW_LEVELS`` consecutive ones, aligned to the tree, so a partition's task
knows the lowest levels whole.  What is above comes from a butterfly: in round r the groups of 16^r
partitions that share a parent swap the roots of their subtrees.  Every partition of a group holds that root; the
t-th one sends it to the t-th one of each sibling group (to more where a ragged group is smaller than its
siblings), so a partition gets 16 digests at most, and hashes the parent itself, as its neighbours do.  Each
round is one shuffle of a row per digest and partition; after the last one each partition holds the root and all
siblings on its path, and no pass leads down again.  The same rounds, over groups of the partitions of 16^r
sources, climb the tree of sources.

Only digests are shuffled, texts never.  Ranks come from a range-partitioned sort of the leaves (rows are told apart
by a row number, so a hot id or source is split) and from one row per task and source.

Defined results.  Each null field is ``-``; null and empty differ.  Null sources come first, as one source; within a
source null ids come first, rows of one id are ordered by leaf, repeated rows are leaves of their own (with equal
digests, at neighbouring places).  A tree of one leaf is that leaf; its proof is the digest of nothing.  Texts of any
length are hashed whole.  An empty table has no rows and no root.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import Scratch, lower_ascii, stored

FANOUT = 16
LOW_LEVELS = 3  # levels within a partition
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_digest(fields: list[Column]) -> Column:
    """H of the fields, each ``-`` if null, else its length in bytes, ``:`` and itself."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
                             for t in texts]), 256)


def manifest_leaves(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source",
                    fields: tuple[str, ...] = FIELDS, changed: dict[str, Column] | None = None) -> DataFrame:
    """One row per row of ``docs``: id, source, leaf and, where ``changed`` gives other values to some fields that make
    another leaf, ``other``: that leaf."""
    at = {c: F.col(f"`{c}`") for c in fields}
    other = leaf_digest([(changed or {}).get(c, at[c]) for c in fields]) if changed else F.lit(None).cast("string")
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{source_col}`").cast("string").alias("source"),
                       leaf_digest(list(at.values())).alias("leaf"), other.alias("other")) \
        .select("id", "source", F.unhex("leaf").alias("leaf"), F.unhex(F.nullif("other", "leaf")).alias("other"))


def lower_where(text: Column, condition: Column) -> Column:
    """The text, with A-Z in lower case where the condition holds."""
    return F.when(F.coalesce(condition, F.lit(False)), lower_ascii(text)).otherwise(text)


def _ranked(leaves: DataFrame, scratch: Scratch, part_leaves: int) -> tuple[DataFrame, DataFrame]:
    """The leaves with ``pos`` in their source, ``part`` (a number of the partition over all sources) and what is known of
    the source; and the sources: s (their rank), n leaves, n_parts, and first part."""
    # Null first, then bytewise.
    key = F.when(F.col("source").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col("source")))
    rows = scratch.stored(leaves.select("id", key.alias("key"), "leaf", "other")
                          .withColumn("row", F.monotonically_increasing_id()))
    order = ["key", "id", "leaf", "row"]
    rows = scratch.stored(rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("row")
                          .withColumn("at", F.monotonically_increasing_id()))
    task = F.shiftright("at", 33)
    heads = scratch.stored(rows.groupBy(task.alias("task"), "key").agg(F.min("at").alias("first_at"),
                                                                      F.count("*").alias("c")))
    sources = heads.groupBy("key").agg(F.min("task").alias("task"), F.sum("c").alias("n")) \
        .withColumn("n_parts", F.ceil(F.col("n") / part_leaves))
    # Sources are counted by the task in which they begin: one row per task, then a window within each task.
    tasks = sources.groupBy("task").agg(F.count("*").alias("n_s"), F.sum("n_parts").alias("n_p"))
    by_task = Window.orderBy("task")
    tasks = tasks.select("task", (F.sum("n_s").over(by_task) - F.col("n_s")).alias("s_before"),
                         (F.sum("n_p").over(by_task) - F.col("n_p")).alias("p_before"))
    inside = Window.partitionBy("task").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    sources = scratch.stored(sources.join(tasks, "task").select(
        "key", "n", "n_parts", (F.col("s_before") + F.count("*").over(inside) - 1).alias("s"),
        (F.col("p_before") + F.sum("n_parts").over(inside) - F.col("n_parts")).alias("first")))
    by_key = Window.partitionBy("key").orderBy("task")
    heads = heads.withColumn("before", F.sum("c").over(by_key) - F.col("c") - F.col("first_at")).drop("c", "first_at") \
        .join(sources.select("key", "s", "first", "n_parts"), "key").withColumnRenamed("key", "k")
    placed = rows.join(heads, (F.col("key") == F.col("k")) & (task == F.col("task"))) \
        .select("id", "leaf", "other", (F.col("before") + F.col("at")).alias("pos"), "s", "first", "n_parts")
    return placed.withColumn("part", F.col("first") + F.floor(F.col("pos") / part_leaves)), sources


def _digest(nodes: list[str]) -> str:
    return sha256("".join(nodes).encode()).hexdigest()


def _raised(nodes: list[str]) -> list[str]:
    return [_digest(nodes[k:k + FANOUT]) for k in range(0, len(nodes), FANOUT)]


def _levels(leaves: list[str], whole: bool, low_levels: int) -> list[list[str]]:
    """The levels of a partition: so many above the leaves, or up to a single node where it is a ``whole`` source."""
    out = [leaves]
    while len(out[-1]) > 1 if whole else len(out) <= low_levels:
        out.append(_raised(out[-1]))
    return out


def _part_task(low_levels: int) -> Callable:
    """One row per partition, from its leaves in order (a partition's rows are neighbours)."""
    names = ["part", "s", "first", "n_parts", "ids", "leaves", "others", "changed", "node"]
    types = [pa.int64()] * 4 + [pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary(), pa.binary()]

    def row(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held)
        part, s, first, n_parts = (rows.column(c)[0].as_py() for c in names[:4])
        leaves, others = rows.column("leaf").to_pylist(), rows.column("other").to_pylist()
        node = _levels([x.hex() for x in leaves], n_parts == 1, low_levels)[-1][0]
        values = [part, s, first, n_parts, rows.column("id").to_pylist(), b"".join(leaves),
                  b"".join(x for x in others if x is not None), bytes(x is not None for x in others),
                  bytes.fromhex(node)]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            parts = batch.column(batch.schema.get_field_index("part")).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if held and held[0].column(held[0].schema.get_field_index("part"))[0].as_py() != parts[a]:
                    yield row(held)
                    held = []
                held.append(batch.slice(a, b - a))
        if held:
            yield row(held)

    return run


def _swap(state: DataFrame) -> DataFrame:
    """One round.  ``state`` has part, node, path and ``q`` (number of its group), ``t`` (its place there) and ``peers``
    (the groups of its run: q, start, size); ``more`` is false where the tree has ended."""
    own = F.element_at("peers", (F.col("q") - F.element_at("peers", 1)["q"] + 1).cast("int"))["size"]
    # The t-th of a group serves the places t, t + size, ... of each sibling group.
    targets = F.flatten(F.transform("peers", lambda p: F.when(
        F.col("t") < p["size"], F.transform(F.sequence(F.col("t"), p["size"] - 1, own), lambda o: p["start"] + o))
        .otherwise(F.array().cast("array<bigint>"))))
    mine = F.struct("s", "first", "n_parts", "node", "path", "q", "more")
    sent = state.withColumn("targets", targets).withColumn("mine", mine) \
        .select("part", "q", "node", "mine", F.explode("targets").alias("to")) \
        .select("to", F.struct("q", "node").alias("got"), F.when(F.col("to") == F.col("part"), F.col("mine")).alias("mine"))
    met = sent.groupBy("to").agg(F.array_sort(F.collect_list("got")).alias("got"),
                                 F.first("mine", ignorenulls=True).alias("mine"))
    nodes = F.transform("got", lambda x: x["node"])
    joined = F.array_join(F.transform(nodes, lambda x: F.lower(F.hex(x))), "")
    step = F.struct((F.col("mine.q") - F.element_at("got", 1)["q"]).cast("int").alias("at"), nodes.alias("nodes"))
    more = F.col("mine.more")
    return met.select(F.col("to").alias("part"), "mine.s", "mine.first", "mine.n_parts",
                      F.when(more, F.unhex(F.sha2(joined, 256))).otherwise(F.col("mine.node")).alias("node"),
                      F.when(more, F.concat("mine.path", F.array(step))).otherwise(F.col("mine.path")).alias("path"))


_PATH = "array<struct<at:int,nodes:array<binary>>>"


def exchange(parts: DataFrame, sources: DataFrame) -> DataFrame:
    """Per partition: subroot, root, and the path above its own node (place and all digests of each run)."""
    state = parts.select("part", "s", "first", "n_parts", "node").withColumn("path", F.array().cast(_PATH))
    most_parts, n_sources = sources.agg(F.coalesce(F.max("n_parts"), F.lit(0)), F.count("*")).first()
    size = 1
    while size < most_parts:
        last = F.ceil(F.col("n_parts") / size) - 1  # group of the source
        place = F.col("part") - F.col("first")
        state = state.withColumn("q", F.floor(place / size)).withColumn("t", place % size) \
            .withColumn("run", F.floor(F.col("q") / FANOUT) * FANOUT).withColumn("more", last > 0)
        groups = F.sequence(F.col("run"), F.least(F.col("run") + FANOUT - 1, last))
        state = _swap(state.withColumn("peers", F.transform(groups, lambda q: F.struct(
            q.alias("q"), (F.col("first") + q * size).alias("start"),
            F.least(F.lit(size).cast("long"), F.col("n_parts") - q * size).alias("size")))))
        size *= FANOUT
    state = state.withColumn("path", F.concat("path", F.array(F.struct(F.lit(-1).alias("at"),
                                                                     F.array("node").alias("nodes")))))
    size = 1
    while size < n_sources:
        groups = sources.groupBy(F.floor(F.col("s") / size).alias("q")).agg(
            F.min("first").alias("start"), F.sum("n_parts").alias("size"))
        runs = groups.groupBy(F.floor(F.col("q") / FANOUT).alias("r")).agg(
            F.array_sort(F.collect_list(F.struct("q", "start", "size"))).alias("peers"))
        state = state.withColumn("q", F.floor(F.col("s") / size)).withColumn("more", F.lit(True))
        state = state.join(runs, F.floor(F.col("q") / FANOUT) == F.col("r"))
        own = F.element_at("peers", (F.col("q") - F.col("r") * FANOUT + 1).cast("int"))
        state = _swap(state.withColumn("t", F.col("part") - own["start"]))
        size *= FANOUT
    return state.select("part", F.col("node").alias("root"), "path")


def _proof_task(low_levels: int) -> Callable:
    """Per leaf: proof digest, and the root folded from the leaf (or its other version) and its siblings."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in (batch.slice(k, 1).to_pylist()[0] for k in range(batch.num_rows)):
                leaves = [r["leaves"][k:k + 32].hex() for k in range(0, len(r["leaves"]), 32)]
                others = iter([r["others"][k:k + 32].hex() for k in range(0, len(r["others"]), 32)])
                used = [next(others) if c else x for x, c in zip(leaves, r["changed"], strict=True)]
                low = _levels(leaves, r["n_parts"] == 1, low_levels)
                steps, subroot = [], ""
                for step in r["path"]:
                    if step["at"] < 0:
                        subroot = step["nodes"][0].hex()
                    else:
                        steps.append((step["at"], [x.hex() for x in step["nodes"]]))
                above = "".join("".join(nodes[:at] + nodes[at + 1:]) for at, nodes in steps)
                runs = [["".join(x[k:k + FANOUT]) for k in range(0, len(x), FANOUT)] for x in low[:-1]]
                ends = [("".join(nodes[:at]), "".join(nodes[at + 1:])) for at, nodes in steps]
                # Siblings above the lowest level are shared by the leaves of one run.
                upper = []
                for run in range(len(runs[0]) if runs else 0):
                    found, place = [], run
                    for level in runs[1:]:
                        text, nth = level[place // FANOUT], 64 * (place % FANOUT)
                        found.append(text[:nth] + text[nth + 64:])
                        place //= FANOUT
                    upper.append("".join(found) + above)
                proofs, folded = [], []
                for k, value in enumerate(used):
                    if not runs:
                        proofs.append(sha256(above.encode()).hexdigest())
                    else:
                        text, nth = runs[0][k // FANOUT], 64 * (k % FANOUT)
                        proofs.append(sha256((text[:nth] + text[nth + 64:] + upper[k // FANOUT]).encode()).hexdigest())
                    place = k
                    for level in runs:
                        text, nth = level[place // FANOUT], 64 * (place % FANOUT)
                        value = sha256((text[:nth] + value + text[nth + 64:]).encode()).hexdigest()
                        place //= FANOUT
                    for before, after in ends:
                        value = sha256((before + value + after).encode()).hexdigest()
                    folded.append(value)
                n, root = len(leaves), r["root"].hex()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r["ids"], pa.int64()), pa.array(leaves), pa.array([subroot] * n), pa.array([root] * n),
                     pa.array(proofs), pa.array(folded), pa.array([x == root for x in folded])],
                    ["id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])
    return run


def manifest(leaves: DataFrame, low_levels: int = LOW_LEVELS) -> DataFrame:
    """One row per leaf (see ``manifest_leaves``): id, leaf, subroot, root, proof_sha256, folded_root, verified.

    ``folded_root`` is folded from the ``other`` leaf, where there is one, and the siblings of the leaf.
    """
    scratch = Scratch(leaves.sparkSession)
    rows, sources = _ranked(leaves, scratch, FANOUT ** low_levels)
    parts = scratch.stored(
        rows.select("part", "s", "first", "n_parts", "pos", "id", "leaf", "other")
        .repartition("part").sortWithinPartitions("part", "pos").drop("pos")
        .mapInArrow(_part_task(low_levels), "part long, s long, first long, n_parts long, ids array<long>, leaves binary, "
                                "others binary, changed binary, node binary"))
    # Written first, so that Spark knows its size when it chooses how to join it with the partitions' leaves.
    upper = scratch.stored(exchange(parts, sources))
    out = stored(parts.select("part", "n_parts", "ids", "leaves", "others", "changed").join(upper, "part").drop("part")
                 .mapInArrow(_proof_task(low_levels), "id long, leaf string, subroot string, root string, proof_sha256 string, "
                                          "folded_root string, verified boolean"))
    scratch.clear()
    return out
