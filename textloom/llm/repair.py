"""Token ids in grammar-compressed shard files (Re-Pair), readable at random.

Documents are encoded, ended with the end id and brought into ascending id order; shards of bounded length follow one
another in that order.  In each shard the pairs of neighbouring symbols that occur most often are replaced by new
symbols, round after round, until no pair is frequent enough (``LEAST``).  A shard stores its rules (left and right symbol and
expansion length of each), the remaining symbols, and where its documents start.  Expansion lengths let a
reader find and expand any range of ids without touching the rest.

File format: a Parquet table with a row per shard, written by Spark (so the shared store, retries and commits are
Spark's), with columns ``part, shard`` (numbering), ``before`` (ids in the part's shards before), ``n_tokens, n_docs``, ``doc_ids`` and ``doc_tokens``
(little-endian int64), ``null_ids`` (documents at the front with a null id), ``rules`` (little-endian uint32 left,
right, length, rule after rule) and ``low``, ``high`` (low 16 and next 16 bits of the remaining symbols).

Defined results.  A null text is empty: its document is the end id alone.  Null ids come first; rows of one id are
ordered by text.  A text of any length is encoded whole (a shard is closed when it is long enough, so it holds at
most ``SHARD_TOKENS`` tokens and one document).  An empty table gives no shards.  Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import chunk_encoder, in_batches

SHARD_TOKENS = 1 << 18
END_ID = 2
FIRST_RULE = 1 << 17  # above every id of the vocabularies in use
LEAST = 4  # a pair is replaced where that can be done so often in a shard: a rule takes the room of three symbols
_SYMBOL, _PLACE = 18, 28  # bits of a symbol and a place, where pairs are sorted with their places

BROADCAST_PARTS = 1 << 20  # rows of 12 bytes, one per task that wrote shards

SHARD_SCHEMA = ("part int, shard int, before long, n_tokens long, n_docs long, doc_ids binary, doc_tokens binary, null_ids long, "
                "rules binary, low binary, high binary")


def compress(ids: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray]:
    """``(rules, symbols)``: rules are rows (left, right, expansion length); rule k is symbol FIRST_RULE + k.

    A round replaces all pairs that are frequent enough; where they overlap, the more frequent one, and in a run of
    equal pairs every other one.  Rounds go on until no pair is left that can be replaced ``least`` times.  After the
    first round only pairs next to a replaced one, or that lost to one, are counted again: others were too rare already.
    """
    seq = ids.astype(np.uint32)
    rules: list[np.ndarray] = []
    lengths = np.zeros(0, dtype=np.uint32)
    open_ = np.ones(len(seq), dtype=bool)  # places whose pair with the next symbol is to be counted
    while len(seq) > 1:
        open_[-1] = False
        at, number, pairs, counts = _frequent(seq, np.flatnonzero(open_), least)
        if not len(at):
            break
        weight = np.zeros(len(seq) + 1, dtype=np.int32)
        weight[at] = counts[number]
        here = weight[at]
        best = (here >= weight[at + 1]) & (here >= np.where(at > 0, weight[at - 1], 0))
        chosen, which = _every_other(at[best], number[best])
        used = np.bincount(which, minlength=len(pairs)) >= least
        if not used.any():
            at, chosen, which = _one_by_one(at, number, len(seq), least)
            used[which] = True
        fine = used[which]
        chosen, which = chosen[fine], which[fine]
        names = np.cumsum(used) - 1 + FIRST_RULE + len(lengths)
        kept = pairs[used]
        left, right = (kept >> np.uint64(32)).astype(np.uint32), kept.astype(np.uint32)
        known = np.concatenate([lengths, np.ones(1, dtype=np.uint32)])  # the last one: an id
        long = sum(known[np.where(s >= FIRST_RULE, s.astype(np.int64) - FIRST_RULE, -1)] for s in (left, right))
        rules.append(np.stack([left, right, long], axis=1))
        lengths = np.concatenate([lengths, long])
        seq[chosen] = names[which]
        open_ = np.zeros(len(seq), dtype=bool)
        open_[at] = True
        open_[chosen] = True
        open_[chosen[chosen > 0] - 1] = True
        keep = np.ones(len(seq), dtype=bool)
        keep[chosen + 1] = False
        # A place before a removed one now meets what follows it.
        seq, open_ = seq[keep], open_[keep]
    return (np.concatenate(rules) if rules else np.zeros((0, 3), dtype=np.uint32)), seq


def _frequent(seq: np.ndarray, at: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the pairs at the places ``at`` those that occur ``least`` times or more: their places in order, the number of
    the pair at each, the pairs (left in the upper half), and how often each occurs."""
    left, right = seq[at].astype(np.uint64), seq[at + 1]
    if len(seq) >= 1 << _PLACE or not len(at) or int(seq.max()) >= 1 << _SYMBOL:
        pairs, number, counts = np.unique(left << np.uint64(32) | right, return_inverse=True, return_counts=True)
        often = counts[number] >= least
        at, number = at[often], number[often]
        return at, number, pairs, counts
    # Symbols and place fit into one integer, so sorting that brings the places of a pair together.
    key = np.sort((left << np.uint64(_SYMBOL) | right) << np.uint64(_PLACE) | at.astype(np.uint64))
    both = key >> np.uint64(_PLACE)
    first = np.flatnonzero(np.concatenate(([True], both[1:] != both[:-1])))
    counts = np.diff(first, append=len(key))
    often = counts >= least
    first, counts = first[often], counts[often]
    pairs = both[first]
    pairs = (pairs >> np.uint64(_SYMBOL) << np.uint64(32)) | (pairs & np.uint64((1 << _SYMBOL) - 1))
    which = np.zeros(len(seq), dtype=np.int32)
    taken = np.repeat(often, np.diff(np.flatnonzero(np.concatenate(([True], both[1:] != both[:-1], [True])))))
    which[(key[taken] & np.uint64((1 << _PLACE) - 1)).astype(np.int64)] = np.repeat(np.arange(1, len(counts) + 1), counts)
    at = np.flatnonzero(which)
    return at, which[at] - 1, pairs, counts


def _every_other(at: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """In each run of neighbouring places the first, third, ..."""
    if not len(at):
        return at, number
    begins = np.concatenate(([True], at[1:] != at[:-1] + 1))
    odd = (at - np.maximum.accumulate(np.where(begins, at, 0))) % 2 == 0
    return at[odd], number[odd]


def _one_by_one(at: np.ndarray, number: np.ndarray, size: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs that hinder each other, the most frequent first, each at the places that are still free: the places to be
    counted again, those taken, and their pairs.  A pair that all its places do not suffice for is given up."""
    order = np.argsort(number, kind="stable")
    groups = np.split(at[order], np.flatnonzero(np.diff(number[order])) + 1)
    names = number[order][np.cumsum([0, *map(len, groups[:-1])])]
    taken = np.zeros(size + 1, dtype=bool)
    again, chosen, which = [], [at[:0]], [number[:0]]
    for k in sorted(range(len(groups)), key=lambda k: -len(groups[k])):
        free = groups[k][~taken[groups[k]] & ~taken[groups[k] + 1]]
        found = _every_other(free, free)[0]
        if len(found) >= least:
            taken[found] = taken[found + 1] = True
            chosen.append(found)
            which.append(np.full(len(found), names[k]))
        if len(found) >= least or len(free) < len(groups[k]):
            again.append(groups[k])
    chosen, which = np.concatenate(chosen), np.concatenate(which)
    order = np.argsort(chosen)
    return np.concatenate([at[:0], *again]), chosen[order], which[order]


def _opened(rules: np.ndarray) -> np.ndarray:
    """The ids of all rules, one after the other: rules of equal depth are opened at once."""
    seq = np.arange(len(rules), dtype=np.uint32) + np.uint32(FIRST_RULE)
    while (is_rule := seq >= FIRST_RULE).any():
        widths = is_rule.astype(np.int64) + 1
        at = np.cumsum(widths) - widths
        out = np.empty(int(widths.sum()), dtype=np.uint32)
        out[at[~is_rule]] = seq[~is_rule]
        own = rules[seq[is_rule].astype(np.int64) - FIRST_RULE]
        out[at[is_rule]] = own[:, 0]
        out[at[is_rule] + 1] = own[:, 1]
        seq = out
    return seq


def expand(rules: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """The ids of ``symbols``."""
    symbols = symbols.astype(np.uint32)
    if not len(rules):
        return symbols
    sizes = rules[:, 2].astype(np.int64)
    table, first = _opened(rules), np.cumsum(sizes) - sizes
    # Where a symbol's ids begin: a rule's in the table, an id's own place behind the table.
    at = np.flatnonzero(symbols >= FIRST_RULE)
    rule = symbols[at].astype(np.int64) - FIRST_RULE
    widths, starts = np.ones(len(symbols), dtype=np.int64), np.arange(len(table), len(table) + len(symbols))
    widths[at], starts[at] = sizes[rule], first[rule]
    ends = np.cumsum(widths)
    total = int(ends[-1]) if len(ends) else 0
    place = np.int32 if len(table) + total < 1 << 31 else np.int64
    take = np.repeat((starts - ends + widths).astype(place), widths)
    take += np.arange(total, dtype=place)
    return np.concatenate([table, symbols])[take]


def symbol_ends(rules: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """Running expansion lengths of the symbols of a shard."""
    size = np.ones(len(symbols), dtype=np.int64)
    is_rule = symbols >= FIRST_RULE
    size[is_rule] = rules[symbols[is_rule].astype(np.int64) - FIRST_RULE, 2]
    return np.cumsum(size)


def decode_range(rules: np.ndarray, symbols: np.ndarray, start: int, length: int) -> np.ndarray:
    """Ids ``start`` to ``start + length`` of a shard, expanding only the symbols that cover them."""
    ends = symbol_ends(rules, symbols)
    a, b = int(np.searchsorted(ends, start, side="right")), int(np.searchsorted(ends, start + length, side="left")) + 1
    before = int(ends[a - 1]) if a else 0
    return expand(rules, symbols[a:b])[start - before:start - before + length]


def _write_task(id_col: str, text_col: str, tokenizer_path: str, shard_tokens: int) -> Callable:
    from pyspark import TaskContext

    names = [c.split()[0] for c in SHARD_SCHEMA.split(", ")]

    def shard(part: int, number: int, before: int, doc_ids: list, ids: list[bytes]) -> pa.RecordBatch:
        rules, symbols = compress(np.frombuffer(b"".join(ids), dtype="<u4"))
        nulls = sum(d is None for d in doc_ids)
        sizes = np.array([len(x) // 4 for x in ids], dtype="<i8")
        values = [part, number, before, int(sizes.sum()), len(ids),
                  np.array([d or 0 for d in doc_ids], dtype="<i8").tobytes(), sizes.tobytes(), nulls,
                  rules.astype("<u4").tobytes(), (symbols & 0xFFFF).astype("<u2").tobytes(),
                  (symbols >> 16).astype("<u2").tobytes()]
        types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.binary(),
                 pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = chunk_encoder(tokenizer_path, keeps_space=True)
        part = TaskContext.get().partitionId()
        end = np.array([END_ID], dtype="<u4").tobytes()
        doc_ids, ids, held, number, before = [], [], 0, 0, 0
        for batch in in_batches(batches, 8192, text_col, 1 << 21):
            texts = [t or "" for t in batch.column(batch.schema.get_field_index(text_col)).to_pylist()]
            keys = batch.column(batch.schema.get_field_index(id_col)).to_pylist()
            for key, got in zip(keys, encoder.encode(texts), strict=True):
                doc_ids.append(key)
                ids.append(got + end)
                held += len(got) // 4 + 1
                if held >= shard_tokens:
                    yield shard(part, number, before, doc_ids, ids)
                    doc_ids, ids, held, number, before = [], [], 0, number + 1, before + held
        if ids:
            yield shard(part, number, before, doc_ids, ids)

    return run


def write_shards(docs: DataFrame, path: str, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 shard_tokens: int = SHARD_TOKENS) -> None:
    """Write the shard files of all documents, in ascending id order, to ``path``."""
    ordered = docs.select(F.col(f"`{id_col}`").cast("long").alias(id_col), F.col(f"`{text_col}`").alias(text_col)) \
        .repartitionByRange(id_col).sortWithinPartitions(id_col, text_col)
    ordered.mapInArrow(_write_task(id_col, text_col, tokenizer_path, shard_tokens), SHARD_SCHEMA) \
        .write.mode("overwrite").option("compression", "zstd").parquet(path)


def _read_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in (batch.slice(k, 1).to_pylist()[0] for k in range(batch.num_rows)):
            rules = np.frombuffer(row["rules"], dtype="<u4").reshape(-1, 3)
            symbols = np.frombuffer(row["low"], "<u2").astype(np.uint32) \
                | (np.frombuffer(row["high"], "<u2").astype(np.uint32) << 16)
            ids = expand(rules, symbols).astype("<u4").tobytes()
            sizes = np.frombuffer(row["doc_tokens"], "<i8")
            starts = np.cumsum(sizes) - sizes
            keys = np.frombuffer(row["doc_ids"], "<i8").tolist()
            keys[:row["null_ids"]] = [None] * row["null_ids"]
            n = len(sizes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(starts + row["before"] + row["part_before"], pa.int64()),
                 pa.array(sizes, pa.int64()),
                 pa.array([zlib.crc32(ids[4 * a:4 * (a + b)]) for a, b in zip(starts, sizes, strict=True)],
                          pa.int64()), pa.array([row["part"]] * n, pa.int32()), pa.array([row["shard"]] * n, pa.int32())],
                ["doc_id", "start", "n_tokens", "ids_crc32", "part", "shard"])


def read_documents(shards: DataFrame) -> DataFrame:
    """Per document of the shard files: doc_id, start, n_tokens, ids_crc32, part, shard.

    A shard's header says how many ids its part has before it; a running sum over the parts (one row per task that
    wrote) gives the rest.  Parts are broadcast up to ``BROADCAST_PARTS`` rows, so shards are not shuffled for it.
    """
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("n")) \
        .select(F.col("part").alias("p"), (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("part_before"))
    if parts.count() <= BROADCAST_PARTS:
        parts = F.broadcast(parts)
    return shards.join(parts, F.col("part") == F.col("p")).drop("p") \
        .mapInArrow(_read_task, "doc_id long, start long, n_tokens long, ids_crc32 long, part int, shard int")
