"""Hierarchical packing of documents into windows of several context sizes.

Each task encodes its documents and packs them in bounded rounds, without moving texts:

1.  route: a document gives as many windows of the longest size as it fills; the rest goes to the tier of the smallest
    window size that holds it;
2.  pack, longest tier first: the longest rest opens a window of its tier, whose gap is filled with whole rests of
    shorter tiers, the longest that fit first;
3.  a gap that no whole rest fits is filled by cutting a rest; a window that cannot be filled is not opened: its
    rest is cut at the next shorter size instead;
4.  what is left in the end of a task, less than the shortest window, shares one last window with the ends of
    neighbouring tasks (as many as always fit), the only windows that are not full;
5.  full windows are dealt to step groups of equal tokens and one window size, so that the groups of a round hold
    about the same number of documents.

Defined results.  A null text is empty: its document is the end id alone.  Documents of equal id (or null ids) are
packed separately, one per row.  A text of any length is encoded whole.  An empty table gives no rows.
Other columns are ignored.  Memory: a round holds ``ROUND_TOKENS`` tokens and one document at most; about
``ENCODE_BYTES`` of text are encoded at a time, and a Python worker remembers ``KNOWN_BYTES`` of chunks between them.
"""

from __future__ import annotations

import os
import zlib
from collections import deque
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import chunk_encoder, in_batches

SIZES = (256, 512, 1024, 2048, 4096)  # window sizes, powers of two
ROUND_TOKENS = 1 << 19
STEP_TOKENS = 1 << 16
ENCODE_BYTES = 1 << 19
KNOWN_BYTES = 8 << 20
END_ID = 2

Piece = tuple[int, int, int]  # document of the round, start, length


class Packer:
    """Full windows out of pieces; ``rests`` are kept between rounds in one queue per tier."""

    def __init__(self, sizes: tuple[int, ...] = SIZES):
        self.sizes = sizes
        self.rests: list[deque[Piece]] = [deque() for _ in sizes]

    def route(self, piece: Piece) -> None:
        doc, start, length = piece
        if length:
            tier = next(i for i, s in enumerate(self.sizes) if length <= s)
            self.rests[tier].append(piece)

    def add(self, doc: int, n: int) -> Iterator[tuple[int, list[Piece]]]:
        """Windows that the document fills alone; its rest is routed."""
        top = self.sizes[-1]
        for start in range(0, n - n % top, top):
            yield top, [(doc, start, top)]
        self.route((doc, n - n % top, n % top))

    def _fill(self, gap: int) -> list[Piece] | None:
        """Pieces that fill a gap exactly, or None if all rests together are too short (they stay)."""
        if not self._enough(gap):
            return None
        taken: list[Piece] = []
        while gap:
            fits = next((q for s, q in zip(reversed(self.sizes), reversed(self.rests), strict=True)
                         if q and q[0][2] <= gap), None)
            if fits is not None:
                piece = fits.popleft()
            else:
                queue = next(q for q in self.rests if q)
                doc, start, length = queue.popleft()
                piece = (doc, start, gap)
                self.route((doc, start + gap, length - gap))
            taken.append(piece)
            gap -= piece[2]
        return taken

    def _enough(self, gap: int) -> bool:
        total = 0
        for piece in chain.from_iterable(reversed(self.rests)):
            if total >= gap:
                break
            total += piece[2]
        return total >= gap

    def windows(self) -> Iterator[tuple[int, list[Piece]]]:
        """All windows that the rests can fill, longest tier first."""
        for tier in range(len(self.sizes) - 1, -1, -1):
            size, queue = self.sizes[tier], self.rests[tier]
            while queue:
                doc, start, length = queue.popleft()
                more = self._fill(size - length)
                if more is not None:
                    yield size, [(doc, start, length), *more]
                elif tier:
                    half = self.sizes[tier - 1]
                    yield half, [(doc, start, half)]
                    self.route((doc, start + half, length - half))
                else:
                    queue.appendleft((doc, start, length))
                    break

    def left(self) -> list[Piece]:
        out = [p for q in self.rests for p in q]
        for q in self.rests:
            q.clear()
        return out


def step_groups(windows: list[tuple[int, list[Piece]]], step_tokens: int) -> list[int]:
    """A group number per window: one size and ``step_tokens`` per group, documents dealt evenly back and forth."""
    groups, first = [0] * len(windows), 0
    for size in sorted({s for s, _ in windows}, reverse=True):
        mine = sorted((i for i, (s, _) in enumerate(windows) if s == size), key=lambda i: -len(windows[i][1]))
        n = max(1, -(-len(mine) * size // step_tokens))
        for rank, i in enumerate(mine):
            turn, at = divmod(rank, n)
            groups[i] = first + (at if turn % 2 == 0 else n - 1 - at)
        first += n
    return groups


def _pack_task(id_col: str, text_col: str, tokenizer_path: str, sizes: tuple[int, ...], round_tokens: int,
               step_tokens: int, part_bits: int) -> Callable:
    from pyspark import TaskContext

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "window", "step", "size", "place"]

    def rows(docs: list, windows: list[tuple[int, list[Piece]]], number: int, step: int, base: int):
        groups = step_groups(windows, step_tokens)
        for (size, pieces), group in zip(windows, groups, strict=True):
            for place, (d, start, length) in enumerate(pieces):
                doc_id, ids = docs[d]
                yield (doc_id, start, length, zlib.crc32(ids[4 * start:4 * (start + length)]), len(ids) // 4,
                       base + number, base + step + group, size, place)
            number += 1

    def batch(found: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A task has one core: threads of the library would only keep memory of their own.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        encoder = chunk_encoder(tokenizer_path, keeps_space=False, most=KNOWN_BYTES)
        base = TaskContext.get().partitionId() << part_bits
        end = np.array([END_ID], dtype="<u4").tobytes()
        packer, docs, windows, held, number, step = Packer(sizes), [], [], 0, 0, 0
        for part in in_batches(batches, 8192, text_col, 1 << 21):
            for few in in_batches(iter([part]), 8192, text_col, ENCODE_BYTES):
                ids = few.column(few.schema.get_field_index(id_col)).to_pylist()
                texts = [t or "" for t in few.column(few.schema.get_field_index(text_col)).to_pylist()]
                for doc_id, got in zip(ids, encoder.encode(texts), strict=True):
                    docs.append((doc_id, got + end))
                    windows += packer.add(len(docs) - 1, len(got) // 4 + 1)
                    held += len(got) // 4 + 1
            if held < round_tokens:
                continue
            windows += packer.windows()
            yield batch(list(rows(docs, windows, number, step, base)))
            number += len(windows)
            step += 1 + max(step_groups(windows, step_tokens), default=0)
            rest = packer.left()  # less than the shortest window; its documents open the next round
            docs = [docs[d] for d, _, _ in rest]
            for i, (_, start, length) in enumerate(rest):
                packer.route((i, start, length))
            windows, held = [], 0
        if not docs:
            return
        windows += packer.windows()
        found = list(rows(docs, windows, number, step, base))
        # The end of the task: to the window it shares with its neighbours.
        found += [(docs[d][0], start, length, zlib.crc32(docs[d][1][4 * start:4 * (start + length)]),
                   len(docs[d][1]) // 4, None, None, None, place)
                  for place, (d, start, length) in enumerate(packer.left())]
        if found:
            yield batch(found)

    return run


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
         sizes: tuple[int, ...] = SIZES, round_tokens: int = ROUND_TOKENS,
         step_tokens: int = STEP_TOKENS) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, window_size, step_id."""
    part_bits = 40
    run = _pack_task(id_col, text_col, tokenizer_path, sizes, round_tokens, step_tokens, part_bits)
    pieces = docs.select(F.col(f"`{id_col}`").cast("long").alias(id_col), F.col(f"`{text_col}`").alias(text_col)) \
        .mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, window long, "
                         "step long, size long, place long")
    # Ends of tasks are shorter than the shortest window, so those of so many tasks share a longest one.
    share = sizes[-1] // sizes[0]
    task = F.spark_partition_id().cast("long")
    ends = -1 - F.floor(task / share)
    pieces = pieces.withColumn("sequence_id", F.coalesce("window", ends)) \
        .withColumn("task", F.when(F.col("window").isNull(), task))
    w = Window.partitionBy("sequence_id").orderBy("task", "place")
    return pieces.withColumn("offset", F.sum("length").over(w) - F.col("length")) \
        .select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset",
                F.coalesce("size", F.lit(sizes[-1])).cast("long").alias("window_size"),
                F.coalesce("step", F.col("sequence_id")).alias("step_id"))
