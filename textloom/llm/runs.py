"""Maximal periodic runs of words, found with a recompression grammar.

The words of many documents become one sequence of integers with a separator, equal to nothing else, around each
document.  Recompression turns it into a run-length grammar, level by level: block compression replaces each maximal
block of one symbol by a symbol for (symbol, length); pair compression splits the symbols into a left and a right
half and replaces every left-right pair; this goes on until each document is one symbol.  Equal stretches are
parsed alike except at their ends, so the longest common extension (LCE) of two places follows from one climb and one
descent through the levels, with at most one comparison and one step on each.  Queries run in numpy batches, level by
level; extensions to the left use the same levels read backwards.

Candidates are on the harmonic grid: a run of period p holds a place i = k * p with equal words at i and i + p, so
the places of all periods are the pairs (j - p, j) of a number and its divisors, n ln n of them.  Those with equal
words are extended both ways; the extension is exact, so a run is found whole from any of its places, and its
smallest period is the least that gives the same start and end.

Defined results.  A null or empty text has no words and no runs.  Words are compared as they are (bytes of the text).
Repeated rows get equal results, null ids stay, an empty table gives no rows, other columns are ignored.  A text of
any length is read whole: documents are batched up to ``BATCH_WORDS`` words, a longer one stands alone, and its
candidates are extended ``CHUNK`` at a time.
"""

from __future__ import annotations

import functools
import hashlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import in_batches

LEAST_LENGTH = 12
BATCH_WORDS = 1 << 16
CHUNK = 1 << 20  # candidates extended at once
GRID_WORDS = 1 << 14  # up to which the grid of a document comes from one table of divisors


class Level(NamedTuple):
    """One level of the grammar, and how it was made from the level below."""
    symbols: np.ndarray
    first: np.ndarray  # of each symbol's children, and an end; places in the level below
    pairs: bool  # children are at most two, and different


class Grammar:
    """Levels of a sequence; ``fixed`` symbols (separators, the last ones) are never compressed."""

    def __init__(self, sequence: np.ndarray, fixed_from: int):
        """Symbols from ``fixed_from`` on are separators, each of which occurs once."""
        self.levels = [Level(sequence, np.arange(len(sequence) + 1), True)]
        self.rules: list[tuple[int, np.ndarray, np.ndarray]] = []  # first symbol, left, right (or length)
        self.fixed_from, self.fixed_to = fixed_from, int(sequence.max()) + 1
        self.next = self.fixed_to
        seed, made = 1, 0
        while made < len(self.levels):  # until no two free symbols are neighbours
            made = len(self.levels)
            self._blocks()
            seed = self._pairs(seed)
        # Parents: of each place of a level, its symbol's place in the level above.
        self.up = [np.repeat(np.arange(len(above.symbols)), np.diff(above.first)) for above in self.levels[1:]]

    def _is_fixed(self, symbols: np.ndarray) -> np.ndarray:
        return (symbols >= self.fixed_from) & (symbols < self.fixed_to)

    def _add(self, symbols: np.ndarray, starts: np.ndarray, size: int, pairs: bool) -> None:
        self.levels.append(Level(symbols, np.append(starts, size), pairs))

    def _named(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """A new symbol for each distinct (left, right)."""
        keys, number = np.unique(left << np.int64(32) | right, return_inverse=True)
        self.rules.append((self.next, keys >> np.int64(32), keys & np.int64(0xFFFFFFFF)))
        out = number + self.next
        self.next += len(keys)
        return out

    def _blocks(self) -> None:
        s = self.levels[-1].symbols
        starts = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
        lengths = np.diff(starts, append=len(s))
        long = lengths > 1
        if not long.any():
            return
        out = s[starts]
        out[long] = self._named(out[long], lengths[long])
        self._add(out, starts, len(s), False)

    def _pairs(self, seed: int) -> int:
        """Neighbours differ here.  Halves come from a hash; a seed that pairs nothing gives way to the next."""
        s = self.levels[-1].symbols
        free = ~self._is_fixed(s)
        both = free[:-1] & free[1:]
        if not both.any():
            return seed
        while True:
            seed += 1
            x = (s + seed * 0x9E3779B9).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
            x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
            half = (x >> np.uint64(60)) & np.uint64(1)
            ahead = both & (half[:-1] < half[1:])
            back = both & (half[:-1] > half[1:])
            at = np.flatnonzero(ahead if ahead.sum() >= back.sum() else back)
            if len(at):
                break
        keep = np.ones(len(s), dtype=bool)
        keep[at + 1] = False
        out = s.copy()
        out[at] = self._named(s[at], s[at + 1])
        starts = np.flatnonzero(keep)
        self._add(out[starts], starts, len(s), True)
        return seed

    def backwards(self) -> Grammar:
        """The same parse read from the end."""
        out = object.__new__(Grammar)
        sizes = [len(x.symbols) for x in self.levels]
        below = [sizes[0], *sizes[:-1]]
        out.levels = [Level(x.symbols[::-1], n - x.first[::-1], x.pairs)
                      for x, n in zip(self.levels, below, strict=True)]
        out.up = [n - 1 - u[::-1] for u, n in zip(self.up, sizes[1:], strict=True)]
        return out

    def lce(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """For each pair of places (different, of one document) the number of equal symbols from there on."""
        a, b = i.copy(), j.copy()
        ended = []  # by level: those that differ there, at (a, b)
        live = np.arange(len(i))
        # Climb: compare what is left of the symbols above, then step up.
        for h, (up, above) in enumerate(zip(self.up, self.levels[1:], strict=True)):
            symbols = self.levels[h].symbols
            x, y = a[live], b[live]
            px, py = up[x], up[y]
            level = (above.first[px] == x) & (above.first[py] == y)
            inside = np.flatnonzero(~level)
            u, v = x[inside], y[inside]
            same = symbols[u] == symbols[v]
            left, right = above.first[px[inside] + 1] - u, above.first[py[inside] + 1] - v
            step = np.where(same, np.minimum(left, right), 0)
            a[live[inside]] = u + step
            b[live[inside]] = v + step
            level[inside] = same & (left == right)
            ended.append(live[~level])
            live = live[level]
            # What lies before is equal or not asked for, so the next symbol above follows that of the place before.
            a[live], b[live] = up[a[live] - 1] + 1, up[b[live] - 1] + 1
        # Descend: the symbols differ, their children may agree at first.
        at = live
        for h in range(len(self.levels) - 1, 0, -1):
            above, symbols = self.levels[h], self.levels[h - 1].symbols
            px, py = a[at], b[at]
            x, y = above.first[px], above.first[py]
            same = symbols[x] == symbols[y]
            if above.pairs:
                step = same.astype(np.int64)
            else:
                step = np.where(same, np.minimum(above.first[px + 1] - x, above.first[py + 1] - y), 0)
            a[at], b[at] = x + step, y + step
            at = np.concatenate([at, ended[h - 1]])
        return a - i


@functools.cache
def divisor_grid(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All (j - p, j) with p a divisor of j < n, by j; and how many of them have j below 0 ... n."""
    j = np.concatenate([np.arange(p, n, p) for p in range(1, n)] or [np.zeros(0, dtype=np.int64)])
    p = np.repeat(np.arange(1, n), (n - 1) // np.arange(1, n)) if n > 1 else np.zeros(0, dtype=np.int64)
    order = np.argsort(j, kind="stable")
    j, p = j[order].astype(np.int32), p[order].astype(np.int32)
    return j - p, j, np.searchsorted(j, np.arange(n + 1))


def grid_places(words: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (i, i + p) of the grid with equal words, for p up to half the words, in bounded portions."""
    n = len(words)
    if n <= GRID_WORDS:
        size = 64
        while size < n:
            size *= 2
        left, right, upto = divisor_grid(size)
        left, right = left[:upto[n]], right[:upto[n]]
        at = np.flatnonzero(words[left] == words[right])
        yield left[at].astype(np.int64), right[at].astype(np.int64)
        return
    p = 1
    while 2 * p <= n:
        # As many periods as give about CHUNK places.
        end = min(n // 2 + 1, p + max(1, CHUNK // (n // p)))
        periods = np.arange(p, end)
        counts = (n - 1) // periods
        each = np.repeat(periods, counts)
        nth = np.arange(len(each)) - np.repeat(np.cumsum(counts) - counts, counts)
        left = nth * each
        at = np.flatnonzero(words[left] == words[left + each])
        yield left[at], left[at] + each[at]
        p = end


def numbered(docs: list[list[bytes]]) -> list[np.ndarray]:
    number: defaultdict[bytes, int] = defaultdict()
    number.default_factory = number.__len__
    return [np.fromiter(map(number.__getitem__, words), dtype=np.int64, count=len(words)) for words in docs]


def find_runs(docs: list[np.ndarray], least: int = LEAST_LENGTH) -> list[np.ndarray]:
    """Of each document its runs, rows (start, length, period) by start, then period.

    A run has a length of at least ``least`` and twice its smallest period and cannot be extended.
    """
    empty = np.zeros((0, 3), dtype=np.int64)
    busy = [k for k, words in enumerate(docs) if len(words) >= max(least, 2)]
    out = [empty] * len(docs)
    if not busy:
        return out
    top = 1 + max(int(docs[k].max()) for k in busy)
    parts, at, base = [np.array([top])], 1, []
    for nth, k in enumerate(busy):
        base.append(at)
        parts += [docs[k], np.array([top + nth + 1])]
        at += len(docs[k]) + 1
    sequence = np.concatenate(parts)
    forward = Grammar(sequence, top)
    backward = forward.backwards()
    last = len(sequence) - 1
    found: list[np.ndarray] = []

    def extend(lefts: list[np.ndarray], rights: list[np.ndarray]) -> None:
        i, j = np.concatenate(lefts), np.concatenate(rights)
        period = j - i
        ahead = forward.lce(i, j)
        back = backward.lce(last - i + 1, last - j + 1)
        length = period + ahead + back
        good = (length >= 2 * period) & (length >= least)
        rows = np.stack([(i - back)[good], length[good], period[good]], axis=1)
        found.append(np.unique(rows, axis=0) if len(rows) else empty)

    lefts, rights, held = [], [], 0
    for start, k in zip(base, busy, strict=True):
        for i, j in grid_places(docs[k]):
            lefts.append(i + start)
            rights.append(j + start)
            held += len(i)
            if held >= CHUNK:
                extend(lefts, rights)
                lefts, rights, held = [], [], 0
    if lefts:
        extend(lefts, rights)
    rows = np.concatenate(found)
    if not len(rows):
        return out
    # The least period of each (start, length).
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    fresh = np.ones(len(rows), dtype=bool)
    fresh[1:] = (rows[1:, 0] != rows[:-1, 0]) | (rows[1:, 1] != rows[:-1, 1])
    rows = rows[fresh]
    rows = rows[np.lexsort((rows[:, 2], rows[:, 0]))]
    cuts = np.searchsorted(rows[:, 0], [*base[1:], len(sequence)])
    for k, start, mine in zip(busy, base, np.split(rows, cuts[:-1]), strict=True):
        out[k] = mine - np.array([start, 0, 0])
    return out


def collapsed(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words without those that a run contains after its first period."""
    if not len(runs):
        return words
    depth = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
    return [words[k] for k in np.flatnonzero(np.cumsum(depth[:-1]) == 0)]


def _batched(texts: Iterator[tuple[object, list[bytes]]]) -> Iterator[list[tuple[object, list[bytes]]]]:
    held, words = [], 0
    for key, found in texts:
        if held and words + len(found) > BATCH_WORDS:
            yield held
            held, words = [], 0
        held.append((key, found))
        words += len(found)
    if held:
        yield held


def _run_task(id_col: str, text_col: str, change: Callable[[int | None, list[bytes]], list[bytes]] | None) -> Callable:
    def row(key, words: list[bytes], runs: np.ndarray) -> tuple:
        best = (None,) * 4
        if len(runs):
            start, length, period = min(runs.tolist(), key=lambda r: (-r[1], r[0], r[2]))
            best = (start, length, period, 1000 * length // period)
        told = "".join(f"{s},{n},{p}\n" for s, n, p in runs.tolist())
        return (key, len(runs), *best, hashlib.sha256(told.encode()).hexdigest(),
                hashlib.sha256(b" ".join(collapsed(words, runs))).hexdigest(),
                [{"start": s, "length": n, "period": p} for s, n, p in runs.tolist()])

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, list[bytes]]]:
        for batch in in_batches(batches, 1024, text_col, 1 << 21):
            column = batch.column(batch.schema.get_field_index(text_col)).cast(pa.large_binary())
            keys = batch.column(batch.schema.get_field_index(id_col)).to_pylist()
            for key, text in zip(keys, column.to_pylist(), strict=True):
                words = (text or b"").split()
                yield key, change(key, words) if change else words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _batched(texts(batches)):
            runs = find_runs(numbered([words for _, words in group]))
            found = [row(key, words, r) for (key, words), r in zip(group, runs, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), _TYPES.values(),
                                                                             strict=True)], list(_TYPES))
    return run


_TYPES = {"doc_id": pa.int64(), "n_runs": pa.int64(), "start": pa.int64(), "length": pa.int64(), "period": pa.int64(),
          "exponent_milli": pa.int64(), "runs_sha256": pa.string(), "collapsed_sha256": pa.string(),
          "runs": pa.list_(pa.struct({k: pa.int64() for k in ("start", "length", "period")}))}


def word_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              change: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """One row per row of ``docs``: its id, the number of runs, the longest run (ties: least start, then period),
    digests of all runs and of the collapsed text, and ``runs`` (array of start, length, period).

    ``change`` may replace the words of a document before the search.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return rows.mapInArrow(_run_task("id", "text", change),
                           "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
                           "runs_sha256 string, collapsed_sha256 string, "
                           "runs array<struct<start:long,length:long,period:long>>") \
        .withColumnRenamed("doc_id", id_col)


def collapse_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``text_col`` collapsed: words a run repeats after its first period go, the rest is joined by
    single blanks.  A text without runs stays as it is; all other columns and rows stay."""
    return docs.withColumn(text_col, _collapse_udf()(F.col(f"`{text_col}`")))


def _collapse_udf() -> Callable[[Column], Column]:
    @F.pandas_udf("string")
    def collapse(texts: pd.Series) -> pd.Series:
        out = texts.copy()
        words = [[] if t is None else t.encode("utf-8", "surrogatepass").split() for t in texts]
        for group in _batched(enumerate(words)):
            runs = find_runs(numbered([w for _, w in group]))
            for (k, w), r in zip(group, runs, strict=True):
                if len(r):
                    out.iloc[k] = b" ".join(collapsed(w, r)).decode("utf-8", "surrogatepass")
        return out

    return collapse
