"""Quality classifier: histogram gradient-boosted trees over document statistics.

A document is described by statistics of its whole text (``STATISTICS``): lengths, shares of kinds of characters, of
kinds of words and of lines, repetition, entropies.  Trees are grown level by level on histograms of gradients and
curvatures of the logistic loss over at most ``BINS`` quantile bins per statistic.  All trees lie one after the other
in five flat arrays, and a batch of documents walks through all of them at once with numpy.

Statistics are computed once for every document in Spark tasks and stored.  The trees are fitted on a bounded sample
of labelled rows, ``MOST_ROWS`` in the mean: equal rows are merged with a weight first (a group of copies is one
row), then a row is taken by a hash of its statistics, so reruns agree.  Nothing else is sampled.

Defined results.  A null text counts as empty; an empty text has statistics, too (all 0), and a score.  A label above 0
is 1, a null one is none; an id with several labels counts each with its share; null ids have no label.  Without any
label every score is 0.5; with labels of one kind only, scores stay strictly between 0 and 1.  Repeated rows get equal
scores, null ids stay, an empty table gives no rows, other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import in_batches
from textloom.llm.fertility import dup_lines, repeat_words

MOST_ROWS = 1 << 15  # labelled rows that the trees are fitted on
BINS = 64
TREES = 120
DEPTH = 4
RATE = 0.1
LEAST_WEIGHT = 5.0  # rows (by weight) on each side of a split
L2 = 1.0

# Bytes that are counted together; each kind is a statistic (its share of all characters).
KINDS = {"upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "lower": b"abcdefghijklmnopqrstuvwxyz", "digit": b"0123456789",
         "blank": b" \t\v\f\r", "line_end": b"\n", "stop": b".", "comma": b",", "bang": b"!", "question": b"?",
         "bar": b"|", "mark": b"#*$%&<>", "quote": b"\"'`", "bracket": b"()[]{}", "colon": b":;", "at": b"@",
         "dash": b"-_", "slash": b"/\\", "equal": b"=+~^"}
STATISTICS = (*KINDS, "beyond_ascii", "log_chars", "log_words", "log_lines", "word_mean", "word_spread", "word_max",
              "short_words", "long_words", "distinct_words", "repeat_words", "top_word", "dup_lines", "line_words",
              "word_entropy", "byte_entropy", "upper_of_letters", "letters_inside_words", "plain_words", "ending_words")
_KIND_OF = np.full(256, len(KINDS), dtype=np.int64)
for _k, _chars in enumerate(KINDS.values()):
    _KIND_OF[list(_chars)] = _k
_LETTER = bytes(ord("a") if chr(c).isascii() and chr(c).isalpha() or c >= 0x80 else ord(" ") for c in range(256))


def statistics_of(raw: bytes) -> list[float]:
    """The values of ``STATISTICS`` for a text in UTF-8."""
    words = raw.split()
    counts = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    chars = int(counts[:0x80].sum() + counts[0xC0:].sum())  # bytes that open a character
    kinds = np.bincount(_KIND_OF, weights=counts, minlength=len(KINDS) + 1)[:len(KINDS)]
    n, some = len(words), max(1, len(words))
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=n)
    seen: dict[bytes, int] = {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    times = np.fromiter(seen.values(), dtype=np.float64, count=len(seen)) / some
    share = counts[counts > 0] / max(1, len(raw))
    text = raw.decode("utf-8", "replace")
    lines = counts[10] + 1
    marked = raw.translate(_LETTER).split()
    return [*(kinds / max(1, chars)), counts[0xC0:].sum() / max(1, chars), np.log1p(chars), np.log1p(n),
            np.log(lines), lengths.mean() if n else 0.0, lengths.std() if n else 0.0, lengths.max() if n else 0.0,
            (lengths <= 3).sum() / some, (lengths >= 12).sum() / some, len(seen) / some, repeat_words(words) / some,
            times.max() if n else 0.0, dup_lines(text) / lines, n / lines, -(times * np.log2(times)).sum() if n else 0.0,
            -(share * np.log2(share)).sum() if len(raw) else 0.0, kinds[0] / max(1.0, kinds[0] + kinds[1]),
            sum(map(len, marked)) / max(1, int(lengths.sum())), sum(map(bytes.isalpha, words)) / some,
            sum(w.endswith((b".", b",")) for w in words) / some]


def _statistics_task(id_col: str, text_col: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_batches(batches, 1024, text_col, 1 << 21):
            texts = batch.column(batch.schema.get_field_index(text_col)).cast(pa.large_binary()).to_pylist()
            x = np.array([statistics_of(t or b"") for t in texts], dtype=np.float32).reshape(len(texts), -1)
            ends = np.arange(len(texts) + 1, dtype=np.int32) * len(STATISTICS)
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(id_col)),
                                              pa.ListArray.from_arrays(pa.array(ends), pa.array(x.ravel()))], ["id", "x"])
    return run


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: ``id`` and ``x``, the array of its statistics."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return rows.mapInArrow(_statistics_task("id", "text"), "id long, x array<float>")


class Forest(NamedTuple):
    """All trees in flat arrays; a leaf leads to itself.  ``roots`` are the first nodes of the trees."""
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Scores of the rows of ``x``: all rows walk through all trees, one level at a time."""
        at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        row = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            at = np.where(x[row, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
        return 1 / (1 + np.exp(-(self.base + self.value[at].sum(axis=1))))


def _edges(values: np.ndarray, weights: np.ndarray, bins: int) -> np.ndarray:
    """At most ``bins`` - 1 limits between the values, at equal shares of the weight."""
    order = np.argsort(values, kind="stable")
    v, total = values[order], np.cumsum(weights[order])
    at = np.searchsorted(total, total[-1] * np.arange(1, bins) / bins)
    distinct = np.unique(v)
    low = np.unique(np.searchsorted(distinct, v[np.minimum(at, len(v) - 1)]))
    low = low[low < len(distinct) - 1]
    return ((distinct[low].astype(np.float64) + distinct[low + 1]) / 2).astype(np.float32)


def _tree(bins: np.ndarray, edges: list[np.ndarray], g: np.ndarray, h: np.ndarray, w: np.ndarray, depth: int,
          n_bins: int) -> tuple[list[list], np.ndarray]:
    """Nodes [feature, threshold, left, right, value] of one tree, and the node in which each row ends."""
    n, f = bins.shape
    nodes = [[0, np.inf, 0, 0, 0.0]]
    node = np.zeros(n, dtype=np.int64)
    open_nodes = [0]
    flat = bins + np.arange(f) * n_bins
    for level in range(depth + 1):
        local = np.full(len(nodes), -1, dtype=np.int64)
        local[open_nodes] = np.arange(len(open_nodes))
        rows = np.flatnonzero(local[node] >= 0)
        mine = local[node[rows]]
        size = len(open_nodes) * f * n_bins
        key = (mine[:, None] * (f * n_bins) + flat[rows]).ravel()
        sums = [np.bincount(key, weights=np.repeat(v[rows], f), minlength=size).reshape(-1, f, n_bins)
                for v in (g, h, w)]
        all_g, all_h = (s[:, 0].sum(axis=1) for s in sums[:2])
        for i, k in enumerate(open_nodes):
            nodes[k][4] = -RATE * all_g[i] / (all_h[i] + L2)
        if level == depth:
            break
        lg, lh, lw = (np.cumsum(s, axis=2) for s in sums)
        tg, th, tw = (x[:, :, -1:] for x in (lg, lh, lw))
        gain = lg**2 / (lh + L2) + (tg - lg)**2 / (th - lh + L2) - tg**2 / (th + L2)
        gain[(lw < LEAST_WEIGHT) | (tw - lw < LEAST_WEIGHT)] = 0
        best = gain.reshape(len(open_nodes), -1)
        choice, worth = best.argmax(axis=1), best.max(axis=1)
        grown = []
        for i, k in enumerate(open_nodes):
            if worth[i] <= 1e-6:
                continue
            feature, cut = divmod(int(choice[i]), n_bins)
            if cut >= len(edges[feature]):
                continue
            nodes[k][:4] = [feature, float(edges[feature][cut]), len(nodes), len(nodes) + 1]
            here = rows[mine == i]
            node[here] = np.where(bins[here, feature] <= cut, len(nodes), len(nodes) + 1)
            for _ in range(2):
                grown.append(len(nodes))
                nodes.append([0, np.inf, len(nodes), len(nodes), 0.0])
        open_nodes = grown
        if not grown:
            break
    for k, x in enumerate(nodes):
        if x[1] == np.inf:
            x[2] = x[3] = k
    return nodes, node


def boost(x: np.ndarray, y: np.ndarray, w: np.ndarray, trees: int = TREES, depth: int = DEPTH,
          n_bins: int = BINS) -> Forest:
    """Trees fitted to labels ``y`` (0 or 1) with weights ``w``."""
    total, ones = float(w.sum()), float((w * y).sum())
    base = float(np.log((ones + 0.5) / (total - ones + 0.5)))
    edges = [_edges(x[:, k], w, n_bins) if len(x) else np.zeros(0, np.float32) for k in range(x.shape[1])]
    bins = np.stack([np.searchsorted(e, x[:, k], side="left") for k, e in enumerate(edges)], axis=1)
    margin = np.full(len(x), base)
    flat, roots = [], []
    for _ in range(trees if 0 < ones < total else 0):
        p = 1 / (1 + np.exp(-margin))
        nodes, node = _tree(bins, edges, w * (p - y), w * p * (1 - p), w, depth, n_bins)
        margin += np.array([n[4] for n in nodes])[node]
        roots.append(len(flat))
        flat += [[n[0], n[1], n[2] + roots[-1], n[3] + roots[-1], n[4]] for n in nodes]
    columns = list(zip(*flat, strict=True)) if flat else [[]] * 5
    types = (np.int64, np.float32, np.int64, np.int64, np.float64)
    return Forest(*[np.array(c, dtype=t) for c, t in zip(columns, types, strict=True)],
                  np.array(roots, dtype=np.int64), depth, base)


def fit(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
        most_rows: int = MOST_ROWS) -> Forest:
    """A forest for ``labels`` from the statistics of the rows that have one."""
    label = (F.col(f"`{label_col}`") > 0).cast("int")
    shares = labels.select(F.col(f"`{id_col}`").cast("long").alias("key"), label.alias("y")) \
        .filter("key IS NOT NULL AND y IS NOT NULL").groupBy("key").agg(F.avg("y").alias("y"))
    # Equal statistics are one row: its weight, and how much of that has label 1.
    rows = stats.join(shares, F.col("id") == F.col("key")).groupBy("x") \
        .agg(F.count("*").alias("w"), F.sum("y").alias("ones"))
    taken = rows.withColumn("h", F.pmod(F.xxhash64("x"), F.lit(1 << 32)))
    share = min(1.0, most_rows / max(1, taken.count()))
    found = taken.filter(F.col("h") < int(share * (1 << 32))).select("h", "x", "w", "ones").toArrow()
    x = np.array(found.column("x").combine_chunks().flatten(), dtype=np.float32).reshape(-1, len(STATISTICS))
    w, ones = (found.column(c).to_numpy().astype(np.float64) for c in ("w", "ones"))
    order = np.lexsort((*x.T, found.column("h").to_numpy()))
    x, w, ones = x[order], w[order], ones[order]
    # A row of both labels counts for each with its part of the weight.
    both = np.concatenate([x, x]), np.repeat([0.0, 1.0], len(x)), np.concatenate([w - ones, ones])
    some = both[2] > 0
    return boost(both[0][some], both[1][some], both[2][some])


def _score_task(forest: Forest) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                x = np.asarray(part.column(part.schema.get_field_index("x")).flatten()).reshape(part.num_rows, -1)
                yield pa.RecordBatch.from_arrays([part.column(part.schema.get_field_index("id")),
                                                  pa.array(forest.predict(x))], ["id", "score"])
    return run


def score(stats: DataFrame, forest: Forest) -> DataFrame:
    """Per row of ``stats``: ``id`` and ``score``, the probability of label 1."""
    return stats.select("id", "x").mapInArrow(_score_task(forest), "id long, score double")
