"""Boosted trees: statistics, flat traversal against plain walks, held-out quality."""

import math
import zlib
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm import odd
from textloom.llm import boosting
from textloom.llm.queries import op12_quality


def auc(score, y):
    order = np.argsort(np.argsort(score, kind="stable"), kind="stable") + 1.0
    for v in np.unique(score):
        order[score == v] = order[score == v].mean()
    n1 = (y == 1).sum()
    return (order[y == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(y) - n1))


def walk(forest, x):
    """Each tree for itself, node by node."""
    margin = forest.base
    for root in forest.roots:
        k = int(root)
        while forest.left[k] != k:
            k = int(forest.left[k] if x[forest.feature[k]] <= forest.threshold[k] else forest.right[k])
        margin += forest.value[k]
    return 1 / (1 + math.exp(-margin))


def some_rows(n, seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, len(boosting.STATISTICS))).astype(np.float32)
    x[:, 3] = np.round(x[:, 3])
    p = 1 / (1 + np.exp(-(2 * (x[:, 0] > 0.3) * x[:, 1] + x[:, 3])))
    return x, (rng.random(n) < p).astype(float), p


def test_flat_traversal_walks_every_tree():
    x, y, _ = some_rows(500, 1)
    forest = boosting.boost(x, y, np.ones(len(x)), trees=20)
    assert len(forest.roots) == 20 and np.allclose(forest.predict(x), [walk(forest, r) for r in x])


def test_trees_learn_an_interaction():
    x, y, _ = some_rows(8000, 2)
    forest = boosting.boost(x, y, np.ones(len(x)))
    x, y, p = some_rows(4000, 3)
    assert auc(forest.predict(x), y) > auc(p, y) - 0.02


def test_splits_are_the_best_of_all():
    """The first split of a tree against trying every cut of every statistic."""
    x, y, _ = some_rows(300, 4)
    w = np.ones(len(x))
    forest = boosting.boost(x, y, w, trees=1, depth=1, n_bins=400)
    p = y.mean() + (0.5 - y.mean()) / (len(y) + 1)
    g, h = p - y, np.full(len(y), p * (1 - p))
    best = 0.0
    for f in range(x.shape[1]):
        for cut in np.unique(x[:, f])[:-1]:
            left = x[:, f] <= cut
            if min(left.sum(), (~left).sum()) >= boosting.LEAST_WEIGHT:
                gain = sum(g[s].sum() ** 2 / (h[s].sum() + boosting.L2) for s in (left, ~left))
                if gain > best:
                    best, chosen = gain, (f, left)
    f, left = chosen
    assert forest.feature[0] == f and ((x[:, f] <= forest.threshold[0]) == left).all()


def test_weights_are_repetitions():
    x, y, _ = some_rows(400, 5)
    times = np.arange(len(x)) % 3 + 1
    a = boosting.boost(x, y, times.astype(float), trees=10)
    b = boosting.boost(np.repeat(x, times, axis=0), np.repeat(y, times), np.ones(times.sum()), trees=10)
    assert np.allclose(a.predict(x), b.predict(x))


def test_labels_of_one_kind_or_none():
    x, y, _ = some_rows(50, 6)
    for label in (0.0, 1.0):
        s = boosting.boost(x, np.full(len(x), label), np.ones(len(x))).predict(x)
        assert ((s > 0) & (s < 1)).all() and abs(s[0] - label) < 0.02
    none = boosting.boost(x[:0], y[:0], np.ones(0))
    assert (none.predict(x) == 0.5).all()


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("aAbé1 .,!\n\t|#"), max_size=60))
def test_statistics(text):
    got = dict(zip(boosting.STATISTICS, boosting.statistics_of(text.encode()), strict=True))
    words = text.encode().split()
    n, chars = max(1, len(words)), max(1, len(text))
    assert math.isclose(got["upper"], sum("A" <= c <= "Z" for c in text) / chars)
    assert math.isclose(got["beyond_ascii"], sum(ord(c) > 127 for c in text) / chars)
    assert math.isclose(got["distinct_words"], len(set(words)) / n)
    assert math.isclose(got["log_chars"], math.log1p(len(text)))
    assert math.isclose(got["short_words"], sum(len(w) <= 3 for w in words) / n)
    want = -sum(c / n * math.log2(c / n) for c in Counter(words).values())
    assert math.isclose(got["word_entropy"], want, abs_tol=1e-9)
    assert all(math.isfinite(v) for v in got.values())


def bad(text):
    return " ".join(w + "###" if k % 2 else w.upper() + "!!" for k, w in enumerate(text.split()))


def test_query(spark, tmp_path):
    clash = ["x"] * len(odd.CLASHES)
    rows = [(3000 + k, bad(t) if k % 4 == 0 else t, "en", "s", 0, *clash)
            for k in range(400) for t in [odd.sentence("en", 30 + k % 90, k)]] + odd.rows()
    odd.docs(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(r[0], int(r[0] % 4 != 0), 0) for r in rows if r[0] is not None and r[0] >= 3000]
    labels += [(3001, None, 0), (None, 0, 0), (5, 1, 1), (5, 0, 0), (99_999, 1, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    found = op12_quality(spark, str(tmp_path))
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    got = found.collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)
    for r in got:
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
    held = [(r["score"], r["doc_id"] % 4 != 0) for r in got if r["held_out"] and r["doc_id"] >= 3000]
    s, y = np.array([h[0] for h in held]), np.array([h[1] for h in held], dtype=int)
    assert auc(s, y) > 0.99 and ((s >= 0.3) == y).mean() > 0.97
    again = {(r["doc_id"], r["score"]) for r in op12_quality(spark, str(tmp_path)).collect()}
    assert again == {(r["doc_id"], r["score"]) for r in got}


def test_empty_tables(spark, tmp_path):
    odd.docs(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    assert op12_quality(spark, str(tmp_path)).count() == 0
    odd.docs(spark).write.parquet(f"{tmp_path}/some/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{tmp_path}/some/labels.parquet")
    assert {r["score"] for r in op12_quality(spark, f"{tmp_path}/some").collect()} == {0.5}


def test_sample_is_bounded_and_copies_are_one_row(spark):
    clash = ["x"] * len(odd.CLASHES)
    rows = [(k, odd.sentence("en", 40, k if k >= 300 else 0), "en", "s", 0, *clash) for k in range(900)]
    stats = boosting.statistics(odd.docs(spark, rows))
    labels = spark.createDataFrame([(r[0], r[0] % 2) for r in rows], "doc_id long, quality int")
    seen = []
    real = boosting.boost
    try:
        boosting.boost = lambda x, y, w: seen.append((len(np.unique(x, axis=0)), w.sum())) or real(x, y, w, trees=2)
        boosting.fit(stats, labels)
        boosting.fit(stats, labels, most_rows=100)
    finally:
        boosting.boost = real
    assert seen[0] == (601, 900.0) and 60 < seen[1][0] < 140
