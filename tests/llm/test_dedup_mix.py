"""Near-duplicates against all pairs, mixing against its constraints, the pipeline against its parts."""

import random
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from tests.llm import odd
from textloom.llm import mixing, neardup
from textloom.llm.common import stored


def shingles(text, width):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    words = [w for w in low.split(" ") if w]
    if not words:
        return frozenset()
    n = min(width, len(words))
    return frozenset(tuple(words[i:i + n]) for i in range(len(words) - n + 1))


def brute(rows, width, percent):
    sets = [(r[0], shingles(r[1], width)) for r in rows]
    parent = {r[0]: r[0] for r in rows if r[0] is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, s), (b, t) in combinations(sets, 2):
        if a is not None and b is not None and s and t and 100 * len(s & t) >= percent * len(s | t):
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    return sorted((repr(i), len(s), repr(i if i is None else find(i) if s else i)) for i, s in sets)


def family(start, copies, words, swaps, seed):
    """A text and copies with some words exchanged: some pairs of copies link only through the original."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(words)]
    out = []
    for k in range(copies):
        own = list(base)
        for at in rng.sample(range(words), swaps if k else 0):
            own[at] = f"x{rng.randrange(10**6)}"
        out.append((start + k, " ".join(own), "en", "s", 0, *["x"] * len(odd.CLASHES)))
    return out


@pytest.mark.parametrize(("width", "percent", "block"), [(3, 85, 1024), (5, 80, 1024), (3, 85, 3)])
def test_components_are_those_of_all_pairs(spark, monkeypatch, width, percent, block):
    monkeypatch.setattr(neardup, "BLOCK_DOCS", block)
    rows = odd.rows() + family(1000, 25, 200, 4, 1) + family(2000, 25, 120, 3, 2) + family(3000, 12, 60, 1, 3)
    random.Random(4).shuffle(rows)
    got = neardup.near_groups(odd.docs(spark, rows), width=width, percent=percent,
                              bands=neardup.BANDS if percent == 85 else neardup.MORE_BANDS).collect()
    mine = sorted((repr(r["doc_id"]), r["n_shingles"], repr(r["component_id"])) for r in got)
    want = brute(rows, width, percent)
    # Id 110 has two texts: one node, so both its rows carry one component.
    assert mine == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_stars_join_long_chains(spark):
    edges = [(k, k + 1) for k in range(60)] + [(200, k) for k in range(100, 160)] + [(7, 7), (300, 301), (301, 300)]
    got = {r["node"]: r["label"] for r in neardup.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(61)}, **{k: 100 for k in range(100, 160)}, 200: 100, 300: 300, 301: 300}


@pytest.mark.parametrize("words", [100, 500, 1500])
def test_signatures_tell_long_texts_apart(words):
    rng = random.Random(words)
    texts = [" ".join(f"w{rng.randrange(10**9)}" for _ in range(words)) for _ in range(8)]
    texts.append(texts[0] + " tail")
    batch = pa.RecordBatch.from_pydict({"id": list(range(len(texts))), "text": texts})
    rows = neardup.BANDS * neardup.ROWS
    marks = pa.Table.from_batches(neardup._mark_task("id", "text", 3, neardup.BANDS, neardup.ROWS)(iter([batch])))
    sigs = [np.frombuffer(x, np.uint8) for x in marks.column("sig").to_pylist()]
    assert all(int((a == b).sum()) < 10 for a, b in combinations(sigs[:8], 2))
    assert int((sigs[0] == sigs[8]).sum()) >= neardup.least_agreeing(rows, 85) >= int(rows * 0.65)


def test_no_documents(spark):
    none = odd.docs(spark, [])
    assert neardup.near_groups(none).count() == 0
    assert neardup.drop_near_copies(none).count() == 0
    assert mixing.mix(none).count() == 0
    assert mixing.take(none).count() == 0


def water_fill(sizes, weights, share=1.5, most=2.0):
    """Targets by sharing what is over again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left, open_ = dict.fromkeys(names, 0.0), share * sum(sizes.values()), set(names)
    while open_ and left > 1e-9:
        total = sum(weight[s] for s in open_)
        for s in list(open_):
            target[s] += left * weight[s] / total
        left = 0.0
        for s in list(open_):
            if target[s] >= most * sizes[s]:
                left += target[s] - most * sizes[s]
                target[s] = most * sizes[s]
                open_.discard(s)
    return target


def test_mix_meets_its_targets(spark):
    rng = random.Random(9)
    rows = odd.rows()
    rows += [(5000 + k, " ".join(["w"] * int(rng.paretovariate(1.1) * 5)), "en", f"t{k * k % 5}", 0,
              *["x"] * len(odd.CLASHES)) for k in range(600)]
    first, again = ([tuple(r) for r in mixing.mix(odd.docs(spark, rows)).select(
        "doc_id", "source", "size", "source_size", "target", "rate", "copies", "taken").collect()] for _ in range(2))
    assert sorted(map(repr, first)) == sorted(map(repr, again)) and len(first) == len(rows)
    sizes = defaultdict(int)
    for _, s, n, *_ in first:
        sizes[s] += n
    want = water_fill(sizes, mixing.WEIGHTS)
    taken = defaultdict(int)
    for _, s, n, whole, target, rate, k, took in first:
        assert whole == sizes[s] and abs(target - want[s]) < 1e-6 * max(1, want[s])
        assert took == k * n <= 2 * n
        taken[s] += took
    # s3 has one document of 27000 of its 29080 words: one copy of it and two of the others is the best there is.
    assert taken.pop("s3") == 27000 + 2 * (29080 - 27000)
    for s, t in want.items():
        if s == "s3":
            continue
        assert abs(taken[s] - t) <= max(6, 0.005 * t), (s, taken[s], t)
    # Within a source the rates are an exponential of the size, cut at two copies.
    by = defaultdict(set)
    for _, s, n, _, _, rate, _, _ in first:
        if n and rate < 2:
            by[s].add((n, rate))
    for found in by.values():
        slopes = [np.log(r) / n for n, r in found]
        assert max(slopes) - min(slopes) < 1e-9


def test_targets_of_many_shapes(spark):
    rng = random.Random(3)
    for _ in range(4):
        sizes = {f"s{k:02d}": rng.choice([0, 1, 10, 500, 10**6]) for k in range(rng.randint(1, 12))}
        sizes[None] = 7
        groups = spark.createDataFrame([(s, n, 1) for s, n in sizes.items()], "source string, size long, n long")
        got = {r["source"]: r["target"] for r in mixing.source_targets(groups).collect()}
        want = water_fill(sizes, mixing.WEIGHTS)
        assert got.keys() == want.keys()
        assert all(abs(got[s] - want[s]) <= 1e-6 * max(1, want[s]) for s in want)


def test_take_repeats_rows(spark):
    docs = odd.docs(spark)
    rows = mixing.take(docs)
    assert rows.columns == docs.columns
    got = Counter(r[0] for r in rows.select("doc_id").collect())
    want = Counter()
    for r in mixing.mix(docs).collect():
        want[r["doc_id"]] += r["copies"]
    assert {i: n for i, n in want.items() if n} == dict(got)


def test_pipeline_stages_take_effect(spark):
    docs = stored(odd.docs(spark, odd.rows() + family(1000, 10, 200, 2, 5)))
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, ""))
        seen[name] = docs
        if name != "packing":
            assert docs.columns == columns
    ids = {k: [r[0] for r in v.select("doc_id").collect()] for k, v in seen.items() if k != "packing"}
    assert {100, 101, 102, 111}.isdisjoint(ids["language"]) and set(range(40)) <= set(ids["language"])
    assert {5, 105}.isdisjoint(ids["exact"]) and 106 in ids["exact"]
    assert [i for i in ids["near"] if i and 1000 <= i < 1010] == [1000]
    assert set(ids["mixing"]) <= set(ids["near"])
    pieces = seen["packing"].collect()
    assert {p["doc_id"] for p in pieces} == set(ids["mixing"])


def test_pipeline_runs_empty(spark):
    docs = odd.docs(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, ""))
    assert docs.count() == 0
