"""Periodic runs against plain comparison of every period."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm import odd
from textloom.llm import runs
from textloom.llm.queries import op13_period_runs, periodic_tail


def plain_runs(words, least=12):
    found = {}
    n = len(words)
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            if words[i] != words[i + p]:
                i += 1
                continue
            end = i
            while end + p < n and words[end] == words[end + p]:
                end += 1
            if end - i >= p and end + p - i >= least:
                found.setdefault((i, end + p - i), p)
            i = end
    return sorted((s, n, p) for (s, n), p in found.items())


def got_runs(docs, least=12):
    return [[tuple(r) for r in x.tolist()] for x in
            runs.find_runs(runs.numbered([[str(w).encode() for w in d] for d in docs]), least)]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=60), max_size=5), st.sampled_from([2, 5, 12]))
def test_runs_of_small_alphabets(docs, least):
    assert got_runs(docs, least) == [plain_runs(d, least) for d in docs]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 4), min_size=1, max_size=9), st.integers(1, 9)), max_size=8))
def test_runs_of_repeated_parts(parts):
    doc = [w for block, times in parts for w in block * times]
    assert got_runs([doc, doc[::-1], doc[3:]]) == [plain_runs(doc), plain_runs(doc[::-1]), plain_runs(doc[3:])]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=50), min_size=1, max_size=4).filter(any), st.data())
def test_extensions(docs, data):
    top = 3
    parts = [[top]] + [[*d, top + 1 + k] for k, d in enumerate(docs)]
    sequence = np.array([x for p in parts for x in p], dtype=np.int64)
    grammar = runs.Grammar(sequence, top)
    back = grammar.backwards()
    last = len(sequence) - 1
    k = data.draw(st.sampled_from([k for k, d in enumerate(docs) if d]))
    first = sum(len(p) for p in parts[:k + 1])
    i = data.draw(st.integers(first, first + len(docs[k]) - 1))
    j = data.draw(st.integers(first, first + len(docs[k]) - 1))
    if i == j:
        return
    want = 0
    while max(i, j) + want <= last and sequence[i + want] == sequence[j + want]:
        want += 1
    assert grammar.lce(np.array([i]), np.array([j]))[0] == want
    want = 0
    while min(i, j) - want >= 0 and sequence[i - want] == sequence[j - want]:
        want += 1
    assert back.lce(np.array([last - i]), np.array([last - j]))[0] == want


def test_grammar_spells_the_sequence_in_few_rules():
    sequence = np.array([9, *([0, 1, 0, 2] * 2000), 10], dtype=np.int64)
    grammar = runs.Grammar(sequence, 9)
    assert len(grammar.levels[-1].symbols) == 3 and sum(len(r[1]) for r in grammar.rules) < 40
    for above, below in zip(grammar.levels[1:], grammar.levels, strict=False):
        assert above.first[-1] == len(below.symbols) and (np.diff(above.first) > 0).all()


def test_long_documents_take_the_chunked_grid(monkeypatch):
    rng = random.Random(4)
    doc = [rng.randint(0, 50) for _ in range(900)] + [rng.randint(0, 5) for _ in range(40)] * 8 + [7] * 100
    want = plain_runs(doc)
    monkeypatch.setattr(runs, "GRID_WORDS", 10)
    monkeypatch.setattr(runs, "CHUNK", 300)
    assert got_runs([doc]) == [want] and len(want) == 2


def test_one_word_repeated_many_times():
    assert got_runs([[1] * 30_000]) == [[(0, 30_000, 1)]]


@pytest.mark.parametrize("words", [0, 1, 5, 40])
def test_tail_by_its_definition(words):
    text = [str(k) for k in range(words)]
    for key in [None, *range(200)]:
        h = zlib.crc32(str(key).encode())
        g, out = h // 10, list(text)
        if key is not None and h % 10 == 0 and words:
            a = g % words
            p = 1 + (words - a) // (3 + g % 8)
            out = [text[i] if i < a else text[a + (i - a) % p] for i in range(words)]
        assert periodic_tail(key, text) == out


def told(key, words):
    found = plain_runs(words)
    dropped = {k for s, n, p in found for k in range(s + p, s + n)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    text = "".join(f"{s},{n},{p}\n" for s, n, p in found)
    kept = " ".join(w for k, w in enumerate(words) if k not in dropped)
    return (key, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256(text.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def split(text):
    return [w.decode() for w in (text or "").encode().split()]


def test_query_on_odd_rows(spark, tmp_path):
    rows = [r for r in odd.rows() if r[0] != 109] + [
        (500 + k, " ".join(odd.sentence("en", 40, k) for _ in range(k)), "en", "s", 0, *["x"] * len(odd.CLASHES))
        for k in range(1, 9)]
    odd.docs(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = op13_period_runs(spark, str(tmp_path))
    want = [told(r[0], periodic_tail(r[0], split(r[1]))) for r in rows]
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
                           "collapsed_sha256"]
    assert sorted(map(repr, (tuple(r) for r in got.collect()))) == sorted(map(repr, want))
    odd.docs(spark, []).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert op13_period_runs(spark, f"{tmp_path}/none").count() == 0


def test_collapsed_documents(spark):
    rows = odd.rows()
    rows += [(700, "x " * 30 + "end", "en", "s", 0, *["x"] * len(odd.CLASHES))]
    docs = odd.docs(spark, rows)
    got = runs.collapse_runs(docs)
    assert got.columns == docs.columns
    texts = {r["doc_id"]: r["text"] for r in got.collect()}
    assert texts[700] == "x end" and texts[100] is None and texts[102] == " \t\n " and texts[5] == rows[5][1]
