"""JOIN-02 in one row: the sweep against every span of a sentence, and against the join of token and span tables."""

import json

from hypothesis import given, settings
from hypothesis import strategies as st

from textloom.operators import annotate as A

LABELS = st.sampled_from(["A", "B", "C", "", None])


def plain_labels(tokens, spans):
    keyed = {}
    for start, end, label in spans:
        keyed[(start, end)] = label
    return [keyed.get(t) or next((x for (s, e), x in keyed.items() if not (t[1] <= s or t[0] >= e)), None) for t in tokens]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(1, 4)), max_size=12),
       st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30), LABELS), max_size=12))
def test_sweep(gaps, spans):
    tokens, at = [], 0
    for gap, n in gaps:
        tokens.append((at + gap, at + gap + n))
        at += gap + n
    assert A.sweep_labels(tokens, spans) == plain_labels(tokens, spans)


def test_rows_against_the_join_of_tables(spark):
    texts = ["Pele ke! ola ua hu", "", None, "a b", "x " * 50, "no spans here."]
    marks = [[(0, 4, "NOUN"), (0, 4, "VERB"), (5, 9, "ADJ"), (3, 7, "DET"), (12, 12, "ZERO"), (13, 15, "")], [(0, 1, "A")],
             [(0, 1, "A")], [(0, 2**31 - 2, "FAR")], [(10, 30, "L"), (20, 22, "S"), (21, 21, "Z")], None]
    said = [None if m is None else json.dumps([{"start": s, "end": e, "labels": [x]} for s, e, x in m]
                                              + [{"start": 0, "end": 9, "labels": []}]) for m in marks]
    rows = [*enumerate(zip(texts, said, strict=True)), (90, ("bad json", "[{")), (91, ("bad json", "  "))]
    df = spark.createDataFrame([(i, *r) for i, r in rows], "id long, text string, j string")
    got = A.span_labels(df, "id", "text", "j")
    toks = A.token_offsets(df.filter("text IS NOT NULL"), "id", "text").withColumnRenamed("token", "form")
    want = A.best_labels(toks, A.spans_from_json(df, "id", "j"), "id", ["id", "tok_idx"])
    cols = ["id", "tok_idx", "form", "start", "end", "label"]
    assert got.columns == cols
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(*cols).collect()))


def test_many_spans_in_one_sentence():
    n = 60_000
    tokens = [(2 * k, 2 * k + 1) for k in range(n)]
    spans = [(0, 2 * n, "ALL"), *[(2 * k, 2 * k + 2, "T") for k in range(n)]]
    assert set(A.sweep_labels(tokens, spans)) == {"ALL"}
