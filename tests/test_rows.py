"""Written rows, heads of grouped rows, masks in texts."""

import pytest

from textloom.operators import annotate as A
from textloom.operators import maskedlm as ML
from textloom.operators import sampling as S


def test_skipped_rows_and_their_numbers(spark):
    some = '[{"start": 0, "end": 1, "labels": ["X"]}]'
    rows = [(1, "a", some), (2, "b", "[]"), (3, " ", some), (4, None, some), (5, "c", None), (6, "d", some), (7, "", ""),
            (8, "e", '[{"start": 0, "end": 1, "labels": []}]'), (9, "f", some)]
    df = spark.createDataFrame(rows, "n long, text string, j string").repartition(3)
    got = {v: sorted((r["n"], r["sent_id"]) for r in A.written_rows(df, ["n"], "text", "j", v).collect())
           for v in ("labelled", "texts")}
    assert got["labelled"] == [(1, 1), (6, 2), (9, 3)]
    assert got["texts"] == [(1, 1), (2, 2), (5, 5), (6, 6), (8, 8), (9, 9)]
    with pytest.raises(ValueError):
        A.written_rows(df, ["n"], "text", "j", "other")


@pytest.mark.parametrize("fraction", [0.0, 0.01, 0.1, 0.37, 0.5, 0.999, 1.0])
def test_heads_of_groups(spark, fraction):
    rows = [(g, 3 * p + 1) for g, n in ((4, 30), (1, 3), (9, 1), (2, 0), (7, 66)) for p in range(n)]
    df = spark.createDataFrame(rows, "g long, p long").repartition(5)
    got = sorted(map(tuple, S.head_of_groups(df, "g", "p", fraction).collect()))
    assert got == sorted(rows)[:int(len(rows) * fraction)]


def test_head_of_nothing(spark):
    assert S.head_of_groups(spark.createDataFrame([], "g long, p long"), "g", "p", 0.5).count() == 0


def test_texts_with_and_without_masks(spark):
    train = spark.createDataFrame([(1, "the red house stands"), (2, "the red barn stands"), (3, "the red house burns")],
                                  "i long, text string")
    counts = ML.context_counts(train, ["i"], "text")
    texts = spark.createDataFrame([(1, "The red [MASK] stands."), (2, "no mask here"), (3, "[MASK] red [MASK]"), (4, None),
                                   (5, "[mask] is no mask")], "i long, text string")
    rows = ML.fill_texts(texts, ["i"], "text", counts, 2).collect()
    one = sorted((r["rank"], r["filler"], r["score"], r["pos"]) for r in rows if r["i"] == 1)
    assert one == [(1, "barn", 0.5, 3), (2, "house", 0.5, 3)]
    assert {(r["i"], r["hint"]) for r in rows if r["hint"]} == {(k, ML.NO_MASK) for k in (2, 4, 5)}
    assert {(r["pos"], r["rank"]) for r in rows if r["i"] == 3} == {(1, 1), (3, 1), (3, 2)}
