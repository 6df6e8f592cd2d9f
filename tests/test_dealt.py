"""Texts are dealt to tasks before they are cut; what is shuffled of a span is short."""

import pytest
from pyspark.sql import functions as F

from textloom.operators import annotate as A

from .conftest import SMALL


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["span_overlap_join", "sequence_tags"])
def test_texts_are_dealt_before_they_are_cut(spark, name):
    import __spark_entry__ as E
    assert "REPARTITION_BY_COL" in plan_of(E.queries()[name](spark, SMALL))


def test_files_of_blocks_are_as_many_as_tasks(spark, monkeypatch):
    from textloom.plans import annotate_queries as Q
    plans = []
    monkeypatch.setattr(A, "write_conllu", lambda blocks, path, compression: plans.append(plan_of(blocks)))
    Q._written(spark, SMALL)
    assert "REPARTITION_BY_COL" in plans[0]


def test_labels_become_arrays_after_the_shuffle(spark):
    rows = [(1, 2, 4, 5, "B"), (1, 0, 0, 3, "A"), (1, 1, 0, 3, None), (2, 0, 7, 9, 'q"')]
    spans = spark.createDataFrame(rows, "k long, span_ord int, start int, end int, label string").repartition(3)
    df = A.spans_to_json(spans, "k")
    assert "labels" not in plan_of(df).split("Exchange")[1]
    got = {r["k"]: r["label_json"] for r in df.collect()}
    assert got == {1: '[{"start":0,"end":3,"labels":["A"]},{"start":0,"end":3,"labels":[null]},{"start":4,"end":5,"labels":["B"]}]',
                   2: '[{"start":7,"end":9,"labels":["q\\""]}]'}
    assert A.spans_from_json(df, "k", "label_json").filter(F.col("k") == 1).count() == 3
