"""Exact quantiles and distinct counts against numpy and sets, and their plans."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.operators import profile as P


def plan_of(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.mark.parametrize("kind", ["long", "double"])
def test_quantiles(spark, kind):
    rng = random.Random(1)
    rows = [(g, None if rng.random() < 0.1 else rng.choice([rng.randint(-50, 50), 7]) * (1 if kind == "long" else 0.37))
            for g in (["a"] * 400 + ["b"] * 3 + ["c"] + [None] * 90)] + [("none", None)] * 2
    df = spark.createDataFrame(rows, f"g string, x {kind}")
    at = (0.0, 0.1, 0.25, 0.5, 0.9, 1.0)
    got = {r["g"]: r["q"] for r in P.quantiles(df, "x", at, "g").collect()}
    assert "none" not in got
    for g in ("a", "b", "c", None):
        x = [v for k, v in rows if k == g and v is not None]
        assert (g in got) == bool(x)
        assert not x or np.allclose(got[g], np.quantile(x, at))
    whole = P.quantiles(df, "x", at).first()["q"]
    assert np.allclose(whole, np.quantile([v for _, v in rows if v is not None], at))
    d = {r["g"]: r for r in P.describe(df, "x", "g").collect()}
    assert d["none"]["p50"] is None and d["none"]["count"] == 0 and d["a"]["p50"] == pytest.approx(got["a"][3])
    assert P.describe(df, "x").first()["p50"] == pytest.approx(whole[3])
    f = {r["g"]: r for r in P.five_number(df, "x", "g").collect()}
    assert f[None]["median"] == pytest.approx(got[None][3]) and f["none"]["median"] is None


def test_quantiles_hold_no_group_in_one_buffer(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), F.col("id").alias("x"))
    assert "percentile" not in plan_of(P.describe(df, "x", "g")).lower()


def test_distinct_counts(spark):
    rows = [(k % 7, None if k % 5 == 0 else f"text {k % 13}", [0.0, -0.0, 1.5][k % 3]) for k in range(200)]
    df = spark.createDataFrame(rows, "a long, `b c` string, d double")
    got = {r["column_name"]: (r["n_distinct"], r["is_categorical"]) for r in P.distinct_counts(df, 8).collect()}
    assert got == {"a": (7, True), "b c": (13, False), "d": (2, True)}
    prof = {r["column_name"]: r.asDict() for r in P.column_profile(df).collect()}
    assert prof["b c"] == {"column_name": "b c", "kind": "text", "n_null": 40, "n_distinct": 13, "n_rows": 200,
                           "n_columns": 3}
    empty = {r["column_name"]: r["n_distinct"] for r in P.distinct_counts(df.limit(0)).collect()}
    assert empty == {"a": 0, "b c": 0, "d": 0}


def test_values_stay_out_of_shuffles(spark):
    df = spark.createDataFrame([(1, "long text")], "doc_id long, words string")
    for out in (P.distinct_counts(df), P.column_profile(df)):
        plan = plan_of(out)
        assert "Expand" not in plan
        blocks = [b for b in plan.split("\n\n") if ") Exchange" in b]
        assert blocks and not any("words" in b for b in blocks)


def test_estimated_words_by_the_columns_at_hand(spark):
    df = spark.createDataFrame([(100, 2), (None, 3), (None, None)], "word_count long, pages long")
    read = lambda d: [r[0] for r in d.select(P.estimated_words(d)).collect()]
    assert read(df) == [100, 900, None] and read(df.drop("pages")) == [100, None, None]
    assert read(df.drop("word_count")) == [600, 900, None] and read(df.select("pages").withColumnRenamed("pages", "p")) == [None] * 3
