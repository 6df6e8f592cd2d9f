"""Steps whose cost must not grow with the length of a row, the tokens of a table or the size of a row group."""

import random
import time

import pytest
from pyspark.sql import functions as F

from textloom.operators import annotate as A
from textloom.operators import lexicon as L
from textloom.operators import subword as SW
from textloom.plans import fixtures as FX

from .conftest import SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["token_offsets", "pos_csv_islands", "lexicon_lookup"])
def test_documents_are_dealt_to_tasks(spark, name):
    """A file with one row group is read by one task; the work on its texts is done by several."""
    import __spark_entry__ as E
    assert "hashpartitioning(doc_id" in plan(E.queries()[name](spark, SMALL)).split("Scan parquet")[0]


def test_turns_are_dealt_to_tasks_before_they_are_scored(spark):
    import __spark_entry__ as E
    scored = plan(E.queries()["batch_tag_scores"](spark, SMALL))
    assert "hashpartitioning(task_id" in scored[scored.index("ArrowEvalPython"):]  # below the tokenizer


def test_offsets_of_odd_texts(spark):
    texts = ["", None, "a b", " ", "𝒳y ʻo'a, é", None, "x"]
    df = spark.createDataFrame(list(enumerate(texts)), "i long, t string").coalesce(1)
    got = [tuple(r) for r in A.token_offsets(df, "i", "t").orderBy("i", "tok_idx").collect()]
    assert [r[2] for r in got if r[0] == 2] == ["a", "b"] and {r[0] for r in got} == {2, 4, 6}
    assert all(texts[i][s:e] == tok for i, _, tok, s, e in got) and len([r for r in got if r[0] == 4]) > 3
    assert A.token_offsets(df.filter("t IS NULL"), "i", "t").count() == 0


def test_labels_of_a_long_sentence_take_time_in_proportion(spark):
    labels = {t: i for i, t in enumerate(["PUNCT", "NUM", "PROPN", *FX.HASH_TAGS])}
    words = [f"w{i}x" for i in range(6000)]
    df = spark.createDataFrame([(1, words)], "k long, tokens array<string>")
    s = df.select("k", "tokens", F.transform("tokens", lambda t, i: FX.tag_rule(t, i + 1)).alias("tags"))
    vocab = spark.createDataFrame([(t, i) for i, t in enumerate([*SW.WORDPIECE_SPECIALS, "w", *[f"##{c}" for c in "0123456789x"]])],
                                  "token string, id int")
    enc = SW.encode(s, F.col("tokens"), vocab, [])
    enc = enc.withColumn("labels", SW.subtoken_labels(enc, "tags", labels))
    begin = time.time()
    got = {r["word_id"]: r["pred"] for r in SW.first_subtokens(enc, ["k"], "labels", -100).collect()}
    assert time.time() - begin < 25
    want = {i: labels[t] for i, t in enumerate(s.first()["tags"])}
    assert got == want


def test_first_subtokens_like_the_grouped_form(spark):
    rng = random.Random(5)
    rows = []
    for k in (1, 2, 2, 3, None):
        ids = sorted(rng.choices(range(8), k=12))
        rows.append((k, [-1, *ids, -1], [-100, *[rng.choice([-100, w, w]) for w in ids], -100]))
    rows.append((4, [-1, -1], [-100, -100]))
    df = spark.createDataFrame(rows, "k long, word_ids array<int>, labels array<int>").repartition(3)
    flat = df.select("k", F.posexplode(F.arrays_zip("word_ids", "labels")).alias("pos", "z")).select(
        "k", "pos", F.col("z.word_ids").alias("word_id"), F.col("z.labels").alias("pred")).filter("pred <> -100")
    key = lambda r: tuple(-9 if v is None else v for v in r)
    want = SW.first_subtoken(flat.withColumn("score", F.lit(1.0)), ["k"]).select("k", "word_id", "pred").collect()
    got = SW.first_subtokens(df, ["k"], "labels", -100).select("k", "word_id", "pred").collect()
    assert sorted(map(key, got)) == sorted(map(key, want)) and got


def test_lookup_counts_tokens_where_they_are_cut(spark):
    tokens = spark.createDataFrame([(d, w) for d, ws in ((1, "a b a zz"), (2, "zz"), (None, "a ā")) for w in ws.split()],
                                   "d long, w string")
    index = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "folded string")
    small = L.lookup_counts(tokens, index, "d", "w")
    key = lambda r: tuple(-9 if v is None else v for v in r)
    got = sorted(map(key, small.collect()))
    assert got == [(-9, 2, 2, 4), (1, 4, 3, 5), (2, 1, 0, 0)]
    assert got == sorted(map(key, L.lookup_counts(tokens, index, "d", "w", most_keys=0).collect()))
    assert "hashpartitioning(folded" not in plan(small) and "BroadcastHashJoin" in plan(small)
