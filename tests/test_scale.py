"""Steps whose cost must not grow faster than the tables: plans, triggers, batches."""

import glob
import tempfile

import numpy as np
from pyspark.sql import functions as F

from textloom.operators import annotate as A
from textloom.operators import features as FE
from textloom.operators import taggers as TG
from textloom.plans import fixtures as FX
from textloom.session import first_rows
from textloom.streaming import annotation_loop as AL
from textloom.streaming import feed as FD


def plan_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_events_join_nothing(spark):
    rows = [(1, 0, "user", "one"), (1, 1, "user", "two"), (1, 2, "user", "three"), (None, 2, "user", "x"), (2, 2, "user", "y")]
    events = FD.annotation_events(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string"))
    assert "Join" not in plan_of(events)
    ann, _ = AL.normalise(events)
    assert sorted((r["event_seq"], r["text"]) for r in ann.collect()) == \
        [(1000, "one"), (1002, "two"), (1004, "one"), (2004, "y")]


def test_triggers_take_chunks_not_files(spark):
    path, base = (tempfile.mkdtemp(prefix="textloom-feed-") for _ in range(2))
    rows = [(i * 1000, i, "ANNOTATION_CREATED", "{}") for i in range(64)]
    spark.createDataFrame(rows, AL.EVENT_SCHEMA).repartition(32).write.mode("append").parquet(path)
    n_files = len(glob.glob(f"{path}/part-*"))
    out = FD.run_available(FD.read_feed(spark, path), base=base)
    assert n_files > 8 and out.count() == 64
    assert len(glob.glob(f"{base}/checkpoint/commits/[0-9]*")) <= FD.CHUNKS


def test_pairs_do_not_cut_tokens_again(spark):
    docs = spark.createDataFrame([(1, "Some words. And more words, too.\nA second line")], "doc_id long, text string")
    s = FX.tagged_sentences(docs)
    tags = F.when(F.col("sent_no") == 1, F.slice("tags", 1, 1)).otherwise(F.col("tags"))
    flat = A.zip_tokens_tags(s.select(*FX.SENT_KEYS, "tokens", tags.alias("tags")), FX.SENT_KEYS)
    assert plan_of(flat).count("regexp_extract_all") == 1
    assert [r["token"] for r in flat.collect()] == ["And", "more", "words", ",", "too", "."]


def test_spans_cut_texts_once(spark):
    docs = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(1, 30)))], "doc_id long, text string")
    spans = FX.span_annotations(docs)
    assert plan_of(spans).count("ArrowEvalPython") == 1
    got = [(r["span_ord"], r["label"]) for r in spans.orderBy("span_ord").collect()]
    assert [o for o, _ in got] == sorted([2 * i for i in range(1, 30) if i % 11] + [27, 53])
    assert [x for o, x in got if o in (27, 53)] == ["SYM", "SYM"]


def test_span_json_is_parsed_once(spark):
    rows = [(1, "a b, c", '[{"start": 0, "end": 1, "labels": ["X"]}, {"start": 2, "end": 4, "labels": ["Y", "Z"]}]'),
            (2, "d", None), (3, None, "[]"), (4, "e!", '[{"start": 0, "end": 1, "labels": []}]')]
    got = A.span_labels(spark.createDataFrame(rows, "i long, t string, j string"), ["i"], "t", "j")
    assert plan_of(got).count("from_json") == 1
    assert sorted((r["i"], r["tok_idx"], r["form"], r["start"], r["end"], r["label"]) for r in got.collect()) == [
        (1, 1, "a", 0, 1, "X"), (1, 2, "b", 2, 3, "Y"), (1, 3, ",", 3, 4, "Y"), (1, 4, "c", 5, 6, "X"),
        (2, 1, "d", 0, 1, "X"), (4, 1, "e", 0, 1, "X"), (4, 2, "!", 1, 2, "PUNCT")]


def test_terms_are_counted_where_their_text_is(spark):
    rows = [(1, "a b a"), (1, "a c"), (2, "c"), (None, "a"), (3, None)]
    got = FE.term_counts(spark.createDataFrame(rows, "i long, t string"), ["i"], "t")
    assert "term" not in str([x for x in got._jdf.queryExecution().executedPlan().toString().split("\n")
                              if "hashpartitioning" in x])
    assert sorted(map(tuple, got.collect()), key=str) == [(1, "a", 3), (1, "b", 1), (1, "c", 1), (2, "c", 1), (None, "a", 1)]


def test_splits_meet_counts(spark):
    from textloom.plans.profile_queries import _tags_by_split
    from .conftest import SMALL
    assert "Aggregate [doc_id" in plan_of(_tags_by_split(spark, SMALL))


def test_first_rows_of_many_tasks(spark):
    df = spark.createDataFrame([(i * 7 % 50, str(i)) for i in range(200)], "n long, s string").repartition(16)
    want = sorted(((r["n"], r["s"]) for r in df.collect()), key=lambda r: (-r[0], r[1]))[:30]
    assert [tuple(r) for r in first_rows(df, 30, F.desc("n"), "s")] == want


def test_candidates_share_a_sample(spark, monkeypatch):
    made = []
    sample = TG.labelled_sample
    monkeypatch.setattr(TG, "labelled_sample", lambda *a: made.append(1) or sample(*a))
    rows = spark.createDataFrame([(f"word{i % 5}", "AB"[i % 2], "x", "yy") for i in range(20)],
                                 "token string, tag string, prev string, next string")
    trials = TG.search_logreg(rows, rows, [{"c": 1.0, "max_features": 3, "ngram": n} for n in (1, 2)]).collect()
    assert len(made) == 1 and all(r["macro_f1"] is not None for r in trials)


def test_texts_go_to_python_in_small_batches(spark):
    import __spark_entry__ as E
    from .conftest import SMALL
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(setting)
    for name in ("html_to_text", "html_text_joined", "page_text"):
        spark.conf.set(setting, "10000")
        E.queries()[name](spark, SMALL)
        assert int(spark.conf.get(setting)) <= 1000
    spark.conf.set(setting, old)


def test_search_is_exact(spark):
    vecs = np.random.default_rng(1).normal(size=(61, 5))
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vecs)], "id long, v array<double>")
    got = FE.search_topk(df, "id", 3, every=4, block_rows=7, vec_col="v").orderBy("id", "rank").collect()
    n = vecs / np.linalg.norm(vecs, axis=1, keepdims=True)
    s = np.round(n @ n.T, 9)
    assert sorted({r["id"] for r in got}) == list(range(0, 61, 4))
    for i in range(0, 61, 4):
        order = sorted((j for j in range(61) if j != i), key=lambda j: (-s[i, j], j))[:3]
        assert [r["other_id"] for r in got if r["id"] == i] == order


def test_ngrams_read_words_in_place(spark):
    df = spark.createDataFrame([(["a", "b", "c"],), (["a"],), ([],)], "w array<string>")
    for n, want in ((2, [["a b", "b c"], [], []]), (3, [["a b c"], [], []])):
        got = df.select(A.ngrams(F.col("w"), n).alias("g"))
        assert "slice(" not in plan_of(got)
        assert [r["g"] for r in got.collect()] == want


def test_written_sheets_are_compressed(spark):
    from textloom.plans import annotate_queries as Q
    from .conftest import SMALL
    path = Q._written(spark, SMALL).removeprefix("file:")
    assert glob.glob(f"{path}/part-*") and not glob.glob(f"{path}/part-*.txt")
