"""The stored tagger: what is loaded predicts as what was fitted; weights stand for repeated rows; retraining refits it."""

import random
import threading

import pytest
from pyspark.sql import functions as F

from textloom.operators import annotate as A
from textloom.operators import taggers as TG
from textloom.session import at_once
from textloom.sources.store import Store
from textloom.streaming import retrain as RT


def rows(spark, n=400):
    rng = random.Random(7)
    out = []
    for i in range(n):
        w = rng.choice(["run", "house", "red", "walks", "the"])
        out.append((i, w, {"run": "V", "house": "N", "red": "A", "walks": "V", "the": "D"}[w], rng.choice(["<s>", "the", "red"]),
                    rng.choice(["</s>", "house", "run"])))
    return spark.createDataFrame(out, "i long, token string, tag string, prev string, next string")


def test_stored_tagger_predicts_alike(spark, tmp_path):
    df = rows(spark)
    store = Store(spark, str(tmp_path / "tagger"))
    fitted = TG.fit_logreg(df, ngram=2, max_features=50)
    assert TG.save_logreg(store, fitted, "first") == 1
    loaded = TG.load_logreg(store)
    assert loaded[1] == 2
    read = lambda m: sorted(tuple(r) for r in TG.predict(m, df).select("i", "pred", F.round("score", 9)).collect())
    assert read(loaded) == read(fitted)
    whole = TG.evaluate(TG.predict(loaded, df)).first()
    few = TG.distinct_rows(df)
    assert few.count() < df.count() and TG.evaluate(TG.predict(loaded, few), "n").first() == whole


def test_retraining_refits_the_stored_tagger(spark, tmp_path):
    d = str(tmp_path)
    label = '[{"start": 0, "end": 2, "labels": ["NOUN"]}, {"start": 3, "end": 5, "labels": ["VERB"]}]'
    emitted = [(p, 0, 10 * p + k, 0, t, label, False) for p in (1, 2) for k, t in enumerate(["aa xx", "bb yy", "aa zz"])]
    spark.createDataFrame(emitted, RT.EMITTED).write.parquet(f"{d}/emitted")
    store = Store(spark, f"{d}/tagger")
    RT.retrain_all(spark, d, RT.tagger_trainer(store))
    status = RT.read_table(spark, d, "status", RT.STATUS).collect()
    assert sorted((r["project"], r["status"], r["error"]) for r in status) == [(1, "done", None), (2, "done", None)]
    assert store.current() == 1
    new = spark.createDataFrame([("aa", "<s>", "xx"), ("yy", "bb", "</s>")], "token string, prev string, next string")
    got = {r["token"]: r["pred"] for r in TG.predict(TG.load_logreg(store), new).collect()}
    assert got == {"aa": "NOUN", "yy": "VERB"}


def test_a_trigger_reads_its_own_and_pending_rows_only(spark, tmp_path):
    d = str(tmp_path)
    label = '[{"start": 0, "end": 2, "labels": ["NOUN"]}]'

    def emit(epoch, batches):
        spark.createDataFrame([(1, b, b, 0, f"w{b} x", label, False) for b in batches], RT.EMITTED) \
            .write.mode("overwrite").parquet(f"{d}/emitted/epoch={epoch}")

    seen = []

    def train_all(tokens, path):
        mine = sorted({r["batch_id"] for r in tokens.select("batch_id").collect()})
        seen.append(mine)
        if 2 in mine and len(seen) < 4:
            raise ValueError("no luck")

    def trigger(epoch):
        RT.retrain_all(spark, d, train_all, epoch=epoch)
        RT.due(spark, d, epoch).write.mode("overwrite").parquet(f"{d}/pending/epoch={epoch}")

    emit(0, [1, 2])
    trigger(0)  # both fail together; alone, 1 succeeds and 2 fails
    assert seen == [[1, 2], [1], [2]]
    emit(1, [3])
    trigger(1)  # 2 is carried over
    assert seen[3:] == [[2, 3]]
    trigger(1)  # delivered again: everything of it is done
    assert len(seen) == 4
    emit(2, [4])
    trigger(2)
    assert seen[4:] == [[4]] and RT.pending(spark, d).count() == 0


def emit(spark, d, n, project=1):
    label = '[{"start": 0, "end": 2, "labels": ["NOUN"]}]'
    spark.createDataFrame([(project, b, b, 0, f"w{b} x", label, False) for b in range(n)], RT.EMITTED).write.parquet(f"{d}/emitted")


def test_one_bad_batch_costs_few_attempts(spark, tmp_path):
    d, seen = str(tmp_path), []
    emit(spark, d, 8)

    def train_all(tokens, path):
        seen.append(sorted({r["batch_id"] for r in tokens.select("batch_id").collect()}))
        if 5 in seen[-1]:
            raise ValueError("no luck")

    RT.retrain_all(spark, d, train_all)
    assert seen == [[*range(8)], [0, 1, 2, 3], [4, 5, 6, 7], [4, 5], [4], [5], [6, 7]]
    status = RT.read_table(spark, d, "status", RT.STATUS).collect()
    assert sorted((r["batch_id"], r["version"], r["status"]) for r in status) == [
        *((b, b + 1, "done") for b in range(5)), (5, 6, "failed"), (6, 6, "done"), (7, 7, "done")]
    assert {r["batch_id"] for r in RT.pending(spark, d).collect()} == {5}


def test_counts_are_written_while_the_tagger_is_fitted(spark, tmp_path, monkeypatch):
    d, both = str(tmp_path), threading.Barrier(2, timeout=60)
    emit(spark, d, 2)

    def meet(f):
        def met(*args, **options):
            both.wait()
            return f(*args, **options)
        return met

    monkeypatch.setattr(RT, "label_models", meet(RT.label_models))
    monkeypatch.setattr(TG, "fit_logreg", meet(TG.fit_logreg))
    store = Store(spark, f"{d}/tagger")
    RT.retrain_all(spark, d, RT.tagger_trainer(store, max_features=2, most_rows=3))
    assert sorted((r["batch_id"], r["status"]) for r in RT.read_table(spark, d, "status", RT.STATUS).collect()) == [
        (0, "done"), (1, "done")]
    assert A.read_conllu(spark, f"{d}/corpus/project=1/batch=1").count() == 2
    assert spark.read.parquet(f"{d}/models").count() == 4
    assert store.current() == 1 and len(TG.load_logreg(store)[0].stages[1].vocabulary) == 2


def test_steps_at_once_all_end_before_an_error(spark):
    ended = []

    def bad():
        raise ValueError("no luck")

    assert at_once(spark, lambda: 1, lambda: spark.range(2).count()) == [1, 2]
    with pytest.raises(ValueError, match="no luck"):
        at_once(spark, bad, lambda: ended.append(spark.range(3).count()))
    assert ended == [3]
