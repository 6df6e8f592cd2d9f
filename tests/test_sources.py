"""Numbered lines over cut files, POS sheets without a window, the run log."""

import random

import pytest
from pyspark.sql import functions as F

from textloom.sources import formats as SF
from textloom.sources import sinks

from .test_profile import plan_of


def test_lines_of_cut_files_have_exact_numbers(spark, tmp_path):
    rng = random.Random(3)
    ends = ["\n", "\n", "\n", "\r\n"]
    files = {f"f{k}.txt": [" ".join(f"w{k}-{i}" for i in range(rng.randint(0, 12))) for _ in range(n)]
             for k, n in enumerate([4000, 0, 1, 700, 2500])}
    for name, lines in files.items():
        with open(tmp_path / name, "w", newline="") as f:
            f.writelines(x + rng.choice(ends) for x in lines)
    with open(tmp_path / "f9.txt", "w") as f:
        f.write("no end at the end")
    files["f9.txt"] = ["no end at the end"]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        got = SF.numbered_lines(spark, str(tmp_path))
        pieces = got.select("src", F.spark_partition_id().alias("p")).distinct().groupBy("src").count().collect()
        assert max(r["count"] for r in pieces) > 3  # one file is read by several tasks
        rows = got.collect()
        clean = SF.read_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    want, n = [], 0
    for name in sorted(files):
        for i, line in enumerate(files[name]):
            n += 1
            want.append((name, i + 1, n, line))
    assert sorted((r["src"].rsplit("/", 1)[1], r["line_no"], r["corpus_line_no"], r["value"]) for r in rows) == sorted(want)
    assert sorted((r["corpus_line_no"], r["text"]) for r in clean) == sorted((w[2], w[3].strip()) for w in want if w[3].strip())


def test_no_lines(spark, tmp_path):
    (tmp_path / "empty.txt").write_text("")
    assert SF.read_lines(spark, str(tmp_path)).count() == 0


def test_ragged_lines_keep_their_numbers(spark, tmp_path):
    (tmp_path / "x.tsv").write_text("a\tb\tc\n\n d \t e\n")
    got = [(r["line_no"], r["head"], r["pos"], r["value"]) for r in SF.read_ragged_tsv(spark, str(tmp_path)).collect()]
    assert sorted(got) == [(1, "a", 1, "b"), (1, "a", 2, "c"), (3, "d ", 1, " e")]


def plain_sheet(text):
    sent, out = 0, []
    for i, line in enumerate(text.replace("\r\n", "\n").split("\n")):
        if line.startswith("#"):
            sent += 1
        elif line.strip():
            cells = [c.strip() for c in line.split(",")] + [""] * 4
            if cells[0].isdigit():
                out.append((sent, i, *cells[:4]))
    return out


@pytest.mark.parametrize("text", ["# one\n1,a,b,X\n2, c ,d,Y\n,,,,\n# two\n1,e,f,Z", "1,x,y,Z\n# one\n1,a,b,X\n\n2,c,d,Y\n#\n#\n",
                                  "# a\r\n1,a,b,X\r\n\r\n# b\r\n2,c,d,Y\r\n", "", "#", "\n\n1,a,b,C"])
def test_sheets_are_cut_in_place(spark, text):
    df = spark.createDataFrame([("s", text), ("none", None)], "k string, sheet string")
    out = SF.parse_pos_csv(df, "k", "sheet")
    assert "Window" not in plan_of(out) and "Exchange" not in plan_of(out)
    got = [tuple(r)[1:] for r in out.orderBy("line_no").collect()]
    assert got == plain_sheet(text)


def test_run_log_takes_a_run_once_and_prunes(spark, tmp_path):
    path = str(tmp_path / "log")
    schema = "run_id long, experiment string, value double, metrics map<string,double>"
    first = spark.createDataFrame([(1, "lm", 0.5, {"a": 1.0}), (2, "pos", 0.7, {}), (2, "pos", 0.6, {})], schema)
    assert sinks.run_log(spark, path) is None
    sinks.append_runs(first, path)
    sinks.append_runs(first, path)  # tried again
    sinks.append_runs(first.unionByName(spark.createDataFrame([(3, "lm", 0.1, {}), (2, "lm", 0.2, {})], schema)), path)
    log = sinks.run_log(spark, path)
    assert sorted((r["experiment"], r["run_id"], r["value"]) for r in log.collect()) == [
        ("lm", 1, 0.5), ("lm", 2, 0.2), ("lm", 3, 0.1), ("pos", 2, 0.6)]
    assert "PartitionFilters: [isnotnull(experiment" in plan_of(log.filter("experiment = 'lm'"))


def test_leaderboard_scans_two_experiments_only(spark):
    from textloom.plans import eval_queries as Q

    from .conftest import SMALL
    plan = plan_of(Q._board(spark, SMALL))
    assert "PartitionFilters: [experiment" in plan or "PartitionFilters: [isnotnull(experiment" in plan
