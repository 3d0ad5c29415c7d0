"""The split path for large groups gives the rows of the plain windows."""

import random

import pytest
from pyspark.sql import functions as F

from rankloom.operators import ranking
from rankloom.operators.ordered import OrderedGroups
from rankloom.plans.evaluate import evaluate, evaluate_prefs


def _rows(spark):
    # One group holds most rows, many of them equal in the first order column.
    rng = random.Random(7)
    rows = [("hot", rng.randint(0, 3), f"d{i:03d}", rng.randint(0, 9)) for i in range(300)]
    rows += [(f"g{i % 9}", rng.randint(0, 3), f"e{i:03d}", rng.randint(0, 9)) for i in range(60)]
    return spark.createDataFrame(rows, "k string, s int, d string, v int").repartition(5)


def _numbered(df):
    groups = OrderedGroups(df, ["k"], [F.col("s").desc(), F.col("d").asc()])
    before = groups.df.columns
    numbered = groups.number("no").running({"total": F.col("v")}).running_max({"best": F.col("v")})
    assert groups.df.columns == before
    groups = numbered
    return groups.split, sorted(map(tuple, groups.df.select("k", "d", "no", "total", "best").collect()))


def test_split_groups_equal_plain_windows(spark):
    df = _rows(spark)
    split, plain = _numbered(df)
    assert not split
    spark.conf.set("rankloom.groupRows", "20")
    try:
        split, pieces = _numbered(df)
    finally:
        spark.conf.unset("rankloom.groupRows")
    assert split
    assert pieces == plain
    hot = [r for r in plain if r[0] == "hot"]
    assert sorted(r[2] for r in hot) == list(range(1, 301))


def _run_and_qrels(spark):
    rng = random.Random(3)
    docs = [f"d{i:02d}" for i in range(40)]
    run = [(q, d, float(rng.randint(0, 6))) for q in ("a", "b") for d in rng.sample(docs, 25)]
    qrels = [(q, d, rng.randint(-1, 3)) for q in ("a", "b") for d in rng.sample(docs, 25)]
    return (
        spark.createDataFrame(run, "qid string, docno string, score double"),
        spark.createDataFrame(qrels, "qid string, docno string, rel int"),
    )


def _values(df):
    return {(r.qid, r.measure): round(r.value, 9) for r in df.collect()}


def test_all_measures_do_not_depend_on_group_size(spark):
    run, qrels = _run_and_qrels(spark)
    plain = _values(evaluate(run, qrels, "all"))
    spark.conf.set("rankloom.groupRows", "5")
    try:
        assert _values(evaluate(run, qrels, "all")) == plain
    finally:
        spark.conf.unset("rankloom.groupRows")


def test_preference_measures_do_not_depend_on_group_size(spark):
    run, qrels = _run_and_qrels(spark)
    prefs = qrels.select(
        "qid", F.lit("j").alias("jg"), (F.col("docno") < "d20").cast("string").alias("jsg"),
        "docno", F.col("rel").cast("float").alias("rel_level"),
    )
    plain = _values(evaluate_prefs(run, prefs, "all_prefs"))
    spark.conf.set("rankloom.groupRows", "5")
    try:
        assert _values(evaluate_prefs(run, prefs, "all_prefs")) == plain
    finally:
        spark.conf.unset("rankloom.groupRows")


@pytest.mark.parametrize("k", [3, 1000, 1001])
def test_large_cuts_number_pieces(spark, small_groups, k):
    """Beyond the planner's limit no window holds a whole topic."""
    rows = [("1", f"d{i:05d}", float(i % 700)) for i in range(1500)] + [("2", "d", 1.0)]
    run = spark.createDataFrame(rows, "qid string, docno string, score double")
    found = ranking.rank_run(run, max_docs=k)
    expected = sorted(rows[:-1], key=lambda r: (r[2], r[1]), reverse=True)[:k]
    assert [r.docno for r in found.filter("qid = '1'").orderBy("rank").collect()] == [d for _, d, _ in expected]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert ("WindowGroupLimit" in plan) == (k <= 1000)
    if k > 1000:
        assert "_piece" in plan


def test_wrong_bounds_are_errors(spark):
    run = spark.createDataFrame([("1", "a", 1.0), ("1", "b", 2.0)], "qid string, docno string, score double")
    with pytest.raises(ValueError, match="more than the bound"):
        ranking.rank_run(run, size=1)
