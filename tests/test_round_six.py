from pyspark.sql import functions as F

from rankloom.operators.ordered import GroupSize
from rankloom.operators.prefs import Preferences, _member_conflicts, _members, _placed
from rankloom.operators.ranking import with_key


def tables(spark):
    run = [("q", f"d{i:02}", float(i % 7)) for i in range(0, 30, 2)] + [("q", "d01", None), ("r", "d1", 1.0), (None, "d1", 1.0)]
    prefs = [("q", f"d{i:02}", g, s, float(i % 4)) for i in range(25) for g in ("a", "b") for s in (("x", "y") if g == "b" and i % 3 else ("x",))]
    odd = [("q", None, "a", "x", 3.0), ("q", "d03", None, "x", 1.0), ("r", "d1", "a", "x", 0.0), ("s", "d1", "a", "x", 1.0), (None, "d1", "a", "x", 1.0)]
    return (
        spark.createDataFrame(run, "qid string, docno string, score double"),
        spark.createDataFrame(prefs + prefs[:9] + odd, "qid string, docno string, jg string, jsg string, rel_level float"),
    )


def test_places_take_one_exchange_and_no_join(spark):
    """Places of documents whose topics fit a task were joined back after three exchanges."""
    run, prefs = tables(spark)
    rows = with_key(_members(prefs).join(run, ["qid", "docno"], "left")).withColumn("retrieved", F.col("score").isNotNull())
    rows = spark.createDataFrame(rows.drop("score").collect(), rows.drop("score").schema)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _placed(rows, GroupSize(60, 100))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_a_document_of_a_group_is_one_row_with_its_distinct_judgements(spark):
    prefs = spark.createDataFrame(
        [("q", "d", "a", "x", 1.0), ("q", "d", "a", "x", 1.0), ("q", "d", "a", "y", 0.0), ("q", "e", "a", None, None)],
        "qid string, docno string, jg string, jsg string, rel_level float",
    )
    rows = _members(prefs)
    found = {r["docno"]: ([tuple(m) for m in r["members"]], r["level"]) for r in rows.collect()}
    assert found == {"d": ([("x", 1.0), ("y", 0.0)], 1.0), "e": ([(None, None)], None)}
    assert [r["rule"] for r in _member_conflicts(rows).collect()] == ["zero and non-zero"]


def test_large_and_small_topics_get_the_same_places_classes_and_counts(spark):
    run, prefs = tables(spark)

    def found(limit):
        spark.conf.set("rankloom.groupRows", limit)
        try:
            t = Preferences(run, prefs)
            return [sorted(map(str, x.select(sorted(x.columns)).collect())) for x in (t.judged, t.classes, t.group_counts(), t.balanced_counts(), t.pair_counts())]
        finally:
            spark.conf.unset("rankloom.groupRows")

    small, large = found("1000"), found("5")
    assert small == large
    # Places count documents without a name, which have no row; topics without results are left out.
    assert len(small[0]) == 25 * 2 + 1 and "s" not in "".join(r.split("qid=")[1][:3] for r in small[0])
