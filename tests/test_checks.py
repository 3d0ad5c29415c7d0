"""Bad input stops an evaluation; rounding is no spread."""

import pytest

from rankloom.operators.checks import InputError
from rankloom.operators.measures import run_id
from rankloom.operators.ordered import GroupSize
from rankloom.operators.summary import zscore, zscore_reference
from rankloom.plans.evaluate import evaluate, evaluate_groups, evaluate_prefs

RUN, QRELS = "qid string, docno string, score double", "qid string, docno string, rel int"
PREFS = "qid string, jg string, jsg string, docno string, rel_level float"


def test_duplicates_stop_an_evaluation(spark):
    run = spark.createDataFrame([("1", "a", 2.0), ("1", "b", 1.0)], RUN)
    qrels = spark.createDataFrame([("1", "a", 1), ("1", "c", 0)], QRELS)
    for options in ({}, {"max_docs": 2}, {"judged_only": True}):
        assert evaluate(run, qrels, ["map"], **options).first().value == 1.0
        with pytest.raises(Exception, match="duplicate result: 1 a"):
            evaluate(run.union(run.limit(1)), qrels, ["map"], **options).collect()
        with pytest.raises(Exception, match="duplicate judgement: 1 a"):
            evaluate(run, qrels.union(qrels.filter("docno = 'a'")), ["map"], **options).collect()


def test_groups_take_options(spark):
    run = spark.createDataFrame([("1", "x", 3.0), ("1", "a", 2.0), ("2", "a", 2.0)], RUN)
    judged = spark.createDataFrame([("1", "j", "a", 1), ("2", "j", "a", 1)], "qid string, jg string, docno string, rel int")
    values = lambda **o: {r.qid: r.value for r in evaluate_groups(run, judged, ["map_avgjg"], **o).collect()}
    assert values() == {"1": 0.5, "2": 1.0}
    assert values(judged_only=True) == {"1": 1.0, "2": 1.0}
    assert values(max_docs=1) == {"1": 0.0, "2": 1.0}
    assert values(qid="2") == {"2": 1.0}
    with pytest.raises(Exception, match="duplicate judgement"):
        evaluate_groups(run, judged.union(judged), ["map_avgjg"]).collect()


def test_contradictions_stop_an_evaluation(spark):
    run = spark.createDataFrame([("1", "a", 2.0), ("1", "b", 1.0)], RUN)
    good = [("1", "j", "s", "a", 2.0), ("1", "j", "s", "b", 1.0)]
    assert evaluate_prefs(run, spark.createDataFrame(good, PREFS), ["prefs_simp"]).first().value == 1.0
    turned = [("1", "j", "t", "a", 1.0), ("1", "j", "t", "b", 2.0)]
    for bad in (turned, [("1", "j", "s", "a", 1.0)], [("1", "j", "t", "a", 0.0)]):
        with pytest.raises(InputError):
            evaluate_prefs(run, spark.createDataFrame(good + bad, PREFS), ["prefs_simp"]).collect()
    assert evaluate_prefs(run, spark.createDataFrame(good, PREFS), ["prefs_simp"], qid="2").count() == 0


def test_rounding_is_no_spread(spark):
    values = spark.createDataFrame([("1", "map", v) for v in (0.1 + 0.2, 0.3, 0.3)], "qid string, measure string, value double")
    reference = zscore_reference(values)
    assert reference.first().stddev == 0.0
    assert {r.value for r in zscore(values, reference).collect()} == {0.0}


def test_run_tag_needs_the_order_of_lines(spark):
    columns = "qid string, docno string, run_id string"
    assert run_id(spark.createDataFrame([("1", "a", "x")], columns)).first().text == "x"
    with pytest.raises(Exception, match="several run tags"):
        run_id(spark.createDataFrame([("1", "a", "x"), ("1", "b", "y")], columns)).collect()


@pytest.mark.parametrize("name", ["num_ret", "num_rel", "num_rel_ret", "set_P", "set_F", "num_nonrel_judged_ret", "map", "ndcg"])
def test_every_measure_stops_at_duplicates(spark, name):
    run = [("q", "a", 2.0), ("q", "b", 1.0)]
    qrels = [("q", "a", 1), ("q", "c", 0)]
    make_run = lambda rows: spark.createDataFrame(rows, "qid string, docno string, score double")
    make_qrels = lambda rows: spark.createDataFrame(rows, "qid string, docno string, rel int")
    assert evaluate(make_run(run), make_qrels(qrels), [name]).count() == 1
    with pytest.raises(Exception, match="duplicate result"):
        evaluate(make_run([*run, ("q", "a", 1.5)]), make_qrels(qrels), [name]).collect()
    with pytest.raises(Exception, match="duplicate judgement"):
        evaluate(make_run(run), make_qrels([*qrels, ("q", "a", 1)]), [name]).collect()


def test_a_report_of_one_topic_has_no_other(spark):
    from rankloom.plans.evaluate import report

    run = spark.createDataFrame([(q, d, s) for q in "12" for d, s in (("a", 2.0), ("b", 1.0))], "qid string, docno string, score double")
    qrels = spark.createDataFrame([(q, "a", 1) for q in "12"], "qid string, docno string, rel int")
    rows = report(run, qrels, ["map", "num_q", "relstring"], per_topic=True, qid="1").collect()
    assert {r.qid for r in rows} == {"1", "all"}
    assert {(r.qid, r.measure): r.value for r in rows if r.text is None} == {("1", "map"): 1.0, ("all", "map"): 1.0, ("all", "num_q"): 1.0}
    assert [r.text for r in rows if r.measure == "relstring"] == ["1-"]


def test_all_measures_read_run_and_judgements_once(spark, tmp_path):
    run = spark.createDataFrame([("q", f"d{i}", float(i)) for i in range(20)], "qid string, docno string, score double")
    qrels = spark.createDataFrame([("q", f"d{i}", i % 3) for i in range(0, 30, 2)], "qid string, docno string, rel int")
    run.write.parquet(str(tmp_path / "run"))
    qrels.write.parquet(str(tmp_path / "qrels"))
    run, qrels = spark.read.parquet(str(tmp_path / "run")), spark.read.parquet(str(tmp_path / "qrels"))
    size = 20  # a known bound: no count of the topics before
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = evaluate(run, qrels, "all", size=GroupSize(size, size))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("tmp") and len([x for x in plan.splitlines() if "FileScan" in x and "/run" in x]) == 1
    assert len([x for x in plan.splitlines() if "FileScan" in x and "/qrels" in x]) == 1


def test_groups_are_not_joined_with_the_run_by_topic(spark):
    run = spark.createDataFrame([("q", f"d{i}", float(-i)) for i in range(9)], "qid string, docno string, score double")
    qrels = spark.createDataFrame([("q", jg, f"d{i}", (i + k) % 3 - 1) for k, jg in enumerate("ab") for i in range(1, 12, 2)], "qid string, jg string, docno string, rel int")
    found = {r.measure: r.value for r in evaluate_groups(run, qrels, judged_only=True).collect()}
    expected = []
    for k, jg in enumerate("ab"):
        levels = [(i + k) % 3 - 1 for i in range(1, 9, 2) if (i + k) % 3 > 0]  # judged retrieved, in rank order
        total = sum((i + k) % 3 - 1 >= 1 for i in range(1, 12, 2))
        hits = [n for n, level in enumerate(levels, 1) if level >= 1]
        expected.append(sum((j + 1) / n for j, n in enumerate(hits)) / total if total else 0.0)
    assert found["map_avgjg"] == pytest.approx(sum(expected) / 2)
