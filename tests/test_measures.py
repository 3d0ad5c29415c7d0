"""Measures on hand-made rankings."""

import math

import pytest

from rankloom.operators.measures import MEASURE_SETS, register_measure
from rankloom.operators.summary import MISSING_ZSCORE, summarize, zscore
from rankloom.plans.evaluate import choose, evaluate, evaluate_groups, report
from rankloom.sources.reports import report_lines


@pytest.fixture(scope="module")
def run(spark):
    # Topic a ranks d4, d3 (equal scores, higher id first), then d1, d9, d2.
    rows = [("a", "d3", 5.0), ("a", "d4", 5.0), ("a", "d1", 4.0), ("a", "d9", 3.0), ("a", "d2", 1.0)]
    rows += [("b", "d1", 2.0), ("b", "d2", 1.0), ("only_run", "d1", 1.0)]
    return spark.createDataFrame(
        [(*r, "tag") for r in rows], "qid string, docno string, score double, run_id string"
    )


@pytest.fixture(scope="module")
def qrels(spark):
    rows = [("a", "d4", 0), ("a", "d3", 2), ("a", "d1", -1), ("a", "d2", 1), ("a", "d7", 1)]
    rows += [("b", "d1", 0), ("b", "d5", 1), ("only_qrels", "d1", 1)]
    return spark.createDataFrame(rows, "qid string, docno string, rel int")


def values(df, qid):
    return {r.measure: r.value for r in df.collect() if r.qid == qid}


def test_values_by_hand(run, qrels):
    found = values(evaluate(run, qrels, "all"), "a")
    # Relevance by rank: 0, 2, unjudged, not pooled, 1; three relevant documents.
    assert found["num_ret"] == 5 and found["num_rel"] == 3 and found["num_rel_ret"] == 2
    assert found["map"] == pytest.approx((1 / 2 + 2 / 5) / 3)
    assert found["Rprec"] == pytest.approx(1 / 3)
    assert found["recip_rank"] == 0.5
    assert found["P_5"] == pytest.approx(0.4)
    assert found["recall_5"] == pytest.approx(2 / 3)
    assert found["bpref"] == pytest.approx(0.0)
    assert found["iprec_at_recall_0.00"] == pytest.approx(0.5)
    assert found["iprec_at_recall_1.00"] == 0.0
    assert found["num_nonrel_judged_ret"] == 1
    dcg = 2 / math.log2(3) + 1 / math.log2(6)
    ideal = 2 / math.log2(2) + 1 / math.log2(3) + 1 / math.log2(4)
    assert found["ndcg"] == pytest.approx(dcg / ideal)
    assert found["ndcg_cut_5"] == pytest.approx(dcg / ideal)
    assert found["success_1"] == 0.0 and found["success_5"] == 1.0
    assert found["utility"] == 2 - 3
    assert found["set_F"] == pytest.approx(2 * 0.4 * (2 / 3) / (0.4 + 2 / 3))
    first = 1 / 2 + (1 / 2) * (1 / 1) * (1e-5 / (1 + 2e-5))
    fourth = 1 / 5 + (4 / 5) * (3 / 4) * ((1 + 1e-5) / (2 + 2e-5))
    assert found["infAP"] == pytest.approx((first + fourth) / 3)


def test_invariants(run, qrels):
    found = values(evaluate(run, qrels, "all"), "a")
    for k in (5, 10, 100):
        assert found[f"P_{k}"] * k == pytest.approx(found[f"recall_{k}"] * found["num_rel"])
    assert found["set_map"] == pytest.approx(found["set_P"] * found["set_recall"])
    assert found["map_cut_1000"] == pytest.approx(found["map"])
    bounded = [n for n in found if not n.startswith(("num_", "gm_", "utility"))]
    assert all(0 <= found[n] <= 1 for n in bounded)


def test_summary_over_both_and_over_judged_topics(run, qrels):
    evals = evaluate(run, qrels, ["map", "gm_map", "num_rel"])
    means = values(summarize(evals), "all")
    value = 0.3
    assert means["map"] == pytest.approx(value / 2) and means["num_q"] == 2
    assert means["gm_map"] == pytest.approx(math.sqrt(value * 1e-5))
    complete = values(summarize(evals, qrels, complete=True), "all")
    assert complete["map"] == pytest.approx(value / 3) and complete["num_q"] == 3
    assert complete["num_rel"] == 5
    assert complete["gm_map"] == pytest.approx((value * 1e-10) ** (1 / 3))


def test_options(run, qrels):
    judged = values(evaluate(run, qrels, ["map", "num_ret"], judged_only=True), "a")
    assert judged["num_ret"] == 3 and judged["map"] == pytest.approx((1 / 2 + 2 / 3) / 3)
    cut = values(evaluate(run, qrels, ["num_ret", "map"], max_docs=2), "a")
    assert cut["num_ret"] == 2 and cut["map"] == pytest.approx(1 / 6)
    strict = values(evaluate(run, qrels, ["num_rel", "map"], level=2), "a")
    assert strict["num_rel"] == 1 and strict["map"] == 0.5
    assert {r.qid for r in evaluate(run, qrels, ["map"], qid="b").collect()} == {"b"}


def test_parameters_and_names(run, qrels):
    found = values(evaluate(run, qrels, {"P": [3, 1], "utility": [2, -1, 0, 0], "ndcg": {1: 3.0}}), "a")
    assert set(found) == {"P_1", "P_3", "utility_2,-1,0,0", "ndcg_1=3"}
    with pytest.raises(ValueError):
        evaluate(run, qrels, {"P": [5, 5]})
    with pytest.raises(ValueError):
        evaluate(run, qrels, {"P": [0]})
    with pytest.raises(ValueError):
        choose(["no_such_measure"])
    assert set(choose("official")) == set(MEASURE_SETS["official"])


def test_registered_measure(run, qrels):
    register_measure("first_hit", lambda sheet, params: [("first_hit", sheet.rel_max("fh", "-rank"))])
    assert values(evaluate(run, qrels, ["first_hit"]), "a")["first_hit"] == -2


def test_judgement_groups(spark, run):
    rows = [("a", "x", "d3", 1), ("a", "y", "d9", 1), ("a", "y", "d8", 1)]
    qrels = spark.createDataFrame(rows, "qid string, jg string, docno string, rel int")
    found = values(evaluate_groups(run, qrels), "a")
    assert found["map_avgjg"] == pytest.approx((1 / 2 + (1 / 4) / 2) / 2)
    assert found["P_avgjg_5"] == pytest.approx(0.2)


def test_zscores(spark, run, qrels):
    evals = evaluate(run, qrels, ["map", "num_rel", "P"])
    rows = [("a", "map", 0.1, 0.1), ("a", "num_rel", 3.0, 0.0), ("a", "P_5", 9.0, 0.0), ("a", "P_10", float("nan"), 1.0)]
    reference = spark.createDataFrame(rows, "qid string, measure string, mean double, stddev double")
    found = values(zscore(evals, reference), "a")
    assert found["map"] == pytest.approx(2.0)
    assert found["num_rel"] == 0.0
    assert found["P_5"] == MISSING_ZSCORE == found["P_15"]
    assert math.isnan(found["P_10"])


def test_report_lines(run, qrels):
    rows = report(run, qrels, ["runid", "num_q", "num_rel", "map", "relstring"], per_topic=True)
    lines = {r.line for r in report_lines(rows).collect()}
    assert "map                   \ta\t0.3000" in lines
    assert "num_rel               \tall\t4" in lines
    assert "num_q                 \tall\t2" in lines
    assert "relstring             \ta\t'02.-1'" in lines
    assert "runid                 \tall\ttag" in lines
