"""Preference counts against a listing of all document pairs."""

import random
from itertools import product

import pytest

from rankloom.operators.checks import InputError
from rankloom.operators.prefs import Preferences
from rankloom.plans.evaluate import evaluate_prefs

RUN = "qid string, docno string, score double"
PREFS = "qid string, jg string, jsg string, docno string, rel_level float"


def consistent_prefs(rng, docs, groups, subs):
    """Levels of a sub-group follow one hidden order per group, so no cycles arise."""
    rows = []
    for jg in groups:
        hidden = {d: rng.randint(0, 5) for d in docs}
        for jsg in subs[: rng.randint(1, len(subs))]:
            some = rng.sample(docs, len(docs) * 2 // 3)
            rows += [("q", jg, jsg, d, float(hidden[d] // 2 if jsg == "s1" else hidden[d])) for d in some]
    zero = {(jg, d) for _, jg, _, d, level in rows if level == 0}
    # A document is either non-relevant or relevant within a group.
    return [(q, jg, s, d, 0.0 if (jg, d) in zero and level <= 1 else level)
            for q, jg, s, d, level in rows if not ((jg, d) in zero and level > 1)]


def brute_force(run, prefs):
    """All measures by listing pairs."""
    judged = sorted({p[3] for p in prefs})
    score = {d: s for _, d, s in run}
    order = sorted(judged, key=lambda d: (d not in score, -score.get(d, 0), d))
    rank = {d: i for i, d in enumerate(order)}
    ret = {d: d in score for d in judged}
    groups = {}
    for _, jg, jsg, d, level in prefs:
        groups.setdefault(jg, []).append((jsg, d, level))
    closures, counts = {}, {}
    for jg, rows in groups.items():
        better = {(a[1], b[1]) for a, b in product(rows, rows) if a[0] == b[0] and a[2] > b[2]}
        if len({r[0] for r in rows}) > 1:
            while True:
                more = {(a, d) for (a, b), (c, d) in product(better, better) if b == c} - better
                if not more:
                    break
                better |= more
        closures[jg] = better
    pair = {}
    for better in closures.values():
        for p in better:
            pair[p] = pair.get(p, 0) + 1
    total = {"ful": 0, "poss": 0, "ful_ret": 0, "poss_ret": 0, "imp": 0}
    for better in closures.values():
        for a, b in better:
            total["poss"] += 1
            total["ful"] += ret[a] and rank[a] < rank[b]
            total["ful_ret"] += ret[a] and ret[b] and rank[a] < rank[b]
            total["poss_ret"] += ret[a] and ret[b]
            total["imp"] += ret[a] or ret[b]
    share = {}
    for a, b in {tuple(sorted(p, key=rank.get)) for p in pair}:
        there, back = pair.get((a, b), 0), pair.get((b, a), 0)
        share[a, b] = there / (there + back)
    both = [v for (a, b), v in share.items() if ret[a] and ret[b]]
    some = [v for (a, b), v in share.items() if ret[a]]
    return {
        "prefs_num_prefs_poss": total["poss"],
        "prefs_num_prefs_ful": total["ful"],
        "prefs_num_prefs_ful_ret": total["ful_ret"],
        "prefs_simp": total["ful"] / total["poss"],
        "prefs_simp_ret": total["ful_ret"] / total["poss_ret"],
        "prefs_simp_imp": total["ful"] / total["imp"],
        "prefs_pair": sum(some) / len(share),
        "prefs_pair_ret": sum(both) / len(both),
        "prefs_pair_imp": sum(some) / len([1 for a, b in share if ret[a]]),
    }


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_all_pairs(spark, seed):
    rng = random.Random(seed)
    docs = [f"d{i:02d}" for i in range(18)]
    run = [("q", d, float(rng.randint(0, 5))) for d in rng.sample(docs, 11)]
    prefs = consistent_prefs(rng, docs, ["j1", "j2", "j3"], ["s1", "s2", "s3"])
    expected = brute_force(run, prefs)
    found = evaluate_prefs(
        spark.createDataFrame(run, RUN), spark.createDataFrame(prefs, PREFS), "all_prefs"
    )
    values = {r.measure: r.value for r in found.collect()}
    for name, value in expected.items():
        assert values[name] == pytest.approx(value), name


def test_one_group_pair_equals_simple(spark):
    run = spark.createDataFrame([("q", f"d{i}", float(9 - i)) for i in range(5)], RUN)
    prefs = spark.createDataFrame([("q", "j", "s", f"d{i}", float(i % 3)) for i in range(8)], PREFS)
    values = {r.measure: r.value for r in evaluate_prefs(run, prefs, "all_prefs").collect()}
    assert values["prefs_simp"] == pytest.approx(values["prefs_pair"])


def test_closure_over_three_sub_groups_and_cycle(spark):
    rows = [
        ("q", "j", "a", "x", 2.0), ("q", "j", "a", "y", 1.0),
        ("q", "j", "b", "y", 2.0), ("q", "j", "b", "z", 1.0),
        ("q", "j", "c", "z", 2.0), ("q", "j", "c", "w", 1.0),
    ]
    run = spark.createDataFrame([("q", "x", 1.0)], RUN)
    tables = Preferences(run, spark.createDataFrame(rows, PREFS))
    assert tables.group_counts().first().poss_imp + tables.group_counts().first().poss_none == 6
    tables.check()
    cycle = rows + [("q", "j", "d", "w", 2.0), ("q", "j", "d", "x", 1.0)]
    with pytest.raises(InputError):
        Preferences(run, spark.createDataFrame(cycle, PREFS)).check()


def test_strict_leaves_out_pairs_of_the_lowest_class(spark):
    # d0 relevant, d1..d3 not: one non-relevant document is kept.
    run = spark.createDataFrame([("q", d, s) for d, s in (("d1", 3.0), ("d0", 2.0), ("d2", 1.0))], RUN)
    prefs = spark.createDataFrame([("q", "j", "s", f"d{i}", 1.0 if i == 0 else 0.0) for i in range(4)], PREFS)
    name = "prefs_avgjg_Rnonrel"
    wide = evaluate_prefs(run, prefs, [name]).first().value
    narrow = evaluate_prefs(run, prefs, [name], strict=True).first().value
    assert wide == 0.0 and narrow == 0.0
    run = spark.createDataFrame([("q", d, s) for d, s in (("d0", 3.0), ("d1", 2.0), ("d2", 1.0))], RUN)
    assert evaluate_prefs(run, prefs, [name]).first().value == pytest.approx(1 / 4)
    assert evaluate_prefs(run, prefs, [name], strict=True).first().value == 1.0


def _random_levels(n, groups, subs, seed):
    """Levels of one hidden order per group, so distinct that every document is a class."""
    rng = random.Random(seed)
    rows = []
    for jg in groups:
        hidden = list(range(n))
        rng.shuffle(hidden)
        for i in range(n):
            for jsg in subs[: 1 + i % len(subs)]:
                rows.append(("q", jg, jsg, f"d{i:06d}", float(hidden[i] + 1)))
    return rows


def test_closure_stays_linear(spark):
    n = 4000  # every document is a class of its own, half of them join the two sub-groups
    prefs = spark.createDataFrame(_random_levels(n, ["j"], ["s1", "s2"], 1), PREFS)
    run = spark.createDataFrame([("q", f"d{i:06d}", float(n - i)) for i in range(0, n, 2)], RUN)
    tables = Preferences(run, prefs)
    assert tables.classes.count() == n
    assert tables.reach().count() <= 2 * n
    assert tables.tags().count() <= 60 * n  # 13 bits, up to four places: no pairs of classes
    counts = tables.group_counts().first()
    # All pairs of a chain through both sub-groups: s1 alone orders all documents.
    assert counts.poss_ret + counts.poss_imp + counts.poss_none == n * (n - 1) // 2


def test_agreement_over_groups_stays_linear(spark):
    n = 3000  # distinct levels in two groups: every document has a profile of its own
    rows = _random_levels(n, ["j1", "j2"], ["s"], 2)
    prefs = spark.createDataFrame(rows, PREFS)
    run = spark.createDataFrame([("q", f"d{i:06d}", float(n - i)) for i in range(n)], RUN)
    tables = Preferences(run, prefs)
    groups, crossed = tables._by_profiles()
    assert crossed.isEmpty() and tables._names.count() == n
    levels = [{d: level for _, jg, _, d, level in rows if jg == j} for j in ("j1", "j2")]
    order = sorted(levels[0])
    # Pairs in rank order on which both groups agree, by counting inversions.
    expected = {(2, 0): 0, (0, 2): 0, (1, 1): 0}
    a, b = ([level[d] for d in order] for level in levels)
    for i in range(n):
        for j in range(i + 1, n):
            up = (a[i] > a[j]) + (b[i] > b[j])
            expected[up, 2 - up] += 1
    found = {(r.c, r.c_back): r.ret for r in tables.agreement().collect()}
    assert found == expected


def test_profiles_are_compared_when_groups_are_many(spark):
    rng = random.Random(5)
    docs = [f"d{i:02d}" for i in range(14)]
    prefs = [("q", f"j{g}", "s", d, float(rng.randint(0, 3))) for g in range(9) for d in docs]
    run = [("q", d, float(rng.randint(0, 9))) for d in docs[:9]]
    run_df, prefs_df = spark.createDataFrame(run, RUN), spark.createDataFrame(prefs, PREFS)
    tables = Preferences(run_df, prefs_df)
    assert not tables._by_profiles()[1].isEmpty()
    expected = brute_force(run, prefs)
    values = {r.measure: r.value for r in evaluate_prefs(run_df, prefs_df, ["prefs_pair", "prefs_pair_ret", "prefs_pair_imp"]).collect()}
    for name, value in values.items():
        assert value == pytest.approx(expected[name]), name


def test_long_chains_settle_in_few_rounds(spark):
    # Documents alternate between two sub-groups: each is known to be above the next one only.
    rows = []
    for i in range(120):
        s = ("a", "b")[i % 2]
        rows += [("q", "j", s, f"d{i:03d}", float(1000 - i)), ("q", "j", s, f"d{i + 1:03d}", float(999 - i))]
        rows[-1] = ("q", "j", s, f"d{i + 1:03d}", float(999 - i))
    run = spark.createDataFrame([("q", "d000", 1.0)], RUN)
    tables = Preferences(run, spark.createDataFrame(sorted(set(rows)), PREFS)).check()
    counts = tables.group_counts().first()
    assert counts.poss_imp + counts.poss_none == 121 * 120 // 2


def test_duplicate_results_are_an_error(spark):
    run = spark.createDataFrame([("q", "d1", 1.0), ("q", "d1", 2.0)], RUN)
    prefs = spark.createDataFrame([("q", "j", "s", "d1", 1.0), ("q", "j", "s", "d2", 0.0)], PREFS)
    with pytest.raises(Exception, match="duplicate result"):
        evaluate_prefs(run, prefs, ["prefs_simp"]).collect()


def test_conflicts_come_from_the_members(spark):
    """The judgements grouped once say the same as two groupings of their own."""
    from pyspark.sql import functions as F

    from rankloom.operators.checks import preference_conflicts
    from rankloom.operators.prefs import Preferences, _member_conflicts

    rng = random.Random(5)
    levels = [0.0, -0.0, 1.0, 2.0, -1.0, None]
    rows = [("q", rng.choice("ab"), rng.choice("xyz"), f"d{rng.randrange(12)}", rng.choice(levels)) for _ in range(60)]
    rows += [("q", "a", None, "n", 1.0), ("q", "a", None, "n", 0.0), ("q", "c", "x", "m", None), ("q", "c", "x", "o", -0.0), ("q", "c", "x", "o", 0.0)]
    prefs = spark.createDataFrame(rows, "qid string, jg string, jsg string, docno string, rel_level float")
    members = F.array_sort(F.collect_set(F.struct("jsg", F.col("rel_level").cast("double").alias("level"))))
    found = _member_conflicts(prefs.groupBy("qid", "jg", "docno").agg(members.alias("members")))
    assert sorted(found.collect()) == sorted(preference_conflicts(prefs).collect())


def test_only_retrieved_documents_get_places(spark, monkeypatch):
    """Pairs with a document that was not retrieved are products of counts; no window sees it."""
    from rankloom.operators import prefs as module

    prefs = spark.createDataFrame(
        [("q", "g", "s", f"d{i}", float(i % 3)) for i in range(9)], "qid string, jg string, jsg string, docno string, rel_level float"
    )
    run = spark.createDataFrame([("q", f"d{i}", float(10 - i)) for i in range(4)], "qid string, docno string, score double")
    tables, seen = module.Preferences(run, prefs), []
    tables.tags()
    plain = module.OrderedGroups

    def watched(df, keys, order, size=None):
        if "tag" in keys:
            seen.extend(r["doc_rank"] for r in df.select("doc_rank").distinct().collect())
        return plain(df, keys, order, size)

    monkeypatch.setattr(module, "OrderedGroups", watched)
    got = tables.counted(tables.judged).first()
    assert sorted(seen) == [0, 1, 2, 3]
    # Ranked d0 d1 d2 d3 (levels 0 1 2 0), then d4 to d8 (1 2 0 1 2).
    assert (got["ful_ret"], got["poss_ret"]) == (2, 5)
    assert (got["ful_imp"], got["poss_imp"], got["poss_none"]) == (4, 14, 8)
