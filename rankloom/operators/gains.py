"""Graded-gain measures: ndcg, ndcg_rel, Rndcg, G and ndcg_cut.

The ideal ranking is the judged documents with a positive gain, best first. Each ideal
position carries its running ideal DCG and cost, so a retrieved document meets the ideal
by an equi-join on (topic, position), a key with one row each: no group is ever collected.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .measures import ratio
from .ordered import OrderedGroups

GAIN_MEASURES = ("ndcg", "ndcg_rel", "Rndcg", "G")


def gain_sql(gains: dict[int, float] | None = None) -> str:
    """Gain of a relevance value: its level unless overridden; unjudged gives 0."""
    cases = "".join(f" WHEN rel = {int(l)} THEN {float(g)!r}D" for l, g in (gains or {}).items())
    return f"CASE WHEN rel < 0 THEN 0D{cases} ELSE cast(rel AS double) END"


def ideal_ranking(qrels: DataFrame, gains: dict[int, float] | None = None, size=None) -> DataFrame:
    """(qid, pos, gain, idcg, cost) of the judged documents in best possible order."""
    positive = qrels.withColumn("gain", F.expr(gain_sql(gains))).filter("gain > 0")
    return (
        OrderedGroups(
            positive.select("qid", "docno", "gain"),
            ["qid"],
            [F.col("gain").desc(), F.col("docno").asc()],
            size,
        )
        .number("pos")
        .running(
            {
                "idcg": F.expr("gain / log2(pos + 1)"),
                "ideal_gain": F.col("gain"),
                "cost": F.expr("greatest(gain, 1D)"),
            }
        )
        .df.select("qid", "pos", "gain", "idcg", "ideal_gain", "cost")
    )


def _gain_levels(ideal: DataFrame) -> DataFrame:
    """One row per (topic, gain): where the level ends, and the sum of 1/IDCG of this and
    all lower level ends. Few rows per topic."""
    ends = ideal.groupBy("qid", "gain").agg(
        F.max("pos").alias("end"), F.max("idcg").alias("end_idcg")
    )
    lower = (
        Window.partitionBy("qid")
        .orderBy(F.col("gain").desc())
        .rowsBetween(Window.currentRow, Window.unboundedFollowing)
    )
    return ends.select("qid", "gain", F.sum(1.0 / F.col("end_idcg")).over(lower).alias("weight"))


class GainSheet:
    """What the gain measures of one gain table need of rows and topics, as columns named by ``no``.

    ``running`` are sums along the ranking, ``lookup`` joins ideal positions to ranks, ``totals`` has a
    row per judged topic, ``aggregates`` are sums over a topic's ranked rows, and ``values`` names
    the measures. Several tables and the plain measures share one ranked list.
    """

    def __init__(
        self, no: int, judged: DataFrame, gains: dict[int, float] | None, wanted: Sequence[str], cuts: Sequence[int] = (),
        size=None,
    ) -> None:
        self.no, self.gains, self.wanted, self.cuts = no, gains, wanted, list(cuts)
        self.steps = bool(set(wanted) - {"ndcg"})
        self.ideal = ideal_ranking(judged, gains, size)

    def named(self, text: str) -> str:
        """``text`` with {name} replaced by the sheet's column of that name."""
        return re.sub(r"{(\w+)}", rf"\1_{self.no}", text)

    def columns(self) -> dict[str, Column]:
        return {self.named("{gain}"): F.expr(gain_sql(self.gains))}

    def discounted(self) -> dict[str, Column]:
        return {self.named("{dg}"): F.expr(self.named("{gain} / log2(rank + 1)"))}

    def running(self) -> dict[str, Column]:
        if not self.steps:
            return {}
        return {self.named("{dcg}"): F.col(self.named("{dg}")), self.named("{gain_seen}"): F.col(self.named("{gain}"))}

    def lookup(self) -> DataFrame | None:
        """(qid, rank, ...) of ideal positions, for measures that compare step by step."""
        if not self.steps:
            return None
        at = self.ideal.join(_gain_levels(self.ideal), ["qid", "gain"])
        columns = [self.named(f"{c} AS {{{c}}}") for c in ("idcg", "cost", "weight")]
        return at.selectExpr("qid", "pos AS rank", *columns)

    def totals(self) -> DataFrame:
        first = [(f"sum(if(pos <= {k}, gain / log2(pos + 1), null))", f"idcg_{k}") for k in self.cuts]
        parts = [
            ("max(idcg)", "idcg_all"), ("max(ideal_gain)", "gain_all"), ("max(cost)", "cost_all"),
            ("max(pos)", "num_gain"), ("count(DISTINCT gain)", "num_levels"), *first,
        ]
        if not self.steps:
            parts = [parts[0], *first]
        return self.ideal.groupBy("qid").agg(*[F.expr(f"{e} AS {self.named('{' + n + '}')}") for e, n in parts])

    def aggregates(self) -> list[str]:
        parts = [("sum({dg})", "dcg_all")]
        parts += [(f"sum(if(rel > 0 AND rank <= {k}, rel / log2(rank + 1), 0D))", f"dcg_{k}") for k in self.cuts]
        parts += [(f"first({{idcg_{k}}})", f"best_{k}") for k in self.cuts]
        parts += [("first({idcg_all})", "best_all")]
        if self.steps:
            past = "2 + coalesce({cost}, {cost_all} + (rank - {num_gain})) - {gain_seen}"
            parts += [
                ("sum(if({gain} > 0, {dcg} / coalesce({idcg}, {idcg_all}), null))", "rel_sum"),
                ("count_if({gain} > 0)", "num_gain_ret"),
                ("sum({dg} * coalesce({weight}, 0D))", "boundary_sum"),
                ("sum(if({gain} != 0 AND {cost_all} IS NOT NULL, {gain} / log2(" + past + "), null))", "g_sum"),
                ("first({gain_all})", "best_gain"), ("first({num_gain})", "goods"), ("first({num_levels})", "levels"),
            ]
        return [self.named(f"coalesce({e}, 0) AS {{{n}}}") for e, n in parts]

    def values(self) -> dict[str, str]:
        tail = ratio("{dcg_all}", "{best_all}")
        past_ideal = "num_ret > {goods} + 1"
        rel_total = f"({{rel_sum}} + ({{goods}} - {{num_gain_ret}}) * {tail})"
        boundary_total = f"({{boundary_sum}} + if({past_ideal}, {tail}, 0D))"
        boundaries = f"({{levels}} + if({past_ideal}, 1, 0))"
        formulas = {
            "ndcg": tail,
            "ndcg_rel": f"if({rel_total} > 0, {ratio(rel_total, '{goods}')}, 0D)",
            "Rndcg": f"if(num_rel = 0 OR {{goods}} = 0, 0D, {ratio(boundary_total, boundaries)})",
            "G": ratio("{g_sum}", "{best_gain}"),
        }
        found = {name: self.named(formulas[name]) for name in self.wanted}
        return found | {f"ndcg_cut_{k}": self.named(ratio(f"{{dcg_{k}}}", f"{{best_{k}}}")) for k in self.cuts}
