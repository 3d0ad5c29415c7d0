"""Evaluation plans: a run against judgements, judgement groups or preferences."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import gains as gain_ops
from ..operators import measures as m
from ..operators import prefs as pref_ops
from ..operators.ranking import judgements as checked_judgements
from ..operators.ranking import (
    Size,
    judged_counts,
    judged_ranks_by_group,
    ranked_groups,
    running_counts,
)
from ..operators.summary import report_rows, summarize, zscore

# Measures that are texts or counts of topics, not values of one topic.
_REPORT_ONLY = ("runid", "num_q", "relstring")

MeasureChoice = str | Sequence[str] | Mapping[str, object]


def choose(measures: MeasureChoice) -> dict[str, object]:
    """Expand set names; a mapping gives parameters, ``None`` meaning the defaults."""
    if isinstance(measures, str):
        measures = [measures]
    chosen: dict[str, object] = {}
    for name in measures:
        params = measures[name] if isinstance(measures, Mapping) else None
        for member in m.MEASURE_SETS.get(name, [name]):
            chosen[member] = params
    known = set(m.registered()) | set(gain_ops.GAIN_MEASURES) | {"ndcg_cut"} | set(_REPORT_ONLY)
    known |= set(m.QRELS_JG) | set(m.ALL_PREFS)
    unknown = [name for name in chosen if name not in known]
    if unknown:
        raise ValueError(f"unknown measures: {', '.join(unknown)}")
    return chosen


def _gain_label(name: str, gains: Mapping[int, float] | None) -> str:
    if not gains:
        return name
    return f"{name}_{','.join(f'{level}={gain:g}' for level, gain in gains.items())}"


def _of_topic(df: DataFrame, qid: str | None) -> DataFrame:
    return df if qid is None else df.filter(F.col("qid") == qid)


def _sheet(
    run: DataFrame,
    qrels: DataFrame,
    chosen: dict[str, object],
    *,
    level: int = 1,
    max_docs: int | None = None,
    judged_only: bool = False,
    qid: str | None = None,
    collection_size: int = 0,
    size: Size = None,
) -> tuple[DataFrame, list[tuple[str, str]], list[tuple[str, str]]]:
    """One row per topic with all sums, and the values and texts that they give.

    The run is joined, ranked and summed once for all measures: plain ones, those of every gain table,
    cut-offs and relevance strings. Ideal positions meet the ranks by (qid, rank); everything
    of the judgements comes from one checked table, whose exchange the plan uses again.
    """
    run, qrels = _of_topic(run, qid), _of_topic(qrels, qid)
    judged = checked_judgements(qrels)
    sheet = m.Sheet(level, collection_size)
    values = m.chosen_values(sheet, {n: p for n, p in chosen.items() if n in m.registered()})

    by_gains: dict[tuple, list[str]] = {}
    for name in gain_ops.GAIN_MEASURES:
        if name in chosen:
            by_gains.setdefault(tuple((chosen[name] or {}).items()), []).append(name)
    cuts = m.doc_cuts(chosen["ndcg_cut"] or m.DOC_CUTS) if "ndcg_cut" in chosen else []
    if cuts:
        by_gains.setdefault((), [])
    gains = [
        gain_ops.GainSheet(i, judged, dict(pairs), names, cuts if not pairs else ())
        for i, (pairs, names) in enumerate(by_gains.items())
    ]
    for g in gains:
        values += [
            (_gain_label(n, g.gains) if n in gain_ops.GAIN_MEASURES else n, v) for n, v in g.values().items()
        ]

    groups = ranked_groups(run, qrels, max_docs=max_docs, judged_only=judged_only, size=size)
    for add in (gain_ops.GainSheet.columns, gain_ops.GainSheet.discounted):
        groups = groups.with_columns({k: c for g in gains for k, c in add(g).items()}) if gains else groups
    running = {k: c for g in gains for k, c in g.running().items()}
    rows = running_counts(groups, level, running).df.withColumn("is_rel", F.col("rel") >= level)

    topics = judged_counts(judged, level)
    for g in gains:
        topics = topics.join(g.totals(), "qid", "left")
        lookup = g.lookup()
        if lookup is not None:
            rows = rows.join(lookup, ["qid", "rank"], "left")
    length = int((chosen.get("relstring") or [m.RELSTRING_LENGTH])[0])
    aggregates = [
        *m.TOPIC_COUNTS,
        "first(num_rel) AS num_rel",
        "first(num_nonrel) AS num_nonrel",
        *sheet.aggregates(),
        *[a for g in gains for a in g.aggregates()],
    ]
    texts = [(m.relstring_name(length), "relstring")] if "relstring" in chosen else []
    relstring = [m.relstring_aggregate(length).alias("relstring")] if texts else []
    found = rows.join(topics, "qid").groupBy("qid").agg(*[F.expr(a) for a in aggregates], *relstring)
    return found, values, texts


def evaluate(
    run: DataFrame,
    qrels: DataFrame,
    measures: MeasureChoice = "official",
    **options,
) -> DataFrame:
    """(qid, measure, value) for the topics that have results and judgements.

    Options: ``level``, ``max_docs``, ``judged_only``, ``qid`` (one topic only), ``collection_size``,
    ``size`` (rows of the largest topic, if known).
    """
    chosen = {n: p for n, p in choose(measures).items() if n not in _REPORT_ONLY}
    found, values, _ = _sheet(run, qrels, chosen, **options)
    if not values:
        raise ValueError("no measure with values chosen")
    return m.long_form(found, ["qid"], values)


def evaluate_groups(
    run: DataFrame,
    qrels_jg: DataFrame,
    measures: MeasureChoice = "qrels_jg",
    *,
    level: int = 1,
    max_docs: int | None = None,
    judged_only: bool = False,
    qid: str | None = None,
    size: Size = None,
) -> DataFrame:
    """Measures per judgement group, averaged over the groups of a topic."""
    run, qrels_jg = _of_topic(run, qid), _of_topic(qrels_jg, qid)
    inner = {"map_avgjg": "map", "P_avgjg": "P", "Rprec_mult_avgjg": "Rprec_mult"}
    chosen = {inner[n]: p for n, p in choose(measures).items() if n in inner}
    rows, counts = judged_ranks_by_group(run, qrels_jg, size, max_docs, judged_only, level)
    values = m.group_values(rows, counts, chosen, ("qid", "jg"))
    name = F.regexp_replace("measure", r"^(map|P|Rprec_mult)(?=_|$)", "$1_avgjg")
    return values.groupBy("qid", name.alias("measure")).agg(F.avg("value").alias("value"))


def evaluate_prefs(
    run: DataFrame,
    prefs: DataFrame,
    measures: MeasureChoice = "prefs",
    *,
    max_docs: int | None = None,
    strict: bool = False,
    qid: str | None = None,
    size: Size = None,
) -> DataFrame:
    """Preference measures of the topics that have results and preferences.

    Judgements that contradict each other are an error.
    """
    run, prefs = _of_topic(run, qid), _of_topic(prefs, qid)
    wanted = [n for n in choose(measures) if n not in _REPORT_ONLY]
    return pref_ops.pref_values(run, prefs, wanted, max_docs=max_docs, strict=strict, size=size)


def _first_label(kind: str, chosen: dict[str, object]) -> str:
    """A measure that every topic has a value of, by its printed name."""
    names = [n for n in chosen if n not in _REPORT_ONLY]
    if kind == "prefs":
        return names[0]
    if kind == "qrels_jg":
        inner = {"map_avgjg": "map", "P_avgjg": "P", "Rprec_mult_avgjg": "Rprec_mult"}
        label = m.chosen_values(m.Sheet(), {inner[names[0]]: chosen[names[0]]})[0][0]
        return label.replace(inner[names[0]], names[0], 1)
    return ""


def report(
    run: DataFrame,
    judgements: DataFrame,
    measures: MeasureChoice = "official",
    *,
    kind: str = "qrels",
    per_topic: bool = False,
    summary: bool = True,
    complete: bool = False,
    zscores: DataFrame | None = None,
    qid: str | None = None,
    **options,
) -> DataFrame:
    """Report rows (qid, measure, value, text): topic rows if asked for, and ``all`` rows.

    ``kind`` names the judgements: ``qrels``, ``qrels_jg`` or ``prefs`` (judgements read as
    preferences included). ``complete`` averages over all judged topics. ``qid`` leaves all
    other topics out, of every line. Values and texts come from one pass over run and judgements.
    """
    chosen = choose(measures)
    run, judgements = _of_topic(run, qid), _of_topic(judgements, qid)
    if kind == "qrels":
        valued = {n: p for n, p in chosen.items() if n not in ("runid", "num_q")}
        if not per_topic:
            valued.pop("relstring", None)
        found, values, texts = _sheet(run, judgements, valued, **options)
        evals = m.long_form(found, ["qid"], values, texts)
        pivot = values[0][0] if values else texts[0][0]
    else:
        evals = {"qrels_jg": evaluate_groups, "prefs": evaluate_prefs}[kind](run, judgements, measures, **options)
        evals = evals.withColumn("text", F.lit(None).cast("string"))
        pivot = _first_label(kind, chosen)
    if zscores is not None:
        evals = zscore(evals, zscores)
    counted = pivot if "num_q" in chosen else None
    if per_topic and summary and not complete:
        rows = report_rows(evals, pivot=counted)
    else:
        parts = []
        if per_topic or not summary:
            parts.append(report_rows(evals, summary=False))
        if summary:
            valued = evals.filter("text IS NULL").select("qid", "measure", "value")
            all_rows = summarize(valued, judgements, complete, pivot)
            all_rows = all_rows if "num_q" in chosen else all_rows.filter("measure <> 'num_q'")
            parts.append(all_rows.withColumn("text", F.lit(None).cast("string")))
        rows = reduce(DataFrame.unionByName, parts)
    rows = rows.select("qid", "measure", "value", "text")
    if summary and "runid" in chosen and "run_id" in run.columns:
        rows = rows.unionByName(m.run_id(run).withColumn("value", F.lit(None).cast("double")))
    return rows
