"""From per-topic values to summaries, z-scores and report rows.

Everything works on the long form ``(qid, measure, value)``. Values of geometric measures
are logarithms until the summary, so z-scores apply to the logarithm.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .measures import COUNT_MEASURES, GEOMETRIC_FLOOR, GEOMETRIC_MEASURES

# Fixed value: z-score of a value that has no usable reference row.
MISSING_ZSCORE = -1000000.0


def _is(names: frozenset[str]) -> Column:
    return F.col("measure").isin(sorted(names))


def _summary_value(topics: Column, found: Column) -> Column:
    """Sum, mean or geometric mean of a measure whose values add up to ``total``.

    ``topics`` is the number averaged over, ``found`` the number that has a value.
    """
    total = F.col("total")
    patched = total + (topics - found) * F.lit(math.log(GEOMETRIC_FLOOR))
    return (
        F.when(_is(COUNT_MEASURES), total)
        .when(_is(GEOMETRIC_MEASURES), F.exp(patched / topics))
        .otherwise(total / topics)
    )


def topic_count(evals: DataFrame) -> DataFrame:
    """The ``num_q`` row: number of topics with values."""
    count = evals.agg(F.count_distinct("qid").cast("double").alias("value"))
    return count.select(F.lit("all").alias("qid"), F.lit("num_q").alias("measure"), "value")


def _with_count(rows: DataFrame, found: Column, pivot: str | Column) -> DataFrame:
    """Summary rows (measure, value) with a ``num_q`` row beside that of the measure ``pivot``, which
    every topic has: no second pass over the values counts the topics."""
    row = F.struct(F.col("measure"), F.col("value"))
    count = F.struct(F.lit("num_q").alias("measure"), found.cast("double").alias("value"))
    pair = F.when(F.col("measure") == pivot, F.array(row, count)).otherwise(F.array(row))
    others = [c for c in rows.columns if c not in ("measure", "value")]
    return rows.select(*others, F.inline(pair))


def summarize(
    evals: DataFrame, judgements: DataFrame | None = None, complete: bool = False, pivot: str | None = None
) -> DataFrame:
    """The ``all`` rows: one per measure, plus ``num_q``.

    ``complete`` averages over all judged topics, a topic without results counting 0 (or the
    floor of the geometric mean); it needs ``judgements``. ``pivot`` names a measure that every topic
    has, whose values are then counted for ``num_q``.
    """
    totals = evals.groupBy("measure").agg(
        F.sum("value").alias("total"), F.count("*").alias("found")
    )
    if complete:
        judged = judgements.agg(F.count_distinct("qid").alias("n")).scalar()
        value = _summary_value(judged, F.col("found"))
        if "rel" in judgements.columns:
            all_rel = judgements.agg(F.count_if(F.col("rel") > 0).cast("double").alias("n")).scalar()
            value = F.when(F.col("measure") == "num_rel", all_rel).otherwise(value)
        num_q = topic_count(judgements)
    else:
        value = _summary_value(F.col("found"), F.col("found"))
        if pivot is not None:
            rows = totals.select(F.lit("all").alias("qid"), "measure", value.alias("value"), "found")
            return _with_count(rows, F.col("found"), pivot).drop("found")
        num_q = topic_count(evals)
    rows = totals.select(F.lit("all").alias("qid"), "measure", value.alias("value"))
    return rows.unionByName(num_q)


def report_rows(
    evals: DataFrame, per_topic: bool = True, summary: bool = True, pivot: str | None = None
) -> DataFrame:
    """Topic rows and ``all`` rows in one result, from one pass over the values.

    Rows with a ``text`` in place of a value have no summary. ``pivot`` asks for a ``num_q`` row.
    """
    texts = "text" in evals.columns
    topic_rows = evals.filter(~_is(GEOMETRIC_MEASURES))
    if not summary:
        return topic_rows
    if not per_topic:
        return summarize(evals)
    text = [F.max("text").alias("text")] if texts else []
    sets = evals.groupingSets(
        [[F.col("qid"), F.col("measure")], [F.col("measure")]], F.col("qid"), F.col("measure")
    ).agg(
        F.sum("value").alias("total"),
        F.count("value").alias("found"),
        F.grouping(F.col("qid")).alias("is_summary"),
        *text,
    )
    is_summary = F.col("is_summary") == 1
    kept = sets.filter(is_summary | ~_is(GEOMETRIC_MEASURES))
    if texts:
        kept = kept.filter(~is_summary | F.col("text").isNull())
    rows = kept.select(
        F.when(is_summary, "all").otherwise(F.col("qid")).alias("qid"),
        "measure",
        F.when(is_summary, _summary_value(F.col("found"), F.col("found")))
        .otherwise(F.col("total"))
        .alias("value"),
        *(["text"] if texts else []),
        "found",
        "is_summary",
    )
    if pivot is not None:
        counted = F.when(is_summary, F.lit(pivot))
        rows = _with_count(rows, F.col("found"), counted)
    return rows.drop("found", "is_summary")


# Relative difference below which values are equal but for rounding.
TOLERANCE = 1e-9


def zscore(evals: DataFrame, reference: DataFrame) -> DataFrame:
    """Replace values by their distance from the reference mean in standard deviations."""
    value, mean, sd = F.col("value"), F.col("mean"), F.col("stddev")
    equal = F.abs(value - mean) <= TOLERANCE * F.greatest(F.abs(value), F.abs(mean))
    missing = F.lit(MISSING_ZSCORE)
    joined = evals.join(reference, ["qid", "measure"], "left")
    texts = ["text"] if "text" in evals.columns else []
    return joined.select(
        "qid",
        "measure",
        *texts,
        F.when(value.isNull(), F.lit(None).cast("double"))
        .when(mean.isNull() | sd.isNull(), missing)
        .when(sd != 0, (value - mean) / sd)
        .when(equal, F.lit(0.0))
        .otherwise(missing)
        .alias("value"),
    )


def zscore_reference(evals: DataFrame) -> DataFrame:
    """Mean and standard deviation per topic and measure over the values of many runs.

    Values that differ by rounding only have no spread.
    """
    low, high = F.min("value"), F.max("value")
    spread = high - low > TOLERANCE * F.greatest(F.abs(low), F.abs(high))
    return evals.groupBy("qid", "measure").agg(
        F.avg("value").alias("mean"),
        F.when(spread, F.stddev("value")).otherwise(F.lit(0.0)).alias("stddev"),
    )
