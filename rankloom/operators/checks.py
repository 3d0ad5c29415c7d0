"""Input checks. Each returns the offending rows; ``require_none`` turns them into an error."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class InputError(ValueError):
    """The input breaks a rule of its format."""


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key combinations that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def require_none(found: DataFrame, what: str) -> None:
    """Fail with one example when ``found`` has rows."""
    example = found.limit(1).collect()
    if example:
        raise InputError(f"{what}: {example[0].asDict()}")


def once(df: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    """``df`` grouped by ``keys``; a row whose keys occur again is an error, whatever is read of it.

    The error hangs on a filter, which no plan leaves out, unlike a column that nobody asks for. A
    join on the same keys that follows needs no further shuffle, so the check costs no pass.
    """
    others = [c for c in df.columns if c not in keys]
    counted = df.groupBy(*keys).agg(F.count("*").alias("_n"), *[F.first(c).alias(c) for c in others])
    message = F.concat(F.lit(f"duplicate {what}: "), F.concat_ws(" ", *[F.col(k).cast("string") for k in keys]))
    alone = F.when(F.col("_n") > 1, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return counted.filter(alone).select(*keys, *others)


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` itself, after making sure that ``keys`` identify a row."""
    require_none(duplicates(df, keys), f"duplicate {', '.join(keys)}")
    return df


def preference_conflicts(prefs: DataFrame) -> DataFrame:
    """Documents judged inconsistently, with the broken rule.

    ``two levels``: several levels in one sub-group. ``zero and non-zero``: both a zero and
    a positive level within one judgement group.
    """
    two_levels = (
        prefs.groupBy("qid", "jg", "jsg", "docno")
        .agg(F.min("rel_level").alias("lo"), F.max("rel_level").alias("hi"))
        .filter("lo < hi")
        .select("qid", "jg", "docno", F.lit("two levels").alias("rule"))
    )
    mixed = (
        prefs.groupBy("qid", "jg", "docno")
        .agg(
            F.max(F.col("rel_level") == 0).alias("has_zero"),
            F.max(F.col("rel_level") > 0).alias("has_positive"),
        )
        .filter("has_zero AND has_positive")
        .select("qid", "jg", "docno", F.lit("zero and non-zero").alias("rule"))
    )
    return two_levels.distinct().unionByName(mixed)
