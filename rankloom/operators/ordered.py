"""Numbering and running totals inside ordered groups of any size.

A plain window puts one group into one task. That is the right plan while every
group fits a task, but a single topic may hold a large part of all rows. Groups are
therefore counted first (one small aggregate, combined map-side). When the largest
one exceeds the limit, rows are range-partitioned by (group, order) so the large
group spreads over many partitions, each piece is numbered on its own, and the totals
of the pieces before it are added from a table with one row per piece.
"""

from __future__ import annotations

from collections.abc import Sequence
from copy import copy
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import durable, setting

GROUP_ROWS_CONF = "rankloom.groupRows"
GROUP_ROWS = 2_000_000

# The planner's own setting: row-number filters above it are not applied before the shuffle.
GROUP_LIMIT_CONF, GROUP_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold", 1000

_PIECE = "_piece"


class GroupSize(NamedTuple):
    largest: int
    total: int


def group_size(df: DataFrame, keys: Sequence[str]) -> GroupSize:
    """Rows in the largest group and in all groups; one aggregate combined map-side."""
    sizes = df.groupBy(*keys).agg(F.count("*").alias("n"))
    largest, total = sizes.agg(F.max("n"), F.sum("n")).first()
    return GroupSize(largest or 0, total or 0)


def known_size(df: DataFrame, keys: Sequence[str], size: int | GroupSize | None) -> GroupSize:
    """``size`` if counted before, else the counted sizes; a plain number is a bound that is checked."""
    if isinstance(size, GroupSize):
        return size
    counted = group_size(df, keys)
    if size is not None and counted.largest > size:
        raise ValueError(f"a group has {counted.largest} rows, more than the bound of {size}")
    return counted


def fits(df: DataFrame, size: GroupSize) -> bool:
    """Whether the largest group may lie in one task."""
    return size.largest <= setting(df.sparkSession, GROUP_ROWS_CONF, GROUP_ROWS)


def first_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int | None, name: str = "rank"
) -> DataFrame:
    """The first ``k`` rows of each group (all rows for None) with their position.

    Up to the planner's limit a row-number filter is applied before the shuffle, so a task sends
    ``k`` rows per group at most. Beyond it groups are numbered by pieces, whatever their size.
    """
    limit = setting(df.sparkSession, GROUP_LIMIT_CONF, GROUP_LIMIT)
    if k is not None and k <= limit:
        w = Window.partitionBy(*keys).orderBy(*order)
        ranked = df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= k)
        return ranked.withColumn(name, F.col(name).cast("long"))
    ranked = OrderedGroups(df, keys, order).number(name).df
    return ranked if k is None else ranked.filter(F.col(name) <= k)


class OrderedGroups:
    """Rows of ``df`` grouped by ``keys`` and totally ordered by ``order``.

    ``size`` holds sizes counted before and saves the count; a plain number is a bound of rows
    per group that is checked. Methods give new objects that share the partitioning.
    """

    def __init__(
        self,
        df: DataFrame,
        keys: Sequence[str],
        order: Sequence[Column],
        size: int | GroupSize | None = None,
    ) -> None:
        self.keys = list(keys)
        self.order = list(order)
        spark = df.sparkSession
        limit = setting(spark, GROUP_ROWS_CONF, GROUP_ROWS)
        size = known_size(df, self.keys, size)
        self.split = not fits(df, size)
        if self.split:
            partitions = setting(spark, "spark.sql.shuffle.partitions", 200)
            pieces = max(partitions, 2 * size.total // limit)
            df = durable(
                df.repartitionByRange(pieces, *[F.col(k) for k in self.keys], *self.order)
                .withColumn(_PIECE, F.spark_partition_id())
            )
        self._parts = ([_PIECE] if self.split else []) + self.keys
        self._df = df

    @property
    def df(self) -> DataFrame:
        return self._df.drop(_PIECE) if self.split else self._df

    def _of(self, df: DataFrame) -> OrderedGroups:
        other = copy(self)
        other._df = df
        return other

    def with_columns(self, columns: dict[str, Column]) -> OrderedGroups:
        """Add row-wise columns; grouping and order stay as they are."""
        return self._of(self._df.withColumns(columns))

    def join(self, other: DataFrame, on: Sequence[str], how: str = "inner") -> OrderedGroups:
        """Join a table with at most one row per key of ``on``."""
        return self._of(self._df.join(other, list(on), how))

    def number(self, name: str) -> OrderedGroups:
        """1-based position in the group, as a long."""
        if self.split:
            return self.running({name: F.lit(1)})
        w = Window.partitionBy(*self.keys).orderBy(*self.order)
        return self._of(self._df.withColumn(name, F.row_number().over(w).cast("long")))

    def running(self, columns: dict[str, Column]) -> OrderedGroups:
        """Running sums in order, the row itself included."""
        return self._scan(columns, F.sum, lambda here, before: here + before, 0)

    def running_max(self, columns: dict[str, Column]) -> OrderedGroups:
        """Running maxima in order, the row itself included."""
        return self._scan(columns, F.max, F.greatest, None)

    def _scan(self, columns, function, combine, neutral) -> OrderedGroups:
        w = (
            Window.partitionBy(*self._parts)
            .orderBy(*self.order)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        here = self._df.withColumns({n: function(c).over(w) for n, c in columns.items()})
        if not self.split:
            return self._of(here)
        totals = self._df.groupBy(*self._parts).agg(
            *[function(c).alias(f"_{n}_total") for n, c in columns.items()]
        )
        earlier = (
            Window.partitionBy(*self.keys)
            .orderBy(_PIECE)
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        before = totals.select(
            *self._parts,
            *[
                F.coalesce(function(f"_{n}_total").over(earlier), F.lit(neutral)).alias(f"_{n}_before")
                if neutral is not None
                else function(f"_{n}_total").over(earlier).alias(f"_{n}_before")
                for n in columns
            ],
        )
        joined = here.join(before, self._parts)
        return self._of(
            joined.withColumns({n: combine(F.col(n), F.col(f"_{n}_before")) for n in columns}).drop(
                *[f"_{n}_before" for n in columns]
            )
        )
