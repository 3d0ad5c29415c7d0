"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.session import new_folder

#: Bytes of text that a Python task works on at once; also asked of Spark's Arrow batches.
SLICE_BYTES = 8 << 20
ARROW_BYTES_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def bounded_batches(df: DataFrame, limit: int = SLICE_BYTES) -> DataFrame:
    """Ask for Arrow batches of bounded bytes, so that many long texts don't meet in one batch.

    A task holds a few copies of a batch outside of the heap, and its Python worker some more.
    """
    spark = df.sparkSession
    current = spark.conf.get(ARROW_BYTES_CONF, None)
    if current is not None and not 0 < int(str(current).rstrip("bB")) <= limit:
        spark.conf.set(ARROW_BYTES_CONF, str(limit))
    return df


def text_slices(
    batches: Iterable[pa.RecordBatch], column: str, limit: int = SLICE_BYTES
) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Arrow batches cut so that each holds about ``limit`` bytes of text (one row at least).

    Null texts become empty ones.
    """
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column))
        ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
        start = 0
        while start < len(ends):
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            part = batch.slice(start, stop - start)
            yield part, [t or "" for t in texts.slice(start, stop - start).to_pylist()]
            start = stop


def kept_columns(df: DataFrame, made: Iterable[str]) -> list[str]:
    """Columns of ``df`` that an operator passes on; those it makes anew give way, in any case."""
    lower = {c.lower() for c in made}
    return [c for c in df.columns if c.lower() not in lower]


def set_aside(columns: Iterable[str]) -> tuple[list[str], list[Column], list[Column]]:
    """Place names for columns that an operator only passes on, whatever they are called: the names,
    the columns under them, and the way back."""
    columns = list(columns)
    places = [f"_c{i}" for i in range(len(columns))]
    there = [F.col(f"`{c}`").alias(p) for c, p in zip(columns, places, strict=True)]
    return places, there, [F.col(p).alias(c) for c, p in zip(columns, places, strict=True)]


def ranges(lengths: np.ndarray) -> np.ndarray:
    """0..n-1 for each n of ``lengths``, one after the other."""
    total = int(lengths.sum())
    return np.arange(total) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads their bits (the splitmix finaliser)."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to a new folder of the shared place and read it from there."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in ``links`` (a, b): the smallest id reachable from it.

    In a round a label travels along links; the smallest one that any member of a tree sees goes to the
    tree's root as well, so whole trees move; then labels jump to their label's label. Rounds
    grow with the logarithm of the longest chain (20 for a million links in a row), without a limit.
    What is joined is written first, so that both sides of a join are shuffled for it and a hub's
    rows can be split over tasks; the groupings add up inside tasks before they shuffle. Files, unlike
    checkpoints, start with fresh size estimates: those of joined checkpoints multiply each round.
    """
    pairs = links.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).filter("a <> b")
    edges = stored(pairs.union(pairs.select("b", "a")).distinct(), "links")
    labels = stored(edges.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.col("id")).alias("c")), "links")
    while True:
        near = edges.join(labels, F.col("b") == F.col("id")).groupBy("a").agg(F.min("c").alias("m"))
        step = stored(
            labels.join(near, F.col("id") == F.col("a")).select("id", "c", F.least("c", "m").alias("c0")),
            "links",
        )
        hooks = step.filter("c0 < c").groupBy(F.col("c").alias("root")).agg(F.min("c0").alias("h"))
        hooked = stored(
            step.join(hooks, F.col("id") == F.col("root"), "left").select(
                "id", "c", F.least("c0", F.coalesce("h", "c0")).alias("c1")
            ),
            "links",
        )
        jump = hooked.select(F.col("id").alias("r"), F.col("c1").alias("c2"))
        new = stored(
            hooked.join(jump, F.col("c1") == F.col("r")).select(
                "id", F.least("c1", "c2").alias("n"), (F.least("c1", "c2") < F.col("c")).alias("moved")
            ),
            "links",
        )
        labels = new.select("id", F.col("n").alias("c"))
        if not new.filter("moved").agg(F.count(F.lit(1))).first()[0]:
            return labels.select("id", F.col("c").alias("component"))
