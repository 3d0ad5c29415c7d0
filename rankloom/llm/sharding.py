"""Sharding by extendible hashing, with Spark expressions only.

A directory is indexed by the first bits of a row's hash. A bucket that is too large is split on
one more bit until each fits its byte limit; small buckets keep fewer bits.
"""

from __future__ import annotations

from functools import reduce
from math import ceil, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rankloom.llm.common import kept_columns, set_aside
from rankloom.session import durable

#: Bits of a hash.
HASH_BITS = 60
#: Bits beyond those that even buckets would need, by which cells are counted in one round.
SPARE_BITS = 3
MADE = ("n_bytes", "depth", "shard", "shard_bytes", "shard_rows")


def hash_bits(key: Column) -> Column:
    """The first 60 bits of the MD5 digest of a key as text; a null key is an empty text."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def _split(sized: DataFrame, known: int, bits: int, limit: int) -> tuple[DataFrame, DataFrame]:
    """Cells of ``known + bits`` hash bits as (cell, depth, prefix, bytes, rows), and those still too large.

    ``sized`` has the hash and bytes of rows whose bucket of ``known`` bits is too large (or of all
    rows, with 0 bits known). Rows are added up by cell first; then a cell counts in the bucket of
    every shorter prefix. A bucket that fits while its parent doesn't is a shard.
    """
    to = known + bits
    cells = durable(
        sized.groupBy(F.shiftright("_hash", HASH_BITS - to).alias("cell")).agg(
            F.sum("_bytes").alias("bytes"), F.count(F.lit(1)).alias("rows"),
            F.min("_hash").alias("low"), F.max("_hash").alias("high"),
        )
    )
    within = cells.select(
        "*", F.explode(F.sequence(F.lit(known + (known > 0)), F.lit(to))).alias("depth")
    ).withColumn("prefix", F.expr(f"shiftright(cell, {to} - depth)"))
    buckets = within.groupBy("depth", "prefix").agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"))
    large = buckets.filter(F.col("bytes") > limit).select(
        (F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent")
    )
    first = F.col("depth") == (known + 1 if known else 0)
    leaves = (
        buckets.filter(F.col("bytes") <= limit)
        .withColumn("parent", F.shiftright("prefix", 1))
        .join(large.withColumn("_split", F.lit(True)), ["depth", "parent"], "left")
        .filter(first | F.col("_split"))
        .select("depth", "prefix", "bytes", "rows")
    )
    placed = within.select("cell", "depth", "prefix").join(leaves, ["depth", "prefix"])
    return placed, cells.filter(F.col("bytes") > limit)


def shard(df: DataFrame, key: str = "doc_id", text: str = "text", limit: int = 256 << 20) -> DataFrame:
    """All rows and columns of ``df`` with n_bytes, depth, shard, shard_bytes and shard_rows.

    ``shard`` is the hash prefix in binary digits (empty if all fits in one), ``shard_bytes`` and
    ``shard_rows`` are its size. A shard exceeds ``limit`` only if it is a single row. Rows with
    equal keys have equal hashes: where they alone exceed the limit, they are dealt over pages
    (``prefix.page``, ``prefix.Lpage`` for one row above half the limit) by running totals of bytes. A null text has 0 bytes, null keys hash alike,
    an empty table gives an empty result, columns named like a new one are replaced.
    """
    keep, there, back = set_aside(kept_columns(df, MADE))
    sized = df.select(
        *there, hash_bits(F.col(key)).alias("_hash"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("_bytes"),
    )
    thin = sized.select("_hash", "_bytes")
    total = thin.agg(F.sum("_bytes")).first()[0] or 0
    parts: list[DataFrame] = []
    known, rest = 0, sized
    bits = max(1, ceil(log2(max(1, total / limit)))) + SPARE_BITS
    while True:
        bits = min(bits, HASH_BITS - known)
        placed, over = _split(rest.select("_hash", "_bytes"), known, bits, limit)
        known += bits
        cell = F.shiftright("_hash", HASH_BITS - known)
        parts.append(
            rest.withColumn("cell", cell)
            .join(placed, "cell")
            .withColumn("shard", F.lpad(F.conv("prefix", 10, 2), F.col("depth"), F.lit("0")))
            .select(*keep, F.col("_bytes").alias("n_bytes"), "depth", "shard",
                    F.col("bytes").alias("shard_bytes"), F.col("rows").alias("shard_rows"))
        )
        over = durable(over.select("cell", (F.col("low") == F.col("high")).alias("_same")))
        kinds = {r["_same"] for r in over.select("_same").distinct().collect()}
        if not kinds:
            break
        beyond = rest.withColumn("cell", cell).join(over, "cell").drop("cell")
        if True in kinds:
            parts.append(_pages(beyond.filter("_same").drop("_same"), keep, known, limit))
        if False not in kinds:
            break
        rest = beyond.filter("NOT _same").drop("_same")
    return reduce(DataFrame.unionByName, parts).select(*back, *MADE)


def _pages(rows: DataFrame, keep: list[str], known: int, limit: int) -> DataFrame:
    """Rows of too large buckets of equal hashes, dealt over pages that fit.

    Totals run over the pieces in which the rows lie, then inside each piece, so no task needs
    all rows of a hash. A page takes the rows that start in its stretch, which is shorter than the
    limit by the longest row. Rows above half the limit have pages of their own, so a stretch is
    half the limit at least.
    """
    rows = rows.withColumn("_large", F.col("_bytes") > limit // 2)
    rows = durable(rows.withColumn("_piece", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()))
    pieces = rows.groupBy("_hash", "_large", "_piece").agg(F.sum("_bytes").alias("_sum"), F.max("_bytes").alias("_most"))
    by_hash = W.partitionBy("_hash", "_large")
    before = by_hash.orderBy("_piece").rowsBetween(W.unboundedPreceding, -1)
    offsets = pieces.select(
        "_hash", "_large", "_piece", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"),
        F.max("_most").over(by_hash).alias("_longest"),
    )
    inside = W.partitionBy("_hash", "_large", "_piece").orderBy("_at").rowsBetween(W.unboundedPreceding, -1)
    start = F.col("_before") + F.coalesce(F.sum("_bytes").over(inside), F.lit(0))
    stretch = F.greatest(F.lit(limit) - F.col("_longest") + 1, F.lit(1))
    paged = durable(
        rows.join(offsets, ["_hash", "_large", "_piece"]).withColumn("_page", F.floor(start / stretch).cast("long"))
    )
    sizes = paged.groupBy("_hash", "_large", "_page").agg(
        F.sum("_bytes").alias("shard_bytes"), F.count(F.lit(1)).alias("shard_rows")
    )
    bits = F.lpad(F.conv(F.shiftright("_hash", HASH_BITS - known), 10, 2), known, "0")
    kind = F.when(F.col("_large"), ".L").otherwise(".")
    return paged.join(sizes, ["_hash", "_large", "_page"]).select(
        *keep, F.col("_bytes").alias("n_bytes"), F.lit(known).alias("depth"),
        F.concat(bits, kind, "_page").alias("shard"), "shard_bytes", "shard_rows",
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """Write each shard to a folder of its own, its rows by one task of bounded size."""
    sharded.repartition("shard").write.partitionBy("shard").parquet(path)
