"""Importance resampling: documents drawn by hashed n-gram gains of a target text over the corpus."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankloom.llm.common import bounded_batches, kept_columns, stored, text_slices
from rankloom.operators.ordered import OrderedGroups

#: Lower-cases A-Z and blanks every ASCII character but digits and letters; other bytes of UTF-8 stay.
TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
#: Bytes of a text that are split into words at once.
PIECE_BYTES = 1 << 20
#: Distinct n-grams that a task counts before it adds them to the buckets.
COUNTED = 1 << 18
MADE = ("n_words", "n_features", "weight", "score", "rank")


def ngram_crcs(text: str, longest: int) -> Iterator[tuple[int, list[int]]]:
    """(n, crc32 of the n-grams of n words joined by one space), for stretches of the text.

    The checksum of a run is the seed of the run with one more word. A long text is split piece by
    piece; the last words of a piece begin the runs that cross its border.
    """
    data = text.encode("utf-8", "surrogatepass").translate(TABLE)
    start, before = 0, []
    while start < len(data):
        stop = data.find(b" ", start + PIECE_BYTES)
        stop = len(data) if stop < 0 else stop
        words = before + data[start:stop].split()
        seeds = list(map(crc32, words))
        yield 1, seeds[len(before) :]
        tails = [b" " + w for w in words]
        for n in range(2, longest + 1):
            seeds = list(map(crc32, tails[n - 1 :], seeds))
            yield n, seeds[max(0, len(before) - n + 1) :]
        start, before = stop, words[max(0, len(words) - longest + 1) :] if longest > 1 else []


def feature_counts(texts: DataFrame, text: str = "text", buckets: int = 10_000, longest: int = 2) -> DataFrame:
    """(bucket, n): how many n-grams of 1 to ``longest`` words of all texts fall into each bucket.

    Tasks count by themselves and send at most one row per bucket. Null and empty texts have none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, grams = Counter(), Counter()

        def reduce() -> None:
            for crc, n in grams.items():
                total[crc % buckets] += n
            grams.clear()

        for _, part in text_slices(batches, "_text"):
            for one in part:
                for _, crcs in ngram_crcs(one, longest):
                    grams.update(crcs)
                    if len(grams) > COUNTED:
                        reduce()
        reduce()
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()), pa.array(list(total.values()), pa.int64())], names=["bucket", "n"]
        )

    found = bounded_batches(texts.select(F.col(text).alias("_text"))).mapInArrow(run, "bucket int, n bigint")
    return found.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(corpus: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """Gain of every bucket in thousandths, from two tables (bucket, n): one number per bucket."""
    spark = corpus.sparkSession
    counts = stored(  # read twice, made by a pass over all texts
        spark.range(buckets)
        .select(F.col("id").cast("int").alias("bucket"))
        .join(corpus.withColumnRenamed("n", "s"), "bucket", "left")
        .join(target.withColumnRenamed("n", "t"), "bucket", "left")
        .fillna(0, ["s", "t"]),
        "counts",
    )
    gains = np.zeros(buckets, np.int64)
    totals = counts.agg(F.sum("s").alias("all_s"), F.sum("t").alias("all_t"))
    ratio = ((F.col("t") + 1.0) * (F.col("all_s") + float(buckets))) / (
        (F.col("s") + 1.0) * (F.col("all_t") + float(buckets))
    )
    rows = counts.crossJoin(F.broadcast(totals)).select("bucket", F.floor(F.log(ratio) * 1000.0).alias("gain"))
    for bucket, gain in rows.collect():
        gains[bucket] = gain
    return gains


def weights(docs: DataFrame, gains: np.ndarray, text: str = "text", longest: int = 2, keep_text: bool = False) -> DataFrame:
    """Rows of ``docs`` with n_words, n_features and weight, the floored mean gain of their features.

    A text without features has weight 0. ``docs`` passes its other columns on, the text on request.
    """
    keep = [c for c in kept_columns(docs, MADE) if keep_text or c.lower() != text.lower()]
    places = [f"_c{i}" for i in range(len(keep))]
    source = docs.select(*[F.col(c).alias(p) for c, p in zip(keep, places, strict=True)], F.col(text).alias("_text"))
    buckets = len(gains)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches, "_text"):
            words, features, gained = (np.zeros(len(texts), np.int64) for _ in range(3))
            for i, one in enumerate(texts):
                for n, crcs in ngram_crcs(one, longest):
                    words[i] += len(crcs) if n == 1 else 0
                    features[i] += len(crcs)
                    gained[i] += int(gains[np.array(crcs, np.int64) % buckets].sum())
            made = [words, features, np.where(features > 0, gained // np.maximum(features, 1), 0)]
            yield pa.RecordBatch.from_arrays(
                [*part.columns[: len(keep)], *map(pa.array, made)], names=[*places, *MADE[:3]]
            )

    schema = "".join(f"{p} {docs.schema[c].dataType.simpleString()}, " for c, p in zip(keep, places, strict=True))
    done = bounded_batches(source).mapInArrow(run, schema + "n_words bigint, n_features bigint, weight bigint")
    return done.select(*[F.col(p).alias(c) for c, p in zip(keep, places, strict=True)], *MADE[:3])


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 25, min_words: int = 20, buckets: int = 10_000,
    longest: int = 2, seed: int = 7, key: str = "doc_id", text: str = "text", keep_text: bool = False,
) -> DataFrame:
    """Draw ``percent`` of the documents of at least ``min_words`` words, in favour of target-like ones.

    All rows of ``docs`` come back with their other columns (the text on request) and n_words,
    n_features, weight, score and rank. A bucket's gain is the smoothed log ratio of its share of the
    n-grams of ``target`` and of ``docs``; a document's weight is its mean gain, its score adds
    Gumbel noise from a hash of seed and key, and the highest scores are drawn: 1, 2, 3... by falling
    score, ties by key, then by weight and counts; null when not drawn.

    Null or empty texts have no features, weight 0 and are never drawn (unless ``min_words`` is 0).
    A null key is hashed like an empty one and comes last among ties. Repeated rows count and are
    ranked each. Empty tables give empty results, an empty target a gain that favours rare features.
    Columns of ``docs`` named like a result give way.

    Tasks send bucket counts only; the gains (one number per bucket) go to all tasks. Scores are
    counted per value, values lie within the range of gains and noise, so their running counts are
    a small table and only documents of drawn values are put in order, value by value.
    """
    gains = bucket_gains(
        feature_counts(docs, text, buckets, longest), feature_counts(target, text, buckets, longest), buckets
    )
    h = F.conv(
        F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256), 1, 8), 16, 10
    ).cast("double")
    noise = F.floor(F.log(-F.log((h + 0.5) / 4294967296.0)) * -1000.0)
    scored = stored(
        weights(docs, gains, text, longest, keep_text).withColumn("score", F.col("weight") + noise), "scores"
    )
    able = F.col("n_words") >= min_words
    values = scored.filter(able).groupBy("score").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    values = stored(values.select("score", "_n", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")), "values")
    drawn = (values.agg(F.sum("_n")).first()[0] or 0) * percent // 100
    top = F.broadcast(values.filter(F.col("_before") < drawn).select("score", "_before"))
    placed = scored.withColumn("_able", able).join(top, "score", "left")
    within = F.col("_able") & F.col("_before").isNotNull()
    order = [F.col(key).asc_nulls_last(), F.col("weight"), F.col("n_features"), F.col("n_words")]
    chosen = OrderedGroups(placed.filter(within), ["score"], order).number("_place").df
    rank = F.col("_before") + F.col("_place")
    chosen = chosen.withColumn("rank", F.when(rank <= drawn, rank))
    columns = scored.columns
    others = placed.filter(~F.coalesce(within, F.lit(False))).withColumn("rank", F.lit(None).cast("long"))
    return chosen.select(*columns, "rank").unionByName(others.select(*columns, "rank"))
