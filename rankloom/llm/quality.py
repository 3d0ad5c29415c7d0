"""Quality rules: counts of each text, and a hashed n-gram log-likelihood ratio.

Two multinomials over hashed byte n-grams are counted: one over all documents, one over those
labelled as trusted. A document's score is the mean log ratio of the two over its n-grams, and
documents below a fixed threshold are rejected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.llm.common import bounded_batches, kept_columns, mixed, text_slices

#: Bytes in an n-gram, and bits of its hash: the tables hold 2**BITS numbers at any input size.
NGRAM = 4
BITS = 16
#: Bytes of text that a task looks at together; its arrays take some hundred times as much.
SLICE_BYTES = 1 << 20
#: Added to both counts of a bucket, the raw one scaled to as many n-grams as the trusted one.
SMOOTHING = 4.0
#: Mean log ratio per n-gram below which a document is rejected.
THRESHOLD = -0.3
#: Labelled documents, at most, from which the trusted multinomial is counted. Ids with the smallest
#: hashes are taken; the raw multinomial and the verdicts cover all documents.
TRUSTED_DOCUMENTS = 200_000

# The symbols counted, the white space between words, and the base rule's limits.
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"
WINDOW = 5
LEAST_WORDS = 10
REPEAT_PERCENT = 20

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MADE = (*COUNTS, "base_failed", "n_ngrams", "score", "kept")


def ngram_buckets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash buckets of the n-grams of all texts, one text after the other, and how many each has."""
    data = np.frombuffer(b"".join(texts), np.uint8).astype(np.uint64)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    counts = np.maximum(sizes - NGRAM + 1, 0)
    if not counts.sum():
        return np.zeros(0, np.int64), counts
    packed = np.zeros(len(data) - NGRAM + 1, np.uint64)
    for k in range(NGRAM):
        packed = (packed << np.uint64(8)) | data[k : k + len(packed)]
    inside = np.zeros(len(data) + 1, np.int64)  # starts whose n-gram stays in its text
    first = np.cumsum(sizes) - sizes
    np.add.at(inside, first, 1)
    np.add.at(inside, first + counts, -1)
    chosen = packed[np.cumsum(inside)[: len(packed)] > 0]
    return (mixed(chosen) >> np.uint64(64 - BITS)).astype(np.int64), counts


def repeated_words(words: list[list[bytes]]) -> np.ndarray:
    """Per text, the words inside windows of WINDOW words that occur twice or more in it."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    total = int(sizes.sum())
    found = np.zeros(len(words), np.int64)
    if total < WINDOW:
        return found
    hashes = np.fromiter((xxhash.xxh64_intdigest(w) for text in words for w in text), np.uint64, total)
    owner = np.repeat(np.arange(len(words)), sizes)
    starts = np.flatnonzero(owner[: total - WINDOW + 1] == owner[WINDOW - 1 :])
    if not len(starts):
        return found
    window = mixed(owner[starts].astype(np.uint64) + np.uint64(1))
    for k in range(WINDOW):
        window = mixed(window ^ hashes[starts + k])
    order = np.argsort(window, kind="stable")
    same = window[order][1:] == window[order][:-1]
    twice = np.zeros(len(starts), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(total + 1, np.int64)
    np.add.at(edge, starts[twice], 1)
    np.add.at(edge, starts[twice] + WINDOW, -1)
    return np.bincount(owner[np.cumsum(edge)[:total] > 0], minlength=len(words)).astype(np.int64)


def repeated_lines(text: str) -> int:
    seen: set[str] = set()
    found = 0
    for line in text.split("\n"):
        if line.strip(SPACES):
            found += line in seen
            seen.add(line)
    return found


def trusted_ids(labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """Ids labelled good and not toxic in every row that names them, about TRUSTED_DOCUMENTS at most."""
    good = (
        labels.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.min((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).alias("_trusted"))
        .filter("_trusted")
    )
    share = TRUSTED_DOCUMENTS / max(1, good.count())
    if share >= 1:
        return good
    return good.filter(F.xxhash64(key) < F.lit(int(share * 2.0**64 - 2.0**63)))


def ratio_table(docs: DataFrame, trusted: DataFrame, key: str = "doc_id", text: str = "text") -> np.ndarray:
    """Log ratio of every bucket, from the n-grams of all documents and of the trusted ones.

    ``trusted`` is bounded by ``trusted_ids`` and sent to all tasks, so texts stay where they are. Each
    task adds its documents up before the shuffle; the driver gets 2**BITS sums.
    """
    source = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).join(
        F.broadcast(trusted.select(F.col(key).alias("_key"), "_trusted")), "_key", "left"
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, good = np.zeros(1 << BITS, np.int64), np.zeros(1 << BITS, np.int64)
        for part, texts in text_slices(batches, "_text", SLICE_BYTES):
            buckets, counts = ngram_buckets([t.encode() for t in texts])
            ok = np.array([bool(x) for x in part.column(part.schema.get_field_index("_trusted")).to_pylist()])
            raw += np.bincount(buckets, minlength=1 << BITS)
            good += np.bincount(buckets[np.repeat(ok, counts)], minlength=1 << BITS)
        at = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at.astype(np.int32)), pa.array(raw[at]), pa.array(good[at])], names=["bucket", "raw", "good"]
        )

    rows = (
        bounded_batches(source.select("_text", "_trusted"))
        .mapInArrow(count, "bucket int, raw bigint, good bigint")
        .groupBy("bucket")
        .agg(F.sum("raw").alias("raw"), F.sum("good").alias("good"))
        .collect()
    )
    raw, good = np.zeros(1 << BITS), np.zeros(1 << BITS)
    for r in rows:
        raw[r.bucket], good[r.bucket] = r.raw, r.good
    if not good.sum():
        return np.zeros(1 << BITS)
    expected = raw * (good.sum() / raw.sum())
    return np.log((good + SMOOTHING) / (expected + SMOOTHING))


def quality_rules(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """All rows and columns of ``docs`` with the counts, ``base_failed``, ``score`` and ``kept``.

    A document is kept if it passes the base rule (10 words at least, at most a fifth of them in
    repeated windows) and its score is not below ``threshold``. A null text has no words and fails
    the base rule; a text without n-grams scores 0; without trusted documents every score is 0.
    Equal texts get equal verdicts. Columns of ``docs`` named like a new one are replaced.
    """
    ratios = docs.sparkSession.sparkContext.broadcast(ratio_table(docs, trusted_ids(labels, key), key, text))
    keep = kept_columns(docs, MADE)
    source = docs.select(*keep)
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in source.schema)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ratios.value
        for part, texts in text_slices(batches, text, SLICE_BYTES):
            data = [t.encode() for t in texts]
            words = [d.split() for d in data]  # bytes are split at the six ASCII spaces only
            n_words = np.fromiter(map(len, words), np.int64, len(words))
            chars = np.array([len(t) - sum(map(t.count, SPACES)) for t in texts], np.int64)
            symbols = np.array([sum(map(t.count, SYMBOLS)) for t in texts], np.int64)
            lines = np.array([repeated_lines(t) for t in texts], np.int64)
            repeats = repeated_words(words)
            buckets, counts = ngram_buckets(data)
            sums = np.bincount(np.repeat(np.arange(len(texts)), counts), table[buckets], len(texts))
            score = sums / np.maximum(counts, 1)
            failed = (n_words < LEAST_WORDS) | (100 * repeats > REPEAT_PERCENT * n_words)
            made = [n_words, chars, symbols, lines, repeats, failed, counts, score, ~failed & (score >= threshold)]
            yield pa.RecordBatch.from_arrays([*part.columns, *map(pa.array, made)], names=[*keep, *MADE])

    types = ", ".join(
        [f"{c} bigint" for c in COUNTS] + ["base_failed boolean, n_ngrams bigint, score double, kept boolean"]
    )
    return bounded_batches(source).mapInArrow(judge, schema + types)
