"""Packing token sequences: vector best-fit of pieces into bins under three capacities."""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.llm.common import bounded_batches, kept_columns, ranges, text_slices
from rankloom.session import durable

#: Tokens of a group of pieces that one task packs; one bin of a group may stay part empty.
GROUP_TOKENS = 1 << 22
#: Distinct words that a Python worker remembers, from task to task, before it starts anew.
WORDS_KEPT = 800_000
#: Stands between words that are encoded in one call.
BETWEEN = "\x1e"
WORDS_A_CALL = 500


class WordTokens(dict):
    """Ids of words cut at white space, for a tokenizer that drops white space between tokens.

    Every distinct word is encoded once by the library, many words in a call with a mark between
    them; words that hold the mark are encoded alone.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.no_truncation()
        self.model.no_padding()
        mark = self.encode([BETWEEN])[0]
        probe = ["a", "B'c", "1", "é!", "<|x|>"]
        apart = [i for x in self.encode(probe) for i in x]
        if len(mark) != 1 or any(self.encode([sep.join(probe)])[0] != apart for sep in " \n\t\f"):
            raise ValueError(f"{path}: white space between words must not matter")
        self.mark = mark[0]
        self.forget()

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def forget(self) -> None:
        self.clear()
        self.new: list[bytes] = []
        self.ids, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def __missing__(self, word: bytes) -> int:
        self[word] = at = len(self)
        self.new.append(word)
        return at

    def learn(self) -> None:
        """Encode the words that came up since the last call."""
        new, self.new = [w.decode() for w in self.new], []
        found, sizes = [self.ids], [self.sizes]
        for start in range(0, len(new), WORDS_A_CALL):
            part = new[start : start + WORDS_A_CALL]
            if any(BETWEEN in w for w in part):
                each = self.encode(part)
                found.append(np.array([i for x in each for i in x], np.int64))
                sizes.append(np.array([len(x) for x in each], np.int64))
                continue
            ids = np.array(self.encode([f" {BETWEEN} ".join(part)])[0], np.int64)
            ends = np.r_[np.flatnonzero(ids == self.mark), len(ids)]
            found.append(ids[ids != self.mark])
            sizes.append(np.diff(np.r_[-1, ends]) - 1)
        self.ids, self.sizes = np.concatenate(found), np.concatenate(sizes)

    def tokens(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and how many each has."""
        if len(self) > WORDS_KEPT:
            self.forget()
        numbers, counts = [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            words = text.encode().split()
            counts[i] = len(words)
            numbers.append(np.fromiter(map(self.__getitem__, words), np.int64, len(words)))
        if self.new:
            self.learn()
        which = np.concatenate(numbers) if numbers else np.zeros(0, np.int64)
        sizes = self.sizes[which]
        ids = self.ids[np.repeat((np.cumsum(self.sizes) - self.sizes)[which], sizes) + ranges(sizes)]
        ends = np.r_[0, np.cumsum(sizes)][np.cumsum(counts)]
        return ids, np.diff(np.r_[0, ends])


@lru_cache(maxsize=1)
def word_tokens(path: str) -> WordTokens:
    return WordTokens(path)


def token_pieces(
    df: DataFrame, path: str, capacity: int = 4096, end_id: int = 1, key: str = "doc_id", text: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """The token pieces of every document: key, piece, start, length, ids_crc32 (and ids).

    A document is its ids and ``end_id``; only longer ones than ``capacity`` are cut, into pieces of
    that size and a rest. A null or empty text is the end id alone. ids_crc32 is of the ids as
    little-endian unsigned 32-bit numbers. Repeated rows give pieces of their own.
    """
    source = df.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    names = ["_key", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_tokens(path)
        for part, texts in text_slices(batches, "_text", 4 << 20):
            ids, counts = words.tokens(texts)
            full = counts + 1  # with the end id
            ends = np.cumsum(full)
            flat = np.empty(int(full.sum()), "<u4")
            last = np.zeros(len(flat), bool)
            last[ends - 1] = True
            flat[last], flat[~last] = end_id, ids
            pieces = -(-full // capacity)
            owner, number = np.repeat(np.arange(len(texts)), pieces), ranges(pieces)
            start = number * capacity
            length = np.minimum(full[owner] - start, capacity)
            at = (ends - full)[owner] + start
            crc = [zlib.crc32(flat[a : a + n].tobytes()) for a, n in zip(at.tolist(), length.tolist(), strict=True)]
            out = [
                part.column(0).take(pa.array(owner)),
                pa.array(number.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc, pa.int64()),
            ]
            if with_ids:  # the pieces of a text follow each other in flat
                offsets = pa.array(np.r_[at, len(flat)].astype(np.int32))
                out.append(pa.ListArray.from_arrays(offsets, pa.array(flat.astype(np.int32))))
            yield pa.RecordBatch.from_arrays(out, names=names)

    kind = source.schema["_key"].dataType.simpleString()
    schema = f"_key {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"
    return (
        bounded_batches(source)
        .mapInArrow(run, schema + ", ids array<int>" * with_ids)
        .withColumnRenamed("_key", key)
    )


def best_fit(
    length: np.ndarray, cost: np.ndarray, capacity: tuple[int, int, int], weights: tuple[float, float, float],
    rule: str = "norm",
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin, offset and order of placing of each piece.

    Pieces come by falling length. Of the open bins in which a piece's tokens, one more document
    and its cost fit, it goes to the one whose residual capacities, as weighted shares, are left
    with the smallest norm (``norm``) or have the largest dot product with the piece (``dot``);
    the oldest of equals. If none fits, a new bin opens.
    """
    total = np.array(capacity, float)
    w = np.array(weights, float)
    bins, offsets = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
    left = np.zeros((3, len(length)))  # residual capacities of the bins
    number = np.zeros(len(length), np.int64)
    n_open = opened = 0
    least = length.min() if len(length) else 0
    order = np.argsort(-length, kind="stable")
    for placed, i in enumerate(order):
        need = np.array([length[i], 1.0, cost[i]])
        room = left[:, :n_open]
        fits = np.flatnonzero((room >= need[:, None]).all(axis=0))
        if len(fits):
            if rule == "norm":
                score = -((w / total**2) @ (room[:, fits] - need[:, None]) ** 2)
            else:
                score = (w * need / total**2) @ room[:, fits]
            b = fits[np.argmax(score)]
        else:
            b = n_open
            left[:, b], number[b] = total, opened
            n_open, opened = n_open + 1, opened + 1
        bins[i], offsets[i] = number[b], capacity[0] - int(left[0, b])
        left[:, b] -= need
        if placed % 256 == 255:  # bins that nothing fits any more close
            stay = np.flatnonzero((left[0, :n_open] >= least) & (left[1, :n_open] >= 1))
            left[:, : len(stay)], number[: len(stay)] = left[:, stay], number[stay]
            n_open = len(stay)
    return bins, offsets, order


def pack(
    pieces: DataFrame, tokens: int = 4096, documents: int = 4096, attention: int = 4096 * 4096,
    weights: tuple[float, float, float] = (1.0, 0.001, 0.001), rule: str = "norm",
) -> DataFrame:
    """All rows and columns of ``pieces`` (with ``length``) with ``sequence_id`` and ``offset``.

    A sequence holds at most ``tokens`` tokens, ``documents`` pieces and ``attention`` summed squares
    of lengths. Pieces are dealt at random over groups of about GROUP_TOKENS tokens, each packed
    by one task, so no group grows with the input or with a key. A piece beyond a capacity on its
    own is an error; an empty table gives an empty result; repeated rows are packed each.
    """
    keep = kept_columns(pieces, ("sequence_id", "offset", "_group"))
    pieces = durable(pieces.select(*keep))  # read twice, and dealt by place
    total = pieces.agg(F.sum("length")).first()[0] or 0
    groups = max(1, ceil(total / GROUP_TOKENS))
    deal = F.pmod(F.xxhash64(F.spark_partition_id(), F.monotonically_increasing_id()), F.lit(groups))
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in pieces.schema)
    capacity = (tokens, documents, attention)

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        # The order in which rows arrive is not fixed: sort by everything but arrays.
        by = [c for c in keep if not rows[c].map(lambda v: isinstance(v, (np.ndarray, dict, list))).any()]
        rows = rows.sort_values(["length", *(c for c in by if c != "length")], kind="stable", ignore_index=True)
        length = rows["length"].to_numpy(np.int64)
        if len(length) and (length.max() > tokens or length.max() ** 2 > attention or documents < 1):
            raise ValueError("a piece is larger than a sequence may be")
        bins, offsets, _ = best_fit(length, length.astype(float) ** 2, capacity, weights, rule)
        return rows[keep].assign(sequence_id=int(key[0]) * (1 << 32) + bins, offset=offsets)

    return (
        pieces.withColumn("_group", deal)
        .groupBy("_group")
        .applyInPandas(run, f"{schema}sequence_id bigint, offset bigint")
    )
