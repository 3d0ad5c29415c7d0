"""Binary files of token ids, and a minimal perfect hash index from document keys to their places."""

from __future__ import annotations

import json
import posixpath
import re
import uuid
import zlib
from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.llm.common import bounded_batches, mixed, stored, text_slices
from rankloom.llm.packing import word_tokens

#: Text bytes and rows of a shard, about; one task writes a shard and one task reads it.
SHARD_TEXT, SHARD_ROWS = 64 << 20, 1 << 20
#: Keys of an index file, about.
INDEX_KEYS = 1 << 20
#: Bytes that a reader takes at once.
READ_BYTES = 8 << 20
MANIFEST = "manifest.json"
MAGIC, VERSION = b"TIDX", 1
LEVELS = 64
_FIELDS = {"fingerprint": "<u4", "shard": "<u4", "start": "<u8", "length": "<u8", "copies": "<u4"}


def file_system(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder that drivers and tasks share, and its path there."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "/", folder))


class PerfectHash:
    """Numbers n distinct keys, given as two 64-bit hashes each, from 0 to n - 1 without storing them.

    A level marks the places that exactly one of its keys hashes to; the others go on to the next,
    smaller level. A key's number is the rank of its mark among all marks.
    """

    def __init__(self, sizes: np.ndarray, words: np.ndarray) -> None:
        self.sizes, self.words = sizes, words
        self.bases = np.cumsum(sizes) - sizes
        marked = np.bitwise_count(words).astype(np.int64)
        self.before = np.cumsum(marked) - marked

    @staticmethod
    def places(one: np.ndarray, two: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mixed(one ^ mixed(two + np.uint64(level))) % np.uint64(size)).astype(np.int64)

    @classmethod
    def of(cls, one: np.ndarray, two: np.ndarray) -> PerfectHash:
        sizes, words = [], []
        while len(one):
            if len(sizes) == LEVELS:
                raise ValueError("keys repeat, or their hashes do")
            size = -(-2 * len(one) // 64) * 64
            at = cls.places(one, two, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            words.append(np.packbits(alone, bitorder="little").view("<u8"))
            rest = ~alone[at]
            one, two = one[rest], two[rest]
        return cls(np.array(sizes, np.int64), np.concatenate(words) if words else np.zeros(0, "<u8"))

    def numbers(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """The number of each key; a key that is not one of the n has any number, or -1."""
        found = np.full(len(one), -1, np.int64)
        open_ = np.arange(len(one))
        for level, (size, base) in enumerate(zip(self.sizes.tolist(), self.bases.tolist(), strict=True)):
            at = base + self.places(one[open_], two[open_], level, size)
            word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)
            found[open_[hit]] = (self.before[at >> 6] + below)[hit]
            open_ = open_[~hit]
            if not len(open_):
                break
        return found


def fingerprints(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    return (mixed(two ^ (one << np.uint64(1))) >> np.uint64(32)).astype("<u4")


def index_bytes(one: np.ndarray, two: np.ndarray, fields: dict[str, np.ndarray]) -> bytes:
    """An index file: levels, marks, and the fields of every key in the order of their numbers."""
    hashed = PerfectHash.of(one, two)
    fields = {"fingerprint": fingerprints(one, two), **fields}
    order = np.argsort(hashed.numbers(one, two))
    parts = [MAGIC, np.array([VERSION, len(hashed.sizes)], "<u4").tobytes(), np.array([len(one)], "<u8").tobytes()]
    parts += [hashed.sizes.astype("<u8").tobytes(), hashed.words.tobytes()]
    parts += [np.asarray(fields[name])[order].astype(kind).tobytes() for name, kind in _FIELDS.items()]
    return b"".join(parts)


def index_lookup(data: bytes, one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Which keys an index file holds (an absent key passes once in 2^32), and their fields."""
    if data[:4] != MAGIC or int(np.frombuffer(data, "<u4", 1, 4)[0]) != VERSION:
        raise ValueError("not an index file of this version")
    levels, n = int(np.frombuffer(data, "<u4", 1, 8)[0]), int(np.frombuffer(data, "<u8", 1, 12)[0])
    sizes = np.frombuffer(data, "<u8", levels, 20).astype(np.int64)
    at = 20 + 8 * levels
    words = np.frombuffer(data, "<u8", int(sizes.sum()) // 64, at)
    at += words.nbytes
    number = PerfectHash(sizes, words).numbers(one, two)
    there, found = number >= 0, {}
    for name, kind in _FIELDS.items():
        column = np.frombuffer(data, kind, n, at)
        at += column.nbytes
        found[name] = column[np.where(there, number, 0)] if n else np.zeros(len(one), kind)
    return there & (found["fingerprint"] == fingerprints(one, two)), found


def _name(key: str) -> Column:
    """The key as text; no key's text is that of a null key."""
    return F.coalesce(F.concat(F.lit("k"), F.col(key).cast("string")), F.lit(""))


def _hashes(name: str, copy: Column) -> list[Column]:
    one, two = F.xxhash64(name, copy), F.xxhash64(F.lit("second"), name, copy)
    return [one.alias("_one"), two.alias("_two")]


def write_documents(
    docs: DataFrame, folder: str, path: str, end_id: int = 1, key: str = "doc_id", text: str = "text",
    shard_text: int = SHARD_TEXT,
) -> None:
    """Write the ids of all texts, each with ``end_id`` behind them, to a new folder.

    ``shard-*.ids`` hold nothing but ids, little-endian, of 2 bytes if the vocabulary allows and 4
    otherwise, in ascending order of keys (nulls first; rows of one key by their texts' hashes).
    ``index-*.mph`` map keys to shard, first id and length; the manifest lists all files that count.
    Null texts are empty; repeated rows are written each and found under their key together; an empty table
    gives a manifest without files; other columns are left out.

    Rows are dealt by range of key, hash of the text and place in the input, so copies of a key may lie in several
    shards. A task writes a file of its own name, and only files named by the rows of tasks that
    ended well get into the manifest, so lost or repeated tasks do no harm.
    """
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    width = 2 if Tokenizer.from_file(path).get_vocab_size() <= 1 << 16 and end_id < 1 << 16 else 4
    size, rows = docs.agg(F.sum(F.octet_length(text)), F.count(F.lit(1))).first()
    shards = max(1, ceil((size or 0) / shard_text), ceil(rows / SHARD_ROWS))
    order = ["_key", "_hash", "_at"]
    source = docs.select(F.col(key).alias("_key"), _name(key).alias("_name"), F.col(text).alias("_text"))
    source = source.withColumns({"_hash": F.xxhash64("_text"), "_at": F.monotonically_increasing_id()})
    ordered = source.repartitionByRange(shards, *order).sortWithinPartitions(*order)
    ordered = ordered.select("_name", "_text", F.spark_partition_id().alias("_shard"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = file_system(folder)
        words, name, out = word_tokens(path), f"shard-{uuid.uuid4().hex}.ids", None
        start, last, copy = 0, None, 0
        for part, texts in text_slices(batches, "_text", 4 << 20):
            if out is None:
                out = system.open_output_stream(posixpath.join(base, name))
            ids, counts = words.tokens(texts)
            full = counts + 1
            ends = np.cumsum(full)
            flat = np.empty(int(full.sum()), f"<u{width}")
            stop = np.zeros(len(flat), bool)
            stop[ends - 1] = True
            flat[stop], flat[~stop] = end_id, ids
            out.write(flat.tobytes())
            copies = []
            for one in part.column(0).to_pylist():
                copy = copy + 1 if one == last else 0
                last = one
                copies.append(copy)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0), part.column(2), pa.array([name] * len(texts)), pa.array(copies, pa.int64()),
                    pa.array(start + ends - full), pa.array(full),
                ],
                names=["_name", "_shard", "file", "_copy", "start", "length"],
            )
            start += len(flat)
        if out is not None:
            out.close()

    system, base = file_system(folder)
    system.create_dir(base, recursive=True)
    schema = "_name string, _shard int, file string, _copy bigint, start bigint, length bigint"
    entries = stored(bounded_batches(ordered).mapInArrow(write, schema), "entries")
    files = (
        entries.groupBy("_shard", "file")
        .agg(
            F.count(F.lit(1)).alias("documents"), F.sum("length").alias("ids"), F.min_by("_name", "start").alias("first"),
            F.max_by("_name", "start").alias("last"), F.max_by("_copy", "start").alias("copy"),
        )
        .orderBy("_shard")
        .collect()
    )  # one row a shard
    # Copies of a key that began in an earlier shard go on counting.
    before, count = [], 0
    for i, f in enumerate(files):
        goes_on = i > 0 and files[i - 1].last == f.first
        before.append(count if goes_on else 0)
        count = f.copy + 1 + (before[-1] if f.first == f.last else 0)
    carried = [(f._shard, f.first, b) for f, b in zip(files, before, strict=True) if b]
    numbered = entries.withColumn("_shard_at", F.col("_shard"))
    if carried:
        more = spark.createDataFrame(carried, "_shard int, _name string, _more bigint")
        numbered = numbered.join(F.broadcast(more), ["_shard", "_name"], "left").withColumn(
            "_copy", F.col("_copy") + F.coalesce("_more", F.lit(0))
        )
    repeated = numbered.filter("_copy > 0").groupBy("_name").agg((F.max("_copy") + 1).alias("copies"))
    number = {f._shard: i for i, f in enumerate(files)}
    total = sum(f.documents for f in files)
    buckets = max(1, ceil(total / INDEX_KEYS))
    keyed = numbered.join(repeated, "_name", "left").select(
        *_hashes("_name", F.col("_copy")), "_shard", "start", "length", F.coalesce("copies", F.lit(1)).alias("copies")
    )
    keyed = keyed.withColumn("_bucket", F.pmod("_one", F.lit(buckets)).cast("int"))

    def build(found: pd.DataFrame) -> pd.DataFrame:
        system, base = file_system(folder)
        one, two = (found[c].to_numpy(np.int64).view(np.uint64) for c in ("_one", "_two"))
        fields = {c: found[c].to_numpy() for c in ("start", "length", "copies")}
        fields["shard"] = found["_shard"].map(number).to_numpy()
        name = f"index-{uuid.uuid4().hex}.mph"
        with system.open_output_stream(posixpath.join(base, name)) as out:
            out.write(index_bytes(one, two, fields))
        return pd.DataFrame({"bucket": [found["_bucket"].iloc[0]], "file": [name]})

    made = stored(keyed.groupBy("_bucket").applyInPandas(build, "bucket int, file string"), "index")
    manifest = {
        "width": width,
        "shards": [{"file": f.file, "documents": f.documents, "ids": f.ids} for f in files],
        "index": {str(r.bucket): r.file for r in made.collect()},
        "buckets": buckets,
        "repeated": bool(repeated.limit(1).count()),
    }
    with system.open_output_stream(posixpath.join(base, MANIFEST)) as out:
        out.write(json.dumps(manifest).encode())


def read_manifest(folder: str) -> dict:
    system, base = file_system(folder)
    with system.open_input_stream(posixpath.join(base, MANIFEST)) as file:
        return json.loads(file.read())


def spans(start: np.ndarray, length: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Stretches of requests, in ascending order, that one read of about ``limit`` ids takes."""
    first, ends = 0, start + length
    while first < len(start):
        stop = max(first + 1, int(np.searchsorted(ends, start[first] + limit, side="right")))
        yield first, stop
        first = stop


def read_documents(keys: DataFrame, folder: str, key: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """Rows (key, copy, start, n_tokens, ids_crc32, and ids on request) of every row of ``keys``.

    ``start`` counts the ids of all documents before it; a key with several documents gives a row for
    each, numbered by ``copy``. A key that is not there gives one row with nulls, a null key the
    documents without a key. ids_crc32 is of the ids as little-endian unsigned 32-bit numbers. An
    empty table gives an empty result.

    Keys meet the index file of their bucket, then the shard they are in; each shard is read in order.
    """
    spark = keys.sparkSession
    manifest = read_manifest(folder)
    buckets, width = manifest["buckets"], manifest["width"]
    ids_before = np.cumsum([0, *[s["ids"] for s in manifest["shards"]]])
    index, files = manifest["index"], [s["file"] for s in manifest["shards"]]
    kind = keys.schema[key].dataType.simpleString()
    found_schema = f"_key {kind}, copy bigint, _shard int, _start bigint, _length bigint, copies bigint"

    def find(part: pd.DataFrame) -> pd.DataFrame:
        name = index.get(str(int(part["_bucket"].iloc[0])))
        there = np.zeros(len(part), bool)
        fields = {f: np.zeros(len(part), k) for f, k in _FIELDS.items()}
        if name:
            system, base = file_system(folder)
            with system.open_input_stream(posixpath.join(base, name)) as file:
                data = file.read()
            one, two = (part[c].to_numpy(np.int64).view(np.uint64) for c in ("_one", "_two"))
            there, fields = index_lookup(data, one, two)
        out = part[["_key", "copy"]].copy()
        for column, field in (("_shard", "shard"), ("_start", "start"), ("_length", "length"), ("copies", "copies")):
            out[column] = pd.Series(fields[field].astype(np.int64), index=part.index).astype("Int64").where(there)
        return out

    def lookup(wanted: DataFrame) -> DataFrame:
        hashed = wanted.select("_key", "copy", *_hashes("_name", F.col("copy")))
        hashed = hashed.withColumn("_bucket", F.pmod("_one", F.lit(buckets)).cast("int"))
        # A bucket's keys are dealt over tasks by hash; each of them reads the index file.
        hashed = hashed.withColumn("_part", F.pmod(F.hash("_two"), F.lit(16)))
        return hashed.groupBy("_bucket", "_part").applyInPandas(find, found_schema)

    wanted = keys.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_asked"))
    often = stored(wanted.filter("_asked > 1"), "often")
    wanted = wanted.select("_key", _name("_key").alias("_name"), F.lit(0).cast("long").alias("copy"))
    found = lookup(wanted)
    if manifest["repeated"]:
        found = stored(found, "found")
        again = found.filter("copies > 1").select("_key", F.explode(F.sequence(F.lit(1), F.col("copies") - 1)).alias("copy"))
        found = found.unionByName(lookup(again.withColumn("_name", _name("_key"))))
    found = found.drop("copies")

    def read(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("_start", kind="stable", ignore_index=True)
        out = part[["_key", "copy"]].copy()
        if pd.isna(part["_shard"].iloc[0]):
            return out.assign(start=None, n_tokens=None, ids_crc32=None, **({"ids": None} if with_ids else {}))
        shard = int(part["_shard"].iloc[0])
        start, length = (part[c].to_numpy(np.int64) for c in ("_start", "_length"))
        crcs, ids = [], []
        system, base = file_system(folder)
        with system.open_input_file(posixpath.join(base, files[shard])) as file:
            for a, b in spans(start, length, READ_BYTES // width):
                low, high = int(start[a]), int((start[a:b] + length[a:b]).max())
                file.seek(low * width)
                flat = np.frombuffer(file.read((high - low) * width), f"<u{width}").astype("<u4")
                for s, n in zip(start[a:b].tolist(), length[a:b].tolist(), strict=True):
                    one = flat[s - low : s - low + n]
                    crcs.append(zlib.crc32(one.tobytes()))
                    if with_ids:
                        ids.append(one.astype(np.int64))
        out = out.assign(start=start + ids_before[shard], n_tokens=length, ids_crc32=crcs)
        return out.assign(ids=ids) if with_ids else out

    schema = f"_key {kind}, copy bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<bigint>" * with_ids
    # What is not there is spread over groups of its own.
    spread = F.when(F.col("_shard").isNull(), F.pmod(F.xxhash64("_key"), F.lit(1024)))
    out = found.withColumn("_spread", spread).groupBy("_shard", "_spread").applyInPandas(read, schema)
    columns = out.columns
    if not often.isEmpty():
        more = often.withColumnRenamed("_key", "_again")
        out = out.join(more, F.col("_key").eqNullSafe(F.col("_again")), "left")
        out = out.withColumn("_n", F.explode(F.sequence(F.lit(1), F.coalesce("_asked", F.lit(1))))).select(columns)
    return out.withColumnRenamed("_key", key)


def file_digests(docs: DataFrame, path: str, folder: str) -> DataFrame:
    """Write ``docs`` to ``folder`` and read every document back by its key."""
    write_documents(docs, folder, path)
    keys = docs.select("doc_id").distinct()
    return read_documents(keys, folder).select("doc_id", "start", "n_tokens", "ids_crc32")
