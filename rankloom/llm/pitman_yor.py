"""Language-model scores from a hierarchical Pitman-Yor model of word pairs.

Every word seen in training, and the start of a text, has a restaurant for what follows it; all share
the restaurant of single words as parent, whose own parent is uniform over the vocabulary and one
unknown word. Words are dealt over shards, so a word's customers in every restaurant meet in one
task; the customers and tables of the restaurants are added up over shards by ranges of context
hashes, and each shard gets back the sums of its own contexts. A Gibbs sweep seats all customers of
every dish anew, which a Metropolis step accepts or not; predictive probabilities are averaged over
several sweeps.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.llm.common import bounded_batches, ranges, stored, text_slices

#: Not read any more, since every word has a restaurant; tests still set it.
SHARE = 1e-4
#: Tokens of a shard; text bytes of a chunk of documents.
SHARD_TOKENS = 4_000_000
CHUNK_BYTES = 32 << 20
#: Sweeps before and while probabilities are averaged, and times that all customers of a dish are reseated in each.
BURN_IN, SAMPLES, MOVES = 1, 3, 2
#: Strength of both levels; their discounts are estimated from how many dishes were ordered once and twice.
STRENGTH = 1.0
#: Customers of a dish that are seated one by one at first; the rest come in doubling parties.
ONE_BY_ONE = 16
#: Every fifth document is held out.
FOLDS, HELD_FOLD = 5, 1

# Strings that are not words stand for the ends of a text.
END = np.uint64(xxhash.xxh64_intdigest(b"\n"))
START = np.uint64(xxhash.xxh64_intdigest(b"\t"))


def held_out(doc_id: int | None) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % FOLDS == HELD_FOLD


def token_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all texts, an end behind each, and how many each text has."""
    words = [t.encode().lower().split() for t in texts]  # ASCII letters and spaces only
    counts = np.fromiter(map(len, words), np.int64, len(words)) + 1
    flat = np.full(int(counts.sum()), END, np.uint64)
    inside = np.ones(len(flat), bool)
    inside[np.cumsum(counts) - 1] = False
    flat[inside] = np.fromiter((xxhash.xxh64_intdigest(w) for x in words for w in x), np.uint64, int(inside.sum()))
    return flat, counts


def training_tokens(docs: DataFrame) -> int:
    """All tokens of the documents that are not held out, ends among them."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches, "_text"):
            train = [t for i, t in zip(part.column(0).to_pylist(), texts, strict=True) if not held_out(i)]
            total = sum(len(t.encode().split()) + 1 for t in train)
            yield pa.RecordBatch.from_arrays([pa.array([total], pa.int64())], names=["total"])

    return bounded_batches(docs, CHUNK_BYTES).mapInArrow(count, "total bigint").agg(F.sum("total")).first()[0] or 0


def _compressed(array: np.ndarray) -> bytes:
    return zlib.compress(array.tobytes(), 1)


def _chunks(docs: DataFrame, shards: int) -> DataFrame:
    """Rows (chunk, shard, blob): what each chunk of documents orders from each shard of words.

    The row of shard -1 keeps the chunk's documents and, for each token, the place of its entry.
    An entry is a word with the word before it, sorted by word; shards are ranges of word hashes,
    so entries of successive shards follow each other.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0
        task = TaskContext.get()
        base = (task.partitionId() if task else 0) << 32
        for part, texts in text_slices(batches, "_text", CHUNK_BYTES):
            ids = part.column(0).to_pylist()
            held = np.array([held_out(i) for i in ids])
            flat, counts = token_hashes(texts)
            word, index = np.unique(flat, return_inverse=True)
            contexts = np.append(word, START)
            before = np.r_[0, index[:-1]]
            before[np.cumsum(counts) - counts] = len(word)
            entry, place = np.unique(index * len(contexts) + before, return_inverse=True)
            n = np.bincount(place[np.repeat(~held, counts)], minlength=len(entry))
            owner, context = entry // len(contexts), entry % len(contexts)
            k = np.bincount(owner, minlength=len(word))
            shard = ((word >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)
            ends = np.searchsorted(shard, np.arange(shards + 1, dtype=np.uint64))
            stops = np.r_[0, np.cumsum(k)][ends]
            chunk = base + number
            number += 1
            rows = [(-1, _compressed(place.astype("<i4")))]
            for s in np.flatnonzero(np.diff(ends)).tolist():
                w, e = slice(ends[s], ends[s + 1]), slice(stops[s], stops[s + 1])
                own, at = np.unique(context[e], return_inverse=True)
                head = np.array([w.stop - w.start, e.stop - e.start, len(own)], "<i8").tobytes()
                rows.append((s, zlib.compress(b"".join([
                    head, word[w].astype("<u8").tobytes(), contexts[own].astype("<u8").tobytes(), k[w].astype("<i4").tobytes(),
                    at.astype("<i4").tobytes(), n[e].astype("<i4").tobytes(),
                ]), 1)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([chunk] * len(rows), pa.int64()),
                    pa.array([s for s, _ in rows], pa.int64()),
                    pa.array([b if s >= 0 else None for s, b in rows], pa.binary()),
                    pa.array([b if s < 0 else None for s, b in rows], pa.binary()),
                    pa.array([ids if s < 0 else None for s, _ in rows], pa.list_(pa.int64())),
                    pa.array([counts if s < 0 else None for s, _ in rows], pa.list_(pa.int64())),
                ],
                names=["chunk", "shard", "orders", "places", "ids", "counts"],
            )

    schema = "chunk bigint, shard bigint, orders binary, places binary, ids array<bigint>, counts array<bigint>"
    return stored(bounded_batches(docs, CHUNK_BYTES).mapInArrow(run, schema), "pitman_yor")


def _orders(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words, entries of each, and hashes of contexts and training counts of the entries."""
    blob = zlib.decompress(blob)
    words, entries, contexts = np.frombuffer(blob, "<i8", 3).tolist()
    at = 24 + 8 * (words + contexts)
    word = np.frombuffer(blob, "<u8", words, 24)
    k = np.frombuffer(blob, "<i4", words, at)
    context = np.frombuffer(blob, "<u8", contexts, 24 + 8 * words)
    context = context[np.frombuffer(blob, "<i4", entries, at + 4 * words)]
    n = np.frombuffer(blob, "<i4", entries, at + 4 * (words + entries))
    return word, k, context, n


@dataclass
class Orders:
    """All entries of a shard, sorted by word and context; ``lookup`` finds those of a chunk.

    Contexts are numbered from 1 in the order of their hashes, ``contexts``.
    """

    word: np.ndarray
    owner: np.ndarray  # index of each entry's word
    context: np.ndarray
    count: np.ndarray
    contexts: np.ndarray
    width: int

    @classmethod
    def gathered(cls, blobs: list[bytes], width: int = 0) -> Orders:
        parts = [_orders(b) for b in blobs]
        word = np.unique(np.concatenate([p[0] for p in parts]))
        contexts = np.unique(np.concatenate([np.unique(p[2]) for p in parts]))
        width = max(width, len(contexts) + 1)
        keys = np.concatenate(
            [np.repeat(np.searchsorted(word, w), k) * width + np.searchsorted(contexts, c) + 1 for w, k, c, _ in parts]
        )
        entry, place = np.unique(keys, return_inverse=True)
        count = np.bincount(place, np.concatenate([p[3] for p in parts]), len(entry)).astype(np.int64)
        return cls(word, entry // width, entry % width, count, contexts, width)

    def lookup(self, blob: bytes) -> np.ndarray:
        word, k, context, _ = _orders(blob)
        keys = np.repeat(np.searchsorted(self.word, word), k) * self.width + np.searchsorted(self.contexts, context) + 1
        return np.searchsorted(self.owner * self.width + self.context, keys)


class Seats:
    """Tables of many dishes: sizes of all tables, dish by dish, and the number of each dish's.

    A model needs the numbers only; its sweeps keep, in place of sizes, which customers opened tables.
    """

    def __init__(self, sizes: np.ndarray, tables: np.ndarray, rng: np.random.Generator) -> None:
        self.sizes, self.tables, self.rng = sizes.astype(np.int64), tables.astype(np.int64), rng

    def _pick(self, rows: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """For each dish one of its tables, by weight."""
        sums = np.cumsum(weight)
        ends = np.cumsum(self.tables)
        low = np.r_[0.0, sums][(ends - self.tables)[rows]]
        at = np.searchsorted(sums, low + self.rng.random(len(rows)) * (sums[ends[rows] - 1] - low), side="right")
        return np.clip(at, (ends - self.tables)[rows], ends[rows] - 1)

    def remove(self, rows: np.ndarray) -> None:
        """A random customer of each dish leaves; a table that is left empty goes."""
        self.sizes[self._pick(rows, self.sizes.astype(float))] -= 1
        empty = np.flatnonzero(self.sizes == 0)
        owner = np.searchsorted(np.cumsum(self.tables), empty, side="right")
        self.sizes = np.delete(self.sizes, empty)
        np.subtract.at(self.tables, owner, 1)

    def add(self, rows: np.ndarray, fresh: np.ndarray, discount: float) -> None:
        """A customer of each dish sits down: at a new table by weight ``fresh``, else at one by its size."""
        ends = np.cumsum(self.tables)
        sums = np.r_[0, np.cumsum(self.sizes)]
        seated = sums[ends[rows]] - sums[(ends - self.tables)[rows]] - discount * self.tables[rows]
        new = self.rng.random(len(rows)) * (fresh + seated) < fresh
        new |= self.tables[rows] == 0
        old = rows[~new]
        if len(old):
            self.sizes[self._pick(old, self.sizes - discount)] += 1
        self.sizes = np.insert(self.sizes, ends[rows[new]], 1)
        self.tables[rows[new]] += 1

    def party(self, rows: np.ndarray, guests: np.ndarray, fresh: np.ndarray, discount: float) -> None:
        """Many customers of each dish at once: some at tables of their own, the others by table size."""
        ends = np.cumsum(self.tables)
        sums = np.r_[0, np.cumsum(self.sizes)]
        seated = (sums[ends[rows]] - sums[(ends - self.tables)[rows]]).astype(float)
        share = fresh / (fresh + seated - discount * self.tables[rows])
        own = self.rng.binomial(guests, np.clip(share, 0, 1))
        rest = np.zeros(len(self.tables))
        rest[rows] = (guests - own) / seated
        owner = np.repeat(np.arange(len(self.tables)), self.tables)
        grown = np.cumsum(self.sizes * (1 + rest[owner]))  # whole numbers by rounding running sums
        first = np.r_[0.0, grown][(ends - self.tables)[owner]]
        whole = np.rint(grown - first).astype(np.int64)
        start = np.r_[True, owner[1:] != owner[:-1]] if len(owner) else np.zeros(0, bool)
        self.sizes = whole - np.where(start, 0, np.r_[0, whole[:-1]][: len(whole)])
        self.sizes = np.insert(self.sizes, np.repeat(ends[rows], own), 1)
        self.tables[rows] += own

    def seat(self, guests: np.ndarray, fresh: np.ndarray, discount: float) -> None:
        """Seat the customers of every dish, which has none yet."""
        done = np.zeros(len(guests), np.int64)
        while (rows := np.flatnonzero(done < guests)).size:
            few = rows[done[rows] < ONE_BY_ONE]
            if len(few):
                self.add(few, fresh[few], discount)
                done[few] += 1
                continue
            party = np.minimum(done[rows], guests[rows] - done[rows])
            self.party(rows, party, fresh[rows], discount)
            done[rows] += party

    def dump(self) -> bytes:
        head = np.array([len(self.tables), len(self.sizes)], "<i8").tobytes()
        return _compressed(np.frombuffer(head + self.tables.astype("<i4").tobytes() + self.sizes.astype("<i8").tobytes(), np.uint8))

    @classmethod
    def load(cls, blob: bytes, rng: np.random.Generator) -> Seats:
        blob = zlib.decompress(blob)
        dishes, tables = np.frombuffer(blob, "<i8", 2).tolist()
        return cls(np.frombuffer(blob, "<i8", tables, 16 + 4 * dishes), np.frombuffer(blob, "<i4", dishes, 16), rng)


def opened(guests: np.ndarray, fresh: np.ndarray, discount: float, rng: np.random.Generator) -> Seats:
    """All customers of every dish seated one after the other, and which of them opened tables.

    Customer k opens a table with probability fresh / (fresh + k - discount * tables), which falls
    until one does. So the next to do so is drawn by its probability now, and kept by the ratio
    of that at its turn; a step goes on to twice the customers at most, so few are not kept.
    """
    seated, tables = np.minimum(guests, 1), np.minimum(guests, 1)
    dishes, places = [np.flatnonzero(guests)], [np.zeros(int((guests > 0).sum()), np.int64)]
    rows = np.flatnonzero(guests > 1)
    while len(rows):
        now = seated[rows]
        weight = fresh[rows] + now - discount * tables[rows]
        with np.errstate(divide="ignore"):
            jump = np.floor(np.log1p(-rng.random(len(rows))) / np.log1p(-fresh[rows] / weight))
        stop = np.minimum(guests[rows], 2 * now)
        at = np.minimum(now + jump, stop).astype(np.int64)
        new = (at < stop) & (rng.random(len(rows)) * (weight + at - now) < weight)
        dishes.append(rows[new])
        places.append(at[new])
        tables[rows[new]] += 1
        seated[rows] = np.minimum(at + 1, stop)
        rows = rows[seated[rows] < guests[rows]]
    dish, place = np.concatenate(dishes), np.concatenate(places)
    return Seats(place[np.lexsort((place, dish))], tables, rng)


def _log_gamma(x: np.ndarray) -> np.ndarray:
    y = x + 8
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + 1 / (12 * y) - 1 / (360 * y**3) - np.log(
        x * (x + 1) * (x + 2) * (x + 3) * (x + 4) * (x + 5) * (x + 6) * (x + 7)
    )


def log_weight(seats: Seats, guests: np.ndarray, fresh: np.ndarray, discount: float) -> np.ndarray:
    """Log of what ``opened`` divides by at each dish: seatings count by it against the way they are drawn."""
    owner = np.repeat(np.arange(len(guests)), seats.tables)
    number = ranges(seats.tables) + 1
    last = number == seats.tables[owner]
    until = np.where(last, guests[owner] - 1, np.r_[seats.sizes[1:], 0][: len(owner)])
    base = fresh[owner] - discount * number + 1
    return np.bincount(owner, _log_gamma(base + until) - _log_gamma(base + seats.sizes), len(guests))


def reseated(seats: Seats | None, guests: np.ndarray, fresh: np.ndarray, discount: float, rng: np.random.Generator) -> Seats:
    """MOVES whole reseatings of every dish, each accepted by its weight against the seating before.

    The seating of each dish with p(tables) in proportion to the discounted Stirling number times
    fresh ** tables is what this leaves as it is. Without a seating one is drawn first.
    """
    seats = seats or opened(guests, fresh, discount, rng)
    for _ in range(MOVES):
        new = opened(guests, fresh, discount, rng)
        gain = log_weight(new, guests, fresh, discount) - log_weight(seats, guests, fresh, discount)
        keep = np.log1p(-rng.random(len(guests))) >= gain
        owner = np.r_[np.repeat(np.arange(len(guests)), seats.tables), np.repeat(np.arange(len(guests)), new.tables)]
        wanted = np.r_[keep[owner[: len(seats.sizes)]], ~keep[owner[len(seats.sizes) :]]]
        place = np.r_[seats.sizes, new.sizes][wanted]
        order = np.argsort(owner[wanted], kind="stable")
        seats = Seats(place[order], np.where(keep, seats.tables, new.tables), rng)
    return seats


#: Columns of a shard's counts of contexts, cut by ranges of context hashes.
PIECE = ["bucket", "contexts", "counts"]


def _pieces(contexts: np.ndarray, counts: np.ndarray, buckets: int) -> list[tuple[int, bytes, bytes]]:
    """PIECE rows of the columns of ``counts``, whose contexts are sorted."""
    at = ((contexts >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    ends = np.searchsorted(at, np.arange(buckets + 1, dtype=np.uint64))
    return [
        (b, contexts[x:y].astype("<u8").tobytes(), _compressed(counts[:, x:y].astype("<i8")))
        for b, (x, y) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)) if y > x
    ]


def _summed_pieces(pieces: DataFrame) -> DataFrame:
    """(shard, bucket, own, sums): for each piece the sums over all shards, and its contexts counted once."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        contexts = [np.frombuffer(b, "<u8") for b in rows["contexts"]]
        counts = [np.frombuffer(zlib.decompress(b), "<i8").reshape(-1, len(c)) for b, c in zip(rows["counts"], contexts, strict=True)]
        known, place = np.unique(np.concatenate(contexts), return_inverse=True)
        sums = np.stack([np.bincount(place, x, len(known)).astype("<i8") for x in np.concatenate(counts, axis=1)])
        ends = np.cumsum([len(c) for c in contexts])[:-1]
        out = [_compressed(sums[:, at]) for at in np.split(place, ends)]
        return pd.DataFrame({"shard": rows["shard"].to_numpy(), "bucket": key[0], "own": [len(known)] + [0] * (len(out) - 1), "sums": out})

    own = pieces.filter("bucket >= 0").select("shard", *PIECE)
    return stored(own.groupBy("bucket").applyInPandas(run, "shard bigint, bucket bigint, own bigint, sums binary"), "pitman_yor")


def _joined(sums: pd.DataFrame, kinds: int) -> np.ndarray:
    """A shard's sums of all buckets, one column for each of its contexts behind an empty one."""
    rows = sums.sort_values("bucket")["sums"]
    parts = [np.frombuffer(zlib.decompress(b), "<i8").reshape(kinds, -1) for b in rows]
    return np.concatenate([np.zeros((kinds, 1), np.int64), *parts], axis=1)


def _restaurants(chunks: DataFrame, shards: int) -> DataFrame:
    """One row per shard (bucket -1): the dishes that have several customers, and numbers of those
    that don't; and its pieces, of the customers and the least tables of contexts."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        orders = Orders.gathered(rows["orders"].tolist())
        size = len(orders.contexts) + 1
        total = np.bincount(orders.owner, orders.count, len(orders.word)).astype(np.int64)
        several = total > 1  # words with one customer in all have one table everywhere
        single, dish = orders.count == 1, orders.count > 1
        alone = np.bincount(orders.owner, single, len(orders.word)).astype(np.int64)
        new = np.cumsum(several) - 1
        once = np.bincount(orders.owner, orders.count > 0, len(orders.word)).astype(np.int64)
        stats = [
            int(total.sum()), int((total > 0).sum()), int((total == 1).sum()), int(single.sum()), int(dish.sum()),
            int((orders.count == 2).sum()), int((once == 1).sum()), int((once == 2).sum()),
        ]
        singles = np.bincount(orders.context, single, size).astype(np.int64)
        customers = np.bincount(orders.context, orders.count, size).astype(np.int64)
        least = singles + np.bincount(orders.context, dish, size).astype(np.int64)
        dishes = np.stack([new[orders.owner[dish]], orders.context[dish], orders.count[dish]])
        room = {
            "shard": key[0], "bucket": -1, "stats": stats, "dishes": _compressed(dishes.astype("<i8")),
            "alone": _compressed(alone[several].astype("<i8")), "contexts": orders.contexts.astype("<u8").tobytes(),
            "counts": _compressed(singles.astype("<i8")),
        }
        pieces = _pieces(orders.contexts, np.stack([customers, least])[:, 1:], shards)
        empty = {"shard": key[0], "stats": None, "dishes": None, "alone": None}
        return pd.DataFrame([room, *(empty | dict(zip(PIECE, p, strict=True)) for p in pieces)])

    schema = "shard bigint, bucket bigint, stats array<bigint>, dishes binary, alone binary, contexts binary, counts binary"
    orders = chunks.filter("shard >= 0").select("shard", "orders")
    return stored(orders.groupBy("shard").applyInPandas(run, schema), "pitman_yor")


def _summed(df: DataFrame, column: str, width: int) -> np.ndarray:
    rows = df.select(F.posexplode(column).alias("i", "n")).groupBy("i").agg(F.sum("n").alias("n")).collect()
    found = np.zeros(width, np.int64)
    for r in rows:
        found[r["i"]] = r["n"]
    return found


class Counts:
    """Sums of all contexts, in the order of their hashes, for a look at the model: read when asked for.

    Tasks get those of their own contexts instead.
    """

    def __init__(self, rooms: DataFrame, sums: DataFrame, kinds: int, kind: int) -> None:
        self.rooms, self.sums, self.kinds, self.kind = rooms, sums, kinds, kind
        self.known: np.ndarray | None = None

    def __getitem__(self, context: np.ndarray) -> np.ndarray:
        if self.known is None:
            found, sums = {}, self.sums.toPandas()
            for r in self.rooms.filter("bucket = -1").select("shard", "contexts").collect():
                own = _joined(sums[sums["shard"] == r["shard"]], self.kinds)[self.kind, 1:]
                found |= dict(zip(np.frombuffer(r["contexts"], "<u8").tolist(), own.tolist(), strict=True))
            self.known = np.array([0, *(found[c] for c in sorted(found))])
        return self.known[context]


@dataclass
class Model:
    """Numbers that all tasks share, and counts of contexts: those of a shard in its task."""

    customers: np.ndarray | Counts | None
    tables: np.ndarray | Counts | None  # of each restaurant
    root_customers: int
    root_tables: int
    vocabulary: int
    tokens: int
    discount: float
    root_discount: float

    def of_shard(self, customers: np.ndarray | None, tables: np.ndarray | None) -> Model:
        return replace(self, customers=customers, tables=tables)

    def parent(self, customers: np.ndarray, tables: np.ndarray) -> np.ndarray:
        """Probability of words by their customers and tables in the parent restaurant."""
        d = self.root_discount
        unseen = (STRENGTH + d * self.root_tables) / (self.vocabulary + 1)
        return (customers - d * tables + unseen) / (STRENGTH + self.root_customers)

    def child(self, context: np.ndarray, customers: np.ndarray, tables: np.ndarray, parent: np.ndarray) -> np.ndarray:
        d = self.discount
        passed = (STRENGTH + d * self.tables[context]) * parent
        return (customers - d * tables + passed) / (STRENGTH + self.customers[context])


def _dishes(row: pd.Series) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    owner, context, count = np.frombuffer(zlib.decompress(row["dishes"]), "<i8").reshape(3, -1)
    return owner, context, count, np.frombuffer(zlib.decompress(row["alone"]), "<i8")


def _sweep(rooms: DataFrame, before: DataFrame | None, sums: DataFrame, kinds: int, model: Model, number: int, shards: int) -> DataFrame:
    """One row per shard (bucket -1): its seats after one more Gibbs sweep, child seats, then the
    parent's; and its pieces, of the tables of contexts. ``sums`` are those after the sweep before."""
    plain = model.of_shard(None, None)

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        model = plain
        room = rows[rows["part"] == 0].iloc[0]
        state = rows[rows["part"] == 1]
        tables = _joined(rows[rows["part"] == 2], kinds)[-1]
        rng = np.random.default_rng([int(key[0]), number])
        owner, context, count, alone = _dishes(room)
        first = not len(state)
        fresh_root = np.full(len(alone), (STRENGTH + model.root_discount * model.root_tables) / (model.vocabulary + 1))
        if first:  # at first every dish has one table, in the parent too
            seats = None
            guests = alone + np.bincount(owner, minlength=len(alone)).astype(np.int64)
            parent = model.parent(guests, np.minimum(guests, 1))
        else:
            seats, root = Seats.load(state["seats"].iloc[0], rng), Seats.load(state["root"].iloc[0], rng)
            guests = alone + np.bincount(owner, seats.tables, len(alone)).astype(np.int64)
            parent = model.parent(guests, root.tables)
        fresh = (STRENGTH + model.discount * tables[context]) * parent[owner]
        seats = reseated(seats, count, fresh, model.discount, rng)
        # Each table of a child is a customer of the parent, whose numbers have changed: all sit down anew.
        guests = alone + np.bincount(owner, seats.tables, len(alone)).astype(np.int64)
        root = reseated(None, guests, fresh_root, model.root_discount, rng)
        contexts, singles = np.frombuffer(room["contexts"], "<u8"), np.frombuffer(zlib.decompress(room["counts"]), "<i8")
        tables = singles + np.bincount(context, seats.tables, len(singles)).astype(np.int64)
        done = (key[0], -1, seats.dump(), root.dump(), int(guests.sum()), int(root.tables.sum()), None, None)
        pieces = [(key[0], b, None, None, 0, 0, c, n) for b, c, n in _pieces(contexts, tables[None, 1:], shards)]
        return pd.DataFrame([done, *pieces], columns=["shard", "bucket", "seats", "root", "root_customers", "root_tables", "contexts", "counts"])

    parts = rooms.filter("bucket = -1").select("shard", F.lit(0).alias("part"), "dishes", "alone", "contexts", "counts")
    if before is not None:
        parts = parts.unionByName(before.select("shard", F.lit(1).alias("part"), "seats", "root"), allowMissingColumns=True)
    else:
        parts = parts.withColumn("seats", F.lit(None).cast("binary")).withColumn("root", F.lit(None).cast("binary"))
    parts = parts.unionByName(sums.select("shard", F.lit(2).alias("part"), "bucket", "sums"), allowMissingColumns=True)
    schema = (
        "shard bigint, bucket bigint, seats binary, root binary, root_customers bigint, root_tables bigint, "
        "contexts binary, counts binary"
    )
    # Shards are few rows: deal them out, so that each is a task's whole work.
    return stored(parts.repartition(shards, "shard").groupBy("shard").applyInPandas(run, schema), "pitman_yor")


def _answers(chunks: DataFrame, first: DataFrame, samples: list[DataFrame], sums: list[DataFrame], models: list[Model]) -> DataFrame:
    """(chunk, shard, answer): of each entry, log10 of the averaged probability and the word's count.

    ``first`` are the sums of customers, ``sums`` the tables of each sample.
    """
    rows = chunks.filter("shard >= 0").select("shard", "chunk", "orders")
    empty = F.lit(None).cast("binary")
    rows = rows.withColumns({"seats": empty, "root": empty, "bucket": F.lit(None).cast("bigint"), "sums": empty})
    for i, s in enumerate(samples):
        rows = rows.unionByName(s.select("shard", F.lit(-1 - i).cast("long").alias("chunk"), "seats", "root"), allowMissingColumns=True)
    for i, s in enumerate([*sums, first]):
        number = F.lit(-1 - len(samples) - i).cast("long").alias("chunk")
        rows = rows.unionByName(s.select("shard", number, "bucket", "sums"), allowMissingColumns=True)
    orders = rows
    sent = [m.of_shard(None, None) for m in models]

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rng = np.random.default_rng(0)
        asked = rows[rows["chunk"] >= 0]
        orders = Orders.gathered(asked["orders"].tolist())
        total = np.bincount(orders.owner, orders.count, len(orders.word)).astype(np.int64)
        several, dish, single = total > 1, orders.count > 1, orders.count == 1
        customers = _joined(rows[rows["chunk"] == -1 - 2 * len(sent)], 2)[0]
        mean = np.zeros(len(orders.owner))
        for i, model in enumerate(sent):
            model = model.of_shard(customers, _joined(rows[rows["chunk"] == -1 - len(sent) - i], 1)[0])
            state = rows[rows["chunk"] == -1 - i].iloc[0]
            tables = single.astype(float)
            tables[dish] = Seats.load(state["seats"], rng).tables
            guests = np.bincount(orders.owner, tables, len(orders.word))
            root = (total == 1).astype(float)
            root[several] = Seats.load(state["root"], rng).tables
            parent = model.parent(guests, root)[orders.owner]
            mean += model.child(orders.context, orders.count, tables, parent) / len(sent)
        logs = np.log10(mean).astype("<f4")
        counts = total[orders.owner].astype("<i8")
        out = []
        for chunk, blob in zip(asked["chunk"], asked["orders"], strict=True):
            at = orders.lookup(blob)
            out.append((chunk, key[0], logs[at].tobytes(), _compressed(counts[at])))
        return pd.DataFrame(out, columns=["chunk", "shard", "logs", "known"])

    return orders.groupBy("shard").applyInPandas(run, "chunk bigint, shard bigint, logs binary, known binary")


def _fitted(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, list[DataFrame], list[DataFrame], list[Model]]:
    """Chunks, rooms, their first sums, and sampled seatings with their sums and models."""
    shards = max(1, ceil(training_tokens(docs) / SHARD_TOKENS))
    chunks = _chunks(docs, shards)
    rooms = _restaurants(chunks, shards)
    first = _summed_pieces(rooms)
    tokens, vocabulary, hapaxes, ones, pairs, twos, root_ones, root_twos = _summed(rooms, "stats", 8).tolist()

    def ney(n1: int, n2: int) -> float:
        return min(0.95, max(0.1, n1 / (n1 + 2 * n2))) if n1 else 0.5

    # At first every dish has one table.
    customers = Counts(rooms, first, 2, 0)
    model = Model(
        customers, Counts(rooms, first, 2, 1), ones + pairs, vocabulary, vocabulary, tokens,
        ney(ones, twos), ney(root_ones, root_twos),
    )
    state, now, kinds, samples, sums, models = None, first, 2, [], [], []
    for number in range(BURN_IN + SAMPLES):
        swept = _sweep(rooms, state, now, kinds, model, number, shards)
        state, now, kinds = swept.filter("bucket = -1"), _summed_pieces(swept), 1
        root = state.agg(F.sum("root_customers").alias("c"), F.sum("root_tables").alias("t")).first()
        model = Model(
            customers, Counts(rooms, now, 1, 0), (root["c"] or 0) + hapaxes, (root["t"] or 0) + hapaxes,
            vocabulary, tokens, model.discount, model.root_discount,
        )
        if number >= BURN_IN:
            samples.append(state)
            sums.append(now)
            models.append(model)
    return chunks, rooms, first, samples, sums, models


def fitted(docs: DataFrame) -> tuple[DataFrame, list[DataFrame], list[Model], int]:
    """Chunks, sampled seatings, their models, and the contexts' number and one."""
    chunks, _, first, samples, _, models = _fitted(docs)
    return chunks, samples, models, (first.agg(F.sum("own")).first()[0] or 0) + 1


def score_documents(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``df``: key, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Scores are log10 probabilities of whole texts: ``score`` by the model, ``base_score`` by single words
    with half a count added. A null or empty text is an end alone; a null key counts as an empty
    string where documents are held out; repeated rows count each time; an empty table gives an
    empty result; other columns are not read.
    """
    docs = df.select(F.col(key).cast("long").alias("_key"), F.col(text).alias("_text"))
    chunks, _, first, samples, sums, models = _fitted(docs)
    tokens, vocabulary = models[-1].tokens, models[-1].vocabulary
    answers = _answers(chunks, first, samples, sums, models)
    kept = chunks.filter("shard < 0").select("chunk", "places", "ids", "counts")

    def run(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        right = right.sort_values("shard")
        logs = np.concatenate([np.frombuffer(b, "<f4") for b in right["logs"]]).astype(float)
        known = np.concatenate([np.frombuffer(zlib.decompress(b), "<i8") for b in right["known"]])
        base = np.log10((known + 0.5) / (tokens + 0.5 * (vocabulary + 1)))
        out = []
        for _, row in left.iterrows():
            place = np.frombuffer(zlib.decompress(row["places"]), "<i4")
            counts = np.asarray(row["counts"], np.int64)
            owner = np.repeat(np.arange(len(counts)), counts)
            sums = [np.bincount(owner, x[place], len(counts)) for x in (known > 0, base, logs)]
            ids = list(row["ids"])
            out.append(pd.DataFrame({
                "id": pd.array([None if pd.isna(i) else int(i) for i in ids], "Int64"),
                "held_out": [held_out(None if pd.isna(i) else int(i)) for i in ids], "n_tokens": counts,
                "n_known": sums[0].astype("int64"), "train_tokens": tokens, "base_score": sums[1], "score": sums[2],
            }))
        return pd.concat(out)

    schema = "id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return (
        kept.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(run, schema).withColumnRenamed("id", key)
    )
