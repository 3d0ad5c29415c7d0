"""Exact n-gram Jaccard join: group counts of shingles as points, bounded by summed minima.

1. Shingles are hashed, and the hash range of a set is cut into groups. The sizes of the sets
   decide how many groups there are, so that sets similar enough differ in fewer groups
   than either has. They meet in a cell: size band, group, and digest of the group.
2. In each cell, members are compared with one of them, the centre. Links become components.
3. Large cells get new centres for what is outside their largest component. Cells that still hold
   several components are compared wholly. Pairs of small cells go on if the
   summed minima of their counts reach the overlap needed. The members of large cells are cut into
   blocks, of which those outside the largest component meet all, their points packed into an
   R-tree that is searched from its root, nodes bounded by the summed minima of their largest counts.
4. Every pair that survives a bound is verified with its whole sets of 64-bit shingle hashes. The
   sets that share a cell are hashed and written once; pairs and blocks meet these, no text travels.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.llm.common import bounded_batches, components, mixed, stored, text_slices
from rankloom.session import broadcast_if_small

#: Ratio of the sizes at which size bands begin and end.
BAND = 1.5
#: Coordinates of a point; children of an R-tree node; members of a block.
DIMENSIONS = 32
FANOUT = 16
BLOCK = 1024
#: Shingles of a block, so that blocks of long texts hold fewer members.
BLOCK_SHINGLES = 1_000_000
#: Members up to which the pairs of a cell are listed; larger cells are compared in blocks.
SMALL = 32
#: Centres that cells with the same members can have.
CENTRES = 4
#: Rounds in which large cells get new centres before they are compared wholly.
CENTRE_ROUNDS = 2
#: Entries in a bucket of cells, and roughly those that a shingle makes at 85 percent.
BUCKET_ENTRIES = 1_000_000
ENTRIES_A_SHINGLE = 0.31


def shingle_hashes(text: str, words: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles; a shorter text is one shingle, an empty one none."""
    found = text.encode().lower().split()  # ASCII letters and spaces only
    if not found:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, found), np.uint64, len(found))
    width = min(words, len(hashes))
    shingles = np.full(len(hashes) - width + 1, width, np.uint64)
    for k in range(width):
        shingles = mixed(shingles ^ hashes[k : len(shingles) + k])
        shingles += np.uint64(k + 1)
    return np.unique(shingles)


class Cells:
    """Cell keys of sets, such that sets of the similarity asked for share one.

    Sets of a and b shingles with 100 * overlap >= percent * union differ in at most
    (a + b) * (100 - percent) / (100 + percent) shingles. Band i holds the sizes from its edge to
    the next one; a set has the cells of its own band, and of every band below down to that of the
    smallest partner. A band has more groups than differences, so one group that isn't empty
    is equal, unless a set has too few groups that aren't; such sets meet in a cell of their own.
    """

    def __init__(self, percent: int) -> None:
        self.percent = percent
        self.edges = [1]

    def differences(self, a: float, b: float) -> int:
        return int((a + b) * (100 - self.percent) / (100 + self.percent) + 1e-9)

    def band(self, size: int) -> int:
        while self.edges[-1] <= size:
            self.edges.append(max(self.edges[-1] + 1, int(self.edges[-1] * BAND)))
        return int(np.searchsorted(self.edges, size, side="right")) - 1

    def groups(self, band: int) -> int:
        top = self.edges[band + 1] - 1
        most = self.differences(top, top * 100 / self.percent)
        return 1 if most == 0 else int(1.1 * (most + 1)) + 1

    def keys(self, shingles: np.ndarray) -> np.ndarray:
        size = len(shingles)
        if not size:
            return np.zeros(0, np.int64)
        sums = np.r_[np.uint64(0), np.cumsum(mixed(shingles))]
        own = self.band(size)
        bands = [(own, self.differences(size, size * 100 / self.percent))]
        below = own
        while below and size * self.percent <= 100 * (self.edges[below] - 1):
            below -= 1
            bands.append((below, self.differences(size, self.edges[below + 1] - 1)))
        found = []
        for band, most in bands:
            count = self.groups(band)
            group = ((shingles >> np.uint64(32)) * np.uint64(count)) >> np.uint64(32)
            ends = np.searchsorted(group, np.arange(count + 1, dtype=np.uint64))
            used = np.flatnonzero(np.diff(ends))
            place = mixed(used.astype(np.uint64) + np.uint64((band + 1) << 32))
            found.append(mixed(place ^ (sums[ends[used + 1]] - sums[ends[used]])))
            if len(used) <= most:
                found.append(mixed(np.array([(band + 1) << 48], np.uint64)))
        return np.concatenate(found).view(np.int64)


def needed(a: np.ndarray | int, b: np.ndarray | int, percent: int) -> np.ndarray | int:
    """The least overlap with which sets of a and b shingles link."""
    return -(-percent * (a + b) // (100 + percent))


def _described(docs: DataFrame, words: int) -> DataFrame:
    """id, set size, two digests of the set, and its point: how many shingles fall in each group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches, "_text", 1 << 20):
            found = [shingle_hashes(t, words) for t in texts]
            numbers = [[len(x) for x in found], [digest(x) for x in found], [digest(x, 77) for x in found]]
            points = pa.array([point_of(x).astype(np.int32) for x in found], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *(pa.array(x, pa.int64()) for x in numbers), points],
                names=["id", "n", "d1", "d2", "point"],
            )

    return bounded_batches(docs).mapInArrow(run, "id bigint, n bigint, d1 bigint, d2 bigint, point array<int>")


def point_of(shingles: np.ndarray) -> np.ndarray:
    return np.bincount((shingles >> np.uint64(59)).astype(np.int64), minlength=DIMENSIONS)


def digest(shingles: np.ndarray, seed: int = 0) -> int:
    return int(mixed(shingles + np.uint64(seed)).sum(dtype=np.uint64).view(np.int64))


def _packed_cells(docs: DataFrame, words: int, percent: int, buckets: int) -> DataFrame:
    """(bucket, packed): cells and digests of the sets of slices, as one array for each bucket of cells.

    So a row travels for thousands of cells. A cell that a slice sees several times sends one entry to
    its bucket; all its entries are known to be wanted and pass by the buckets, so a common cell
    fills none. They go to numbers from ``buckets`` on, dealt by task and slice.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker = Cells(percent)
        task = TaskContext.get()
        base, flushes = (task.partitionId() if task else 0) << 32, 0
        for _, texts in text_slices(batches, "_text"):
            cells, sets = [], []
            for text in texts:
                found = shingle_hashes(text, words)
                cells.append(maker.keys(found))
                sets.append(np.full(len(cells[-1]), digest(found), np.int64))
            cell, d = np.concatenate(cells), np.concatenate(sets)
            order = np.lexsort((d, cell))
            cell, d = cell[order], d[order]
            new = np.r_[True, (cell[1:] != cell[:-1]) | (d[1:] != d[:-1])][: len(cell)]
            cell, d = cell[new], d[new]
            first = np.r_[True, cell[1:] != cell[:-1]][: len(cell)]
            several = ~(first & np.r_[first[1:], True][: len(cell)])
            spread = int(mixed(np.array([base + flushes], np.uint64))[0] % np.uint64(buckets))
            out = [(buckets + spread, cell[several], d[several])]
            flushes += 1
            cell, d = cell[first], d[first]
            at = ((mixed(cell.view(np.uint64)) >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
            order = np.argsort(at, kind="stable")
            ends = np.searchsorted(at[order], np.arange(buckets + 1, dtype=np.uint64))
            for b in np.flatnonzero(np.diff(ends)).tolist():
                part = order[ends[b] : ends[b + 1]]
                out.append((b, cell[part], d[part]))
            out = [x for x in out if len(x[1])]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([b for b, _, _ in out], pa.int64()),
                    pa.array([np.concatenate([c, s]).tobytes() for _, c, s in out], pa.binary()),
                ],
                names=["bucket", "packed"],
            )

    return bounded_batches(docs.select("_text")).mapInArrow(pack, "bucket bigint, packed binary")


def _shared_cells(docs: DataFrame, words: int, percent: int, buckets: int) -> DataFrame:
    """(cell, d) of all cells with two different sets or more, each set by its digest."""

    def match(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        parts = [np.frombuffer(x, np.int64).reshape(2, -1) for x in rows["packed"]]
        cell, d = np.concatenate(parts, axis=1)
        if key[0] < buckets:
            order = np.lexsort((d, cell))
            cell, d = cell[order], d[order]
            new = np.r_[True, (cell[1:] != cell[:-1]) | (d[1:] != d[:-1])]
            cell, d = cell[new], d[new]
            first = np.r_[True, cell[1:] != cell[:-1]]
            several = ~(first & np.r_[first[1:], True])
            cell, d = cell[several], d[several]
        return pd.DataFrame({"cell": cell, "d": d})

    return _packed_cells(docs, words, percent, buckets).groupBy("bucket").applyInPandas(match, "cell bigint, d bigint").distinct()


def durable(df: DataFrame) -> DataFrame:
    """Written and read again. Size estimates of checkpoints would multiply with every join."""
    return stored(df, "jaccard")


def _bounded(pairs: DataFrame, points: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, cells) whose summed minima reach the overlap that their sizes need."""

    def side(name: str) -> DataFrame:
        return points.select(F.col("rep").alias(name), F.col("n").alias(f"n_{name}"), F.col("point").alias(f"point_{name}"))

    minima = F.aggregate(
        F.zip_with("point_a", "point_b", lambda x, y: F.least(x, y)), F.lit(0), lambda x, y: x + y
    )
    reached = minima * (100 + percent) >= percent * (F.col("n_a") + F.col("n_b"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").filter(reached)
    return durable(both.groupBy("a", "b").agg(F.max("cells").alias("cells")))


def _member_sets(docs: DataFrame, members: DataFrame, words: int) -> DataFrame:
    """(id, d, point, set) of every member: its sorted shingle hashes as bytes, written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches, "_text", 1 << 20):
            found = [shingle_hashes(t, words) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0), pa.array([digest(x) for x in found], pa.int64()),
                    pa.array([point_of(x).astype(np.int32) for x in found], pa.list_(pa.int32())),
                    pa.array([x.tobytes() for x in found], pa.binary()),
                ],
                names=["id", "d", "point", "set"],
            )

    wanted = durable(members.select("id", "d").distinct())
    texts = docs.select(F.col("_key").alias("id"), "_text").join(broadcast_if_small(wanted.select("id").distinct()), "id", "left_semi")
    hashed = bounded_batches(texts).mapInArrow(run, "id bigint, d bigint, point array<int>, set binary")
    hashed = durable(hashed.join(broadcast_if_small(wanted), ["id", "d"], "left_semi"))
    # Repeated rows give equal sets, of which one stays. Only these are shuffled.
    again = durable(hashed.groupBy("id", "d").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1").select("id", "d"))
    if again.isEmpty():
        return hashed
    one = hashed.join(broadcast_if_small(again), ["id", "d"], "left_semi").groupBy("id", "d")
    one = one.agg(F.any_value("point").alias("point"), F.any_value("set").alias("set"))
    return durable(hashed.join(broadcast_if_small(again), ["id", "d"], "left_anti").unionByName(one))


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that link, by their whole sets. Only sets of pairs travel."""
    pairs = durable(pairs.select("a", "b"))
    wanted = durable(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct())
    sets = sets.join(broadcast_if_small(wanted), "id", "left_semi")
    both = pairs.join(sets.select(F.col("id").alias("b"), F.col("set").alias("set_b")), "b").join(
        sets.select(F.col("id").alias("a"), F.col("set").alias("set_a")), "a"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for a, b, one, two in zip(batch[0].to_pylist(), batch[1].to_pylist(), batch[2], batch[3], strict=True):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (one, two))  # no copies
                if overlap(x, y) * (100 + percent) >= percent * (len(x) + len(y)):
                    found.append((a, b))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], names=["a", "b"]
            )

    # An id may have several sets: the pair counts once.
    checked = bounded_batches(both.select("a", "b", "set_a", "set_b")).mapInArrow(run, "a bigint, b bigint")
    return durable(checked)


def overlap(x: np.ndarray, y: np.ndarray) -> int:
    """Common members of two sorted arrays of distinct numbers; the smaller is looked up in the other."""
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    return int((y[at] == x).sum()) if len(y) else 0


class RTree:
    """Points in packed leaves under packed inner nodes; every node knows the largest counts and the range of
    sizes of the points below it.

    Two sets share at most the sum of the smaller counts of their groups. What a point shares with any point
    below a node is at most its summed minima with the node's largest counts, so a search goes down
    from the root into the nodes whose bound reaches the overlap needed.
    """

    def __init__(self, points: np.ndarray, sizes: np.ndarray) -> None:
        self.points, self.sizes = points, sizes
        self.order = np.lexsort((*(points[:, k] for k in range(points.shape[1] - 1, -1, -1)), sizes // 4))
        top, low, high = points[self.order], sizes[self.order], sizes[self.order]
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(low) > 1 or not self.levels:  # from the leaves to the root
            starts = np.arange(0, len(low), FANOUT)
            top = np.maximum.reduceat(top, starts, axis=0)
            low, high = np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts)
            self.levels.append((top, low, high))

    def candidates(self, point: np.ndarray, size: int, percent: int) -> np.ndarray:
        """Indices of points whose summed minima with ``point`` reach the overlap needed."""
        least = -(-percent * size // 100)
        nodes = np.zeros(1, np.int64)
        for depth in range(len(self.levels) - 1, -1, -1):
            top, low, high = (x[nodes] for x in self.levels[depth])
            near = (100 * high >= percent * size) & (percent * low <= 100 * size)
            near &= np.minimum(top, point).sum(axis=1) >= needed(size, np.maximum(low, least), percent)
            nodes = nodes[near]
            if not len(nodes):
                return nodes
            below = len(self.levels[depth - 1][1]) if depth else len(self.order)
            nodes = (nodes[:, None] * FANOUT + np.arange(FANOUT)).ravel()
            nodes = nodes[nodes < below]
        at = self.order[nodes]
        return at[np.minimum(self.points[at], point).sum(axis=1) >= needed(size, self.sizes[at], percent)]


def _block_links(percent: int, rows: pd.DataFrame) -> pd.DataFrame:
    """Links between components that the members of two blocks (or one) have; one per join."""
    rows = rows.drop_duplicates(["id", "d"]).sort_values(["id", "d"], ignore_index=True)
    sets = [np.frombuffer(x, np.uint64) for x in rows["set"]]
    points, sizes = np.stack(rows["point"].to_numpy()).astype(np.int64), np.array([len(x) for x in sets])
    ids, root = rows["id"].to_numpy(np.int64), {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = x = root[root[x]]
        return x

    comp = rows["component"].tolist()
    tree, links = RTree(points, sizes), []
    for i in range(len(rows)):
        for j in tree.candidates(points[i], int(sizes[i]), percent).tolist():
            if j <= i or find(comp[i]) == find(comp[j]):
                continue
            if overlap(sets[i], sets[j]) * (100 + percent) >= percent * (sizes[i] + sizes[j]):
                links.append((ids[i], ids[j]))
                root[find(comp[i])] = find(comp[j])
    return pd.DataFrame(links, columns=["a", "b"], dtype="int64")


def _recentred(labelled: DataFrame, salt: int) -> DataFrame:
    """Pairs (a, b) of the members outside a cell's largest component with one member of that."""
    order = F.xxhash64("id", F.pmod("cell", F.lit(CENTRES)), F.lit(salt))
    parts = labelled.groupBy("cell", "component").agg(
        F.count(F.lit(1)).alias("sets"), F.min(F.struct(order.alias("o"), "id")).alias("first")
    )
    largest = F.max(F.struct("sets", "component", "first"))
    centres = durable(
        parts.groupBy("cell").agg(largest.alias("l")).select(
            "cell", F.col("l.component").alias("largest"), F.col("l.first.id").alias("centre")
        )
    )
    return (
        labelled.join(centres, "cell")
        .filter("component <> largest")
        .select(F.least("id", "centre").alias("a"), F.greatest("id", "centre").alias("b"))
        .distinct()
    )


def _blocks(sets: Column, shingles: Column) -> Column:
    return F.ceil(F.greatest(sets / BLOCK, shingles / BLOCK_SHINGLES)).cast("int")


def _open_members(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members (cell, id, d, component) of the cells that hold several components."""
    labelled = durable(
        members.join(labels.select("id", F.col("component").alias("known")), "id", "left").select(
            "cell", "id", "d", "n", F.coalesce("known", "id").alias("component")
        )
    )
    several = durable(
        labelled.groupBy("cell")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .filter("low <> high")
        .select("cell")
    )
    return durable(labelled.join(several, "cell"))


def jaccard_components(
    docs: DataFrame, words: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: key, n_shingles, component_id (the smallest key reachable).

    Texts are lower-cased (A-Z) and cut at ASCII white space; a set holds the distinct shingles of
    ``words`` words, the whole sequence if there are fewer. Two documents link when 100 * overlap
    >= ``percent`` * union. Null and empty texts have no shingles and link with nothing. Rows of one
    key share a component. Rows with a null key get their size, link with nothing, and have a
    null component. An empty table gives an empty result; other columns are not read.
    """
    if not 50 <= percent <= 100:
        raise ValueError("percent must be from 50 to 100")
    source = docs.select(F.col(key).cast("long").alias("_key"), F.col(text).alias("_text"))
    named = source.filter("_key IS NOT NULL")
    described = stored(_described(source, words), "jaccard")
    live = described.filter("id IS NOT NULL AND n > 0")

    # Equal sets are one: the smallest key stands for all.
    reps = stored(
        live.groupBy("n", "d1", "d2").agg(
            F.min("id").alias("rep"), F.count(F.lit(1)).alias("rows"), F.any_value("point").alias("point")
        ),
        "jaccard",
    )
    copies = live.select("id", "n", "d1", "d2").join(
        reps.filter("rows > 1").select("n", "d1", "d2", "rep"), ["n", "d1", "d2"]
    )
    copy_links = copies.filter("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b"))

    # Cells with several sets, each with a centre.
    total = live.agg(F.sum("n")).first()[0] or 0
    buckets = max(1, ceil(total * ENTRIES_A_SHINGLE * (100 - percent) / 15 / BUCKET_ENTRIES))
    entries = stored(
        stored(_shared_cells(named, words, percent, buckets), "jaccard")
        .join(reps.select(F.col("d1").alias("d"), F.col("rep").alias("id"), "n"), "d")
        .select("cell", "id", "d", "n"),
        "jaccard",
    )
    order = F.xxhash64("id", F.pmod("cell", F.lit(CENTRES)))
    shared = durable(
        entries.groupBy("cell")
        .agg(F.count(F.lit(1)).alias("rows"), F.min(F.struct(order.alias("o"), "id")).alias("first"))
        .select("cell", "rows", F.col("first.id").alias("centre"))
    )
    members = stored(entries.join(shared, "cell"), "jaccard")
    pairs = (
        members.filter("id <> centre")
        .groupBy(F.least("id", "centre").alias("a"), F.greatest("id", "centre").alias("b"))
        .agg(F.count(F.lit(1)).alias("cells"))
    )
    pairs = _bounded(pairs, reps, percent)
    sets = _member_sets(named, members, words)

    # First each set and the one that it shares most cells with, then pairs that are still apart.
    best = durable(pairs.groupBy("b").agg(F.max_by("a", F.struct("cells", -F.col("a"))).alias("a")).select("a", "b"))
    links = _linked(best, sets, percent)
    labels = components(links)
    apart = pairs.select("a", "b").join(best, ["a", "b"], "left_anti")
    for name in ("a", "b"):
        own = labels.select(F.col("id").alias(name), F.col("component").alias(f"c_{name}"))
        apart = apart.join(own, name, "left").withColumn(f"c_{name}", F.coalesce(f"c_{name}", name))
    links = links.union(_linked(durable(apart.filter("c_a <> c_b").select("a", "b")), sets, percent))

    # Cells of three sets or more may hold several components yet. In small ones the pairs that are
    # apart and were not compared go on, each once however many cells they share.
    small = _open_members(members.filter(F.col("rows").between(3, SMALL)), components(links))
    left, right = (small.select("cell", F.col("id").alias(x), F.col("component").alias(f"c_{x}")) for x in ("a", "b"))
    rest = left.join(right, "cell").filter("a < b AND c_a <> c_b").groupBy("a", "b").agg(F.count(F.lit(1)).alias("cells"))
    rest = _bounded(durable(rest.join(pairs.select("a", "b"), ["a", "b"], "left_anti")), reps, percent)
    links = links.union(_linked(rest.select("a", "b"), sets, percent))

    # In large ones, members outside the largest component meet some of its members first.
    tested = pairs.select("a", "b")
    for salt in range(CENTRE_ROUNDS):
        labelled = _open_members(members.filter(F.col("rows") > SMALL), components(links))
        new = durable(_recentred(labelled, salt).join(tested, ["a", "b"], "left_anti"))
        tested = tested.union(new)
        near = _bounded(new.withColumn("cells", F.lit(1)), reps, percent)
        links = links.union(_linked(near.select("a", "b"), sets, percent))

    # What is still open is compared wholly: the members outside a cell's largest component with each other
    # and with that component, in pairs of blocks; cells with the same members once.
    labelled = _open_members(members.filter(F.col("rows") > SMALL), components(links))
    parts = labelled.groupBy("cell", "component").agg(
        F.count(F.lit(1)).alias("sets"), F.sum("n").alias("size"),
        F.sum(F.xxhash64("id", "d").cast("decimal(20,0)")).alias("who"),
    )
    largest = F.max(F.struct("sets", "component", "size"))
    open_cells = durable(
        parts.groupBy("cell")
        .agg(
            F.sum("sets").alias("rows"), F.sum("who").alias("who"), F.sum("size").alias("size"), largest.alias("l")
        )
        .groupBy("rows", "who", "size")
        .agg(F.min(F.struct("cell", "l")).alias("c"))
        .select(
            "c.cell", F.col("c.l.component").alias("largest"),
            _blocks(F.col("rows") - F.col("c.l.sets"), F.col("size") - F.col("c.l.size")).alias("outside"),
            _blocks(F.col("c.l.sets"), F.col("c.l.size")).alias("inside"),
        )
    )
    block = F.pmod(F.xxhash64("id", "d"), F.when(F.col("component") == F.col("largest"), F.col("inside")).otherwise(F.col("outside"))).cast("int")

    def pair(i: Column, j: Column) -> Column:
        return F.struct(i.alias("i"), j.alias("j"))

    to_outside = F.sequence(F.lit(0), F.col("outside") - 1)
    met = F.when(
        F.col("component") == F.col("largest"),
        F.transform(to_outside, lambda o: pair(o, F.col("outside") + F.col("block"))),
    ).otherwise(
        F.concat(
            F.transform(to_outside, lambda o: pair(F.least(o, "block"), F.greatest(o, "block"))),
            F.transform(F.sequence(F.lit(0), F.col("inside") - 1), lambda k: pair(F.col("block"), F.col("outside") + k)),
        )
    )
    dealt = durable(
        labelled.join(open_cells, "cell")
        .withColumn("block", block)
        .select("cell", "id", "d", "component", F.inline(met))
    )
    more = dealt.join(sets, ["id", "d"]).groupBy("cell", "i", "j").applyInPandas(
        lambda rows: _block_links(percent, rows), "a bigint, b bigint"
    )
    found = components(links.union(durable(more)).union(copy_links))
    return (
        described.select("id", "n")
        .join(found.select(F.col("id").alias("_id"), "component"), F.col("id") == F.col("_id"), "left")
        .select(
            F.col("id").alias(key),
            F.col("n").alias("n_shingles"),
            F.coalesce("component", "id").alias("component_id"),
        )
    )
