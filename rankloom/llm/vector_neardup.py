"""Embedding near duplicates by a robust-pruned flat graph.

Vectors of a label are cut into overlapping cluster shards. Each shard builds a pruned neighbour
graph, the adjacency lists of a vector are united over its shards, and every vector is searched
for from the medoids of its home shard: greedily, then on from all places reached, its own
included, along the edges inside the range. Every cosine is computed in double precision before it
counts, and a sample is audited against brute force: the share of its links that a vector got, on average
over vectors and per label. If too little was found, shards overlap more; if that does not
help, shards overlap by the angle that no link can exceed and are compared wholly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.llm.common import bounded_batches, components, ranges, stored
from rankloom.session import broadcast_if_small, durable

#: Vectors of a label for one medoid, and medoids at most (they are sent to every task).
SHARD = 512
MEDOIDS = 4096
#: Vectors of a block; a cluster of several blocks is one shard for each pair of them.
BLOCK = 4096
#: A vector is in the shards of all medoids whose cosine is this near to the best one's, and of
#: OVERLAP ones at most; both are doubled when an audit fails.
MARGIN, OVERLAP = 0.12, 6
#: Nearest and random candidates for edges, edges kept, and the slack of pruning.
NEAREST, RANDOM, DEGREE, SLACK = 64, 8, 24, 1.2
#: Best places that the greedy search keeps open, and places expanded at once.
BEAM, AT_ONCE = 16, 4
#: Expansion goes on at vectors this much below the range.
BELOW = 0.03
#: Vectors audited, about, the recall they must show, and those a label needs to be looked at alone.
AUDIT, LEAST_RECALL, LABEL_SAMPLE = 1024, 0.999, 20
#: How often shards are widened before they are compared wholly.
WIDENED = 1

TASK = ["label", "dim", "cluster", "i", "j"]


def _unit(df: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """Vectors that can link, divided by their norms, with a digest of what they were."""
    source = df.filter(F.col(key).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull()).select(
        F.col(key).cast("long").alias("id"), F.col(label).cast("string").alias("label"), F.col(vector).cast("array<double>").alias("v")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, labels, vectors = [], [], []
            for i, name, v in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if v and None not in v:
                    x = np.array(v)
                    # Scaled first: squares of very large or small numbers would leave the range.
                    top = np.abs(x).max()
                    if np.isfinite(top) and top > 0 and not np.isnan(x).any():
                        x = x / top
                        ids.append(i)
                        labels.append(name)
                        vectors.append(x / np.sqrt(x @ x))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(labels, pa.string()), pa.array(vectors, pa.list_(pa.float64()))],
                names=["id", "label", "v"],
            )

    unit = bounded_batches(source).mapInArrow(run, "id bigint, label string, v array<double>")
    return unit.withColumn("dim", F.size("v")).withColumn("h1", F.xxhash64("v")).withColumn("h2", F.xxhash64(F.lit(1), "v"))


def _medoids(reps: DataFrame) -> dict[tuple[str, int], np.ndarray]:
    """A sample of vectors by label and dimension: one of SHARD by hash, MEDOIDS in all at most."""
    total = reps.count()
    share = min(1 / SHARD, 0.8 * MEDOIDS / max(total, 1))
    rows = reps.filter(F.pmod(F.xxhash64(F.lit("medoid"), "rep"), F.lit(1 << 32)) < int(share * 2**32))
    found: dict[tuple[str, int], list] = {}
    for r in rows.select("label", "dim", "rep", "v").limit(MEDOIDS).collect():
        found.setdefault((r["label"], r["dim"]), []).append((r["rep"], r["v"]))
    return {k: np.array([v for _, v in sorted(x)]) for k, x in found.items() if len(x) > 1}


def _shards(reps: DataFrame, medoids: dict, widen: int | None, threshold: float) -> DataFrame:
    """Rows (TASK, rep, weight, v, own, other): members of every shard; own: searched for here.

    Without ``widen`` a vector is in every shard that may be the home of a partner: if two vectors are
    at most an angle apart, each is as near to the other's medoid as to its own but for twice the angle.
    """
    angle = 2 * np.arccos(min(1.0, threshold)) + 1e-6
    sent = reps.sparkSession.sparkContext.broadcast(medoids)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            places = []
            for name, dim, v in zip(rows["label"], rows["dim"], rows["v"], strict=True):
                known = sent.value.get((name, dim))
                if known is None:
                    places.append([0])
                    continue
                cos = known @ v
                near = np.argsort(-cos, kind="stable")
                if widen is None:
                    least = np.cos(min(np.pi, np.arccos(min(1.0, cos[near[0]])) + angle))
                else:
                    near = near[: widen * OVERLAP]
                    least = cos[near[0]] - widen * MARGIN
                places.append(near[cos[near] >= least].tolist())
            out = rows.assign(cluster=places, home=[p[0] for p in places]).explode("cluster", ignore_index=True)
            yield out.assign(cluster=out["cluster"].astype("int64"), home=out["home"] == out["cluster"])

    assigned = stored(
        bounded_batches(reps.select("label", "dim", "rep", "weight", "v")).mapInPandas(
            assign, "label string, dim int, rep bigint, weight bigint, v array<double>, cluster bigint, home boolean"
        ),
        "vectors",
    )
    sizes = durable(assigned.groupBy("label", "dim", "cluster").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")))
    own = F.pmod(F.xxhash64("rep"), "blocks").cast("int")
    return (
        assigned.join(broadcast_if_small(sizes), ["label", "dim", "cluster"])
        .withColumn("block", own)
        .withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "label", "dim", "cluster", F.least("block", "_o").alias("i"), F.greatest("block", "_o").alias("j"),
            "rep", "weight", "v", "home", "block",
        )
    )


def robust_prune(x: np.ndarray, seed: int) -> list[np.ndarray]:
    """For each vector the candidates kept: the nearest one, then those not nearer to one kept already."""
    m = len(x)
    rng = np.random.default_rng(seed)
    far = rng.integers(0, m, (m, min(RANDOM, m)))
    k = min(NEAREST, m - 1)
    kept: list[np.ndarray] = []
    for start in range(0, m, 128):
        at = np.arange(start, min(m, start + 128))
        cos = x[at] @ x.T
        cos[np.arange(len(at)), at] = -2
        near = np.argpartition(-cos, k - 1, axis=1)[:, :k] if k else np.zeros((len(at), 0), int)
        both = np.concatenate([near, far[at]], axis=1)
        d = 2 - 2 * np.take_along_axis(cos, both, axis=1)
        order = np.argsort(d, axis=1, kind="stable")
        both, d = np.take_along_axis(both, order, axis=1), np.take_along_axis(d, order, axis=1)
        vectors = x[both]
        between = 2 - 2 * (vectors @ vectors.transpose(0, 2, 1))
        alive = both != at[:, None]
        chosen = np.zeros_like(alive)
        rows = np.arange(len(at))
        for _ in range(DEGREE):
            first = alive.argmax(axis=1)
            some = alive[rows, first]
            chosen[rows[some], first[some]] = True
            alive &= SLACK**2 * between[rows, first] > d
            alive[rows, first] = False
            if not alive.any():
                break
        kept += [np.unique(both[r][chosen[r]]) for r in rows]
    return kept


def _build(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("rep", ignore_index=True)
    ids = rows["rep"].to_numpy()
    kept = robust_prune(np.stack(rows["v"].to_numpy()), len(ids))
    return pd.DataFrame({"rep": ids, "near": [ids[k] for k in kept]})


def both_ways(ids: np.ndarray, near: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Edges in both directions as places: where each place's neighbours begin, and all neighbours.

    No edge is dropped for its number, so whatever has an edge can be reached; edges that lead out
    of the shard are left out.
    """
    source = np.repeat(np.arange(len(ids)), [len(n) for n in near])
    names = np.concatenate(near) if len(near) else np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(ids, names), len(ids) - 1)
    ok = ids[at] == names
    edges = np.unique(np.r_[source[ok] * len(ids) + at[ok], at[ok] * len(ids) + source[ok]])
    return np.searchsorted(edges, np.arange(len(ids) + 1) * len(ids)), edges % len(ids)


def entry_medoids(x: np.ndarray) -> np.ndarray:
    """Places from which searches start: the vectors nearest to the means of sqrt(m) clusters."""
    seeds = np.unique(np.linspace(0, len(x) - 1, int(np.ceil(np.sqrt(len(x))))).astype(int))
    owner = (x @ x[seeds].T).argmax(axis=1)
    found = []
    for c in range(len(seeds)):
        members = np.flatnonzero(owner == c)
        if len(members):
            found.append(members[(x[members] @ x[members].mean(axis=0)).argmax()])
    return np.array(found)


def range_search(x: np.ndarray, graph: tuple[np.ndarray, np.ndarray], queries: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query places, found) for slices of the queries; found marks the places within the range."""
    entries = entry_medoids(x)
    step = max(16, min(256, (16 << 20) // (8 * len(x))))
    for start in range(0, len(queries), step):
        q = queries[start : start + step]
        rows = np.arange(len(q))
        cos = np.full((len(q), len(x)), -2.0)  # -2: not seen yet
        done = np.zeros(cos.shape, bool)
        cos[:, entries] = x[q] @ x[entries].T

        def visit(r: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Expand places: cosines of their neighbours not seen yet, each once."""
            done[r, at] = True
            counts = graph[0][at + 1] - graph[0][at]
            near = graph[1][np.repeat(graph[0][at], counts) + ranges(counts)]
            r = np.repeat(r, counts)
            fresh = cos[r, near] == -2
            new = np.unique(r[fresh] * len(x) + near[fresh])
            r, at = new // len(x), new % len(x)
            for s in range(0, len(r), 65536):
                part = slice(s, s + 65536)
                cos[r[part], at[part]] = np.einsum("ij,ij->i", x[q[r[part]]], x[at[part]])
            return r, at

        # Greedily from the medoids: the best places seen are kept in a beam.
        width = min(BEAM, len(entries))
        beam = entries[np.argpartition(-cos[:, entries], width - 1, axis=1)[:, :width]]
        while True:
            ready = np.where(done[rows[:, None], beam], -3.0, cos[rows[:, None], beam])
            best = np.argsort(-ready, axis=1)[:, :AT_ONCE]
            live = np.take_along_axis(ready, best, axis=1) > -3
            if not live.any():
                break
            r, at = visit(np.repeat(rows, live.sum(axis=1)), np.take_along_axis(beam, best, axis=1)[live])
            place = np.arange(len(r)) - np.searchsorted(r, r)
            more = np.full((len(q), int(place.max()) + 1 if len(r) else 0), -1)
            more[r, place] = at
            both = np.concatenate([beam, more], axis=1)
            value = np.where(both < 0, -3.0, cos[rows[:, None], both])
            width = min(BEAM, both.shape[1])
            top = np.argpartition(-value, width - 1, axis=1)[:, :width]
            beam = np.take_along_axis(both, top, axis=1)
            beam = np.where(beam < 0, beam[:, :1], beam)
            beam = np.where(beam < 0, entries[0], beam)
        # Then over all places inside the range, or a little below it; the vector's own is one of them.
        cos[rows, q] = 1.0
        while True:
            r, at = np.nonzero((cos >= threshold - BELOW) & ~done)
            if not len(r):
                break
            visit(r, at)
        found = cos >= threshold
        found[rows, q] = False
        yield q, found


def whole_search(x: np.ndarray, queries: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The same as :func:`range_search`, by comparing the queries with all vectors."""
    step = max(16, min(1024, (16 << 20) // (8 * len(x))))
    for start in range(0, len(queries), step):
        q = queries[start : start + step]
        found = x[q] @ x.T >= threshold
        found[np.arange(len(q)), q] = False
        yield q, found


def _search(threshold: float, rows: pd.DataFrame, whole: bool = False) -> pd.DataFrame:
    """Links of the vectors at home here: weight of those found, and the smallest reachable rep."""
    rows = rows.sort_values("rep", ignore_index=True)
    ids, weight = rows["rep"].to_numpy(), rows["weight"].to_numpy(float)
    x = np.stack(rows["v"].to_numpy())
    i, j = int(rows["i"].iloc[0]), int(rows["j"].iloc[0])
    block, home = rows["block"].to_numpy(), rows["home"].to_numpy(bool)
    links, root = np.zeros(len(ids)), np.arange(len(ids))
    a, b = [], []
    if whole:
        searched = whole_search(x, np.flatnonzero(home), threshold)
    else:
        searched = range_search(x, both_ways(ids, rows["near"].tolist()), np.flatnonzero(home), threshold)
    for q, found in searched:
        if i != j:  # partners of the own block are counted where the block is alone
            found &= block[q][:, None] != block[None, :]
        links[q] += found @ weight
        r, at = np.nonzero(found)
        a.append(q[r])
        b.append(at)
    a, b = np.concatenate(a or [[]]).astype(int), np.concatenate(b or [[]]).astype(int)
    while True:
        before = root.copy()
        np.minimum.at(root, a, root[b])
        np.minimum.at(root, b, root[a])
        root = root[root]
        if (before == root).all():
            break
    touched = home | (root != np.arange(len(ids)))
    return pd.DataFrame({"rep": ids[touched], "links": (links[touched]).astype("int64"), "root": ids[root[touched]]})


def _found_links(reps: DataFrame, medoids: dict, widen: int | None, threshold: float) -> DataFrame:
    """(rep, links, root) rows of every task; without ``widen`` shards are compared wholly."""
    shards, schema = _shards(reps, medoids, widen, threshold), "rep bigint, links bigint, root bigint"
    if widen is None:
        found = shards.groupBy(*TASK).applyInPandas(lambda rows: _search(threshold, rows, whole=True), schema)
        return stored(found, "vectors")
    built = shards.groupBy(*TASK).applyInPandas(_build, "rep bigint, near array<bigint>")
    united = durable(built.groupBy("rep").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")))
    return stored(
        shards.join(united, "rep").groupBy(*TASK).applyInPandas(lambda rows: _search(threshold, rows), schema), "vectors"
    )


def audited_recall(reps: DataFrame, found: DataFrame, threshold: float) -> float:
    """The share of its links that a vector got, on average over a bounded sample of those with links.

    The least of this average and of those of labels with LABEL_SAMPLE such vectors, so that neither one large
    group nor one large label can hide what others lose. The sample is sent to all tasks, which
    compare it with every vector they hold.
    """
    share = min(1.0, AUDIT / max(reps.count(), 1))
    sample = (
        reps.filter(F.pmod(F.xxhash64(F.lit("audit"), "rep"), F.lit(1 << 32)) < int(share * 2**32))
        .select("label", "dim", "rep", "v")
        .limit(2 * AUDIT)
        .collect()
    )
    by: dict[tuple[str, int], tuple[list, list]] = {}
    for r in sample:
        ids, vectors = by.setdefault((r["label"], r["dim"]), ([], []))
        ids.append(r["rep"])
        vectors.append(r["v"])
    sent = reps.sparkSession.sparkContext.broadcast({k: (np.array(i), np.array(v)) for k, (i, v) in by.items()})

    def brute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for group, part in rows.groupby(["label", "dim"]):
                if group in sent.value:
                    ids, vectors = sent.value[group]
                    own, x = part["rep"].to_numpy(), np.stack(part["v"].to_numpy())
                    for s in range(0, len(own), 1024):
                        hit = (vectors @ x[s : s + 1024].T >= threshold) & (ids[:, None] != own[None, s : s + 1024])
                        yield pd.DataFrame({"rep": ids, "links": (hit @ part["weight"].to_numpy()[s : s + 1024]).astype("int64")})

    true = (
        bounded_batches(reps.select("label", "dim", "rep", "weight", "v"))
        .mapInPandas(brute, "rep bigint, links bigint")
        .groupBy("rep")
        .agg(F.sum("links").alias("all"))
        .filter(F.col("all") > 0)
    )
    got = found.groupBy("rep").agg(F.sum("links").alias("got"))
    share_of = F.least(F.coalesce(F.col("got"), F.lit(0)) / F.col("all"), F.lit(1.0))
    each = broadcast_if_small(durable(true)).join(got, "rep", "left").join(reps.select("rep", "label"), "rep")
    sums = each.groupBy("label").agg(F.sum(share_of).alias("s"), F.count(F.lit(1)).alias("n")).collect()
    parts = [r["s"] / r["n"] for r in sums if r["n"] >= LABEL_SAMPLE]
    total = sum(r["n"] for r in sums)
    return min([sum(r["s"] for r in sums) / total, *parts]) if total else 1.0


def vector_neardups(
    df: DataFrame, threshold: float = 0.98, key: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> DataFrame:
    """One row per row of ``df``: key, n_links, component_id (smallest key reachable), kept.

    Rows link if their labels are equal and not null and their cosine is at least ``threshold``.
    Vectors that are null, empty, zero, or hold null or non-finite numbers, and vectors of another
    length, link with nothing; rows with a null key neither, they have a null component and are
    kept. Equal vectors are searched for once and counted as often as they occur. An empty table
    gives an empty result; other columns are not read.
    """
    unit = stored(_unit(df, key, vector, label), "vectors")
    same = ["label", "dim", "h1", "h2"]
    reps = stored(
        unit.groupBy(*same).agg(
            F.min("id").alias("rep"), F.count(F.lit(1)).alias("weight"), F.any_value("v").alias("v")
        ),
        "vectors",
    )
    medoids = _medoids(reps)
    for widen in [*(1 << n for n in range(WIDENED + 1)), None]:
        found = _found_links(reps, medoids, widen, threshold)
        if widen is None or audited_recall(reps, found, threshold) >= LEAST_RECALL:
            break
    copies = unit.select("id", *same).join(durable(reps.filter("weight > 1").select("rep", *same)), same)
    links = found.filter("rep <> root").select(F.col("rep").alias("a"), F.col("root").alias("b"))
    reached = components(links.union(copies.filter("id <> rep").select("id", "rep")))
    per_rep = durable(found.groupBy("rep").agg(F.sum("links").alias("links")))
    per_row = (
        unit.select("id", *same)
        .join(durable(reps.select("rep", "weight", *same)), same)
        .join(per_rep, "rep")
        .groupBy("id", *same)
        .agg(F.max(F.col("links") + F.col("weight") - 1).alias("links"))
    )
    out = df.select(
        F.col(key).cast("long").alias("_key"), F.col(label).cast("string").alias("label"), F.col(vector).cast("array<double>").alias("_v")
    )
    return _with_links(out, unit, per_row, reached, key)


def _with_links(rows: DataFrame, unit: DataFrame, per_row: DataFrame, reached: DataFrame, key: str) -> DataFrame:
    """Every input row with its links; rows of one key that can't be told apart share the largest number."""
    links = durable(per_row.groupBy("id").agg(F.max("links").alias("links")))
    return (
        rows.select("_key")
        .join(links, F.col("_key") == F.col("id"), "left")
        .drop("id")
        .join(reached, F.col("_key") == F.col("id"), "left")
        .select(
            F.col("_key").alias(key),
            F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component", "_key").alias("component_id"),
            F.coalesce(F.coalesce("component", "_key") == F.col("_key"), F.lit(True)).alias("kept"),
        )
    )
