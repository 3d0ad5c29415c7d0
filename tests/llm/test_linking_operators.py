"""Jaccard join, embedding near duplicates, packing, language model, pipeline: odd inputs and brute force."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from rankloom.llm import common, jaccard_join, packing, pii, pitman_yor, quality, vector_neardup

FOLDER = "/root/testdata/sf0.001"


def smallest_reachable(ids, links):
    root = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    return root


def test_components(spark):
    r = random.Random(1)
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(r.randrange(200, 260), r.randrange(200, 260)) for _ in range(50)]
    found = {x.id: x.component for x in common.components(spark.createDataFrame(links, "a long, b long")).collect()}
    linked = {i for a, b in links if a != b for i in (a, b)}
    expected = smallest_reachable({i for l in links for i in l}, links)
    assert found == {i: expected[i] for i in linked}


def shingles(text, words):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    return {tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()


def brute_jaccard(rows, words, percent):
    sets = [(i, shingles(t, words)) for i, t in rows]
    links = [
        (a, b)
        for k, (a, x) in enumerate(sets)
        for b, y in sets[:k]
        if None not in (a, b) and x and y and 100 * len(x & y) >= percent * len(x | y)
    ]
    return sets, smallest_reachable({i for i, _ in rows if i is not None}, links)


def edited(words, n, r):
    words = list(words)
    for _ in range(n):
        words[r.randrange(len(words))] = f"e{r.randrange(10**6)}"
    return words


@pytest.mark.parametrize(("words", "percent"), [(4, 85), (5, 80), (1, 100), (2, 60)])
def test_jaccard_join(spark, words, percent):
    r = random.Random(words)
    rows = [(1000, None), (1001, ""), (1002, " \n"), (1003, "One"), (1004, "oNE"), (None, "one"), (1005, "a b c"), (1006, "A  b\tc"), (1007, "É é"), (1007, "other text of this id"), (1003, "One")]
    for g in range(25):
        size = r.choice([3, 6, 8, 12, 30, 60, 200, 400])
        base = [f"w{r.randrange(5000)}" for _ in range(size)]
        for _ in range(r.choice([2, 3, 9])):
            rows.append((len(rows), " ".join(edited(base, r.randrange(0, 1 + size // 30 + size // 12), r))))
    # Chains: each text is near the next one only.
    chain = [f"c{i}" for i in range(150)]
    for k in range(12):
        rows.append((len(rows), " ".join(chain[k * 3 : k * 3 + 110])))
    passage = " ".join(f"p{i}" for i in range(60))
    rows += [(2000 + i, f"{passage} {' '.join(f'q{i}x{j}' for j in range(5 + i))}") for i in range(30)]
    r.shuffle(rows)
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id bigint, text string, n string").repartition(3)
    sets, root = brute_jaccard(rows, words, percent)
    found = jaccard_join.jaccard_components(df, words, percent).collect()
    assert Counter((x.doc_id, x.n_shingles, x.component_id) for x in found) == Counter((i, len(s), root.get(i)) for i, s in sets)


def test_jaccard_blocks(spark, monkeypatch):
    """Large cells are cut into blocks; small centres leave them several components."""
    monkeypatch.setattr(jaccard_join, "BLOCK", 8)
    monkeypatch.setattr(jaccard_join, "CENTRES", 1)
    r = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(edited(base, r.randrange(2, 8), r))) for i in range(120)]
    found = jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id bigint, text string"), 4, 85).collect()
    _, root = brute_jaccard(rows, 4, 85)
    assert {x.doc_id: x.component_id for x in found} == root
    assert jaccard_join.jaccard_components(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_common_cells_of_small_partitions_are_spread(spark):
    """Entries that pass by the buckets don't meet in one group where every task has one slice."""
    text = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(f"{text} {i}",) for i in range(640)], "_text string").repartition(64)
    packed = jaccard_join._packed_cells(docs, 5, 80, 16).filter("bucket >= 16").collect()
    groups = Counter(x.bucket for x in packed)
    assert groups.total() == 64 and len(groups) > 8 and max(groups.values()) <= 16
    assert jaccard_join._packed_cells(docs, 5, 80, 16).filter("bucket >= 32").count() == 0


def test_cells_never_part_similar_sets():
    r = np.random.default_rng(3)
    for percent in (60, 80, 85, 95):
        cells = jaccard_join.Cells(percent)
        for _ in range(300):
            a = int(r.integers(1, 400))
            x = np.unique(r.integers(0, 2**63, a).astype(np.uint64))
            keep = int(r.integers(len(x) * percent // 100, len(x) + 1))
            y = np.unique(np.r_[r.permutation(x)[:keep], r.integers(0, 2**63, int(r.integers(0, max(1, a // 5) + 1))).astype(np.uint64)])
            shared = len(np.intersect1d(x, y))
            if shared and 100 * shared >= percent * (len(x) + len(y) - shared):
                assert set(cells.keys(x).tolist()) & set(cells.keys(y).tolist())


@pytest.mark.parametrize("percent", [50, 55, 60, 66, 67, 80])
def test_subsets_at_the_limit_share_cells(percent):
    """The smallest subset that links, whatever bands the sizes lie in."""
    r = np.random.default_rng(percent)
    for size in [*range(1, 60), *range(60, 900, 7), 500]:
        large = np.unique(r.integers(0, 1 << 63, size).astype(np.uint64) << np.uint64(1))
        small = np.sort(r.choice(large, -(-size * percent // 100), replace=False))
        cells = jaccard_join.Cells(percent)
        assert np.intersect1d(cells.keys(large), cells.keys(small)).size, (size, len(small))


def test_small_subset_is_linked(spark):
    rows = [(1, " ".join(f"x{i}" for i in range(300))), (2, " ".join(f"x{i}" for i in range(500)))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = jaccard_join.jaccard_components(df, 1, 60).collect()
    assert {x.doc_id: x.component_id for x in found} == {1: 1, 2: 1}


def vectors(r, n, dims=16):
    rows, label = [], 0
    while len(rows) < n:
        v = r.normal(size=dims)
        for _ in range(int(r.choice([1, 1, 2, 30]))):
            rows.append((len(rows), (v + r.normal(size=dims) * r.choice([0, 0.02, 0.05])).tolist(), label % 3))
        label += 1
    return rows


def brute_vectors(rows, threshold):
    ok = [(i, v, l) for i, v, l in rows if i is not None and l is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    links = [
        (a, b)
        for k, (a, x, l) in enumerate(ok)
        for b, y, m in ok[:k]
        if l == m and len(x) == len(y) and np.dot(x, y) / math.sqrt(np.dot(x, x) * np.dot(y, y)) >= threshold
    ]
    return Counter(i for pair in links for i in pair), smallest_reachable({i for i, _, _ in rows if i is not None}, links)


@pytest.mark.parametrize("shard", [2048, 40])
def test_vector_neardups(spark, monkeypatch, shard):
    monkeypatch.setattr(vector_neardup, "SHARD", shard)
    monkeypatch.setattr(vector_neardup, "BLOCK", 4096 if shard > 100 else 60)
    nan = float("nan")
    rows = vectors(np.random.default_rng(7), 400)
    rows += [(900, None, 1), (901, [0.0] * 16, 1), (902, [nan] * 16, 1), (903, [None] + [1.0] * 15, 1), (904, [], 1), (905, rows[0][1], None), (906, [1.0, 2.0], 0), (907, [2.0, 4.0], 0), (908, rows[0][1], rows[0][2]), (None, rows[0][1], 0), (909, [math.inf] * 16, 1)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id bigint, embedding array<float>, label int, links string")
    single = [(i, v and [x if x is None else float(np.float32(x)) for x in v], l) for i, v, l in rows]
    n_links, root = brute_vectors(single, 0.98)
    found = vector_neardup.vector_neardups(df, 0.98).collect()
    assert len(found) == len(rows)
    for x in found:
        assert (x.n_links, x.component_id) == (n_links[x.vec_id], root.get(x.vec_id)), x
        assert x.kept == (x.vec_id is None or x.vec_id == root[x.vec_id])
    assert vector_neardup.vector_neardups(df.limit(0)).count() == 0


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_best_fit_keeps_every_capacity(rule):
    r = np.random.default_rng(2)
    length = r.integers(1, 100, 500)
    cost = length.astype(float) ** 2
    bins, offsets, order = packing.best_fit(length, cost, (100, 5, 6000), (1.0, 0.5, 0.5), rule)
    for b in np.unique(bins):
        at = [i for i in order if bins[i] == b]
        assert length[at].sum() <= 100 and len(at) <= 5 and (cost[at].sum() <= 6000 or len(at) == 1)
        assert offsets[at].tolist() == np.r_[0, np.cumsum(length[at])[:-1]].tolist()


def test_packing(spark, monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(packing, "GROUP_TOKENS", 3000)
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    texts = ["", None, "a b", "It's Ünïcode\x1e \x1e <|endoftext|>x <|STARTOFTEXT|>́ é", "\x1e", "word " * 700, "x" * 900, "同じ 123"]
    rows = [(i, t) for i, t in enumerate(texts)] * 2 + [(None, "no id")] + [(100 + i, f"text {i} " * (i % 40)) for i in range(150)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, length string")
    packed = packing.pack(packing.token_pieces(df, path, 256, with_ids=True), 256, attention=256 * 256).collect()
    expected = Counter()
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids + [1]
        for k in range(0, len(ids), 256):
            part = ids[k : k + 256]
            expected[(i, k // 256, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes()), tuple(part))] += 1
    assert Counter((p.doc_id, p.piece, p.start, p.length, p.ids_crc32, tuple(p.ids)) for p in packed) == expected
    sequences = {}
    for p in packed:
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 256
    assert len(sequences) <= 1.1 * sum(p.length for p in packed) / 256 + 1
    assert packing.pack(packing.token_pieces(df.limit(0), path)).count() == 0


def test_language_model(spark, monkeypatch):
    monkeypatch.setattr(pitman_yor, "SHARE", 0.02)
    monkeypatch.setattr(pitman_yor, "SHARD_TOKENS", 2000)
    r = random.Random(4)
    words = [f"W{int(r.paretovariate(0.8))}" for _ in range(400)]
    follow = {w: r.sample(words, 3) for w in words}
    rows = [(None, None), (1, ""), (1, ""), (2, "UNSEEN word"), (3, None)]
    for i in range(10, 300):
        text = [r.choice(words)]
        while len(text) < 60:
            text.append(r.choice(follow[text[-1]]) if r.random() < 0.8 else r.choice(words))
        rows.append((i, " ".join(text)))
    df = spark.createDataFrame([(*x, "y") for x in rows], "doc_id bigint, text string, score string").repartition(3)
    found = pitman_yor.score_documents(df).collect()
    tokens = [(i, re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower()) + ["\n"]) for i, t in rows]
    held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 5 == 1
    count = Counter(w for i, x in tokens if not held(i) for w in x)
    total = count.total()
    base = lambda x: sum(math.log10((count[w] + 0.5) / (total + 0.5 * (len(count) + 1))) for w in x)
    expected = sorted(((i, held(i), len(x), sum(count[w] > 0 for w in x), total, round(base(x), 6)) for i, x in tokens), key=lambda v: (v[0] is None, v[0] or 0, v[2:]))
    got = sorted(((x.doc_id, x.held_out, x.n_tokens, x.n_known, x.train_tokens, round(x.base_score, 6)) for x in found), key=lambda v: (v[0] is None, v[0] or 0, v[2:]))
    assert got == expected
    held_rows = [x for x in found if x.held_out and x.n_tokens > 2]
    assert sum(x.score for x in held_rows) > sum(x.base_score for x in held_rows) + 0.05 * sum(x.n_tokens for x in held_rows)
    assert all(x.score < 0 for x in found)
    assert pitman_yor.score_documents(df.limit(0)).count() == 0


def test_probabilities_sum_to_one(spark, monkeypatch):
    """Over all words and the unknown one, behind every context and behind none."""
    monkeypatch.setattr(pitman_yor, "SHARE", 0.05)
    r = random.Random(9)
    rows = [(i, " ".join(f"w{int(r.paretovariate(1))}" for _ in range(30))) for i in range(60)]
    docs = spark.createDataFrame(rows, "_key bigint, _text string")
    chunks, samples, models, width = pitman_yor.fitted(docs)
    model, state = models[-1], samples[-1].collect()
    blobs = [x.orders for x in chunks.filter("shard >= 0").collect()]
    assert len(state) == 1 and width > 3
    orders = pitman_yor.Orders.gathered(blobs, width)
    rng = np.random.default_rng(0)
    hot, total = orders.context > 0, np.bincount(orders.owner, orders.count)
    tables = (hot & (orders.count == 1)).astype(float)
    tables[hot & (orders.count > 1)] = pitman_yor.Seats.load(state[0].seats, rng).tables
    root = (total == 1).astype(float)
    root[total > 1] = pitman_yor.Seats.load(state[0].root, rng).tables
    guests = np.bincount(orders.owner, orders.count * ~hot + tables)
    parent = model.parent(guests, root)
    unknown = float(model.parent(np.array([0.0]), np.array([0.0]))[0])
    assert parent[total > 0].sum() + unknown == pytest.approx(1)
    for c in range(1, width):
        customers, seats = np.zeros(len(parent)), np.zeros(len(parent))
        own = orders.context == c
        customers[orders.owner[own]], seats[orders.owner[own]] = orders.count[own], tables[own]
        p = model.child(np.full(len(parent), c), customers, seats, parent)[total > 0].sum()
        assert p + model.child(np.array([c]), np.zeros(1), np.zeros(1), np.array([unknown]))[0] == pytest.approx(1)


def test_every_word_has_a_restaurant(spark, monkeypatch):
    """Pairs of words that hold a small share of the tokens count, in any layout and number of shards."""
    r = random.Random(5)
    follow = {i: r.randrange(6000) for i in range(6000)}
    rows = [(i, " ".join(f"a{j} b{follow[j]}" for j in r.sample(range(6000), 300))) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    gains = []
    for parts, tokens in ((1, 4_000_000), (7, 4_000_000), (3, 9_000)):
        monkeypatch.setattr(pitman_yor, "SHARD_TOKENS", tokens)
        found = pitman_yor.score_documents(df.repartition(parts)).collect()
        held = [x for x in found if x.held_out]
        gains.append(sum(x.score - x.base_score for x in held) / sum(x.n_tokens for x in held))
    assert min(gains) > 0.5 and max(gains) - min(gains) < 0.05
    docs = df.select(df.doc_id.alias("_key"), df.text.alias("_text"))
    words = {w for i, t in rows if zlib.crc32(str(i).encode()) % 5 != 1 for w in t.split()}
    _, _, models, width = pitman_yor.fitted(docs)
    customers = models[-1].customers[np.arange(1, width)]
    assert (customers > 0).sum() == len(words) + 1 and customers.sum() == models[-1].tokens


def test_sweeps_pass_over_all_customers():
    """Numbers of tables follow their exact distribution, and those of large dishes change with every sweep."""
    rng, d, f = np.random.default_rng(3), 0.7, 0.9
    for c in (2, 3, 6, 12):
        stirling = np.zeros((c + 1, c + 2))
        stirling[0, 0] = 1
        for n in range(c):
            for k in range(1, n + 2):
                stirling[n + 1, k] = stirling[n, k - 1] + max(n - d * k, 0) * stirling[n, k]
        exact = stirling[c, : c + 1] * f ** np.arange(c + 1)
        guests, fresh = np.full(40000, c), np.full(40000, f)
        seats = None
        for _ in range(12):
            seats = pitman_yor.reseated(seats, guests, fresh, d, rng)
        got = np.bincount(seats.tables, minlength=c + 1) / 40000
        assert np.abs(got - exact / exact.sum()).max() < 0.012
    guests, fresh = np.full(300, 200_000), np.full(300, 2.0)
    one = pitman_yor.reseated(None, guests, fresh, d, rng)
    two = pitman_yor.reseated(one, guests, fresh, d, rng)
    changed = (one.tables != two.tables).mean()
    assert changed > 0.25, changed  # two customers of 200,000 would change hardly any


def test_seats_stay_whole():
    rng = np.random.default_rng(1)
    guests = rng.integers(1, 3000, 200)
    seats = pitman_yor.Seats(np.zeros(0, int), np.zeros(200, int), rng)
    fresh = rng.random(200) * 3
    seats.seat(guests, fresh, 0.7)
    for _ in range(5):
        rows = np.flatnonzero(guests > 1)
        seats.remove(rows)
        seats.add(rows, fresh[rows], 0.7)
        assert (seats.sizes > 0).all() and seats.tables.sum() == len(seats.sizes)
        owner = np.repeat(np.arange(200), seats.tables)
        assert (np.bincount(owner, seats.sizes, 200) == guests).all()
    again = pitman_yor.Seats.load(seats.dump(), rng)
    assert (again.sizes == seats.sizes).all() and (again.tables == seats.tables).all()


def test_pipeline(spark):
    """Each stage against a brute-force version on the whole smallest tables."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = docs.collect()
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "jaccard_join", "pseudonyms", "best_fit_packing"]
    judged = quality.quality_rules(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    kept = {x.doc_id for x in judged.filter("kept").collect()}
    first = corpus_pipeline.quality(spark, docs, FOLDER)
    assert first.columns == docs.columns and {x.doc_id for x in first.collect()} == kept
    stay = [x for x in rows if x.doc_id in kept]
    _, root = brute_jaccard([(x.doc_id, x.text) for x in stay], 5, 80)
    second = corpus_pipeline.near_duplicates(spark, first, FOLDER)
    left = [x for x in stay if root[x.doc_id] == x.doc_id]
    assert second.columns == docs.columns and sorted(x.doc_id for x in second.collect()) == sorted(x.doc_id for x in left)
    third = corpus_pipeline.pseudonyms(spark, second, FOLDER).collect()
    expected = {x.doc_id: pii.pseudonymised(x.text, corpus_pipeline.PSEUDONYM_KEY)[0] for x in left}
    assert {x.doc_id: x.text for x in third} == expected and all(x.n_chars == len(x.text) for x in third)
    pieces = corpus_pipeline.run(spark, FOLDER).collect()
    assert {p.doc_id for p in pieces} == set(expected)
    lengths = Counter()
    for p in pieces:
        lengths[p.sequence_id] += p.length
    assert max(lengths.values()) <= 4096 and len(lengths) <= 1.05 * sum(lengths.values()) / 4096 + 1
