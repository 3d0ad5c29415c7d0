"""Cases that once lost results or crashed: long chains, lost links, clashing column names."""

import random

import numpy as np
import pytest

from rankloom.llm import common, vector_neardup


@pytest.mark.parametrize("n", [70, 3000])
def test_components_of_long_chains(spark, n):
    order = [*range(1, n), 0]  # the smallest id is at the far end
    links = list(zip(order, order[1:]))
    random.Random(2).shuffle(links)
    found = common.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.id for r in found} == set(range(n)) and {r.component for r in found} == {0}


def _mixed_label(n_copies, n_pairs, dims, seed):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=dims)
    copies = centre + 0.02 * np.linalg.norm(centre) / np.sqrt(dims) * rng.normal(size=(n_copies, dims))
    ones = rng.normal(size=(n_pairs, dims))
    twos = ones + 0.05 * rng.normal(size=(n_pairs, dims))
    return np.concatenate([copies, ones, twos])


@pytest.mark.parametrize("labels", [1, 3])
def test_pairs_beside_a_large_group_are_found(spark, labels):
    parts = [_mixed_label(1500 // labels, 250 // labels, 64, 1 + k) for k in range(labels)]
    rows = [(k * 10_000 + i, v.tolist(), k) for k, x in enumerate(parts) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label bigint")
    found = {r.vec_id: (r.n_links, r.component_id) for r in vector_neardup.vector_neardups(df).collect()}
    for k, x in enumerate(parts):
        unit = x / np.linalg.norm(x, axis=1, keepdims=True)
        near = unit @ unit.T >= 0.98
        np.fill_diagonal(near, False)
        assert [found[k * 10_000 + i][0] for i in range(len(x))] == near.sum(axis=1).tolist()


def test_low_recall_leads_to_whole_comparison(spark, monkeypatch):
    x = _mixed_label(200, 60, 16, 4)
    df = spark.createDataFrame([(i, v.tolist(), "a") for i, v in enumerate(x)], "vec_id bigint, embedding array<double>, label string")
    used = []
    real = vector_neardup._found_links

    def watched(reps, medoids, widen, threshold):
        used.append(widen)
        found = real(reps, medoids, widen, threshold)
        return found if widen is None else found.withColumn("links", found["links"] * 0)

    monkeypatch.setattr(vector_neardup, "_found_links", watched)
    monkeypatch.setattr(vector_neardup, "SHARD", 32)
    found = {r.vec_id: r.n_links for r in vector_neardup.vector_neardups(df).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.98
    np.fill_diagonal(near, False)
    assert used == [1, 2, None] and [found[i] for i in range(len(x))] == near.sum(axis=1).tolist()


CLASHES = ["cell", "bytes", "rows", "prefix", "_hash", "_bytes", "_page", "_text", "_c0", "ids2", "part", "parent"]


@pytest.mark.parametrize("limit", [50, 10**9])
def test_columns_of_any_name_are_passed_on(spark, limit):
    from rankloom.llm import importance, piece_codec, sharding, token_count
    from rankloom.llm.queries import vocabulary

    rows = [(i % 20, f"some words {i} " * (1 + i % 3), *[f"{c}{i}" for c in CLASHES]) for i in range(60)]
    df = spark.createDataFrame(rows, ["doc_id", "text", *CLASHES])
    expected = sorted(r[2:] for r in rows)
    model = vocabulary("piece_bpe_32k.model")
    for done in (
        sharding.shard(df, limit=limit),
        token_count.count_tokens(df, model),
        piece_codec.encode(df, model),
        piece_codec.decode(piece_codec.encode(df, model), model),
        importance.resample(df, df.select("text")),
    ):
        assert sorted(tuple(r[c] for c in CLASHES) for r in done.collect()) == expected


def test_pages_fill_beside_a_long_row(spark):
    from rankloom.llm import sharding

    rows = [(1, "x" * 300), *[(1, "y")] * 299, *[(1, "z" * 100)] * 3]
    found = sharding.shard(spark.createDataFrame(rows, "doc_id bigint, text string"), limit=300).collect()
    assert len(found) == len(rows) and all(r.shard_bytes <= 300 for r in found)
    assert len({r.shard for r in found}) <= 6


def test_long_conversation_formats_in_proportion(spark):
    from rankloom.llm import chat

    rows = [(1, i, ("user", "assistant")[i % 3 > 0], f"text {i}") for i in range(3000)]
    out = chat.format_chats(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")).first()
    learned = [out.formatted[s.start : s.start + s.length] for s in out.loss_mask]
    assert learned == [t for _, _, r, t in rows if r == "assistant"]


def test_tree_finds_what_all_pairs_find():
    from rankloom.llm import jaccard_join

    rng = np.random.default_rng(6)
    base = [np.unique(rng.integers(0, 1 << 64, int(rng.integers(1, 300)), dtype=np.uint64)) for _ in range(60)]
    sets = [np.sort(rng.permutation(b)[: max(1, len(b) - int(rng.integers(0, 1 + len(b) // 8)))]) for b in base for _ in range(6)]
    points, sizes = np.stack([jaccard_join.point_of(x) for x in sets]), np.array([len(x) for x in sets])
    tree = jaccard_join.RTree(points, sizes)
    assert len(tree.levels) >= 2 and len(tree.levels[-1][1]) == 1
    for i, x in enumerate(sets):
        found = set(tree.candidates(points[i], int(sizes[i]), 85).tolist())
        near = {j for j, y in enumerate(sets) if 100 * len(np.intersect1d(x, y)) >= 85 * len(np.union1d(x, y))}
        assert near <= found and all(jaccard_join.overlap(x, sets[j]) == len(np.intersect1d(x, sets[j])) for j in found)
        assert len(found) < len(sets) // 3


def test_long_chain_of_texts(spark):
    from rankloom.llm import jaccard_join

    words = [f"w{i}" for i in range(60 + 80 * 4)]
    texts = [" ".join(words[4 * k : 4 * k + 60]) for k in range(80)]
    order = [*range(1, 80), 0]
    df = spark.createDataFrame(list(zip(order, texts)), "doc_id bigint, text string")
    found = jaccard_join.jaccard_components(df, words=4, percent=80).collect()
    assert {r.component_id for r in found} == {0} and len(found) == 80


def test_near_duplicates_goes_by_rows(spark):
    import corpus_pipeline

    one, two, three = (" ".join(f"{c}{i}" for i in range(40)) for c in "abc")
    rows = [(2, one), (1, one + " x"), (2, two), (3, three), (3, three), (None, three), (None, one), (4, None), (5, ""), (5, ""), (None, "alone in this")]
    df = spark.createDataFrame([(i, t, "n", 7) for i, t in rows], "doc_id bigint, text string, _row string, component_id int").repartition(3)
    kept = corpus_pipeline.near_duplicates(spark, df, "")
    assert kept.columns == df.columns
    found = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    assert found == sorted([(1, one + " x"), (2, two), (3, three), (4, None), (5, ""), (5, ""), (None, "alone in this")], key=repr)
    assert corpus_pipeline.near_duplicates(spark, df.limit(0), "").count() == 0


@pytest.mark.parametrize("stage", ["quality", "pseudonyms", "packing"])
def test_stages_take_odd_tables(spark, stage):
    import corpus_pipeline

    rows = [(1, "Plain words make up this text, which has more than ten of them, mail a@example.com", 1, "s"),
            (1, "Plain words make up this text, which has more than ten of them, mail a@example.com", 1, "s"),
            (None, None, None, None), (2, "", 0, "s"), (3, "word " * 30_000, 5, "s"), (4, None, None, "s")]
    df = spark.createDataFrame([(*r, "y") for r in rows], "doc_id bigint, text string, n_chars bigint, source string, kept string")
    run = getattr(corpus_pipeline, stage)
    done = run(spark, df, "/root/testdata/sf0.001")
    found = done.collect()
    assert run(spark, df.limit(0), "/root/testdata/sf0.001").count() == 0
    if stage == "packing":
        assert sorted((r.doc_id is None, r.doc_id or 0) for r in found if r.piece == 0) == sorted((i is None, i or 0) for i, *_ in rows)
    else:
        assert done.columns == df.columns
        assert [r.kept for r in found] == ["y"] * len(found)
    if stage == "pseudonyms":
        assert len(found) == len(rows) and len({r.text for r in found if r.doc_id == 1}) == 1
        assert all("a@example.com" not in (r.text or "") for r in found)


def test_member_sets_of_repeated_rows(spark):
    from rankloom.llm import jaccard_join

    words = [f"w{i}" for i in range(40)]
    one, near, other = " ".join(words), " ".join([*words[:39], "zz"]), " ".join(f"q{i}" for i in range(30))
    rows = [(1, one), (1, one), (1, one), (2, near), (2, other), (3, other), (4, None)]
    docs = spark.createDataFrame(rows, "_key long, _text string")
    members = jaccard_join._described(docs, 5).filter("n > 0").selectExpr("id", "d1 AS d")
    sets = jaccard_join._member_sets(docs, members, 5).collect()
    found = sorted((r["id"], len(r["set"]) // 8, sum(r["point"])) for r in sets)
    assert found == [(1, 36, 36), (2, 26, 26), (2, 36, 36), (3, 26, 26)]
