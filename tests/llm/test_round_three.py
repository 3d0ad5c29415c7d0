"""Importance resampling, conversation repair and token files against brute force, and odd inputs."""

import hashlib
import math
import re
import zlib
from collections import Counter
from heapq import heappop, heappush

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from rankloom.llm import importance, token_files, turn_repair

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def grams(text, longest=2):
    w = re.findall(WORD, lowered(text or ""))
    return len(w), [" ".join(w[i : i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]


@settings(max_examples=200, deadline=None)
@given(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from(" aB9é\n.")), max_size=80), st.integers(1, 4))
def test_ngram_checksums(text, longest):
    expected = Counter(zlib.crc32(g.encode()) for g in grams(text, longest)[1])
    old = importance.PIECE_BYTES
    for importance.PIECE_BYTES in (5, old):
        assert Counter(c for _, found in importance.ngram_crcs(text, longest) for c in found) == expected


def brute_resample(rows, target, percent, min_words, buckets=10_000):
    cut = [(i, *grams(t)) for i, t in rows]
    s, t = (Counter(zlib.crc32(g.encode()) % buckets for _, own in [grams(x) for x in texts] for g in own)
            for texts in ([x for _, x in rows], target))
    all_s, all_t = s.total(), t.total()
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets))))
    out = []
    for i, n_words, own in cut:
        weight = sum(gain(zlib.crc32(g.encode()) % buckets) for g in own) // len(own) if own else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, n_words, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[3], r[2], r[1]))
    drawn = able[: percent * len(able) // 100]
    return Counter((r, k) for k, r in enumerate(drawn, 1)) + Counter((r, None) for r in (Counter(out) - Counter(drawn)).elements())


@pytest.mark.parametrize("limit", ["2000000", "5"])
def test_resample(spark, limit):
    spark.conf.set("rankloom.groupRows", limit)
    try:
        texts = [f"This is text number {i % 17} with Wörds {i % 5}, {i}!" for i in range(120)]
        rows = [(i % 90, t) for i, t in enumerate(texts)] + [(1, None), (None, "no id " * 9), (7, ""), (8, "same text here " * 4)] * 3
        rows += [(9, "Long " * 40_000)]
        target = ["text number 3 with wörds", None, "", "same text here again"]
        docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id bigint, text string, score int, `a b` string")
        to = spark.createDataFrame([(t,) for t in target], "text string")
        found = importance.resample(docs, to, percent=40, min_words=5).collect()
        got = Counter(((r.doc_id, r.n_words, r.n_features, r.weight, r.score), r["rank"]) for r in found)
        assert got == brute_resample(rows, target, 40, 5)
        assert "a b" in found[0] and "text" not in found[0]
        assert importance.resample(docs, to, keep_text=True).columns[:3] == ["doc_id", "text", "a b"]
        assert importance.resample(docs.limit(0), to).count() == 0
        assert importance.resample(docs, to.limit(0)).count() == len(rows)
    finally:
        spark.conf.unset("rankloom.groupRows")


def brute_edits(symbols):
    """Cheapest edits by search over (cost, audit), which falls to the ASCII-least first."""
    heap, done = [(0, "", 0, turn_repair.START)], set()
    while heap:
        cost, audit, i, q = heappop(heap)
        if (i, q) in done:
            continue
        if i == len(symbols) and q in (turn_repair.START, turn_repair.ASSISTANT):
            return cost, audit
        done.add((i, q))
        fits = {0: 2, 1: 2, 2: 3, 3: 2}[q]
        heappush(heap, (cost + 5, audit + "I", i, fits))
        if i < len(symbols):
            s = symbols[i]
            heappush(heap, (cost + 2, audit + "D", i + 1, q))
            if s != "-":
                more = 5 if s.isupper() else 0
                after = {"s0": 1, "u0": 2, "u1": 2, "u3": 2, "a2": 3}.get(f"{s.lower()}{q}")
                if after is not None:
                    heappush(heap, (cost + more, audit + "K", i + 1, after))
                heappush(heap, (cost + more + 1, audit + "R", i + 1, fits))


@settings(max_examples=500, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("suaoSUAO-"), st.integers(1, 9)), max_size=7))
def test_cheapest_edits(runs):
    symbols = "".join(s * n for s, n in runs)
    assert turn_repair.cheapest_edits(turn_repair.runs_of(runs)) == brute_edits(symbols)


def test_long_runs_are_not_walked():
    cost, audit = turn_repair.cheapest_edits([("u", 1 << 20), ("a", (1 << 20) + 1), ("-", 1 << 20)])
    assert len(audit) == 3 * (1 << 20) + 1 + audit.count("I") and audit.endswith("D" * (1 << 20))
    assert cost < 3 * (1 << 20) + 1 + 2 * (1 << 20)


def brute_repair(rows):
    """Report and lines of one conversation by the definition."""
    rows = sorted(((t, r or " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, symbols, counts = set(), "", Counter()
    for _, r, x in rows:
        own = re.findall(r"[^\x20\x09-\x0D]", x)
        fault = "blank" if not own else "duplicate" if (r, x) in seen else "truncated" if own[-1] not in ".!?" else ""
        seen.add((r, x))
        counts[fault] += 1
        initial = r[:1] if r[:1] in tuple("sua") else "o"
        symbols += "-" if fault in ("blank", "duplicate") else initial.upper() if fault else initial
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit = brute_edits(symbols)
    left, n, i = [], len(audit.replace("D", "")), 0
    for mark in audit:
        row = None if mark == "I" else rows[i]
        i += mark != "I"
        if mark != "D":
            fit = "user" if (len(left) + n) % 2 == 0 else "assistant"
            left.append((row[1] if mark == "K" else fit, row[2] if row else ""))
    return (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit), left


@pytest.mark.parametrize("limit", ["2000000", "5"])
def test_repair(spark, limit):
    rng = np.random.default_rng(3)
    texts = ["Yes.", "No", "", " ", None, "What?\n", "ends ", " ", "So be it! "]
    roles = ["user", "assistant", "system", "tool", "", None]
    rows = []
    for c in range(60):
        for _ in range(int(rng.integers(0, 9))):
            rows.append((None if c == 7 else c, int(rng.integers(0, 9)) if rng.random() > 0.1 else None, roles[rng.choice(6, p=[0.35, 0.35, 0.1, 0.1, 0.05, 0.05])], texts[rng.integers(0, 9)]))
    rows += [(99, i // 3, "user" if i % 2 else "assistant", f"Turn {i}.") for i in range(50)] + [(98, 4, "user", "Same.")] * 30
    spark.conf.set("rankloom.groupRows", limit)
    try:
        df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id bigint, turn bigint, role string, text string, place string")
        reports, lines = turn_repair.repair(df)
        found, left = {r.conv_id: tuple(r)[1:] for r in reports.collect()}, lines.collect()
        assert reports.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
        expected = {c: brute_repair([r[1:] for r in rows if r[0] == c]) for c in {r[0] for r in rows}}
        assert found == {c: e[0] for c, e in expected.items()}
        for c, (_, turns) in expected.items():
            assert [(r.role, r.text) for r in sorted((r for r in left if r.conv_id == c), key=lambda r: r.place)] == turns
        digests = {r.conv_id: r.repaired_sha256 for r in turn_repair.line_digests(lines).collect()}
        assert digests == {c: hashlib.sha256("\n".join(f"{r}:{x}" for r, x in t).encode()).hexdigest() for c, (_, t) in expected.items() if t}
        reports, lines = turn_repair.repair(df.limit(0))
        assert reports.count() == lines.count() == turn_repair.repair_digests(df.limit(0)).count() == 0
        assert turn_repair.repair_digests(df).count() == len(expected)
    finally:
        spark.conf.unset("rankloom.groupRows")


@pytest.mark.parametrize("n", [0, 1, 2, 63, 64, 5000])
def test_perfect_hash(n):
    rng = np.random.default_rng(n)
    one, two, other = (rng.integers(0, 1 << 63, n + 100, dtype=np.uint64) for _ in range(3))
    hashed = token_files.PerfectHash.of(one[:n], two[:n])
    assert sorted(hashed.numbers(one[:n], two[:n]).tolist()) == list(range(n))
    fields = {f: np.arange(n) * 3 for f in ("shard", "start", "length", "copies")}
    data = token_files.index_bytes(one[:n], two[:n], fields)
    there, found = token_files.index_lookup(data, one, two)
    assert there.tolist() == [True] * n + [False] * 100
    assert found["start"][:n].tolist() == (np.arange(n) * 3).tolist()
    assert not token_files.index_lookup(data, one[:n], other[:n])[0].any()
    with pytest.raises(ValueError):
        token_files.PerfectHash.of(np.zeros(2, np.uint64), np.zeros(2, np.uint64))


@pytest.mark.parametrize("shard_text", [64 << 20, 300])
def test_token_files(spark, tmp_path, shard_text):
    rows = [(i, f"Some text {i} with é and\nlines " * (i % 4)) for i in range(60, 0, -1)]
    rows += [(5, "again"), (5, "again"), (5, None), (7, "x " * 30_000), (None, "no key"), (None, None), (-3, ""), (8, '1 " <|endoftext|>')]
    rows += [(9, "copies")] * 40
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id bigint, text string, start int, _name string")
    folder = str(tmp_path / "files")
    token_files.write_documents(docs, folder, VOCABULARY, shard_text=shard_text)
    model = Tokenizer.from_file(VOCABULARY)
    ids = {t: [*model.encode(t or "", add_special_tokens=False).ids, 1] for _, t in rows}
    keys = spark.createDataFrame([(i,) for i in {r[0] for r in rows}] + [(1000,), (1000,), (60,)], "doc_id bigint")
    found = token_files.read_documents(keys, folder, with_ids=True).collect()
    assert Counter(r.doc_id for r in found) == Counter(i for i, _ in rows) + Counter([1000, 1000, 60])
    there = sorted({(r.start, r.doc_id, tuple(r.ids), r.ids_crc32) for r in found if r.ids is not None}, key=lambda r: r[0])
    assert Counter((i, t) for _, i, t, _ in there) == Counter((i, tuple(ids[t])) for i, t in rows)
    order = [i for _, i, _, _ in there]
    assert order == sorted(order, key=lambda i: (i is not None, i))
    assert [s for s, *_ in there] == np.cumsum([0, *[len(t) for _, _, t, _ in there[:-1]]]).tolist()
    assert all(crc == zlib.crc32(np.array(t, "<u4").tobytes()) for _, _, t, crc in there)
    assert [r.start for r in found if r.doc_id == 1000] == [None, None]
    manifest = token_files.read_manifest(folder)
    assert manifest["width"] == 2 and (len(manifest["shards"]) > 3) == (shard_text == 300)
    empty = str(tmp_path / "empty")
    token_files.write_documents(docs.limit(0), empty, VOCABULARY)
    assert token_files.read_documents(keys.limit(0), empty).count() == 0
    assert token_files.read_documents(keys, empty).filter("start is not null").count() == 0
