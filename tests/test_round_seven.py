import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from rankloom.catalog import search
from rankloom.functions.stem import STEP_2, STEP_3, STEP_4, stem_of, stemmed
from rankloom.operators import analysis, index, queries
from rankloom.operators.analysis import Analyzer
from rankloom.plans.search import MAX_RESULTS

CHAIN = Analyzer(stop=["the"])
TEXTS = [
    ("D1", "text", "The apples apple, the Apple's PEARS relational"), ("D1", "headline", "apples"),
    ("D2", "text", "pears pear the apples"), ("D2", "text", "pear the apple apple plum"),
    (None, "text", "plums"), (None, "text", "plum fig"), ("D3", "text", "the"), ("D4", "text", ""),
]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def table(spark, rows=TEXTS):
    return spark.createDataFrame(rows, "docno string, field string, text string")


def by_vocabulary(texts):
    """Entries as before: words meet the stems in a join, and those of one stem in a shuffle."""
    keys = ["docno", "field"]
    return analysis.stemmed_entries(analysis.entries(analysis.text_words(texts, *keys, analyzer=CHAIN), *keys), *keys)


def test_topk_run_keeps_the_results_of_the_reference(spark, tmp_path):
    """Ten per topic were kept before, of a thousand."""
    docs = [(i, f"wool\nSheep give wool{' and milk' * i}.", "en", "ft", 20) for i in range(12)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, "Sheep and wool.")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    found = contract.queries()["topk_run"](spark, str(tmp_path)).collect()
    assert sorted(r["rank"] for r in found) == list(range(1, 13))
    assert f"rank <= {MAX_RESULTS}" in contract.oracle_sql()["topk_run"]


def test_stems_of_words_are_those_of_the_expressions(spark):
    starts = ["", "a", "y", "by", "sky", "rel", "hopp", "fall", "agr", "crée", "b漢", "x_", "o'n"]
    ends = [*STEP_2, *STEP_3, *STEP_4.split("|"), "s", "es", "ies", "sses", "ed", "ing", "eed", "y", "e", "ll", "sion", "tion", "at", ""]
    words = {a + b + c for a in starts for b in ends for c in ("", "s", "ed", "ing", "e", "ly") if a + b + c}
    found = stemmed(spark.createDataFrame([(w,) for w in sorted(words)], "term string")).collect()
    assert [(w, s) for w, s in found if stem_of(w) != s] == [] and len(found) == len(words)


def test_postings_leave_their_text_without_a_shuffle(spark):
    """All words of all texts were shuffled; now only those of texts that share their keys."""
    alone = table(spark, TEXTS[:2])
    found = index.text_postings(alone, "docno", "field", analyzer=CHAIN)
    assert "Exchange" not in plan_of(found)
    rows = {(r.field, r.term, r.tf, tuple(r.positions)) for r in found.collect()}
    assert rows == {("text", "appl", 3, (1, 2, 4)), ("text", "pear", 1, (5,)), ("text", "relat", 1, (6,)), ("headline", "appl", 1, (0,))}
    found = index.text_postings(table(spark), "docno", "field", analyzer=CHAIN).drop("tf")
    assert sorted(map(str, found.collect())) == sorted(map(str, by_vocabulary(table(spark)).collect()))


def test_a_full_index_keeps_the_keys_it_made(spark):
    docs = spark.createDataFrame([(None, "fig", "apples"), (None, "fig", "apples pears")], "docno string, headline string, text string")
    tables = index.full_index(docs.repartition(3), CHAIN)
    joined = tables["postings"].join(tables["doc_len"], ["doc_key", "field"])
    assert joined.filter("field = 'text'").agg(F.sum("tf"), F.max("dl")).first() == (3, 2)


def test_analysed_texts_are_not_shuffled(spark):
    """Every token went through two shuffles."""
    found = analysis.analyze(table(spark, TEXTS[:2]), "docno", "field", analyzer=CHAIN)
    assert "Exchange" not in plan_of(found)
    assert {(r.field, tuple(r.terms)) for r in found.collect()} == {("text", ("appl", "appl", "appl", "pear", "relat")), ("headline", ("appl",))}
    found = {(r.docno, r.field): r.terms for r in analysis.analyze(table(spark), "docno", "field", analyzer=CHAIN).collect()}
    expected = {}
    for r in by_vocabulary(table(spark)).collect():
        expected.setdefault((r.docno, r.field), []).extend((p, r.term) for p in r.positions)
    assert found == {k: [t for _, t in sorted(v)] for k, v in expected.items()}


def test_phrases_of_common_words_start_from_neighbours(spark, monkeypatch):
    """With many phrases of common words, every text with a phrase's rarest word was a row for that phrase."""
    texts = [(f"d{i}", "text", w) for i in range(30) for w in (f"a b c d a b{' e' * (i % 3)} c a",)]
    texts += [("d1", "text", "c a b"), (None, "text", "a b c"), ("d9", "headline", "a b"), ("e", "text", "c a b a a b c d")]
    tokens = [(d, f, p, t) for d, f, w in texts for p, t in enumerate(w.split())]
    tokens = spark.createDataFrame(tokens, "docno string, field string, pos int, term string")
    phrases = [[(0, a), (n, b)] for a in "abcd" for b in "abcd" for n in (0, 1, 2)]
    phrases += [[(0, "a")], [(0, "zz"), (1, "a")], [(0, "c"), (1, "a"), (2, "b")], [(0, "a"), (1, "b"), (3, "d"), (4, "a")], phrases[0]]
    phrases = [(f"q{i}", "title", "text", 1.0, p, t, len(x)) for i, x in enumerate(phrases) for p, t in x]
    phrases = spark.createDataFrame(phrases, "qid string, clause string, field string, weight double, pos int, term string, size long")
    made = []
    paired = queries.neighbours
    monkeypatch.setattr(queries, "neighbours", lambda *a: made.append(paired(*a)) or made[-1])
    found = sorted(map(str, queries.phrase_match(phrases, tokens).collect()))
    words = phrases.select("qid", "clause", "field", F.col("pos").alias("offset"), "term", "size")
    met = tokens.join(words, ["field", "term"]).groupBy("qid", "clause", "size", "docno", F.expr("pos - offset")).count()
    expected = met.filter("count = size").groupBy("qid", "clause", "docno").agg(F.count("*").alias("freq"))
    assert found == sorted(map(str, expected.collect()))
    assert made and made[0].filter("apart = 1").count() < tokens.count()


def test_halves_of_a_stream_are_read_by_many_tasks(spark, tmp_path, monkeypatch):
    """Each half was one file, whose texts one task analysed."""
    spark.range(100).selectExpr("id AS doc_id", "concat('wool ', id) AS text").write.parquet(str(tmp_path / "documents.parquet"))

    def arrived(spark, source, schema, to_docs, *others, files_per_batch, **more):
        assert files_per_batch >= 4 and spark.read.parquet(source).count() == 100
        assert len(spark.read.parquet(source).inputFiles()) == 2 * files_per_batch
        raise InterruptedError

    monkeypatch.setattr(search, "stream_into_index", arrived)
    with pytest.raises(InterruptedError):
        search.append_index(spark, str(tmp_path))


def test_stored_rows_of_a_document_lie_together(spark):
    """Scores of a document were summed after a shuffle, as its rows were joined with lengths by field."""
    rows = [(f"k{i}", f"d{i % 3}", f, t, 1, [p]) for i in range(6) for p, t in enumerate("abcdx") for f in ("headline", "text")]
    lengths = [(f"k{i}", f"d{i % 3}", f, 5) for i in range(6) for f in ("headline", "text")]
    rows = spark.createDataFrame(rows, "doc_key string, docno string, field string, term string, tf long, positions array<int>")
    lengths = spark.createDataFrame(lengths, "doc_key string, docno string, field string, dl long")
    vocabulary = spark.createDataFrame([(t,) for t in "abcdz"], "term string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = index.index_of_tables(rows.repartition(8), lengths, vocabulary)
        places = found.matched.select("doc_key", F.spark_partition_id().alias("at")).distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert places == 6
    assert sorted(map(tuple, found.matched.drop("dl").collect())) == sorted(map(tuple, rows.filter("term <> 'x'").collect()))
    assert {r.dl for r in found.matched.collect()} == {5} and {(r.df, r.ctf) for r in found.term_stats.collect()} == {(6, 6)}
