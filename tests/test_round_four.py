import itertools

from pyspark.sql import functions as F

from rankloom.functions.text import FAST_WORD, WORD, fold_tables, folded, words
from rankloom.operators.analysis import Analyzer, text_lengths
from rankloom.operators.index import index_of_tables
from rankloom.operators.prefs import Preferences
from rankloom.operators.queries import phrase_match


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_fast_words_are_the_words(spark):
    signs = ["a", "é", "7", "_", ".", "'", ",", ":", "·", "́", " ", "漢", "-", "٣"]
    texts = ["".join(x) for n in (1, 2, 3, 4) for x in itertools.product(signs, repeat=n)]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(8)
    fast, slow = (F.regexp_extract_all("text", F.lit(p), F.lit(0)) for p in (FAST_WORD, WORD))
    assert df.filter(fast != slow).count() == 0


def test_folding_of_signs_that_stand_for_several(spark):
    single, plain, several = fold_tables()
    text = "Größe " + "".join(several) + " " + single + " Æon ÉTÉ 1½"
    df = spark.createDataFrame([(text,), ("Plain Words",), ("",), (None,)], "text string")
    expected = text.lower().translate(str.maketrans(single, plain))
    for sign, letters in several.items():
        expected = expected.replace(sign, letters)
    assert [r[0] for r in df.select(folded(F.col("text"))).collect()] == [expected, "plain words", "", None]
    assert [r[0] for r in df.select(words(F.col("text"))).collect()][1:] == [["Plain", "Words"], [], None]


def test_lengths_cut_each_text_once(spark):
    df = spark.createDataFrame([(1, "one two"), (2, "..."), (3, None)], "id int, text string")
    found = text_lengths(df, "id", analyzer=Analyzer())
    assert found.collect() == [(1, 2)]
    assert plan_of(found).count("translate(") == 1  # the filter on dl folded and cut it again before


def test_phrases_are_searched_from_their_rarest_word(spark):
    common = [(f"d{i}", "text", "of", [0, 2, 4]) for i in range(300)]
    rare = [("d7", "text", "moon", [5]), (None, "text", "of", [0]), (None, "text", "moon", [1])]
    rows = spark.createDataFrame([*common, *rare], "docno string, field string, term string, positions array<int>")
    phrases = [
        (q, "title", "text", 1.0, p, t, 2) for q in ("q1", "q2") for p, t in enumerate(["of", "moon"])
    ] + [("q3", "title", "text", 1.0, 0, "of", 2), ("q3", "title", "text", 1.0, 2, "of", 2)]
    phrases = spark.createDataFrame(phrases, "qid string, clause string, field string, weight double, pos int, term string, size long")
    found = phrase_match(phrases, rows).collect()
    expected = {(q, "title", d, 1) for q in ("q1", "q2") for d in ("d7", None)} | {("q3", "title", f"d{i}", 2) for i in range(300)}
    assert {tuple(r) for r in found} == expected and len(found) == len(expected)
    # A row per position gives the same. Where documents share a name every occurrence counts, as ever.
    tokens = rows.select("docno", "field", "term", F.explode("positions").alias("pos"))
    assert {tuple(r) for r in phrase_match(phrases, tokens).collect()} == expected
    words = phrases.select("qid", "clause", "field", F.col("pos").alias("offset"), "term", "size")
    plain = tokens.union(tokens).join(words, ["field", "term"]).groupBy("qid", "clause", "size", "docno", F.expr("pos - offset"))
    plain = plain.count().filter("count = size").groupBy("qid", "clause", "docno").count()
    twice = [tuple(r) for r in phrase_match(phrases, tokens.union(tokens)).collect()]
    assert sorted(map(str, twice)) == sorted(str(tuple(r)) for r in plain.collect())


def test_a_stored_index_is_read_once(spark, tmp_path):
    rows = [("k", "d", "text", "moon", 1, [0])]
    spark.createDataFrame(rows, "doc_key string, docno string, field string, term string, tf long, positions array<int>").write.parquet(str(tmp_path / "p"))
    lengths = spark.createDataFrame([("k", "d", "text", 1)], "doc_key string, docno string, field string, dl long")
    index = index_of_tables(spark.read.parquet(str(tmp_path / "p")), lengths, spark.createDataFrame([("moon",)], "term string"))
    assert "FileScan" not in plan_of(index.matched) + plan_of(index.term_stats)
    assert index.matched.count() == 1 and index.term_stats.first()["df"] == 1


def test_pairs_of_levels_are_all_given(spark):
    prefs = [("q", "g", "s", f"d{i}", float(level)) for i, level in enumerate([0, 0, 1, 3, 3, 3])]
    prefs = spark.createDataFrame(prefs, "qid string, jg string, jsg string, docno string, rel_level double")
    run = spark.createDataFrame([("q", "d0", 1.0)], "qid string, docno string, score double")
    rows = Preferences(run, prefs).explicit().select("level", "below", "pairs").collect()
    assert {tuple(r) for r in rows} == {(1.0, 0.0, 2), (3.0, 0.0, 6), (3.0, 1.0, 3)}
