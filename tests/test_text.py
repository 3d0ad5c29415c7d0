"""Analysis, narratives, readers and names."""

import time

import pytest

from rankloom.functions.stem import stemmed
from rankloom.operators import analysis, queries
from rankloom.operators.analysis import Analyzer
from rankloom.operators.checks import InputError
from rankloom.operators.scoring import validate
from rankloom.plans.search import search
from rankloom.sources import corpus, judgements
from rankloom.sources.reports import run_lines, run_tag, write_report, write_run

STEMS = {
    "caresses": "caress", "ponies": "poni", "cats": "cat", "feed": "feed", "agreed": "agre",
    "plastered": "plaster", "sing": "sing", "conflated": "conflat", "sized": "size",
    "hopping": "hop", "falling": "fall", "filing": "file", "happy": "happi", "sky": "sky",
    "relational": "relat", "digitizer": "digit", "operator": "oper", "sensibiliti": "sensibl",
    "triplicate": "triplic", "hopeful": "hope", "replacement": "replac", "adoption": "adopt",
    "probate": "probat", "rate": "rate", "cease": "ceas", "controll": "control", "roll": "roll",
    "yes": "ye", "countries": "countri", "generalizations": "gener", "of": "of",
}


def test_stems(spark):
    words = spark.createDataFrame([(w,) for w in STEMS], "term string")
    assert {r.term: r.stem for r in stemmed(words).collect()} == STEMS


def test_chain(spark):
    texts = spark.createDataFrame([("d", "The U.S. court's Œuvre, naïve RUNNING x " + "y" * 21)], "k string, text string")
    found = analysis.analyze(texts, "k", analyzer=Analyzer(stop=["The"])).first().terms
    assert found == ["u.", "court", "oeuvr", "naiv", "run"]


def test_synonyms_keep_the_word_and_its_position(spark):
    tokens = spark.createDataFrame([("d", 0, "countries"), ("d", 1, "grow")], "k string, pos int, term string")
    table = spark.createDataFrame([("countries", "New Zealand")], "term string, synonym string")
    rows = sorted(map(tuple, analysis.expand_synonyms(tokens, table).collect()))
    assert rows == [("d", 0, "countries"), ("d", 0, "new"), ("d", 0, "zealand"), ("d", 1, "grow")]


def test_narrative(spark):
    narrative = "A relevant document must cite wool. Sheep are not relevant. Will discuss yarn!"
    topics = spark.createDataFrame([("1", "t", "", narrative)], "qid string, title string, description string, narrative string")
    row = queries.clean_narrative(topics).first()
    assert row.relevant == "A document wool. Will discuss yarn!"
    assert row.irrelevant == "Sheep ."
    assert {r.clause for r in queries.clauses(topics).collect()} == {"title", "narrative"}


def test_search_ranks_the_matching_document_first(spark):
    docs = spark.createDataFrame(
        [("d1", "wool", "sheep give wool"), ("d2", "tin", "mines give tin"), (None, "wool", "wool wool")],
        "docno string, headline string, text string",
    )
    topics = spark.createDataFrame([("1", "wools", "sheep wool", "")], "qid string, title string, description string, narrative string")
    run = search(docs.filter("docno IS NOT NULL"), topics, "BM25", phrases="analyzed")
    assert [(r.docno, r.rank) for r in run.collect()] == [("d1", 1)]
    scores = spark.createDataFrame([("1", None, 3.0), ("1", "d1", 2.0), ("1", "d2", 1.0)], "qid string, docno string, score double")
    lines = [r.line for r in run_lines(scores, run_tag("CustomAnalyzer", "BM25Similarity")).orderBy("rank").collect()]
    assert lines == ["1 Q0 d1 1 2.000000 CustomBM25", "1 Q0 d2 2 1.000000 CustomBM25"]


def test_unknown_names():
    with pytest.raises(ValueError):
        validate("PL2")
    with pytest.raises(ValueError):
        validate("BM25", "STOP")


def test_corpus_rules(spark, tmp_path):
    (tmp_path / "fb").mkdir()
    (tmp_path / "fb" / "ReadChg.txt").write_text("<DOC><DOCNO>no</DOCNO></DOC>")
    (tmp_path / "fb" / "fb01").write_text(
        "<DOC>\n<DOCNO> FB-1 </DOCNO><TI>A &amp; <b>b</b></TI><TEXT>one <H3>drop</H3>two\n</TEXT></DOC>\n"
        "<DOC><TEXT>no id</TEXT></DOC>\n"
    )
    found = [tuple(r) for r in corpus.read_corpus(spark, str(tmp_path / "fb"), "fbis").collect()]
    assert found == [("FB-1", "fbis", "A & b", "one two")]
    everything = corpus.read_corpus(spark, str(tmp_path / "fb"), "fbis", valid_only=False)
    assert corpus.skip_report(everything, "fbis").first().skipped == 1
    with pytest.raises(ValueError):
        corpus.read_corpus(spark, str(tmp_path), "xml")


def test_malformed_lines_fail(spark, tmp_path):
    path = tmp_path / "lines"
    path.write_text("1 Q0 d1 1 2.5\n\n")
    with pytest.raises(Exception, match="malformed run line"):
        judgements.read_run(spark, str(path)).collect()
    path.write_text("1 0 d1 1 extra\n")
    with pytest.raises(Exception, match="malformed judgement line"):
        judgements.read_qrels(spark, str(path)).collect()
    path.write_text("1 j d1 1\n1 j d1 2\n")
    with pytest.raises(InputError):
        judgements.read_qrels_jg(spark, str(path))


def test_writers_keep_order(spark, tmp_path):
    lines = spark.createDataFrame([("2", 1, "c"), ("1", 2, "b"), ("1", 1, "a")], "qid string, rank int, line string")
    write_run(lines, str(tmp_path / "run"))
    files = sorted((tmp_path / "run").glob("part-*"))
    assert "".join(f.read_text() for f in files).split() == ["a", "b", "c"]
    rows = spark.createDataFrame([("all", "m", "z"), ("b", "m", "y"), ("a", "m", "x")], "qid string, measure string, line string")
    write_report(rows, str(tmp_path / "report"))
    files = sorted((tmp_path / "report").glob("part-*"))
    assert "".join(f.read_text() for f in files).split() == ["x", "y", "z"]


def test_nested_elements_keep_their_text(spark):
    rows = [
        ("<div>a<div>b</div>c</div> x <DIV id='1'>d</div>", "a b c d"), ("</div>x<div>a</div>", "a"), ("none", ""),
        ("<div>a<div>b</div>", "a b"), ("<div/>x", ""), (None, ""), ("<div>1 < 2</div>", "1 < 2"),
    ]
    df = spark.createDataFrame([(m,) for m, _ in rows], "html string")
    found = corpus.extract_fields(df, "html", "title", ["div"], ["script"]).collect()
    assert [r.text for r in found] == [t for _, t in rows]


def test_depth_of_long_markup(spark):
    """Many chunks, and a megabyte of elements that are never closed in reasonable time."""
    text = "<div>" * 700 + "in" + "</div>" * 700 + "out" + "<div>x</div>"
    many = "<div>a" * 150_000
    df = spark.createDataFrame([(text,), (many,)], "html string")
    start = time.monotonic()
    found = [r.text for r in corpus.extract_fields(df, "html", "title", ["div"], []).collect()]
    assert found[0] == "in x" and found[1].split() == ["a"] * 150_000
    assert time.monotonic() - start < 60


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("1,000 a_b", ["1,000", "a_b"]),
        ("3.14 1.a a.1", ["3.14", "1", "a", "a", "1"]),
        ("a.b.c. ab.c.de", ["a.b.c", "ab.c.de"]),
        ("can't won’t o'", ["can't", "won't", "o"]),
        ("key:value 12:30", ["key:value", "12", "30"]),
        ("well-known x/y", ["well", "known", "x", "y"]),
        ("1,5a 2;3 a,b", ["1,5a", "2;3", "a", "b"]),
        ("__ _x_ _", ["_x_"]),
        ("東京abc タワー", ["東", "京", "abc", "タワー"]),
        ("ひらがな", ["ひ", "ら", "が", "な"]),
        ("l·l été", ["l·l", "été"]),
        ("  ", []),
    ],
)
def test_word_breaking(spark, text, expected):
    from pyspark.sql import functions as F

    from rankloom.functions.text import words

    df = spark.createDataFrame([(text.replace("’", "'"),)], "t string")
    assert df.select(words(F.col("t")).alias("w")).first().w == expected


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("Ｆｕｌｌ－ｗｉｄｔｈ １２", "full-width 12"),
        ("① ⑩ ⑴ ⒈ ⓐ Ⓑ ❶", "1 10 (1) 1. a b 1"),
        ("ﬁne ﬄ Œuvre Æon straße Þór", "fine ffl oeuvre aeon strasse thor"),
        ("Łódź đ ħ ŧ ø ı ŋ ſ ɓ ᴀ", "lodz d h t o i n s b a"),
        ("x² H₂O 2ª", "x2 h2o 2a"),
        ("“a” ‘b’ «c» d–e", "\"a\" 'b' \"c\" d-e"),
        ("ǆ ꜳ ẞ ﬆ", "dz aa ss st"),
        ("日本 Привет ñ", "日本 привет n"),
    ],
)
def test_folding(spark, text, expected):
    from pyspark.sql import functions as F

    from rankloom.functions.text import folded

    assert spark.createDataFrame([(text,)], "t string").select(folded(F.col("t")).alias("f")).first().f == expected


def test_folding_looks_only_for_letters_that_occur(spark):
    from pyspark.sql import functions as F

    from rankloom.functions.text import folded, words

    rows = spark.createDataFrame([("Ab É‼ ﬃ 中ö’s a.b a., x_'y", "ab e!! ffi 中o's a.b a., x_'y")], "text string, want string")
    found = rows.select(folded(F.col("text")).alias("got"), "want")
    assert "translate(" not in found._jdf.queryExecution().analyzed().toString()
    row = found.select("got", "want", words(F.col("got")).alias("w")).first()
    assert row["got"] == row["want"]
    assert row["w"] == ["ab", "e", "ffi", "中", "o's", "a.b", "a", "x_", "y"]
