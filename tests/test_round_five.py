from pyspark.sql import functions as F

from rankloom.functions.text import collapsed, element, elements, plain_text
from rankloom.operators.analysis import Analyzer
from rankloom.operators.index import matched_index
from rankloom.sources.corpus import _joined_lines, _not_empty


def test_matched_rows_of_a_document_lie_together(spark):
    texts = ["apple apples pear plum fig", "plum fig apple lime", "", None, "lime pear pears fig plum apple"]
    docs = spark.createDataFrame([(f"D{i % 4}", "fig lime", t) for i, t in enumerate(texts)], "docno string, headline string, text string")
    vocabulary = spark.createDataFrame([("appl",), ("pear",), ("plum",), ("fig",), ("lime",)], "term string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = matched_index(docs, vocabulary, Analyzer(stop=["the"]))
        places = found.matched.select("doc_key", F.spark_partition_id().alias("at")).distinct().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(places) == len({r["doc_key"] for r in places}) == 5  # they were dealt by term before
    rows = found.matched.filter("field = 'text'").select("docno", "term", "dl", "tf", "positions").collect()
    apples = sorted(tuple(r) for r in rows if r["term"] == "appl")
    assert apples == [("D0", "appl", 5, 2, [0, 1]), ("D0", "appl", 6, 1, [5]), ("D1", "appl", 4, 1, [2])]


def test_matched_rows_without_stemming_are_one_per_term(spark):
    docs = spark.createDataFrame([("D0", None, "fig lime fig")], "docno string, headline string, text string")
    vocabulary = spark.createDataFrame([("fig",)], "term string")
    rows = matched_index(docs, vocabulary, Analyzer(stem=False)).matched.drop("doc_key").collect()
    assert [r.asDict() for r in rows] == [{"docno": "D0", "field": "text", "dl": 3, "term": "fig", "positions": [0, 2], "tf": 2}]


def test_readers_compute_each_text_once(spark):
    value = F.col("value")
    found = _not_empty(plain_text(elements(value, "TEXT")))._jc.toString()
    assert found.count("regexp_extract_all(") == 1  # four times before
    assert _not_empty(_joined_lines(element(value, "TEXT")))._jc.toString().count("regexp_extract(") == 1


def test_blanks_and_elements_of_all_kinds(spark):
    texts = ["a b", " a  b\t", "a\tb\n\nc", "\n", "", None, "a \x0b\fb\r\n c  ", "a  b  ", "  \n \n x  y \n"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select(
        collapsed(F.col("t")), F.trim(F.regexp_replace("t", r"\s+", " ")),
        _joined_lines(F.col("t")), F.regexp_replace(F.regexp_replace("t", r"\s*\n\s*", " "), r"^\s+|\s+$", ""),
        plain_text(F.col("t")),
    ).collect()
    assert all(r[0] == r[1] == r[4] and r[2] == r[3] for r in rows)
    marked = ["<T>x</T><t a='1'>y </T >", "<T></T>", "<TT>x</TT>", "<T>x", None, "<!-- <p> -->a<br/>b<i>c</i> 1 < 2"]
    df = spark.createDataFrame([(t,) for t in marked], "t string")
    t = F.col("t")
    rows = [tuple(r) for r in df.select(elements(t, "T"), element(t, "T"), _not_empty(element(t, "T")), plain_text(t)).collect()]
    assert rows == [
        ("x y ", "x", "x", "xy"), ("", "", None, ""), (None, None, None, "x"), (None, None, None, "x"), (None,) * 4,
        (None, None, None, "a bc 1 < 2"),
    ]
