"""Queries on file formats: the tables are written in a format, read back and compared."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.analysis import SYNONYM_KEYS
from ..session import new_folder
from ..sources import corpus, judgements
from . import inputs
from .evaluation import Query
from .inputs import SQL, with_ctes

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def wrap(function: Query) -> Query:
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return wrap


def _write(lines: DataFrame, path: str, *partitions: str) -> str:
    lines.write.partitionBy(*partitions).text(path)
    return path


def _escaped(text: Column) -> Column:
    for letter, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(letter), F.lit(entity))
    return text


def _labelled_docs(spark: SparkSession, folder: str) -> DataFrame:
    """The collection; documents judged toxic lose their id, so some are to be skipped."""
    toxic = inputs.table(spark, folder, "labels").filter("toxic = 1").select(
        F.concat(F.lit("D"), "doc_id").alias("docno"), F.lit(True).alias("lost")
    )
    docs = inputs.docs(spark, folder).join(toxic, "docno", "left")
    return docs.withColumn("docno", F.when(F.col("lost"), "").otherwise(F.col("docno"))).drop("lost")


LABELLED_SQL = f"""
  SELECT CASE WHEN docno IN (SELECT 'D' || doc_id FROM labels WHERE toxic = 1) THEN NULL ELSE docno END AS docno,
         headline, text FROM ({SQL['docs']})"""

JOINED = "nullif(regexp_replace(regexp_replace({0}, '\\s*\\n\\s*', ' ', 'g'), '^\\s+|\\s+$', '', 'g'), '')"
COLLAPSED = "nullif(trim(regexp_replace({0}, '\\s+', ' ', 'g')), '')"


def ft_files(spark: SparkSession, folder: str) -> str:
    """Headline and text between tags on lines of their own, one folder per source."""
    rows = inputs.docs(spark, folder).select(
        "source",
        F.format_string(
            "<DOC>\n<DOCNO>%s</DOCNO>\n<DATE>940101\n<HEADLINE>\n%s\n</HEADLINE>\n<TEXT>\n%s\n</TEXT>\n</DOC>",
            "docno",
            "headline",
            "text",
        ).alias("value"),
    )
    return _write(rows, new_folder(spark, "ft"), "source")


def fr94_files(spark: SparkSession, folder: str) -> str:
    rows = _labelled_docs(spark, folder).select(
        "source",
        F.format_string(
            "<DOC>\n<DOCNO>%s</DOCNO>\n<TEXT>\n<DOCTITLE>%s</DOCTITLE>\n<DATE>May 1</DATE>\n%s\n"
            "<BILLING>code 1505</BILLING>\n</TEXT>\n</DOC>",
            "docno",
            _escaped(F.col("headline")),
            _escaped(F.col("text")),
        ).alias("value"),
    )
    return _write(rows, new_folder(spark, "fr94"), "source")


def latimes_files(spark: SparkSession, folder: str) -> str:
    """Lines become paragraphs; a table with a paragraph of its own is not part of the text."""
    paragraphs = F.regexp_replace(_escaped(F.col("text")), "\n", "</P>\n<P>")
    rows = inputs.docs(spark, folder).select(
        F.format_string(
            "<DOC>\n<DOCNO> %s </DOCNO>\n<HEADLINE><P>\n%s\n</P></HEADLINE>\n"
            "<TEXT>\n<TABLE><CROW><P>cell</P></CROW></TABLE>\n<P>%s</P>\n</TEXT>\n</DOC>",
            "docno",
            _escaped(F.col("headline")),
            paragraphs,
        ).alias("value")
    )
    return _write(rows, new_folder(spark, "latimes"))


def fbis_files(spark: SparkSession, folder: str) -> str:
    """Toxic documents have no id element at all; nested elements are not part of the text."""
    docno = F.when(F.col("docno") == "", "").otherwise(
        F.concat(F.lit("<DOCNO>"), "docno", F.lit("</DOCNO>"))
    )
    rows = _labelled_docs(spark, folder).select(
        F.format_string(
            "<DOC>\n%s\n<HEADER><DATE1>1 May</DATE1><H3><TI>%s</TI></H3></HEADER>\n"
            "<TEXT>\n<H5>part one</H5> %s <TR>table</TR>\n</TEXT>\n</DOC>",
            docno,
            _escaped(F.col("headline")),
            _escaped(F.col("text")),
        ).alias("value")
    )
    return _write(rows, new_folder(spark, "fbis"))


def _corpus_sql(kind: str) -> str:
    shape = JOINED if kind == "ft" else COLLAPSED
    source = f"({SQL['docs']})" if kind in ("ft", "latimes") else f"({LABELLED_SQL}) WHERE docno IS NOT NULL"
    # One reader keeps an empty text as an empty text.
    headline, text = shape.format("headline"), shape.format("text")
    if kind == "fbis":
        headline, text = f"coalesce({headline}, '')", f"coalesce({text}, '')"
    return f"SELECT docno, '{kind}' AS source, {headline} AS headline, {text} AS text FROM {source}"


_FILES = {"ft": ft_files, "fr94": fr94_files, "latimes": latimes_files, "fbis": fbis_files}


def _corpus_query(kind: str) -> Query:
    def run_query(spark: SparkSession, folder: str) -> DataFrame:
        return corpus.read_corpus(spark, _FILES[kind](spark, folder), kind)

    return run_query


for _key, _kind in {
    "src_docs_ft": "ft",
    "src_docs_fr": "fr94",
    "src_docs_lat": "latimes",
    "src_docs_fbis": "fbis",
}.items():
    query(_key, _corpus_sql(_kind))(_corpus_query(_kind))


@query("union_corpora", "SELECT source, count(*) AS docs, count(docno) AS ids, "
       "CAST(sum(length(text)) AS BIGINT) AS letters FROM ("
       + " UNION ALL ".join(f"({_corpus_sql(k)})" for k in _FILES) + ") GROUP BY source")
def union_corpora(spark, folder):
    docs = corpus.load_collection(spark, {k: write(spark, folder) for k, write in _FILES.items()})
    return docs.groupBy("source").agg(
        F.count("*").alias("docs"),
        F.count("docno").alias("ids"),
        F.sum(F.length("text")).cast("long").alias("letters"),
    )


def _unchecked(spark: SparkSession, folder: str) -> DataFrame:
    docs = _labelled_docs(spark, folder)
    return docs.withColumn("docno", F.when(F.col("docno") != "", F.col("docno")))


@query("filter_valid_docs", f"SELECT docno FROM ({LABELLED_SQL}) WHERE docno IS NOT NULL")
def filter_valid_docs(spark, folder):
    return corpus.valid_docs(_unchecked(spark, folder), "fr94").select("docno")


@query("skip_report", f"""
SELECT 'no docno' AS reason, count(*) AS skipped FROM ({LABELLED_SQL}) WHERE docno IS NULL""")
def skip_report(spark, folder):
    return corpus.skip_report(_unchecked(spark, folder), "fbis")


def _decoded(text: str) -> str:
    for entity, letter in (("&quot;", '"'), ("&amp;", "&")):
        text = f"replace({text}, '{entity}', '{letter}')"
    return text


_TAGLESS = "regexp_replace(regexp_replace({0}, '</?(p|br|h1)[^>]*>', ' ', 'g'), '</?[a-zA-Z][^>]*>', '', 'g')"


@query("extract_html_fields", f"""
SELECT page_id,
  trim(regexp_replace({_decoded(_TAGLESS.format("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)"))}, '\\s+', ' ', 'g')) AS headline,
  trim(regexp_replace({_decoded(_TAGLESS.format(
    "array_to_string(regexp_extract_all(regexp_extract(html, '(?s)<article>(.*)</article>', 1), '(?s)<p>(.*?)</p>', 1), ' ')"
  ))}, '\\s+', ' ', 'g')) AS text
FROM pages""")
def extract_html_fields(spark, folder):
    pages = inputs.table(spark, folder, "pages").select("page_id", "html")
    found = corpus.extract_fields(pages, "html", "title", ["article", "p"], ["script", "style"])
    return found.select("page_id", "headline", "text")


@query("src_topics", f"""
SELECT substr(qid, 2) AS qid, title, description, narrative FROM ({SQL['topics']})""")
def src_topics(spark, folder):
    topics = inputs.topics(spark, folder)
    broken = F.regexp_replace("description", r"([.,]) ", "$1\n")
    lines = topics.select(
        F.format_string(
            "<top>\n\n<num> Number: %s \n<title> %s \n\n<desc> Description: \n%s\n\n"
            "<narr> Narrative: \n%s \n\n</top>\n",
            "qid", "title", broken, "narrative",
        ).alias("value")
    )
    return corpus.read_topics(spark, _write(lines, new_folder(spark, "topics")))


def _lines(df: DataFrame, pattern: str, *columns) -> DataFrame:
    return df.select(F.format_string(pattern, *columns).alias("value"))


@query("src_run", with_ctes([("run", SQL["run"])], """
SELECT qid, docno, CAST(score AS FLOAT) AS score, 'tag' AS run_id FROM run"""))
def src_run(spark, folder):
    rows = _lines(inputs.run(spark, folder), "%s Q0\t%s 7  %s tag left over\n", "qid", "docno", "score")
    found = judgements.read_run(spark, _write(rows, new_folder(spark, "run")))
    return found.select("qid", "docno", "score", "run_id")


@query("src_qrels", with_ctes([("qrels", SQL["qrels"])], "SELECT qid, docno, rel FROM qrels"))
def src_qrels(spark, folder):
    rows = _lines(inputs.qrels(spark, folder), "%s 0 %s %s", "qid", "docno", "rel")
    return judgements.read_qrels(spark, _write(rows, new_folder(spark, "qrels")))


@query("src_qrels_jg", with_ctes([("q", SQL["qrels_jg"])], "SELECT qid, jg, docno, rel FROM q"))
def src_qrels_jg(spark, folder):
    rows = _lines(inputs.qrels_jg(spark, folder), "%s %s %s %s", "qid", "jg", "docno", "rel")
    return judgements.read_qrels_jg(spark, _write(rows, new_folder(spark, "qrels_jg")))


@query("src_prefs", with_ctes([("p", SQL["prefs"])], "SELECT qid, jg, jsg, docno, rel_level FROM p"))
def src_prefs(spark, folder):
    rows = _lines(inputs.prefs(spark, folder), "%s %s\t%s %s %s", "qid", "jg", "jsg", "docno", "rel_level")
    return judgements.read_prefs(spark, _write(rows, new_folder(spark, "prefs")))


@query("src_qrels_prefs", with_ctes([("p", SQL["qrels_as_prefs"])], """
SELECT qid, jg, jsg, docno, rel_level FROM p"""))
def src_qrels_prefs(spark, folder):
    rows = _lines(inputs.qrels_jg(spark, folder), "%s %s %s %s", "qid", "jg", "docno", "rel")
    return judgements.read_qrels_prefs(spark, _write(rows, new_folder(spark, "qrels_prefs")))


@query("src_zscores", """
SELECT 'S' || l_suppkey AS qid, 'price_' || l_returnflag AS measure,
       max(l_extendedprice) AS mean, min(l_discount) AS stddev
FROM lineitem GROUP BY l_suppkey, l_returnflag""")
def src_zscores(spark, folder):
    spread = inputs.table(spark, folder, "lineitem").groupBy("l_suppkey", "l_returnflag").agg(
        F.max("l_extendedprice").alias("mean"), F.min("l_discount").alias("stddev")
    )
    rows = _lines(spread, "S%s price_%s %s %s", "l_suppkey", "l_returnflag", "mean", "stddev")
    return judgements.read_zscores(spark, _write(rows, new_folder(spark, "zscores")))


@query("src_stopwords", "SELECT DISTINCT lower(p_brand) AS term FROM part")
def src_stopwords(spark, folder):
    rows = _lines(inputs.table(spark, folder, "part"), "  %s \n", "p_brand")
    return judgements.read_stopwords(spark, _write(rows, new_folder(spark, "stopwords")))


@query("src_synonyms", f"""
SELECT k.term, n_name AS synonym FROM nation
CROSS JOIN (VALUES {', '.join(f"('{k}')" for k in SYNONYM_KEYS)}) AS k(term)""")
def src_synonyms(spark, folder):
    rows = _lines(inputs.table(spark, folder, "nation"), "%s ", "n_name")
    return judgements.read_synonyms(spark, _write(rows, new_folder(spark, "synonyms")))
