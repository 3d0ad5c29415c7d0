"""Readers of tagged newswire collections and of topic files.

Files are cut at the closing record tag by the text source itself, so a large file is
split over many tasks and no task holds a whole file.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import collapsed, element, elements, once_computed, outermost, plain_text, without_elements

# Elements left out of the text, per collection.
FR94_DROPPED = "DOCTITLE ADDRESS SIGNER SIGNJOB BILLING FRFILING DATE CRFNO RINDOCK".split()
FBIS_NESTED = (
    "HEADER TEXT ABS AU DATE1 DOC DOCNO H1 H2 H3 H4 H5 H6 H7 H8 HT TR TXT5 TI".split()
)
# Files of a collection that hold no documents.
FBIS_IGNORED = ("readchg.txt", "readmefb.txt")

FORMATS = ("ft", "fr94", "latimes", "fbis")

# An element other than a paragraph that contains paragraphs.
_CONTAINER = (
    r"(?is)<((?!p\b)[a-z][a-z0-9]*)(?:\s[^>]*)?>(?:(?!</\1\b)(?!<p\b).)*"
    r"<p\b(?:(?!</\1\b).)*</\1\s*>"
)


def _trimmed(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s++|\s++$", "")


def _joined_lines(text: Column) -> Column:
    """Trimmed lines joined by one blank."""
    return _trimmed(F.regexp_replace(text, r"[^\S\n]*+\n\s*+", " "))


def _not_empty(text: Column) -> Column:
    return once_computed(text, lambda t: F.when(t != "", t))


def _records(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    reader = spark.read.option("lineSep", "</DOC>")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.text(path)


def _ft(spark: SparkSession, path: str) -> DataFrame:
    rows = _records(spark, path, recursive=True).filter(F.col("value").contains("<DOC>"))
    value = F.col("value")
    return rows.select(
        _not_empty(_trimmed(element(value, "DOCNO"))).alias("docno"),
        _not_empty(_joined_lines(element(value, "HEADLINE"))).alias("headline"),
        _not_empty(_joined_lines(element(value, "TEXT"))).alias("text"),
    )


def _fr94(spark: SparkSession, path: str) -> DataFrame:
    rows = _records(spark, f"{path}/*/*").filter(F.col("value").rlike("(?i)<DOC>"))
    value = F.col("value")
    kept = without_elements(value, FR94_DROPPED)
    return rows.select(
        _not_empty(plain_text(elements(value, "DOCNO"))).alias("docno"),
        _not_empty(plain_text(elements(value, "DOCTITLE"))).alias("headline"),
        _not_empty(plain_text(elements(kept, "TEXT"))).alias("text"),
    )


def _latimes(spark: SparkSession, path: str) -> DataFrame:
    rows = _records(spark, f"{path}/*").filter(F.col("value").rlike("(?i)<DOC>"))
    value = F.col("value")

    def paragraphs(tag: str) -> Column:
        own = F.regexp_replace(elements(value, tag), _CONTAINER, " ")
        return plain_text(elements(own, "P"))

    return rows.select(
        _not_empty(plain_text(elements(value, "DOCNO"))).alias("docno"),
        _not_empty(paragraphs("HEADLINE")).alias("headline"),
        _not_empty(paragraphs("TEXT")).alias("text"),
    )


def _fbis(spark: SparkSession, path: str) -> DataFrame:
    name = F.lower(F.col("_metadata.file_name"))
    rows = (
        _records(spark, f"{path}/*")
        .filter(~name.isin(*FBIS_IGNORED))
        .filter(F.col("value").rlike("(?i)<DOC>"))
    )
    value = F.col("value")

    def own_text(tag: str) -> Column:
        nested = [t for t in FBIS_NESTED if t != tag]
        return plain_text(without_elements(elements(value, tag), nested))

    return rows.select(
        own_text("DOCNO").alias("docno"),
        own_text("TI").alias("headline"),
        own_text("TEXT").alias("text"),
    )


_READERS = {"ft": _ft, "fr94": _fr94, "latimes": _latimes, "fbis": _fbis}


def read_corpus(spark: SparkSession, path: str, kind: str, valid_only: bool = True) -> DataFrame:
    """(docno, source, headline, text) of one collection.

    ``valid_only`` applies the collection's rule for documents to skip.
    """
    if kind not in _READERS:
        raise ValueError(f"unknown collection format: {kind}")
    docs = _READERS[kind](spark, path).select(
        "docno", F.lit(kind).alias("source"), "headline", "text"
    )
    return valid_docs(docs, kind) if valid_only else docs


def skip_reason(rule: str) -> Column:
    """Why a document is skipped; null for a document to keep."""
    no_docno = F.col("docno").isNull()
    if rule in ("fr94", "fbis"):
        return F.when(no_docno, "no docno")
    if rule == "latimes":
        empty = no_docno & F.col("headline").isNull() & F.col("text").isNull()
        return F.when(empty, "empty document")
    return F.lit(None).cast("string")


def valid_docs(docs: DataFrame, rule: str) -> DataFrame:
    return docs.filter(skip_reason(rule).isNull())


def skip_report(docs: DataFrame, rule: str) -> DataFrame:
    """Number of skipped documents by reason."""
    reasons = docs.select(skip_reason(rule).alias("reason")).filter("reason IS NOT NULL")
    return reasons.groupBy("reason").agg(F.count("*").alias("skipped"))


def load_collection(spark: SparkSession, spec: dict[str, str]) -> DataFrame:
    """All collections of ``{format: path}`` in one table."""
    return reduce(
        DataFrame.unionByName, [read_corpus(spark, path, kind) for kind, path in spec.items()]
    )


def _inner(markup: Column, tag: str) -> Column:
    """Paragraphs cannot hold paragraphs; other elements may hold ones of their own name."""
    return elements(markup, tag) if tag.lower() == "p" else outermost(markup, tag)


def extract_fields(
    df: DataFrame, markup: str, headline_tag: str, text_tags: list[str], drop_tags: list[str]
) -> DataFrame:
    """Add (headline, text): the text of some elements, unwanted elements left out."""
    kept = without_elements(F.col(markup), drop_tags)
    inner = kept
    for tag in text_tags[:-1]:
        inner = _inner(inner, tag)
    found = {
        "headline": _inner(F.col(markup), headline_tag),
        "text": _inner(inner, text_tags[-1]),
    }
    # A page without the element has an empty field.
    return df.withColumns({n: F.coalesce(plain_text(c), F.lit("")) for n, c in found.items()})


def read_topics(spark: SparkSession, path: str) -> DataFrame:
    """(qid, title, description, narrative) of ``<top>`` blocks; lines joined by one blank."""
    value = F.col("value")

    def part(start: str) -> Column:
        pattern = rf"(?s){start}(.*?)(?=\n\s*<(?:num|title|desc|narr)>|$)"
        return collapsed(F.regexp_extract(value, pattern, 1))

    rows = spark.read.option("lineSep", "</top>").text(path).filter(value.contains("<top>"))
    return rows.select(
        F.regexp_replace(F.regexp_extract(value, r"<num> Number:([^\n]*)", 1), r"\D", "").alias("qid"),
        part("<title>").alias("title"),
        part("<desc> Description:").alias("description"),
        part("<narr> Narrative:").alias("narrative"),
    )
