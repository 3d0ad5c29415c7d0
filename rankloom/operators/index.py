"""Index tables from tokens: postings, lengths and collection statistics."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import broadcast_if_small, durable, written
from .analysis import (
    DOC_KEY,
    FIELDS,
    Analyzer,
    document_columns,
    entries,
    fields,
    kept_lengths,
    keyed,
    merged,
    placed_words,
    text_entries,
    text_words,
    vocabulary_stems,
)

# Buckets of terms in a stored index.
TERM_BUCKETS = 64


def postings(tokens: DataFrame) -> DataFrame:
    """Frequency and positions of a term in a document field.

    A group holds the positions of one term in one document, so it is bounded by the document.
    """
    return tokens.groupBy(*document_columns(tokens), "field", "term").agg(
        F.count("*").alias("tf"), F.array_sort(F.collect_list("pos")).alias("positions")
    )


def text_postings(texts: DataFrame, *keys: str, analyzer: Analyzer | None = None, unique: bool = False) -> DataFrame:
    """(keys..., term, tf, positions) of a table (keys..., text); only texts that share their keys are
    shuffled, and none if ``unique`` says so."""
    rows = text_entries(texts, *keys, analyzer=analyzer, unique=unique)
    return rows.select(*keys, "term", F.size("positions").cast("long").alias("tf"), "positions")


def doc_len(tokens: DataFrame) -> DataFrame:
    return tokens.groupBy(*document_columns(tokens), "field").agg(F.count("*").alias("dl"))


def term_stats(frequencies: DataFrame) -> DataFrame:
    """Documents with the term and its occurrences, per field; from rows (.., term, tf)."""
    return frequencies.groupBy("field", "term").agg(
        F.count("*").alias("df"), F.sum("tf").alias("ctf")
    )


def field_stats(lengths: DataFrame) -> DataFrame:
    return lengths.groupBy("field").agg(
        F.count("*").alias("n_docs"), F.sum("dl").alias("sum_dl"), F.avg("dl").alias("avgdl")
    )


def num_docs(docs: DataFrame) -> DataFrame:
    return docs.agg(F.count("*").alias("num_docs"))


def docs_per_source(docs: DataFrame) -> DataFrame:
    return docs.groupBy("source").agg(F.count("*").alias("num_docs"))


def term_bucket(term: str) -> Column:
    """The bucket, of a fixed number, in which postings of a term are stored."""
    return F.pmod(F.xxhash64(term), F.lit(TERM_BUCKETS)).cast("int")


@dataclass
class Index:
    """What scoring needs: matched(doc_key, docno, field, term, tf, dl, positions) and the statistics."""

    matched: DataFrame
    term_stats: DataFrame
    field_stats: DataFrame


def matched_index(
    docs: DataFrame, vocabulary: DataFrame, analyzer: Analyzer | None = None
) -> Index:
    """Index tables restricted to the terms of ``vocabulary`` (column ``term``).

    The words of every text are made in its own row and written once: lengths and field statistics
    are read from there, the distinct words too, whose stems say which words the query terms
    stand for, and only those words leave the row. They are dealt by document, so all rows of a document lie
    in one partition and its parts are summed there. Every row of ``docs`` is a document of its own,
    also without docno or with one that occurs again.
    """
    analyzer = analyzer or Analyzer()
    keys = [DOC_KEY, "docno", "field"]
    texts = fields(keyed(docs), FIELDS, DOC_KEY, "docno")
    # A text's length goes with its words, unless stop tables or synonyms change it after the cut.
    known = not isinstance(analyzer.stop, DataFrame) and analyzer.synonyms is None
    of_text = [*keys, "dl"] if known else keys
    if known:
        placed = written(placed_words(texts, *keys, analyzer=analyzer), "words")
        terms = placed.select(F.explode("term").alias("term"))
        rows = placed.select(*of_text, F.inline(F.arrays_zip("term", "pos")))
    else:
        worded = written(text_words(texts, *keys, analyzer=analyzer), "words")
        terms = rows = entries(worded, *of_text, analyzer=analyzer)
    if analyzer.stem:
        stems = vocabulary_stems(terms).join(
            vocabulary.select(F.col("term").alias("stem")).distinct(), "stem"
        )
        wanted = stems.select("term", F.col("stem").alias("hit"))
    else:
        wanted = vocabulary.select("term", F.col("term").alias("hit")).distinct()
    hits = rows.join(broadcast_if_small(wanted), "term").drop("term").withColumnRenamed("hit", "term")
    found = merged(hits.repartition(DOC_KEY, "docno"), *of_text) if known or analyzer.stem else hits
    counted = found.withColumn("tf", F.size("positions").cast("long"))
    if known:
        lengths = kept_lengths(placed, *keys)
        matched = durable(counted)
    else:
        lengths = rows.groupBy(*keys).agg(F.sum(F.size("positions")).cast("long").alias("dl"))
        matched = durable(counted.join(lengths.drop("docno"), [DOC_KEY, "field"]))
    return Index(matched, term_stats(matched), durable(field_stats(lengths)))


def full_index(docs: DataFrame, analyzer: Analyzer | None = None) -> dict[str, DataFrame]:
    """All index tables of a collection, for writing and reuse."""
    texts, made = fields(keyed(docs), FIELDS, DOC_KEY, "docno"), DOC_KEY not in docs.columns
    # Written, as keys made here hold for one pass over the documents.
    found = written(text_postings(texts, DOC_KEY, "docno", "field", analyzer=analyzer, unique=made), "postings")
    lengths = found.groupBy(DOC_KEY, "docno", "field").agg(F.sum("tf").alias("dl"))
    return {
        "postings": found,
        "doc_len": lengths,
        "term_stats": term_stats(found),
        "field_stats": field_stats(lengths),
    }


def index_of_tables(
    postings_table: DataFrame, lengths: DataFrame, vocabulary: DataFrame
) -> Index:
    """Scoring input from stored tables; postings are pruned by the query terms first.

    Files that are cut by buckets of terms are left unread where no term of the query lies.
    """
    if "bucket" in postings_table.columns:
        wanted = vocabulary.select(term_bucket("term").alias("b")).distinct().collect()
        postings_table = postings_table.filter(F.col("bucket").isin([r["b"] for r in wanted])).drop("bucket")
    terms = broadcast_if_small(vocabulary.select("term").distinct())
    # Terms, statistics and phrases all read these rows; the stored files are read once. A text is one row, and
    # all rows of a document lie together, so its parts are summed there.
    pruned = postings_table.join(terms, "term", "left_semi").repartition(DOC_KEY)
    texts = pruned.groupBy(DOC_KEY, "docno", "field").agg(F.collect_list(F.struct("term", "tf", "positions")).alias("words"))
    of_document = lengths.groupBy(DOC_KEY).agg(F.collect_list(F.struct("field", "dl")).alias("lengths"))
    of_text = F.filter("lengths", lambda x: x["field"] == F.col("field"))
    texts = texts.join(of_document, DOC_KEY).select(DOC_KEY, "docno", "field", "words", F.explode(of_text).alias("of"))
    texts = durable(texts.select(DOC_KEY, "docno", "field", F.col("of.dl").alias("dl"), "words"))
    matched = texts.select(DOC_KEY, "docno", "field", "dl", F.inline("words")).select(
        DOC_KEY, "docno", "field", "term", "tf", "dl", "positions"
    )
    return Index(matched, term_stats(matched), durable(field_stats(lengths)))
