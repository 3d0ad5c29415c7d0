"""The whole search path: topics against a collection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.analysis import FIELDS, Analyzer, document_columns, fields, text_entries
from ..operators.index import Index, matched_index
from ..operators.queries import phrase_match, phrase_terms, query_terms
from ..operators.scoring import (
    contributions,
    phrase_contributions,
    scored,
    top_k,
    validate,
)
from ..session import broadcast_if_small, durable

MAX_RESULTS = 1000


def scores(
    docs: DataFrame,
    topics: DataFrame,
    model: str = "BM25",
    analyzer: Analyzer | None = None,
    phrases: str | None = "analyzed",
    **params,
) -> DataFrame:
    """(qid, docno, score) of every matching document.

    ``phrases`` says how the exact-phrase clauses are made: ``analyzed`` by the same chain as the
    texts, ``raw`` from the blank-separated words as they are; None leaves them out.
    """
    return _scores(docs, topics, model, analyzer, phrases, **params).select("qid", "docno", "score")


def _scores(
    docs: DataFrame, topics: DataFrame, model: str, analyzer: Analyzer | None, phrases: str | None, **params
) -> DataFrame:
    validate(model)
    if phrases not in ("analyzed", "raw", None):
        raise ValueError(f"unknown kind of phrases: {phrases}")
    terms = durable(query_terms(topics, analyzer))
    vocabulary, words = terms.select("term"), None
    if phrases:
        words = durable(phrase_terms(topics, phrases == "analyzed", analyzer))
        vocabulary = vocabulary.union(words.select("term"))
    index = matched_index(docs, vocabulary, analyzer)
    return scored(_parts(index, terms, words, model, **params))


def _parts(index: Index, terms: DataFrame, words: DataFrame | None, model: str, **params) -> DataFrame:
    """Contributions of terms, and of phrases if there are any, from one set of index rows."""
    parts = contributions(terms, index, model, **params)
    if words is None:
        return parts
    wanted = broadcast_if_small(words.select("field", "term").distinct())
    rows = index.matched.join(wanted, ["field", "term"], "left_semi")
    # A phrase's documents are matched ones; their lengths come with any of the phrase's words.
    found = durable(phrase_match(words, rows))
    document = document_columns(rows)
    holding = broadcast_if_small(found.select(document[0]).distinct())
    lengths = rows.join(holding, document[0], "left_semi").groupBy(*document, "field").agg(F.first("dl").alias("dl"))
    return parts.unionByName(phrase_contributions(words, found, lengths, index, model, **params))


def phrase_tokens(
    docs: DataFrame, phrases: DataFrame, analyzer: Analyzer | None = None
) -> DataFrame:
    """(docno, field, term, positions): words of the collection that occur in some phrase.

    Only fields with phrases are analysed, when the rows are asked for; who reads them twice writes them.
    """
    wanted = durable(phrases.select("field", "term").distinct())
    asked = [r["field"] for r in wanted.select("field").distinct().collect()]
    names = [n for n in FIELDS if n in asked] or FIELDS
    rows = text_entries(fields(docs, names), "docno", "field", analyzer=analyzer)
    return rows.join(broadcast_if_small(wanted), ["field", "term"], "left_semi")


def search(
    docs: DataFrame,
    topics: DataFrame,
    model: str = "BM25",
    k: int = MAX_RESULTS,
    analyzer: Analyzer | None = None,
    phrases: str | None = "analyzed",
    **params,
) -> DataFrame:
    """(qid, docno, rank, score): the run of the topics over the collection."""
    return top_k(_scores(docs, topics, model, analyzer, phrases, **params), k)


def search_index(
    index: Index, terms: DataFrame, model: str = "BM25", k: int = MAX_RESULTS, words: DataFrame | None = None, **params
) -> DataFrame:
    """The same from index tables that already exist; ``words`` are the words of phrases."""
    return top_k(scored(_parts(index, terms, words, model, **params)), k)
