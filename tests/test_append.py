"""Stored indexes: batches add up, a replay replaces its own batch, documents stay single."""

import pytest

from rankloom.operators import queries
from rankloom.operators.analysis import Analyzer
from rankloom.operators.index import full_index, index_of_tables
from rankloom.plans.search import search, search_index
from rankloom.streaming.append import append_index, stored_index

DOCS = "docno string, headline string, text string"
PLAIN = Analyzer(stem=False)
FIRST = [("d1", "wool", "sheep give wool"), (None, "tin", "mines give tin")]
SECOND = [("d1", "wool", "wool again"), (None, "tin", "mines give tin"), ("d2", None, None)]


def rows(run):
    return sorted(((r.qid, r.docno, r.score) for r in run.collect()), key=repr)


def test_batches_add_up_and_are_searched(spark, tmp_path):
    path = str(tmp_path / "index")
    append_index(spark.createDataFrame(FIRST, DOCS), path, "one", PLAIN)
    append_index(spark.createDataFrame(SECOND, DOCS), path, "two", PLAIN)
    with pytest.raises(ValueError, match="in the index already"):
        append_index(spark.createDataFrame(SECOND, DOCS), path, "two", PLAIN)
    append_index(spark.createDataFrame(SECOND, DOCS), path, "two", PLAIN, replay=True)
    topics = spark.createDataFrame(
        [("1", "wool", "give tin", "")], "qid string, title string, description string, narrative string"
    )
    terms, words = queries.query_terms(topics, PLAIN), queries.phrase_terms(topics, analyzer=PLAIN)
    wanted = terms.select("term").union(words.select("term"))
    tables = stored_index(spark, path)
    assert tables["field_stats"].filter("field = 'text'").first().n_docs == 4
    found = search_index(index_of_tables(tables["postings"], tables["doc_len"], wanted), terms, words=words)
    whole = spark.createDataFrame(FIRST + SECOND, DOCS)
    assert rows(found) == rows(search(whole, topics, analyzer=PLAIN))
    assert len(rows(found)) == 4
    memory = full_index(whole, PLAIN)
    again = search_index(index_of_tables(memory["postings"], memory["doc_len"], wanted), terms, words=words)
    assert rows(again) == rows(found)


def test_raw_phrases_can_be_asked_for(spark):
    docs = spark.createDataFrame(FIRST, DOCS)
    topics = spark.createDataFrame([("1", "x", "SHEEP give", "")], "qid string, title string, description string, narrative string")
    with_raw, without = (search(docs, topics, analyzer=PLAIN, phrases=p).first().score for p in ("raw", None))
    assert with_raw > without
    with pytest.raises(ValueError):
        search(docs, topics, phrases="other")


def test_unfinished_batches_change_nothing(spark, tmp_path, monkeypatch):
    from rankloom.streaming import append

    path = str(tmp_path / "index")
    docs = spark.createDataFrame([("d1", "one", "alpha beta"), ("d2", "two", "beta gamma")], "docno string, headline string, text string")
    append.append_index(docs, path, "first")
    before = {n: sorted(map(tuple, t.collect()), key=repr) for n, t in append.stored_index(spark, path).items() if n != "postings"}
    real = append._replace

    def stopped(rows, at, *parts):
        if at.endswith("doc_len"):
            raise RuntimeError("lost")
        real(rows, at, *parts)

    monkeypatch.setattr(append, "_replace", stopped)
    with pytest.raises(RuntimeError):
        append.append_index(docs, path, "second/half")
    monkeypatch.undo()
    after = {n: sorted(map(tuple, t.collect()), key=repr) for n, t in append.stored_index(spark, path).items() if n != "postings"}
    assert after == before and append.finished_batches(spark, path) == ["first"]
    append.append_index(docs, path, "second/half")
    assert append.finished_batches(spark, path) == ["first", "second/half"]
    assert append.stored_index(spark, path)["doc_len"].count() == 2 * len(before["doc_len"])
    with pytest.raises(ValueError):
        append.append_index(docs, path, "first")
