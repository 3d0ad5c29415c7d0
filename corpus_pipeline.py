"""From raw documents to packed training sequences: four stages, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.llm.common import set_aside, stored, table
from rankloom.llm.jaccard_join import jaccard_components
from rankloom.llm.packing import pack, token_pieces
from rankloom.llm.pii import pseudonymise
from rankloom.llm.quality import quality_rules
from rankloom.llm.queries import PSEUDONYM_KEY, vocabulary
from rankloom.session import broadcast_if_small, durable, new_folder


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules; null and empty texts don't.

    Repeated rows are judged alike and stay, a null id is judged by its text, further columns pass, an
    empty table gives an empty one.
    """
    others = [c for c in docs.columns if c.lower() not in ("doc_id", "text")]
    _, there, back = set_aside(others)
    judged = quality_rules(docs.select("doc_id", "text", *there), table(spark, sf_dir, "labels"))
    return judged.filter("kept").select("doc_id", "text", *back).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, 80 percent): the smallest id.

    Rows are told apart by numbers of their own, stored with them. So of repeated rows one stays, a copy
    of a document without id goes (ids come before nulls), and a text stays or goes whatever other
    rows of its id hold. Texts without words link with nothing and stay; an empty table gives an
    empty one. Further columns pass, whatever their names.
    """
    places, there, back = set_aside(docs.columns)
    lower = [c.lower() for c in docs.columns]
    key, text = places[lower.index("doc_id")], places[lower.index("text")]
    rows = stored(docs.select(*there).withColumn("_row", F.monotonically_increasing_id()), "rows")
    found = jaccard_components(rows.select("_row", F.col(text).alias("text")), words=5, percent=80, key="_row")
    ids = rows.select("_row", F.struct(F.col(key).isNull(), F.col(key), F.col("_row")).alias("_order"))
    linked = durable(found.select("_row", "component_id").join(ids, "_row"))
    groups = linked.groupBy("component_id").agg(F.min("_order").alias("_first"), F.count(F.lit(1)).alias("_n"))
    groups = durable(groups.filter("_n > 1").drop("_n"))
    others = linked.join(broadcast_if_small(groups), "component_id").filter("_order <> _first").select("_row")
    return rows.join(broadcast_if_small(durable(others)), "_row", "left_anti").select(*back)


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose personal data are replaced; n_chars is counted anew.

    Null and empty texts stay as they are, repeated rows get the same pseudonyms, further columns
    pass, an empty table gives an empty one.
    """
    _, there, back = set_aside(c for c in docs.columns if c.lower() != "text")
    done = pseudonymise(docs.select("text", *there), PSEUDONYM_KEY).select("text", *back)
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return done.select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences of at most 4096 tokens, each with its place in a packed sequence.

    A null or empty text is its end token, repeated rows are packed each, further columns are left out, an
    empty table gives an empty one.
    """
    return pack(token_pieces(docs, vocabulary("word_bpe_49k.json"), capacity=4096), tokens=4096)


STAGES = [
    ("quality_rules", quality),
    ("jaccard_join", near_duplicates),
    ("pseudonyms", pseudonyms),
    ("best_fit_packing", packing),
]

#: SQL has neither the tokenizer nor keyed permutations; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, from the table of documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        folder = new_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
