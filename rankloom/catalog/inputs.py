"""Inputs derived from the given tables, as DataFrames and as the same thing in SQL.

The tables hold no runs or judgements, so suppliers play topics and parts play documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _topic_doc(df: DataFrame, *columns) -> DataFrame:
    return df.select(
        F.concat(F.lit("S"), "l_suppkey").alias("qid"),
        F.concat(F.lit("P"), "l_partkey").alias("docno"),
        *columns,
    )


def run(spark: SparkSession, folder: str) -> DataFrame:
    """Parts sold at a discount of 5% or more, scored by price. Whole numbers give many ties."""
    sold = table(spark, folder, "lineitem").filter("l_discount >= 0.05")
    best = _topic_doc(sold, "l_extendedprice").groupBy("qid", "docno").agg(F.max("l_extendedprice").alias("price"))
    return best.select("qid", "docno", F.floor(F.col("price") / 100).cast("double").alias("score"))


def run_of_solvent(spark: SparkSession, folder: str) -> DataFrame:
    """The run of suppliers with a positive balance: some judged topics have no results."""
    solvent = table(spark, folder, "supplier").filter("s_acctbal > 0").select(
        F.concat(F.lit("S"), "s_suppkey").alias("qid")
    )
    return run(spark, folder).join(solvent, "qid", "left_semi")


def tagged_run(spark: SparkSession, folder: str) -> DataFrame:
    """The run with a tag per line, and the line number of the latest order it stems from."""
    best = (
        table(spark, folder, "lineitem")
        .filter("l_discount >= 0.05")
        .groupBy("l_suppkey", "l_partkey")
        .agg(
            F.max("l_extendedprice").alias("price"),
            F.max(F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line"),
        )
    )
    return _topic_doc(
        best,
        F.floor(F.col("price") / 100).cast("double").alias("score"),
        "line",
        F.concat(F.lit("run"), "line").alias("run_id"),
    )


def qrels(spark: SparkSession, folder: str) -> DataFrame:
    """Shipped or returned parts, levels -1 to 3 by quantity."""
    judged = (
        table(spark, folder, "lineitem")
        .filter("l_returnflag <> 'N'")
        .groupBy("l_suppkey", "l_partkey")
        .agg(F.max("l_quantity").alias("quantity"))
    )
    return _topic_doc(judged, (F.col("quantity").cast("int") % 5 - 1).alias("rel"))


def qrels_of_large(spark: SparkSession, folder: str) -> DataFrame:
    """Judgements of suppliers with a balance below 9000: some results have no judgements."""
    large = table(spark, folder, "supplier").filter("s_acctbal < 9000").select(
        F.concat(F.lit("S"), "s_suppkey").alias("qid")
    )
    return qrels(spark, folder).join(large, "qid", "left_semi")


def qrels_jg(spark: SparkSession, folder: str) -> DataFrame:
    """One judgement group per return flag."""
    lines = _topic_doc(table(spark, folder, "lineitem"), F.col("l_returnflag").alias("jg"), "l_quantity")
    judged = lines.repartition("qid", "docno").groupBy("qid", "docno", "jg").agg(F.max("l_quantity").alias("quantity"))
    return judged.select("qid", "docno", "jg", (F.col("quantity").cast("int") % 5 - 1).alias("rel"))


def prefs(spark: SparkSession, folder: str) -> DataFrame:
    """Groups by return flag, sub-groups by line status. A document has one level per group,
    so no contradictions arise."""
    level = (F.col("l_partkey") * 7 + F.ascii("l_returnflag")) % 5
    lines = _topic_doc(
        table(spark, folder, "lineitem"),
        F.col("l_returnflag").alias("jg"),
        F.col("l_linestatus").alias("jsg"),
        level.cast("float").alias("rel_level"),
    )
    # Grouping by document and meeting the run, which is grouped so, need no other exchange.
    return lines.repartition("qid", "docno").distinct()


def qrels_as_prefs(spark: SparkSession, folder: str) -> DataFrame:
    """Judgement groups read as preferences with one sub-group each."""
    return qrels_jg(spark, folder).select(
        "qid", "jg", F.lit("0").alias("jsg"), "docno", F.col("rel").cast("float").alias("rel_level")
    )


def spread(scan: DataFrame) -> DataFrame:
    """Spread a scan of fewer splits than cores (one small file) over the cores.

    Only for plain scans of small inputs: a large table has more splits than that and is left
    alone, so its rows are not shuffled.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def docs(spark: SparkSession, folder: str) -> DataFrame:
    """The first line of a document is its headline, the rest its text."""
    text = F.col("text")
    rows = spread(table(spark, folder, "documents").select("doc_id", "source", "text"))
    return rows.select(
        F.concat(F.lit("D"), "doc_id").alias("docno"),
        "source",
        F.substring_index(text, "\n", 1).alias("headline"),
        F.expr("substring(text, instr(text, '\n') + 1)").alias("text"),
    )


def topics(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark passages: first sentence, whole passage, remaining sentences."""
    text = F.trim(F.regexp_replace("text", r"\s+", " "))
    return (
        table(spark, folder, "benchmark")
        .select("item_id", text.alias("t"))
        .select(
            F.concat(F.lit("B"), "item_id").alias("qid"),
            F.regexp_extract("t", r"^[^.]*\.?", 0).alias("title"),
            F.col("t").alias("description"),
            F.trim(F.regexp_replace("t", r"^[^.]*\.?", "")).alias("narrative"),
        )
    )


SQL = {
    "run": """
  SELECT 'S' || l_suppkey AS qid, 'P' || l_partkey AS docno,
         floor(max(l_extendedprice) / 100) AS score
  FROM lineitem WHERE l_discount >= 0.05 GROUP BY l_suppkey, l_partkey""",
    "run_of_solvent": """
  SELECT 'S' || l_suppkey AS qid, 'P' || l_partkey AS docno,
         floor(max(l_extendedprice) / 100) AS score
  FROM lineitem WHERE l_discount >= 0.05
    AND l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)
  GROUP BY l_suppkey, l_partkey""",
    "tagged_run": """
  SELECT 'S' || l_suppkey AS qid, 'P' || l_partkey AS docno,
         floor(max(l_extendedprice) / 100) AS score,
         max(l_orderkey * 10 + l_linenumber) AS line,
         'run' || max(l_orderkey * 10 + l_linenumber) AS run_id
  FROM lineitem WHERE l_discount >= 0.05 GROUP BY l_suppkey, l_partkey""",
    "qrels": """
  SELECT 'S' || l_suppkey AS qid, 'P' || l_partkey AS docno,
         CAST(CAST(max(l_quantity) AS INTEGER) % 5 - 1 AS INTEGER) AS rel
  FROM lineitem WHERE l_returnflag <> 'N' GROUP BY l_suppkey, l_partkey""",
    "qrels_of_large": """
  SELECT 'S' || l_suppkey AS qid, 'P' || l_partkey AS docno,
         CAST(CAST(max(l_quantity) AS INTEGER) % 5 - 1 AS INTEGER) AS rel
  FROM lineitem WHERE l_returnflag <> 'N'
    AND l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 9000)
  GROUP BY l_suppkey, l_partkey""",
    "qrels_jg": """
  SELECT 'S' || l_suppkey AS qid, 'P' || l_partkey AS docno, l_returnflag AS jg,
         CAST(CAST(max(l_quantity) AS INTEGER) % 5 - 1 AS INTEGER) AS rel
  FROM lineitem GROUP BY l_suppkey, l_partkey, l_returnflag""",
    "prefs": """
  SELECT DISTINCT 'S' || l_suppkey AS qid, 'P' || l_partkey AS docno, l_returnflag AS jg,
         l_linestatus AS jsg,
         CAST((l_partkey * 7 + ascii(l_returnflag)) % 5 AS FLOAT) AS rel_level
  FROM lineitem""",
    "qrels_as_prefs": """
  SELECT 'S' || l_suppkey AS qid, 'P' || l_partkey AS docno, l_returnflag AS jg, '0' AS jsg,
         CAST(CAST(max(l_quantity) AS INTEGER) % 5 - 1 AS FLOAT) AS rel_level
  FROM lineitem GROUP BY l_suppkey, l_partkey, l_returnflag""",
    "docs": """
  SELECT 'D' || doc_id AS docno, source, split_part(text, chr(10), 1) AS headline,
         substr(text, strpos(text, chr(10)) + 1) AS text
  FROM documents""",
    "topics": """
  SELECT 'B' || item_id AS qid, regexp_extract(t, '^[^.]*\\.?') AS title, t AS description,
         trim(regexp_replace(t, '^[^.]*\\.?', '')) AS narrative
  FROM (SELECT item_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS t FROM benchmark)""",
}


def with_ctes(ctes: list[tuple[str, str]], body: str, recursive: bool = False) -> str:
    parts = ",\n".join(f"{name} AS ({sql})" for name, sql in ctes)
    return f"WITH {'RECURSIVE ' if recursive else ''}{parts}\n{body}"
