"""Readers of run, judgement, preference, z-score and word-list files.

Lines are cut at blanks; a line that breaks its format fails the query with the line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.analysis import SYNONYM_KEYS
from ..operators.checks import check_unique


def _fields(
    spark: SparkSession, path: str, low: int, high: int | None, what: str
) -> DataFrame:
    """Non-blank lines as arrays ``f`` of at least ``low`` and at most ``high`` fields."""
    lines = spark.read.text(path)
    cut = F.split(F.regexp_replace("value", r"^\s+|\s+$", ""), r"\s+")
    rows = lines.filter(F.col("value").rlike(r"\S")).select("value", cut.alias("f"), "_metadata")
    count = F.size("f")
    good = count >= low if high is None else count.between(low, high)
    message = F.concat(F.lit(f"malformed {what} line: "), "value")
    return rows.withColumn("f", F.when(good, F.col("f")).otherwise(F.raise_error(message)))


def read_run(spark: SparkSession, path: str) -> DataFrame:
    """(qid, docno, score, run_id, line); more than 6 fields are allowed, the rank is ignored."""
    line = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return _fields(spark, path, 6, None, "run").select(
        F.expr("f[0]").alias("qid"),
        F.expr("f[2]").alias("docno"),
        F.expr("cast(f[4] AS float)").alias("score"),
        F.expr("f[5]").alias("run_id"),
        line.alias("line"),
    )


def read_qrels(spark: SparkSession, path: str) -> DataFrame:
    return _fields(spark, path, 4, 4, "judgement").selectExpr(
        "f[0] AS qid", "f[2] AS docno", "cast(f[3] AS int) AS rel"
    )


def read_qrels_jg(spark: SparkSession, path: str, check: bool = True) -> DataFrame:
    rows = _fields(spark, path, 4, 4, "judgement").selectExpr(
        "f[0] AS qid", "f[1] AS jg", "f[2] AS docno", "cast(f[3] AS int) AS rel"
    )
    return check_unique(rows, ["qid", "jg", "docno"]) if check else rows


def read_prefs(spark: SparkSession, path: str) -> DataFrame:
    return _fields(spark, path, 5, 5, "preference").selectExpr(
        "f[0] AS qid", "f[1] AS jg", "f[2] AS jsg", "f[3] AS docno", "cast(f[4] AS float) AS rel_level"
    )


def read_qrels_prefs(spark: SparkSession, path: str) -> DataFrame:
    """Judgement-group lines as preferences with the single sub-group ``0``."""
    return _fields(spark, path, 4, 4, "judgement").selectExpr(
        "f[0] AS qid", "f[1] AS jg", "'0' AS jsg", "f[2] AS docno", "cast(f[3] AS float) AS rel_level"
    )


def read_zscores(spark: SparkSession, path: str) -> DataFrame:
    return _fields(spark, path, 4, 4, "z-score").selectExpr(
        "f[0] AS qid", "f[1] AS measure", "cast(f[2] AS double) AS mean", "cast(f[3] AS double) AS stddev"
    )


def _word_lines(spark: SparkSession, path: str) -> DataFrame:
    word = F.regexp_replace("value", r"^\s+|\s+$", "")
    return spark.read.text(path).select(word.alias("term")).filter("term <> ''")


def read_stopwords(spark: SparkSession, path: str) -> DataFrame:
    """One word per line; case does not matter."""
    return _word_lines(spark, path).select(F.lower("term").alias("term")).distinct()


def read_synonyms(
    spark: SparkSession, path: str, keys: tuple[str, ...] = SYNONYM_KEYS
) -> DataFrame:
    """(term, synonym): each line is a synonym of every key."""
    listed = F.array(*[F.lit(k) for k in keys])
    return _word_lines(spark, path).select(
        F.explode(listed).alias("term"), F.col("term").alias("synonym")
    )
