"""Appending newly arrived documents to stored index tables."""

from __future__ import annotations

import json
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.analysis import DOC_KEY, FIELDS, Analyzer, fields, keyed
from ..operators.index import field_stats, term_bucket, term_stats, text_postings
from ..session import new_folder


def append_index(
    docs: DataFrame, path: str, batch: str, analyzer: Analyzer | None = None, replay: bool = False
) -> None:
    """Append the postings and lengths of ``docs`` below ``path`` as the batch named ``batch``.

    Every row of ``docs`` becomes a document of its own. A batch counts once its mark is among the
    finished ones, which is written last; readers leave other batches out, so one that stopped half-way
    changes nothing. A finished batch of that name is an error, unless ``replay`` says that the
    same rows come again, which then replace it: its mark goes first. Texts are analysed
    once: lengths come from the postings.
    """
    spark = docs.sparkSession
    if _exists(spark, _mark(path, batch)):
        if not replay:
            raise ValueError(f"batch {batch} is in the index already")
        _file_system(spark, path)[0].delete(_path(spark, _mark(path, batch)), False)
    texts = fields(keyed(docs), FIELDS, DOC_KEY, "docno")
    found = text_postings(texts, DOC_KEY, "docno", "field", analyzer=analyzer, unique=DOC_KEY not in docs.columns)
    found, made = found.withColumn("bucket", term_bucket("term")), new_folder(spark, "entries")
    found.write.parquet(made)
    entries = spark.read.schema(found.schema).parquet(made)
    # What all rows of a batch share is added when they lie where they are written.
    of_batch = {DOC_KEY: F.concat(F.lit(f"{batch}:"), DOC_KEY), "batch": F.lit(batch)}
    # Ranges of term and document: a frequent term is spread over tasks, and few terms lie close together.
    order = ["bucket", "term", DOC_KEY]
    dealt = entries.repartitionByRange(*order).sortWithinPartitions(*order)
    _replace(dealt.withColumns(of_batch), f"{path}/postings", "batch", "bucket")
    lengths = entries.groupBy(DOC_KEY, "docno", "field").agg(F.sum("tf").alias("dl"))
    _replace(lengths.withColumns(of_batch), f"{path}/doc_len", "batch")
    _file_system(spark, made)[0].delete(_path(spark, made), True)
    _file_system(spark, path)[0].create(_path(spark, _mark(path, batch)), True).close()


def _mark(path: str, batch: str) -> str:
    """An empty file of the batch's name; creating it is one step of the file system."""
    return f"{path}/finished/{quote(batch, safe='')}"


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _file_system(spark: SparkSession, path: str) -> tuple:
    at = _path(spark, path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def _exists(spark: SparkSession, path: str) -> bool:
    system, at = _file_system(spark, path)
    return system.exists(at)


def finished_batches(spark: SparkSession, path: str) -> list[str]:
    """Names of the batches that were written to their end."""
    system, at = _file_system(spark, f"{path}/finished")
    if not system.exists(at):
        return []
    return sorted(unquote(f.getPath().getName()) for f in system.listStatus(at))


def _replace(rows: DataFrame, path: str, *parts: str) -> None:
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*parts).parquet(path)


def stream_into_index(
    spark: SparkSession,
    source: str,
    schema: StructType,
    to_docs,
    path: str,
    checkpoint: str,
    analyzer: Analyzer | None = None,
    glob: str = "*",
    files_per_batch: int = 1000,
) -> None:
    """Index all files that appeared in ``source`` since the last call, then stop.

    ``to_docs`` maps the file rows to (docno, headline, text). The stream checkpoint
    remembers which files are done. Batches are named by the identity that the checkpoint
    gives the stream and their number, so a stream with a new checkpoint adds new ones.
    """

    def append(rows: DataFrame, number: int) -> None:
        stream = json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]
        append_index(rows, path, f"{stream}-{number}", analyzer, replay=True)

    stream = (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", glob)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(source)
    )
    query = (
        to_docs(stream)
        .writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def stored_index(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Index tables below ``path`` with statistics over all batches.

    Only finished batches are read. Postings keep the column by whose values their files are cut,
    for pruning.
    """
    whole = F.col("batch").cast("string").isin(finished_batches(spark, path))
    entries = spark.read.parquet(f"{path}/postings").filter(whole).drop("batch")
    lengths = spark.read.parquet(f"{path}/doc_len").filter(whole).drop("batch")
    return {
        "postings": entries,
        "doc_len": lengths,
        "term_stats": term_stats(entries),
        "field_stats": field_stats(lengths),
    }
