"""Text sinks: run lines and evaluation report lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.measures import COUNT_MEASURES
from ..operators.ordered import first_rows


def run_tag(analyzer: str, model: str) -> Column:
    """Run tag: analyzer name and model name, each without its class suffix."""
    return F.concat(
        F.regexp_replace(F.lit(analyzer), "Analyzer", ""),
        F.regexp_replace(F.lit(model), "Similarity", ""),
    )


def run_lines(scored: DataFrame, tag: Column, k: int | None = None) -> DataFrame:
    """``qid Q0 docno rank score tag`` lines; a document without id uses up no rank."""
    order = [F.col("score").desc(), F.col("docno").asc()]
    ranked = first_rows(scored.filter(F.col("docno").isNotNull()), ["qid"], order, k)
    ranked = ranked.withColumn("rank", F.col("rank").cast("int"))
    line = F.format_string("%s Q0 %s %d %.6f %s", "qid", "docno", "rank", "score", tag)
    return ranked.select("qid", "rank", line.alias("line"))


def write_run(lines: DataFrame, path: str) -> None:
    """Write run lines; sorted by a range partitioning, so files follow each other in order."""
    ordered = lines.repartitionByRange("qid", "rank").sortWithinPartitions("qid", "rank")
    ordered.select("line").write.mode("overwrite").text(path)


def report_lines(rows: DataFrame, zscores: bool = False) -> DataFrame:
    """Report rows (qid, measure, value[, text]) as printed lines."""
    value = F.col("value")
    # Half-even first: the printed form of an exact tie follows the C library.
    number = F.format_string("%-22s\t%s\t%6.4f", "measure", "qid", F.bround(value, 4))
    undefined = F.format_string("%-22s\t%s\tnan", "measure", "qid")
    number = F.when(F.isnan(value), undefined).otherwise(number)
    if zscores:
        number = F.concat(F.lit("Z"), number)
    whole = F.format_string("%-22s\t%s\t%d", "measure", "qid", value.cast("long"))
    counts = F.col("measure").isin(sorted(COUNT_MEASURES) + ["num_q"])
    line = number if zscores else F.when(counts, whole).otherwise(number)
    if "text" in rows.columns:
        text = F.col("text")
        quoted = F.format_string("%-22s\t%s\t'%s'", "measure", "qid", text)
        bare = F.format_string("%-22s\t%s\t%s", "measure", "qid", text)
        line = (
            F.when(text.isNull(), line)
            .when(F.col("measure") == "runid", bare)
            .otherwise(quoted)
        )
    return rows.select("qid", "measure", line.alias("line"))


def write_report(lines: DataFrame, path: str) -> None:
    """Topic lines in topic order, then the ``all`` lines."""
    last = (F.col("qid") == "all").cast("int")
    ordered = lines.repartitionByRange(last, "qid").sortWithinPartitions(last, "qid", "measure")
    ordered.select("line").write.mode("overwrite").text(path)
