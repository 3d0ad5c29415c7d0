"""Runs meet judgements: ranking, relevance of ranked documents, per-topic counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .checks import once
from .ordered import GROUP_LIMIT, GroupSize, OrderedGroups, first_rows, group_size

Size = int | GroupSize | None

# Relevance of a ranked document without a judgement.
NOT_POOLED = -1
UNJUDGED = -2


_KEY = "_score"


def with_key(run: DataFrame) -> DataFrame:
    """Add the sort key, the score as a 32-bit float. A column of its own lets all windows
    of a plan share one sort."""
    return run.withColumn(_KEY, F.col("score").cast("float"))


def run_order(ties: str = "desc") -> list:
    """Key descending; equal keys by document id.

    Relevance measures break ties by descending id, preference measures by ascending id.
    """
    docno = F.col("docno").desc() if ties == "desc" else F.col("docno").asc()
    return [F.col(_KEY).desc(), docno]


def rank_run(
    run: DataFrame,
    ties: str = "desc",
    max_docs: int | None = None,
    size: Size = None,
) -> DataFrame:
    """Add ``rank``; with ``max_docs`` keep only the first ranks of each topic.

    A cut up to the planner's limit is applied before the shuffle, so a topic of any size sends
    at most ``max_docs`` rows per task; a larger one numbers pieces of the topic.
    """
    if max_docs is not None:
        return first_rows(with_key(run), ["qid"], run_order(ties), max_docs).drop(_KEY)
    groups = OrderedGroups(with_key(run), ["qid"], run_order(ties), size).number("rank")
    return groups.df.drop(_KEY)


def judgements(qrels: DataFrame) -> DataFrame:
    """(qid, docno, rel); a document judged twice for a topic is an error.

    Rows without topic or document say nothing. They are left out here, where every reader of the table
    asks the same of the scan, so that one exchange serves all.
    """
    named = qrels.filter("qid IS NOT NULL AND docno IS NOT NULL")
    return once(named.select("qid", "docno", F.col("rel").cast("int").alias("rel")), ["qid", "docno"], "judgement")


def with_relevance(run: DataFrame, qrels: DataFrame) -> DataFrame:
    """Left join on (qid, docno); -1 not judged at all, -2 judged list member without a value."""
    judged = judgements(qrels)
    return run.join(judged, ["qid", "docno"], "left").withColumn(
        "rel",
        F.when(F.col("rel").isNull(), NOT_POOLED)
        .when(F.col("rel") < 0, UNJUDGED)
        .otherwise(F.col("rel")),
    )


def ranked_groups(
    run: DataFrame,
    qrels: DataFrame,
    max_docs: int | None = None,
    judged_only: bool = False,
    size: Size = None,
) -> OrderedGroups:
    """The ranked relevance list of every topic, ready for running counts.

    Relevance is joined before ranking so rank and running counts share one exchange. The
    join key contains the document, so a large topic does not make it skewed.
    """
    run = once(run.select("qid", "docno", "score"), ["qid", "docno"], "result")
    if max_docs is not None:
        run = rank_run(run, max_docs=max_docs).drop("rank")
        size = GroupSize(max_docs, 0) if max_docs <= GROUP_LIMIT else None
    if size is None:
        size = group_size(run, ["qid"])
    rows = with_relevance(run, qrels)
    if judged_only:
        rows = rows.filter("rel >= 0")
    return OrderedGroups(with_key(rows).drop("score"), ["qid"], run_order(), size).number("rank")


def ranked_relevance(run: DataFrame, qrels: DataFrame, **options) -> DataFrame:
    """(qid, docno, rank, rel) for the topics that have judgements."""
    rows = ranked_groups(topics_in_both(run, qrels), qrels, **options).df
    return rows.select("qid", "docno", "rank", "rel")


def judged_ranks_by_group(
    run: DataFrame,
    qrels_jg: DataFrame,
    size: Size = None,
    max_docs: int | None = None,
    judged_only: bool = False,
    level: int = 1,
) -> tuple[DataFrame, DataFrame]:
    """Relevant documents of the run per judgement group, without a copy of the run per group.

    Returns rows (qid, jg, rank, rel, rel_seen) of the relevant retrieved documents, and (qid, jg,
    num_rel) of all groups of the topics with results. The run is ranked once; a group's judgements meet
    the ranks by (qid, docno). With ``judged_only`` the rank counts the documents that the group judged,
    which are the rows that met.
    """
    judged = qrels_jg.select("qid", "jg", "docno", F.col("rel").cast("int").alias("rel"))
    judged = once(judged, ["qid", "jg", "docno"], "judgement")
    run = once(run.select("qid", "docno", "score"), ["qid", "docno"], "result")
    ranked = rank_run(run, max_docs=max_docs, size=size).select("qid", "docno", "rank")
    met = ranked.join(judged, ["qid", "docno"]).filter("rel >= 0")
    if not judged_only:
        met = met.filter(F.col("rel") >= level)
    groups = OrderedGroups(met, ["qid", "jg"], [F.col("rank").asc()])
    if judged_only:
        groups = groups.number("place")
    seen = groups.running({"rel_seen": F.when(F.col("rel") >= level, 1).otherwise(0)}).df
    rank = F.col("place" if judged_only else "rank").alias("rank")
    rows = seen.filter(F.col("rel") >= level).select("qid", "jg", rank, "rel", "rel_seen")
    counts = judged_counts(topics_in_both(judged, run), level, ("qid", "jg")).select("qid", "jg", "num_rel")
    return rows, counts


def ranked_relevance_by_group(
    run: DataFrame,
    qrels_jg: DataFrame,
    size: Size = None,
    max_docs: int | None = None,
    judged_only: bool = False,
):
    """The ranked list once per judgement group, with that group's relevance values.

    The cut to ``max_docs`` comes before the groups; ``judged_only`` keeps what a group judged.
    Returns :class:`OrderedGroups` over (qid, jg).
    """
    groups = qrels_jg.select("qid", "jg").distinct()
    judged = qrels_jg.select("qid", "jg", "docno", F.col("rel").cast("int").alias("rel"))
    judged = once(judged, ["qid", "jg", "docno"], "judgement")
    run = once(run.select("qid", "docno", "score"), ["qid", "docno"], "result")
    if max_docs is not None:
        run = rank_run(run, max_docs=max_docs).drop("rank")
        size = GroupSize(max_docs, 0) if max_docs <= GROUP_LIMIT else None
    rows = (
        run.join(groups, "qid")
        .join(judged, ["qid", "jg", "docno"], "left")
        .withColumn(
            "rel",
            F.when(F.col("rel").isNull(), NOT_POOLED)
            .when(F.col("rel") < 0, UNJUDGED)
            .otherwise(F.col("rel")),
        )
    )
    if size is None:
        size = group_size(run, ["qid"])
    if judged_only:
        rows = rows.filter("rel >= 0")
    keyed = with_key(rows).drop("score")
    return OrderedGroups(keyed, ["qid", "jg"], run_order(), size).number("rank")


def topics_in_both(run: DataFrame, qrels: DataFrame) -> DataFrame:
    """Run rows of the topics that have judgements."""
    return run.join(qrels.select("qid").distinct(), "qid", "left_semi")


def missing_topics(run: DataFrame, qrels: DataFrame) -> DataFrame:
    """Topics with judgements but without results."""
    return qrels.select("qid").distinct().join(run.select("qid").distinct(), "qid", "left_anti")


def judged_counts(qrels: DataFrame, level: int = 1, keys: tuple[str, ...] = ("qid",)) -> DataFrame:
    """num_rel and num_nonrel over all judgements of a topic."""
    rel = F.col("rel")
    return qrels.groupBy(*keys).agg(
        F.count_if(rel >= level).alias("num_rel"),
        F.count_if((rel >= 0) & (rel < level)).alias("num_nonrel"),
    )


def topic_stats(ranked: DataFrame, qrels: DataFrame, level: int = 1) -> DataFrame:
    """Counts per topic of the retrieved documents, with num_rel over all judgements."""
    rel = F.col("rel")
    retrieved = ranked.groupBy("qid").agg(
        F.count("*").alias("num_ret"),
        F.count_if(rel == NOT_POOLED).alias("num_nonpool"),
        F.count_if(rel == UNJUDGED).alias("num_unjudged"),
        F.count_if(rel >= level).alias("num_rel_ret"),
    )
    judged = judged_counts(qrels, level).select("qid", "num_rel")
    return retrieved.join(judged, "qid")


def rel_levels(qrels: DataFrame) -> DataFrame:
    """Number of judgements per topic and level."""
    return qrels.filter("rel >= 0").groupBy("qid", "rel").agg(F.count("*").alias("cnt"))


def running_counts(
    groups: OrderedGroups, level: int = 1, others: dict[str, Column] | None = None
) -> OrderedGroups:
    """Add relevant, judged non-relevant and unjudged documents seen so far, and ``others``."""
    rel = F.col("rel")
    return groups.running(
        (others or {})
        | {
            "rel_seen": F.when(rel >= level, 1).otherwise(0),
            "nonrel_seen": F.when((rel >= 0) & (rel < level), 1).otherwise(0),
            "unjudged_seen": F.when(rel == UNJUDGED, 1).otherwise(0),
        }
    )


def interpolated_precision(
    run: DataFrame, qrels: DataFrame, level: int = 1, size: Size = None
) -> DataFrame:
    """Highest precision at this rank or a later one."""
    if size is None:
        size = group_size(run, ["qid"])
    ranked = ranked_groups(topics_in_both(run, qrels), qrels, size=size)
    counted = ranked.running({"rel_seen": F.when(F.col("rel") >= level, 1).otherwise(0)}).df
    rows = counted.select("qid", "docno", "rank", (F.col("rel_seen") / F.col("rank")).alias("prec"))
    return (
        OrderedGroups(rows, ["qid"], [F.col("rank").desc()], size)
        .running_max({"iprec": F.col("prec")})
        .df.select("qid", "docno", "rank", "iprec")
    )
