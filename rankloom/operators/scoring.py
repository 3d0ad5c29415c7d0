"""Ranking models as expressions over (tf, dl, df, ctf, n_docs, sum_dl, avgdl)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import broadcast_if_small
from .analysis import document_columns
from .index import Index
from .ordered import first_rows

# Parameters of the models.
BM25_K1, BM25_B = 1.2, 0.75
DIRICHLET_MU = 2000.0
SWEET_SPOT_MIN, SWEET_SPOT_MAX, SWEET_SPOT_STEEPNESS = 1, 1, 0.5

SCORE_DIGITS = 6


def idf_bm25() -> str:
    return "ln(1 + (n_docs - df + 0.5D) / (df + 0.5D))"


def idf_classic() -> str:
    return "(1 + ln((n_docs + 1) / (df + 1)))"


def bm25(tf: str = "tf", idf: str | None = None, k1: float = BM25_K1, b: float = BM25_B) -> str:
    length = f"({k1!r}D * ({1 - b!r}D + {b!r}D * dl / avgdl))"
    return f"{idf or idf_bm25()} * {tf} / ({tf} + {length})"


def boolean(tf: str = "tf", idf: str | None = None) -> str:
    return "1D"


def classic(tf: str = "tf", idf: str | None = None) -> str:
    return f"sqrt({tf}) * {idf or idf_classic()} / sqrt(dl)"


def lm_dirichlet(tf: str = "tf", idf: str | None = None, mu: float = DIRICHLET_MU) -> str:
    share = "((ctf + 1) / (sum_dl + 1))"
    return f"greatest(0D, ln(1 + {tf} / ({mu!r}D * {share})) + ln({mu!r}D / (dl + {mu!r}D)))"


def sweet_spot(
    tf: str = "tf",
    idf: str | None = None,
    lmin: int = SWEET_SPOT_MIN,
    lmax: int = SWEET_SPOT_MAX,
    steep: float = SWEET_SPOT_STEEPNESS,
) -> str:
    outside = f"(abs(dl - {lmin}) + abs(dl - {lmax}) - ({lmax} - {lmin}))"
    return f"sqrt({tf}) * {idf or idf_classic()} / sqrt({steep!r}D * {outside} + 1)"


MODELS = {
    "BM25": bm25,
    "BOOLEAN": boolean,
    "CLASSIC": classic,
    "LM_DIRICHLET": lm_dirichlet,
    "SWEET_SPOT": sweet_spot,
}
# Names used in run tags.
MODEL_TAGS = {
    "BM25": "BM25Similarity",
    "BOOLEAN": "BooleanSimilarity",
    "CLASSIC": "ClassicSimilarity",
    "LM_DIRICHLET": "LMDirichletSimilarity",
    "SWEET_SPOT": "SweetSpotSimilarity",
}
ANALYZERS = ("CUSTOM",)


def validate(model: str, analyzer: str = "CUSTOM") -> None:
    """Reject unknown model and analyzer names."""
    if model not in MODELS:
        raise ValueError(f"unknown ranking model: {model}")
    if analyzer not in ANALYZERS:
        raise ValueError(f"unknown analyzer: {analyzer}")


def _idf_of(model: str) -> str:
    return idf_bm25() if model == "BM25" else idf_classic()


def match(terms: DataFrame, index: Index) -> DataFrame:
    """Query terms joined with the postings that contain them.

    The query side is broadcast once its row count is known to be small; otherwise the
    adaptive planner splits the partitions of frequent terms.
    """
    return index.matched.join(broadcast_if_small(terms), ["field", "term"])


def match_any(matched: DataFrame) -> DataFrame:
    """A document matches a topic when one of its terms does; with the number that do."""
    found = matched.groupBy("qid", *document_columns(matched)).agg(F.count("*").alias("terms"))
    return found.select("qid", "docno", "terms")


def contributions(
    terms: DataFrame, index: Index, model: str = "BM25", **params
) -> DataFrame:
    """(qid, doc_key, docno, part): weight times similarity of each matched term."""
    validate(model)
    similarity = MODELS[model](**params)
    # Statistics have one row per query term and field.
    weighted = terms.join(index.term_stats, ["field", "term"]).join(
        F.broadcast(index.field_stats), "field"
    )
    rows = index.matched.join(broadcast_if_small(weighted), ["field", "term"])
    return rows.selectExpr("qid", *document_columns(rows), f"weight * ({similarity}) AS part")


def phrase_contributions(
    phrases: DataFrame,
    found: DataFrame,
    lengths: DataFrame,
    index: Index,
    model: str = "BM25",
    **params,
) -> DataFrame:
    """The same for phrases: phrase frequency as tf, the sum of the words' idf as idf."""
    validate(model)
    stats = phrases.join(index.term_stats, ["field", "term"]).join(
        F.broadcast(index.field_stats), "field"
    )
    per_phrase = stats.groupBy("qid", "clause", "field", "weight").agg(
        F.sum(F.expr(_idf_of(model))).alias("idf"),
        F.min("ctf").alias("ctf"),
        F.min("df").alias("df"),
        F.first("n_docs").alias("n_docs"),
        F.first("sum_dl").alias("sum_dl"),
        F.first("avgdl").alias("avgdl"),
    )
    similarity = MODELS[model](tf="freq", idf="idf", **params)
    document = document_columns(found)
    rows = found.join(per_phrase, ["qid", "clause"]).join(
        lengths.select(document[0], "field", "dl"), [document[0], "field"]
    )
    return rows.selectExpr("qid", *document, f"weight * ({similarity}) AS part")


def scored(parts: DataFrame) -> DataFrame:
    """(qid, doc_key, docno, score): sum of the parts, rounded so that the order in which a cluster
    adds them cannot change a rank."""
    total = F.round(F.sum("part"), SCORE_DIGITS)
    return parts.groupBy("qid", *document_columns(parts)).agg(total.alias("score"))


def top_k(scores: DataFrame, k: int = 1000) -> DataFrame:
    """First ``k`` documents per topic; equal scores by ascending id.

    For the usual ``k`` every task sends at most ``k`` rows per topic.
    """
    keys = [F.col(c).asc() for c in reversed(document_columns(scores))]
    ranked = first_rows(scores, ["qid"], [F.col("score").desc(), *keys], k)
    return ranked.select("qid", "docno", "rank", "score")
