"""Queries on runs and judgements, each with the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import checks, gains, measures, ranking, summary
from ..plans.evaluate import evaluate, evaluate_groups, report
from ..sources.reports import report_lines
from . import inputs
from .inputs import SQL, with_ctes

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

DIGITS = 8


def query(name: str, oracle: str | None = None):
    def wrap(function: Query) -> Query:
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return wrap


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), DIGITS) for c in columns})


# -- SQL building blocks ------------------------------------------------------------


def ranked_sql(level: int = 1, max_docs: int | None = None, judged_only: bool = False) -> list:
    cut = f"WHERE r0 <= {max_docs}" if max_docs else ""
    judged = "WHERE rel >= 0" if judged_only else ""
    return [
        (
            "cut_run",
            f"""
  SELECT * FROM (
    SELECT qid, docno, score, row_number() OVER (
             PARTITION BY qid ORDER BY CAST(score AS FLOAT) DESC, docno DESC) AS r0
    FROM run WHERE qid IN (SELECT qid FROM qrels)) {cut}""",
        ),
        (
            "judged_run",
            """
  SELECT r.qid, r.docno, r.r0,
         CAST(CASE WHEN q.rel IS NULL THEN -1 WHEN q.rel < 0 THEN -2 ELSE q.rel END AS INTEGER) AS rel
  FROM cut_run r LEFT JOIN qrels q ON r.qid = q.qid AND r.docno = q.docno""",
        ),
        (
            "ranked",
            f"""
  SELECT qid, docno, rel, row_number() OVER (PARTITION BY qid ORDER BY r0) AS rank
  FROM judged_run {judged}""",
        ),
        (
            "seen",
            f"""
  SELECT *, CAST(sum(hit) OVER w AS BIGINT) AS cum, CAST(sum(miss) OVER w AS BIGINT) AS nonrel,
         CAST(sum(unj) OVER w AS BIGINT) AS unjudged
  FROM (SELECT *, CASE WHEN rel >= {level} THEN 1 ELSE 0 END AS hit,
               CASE WHEN rel >= 0 AND rel < {level} THEN 1 ELSE 0 END AS miss,
               CASE WHEN rel = -2 THEN 1 ELSE 0 END AS unj FROM ranked)
  WINDOW w AS (PARTITION BY qid ORDER BY rank ROWS UNBOUNDED PRECEDING)""",
        ),
        (
            "t",
            f"""
  SELECT s.*, j.R, j.judged_nonrel FROM (
    SELECT qid, count(*) AS n, CAST(sum(hit) AS BIGINT) AS rr,
           count(*) FILTER (rel = -1) AS nonpool, count(*) FILTER (rel = -2) AS unj
    FROM seen GROUP BY qid) s
  JOIN (SELECT qid, count(*) FILTER (rel >= {level}) AS R,
               count(*) FILTER (rel >= 0 AND rel < {level}) AS judged_nonrel
        FROM qrels GROUP BY qid) j ON s.qid = j.qid""",
        ),
    ]


DOC_K = "(VALUES (5),(10),(15),(20),(30),(100),(200),(500),(1000)) AS c(k)"
POINTS = "(VALUES (0.0::DOUBLE),(0.1),(0.2),(0.3),(0.4),(0.5),(0.6),(0.7),(0.8),(0.9),(1.0)) AS c(x)"
MULTIPLES = "(VALUES (0.2::DOUBLE),(0.4),(0.6),(0.8),(1.0),(1.2),(1.4),(1.6),(1.8),(2.0)) AS c(x)"


def rel_total(expression: str, label: str, over: str = "R") -> str:
    """Sum of a row expression over relevant rows, divided per topic."""
    return f"""
  SELECT t.qid, '{label}' AS measure,
         coalesce(sum(CASE WHEN hit = 1 THEN {expression} END), 0) / nullif(max({over}), 0) AS value
  FROM t JOIN seen s ON s.qid = t.qid GROUP BY t.qid"""


def at_cut(label: str, value: str, cuts: str = DOC_K) -> str:
    """A value from ``h``, the relevant documents within each cut-off."""
    return f"""
  SELECT qid, '{label}_' || k AS measure, {value} AS value
  FROM (SELECT t.qid, c.k, any_value(t.R) AS R, any_value(t.n) AS n,
               count(*) FILTER (hit = 1 AND rank <= c.k) AS h
        FROM t JOIN seen s ON s.qid = t.qid CROSS JOIN {cuts} GROUP BY t.qid, c.k)"""


def at_multiple(label: str) -> str:
    return f"""
  SELECT qid, printf('{label}_%.2f', x) AS measure, h / nullif(cut, 0)::DOUBLE AS value
  FROM (SELECT t.qid, c.x, any_value(floor(c.x * t.R + 0.9)) AS cut,
               count(*) FILTER (hit = 1 AND rank <= floor(c.x * t.R + 0.9)) AS h
        FROM t JOIN seen s ON s.qid = t.qid CROSS JOIN {MULTIPLES} GROUP BY t.qid, c.x)"""


IPREC = f"""
  SELECT qid, x, CASE WHEN cut > rr THEN 0 ELSE best END AS value FROM (
    SELECT t.qid, c.x, any_value(t.rr) AS rr, any_value(floor(c.x * t.R + 0.9)) AS cut,
           max(CASE WHEN s.cum >= floor(c.x * t.R + 0.9) THEN s.cum / s.rank::DOUBLE END) AS best
    FROM t JOIN seen s ON s.qid = t.qid CROSS JOIN {POINTS} GROUP BY t.qid, c.x)"""

BPREF_ROW = "CASE WHEN nonrel = 0 THEN 1.0 ELSE 1.0 - least(nonrel, R) / least(judged_nonrel, R)::DOUBLE END"
INFAP_ROW = """CASE WHEN rank = 1 THEN 1.0 ELSE 1.0 / rank + ((rank - 1) / rank::DOUBLE)
    * ((cum - 1 + nonrel + unjudged) / (rank - 1)::DOUBLE)
    * ((cum - 1 + 0.00001::DOUBLE) / (cum - 1 + nonrel + 0.00002::DOUBLE)) END"""


def stat(label: str, value: str) -> str:
    return f"SELECT qid, '{label}' AS measure, {value} AS value FROM t"


VALUES_SQL: dict[str, str] = {
    "num_ret": stat("num_ret", "n"),
    "num_rel": stat("num_rel", "R"),
    "num_rel_ret": stat("num_rel_ret", "rr"),
    "map": rel_total("cum / rank::DOUBLE", "map"),
    "gm_map": rel_total("cum / rank::DOUBLE", "gm_map"),
    "Rprec": rel_total("CASE WHEN rank <= R THEN 1.0 ELSE 0.0 END", "Rprec"),
    "bpref": rel_total(BPREF_ROW, "bpref"),
    "gm_bpref": rel_total(BPREF_ROW, "gm_bpref"),
    "recip_rank": """
  SELECT qid, 'recip_rank' AS measure,
         coalesce(1.0 / min(CASE WHEN hit = 1 THEN rank END), 0) AS value FROM seen GROUP BY qid""",
    "iprec_at_recall": f"""
  SELECT qid, printf('iprec_at_recall_%.2f', x) AS measure, value FROM ({IPREC})""",
    "11pt_avg": f"SELECT qid, '11pt_avg' AS measure, sum(value) / 11 AS value FROM ({IPREC}) GROUP BY qid",
    "P": at_cut("P", "h / k::DOUBLE"),
    "recall": at_cut("recall", "h / nullif(R, 0)::DOUBLE"),
    "relative_P": at_cut("relative_P", "h / nullif(least(k, R), 0)::DOUBLE"),
    "success": at_cut(
        "success", "CASE WHEN h > 0 THEN 1.0 ELSE 0.0 END", "(VALUES (1),(5),(10)) AS c(k)"
    ),
    "map_cut": f"""
  SELECT t.qid, 'map_cut_' || c.k AS measure,
         coalesce(sum(CASE WHEN hit = 1 AND rank <= c.k THEN cum / rank::DOUBLE END), 0)
           / nullif(max(R), 0) AS value
  FROM t JOIN seen s ON s.qid = t.qid CROSS JOIN {DOC_K} GROUP BY t.qid, c.k""",
    "infAP": rel_total(INFAP_ROW, "infAP"),
    "Rprec_mult": at_multiple("Rprec_mult"),
    "utility": stat("utility", "1.0 * rr - 1.0 * (n - rr)"),
    "binG": rel_total("1.0 / log2(2 + rank - cum)", "binG"),
    "set_P": stat("set_P", "rr / nullif(n, 0)::DOUBLE"),
    "set_relative_P": stat("set_relative_P", "rr / nullif(least(n, R), 0)::DOUBLE"),
    "set_recall": stat("set_recall", "rr / nullif(R, 0)::DOUBLE"),
    "set_map": stat("set_map", "rr * rr / nullif(n * R, 0)::DOUBLE"),
    "set_F": stat(
        "set_F",
        "2.0 * (rr / n::DOUBLE) * (rr / nullif(R, 0)::DOUBLE)"
        " / nullif(rr / n::DOUBLE + rr / nullif(R, 0)::DOUBLE, 0)",
    ),
    "num_nonrel_judged_ret": """
  SELECT qid, 'num_nonrel_judged_ret' AS measure, count(*) FILTER (miss = 1) AS value
  FROM seen GROUP BY qid""",
    "yaap": """
  SELECT t.qid, 'yaap' AS measure, ln((1 + S) / (1 + R - S)) AS value
  FROM t JOIN (SELECT qid, coalesce(sum(CASE WHEN hit = 1 THEN cum / rank::DOUBLE END), 0) AS S
               FROM seen GROUP BY qid) p ON t.qid = p.qid""",
}


def _gain_ctes(gain: str) -> list[tuple[str, str]]:
    """Gains by rank next to the ideal at the same position."""
    return [
        ("g", f"SELECT qid, rank, CASE WHEN rel < 0 THEN 0 ELSE {gain} END::DOUBLE AS gain FROM ranked"),
        (
            "ideal",
            f"""
  SELECT qid, pos, gain, sum(gain / log2(pos + 1)) OVER w AS idcg, sum(gain) OVER w AS isum,
         sum(greatest(gain, 1)) OVER w AS cost
  FROM (SELECT qid, gain, row_number() OVER (PARTITION BY qid ORDER BY gain DESC, docno) AS pos
        FROM (SELECT qid, docno, ({gain})::DOUBLE AS gain FROM qrels WHERE rel >= 0) WHERE gain > 0)
  WINDOW w AS (PARTITION BY qid ORDER BY pos ROWS UNBOUNDED PRECEDING)""",
        ),
        ("tot", "SELECT qid, max(pos) AS np, max(idcg) AS idcg, max(isum) AS isum, max(cost) AS cost FROM ideal GROUP BY qid"),
        (
            "d",
            """
  SELECT qid, rank, gain, sum(gain / log2(rank + 1)) OVER w AS dcg, sum(gain) OVER w AS gsum
  FROM g WINDOW w AS (PARTITION BY qid ORDER BY rank ROWS UNBOUNDED PRECEDING)""",
        ),
        ("fin", "SELECT qid, arg_max(dcg, rank) AS dcg, count(*) AS n FROM d GROUP BY qid"),
    ]


GAIN_SQL: dict[str, str] = {
    "ndcg": "SELECT f.qid, '{label}' AS measure, f.dcg / tot.idcg AS value FROM fin f JOIN tot ON f.qid = tot.qid",
    "ndcg_rel": """
  SELECT f.qid, '{label}' AS measure,
         (coalesce(any_value(p.total), 0) + (any_value(tot.np) - coalesce(any_value(p.cnt), 0))
           * any_value(f.dcg) / any_value(tot.idcg)) / any_value(tot.np) AS value
  FROM fin f JOIN tot ON f.qid = tot.qid
  LEFT JOIN (SELECT d.qid, sum(d.dcg / coalesce(i.idcg, tot.idcg)) AS total, count(*) AS cnt
             FROM d JOIN tot ON d.qid = tot.qid
             LEFT JOIN ideal i ON d.qid = i.qid AND d.rank = i.pos
             WHERE d.gain > 0 GROUP BY d.qid) p ON p.qid = f.qid
  GROUP BY f.qid""",
    "Rndcg": """
  SELECT qid, '{label}' AS measure, avg(v) AS value FROM (
    SELECT b.qid, coalesce(d.dcg, f.dcg) / b.idcg AS v
    FROM (SELECT qid, gain, max(pos) AS b, max(idcg) AS idcg FROM ideal GROUP BY qid, gain) b
    JOIN fin f ON f.qid = b.qid LEFT JOIN d ON d.qid = b.qid AND d.rank = b.b
    UNION ALL
    SELECT f.qid, f.dcg / tot.idcg FROM fin f JOIN tot ON f.qid = tot.qid WHERE f.n > tot.np + 1)
  GROUP BY qid""",
    "G": """
  SELECT d.qid, '{label}' AS measure,
         sum(CASE WHEN d.gain <> 0 THEN d.gain
             / log2(2 + coalesce(i.cost, tot.cost + d.rank - tot.np) - d.gsum) ELSE 0 END)
         / any_value(tot.isum) AS value
  FROM d JOIN tot ON d.qid = tot.qid LEFT JOIN ideal i ON d.qid = i.qid AND d.rank = i.pos
  GROUP BY d.qid""",
}

NDCG_CUT_SQL = f"""
  SELECT a.qid, 'ndcg_cut_' || a.k AS measure, a.dcg / b.idcg AS value
  FROM (SELECT qid, c.k, sum(CASE WHEN rel > 0 AND rank <= c.k THEN rel / log2(rank + 1) ELSE 0 END) AS dcg
        FROM ranked CROSS JOIN {DOC_K} GROUP BY qid, c.k) a
  LEFT JOIN (SELECT qid, c.k, sum(CASE WHEN pos <= c.k THEN rel / log2(pos + 1) END) AS idcg
        FROM (SELECT qid, rel, row_number() OVER (PARTITION BY qid ORDER BY rel DESC, docno) AS pos
              FROM qrels WHERE rel > 0) CROSS JOIN {DOC_K} GROUP BY qid, c.k) b
  ON a.qid = b.qid AND a.k = b.k"""

SUMS = "('num_ret','num_rel','num_rel_ret','num_nonrel_judged_ret')"
GEOMETRIC = "('gm_map','gm_bpref')"
SUMMARY_VALUE = f"""CASE WHEN measure IN {SUMS} THEN sum(value)
         WHEN measure IN {GEOMETRIC} THEN exp(avg(ln(greatest(value, 0.00001)))) ELSE avg(value) END"""
TOPICS_AND_ALL = f"""
SELECT qid, measure, round(value, {DIGITS}) AS value FROM v WHERE measure NOT IN {GEOMETRIC}
UNION ALL
SELECT 'all' AS qid, measure, round({SUMMARY_VALUE}, {DIGITS}) AS value FROM v GROUP BY measure"""


def _values(parts: list[str]) -> str:
    union = "\n  UNION ALL ".join(f"SELECT * FROM ({p})" for p in parts)
    return f"SELECT qid, measure, coalesce(value, 0)::DOUBLE AS value FROM ({union})"


def evaluation_sql(
    names: list[str],
    body: str = TOPICS_AND_ALL,
    run: str = "run",
    qrels: str = "qrels",
    gain: str | None = None,
    gain_label: str = "{name}",
    **options,
) -> str:
    ctes = [("run", SQL[run]), ("qrels", SQL[qrels]), *ranked_sql(**options)]
    if gain or any(n in GAIN_SQL for n in names):
        ctes += _gain_ctes(gain or "rel")
    parts = []
    for n in names:
        if n in GAIN_SQL:
            parts.append(GAIN_SQL[n].replace("{label}", gain_label.format(name=n)))
        elif n == "ndcg_cut":
            parts.append(NDCG_CUT_SQL)
        else:
            parts.append(VALUES_SQL[n])
    return with_ctes([*ctes, ("v", _values(parts))], body)


# -- one query per measure ----------------------------------------------------------

MEASURE_KEYS = {
    "m_num_ret": "num_ret",
    "m_num_rel": "num_rel",
    "m_num_rel_ret": "num_rel_ret",
    "m_map": "map",
    "m_gm_map": "gm_map",
    "m_rprec": "Rprec",
    "m_bpref": "bpref",
    "m_recip_rank": "recip_rank",
    "m_iprec": "iprec_at_recall",
    "m_p": "P",
    "m_recall": "recall",
    "m_infap": "infAP",
    "m_gm_bpref": "gm_bpref",
    "m_rprec_mult": "Rprec_mult",
    "m_utility": "utility",
    "m_11pt_avg": "11pt_avg",
    "m_bing": "binG",
    "m_g": "G",
    "m_ndcg": "ndcg",
    "m_ndcg_rel": "ndcg_rel",
    "m_rndcg": "Rndcg",
    "m_ndcg_cut": "ndcg_cut",
    "m_map_cut": "map_cut",
    "m_relative_p": "relative_P",
    "m_success": "success",
    "m_set_p": "set_P",
    "m_set_relative_p": "set_relative_P",
    "m_set_recall": "set_recall",
    "m_set_map": "set_map",
    "m_set_f": "set_F",
    "m_num_nonrel_judged_ret": "num_nonrel_judged_ret",
    "m_yaap": "yaap",
}


def _measure_query(name: str) -> Query:
    def run_query(spark: SparkSession, folder: str) -> DataFrame:
        evals = evaluate(inputs.run(spark, folder), inputs.qrels(spark, folder), [name])
        return rounded(summary.report_rows(evals), "value")

    return run_query


for _key, _name in MEASURE_KEYS.items():
    query(_key, evaluation_sql([_name]))(_measure_query(_name))


@query("m_runid", with_ctes([("run", SQL["tagged_run"])], """
SELECT 'all' AS qid, 'runid' AS measure, arg_max(run_id, line) AS text FROM run"""))
def m_runid(spark, folder):
    return measures.run_id(inputs.tagged_run(spark, folder))


@query("m_num_q", with_ctes([("run", SQL["run_of_solvent"]), ("qrels", SQL["qrels_of_large"])], """
SELECT 'all' AS qid, 'num_q' AS measure,
       (SELECT count(DISTINCT qid) FROM run WHERE qid IN (SELECT qid FROM qrels))::DOUBLE AS value"""))
def m_num_q(spark, folder):
    run, qrels = inputs.run_of_solvent(spark, folder), inputs.qrels_of_large(spark, folder)
    return summary.summarize(evaluate(run, qrels, ["num_ret"])).filter("measure = 'num_q'")


@query("m_relstring", with_ctes([("run", SQL["run"]), ("qrels", SQL["qrels"]), *ranked_sql()], """
SELECT qid, 'relstring' AS measure,
       string_agg(CASE WHEN rel > 9 THEN '>' WHEN rel >= 0 THEN rel::VARCHAR
                       WHEN rel = -1 THEN '-' ELSE '.' END, '' ORDER BY rank) AS text
FROM ranked WHERE rank <= 10 GROUP BY qid"""))
def m_relstring(spark, folder):
    run, qrels = inputs.run(spark, folder), inputs.qrels(spark, folder)
    return measures.relevance_strings(ranking.ranked_relevance(run, qrels, max_docs=10))


# -- judgement groups -----------------------------------------------------------------

RANKED_JG = [
    ("run", SQL["run"]),
    ("qj", SQL["qrels_jg"]),
    (
        "ranked",
        """
  SELECT r.qid, g.jg, r.docno, r.rank,
         CAST(CASE WHEN q.rel IS NULL THEN -1 WHEN q.rel < 0 THEN -2 ELSE q.rel END AS INTEGER) AS rel
  FROM (SELECT *, row_number() OVER (
          PARTITION BY qid ORDER BY CAST(score AS FLOAT) DESC, docno DESC) AS rank FROM run) r
  JOIN (SELECT DISTINCT qid, jg FROM qj) g ON g.qid = r.qid
  LEFT JOIN qj q ON q.qid = r.qid AND q.jg = g.jg AND q.docno = r.docno""",
    ),
    (
        "seen",
        """
  SELECT *, CAST(sum(hit) OVER (PARTITION BY qid, jg ORDER BY rank ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cum
  FROM (SELECT *, CASE WHEN rel >= 1 THEN 1 ELSE 0 END AS hit FROM ranked)""",
    ),
    ("t", "SELECT qid, jg, count(*) FILTER (rel >= 1) AS R FROM qj GROUP BY qid, jg"),
]

JG_SQL = {
    "map_avgjg": """
  SELECT t.qid, t.jg, 'map_avgjg' AS measure,
         coalesce(sum(CASE WHEN hit = 1 THEN cum / rank::DOUBLE END), 0) / nullif(max(R), 0) AS value
  FROM t JOIN seen s ON s.qid = t.qid AND s.jg = t.jg GROUP BY t.qid, t.jg""",
    "P_avgjg": f"""
  SELECT t.qid, t.jg, 'P_avgjg_' || c.k AS measure,
         count(*) FILTER (hit = 1 AND rank <= c.k) / c.k::DOUBLE AS value
  FROM t JOIN seen s ON s.qid = t.qid AND s.jg = t.jg CROSS JOIN {DOC_K} GROUP BY t.qid, t.jg, c.k""",
    "Rprec_mult_avgjg": f"""
  SELECT t.qid, t.jg, printf('Rprec_mult_avgjg_%.2f', c.x) AS measure,
         count(*) FILTER (hit = 1 AND rank <= floor(c.x * t.R + 0.9))
           / nullif(any_value(floor(c.x * t.R + 0.9)), 0)::DOUBLE AS value
  FROM t JOIN seen s ON s.qid = t.qid AND s.jg = t.jg CROSS JOIN {MULTIPLES} GROUP BY t.qid, t.jg, c.x""",
}


def _jg_query(name: str) -> Query:
    def run_query(spark: SparkSession, folder: str) -> DataFrame:
        evals = evaluate_groups(inputs.run(spark, folder), inputs.qrels_jg(spark, folder), [name])
        return rounded(summary.report_rows(evals), "value")

    return run_query


for _name in JG_SQL:
    _sql = f"""SELECT qid, measure, avg(coalesce(value, 0)) AS value FROM ({JG_SQL[_name]}) GROUP BY qid, measure"""
    query(f"m_{_name.lower()}", with_ctes([*RANKED_JG, ("v", _sql)], TOPICS_AND_ALL))(_jg_query(_name))


@query("ranked_rel_jg", with_ctes(RANKED_JG, "SELECT qid, jg, docno, rank, rel FROM ranked"))
def ranked_rel_jg(spark, folder):
    groups = ranking.ranked_relevance_by_group(inputs.run(spark, folder), inputs.qrels_jg(spark, folder))
    return groups.df.select("qid", "jg", "docno", "rank", "rel")


def _jg_options(name: str, cut: str, **options) -> None:
    """The three measures with an option; ``cut`` is the ranked list under it, in SQL."""
    ranked = [(n, cut if n == "ranked" else sql) for n, sql in RANKED_JG]
    ranked.insert(2, ("all_ranked", RANKED_JG[2][1]))
    values = " UNION ALL ".join(
        f"SELECT qid, measure, avg(coalesce(value, 0)) AS value FROM ({JG_SQL[n]}) GROUP BY qid, measure" for n in JG_SQL
    )

    def run_query(spark: SparkSession, folder: str) -> DataFrame:
        run, qrels_jg = inputs.run(spark, folder), inputs.qrels_jg(spark, folder)
        return rounded(summary.report_rows(evaluate_groups(run, qrels_jg, list(JG_SQL), **options)), "value")

    query(name, with_ctes([*ranked, ("v", values)], TOPICS_AND_ALL))(run_query)


_jg_options("eval_jg_max100", "SELECT * FROM all_ranked WHERE rank <= 100", max_docs=100)
_jg_options("eval_jg_judged_only", """
  SELECT qid, jg, docno, row_number() OVER (PARTITION BY qid, jg ORDER BY rank) AS rank, rel
  FROM all_ranked WHERE rel >= 0""", judged_only=True)


# -- ranking and joins ----------------------------------------------------------------

RUN_QRELS = [("run", SQL["run"]), ("qrels", SQL["qrels"])]
PARTIAL = [("run", SQL["run_of_solvent"]), ("qrels", SQL["qrels_of_large"])]


def _partial(spark, folder):
    return inputs.run_of_solvent(spark, folder), inputs.qrels_of_large(spark, folder)


@query("topics_in_both", with_ctes(PARTIAL, """
SELECT qid, count(*) AS num_ret FROM run WHERE qid IN (SELECT qid FROM qrels) GROUP BY qid"""))
def topics_in_both(spark, folder):
    kept = ranking.topics_in_both(*_partial(spark, folder))
    return kept.groupBy("qid").agg(F.count("*").alias("num_ret"))


@query("missing_topics", with_ctes(PARTIAL, """
SELECT DISTINCT qid FROM qrels WHERE qid NOT IN (SELECT qid FROM run)"""))
def missing_topics(spark, folder):
    return ranking.missing_topics(*_partial(spark, folder))


@query("rank_run", with_ctes([("run", SQL["run"])], """
SELECT qid, docno, score, row_number() OVER (
         PARTITION BY qid ORDER BY CAST(score AS FLOAT) DESC, docno DESC) AS rank FROM run"""))
def rank_run(spark, folder):
    return ranking.rank_run(inputs.run(spark, folder))


@query("rank_run_prefs", with_ctes([("run", SQL["run"])], """
SELECT qid, docno, score, row_number() OVER (
         PARTITION BY qid ORDER BY CAST(score AS FLOAT) DESC, docno ASC) AS rank FROM run"""))
def rank_run_prefs(spark, folder):
    return ranking.rank_run(inputs.run(spark, folder), ties="asc")


@query("ranked_rel", with_ctes([*RUN_QRELS, *ranked_sql()], "SELECT qid, docno, rank, rel FROM ranked"))
def ranked_rel(spark, folder):
    return ranking.ranked_relevance(inputs.run(spark, folder), inputs.qrels(spark, folder))


@query("topic_stats", with_ctes([*RUN_QRELS, *ranked_sql()], """
SELECT qid, n AS num_ret, nonpool AS num_nonpool, unj AS num_unjudged, rr AS num_rel_ret, R AS num_rel
FROM t"""))
def topic_stats(spark, folder):
    run, qrels = inputs.run(spark, folder), inputs.qrels(spark, folder)
    return ranking.topic_stats(ranking.with_relevance(run, qrels), qrels)


@query("rel_levels", with_ctes([("qrels", SQL["qrels"])], """
SELECT qid, rel, count(*) AS cnt FROM qrels WHERE rel >= 0 GROUP BY qid, rel"""))
def rel_levels(spark, folder):
    return ranking.rel_levels(inputs.qrels(spark, folder))


@query("running_counts", with_ctes([*RUN_QRELS, *ranked_sql()], """
SELECT qid, docno, rank, cum AS rel_seen, nonrel AS nonrel_seen, unjudged AS unjudged_seen FROM seen"""))
def running_counts(spark, folder):
    groups = ranking.ranked_groups(inputs.run(spark, folder), inputs.qrels(spark, folder))
    return ranking.running_counts(groups).df.select(
        "qid", "docno", "rank", "rel_seen", "nonrel_seen", "unjudged_seen"
    )


@query("interp_precision", with_ctes([*RUN_QRELS, *ranked_sql()], f"""
SELECT qid, docno, rank, round(max(cum / rank::DOUBLE) OVER (
         PARTITION BY qid ORDER BY rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), {DIGITS}) AS iprec
FROM seen"""))
def interp_precision(spark, folder):
    run, qrels = inputs.run(spark, folder), inputs.qrels(spark, folder)
    return rounded(ranking.interpolated_precision(run, qrels), "iprec")


@query("ideal_dcg", with_ctes([*RUN_QRELS, *ranked_sql(), *_gain_ctes("rel")], f"""
SELECT qid, pos, gain, round(idcg, {DIGITS}) AS idcg FROM ideal"""))
def ideal_dcg(spark, folder):
    ideal = gains.ideal_ranking(inputs.qrels(spark, folder))
    return rounded(ideal.select("qid", "pos", "gain", "idcg"), "idcg")


# Gains that differ from the levels, one of them negative and one on level 0.
GAINS = {0: 0.5, 1: 3.5, 2: -1.0, 3: 9.0}
GAIN_CASE = "CASE rel WHEN 0 THEN 0.5 WHEN 1 THEN 3.5 WHEN 2 THEN -1.0 WHEN 3 THEN 9.0 ELSE rel END"
GAIN_NAMES = ["ndcg", "ndcg_rel", "Rndcg", "G"]


@query("ndcg_gains", evaluation_sql(GAIN_NAMES, gain=GAIN_CASE, gain_label="{name}_0=0.5,1=3.5,2=-1,3=9"))
def ndcg_gains(spark, folder):
    run, qrels = inputs.run(spark, folder), inputs.qrels(spark, folder)
    evals = evaluate(run, qrels, {name: GAINS for name in GAIN_NAMES})
    return rounded(summary.report_rows(evals), "value")


# -- options --------------------------------------------------------------------------

SOME = ["num_ret", "num_rel", "num_rel_ret", "map", "bpref", "P", "infAP", "num_nonrel_judged_ret"]


def _option_query(run: Callable = inputs.run, qrels: Callable = inputs.qrels, **options) -> Query:
    def run_query(spark: SparkSession, folder: str) -> DataFrame:
        evals = evaluate(run(spark, folder), qrels(spark, folder), SOME, **options)
        return rounded(summary.report_rows(evals), "value")

    return run_query


query("eval_judged_only", evaluation_sql(SOME, judged_only=True))(_option_query(judged_only=True))
query("eval_level2", evaluation_sql(SOME, level=2))(_option_query(level=2))
query("eval_max100", evaluation_sql(SOME, max_docs=100))(_option_query(max_docs=100))
query("eval_one_topic", evaluation_sql(SOME, body="""
SELECT qid, measure, round(value, 8) AS value FROM v WHERE qid = 'S7'
UNION ALL SELECT 'all' AS qid, measure, round(value, 8) AS value FROM v WHERE qid = 'S7'"""))(
    _option_query(qid="S7")
)
# All measures that have a value for each topic.
VALUED = [n for n in [*VALUES_SQL, *GAIN_SQL, "ndcg_cut"] if n in measures.ALL_QRELS]
query("eval_grouping_sets", evaluation_sql(
    VALUED,
    body=f"""
SELECT CASE WHEN grouping(qid) = 1 THEN 'all' ELSE qid END AS qid, measure,
       round({SUMMARY_VALUE}, {DIGITS}) AS value
FROM v GROUP BY GROUPING SETS ((qid, measure), (measure))
HAVING grouping(qid) = 1 OR measure NOT IN {GEOMETRIC}""",
))(lambda spark, folder: rounded(summary.report_rows(evaluate(
    inputs.run(spark, folder), inputs.qrels(spark, folder),
    VALUED,
)), "value"))


# -- summaries ------------------------------------------------------------------------


def _summary_query(names: list[str], complete: bool = False) -> Query:
    def run_query(spark: SparkSession, folder: str) -> DataFrame:
        run, qrels = _partial(spark, folder)
        return rounded(summary.summarize(evaluate(run, qrels, names), qrels, complete), "value")

    return run_query


def _summary_sql(names: list[str], value: str, num_q: str) -> str:
    return evaluation_sql(names, run="run_of_solvent", qrels="qrels_of_large", body=f"""
SELECT 'all' AS qid, measure, round({value}, {DIGITS}) AS value FROM v GROUP BY measure
UNION ALL SELECT 'all' AS qid, 'num_q' AS measure, ({num_q})::DOUBLE AS value""")


IN_BOTH = "SELECT count(DISTINCT qid) FROM v"
JUDGED = "SELECT count(DISTINCT qid) FROM qrels"
MEANS = ["map", "Rprec", "bpref", "recip_rank", "P", "ndcg"]
COMPLETE_VALUE = f"""CASE WHEN measure = 'num_rel' THEN (SELECT count(*) FROM qrels WHERE rel > 0)
  WHEN measure IN {SUMS} THEN sum(value)
  WHEN measure IN {GEOMETRIC} THEN exp((sum(ln(greatest(value, 0.00001)))
       + (({JUDGED}) - count(*)) * ln(0.00001)) / ({JUDGED}))
  ELSE sum(value) / ({JUDGED}) END"""

query("summary_mean", _summary_sql(MEANS, "avg(value)", IN_BOTH))(_summary_query(MEANS))
_COUNTS = ["num_ret", "num_rel", "num_rel_ret", "num_nonrel_judged_ret"]
query("summary_counts", _summary_sql(_COUNTS, "sum(value)", IN_BOTH))(_summary_query(_COUNTS))
_GM = ["gm_map", "gm_bpref"]
query("summary_geometric", _summary_sql(_GM, SUMMARY_VALUE, IN_BOTH))(_summary_query(_GM))
_COMPLETE = [*MEANS, *_COUNTS, *_GM]
query("summary_complete", _summary_sql(_COMPLETE, COMPLETE_VALUE, JUDGED))(
    _summary_query(_COMPLETE, complete=True)
)


# -- z-scores: runs that differ in the discount they ask for ---------------------------

ZNAMES = ["map", "P", "recip_rank", "gm_map"]


def _threshold_run(spark, folder, discount):
    best = (
        inputs.table(spark, folder, "lineitem")
        .filter(F.col("l_discount") >= discount)
        .groupBy("l_suppkey", "l_partkey")
        .agg(F.max("l_extendedprice").alias("price"))
    )
    return best.select(
        F.concat(F.lit("S"), "l_suppkey").alias("qid"),
        F.concat(F.lit("P"), "l_partkey").alias("docno"),
        F.floor(F.col("price") / 100).cast("double").alias("score"),
    )


THRESHOLDS = (0.02, 0.05, 0.08)


def _many_evals(spark, folder):
    qrels = inputs.qrels(spark, folder)
    evals = [evaluate(_threshold_run(spark, folder, d), qrels, ZNAMES) for d in THRESHOLDS]
    return evals[0].unionByName(evals[1]).unionByName(evals[2])


def _zscore_sql() -> list[tuple[str, str]]:
    """The same measures for the three runs, as CTEs ``v1 v2 v3`` and the reference ``z``."""
    ctes = [("qrels", SQL["qrels"])]
    for i, d in enumerate(THRESHOLDS, 1):
        ctes.append((f"run{i}", SQL["run"].replace("0.05", str(d))))
        for name, sql in ranked_sql():
            for other in ("cut_run", "judged_run", "ranked", "seen"):
                sql = sql.replace(f"FROM {other}", f"FROM {other}{i}")
            sql = sql.replace("FROM run ", f"FROM run{i} ")
            ctes.append((f"{name}{i}", sql))
        parts = _values([VALUES_SQL[n] for n in ZNAMES])
        parts = parts.replace("FROM t JOIN seen s", f"FROM t{i} t JOIN seen{i} s")
        parts = parts.replace("FROM seen GROUP", f"FROM seen{i} GROUP")
        logged = f"SELECT qid, measure, CASE WHEN measure = 'gm_map' THEN ln(greatest(value, 0.00001)) ELSE value END AS value FROM ({parts})"
        ctes.append((f"v{i}", logged))
    union = " UNION ALL ".join(f"SELECT * FROM v{i}" for i in (1, 2, 3))
    ctes.append(("z", f"""
  SELECT qid, measure, avg(value) AS mean,
         CASE WHEN max(value) - min(value) <= 1e-9 * greatest(abs(max(value)), abs(min(value))) THEN 0
              ELSE stddev(value) END AS stddev
  FROM ({union}) GROUP BY qid, measure"""))
    return ctes


@query("zscore_reference", with_ctes(_zscore_sql(), f"""
SELECT qid, measure, round(mean, {DIGITS}) AS mean, round(stddev, {DIGITS}) AS stddev FROM z"""))
def zscore_reference(spark, folder):
    return rounded(summary.zscore_reference(_many_evals(spark, folder)), "mean", "stddev")


@query("eval_zscore", with_ctes(_zscore_sql(), """
, zs AS (SELECT v2.qid, v2.measure,
         CASE WHEN stddev <> 0 THEN (value - mean) / stddev
              WHEN abs(value - mean) <= 1e-9 * greatest(abs(value), abs(mean)) THEN 0 ELSE -1000000 END AS value
       FROM v2 JOIN z ON v2.qid = z.qid AND v2.measure = z.measure)
SELECT qid, measure, round(value, 4) AS value FROM zs WHERE measure <> 'gm_map'
UNION ALL
SELECT 'all' AS qid, measure,
       round(CASE WHEN measure = 'gm_map' THEN exp(avg(value)) ELSE avg(value) END, 4) AS value
FROM zs GROUP BY measure""".replace("\n, zs", ", zs", 1)))
def eval_zscore(spark, folder):
    evals = evaluate(inputs.run(spark, folder), inputs.qrels(spark, folder), ZNAMES)
    reference = summary.zscore_reference(_many_evals(spark, folder))
    rows = summary.report_rows(summary.zscore(evals, reference))
    return rows.withColumn("value", F.round("value", 4))


# -- parameters, report, checks -------------------------------------------------------


@query("measure_params", with_ctes([*RUN_QRELS, *ranked_sql(), *_gain_ctes(
    "CASE rel WHEN 1 THEN 3 WHEN 2 THEN 9 ELSE rel END"), ("ip", f"""
  SELECT t.qid, c.x, any_value(t.rr) AS rr, any_value(floor(c.x * t.R + 0.9)) AS cut,
         max(CASE WHEN s.cum >= floor(c.x * t.R + 0.9) THEN s.cum / s.rank::DOUBLE END) AS best
  FROM t JOIN seen s ON s.qid = t.qid
  CROSS JOIN (VALUES (0.1::DOUBLE),(0.25),(0.5),(0.75)) AS c(x) GROUP BY t.qid, c.x"""), ("v", _values([
    "SELECT qid, printf('iprec_at_recall_%.2f', x) AS measure, CASE WHEN cut > rr THEN 0 ELSE best END AS value FROM ip",
    at_cut("P", "h / k::DOUBLE", "(VALUES (3),(5),(7)) AS c(k)"),
    at_cut("recall", "h / nullif(R, 0)::DOUBLE", "(VALUES (20),(2000)) AS c(k)"),
    stat("utility_2,-1,0,0", "2.0 * rr - (n - rr)"),
    "SELECT qid, '11pt_avg_0.25,0.5,0.75' AS measure, sum(CASE WHEN cut > rr THEN 0 ELSE best END) / 3 AS value FROM ip WHERE x > 0.2 GROUP BY qid",
    GAIN_SQL["ndcg"].replace("{label}", "ndcg_1=3,2=9"),
    at_cut("success", "CASE WHEN h > 0 THEN 1.0 ELSE 0.0 END", "(VALUES (2),(5),(20)) AS c(k)"),
]))], TOPICS_AND_ALL))
def measure_params(spark, folder):
    evals = evaluate(inputs.run(spark, folder), inputs.qrels(spark, folder), {
        "iprec_at_recall": [0.1, 0.25, 0.75, 0.5],
        "P": [5, 7, 3],
        "recall": [20, 2000],
        "utility": [2, -1, 0, 0],
        "11pt_avg": [0.25, 0.5, 0.75],
        "ndcg": {1: 3.0, 2: 9.0},
        "success": [2, 5, 20],
    })
    return rounded(summary.report_rows(evals), "value")


REPORT_SQL = f"""
, rows_ AS (
  SELECT qid, measure, value FROM v
  UNION ALL
  SELECT 'all', measure, {SUMMARY_VALUE} FROM v GROUP BY measure
  UNION ALL SELECT 'all', 'num_q', count(DISTINCT qid)::DOUBLE FROM v)
SELECT qid, measure, CASE WHEN measure IN ('num_ret','num_rel','num_rel_ret','num_q')
    THEN printf('%-22s' || chr(9) || '%s' || chr(9) || '%d', measure, qid, value::BIGINT)
    ELSE printf('%-22s' || chr(9) || '%s' || chr(9) || '%6.4f', measure, qid, value) END AS line
FROM rows_
UNION ALL
SELECT qid, 'relstring' AS measure, printf('%-22s' || chr(9) || '%s' || chr(9) || '''%s''', 'relstring', qid,
       string_agg(CASE WHEN rel > 9 THEN '>' WHEN rel >= 0 THEN rel::VARCHAR
                       WHEN rel = -1 THEN '-' ELSE '.' END, '' ORDER BY rank)) AS line
FROM ranked WHERE rank <= 10 GROUP BY qid
UNION ALL
SELECT 'all', 'runid', printf('%-22s' || chr(9) || '%s' || chr(9) || '%s', 'runid', 'all', arg_max(run_id, line)) FROM run"""
_REPORT_NAMES = ["num_ret", "num_rel", "num_rel_ret", "map", "Rprec", "bpref", "recip_rank"]
query("report_lines", evaluation_sql(_REPORT_NAMES, body="", run="tagged_run").rstrip() + REPORT_SQL)(
    lambda spark, folder: report_lines(report(
        inputs.tagged_run(spark, folder), inputs.qrels(spark, folder),
        [*_REPORT_NAMES, "num_q", "relstring", "runid"], per_topic=True,
    ))
)


@query("dup_check", """
SELECT 'S' || l_suppkey AS qid, 'P' || l_partkey AS docno, count(*) AS n
FROM lineitem GROUP BY l_suppkey, l_partkey HAVING count(*) > 1""")
def dup_check(spark, folder):
    lines = inputs.table(spark, folder, "lineitem").select(
        F.concat(F.lit("S"), "l_suppkey").alias("qid"), F.concat(F.lit("P"), "l_partkey").alias("docno")
    )
    return checks.duplicates(lines, ["qid", "docno"])


@query("dup_check_jg", """
SELECT 'S' || l_suppkey AS qid, l_returnflag AS jg, 'P' || l_partkey AS docno, count(*) AS n
FROM lineitem GROUP BY l_suppkey, l_returnflag, l_partkey HAVING count(*) > 1""")
def dup_check_jg(spark, folder):
    lines = inputs.table(spark, folder, "lineitem").select(
        F.concat(F.lit("S"), "l_suppkey").alias("qid"),
        F.col("l_returnflag").alias("jg"),
        F.concat(F.lit("P"), "l_partkey").alias("docno"),
    )
    return checks.duplicates(lines, ["qid", "jg", "docno"])
