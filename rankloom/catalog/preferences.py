"""Queries on preference judgements. The SQL lists every document pair; the engine does not."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import summary
from ..operators.prefs import Preferences, pref_documents, preference_errors
from ..plans.evaluate import evaluate_prefs
from . import inputs
from .evaluation import TOPICS_AND_ALL, Query, rounded
from .inputs import SQL, with_ctes

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def wrap(function: Query) -> Query:
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return wrap


MEMBER = """'{"jsg":"' || jsg || '","level":' || rel_level::DOUBLE || '}'"""


def pref_ctes(prefs: str) -> list[tuple[str, str]]:
    return [
        ("run", SQL["run"]),
        ("prefs_in", SQL[prefs]),
        ("prefs", "SELECT * FROM prefs_in WHERE qid IN (SELECT qid FROM run)"),
        (
            "d",
            """
  SELECT p.qid, p.docno, r.score IS NOT NULL AS ret,
         row_number() OVER (PARTITION BY p.qid ORDER BY r.score IS NULL,
           CAST(r.score AS FLOAT) DESC, p.docno) - 1 AS dr
  FROM (SELECT DISTINCT qid, docno FROM prefs) p
  LEFT JOIN run r ON r.qid = p.qid AND r.docno = p.docno""",
        ),
        (
            "p",
            """
  SELECT p.qid, p.jg, p.jsg, p.rel_level, d.dr, d.ret
  FROM prefs p JOIN d ON d.qid = p.qid AND d.docno = p.docno""",
        ),
        (
            "jd",
            f"""
  SELECT qid, jg, dr, any_value(ret) AS ret, max(rel_level) AS level, count(*) AS subs,
         '[' || string_agg({MEMBER}, ',' ORDER BY jsg, rel_level) || ']' AS class
  FROM p GROUP BY qid, jg, dr""",
        ),
        (
            "g",
            """
  SELECT p.qid, p.jg, count(DISTINCT jsg) = 1 AS single FROM p GROUP BY p.qid, p.jg""",
        ),
        (
            "base",
            """
  SELECT DISTINCT a.qid, a.jg, a.dr AS i, b.dr AS j
  FROM p a JOIN p b ON a.qid = b.qid AND a.jg = b.jg AND a.jsg = b.jsg AND a.rel_level > b.rel_level""",
        ),
        (
            "bridge",
            """
  SELECT b.* FROM base b JOIN jd ON jd.qid = b.qid AND jd.jg = b.jg AND jd.dr = b.i WHERE jd.subs > 1""",
        ),
        (
            "clo",
            """
  SELECT qid, jg, i, j FROM base
  UNION
  SELECT c.qid, c.jg, c.i, b.j FROM clo c JOIN bridge b ON b.qid = c.qid AND b.jg = c.jg AND b.i = c.j""",
        ),
        (
            "pairs",
            """
  SELECT c.qid, c.jg, c.i, c.j, a.ret AS ri, b.ret AS rj
  FROM clo c JOIN jd a ON a.qid = c.qid AND a.jg = c.jg AND a.dr = c.i
             JOIN jd b ON b.qid = c.qid AND b.jg = c.jg AND b.dr = c.j""",
        ),
        (
            "dc",
            """
  SELECT jd.qid, jd.jg, any_value(single) AS single, count(*) FILTER (level > 0) AS num_rel,
         count(*) FILTER (level > 0 AND ret) AS num_rel_ret,
         count(*) FILTER (CASE WHEN single THEN level <= 0 ELSE level = 0 END) AS num_nonrel,
         count(*) FILTER (ret AND CASE WHEN single THEN level <= 0 ELSE level = 0 END) AS num_nonrel_ret
  FROM jd JOIN g ON g.qid = jd.qid AND g.jg = jd.jg GROUP BY jd.qid, jd.jg""",
        ),
        (
            "jc",
            """
  SELECT dc.qid, dc.jg, count(*) FILTER (ri AND rj AND i < j) AS fr, count(*) FILTER (ri AND rj) AS pr,
         count(*) FILTER (ri AND NOT rj) AS fi, count(*) FILTER (ri <> rj) AS pi,
         count(*) FILTER (NOT ri AND NOT rj) AS no
  FROM dc LEFT JOIN pairs x ON x.qid = dc.qid AND x.jg = dc.jg GROUP BY dc.qid, dc.jg""",
        ),
    ]


BALANCED = [
    (
        "ord",
        """
  SELECT jd.*, dc.single, dc.num_rel, dc.num_rel_ret,
         level = min(level) OVER (PARTITION BY jd.qid, jd.jg) AS lowest,
         count(*) FILTER (level = 0) OVER (PARTITION BY jd.qid, jd.jg ORDER BY dr) AS zeros
  FROM jd JOIN dc ON dc.qid = jd.qid AND dc.jg = jd.jg""",
    ),
    (
        "kept",
        """
  SELECT qid, jg, dr, ret, row_number() OVER (PARTITION BY qid, jg ORDER BY dr) AS no, num_rel, num_rel_ret
  FROM ord WHERE single AND lowest""",
    ),
    (
        "cut_pairs",
        """
  SELECT x.qid, x.jg, ri AND i < j AS ful, ri AND rj AS seen
  FROM pairs x JOIN ord a ON a.qid = x.qid AND a.jg = x.jg AND a.dr = x.i
               JOIN ord b ON b.qid = x.qid AND b.jg = x.jg AND b.dr = x.j
  WHERE CASE WHEN a.single THEN NOT b.lowest
             ELSE (a.level <> 0 OR a.zeros <= a.num_rel) AND (b.level <> 0 OR b.zeros <= b.num_rel) END""",
    ),
    (
        "kept_pairs",
        """
  SELECT k.qid, k.jg, a.ret AND a.dr < k.dr AS ful, a.ret AND k.ret AND k.no <= k.num_rel_ret AS seen,
         k.no <= k.num_rel AS full_cut
  FROM kept k JOIN jd a ON a.qid = k.qid AND a.jg = k.jg""",
    ),
    (
        "cut",
        """
  SELECT qid, jg, count(*) FILTER (full_cut AND ful) AS ful, count(*) FILTER (full_cut) AS poss,
         count(*) FILTER (seen AND ful) AS ful_r, count(*) FILTER (seen) AS poss_r
  FROM (SELECT qid, jg, ful, seen, true AS full_cut FROM cut_pairs
        UNION ALL SELECT qid, jg, ful, seen, full_cut FROM kept_pairs)
  GROUP BY qid, jg""",
    ),
    (
        "bal",
        """
  SELECT dc.qid, dc.jg,
    CASE WHEN num_rel >= num_nonrel THEN fr + fi + num_rel_ret * (num_rel - num_nonrel) ELSE c.ful END AS ful,
    CASE WHEN num_rel >= num_nonrel THEN pr + pi + no + num_rel * (num_rel - num_nonrel) ELSE c.poss END AS poss,
    CASE WHEN num_rel_ret >= num_nonrel_ret THEN fr + num_rel_ret * (num_rel_ret - num_nonrel_ret) ELSE c.ful_r END AS ful_r,
    CASE WHEN num_rel_ret >= num_nonrel_ret THEN pr + num_rel * (num_rel_ret - num_nonrel_ret) ELSE c.poss_r END AS poss_r
  FROM dc JOIN jc ON jc.qid = dc.qid AND jc.jg = dc.jg
  LEFT JOIN cut c ON c.qid = dc.qid AND c.jg = dc.jg""",
    ),
]

COUNTED_PAIRS = [
    ("c", "SELECT qid, i, j, count(*) AS n FROM pairs GROUP BY qid, i, j"),
    (
        "u",
        """
  SELECT x.qid, x.a, x.b, a.ret AS ra, b.ret AS rb,
         coalesce(f.n, 0) / (coalesce(f.n, 0) + coalesce(k.n, 0))::DOUBLE AS share
  FROM (SELECT DISTINCT qid, least(i, j) AS a, greatest(i, j) AS b FROM c) x
  JOIN d a ON a.qid = x.qid AND a.dr = x.a JOIN d b ON b.qid = x.qid AND b.dr = x.b
  LEFT JOIN c f ON f.qid = x.qid AND f.i = x.a AND f.j = x.b
  LEFT JOIN c k ON k.qid = x.qid AND k.i = x.b AND k.j = x.a""",
    ),
]

DOUBLE = "::DOUBLE"
GROUP_SQL = {
    "prefs_num_prefs_poss": "sum(pr + pi + no)",
    "prefs_num_prefs_ful": "sum(fr + fi)",
    "prefs_num_prefs_ful_ret": "sum(fr)",
    "prefs_simp": "sum(fr + fi) / nullif(sum(pr + pi + no), 0)::DOUBLE",
    "prefs_simp_ret": "sum(fr) / nullif(sum(pr), 0)::DOUBLE",
    "prefs_simp_imp": "sum(fr + fi) / nullif(sum(pr + pi), 0)::DOUBLE",
    "prefs_avgjg": "avg(coalesce((fr + fi) / nullif(pr + pi + no, 0)::DOUBLE, 0))",
    "prefs_avgjg_ret": "avg(coalesce(fr / nullif(pr, 0)::DOUBLE, 0))",
    "prefs_avgjg_imp": "avg(coalesce((fr + fi) / nullif(pr + pi, 0)::DOUBLE, 0))",
}
BALANCE_SQL = {
    "prefs_avgjg_Rnonrel": ("ful", "poss"),
    "prefs_avgjg_Rnonrel_ret": ("ful_r", "poss_r"),
}
PAIR_SQL = {
    "prefs_pair": ("sum(CASE WHEN ra THEN share ELSE 0 END)", "count(*)"),
    "prefs_pair_ret": (
        "sum(CASE WHEN ra AND rb THEN share ELSE 0 END)",
        "count(*) FILTER (ra AND rb)",
    ),
    "prefs_pair_imp": ("sum(CASE WHEN ra THEN share ELSE 0 END)", "count(*) FILTER (ra OR rb)"),
}

MEASURE_KEYS = {
    "m_prefs_num_poss": "prefs_num_prefs_poss",
    "m_prefs_num_ful": "prefs_num_prefs_ful",
    "m_prefs_num_ful_ret": "prefs_num_prefs_ful_ret",
    "m_prefs_simp": "prefs_simp",
    "m_prefs_simp_ret": "prefs_simp_ret",
    "m_prefs_simp_imp": "prefs_simp_imp",
    "m_prefs_pair": "prefs_pair",
    "m_prefs_pair_ret": "prefs_pair_ret",
    "m_prefs_pair_imp": "prefs_pair_imp",
    "m_prefs_avgjg": "prefs_avgjg",
    "m_prefs_avgjg_ret": "prefs_avgjg_ret",
    "m_prefs_avgjg_imp": "prefs_avgjg_imp",
    "m_prefs_rnonrel": "prefs_avgjg_Rnonrel",
    "m_prefs_rnonrel_ret": "prefs_avgjg_Rnonrel_ret",
}

REPORT = TOPICS_AND_ALL.replace(
    "('num_ret',", "('prefs_num_prefs_poss','prefs_num_prefs_ful','prefs_num_prefs_ful_ret','num_ret',"
)


def measure_sql(name: str, prefs: str) -> str:
    ctes = pref_ctes(prefs)
    if name in GROUP_SQL:
        value = f"SELECT qid, '{name}' AS measure, {GROUP_SQL[name]} AS value FROM jc GROUP BY qid"
    elif name in BALANCE_SQL:
        ctes += BALANCED
        top, bottom = BALANCE_SQL[name]
        value = f"""
  SELECT qid, '{name}' AS measure, CASE WHEN min({bottom}) = 0 THEN 0
         ELSE avg({top} / nullif({bottom}, 0)::DOUBLE) END AS value FROM bal GROUP BY qid"""
    else:
        ctes += COUNTED_PAIRS
        top, bottom = PAIR_SQL[name]
        value = f"""
  SELECT t.qid, '{name}' AS measure, x.value FROM (SELECT DISTINCT qid FROM d) t LEFT JOIN (
    SELECT qid, {top} / nullif({bottom}, 0)::DOUBLE AS value FROM u GROUP BY qid) x ON x.qid = t.qid"""
    v = f"SELECT qid, measure, coalesce(value, 0)::DOUBLE AS value FROM ({value})"
    return with_ctes([*ctes, ("v", v)], REPORT, recursive=True)


def _measure_query(name: str, prefs) -> Query:
    def run_query(spark: SparkSession, folder: str) -> DataFrame:
        evals = evaluate_prefs(inputs.run(spark, folder), prefs(spark, folder), [name])
        return rounded(summary.report_rows(evals), "value")

    return run_query


for _key, _name in MEASURE_KEYS.items():
    query(_key, measure_sql(_name, "prefs"))(_measure_query(_name, inputs.prefs))

# The same for judgements read as preferences: one sub-group per group, ordered classes.
for _key in ("m_prefs_simp", "m_prefs_pair", "m_prefs_avgjg_ret", "m_prefs_rnonrel", "m_prefs_rnonrel_ret"):
    _name = MEASURE_KEYS[_key]
    query(f"{_key}_of_qrels", measure_sql(_name, "qrels_as_prefs"))(
        _measure_query(_name, inputs.qrels_as_prefs)
    )


def _tables(spark: SparkSession, folder: str) -> Preferences:
    return Preferences(inputs.run(spark, folder), inputs.prefs(spark, folder))


@query("pref_docids", with_ctes(pref_ctes("prefs")[:4], """
SELECT qid, docno, dr AS doc_rank, ret AS retrieved FROM d"""))
def pref_docids(spark, folder):
    return pref_documents(inputs.run(spark, folder), inputs.prefs(spark, folder))


@query("pref_pairs", with_ctes(pref_ctes("prefs")[:5], """
SELECT a.qid, a.jg, a.jsg, a.rel_level::DOUBLE AS level, b.rel_level::DOUBLE AS below, count(*) AS pairs
FROM p a JOIN p b ON a.qid = b.qid AND a.jg = b.jg AND a.jsg = b.jsg AND a.rel_level > b.rel_level
GROUP BY ALL"""))
def pref_pairs(spark, folder):
    return _tables(spark, folder).explicit()


@query("pref_closure", with_ctes(pref_ctes("prefs")[:10], """
SELECT DISTINCT c.qid, c.jg, a.class AS class, b.class AS below
FROM clo c JOIN g ON g.qid = c.qid AND g.jg = c.jg
JOIN jd a ON a.qid = c.qid AND a.jg = c.jg AND a.dr = c.i
JOIN jd b ON b.qid = c.qid AND b.jg = c.jg AND b.dr = c.j
WHERE NOT single""", recursive=True))
def pref_closure(spark, folder):
    return _tables(spark, folder).closure()


@query("pref_areas", with_ctes(pref_ctes("prefs"), """
SELECT qid, jg, fr AS ful_ret, pr AS poss_ret, fi AS ful_imp, pi AS poss_imp, no AS poss_none
FROM jc""", recursive=True))
def pref_areas(spark, folder):
    return _tables(spark, folder).group_counts().select(
        "qid", "jg", "ful_ret", "poss_ret", "ful_imp", "poss_imp", "poss_none"
    )


@query("pref_jg_counts", with_ctes([*pref_ctes("prefs")[:7], pref_ctes("prefs")[11]], """
SELECT qid, jg, num_rel, num_rel_ret, num_nonrel, num_nonrel_ret FROM dc"""))
def pref_jg_counts(spark, folder):
    return _tables(spark, folder).doc_counts()


@query("pref_pair_counts", with_ctes([*pref_ctes("prefs"), COUNTED_PAIRS[0]], """
SELECT f.qid, f.n AS c, coalesce(k.n, 0) AS c_back, count(*) AS pairs
FROM c f LEFT JOIN c k ON k.qid = f.qid AND k.i = f.j AND k.j = f.i GROUP BY ALL""", recursive=True))
def pref_pair_counts(spark, folder):
    return _tables(spark, folder).pair_counts()


# Judgements whose level depends on the line: documents get several levels.
MIXED_SQL = """
  SELECT DISTINCT 'S' || l_suppkey AS qid, 'P' || l_partkey AS docno, l_returnflag AS jg,
         l_linestatus AS jsg, CAST(l_quantity AS FLOAT) % 5 AS rel_level FROM lineitem"""


@query("pref_reach", with_ctes([*pref_ctes("prefs")[:7], ("own", """
  SELECT p.qid, p.jg, p.jsg, rel_level::DOUBLE AS level, dr FROM p JOIN g ON g.qid = p.qid AND g.jg = p.jg AND NOT single"""),
    ("reach", """
  SELECT qid, jg, dr, jsg, level FROM own
  UNION
  SELECT r.qid, r.jg, r.dr, t.jsg, t.level FROM reach r
  JOIN own b ON b.qid = r.qid AND b.jg = r.jg AND b.jsg = r.jsg AND b.level < r.level
  JOIN own t ON t.qid = b.qid AND t.jg = b.jg AND t.dr = b.dr AND t.jsg <> b.jsg""")], """
SELECT qid, jg, dr AS doc_rank, jsg, max(level) AS level FROM reach GROUP BY ALL""", recursive=True))
def pref_reach(spark, folder):
    """The level of each sub-group under which everything is below a document."""
    tables = _tables(spark, folder)
    return tables.reach_levels()


@query("pref_conflicts", with_ctes([("m", MIXED_SQL), ("state", """
  SELECT qid, jg, docno, jsg, rel_level AS level FROM m
  UNION
  SELECT s.qid, s.jg, s.docno, b.to_jsg, b.to_level FROM state s
  JOIN (SELECT DISTINCT a.qid, a.jg, a.jsg, a.rel_level, t.jsg AS to_jsg, t.rel_level AS to_level
        FROM m a JOIN m t ON a.qid = t.qid AND a.jg = t.jg AND a.docno = t.docno) b
    ON b.qid = s.qid AND b.jg = s.jg AND b.jsg = s.jsg AND b.rel_level < s.level""")], """
SELECT DISTINCT qid, jg, docno, 'two levels' AS rule FROM m
GROUP BY qid, jg, jsg, docno HAVING count(DISTINCT rel_level) > 1
UNION ALL
SELECT qid, jg, docno, 'zero and non-zero' AS rule FROM m
GROUP BY qid, jg, docno HAVING bool_or(rel_level = 0) AND bool_or(rel_level > 0)
UNION ALL
SELECT DISTINCT m.qid, m.jg, m.docno, 'contradiction' AS rule FROM m JOIN state s
ON s.qid = m.qid AND s.jg = m.jg AND s.docno = m.docno AND s.jsg = m.jsg AND m.rel_level < s.level""", recursive=True))
def pref_conflicts(spark, folder):
    lines = inputs.table(spark, folder, "lineitem").select(
        F.concat(F.lit("S"), "l_suppkey").alias("qid"),
        F.concat(F.lit("P"), "l_partkey").alias("docno"),
        F.col("l_returnflag").alias("jg"),
        F.col("l_linestatus").alias("jsg"),
        (F.col("l_quantity").cast("float") % 5).alias("rel_level"),
    )
    return preference_errors(lines.distinct())
