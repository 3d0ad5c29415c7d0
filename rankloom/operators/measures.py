"""Measures on ranked relevance lists.

Every measure is a per-topic SQL expression over sums of row expressions. ``Sheet`` collects
the row sums that the chosen measures need, so one pass over the ranked rows and one
``groupBy`` per topic serve all of them. The functions below are generators of
``(name, value)`` pairs; ``register_measure`` adds further ones.

Row columns: ``rank rel is_rel rel_seen nonrel_seen unjudged_seen`` and, per topic,
``num_rel num_nonrel``. Topic columns: ``num_ret num_rel num_rel_ret num_nonpool
num_unjudged num_nonrel``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranking import NOT_POOLED, UNJUDGED

# Default cut-offs, points and parameters of the published measures.
DOC_CUTS = (5, 10, 15, 20, 30, 100, 200, 500, 1000)
SUCCESS_CUTS = (1, 5, 10)
RECALL_POINTS = (0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)
R_MULTIPLES = (0.2, 0.4, 0.6, 0.8, 1.0, 1.2, 1.4, 1.6, 1.8, 2.0)
UTILITY_WEIGHTS = (1.0, -1.0, 0.0, 0.0)
INFAP_EPSILON = 0.00001
GEOMETRIC_FLOOR = 0.00001
RELSTRING_LENGTH = 10
ROUND_UP = 0.9

# Members of the measure sets, in report order.
OFFICIAL = (
    "runid num_q num_ret num_rel num_rel_ret map gm_map Rprec bpref recip_rank "
    "iprec_at_recall P"
).split()
ALL_QRELS = (
    "runid num_q num_ret num_rel num_rel_ret map gm_map Rprec bpref recip_rank "
    "iprec_at_recall P relstring recall infAP gm_bpref utility 11pt_avg ndcg relative_P "
    "Rprec_mult success map_cut ndcg_cut ndcg_rel Rndcg binG G set_P set_recall "
    "set_relative_P set_map set_F num_nonrel_judged_ret"
).split()
SET = (
    "runid num_q num_ret num_rel num_rel_ret utility set_P set_recall set_relative_P "
    "set_map set_F"
).split()
QRELS_JG = "runid num_q map_avgjg P_avgjg Rprec_mult_avgjg".split()
PREFS = (
    "runid num_q prefs_num_prefs_poss prefs_num_prefs_ful prefs_num_prefs_ful_ret "
    "prefs_simp prefs_pair prefs_avgjg"
).split()
ALL_PREFS = (
    "runid num_q prefs_num_prefs_poss prefs_num_prefs_ful prefs_num_prefs_ful_ret "
    "prefs_simp prefs_pair prefs_avgjg prefs_avgjg_Rnonrel prefs_simp_ret prefs_pair_ret "
    "prefs_avgjg_ret prefs_avgjg_Rnonrel_ret prefs_simp_imp prefs_pair_imp prefs_avgjg_imp"
).split()
MEASURE_SETS = {
    "official": OFFICIAL,
    "all": ALL_QRELS,
    "set": SET,
    "qrels_jg": QRELS_JG,
    "prefs": PREFS,
    "all_prefs": ALL_PREFS,
}

# Measures whose summary is a sum, and those averaged geometrically.
COUNT_MEASURES = frozenset(
    "num_ret num_rel num_rel_ret num_nonrel_judged_ret prefs_num_prefs_poss "
    "prefs_num_prefs_ful prefs_num_prefs_ful_ret".split()
)
GEOMETRIC_MEASURES = frozenset(["gm_map", "gm_bpref"])


def ratio(top: str, bottom: str) -> str:
    """``top / bottom``, and 0 where ``bottom`` is 0."""
    return f"if(({bottom}) = 0, 0D, ({top}) / ({bottom}))"


def share_cut(point: float, total: str) -> str:
    """Number of documents at the share ``point`` of ``total``."""
    return f"floor({float(point)!r}D * {total} + {ROUND_UP}D)"


def _name(text: str) -> str:
    return "".join(ch if ch.isalnum() else "_" for ch in text)


class Sheet:
    """Row sums requested by measures, each computed once per topic.

    Expressions are SQL text; a method returns the name of the column it asks for.
    """

    def __init__(self, level: int = 1, collection_size: int = 0) -> None:
        self.level = level
        self.collection_size = collection_size
        self._sums: dict[str, str] = {}

    def _add(self, name: str, aggregate: str) -> str:
        self._sums.setdefault(_name(name), aggregate)
        return _name(name)

    def rel_sum(self, name: str, value: str) -> str:
        """Sum of ``value`` over the relevant retrieved documents."""
        return self._add(name, f"coalesce(sum(if(is_rel, {value}, null)), 0D)")

    def rel_max(self, name: str, value: str) -> str:
        return self._add(name, f"coalesce(max(if(is_rel, {value}, null)), 0D)")

    def hits(self, within: str | int) -> str:
        """Relevant documents among the ranks up to ``within``."""
        return self._add(f"hits_{within}", f"count_if(is_rel AND rank <= {within})")

    def precision_sum(self) -> str:
        return self.rel_sum("precision_sum", "rel_seen / rank")

    def aggregates(self) -> list[str]:
        return [f"{aggregate} AS {name}" for name, aggregate in self._sums.items()]


Values = Iterator[tuple[str, str]]
MeasureFunction = Callable[..., Values]
_REGISTRY: dict[str, tuple[MeasureFunction, tuple]] = {}


def register_measure(name: str, function: MeasureFunction, default: Sequence = ()) -> None:
    """Make ``function(sheet, params)`` available under ``name``."""
    _REGISTRY[name] = (function, tuple(default))


def measure(name: str, default: Sequence = ()):
    def wrap(function: MeasureFunction) -> MeasureFunction:
        register_measure(name, function, default)
        return function

    return wrap


def doc_cuts(cuts: Iterable) -> list[int]:
    """Document cut-offs: whole, positive, unique, ascending."""
    found = sorted(int(float(c)) for c in cuts)
    if not found or found[0] <= 0:
        raise ValueError("cut-offs must be positive")
    if len(set(found)) != len(found):
        raise ValueError("duplicate cut-offs")
    return found


def points(values: Iterable) -> list[float]:
    """Fractional cut-offs: unique, ascending."""
    found = sorted(float(v) for v in values)
    if not found:
        raise ValueError("no cut-off values")
    if len(set(found)) != len(found):
        raise ValueError("duplicate cut-offs")
    return found


def labelled(name: str, params: Sequence, default: Sequence) -> str:
    """A changed parameter list becomes part of the measure name."""
    if tuple(params) == tuple(default):
        return name
    return f"{name}_{','.join(str(p) for p in params)}"


@measure("num_ret")
def _num_ret(s: Sheet, params) -> Values:
    yield "num_ret", "num_ret"


@measure("num_rel")
def _num_rel(s: Sheet, params) -> Values:
    yield "num_rel", "num_rel"


@measure("num_rel_ret")
def _num_rel_ret(s: Sheet, params) -> Values:
    yield "num_rel_ret", "num_rel_ret"


@measure("num_nonrel_judged_ret")
def _num_nonrel_judged_ret(s: Sheet, params) -> Values:
    yield "num_nonrel_judged_ret", "num_ret - num_nonpool - num_unjudged - num_rel_ret"


@measure("map")
def _map(s: Sheet, params) -> Values:
    yield "map", ratio(s.precision_sum(), "num_rel")


@measure("gm_map")
def _gm_map(s: Sheet, params) -> Values:
    yield "gm_map", f"ln(greatest({ratio(s.precision_sum(), 'num_rel')}, {GEOMETRIC_FLOOR!r}D))"


@measure("map_cut", DOC_CUTS)
def _map_cut(s: Sheet, params) -> Values:
    for k in doc_cuts(params):
        total = s.rel_sum(f"precision_sum_{k}", f"if(rank <= {k}, rel_seen / rank, null)")
        yield f"map_cut_{k}", ratio(total, "num_rel")


@measure("yaap")
def _yaap(s: Sheet, params) -> Values:
    total = s.precision_sum()
    yield "yaap", f"ln((1 + {total}) / (1 + num_rel - {total}))"


@measure("Rprec")
def _rprec(s: Sheet, params) -> Values:
    yield "Rprec", ratio(s.hits("num_rel"), "num_rel")


@measure("Rprec_mult", R_MULTIPLES)
def _rprec_mult(s: Sheet, params) -> Values:
    for x in points(params):
        cut = share_cut(x, "num_rel")
        yield f"Rprec_mult_{x:3.2f}", ratio(s.hits(cut), cut)


def _bpref_value(s: Sheet) -> str:
    kept = "if(nonrel_seen = 0, 1D, 1 - least(nonrel_seen, num_rel) / least(num_nonrel, num_rel))"
    return ratio(s.rel_sum("bpref_sum", kept), "num_rel")


@measure("bpref")
def _bpref(s: Sheet, params) -> Values:
    yield "bpref", _bpref_value(s)


@measure("gm_bpref")
def _gm_bpref(s: Sheet, params) -> Values:
    yield "gm_bpref", f"ln(greatest({_bpref_value(s)}, {GEOMETRIC_FLOOR!r}D))"


@measure("recip_rank")
def _recip_rank(s: Sheet, params) -> Values:
    yield "recip_rank", s.rel_max("recip_rank_max", "1 / rank")


def _iprec(s: Sheet, x: float) -> str:
    # The best precision from the c-th relevant document on sits on a relevant row
    # that has seen at least c of them, so a conditional maximum replaces a reverse scan.
    cut = share_cut(x, "num_rel")
    return s.rel_max(f"iprec_{x!r}", f"if(rel_seen >= {cut}, rel_seen / rank, null)")


@measure("iprec_at_recall", RECALL_POINTS)
def _iprec_at_recall(s: Sheet, params) -> Values:
    for x in points(params):
        yield f"iprec_at_recall_{x:3.2f}", _iprec(s, x)


@measure("11pt_avg", RECALL_POINTS)
def _11pt_avg(s: Sheet, params) -> Values:
    values = [_iprec(s, x) for x in points(params)]
    yield labelled("11pt_avg", params, RECALL_POINTS), f"({' + '.join(values)}) / {len(values)}"


@measure("P", DOC_CUTS)
def _p(s: Sheet, params) -> Values:
    for k in doc_cuts(params):
        yield f"P_{k}", f"{s.hits(k)} / {k}"


@measure("recall", DOC_CUTS)
def _recall(s: Sheet, params) -> Values:
    for k in doc_cuts(params):
        yield f"recall_{k}", ratio(s.hits(k), "num_rel")


@measure("relative_P", DOC_CUTS)
def _relative_p(s: Sheet, params) -> Values:
    for k in doc_cuts(params):
        yield f"relative_P_{k}", ratio(s.hits(k), f"least({k}, num_rel)")


@measure("success", SUCCESS_CUTS)
def _success(s: Sheet, params) -> Values:
    for k in doc_cuts(params):
        yield f"success_{k}", f"if({s.hits(k)} > 0, 1D, 0D)"


@measure("infAP")
def _infap(s: Sheet, params) -> Values:
    above, epsilon = "(rank - 1)", f"{INFAP_EPSILON!r}D"
    judged_above = "(rel_seen - 1 + nonrel_seen)"
    in_pool = f"(({judged_above} + unjudged_seen) / {above})"
    estimate = f"((rel_seen - 1 + {epsilon}) / ({judged_above} + 2 * {epsilon}))"
    expected = f"if(rank = 1, 1D, 1 / rank + ({above} / rank) * {in_pool} * {estimate})"
    yield "infAP", ratio(s.rel_sum("infap_sum", expected), "num_rel")


@measure("utility", UTILITY_WEIGHTS)
def _utility(s: Sheet, params) -> Values:
    if len(params) != 4:
        raise ValueError("utility takes 4 weights")
    a, b, c, d = (f"{float(p)!r}D" for p in params)
    outside = f"({s.collection_size} + num_rel_ret - num_ret - num_rel)"
    yield labelled("utility", params, UTILITY_WEIGHTS), (
        f"{a} * num_rel_ret + {b} * (num_ret - num_rel_ret) + {c} * (num_rel - num_rel_ret)"
        f" + {d} * {outside}"
    )


@measure("binG")
def _bing(s: Sheet, params) -> Values:
    yield "binG", ratio(s.rel_sum("bing_sum", "1 / log2(2 + rank - rel_seen)"), "num_rel")


@measure("set_P")
def _set_p(s: Sheet, params) -> Values:
    yield "set_P", ratio("num_rel_ret", "num_ret")


@measure("set_relative_P")
def _set_relative_p(s: Sheet, params) -> Values:
    yield "set_relative_P", ratio("num_rel_ret", "least(num_ret, num_rel)")


@measure("set_recall")
def _set_recall(s: Sheet, params) -> Values:
    yield "set_recall", ratio("num_rel_ret", "num_rel")


@measure("set_map")
def _set_map(s: Sheet, params) -> Values:
    yield "set_map", ratio("num_rel_ret * num_rel_ret", "num_ret * num_rel")


@measure("set_F", (1.0,))
def _set_f(s: Sheet, params) -> Values:
    x = f"{float(params[0])!r}D"
    p, r = ratio("num_rel_ret", "num_ret"), ratio("num_rel_ret", "num_rel")
    yield labelled("set_F", params, (1.0,)), ratio(f"({x} + 1) * {p} * {r}", f"{x} * {p} + {r}")


def registered() -> list[str]:
    return list(_REGISTRY)


def chosen_values(sheet: Sheet, chosen: dict[str, Sequence | None]) -> list[tuple[str, str]]:
    """(name, SQL text) of the chosen measures; ``sheet`` gets the row sums that they need."""
    values: list[tuple[str, str]] = []
    for name, params in chosen.items():
        function, default = _REGISTRY[name]
        values.extend(function(sheet, default if params is None else params))
    return values


#: What every sheet counts of a topic.
TOPIC_COUNTS = (
    "count(*) AS num_ret",
    f"count_if(rel = {NOT_POOLED}) AS num_nonpool",
    f"count_if(rel = {UNJUDGED}) AS num_unjudged",
    "count_if(is_rel) AS num_rel_ret",
)


def group_values(
    rows: DataFrame, counts: DataFrame, chosen: dict[str, Sequence | None], keys: tuple[str, ...]
) -> DataFrame:
    """(keys..., measure, value) from relevant rows alone (keys, rank, rel, rel_seen) and num_rel per key.

    For measures that are sums over relevant documents.
    """
    sheet = Sheet()
    values = chosen_values(sheet, chosen)
    sums = (
        rows.withColumn("is_rel", F.lit(True))
        .join(counts, list(keys))
        .groupBy(*keys)
        .agg(*[F.expr(a) for a in sheet.aggregates()])
    )
    return long_form(counts.join(sums, list(keys), "left").na.fill(0), keys, values)


def long_form(
    topics: DataFrame, keys: Sequence[str], values: list[tuple[str, str]], texts: list[tuple[str, str]] | None = None
) -> DataFrame:
    """One row per topic and measure from one row per topic; values are SQL text.

    With ``texts`` there is a column ``text`` too, which those measures have in place of a value.
    """
    if texts is None:
        pairs = [f"named_struct('measure', '{name}', 'value', cast({value} AS double))" for name, value in values]
        return topics.selectExpr(*keys, f"inline(array({', '.join(pairs)}))")
    rows = [(name, f"cast({value} AS double)", "cast(null AS string)") for name, value in values]
    rows += [(name, "cast(null AS double)", f"cast({text} AS string)") for name, text in texts]
    pairs = [f"named_struct('measure', '{n}', 'value', {v}, 'text', {t})" for n, v, t in rows]
    return topics.selectExpr(*keys, f"inline(array({', '.join(pairs)}))")


def relstring_name(length: int) -> str:
    return "relstring" if length == RELSTRING_LENGTH else f"relstring_{length}"


def relstring_aggregate(length: int) -> Column:
    """Relevance of a topic's first ``length`` documents as one character each."""
    rel = F.col("rel")
    letter = (
        F.when(rel > 9, ">")
        .when(rel >= 0, rel.cast("string"))
        .when(rel == NOT_POOLED, "-")
        .when(rel == UNJUDGED, ".")
        .otherwise("<")
    )
    first = F.collect_list(F.when(F.col("rank") <= length, F.struct("rank", letter.alias("letter"))))
    return F.array_join(F.transform(F.array_sort(first), lambda a: a["letter"]), "")


def relevance_strings(ranked: DataFrame, length: int = RELSTRING_LENGTH) -> DataFrame:
    """The relevance string of every topic of a ranked list."""
    first = ranked.filter(F.col("rank") <= length)
    return first.groupBy("qid").agg(relstring_aggregate(length).alias("text")).select(
        "qid", F.lit(relstring_name(length)).alias("measure"), "text"
    )


def run_id(run: DataFrame) -> DataFrame:
    """Tag of the last run line; ``line`` gives the order of the file.

    Without that column several tags are an error.
    """
    if "line" in run.columns:
        last = F.max_by("run_id", "line")
    else:
        message = F.lit("several run tags: the order of lines, column line, is needed")
        several = F.min("run_id") != F.max("run_id")
        last = F.when(several, F.raise_error(message)).otherwise(F.max("run_id"))
    return run.agg(last.alias("text")).select(
        F.lit("all").alias("qid"), F.lit("runid").alias("measure"), "text"
    )
