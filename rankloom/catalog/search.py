"""Queries on text: analysis, index tables, query building, scoring, runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.stem import stem_steps
from ..functions.text import WORD, fold_tables
from ..operators import analysis, index, queries, scoring
from ..operators.analysis import Analyzer, fields
from ..plans import search as plans
from ..session import durable, new_folder
from ..sources.reports import run_lines as lines_of_run
from ..sources.reports import run_tag as tag_of_run
from ..streaming.append import stored_index, stream_into_index
from . import inputs
from .evaluation import Query, rounded
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


# Frequent short words of the four languages of the collection.
STOP = (
    "the of and to in is that with for as on are be or at by from this de la le les des une un "
    "du que qui der die das und den von zu mit el los las en"
).split()
NO_STEM = Analyzer(stop=STOP, stem=False)
FULL = Analyzer(stop=STOP, stem=True)


# -- the analysis chain in SQL ----------------------------------------------------------


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def folded_sql(text: str) -> str:
    single, plain, several = fold_tables()
    sql = f"translate(lower({text}), {_quoted(single)}, {_quoted(plain)})"
    spelled = sql
    for letter, letters in several.items():
        spelled = f"replace({spelled}, '{letter}', '{letters}')"
    return f"CASE WHEN regexp_matches({sql}, '[{''.join(several)}]') THEN {spelled} ELSE {sql} END"


def words_sql(source: str, keys: str, text: str) -> str:
    return f"""
  SELECT {keys}, CAST(generate_subscripts(w, 1) - 1 AS INTEGER) AS pos, unnest(w) AS term
  FROM (SELECT {keys}, regexp_extract_all(regexp_replace({text}, '([\\p{{Han}}\\p{{Hiragana}}])', ' \\1 ', 'g'), {_quoted(WORD)}) AS w
        FROM {source})"""


POSSESSIVE = "CASE WHEN lower(right(term, 2)) = '''s' THEN left(term, length(term) - 2) ELSE term END"
STOP_LIST = ", ".join(f"'{w}'" for w in STOP)

DOCS = [
    ("docs", SQL["docs"]),
    (
        "flds",
        """
  SELECT docno, 'headline' AS field, headline AS text FROM docs
  UNION ALL SELECT docno, 'text' AS field, text FROM docs""",
    ),
]
RAW = [*DOCS, ("raw", words_sql("flds", "docno, field", "replace(text, '’', '''')"))]


def chain_sql(source: str, keys: str, name: str, stem: bool, stop: bool = True) -> list[tuple[str, str]]:
    """CTE ``name`` (keys, pos, term): the chain, with the stop list above if asked for."""
    plain = f"""
  SELECT {keys}, pos, term FROM (
    SELECT {keys}, pos, {POSSESSIVE} AS term
    FROM ({words_sql(source, keys, folded_sql('text'))}))
  WHERE length(term) BETWEEN 2 AND 20{f" AND term NOT IN ({STOP_LIST})" if stop else ""}"""
    if not stem:
        return [(name, plain)]
    return [
        (f"{name}_plain", plain),
        (f"{name}_stems", stems_sql(f"SELECT DISTINCT term AS w FROM {name}_plain")),
        (
            name,
            f"SELECT {keys}, pos, stem AS term FROM {name}_plain JOIN {name}_stems ON term = w",
        ),
    ]


def stems_sql(words: str) -> str:
    sql = words
    for column, step in stem_steps():
        sql = f"SELECT *, {step.replace('regexp_like(', 'regexp_matches(')} AS {column} FROM ({sql})"
    return f"SELECT w, stem FROM ({sql})"


PLAIN_TOKENS = [*DOCS, *chain_sql("flds", "docno, field", "tok", stem=False)]
TOKENS = [*DOCS, *chain_sql("flds", "docno, field", "tok", stem=True)]
TOKEN_ROWS = "SELECT docno, field, pos, {term} AS term FROM raw"


def _raw(spark: SparkSession, folder: str) -> DataFrame:
    return analysis.raw_tokens(fields(inputs.docs(spark, folder)), "docno", "field")


def _tokens(spark: SparkSession, folder: str, analyzer: Analyzer = FULL) -> DataFrame:
    texts = fields(inputs.docs(spark, folder))
    return analysis.analyzed_tokens(texts, "docno", "field", analyzer=analyzer)


query("tok_words", with_ctes(RAW, TOKEN_ROWS.format(term="term")))(_raw)
query("tok_possessive", with_ctes(RAW, TOKEN_ROWS.format(term=POSSESSIVE)))(
    lambda spark, folder: analysis.possessive(_raw(spark, folder))
)
query("tok_ascii", with_ctes(RAW, TOKEN_ROWS.format(term=folded_sql("term"))))(
    lambda spark, folder: analysis.fold_accents(_raw(spark, folder))
)
query("tok_lower", with_ctes(RAW, TOKEN_ROWS.format(term="lower(term)")))(
    lambda spark, folder: analysis.lower_case(_raw(spark, folder))
)
query("tok_length", with_ctes(RAW, TOKEN_ROWS.format(term="term") + " WHERE length(term) BETWEEN 2 AND 20"))(
    lambda spark, folder: analysis.keep_length(_raw(spark, folder))
)
query("tok_stop", with_ctes(RAW, TOKEN_ROWS.format(term="term") + f" WHERE lower(term) NOT IN ({STOP_LIST})"))(
    lambda spark, folder: analysis.remove_stop_words(_raw(spark, folder), STOP)
)


@query("vocab_stem", with_ctes(
    [*PLAIN_TOKENS, ("stems", stems_sql("SELECT DISTINCT term AS w FROM tok"))],
    "SELECT w AS term, stem FROM stems",
))
def vocab_stem(spark, folder):
    return analysis.vocabulary_stems(_tokens(spark, folder, NO_STEM))


@query("tok_synonym", with_ctes([*PLAIN_TOKENS, ("syn", f"""
  SELECT k.term, s.synonym FROM (VALUES ('ing'), ('ment')) AS k(term)
  CROSS JOIN (SELECT DISTINCT unnest(regexp_extract_all(lower(r_name), {_quoted(WORD)})) AS synonym
              FROM region) s""")], """
SELECT docno, field, pos, term FROM tok
UNION
SELECT t.docno, t.field, t.pos, s.synonym AS term FROM tok t JOIN syn s ON t.term = s.term"""))
def tok_synonym(spark, folder):
    names = inputs.table(spark, folder, "region")
    keys = F.array(F.lit("ing"), F.lit("ment"))
    synonyms = names.select(F.explode(keys).alias("term"), F.col("r_name").alias("synonym"))
    return analysis.expand_synonyms(_tokens(spark, folder, NO_STEM), synonyms)


@query("analyze", with_ctes(TOKENS, """
SELECT docno, field, string_agg(term, ' ' ORDER BY pos) AS terms FROM tok GROUP BY docno, field"""))
def analyze(spark, folder):
    texts = fields(inputs.docs(spark, folder))
    found = analysis.analyze(texts, "docno", "field", analyzer=FULL)
    return found.select("docno", "field", F.array_join("terms", " ").alias("terms"))


# -- index ------------------------------------------------------------------------------

INDEX = [
    *TOKENS,
    ("post", "SELECT docno, field, term, count(*) AS tf FROM tok GROUP BY docno, field, term"),
    ("len", "SELECT docno, field, count(*) AS dl FROM tok GROUP BY docno, field"),
    (
        "ts",
        "SELECT field, term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS ctf FROM post GROUP BY field, term",
    ),
    (
        "fs",
        "SELECT field, count(*) AS n_docs, CAST(sum(dl) AS BIGINT) AS sum_dl, avg(dl) AS avgdl FROM len GROUP BY field",
    ),
]


@query("postings", with_ctes(TOKENS, """
SELECT docno, field, term, count(*) AS tf, string_agg(pos::VARCHAR, ',' ORDER BY pos) AS positions
FROM tok GROUP BY docno, field, term"""))
def postings(spark, folder):
    found = index.text_postings(fields(inputs.docs(spark, folder)), "docno", "field", analyzer=FULL)
    return found.withColumn("positions", F.array_join(F.col("positions").cast("array<string>"), ","))


@query("doc_len", with_ctes(INDEX, "SELECT docno, field, dl FROM len"))
def doc_len(spark, folder):
    return analysis.text_lengths(fields(inputs.docs(spark, folder)), "docno", "field", analyzer=FULL)


@query("term_stats", with_ctes(INDEX, "SELECT field, term, df, ctf FROM ts"))
def term_stats(spark, folder):
    texts = fields(inputs.docs(spark, folder))
    return index.term_stats(analysis.text_frequencies(texts, "docno", "field", analyzer=FULL))


@query("field_stats", with_ctes(INDEX, "SELECT field, n_docs, sum_dl, round(avgdl, 8) AS avgdl FROM fs"))
def field_stats(spark, folder):
    lengths = analysis.text_lengths(fields(inputs.docs(spark, folder)), "docno", "field", analyzer=FULL)
    return rounded(index.field_stats(lengths), "avgdl")


@query("num_docs", "SELECT count(*) AS num_docs FROM documents")
def num_docs(spark, folder):
    return index.num_docs(inputs.docs(spark, folder))


@query("docs_per_source", "SELECT source, count(*) AS num_docs FROM documents GROUP BY source")
def docs_per_source(spark, folder):
    return index.docs_per_source(inputs.docs(spark, folder))


# -- narratives: passages in which common words are turned into stock phrases ----------------

NARRATIVE_MARKS = {
    " of ": " not relevant ",
    " to ": " a relevant document must ",
    " is ": " relevant documents ",
    " de ": " will discuss ",
    " en ": " irrelevant ",
}


def _marked_topics(spark: SparkSession, folder: str) -> DataFrame:
    narrative = F.col("description")
    for word, phrase in NARRATIVE_MARKS.items():
        narrative = F.replace(narrative, F.lit(word), F.lit(phrase))
    return inputs.topics(spark, folder).withColumn("narrative", narrative)


def _marked_sql() -> str:
    text = "description"
    for word, phrase in NARRATIVE_MARKS.items():
        text = f"replace({text}, '{word}', '{phrase}')"
    return f"SELECT qid, title, description, {text} AS narrative FROM plain_topics"


def narrative_sql(topics: str) -> list[tuple[str, str]]:
    """CTEs ``sent`` (qid, no, sentence, bad) and ``narr`` (qid, relevant, irrelevant)."""
    return [
        (
            "sent",
            f"""
  SELECT qid, no, sentence,
         contains(sentence, 'not relevant') OR contains(sentence, 'irrelevant') AS bad
  FROM (SELECT qid, CAST(generate_subscripts(p, 1) - 1 AS INTEGER) AS no, unnest(p) AS sentence FROM (
          SELECT qid, string_split(regexp_replace(narrative, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)) AS p
          FROM {topics}))
  WHERE trim(sentence) <> ''""",
        ),
        (
            "narr",
            f"""
  SELECT qid,
    trim(regexp_replace(coalesce(string_agg(regexp_replace(sentence, '{queries.RELEVANT_PHRASES}', '', 'g'),
         ' ' ORDER BY no) FILTER (NOT bad), ''), '\\s+', ' ', 'g')) AS relevant,
    trim(regexp_replace(coalesce(string_agg(regexp_replace(sentence, '{queries.IRRELEVANT_PHRASES}', '', 'g'),
         ' ' ORDER BY no) FILTER (bad), ''), '\\s+', ' ', 'g')) AS irrelevant
  FROM sent GROUP BY qid""",
        ),
    ]


MARKED = [
    ("plain_topics", SQL["topics"]),
    ("topics", _marked_sql()),
    *narrative_sql("topics"),
]


@query("narr_sentences", with_ctes(MARKED, "SELECT qid, no, sentence FROM sent"))
def narr_sentences(spark, folder):
    return queries.sentences(_marked_topics(spark, folder))


@query("narr_relevant", with_ctes(MARKED, "SELECT qid, no, sentence FROM sent WHERE NOT bad"))
def narr_relevant(spark, folder):
    return queries.relevant_sentences(queries.sentences(_marked_topics(spark, folder)))


@query("narr_irrelevant", with_ctes(MARKED, "SELECT qid, no, sentence FROM sent WHERE bad"))
def narr_irrelevant(spark, folder):
    return queries.irrelevant_sentences(queries.sentences(_marked_topics(spark, folder)))


@query("narr_clean", with_ctes(MARKED, "SELECT qid, relevant, irrelevant FROM narr"))
def narr_clean(spark, folder):
    return queries.clean_narrative(_marked_topics(spark, folder))


# -- queries and matching ------------------------------------------------------------------


def query_ctes(stem: bool, topics: str = SQL["topics"]) -> list[tuple[str, str]]:
    """CTEs ``clauses`` and ``qt`` (qid, field, term, weight)."""
    return [
        ("topics", topics),
        *narrative_sql("topics"),
        (
            "clauses",
            """
  SELECT * FROM (
    SELECT qid, 'title' AS clause, 3.5::DOUBLE AS boost, title AS text FROM topics
    UNION ALL SELECT qid, 'description', 2.5, description FROM topics
    UNION ALL SELECT qid, 'narrative', 2.0, relevant FROM narr)
  WHERE trim(text) <> ''""",
        ),
        *chain_sql("clauses", "qid, clause, boost", "qtok", stem),
        (
            "qt",
            """
  SELECT qid, f.field, term, sum(boost) * f.fb AS weight
  FROM (SELECT qid, term, boost FROM qtok) CROSS JOIN
       (VALUES ('headline', 0.1::DOUBLE), ('text', 0.9)) AS f(field, fb)
  GROUP BY qid, f.field, term, f.fb""",
        ),
    ]


@query("query_terms", with_ctes(query_ctes(stem=True), """
SELECT qid, field, term, round(weight, 8) AS weight FROM qt"""))
def query_terms(spark, folder):
    return rounded(queries.query_terms(inputs.topics(spark, folder), FULL), "weight")


SEARCH = [*INDEX, *query_ctes(stem=True)]


def _terms_and_index(spark, folder):
    terms = queries.query_terms(inputs.topics(spark, folder), FULL)
    return terms, index.matched_index(inputs.docs(spark, folder), terms, FULL)


@query("match_terms", with_ctes(SEARCH, """
SELECT qid, q.field, q.term, count(*) AS docs, CAST(sum(tf) AS BIGINT) AS tf
FROM qt q JOIN post p ON p.field = q.field AND p.term = q.term GROUP BY qid, q.field, q.term"""))
def match_terms(spark, folder):
    terms, found = _terms_and_index(spark, folder)
    return scoring.match(terms, found).groupBy("qid", "field", "term").agg(
        F.count("*").alias("docs"), F.sum("tf").alias("tf")
    )


@query("match_any", with_ctes(SEARCH, """
SELECT qid, docno, count(*) AS terms
FROM qt q JOIN post p ON p.field = q.field AND p.term = q.term GROUP BY qid, docno"""))
def match_any(spark, folder):
    return scoring.match_any(scoring.match(*_terms_and_index(spark, folder)))


SIMILARITY = {
    "BM25": "ln(1 + (n_docs - df + 0.5) / (df + 0.5)) * tf / (tf + 1.2 * (0.25 + 0.75 * dl / avgdl))",
    "BOOLEAN": "1.0",
    "CLASSIC": "sqrt(tf) * (1 + ln((n_docs + 1) / (df + 1)::DOUBLE)) / sqrt(dl)",
    "LM_DIRICHLET": """greatest(0, ln(1 + tf / (2000.0::DOUBLE * ((ctf + 1) / (sum_dl + 1)::DOUBLE)))
      + ln(2000.0::DOUBLE / (dl + 2000.0::DOUBLE)))""",
    "SWEET_SPOT": """sqrt(tf) * (1 + ln((n_docs + 1) / (df + 1)::DOUBLE))
      / sqrt(0.5::DOUBLE * (abs(dl - 1) + abs(dl - 1)) + 1)""",
}


def scores_ctes(model: str) -> list[tuple[str, str]]:
    return [
        (
            "parts",
            f"""
  SELECT qid, p.docno, q.field, weight * ({SIMILARITY[model]})::DOUBLE AS part
  FROM qt q JOIN post p ON p.field = q.field AND p.term = q.term
  JOIN len l ON l.docno = p.docno AND l.field = p.field
  JOIN ts ON ts.field = q.field AND ts.term = q.term JOIN fs ON fs.field = q.field""",
        ),
        ("sc", "SELECT qid, docno, round(sum(part), 6) AS score FROM parts GROUP BY qid, docno"),
    ]


@query("score_multifield", with_ctes([*SEARCH, ("halved", f"""
  SELECT qid, p.docno,
    round(sum(CASE WHEN q.field = 'headline' THEN weight * ({SIMILARITY['BM25']}) ELSE 0 END), 6) AS headline,
    round(sum(CASE WHEN q.field = 'text' THEN weight * ({SIMILARITY['BM25']}) ELSE 0 END), 6) AS text
  FROM qt q JOIN post p ON p.field = q.field AND p.term = q.term
  JOIN len l ON l.docno = p.docno AND l.field = p.field
  JOIN ts ON ts.field = q.field AND ts.term = q.term JOIN fs ON fs.field = q.field
  GROUP BY qid, p.docno""")], "SELECT qid, docno, headline, text FROM halved"))
def score_multifield(spark, folder):
    terms, found = _terms_and_index(spark, folder)
    halves = []
    for name in analysis.FIELDS:
        part = scoring.scored(scoring.contributions(terms.filter(F.col("field") == name), found))
        halves.append(part.withColumn("field", F.lit(name)))
    both = halves[0].unionByName(halves[1])
    return both.groupBy("qid", "docno").agg(
        *[
            F.sum(F.when(F.col("field") == n, F.col("score")).otherwise(0.0)).alias(n)
            for n in analysis.FIELDS
        ]
    )


def phrase_ctes(analyzed: bool = True) -> list[tuple[str, str]]:
    """CTE ``ph`` (qid, clause, docno, freq); analysed phrases come from ``qtok``."""
    words = (
        "SELECT qid, clause, pos, term FROM qtok"
        if analyzed
        else """
  SELECT qid, clause, generate_subscripts(w, 1) - 1 AS pos, unnest(w) AS term
  FROM (SELECT qid, clause, regexp_split_to_array(lower(trim(text)), '\\s+') AS w FROM clauses)"""
    )
    return [
        ("pw0", words),
        (
            "pw",
            """
  SELECT p.*, CASE clause WHEN 'title' THEN 'headline' ELSE 'text' END AS field,
         CASE clause WHEN 'title' THEN 4.0 WHEN 'description' THEN 3.0 ELSE 2.5 END::DOUBLE AS weight,
         count(*) OVER (PARTITION BY qid, clause) AS size FROM pw0 p""",
        ),
        (
            "ph",
            """
  SELECT qid, clause, docno, count(*) AS freq FROM (
    SELECT qid, clause, docno, t.pos - p.pos AS start, any_value(size) AS size, count(*) AS found
    FROM pw p JOIN tok t ON t.field = p.field AND t.term = p.term
    GROUP BY qid, clause, docno, t.pos - p.pos)
  WHERE found = size GROUP BY qid, clause, docno""",
        ),
    ]


# Raw phrases are matched as they are written, in texts whose words are neither stopped nor stemmed. The
# first two neighbouring plain words of every document's headline are a topic.
AS_WRITTEN = Analyzer(stem=False)
TWO_WORDS = "[a-z]{2,20} [a-z]{2,20}"


def _written_topics(spark: SparkSession, folder: str) -> DataFrame:
    pair = F.regexp_extract(F.lower("headline"), TWO_WORDS, 0)
    return inputs.docs(spark, folder).select(
        F.concat(F.lit("T"), "docno").alias("qid"), pair.alias("title"),
        F.lit("").alias("description"), F.lit("").alias("narrative"),
    )


@query("phrase_match", with_ctes([
    *DOCS,
    *chain_sql("flds", "docno, field", "tok", stem=False, stop=False),
    ("clauses", f"""
  SELECT 'T' || docno AS qid, 'title' AS clause, regexp_extract(lower(headline), '{TWO_WORDS}') AS text FROM docs
  WHERE regexp_extract(lower(headline), '{TWO_WORDS}') <> ''"""),
    *phrase_ctes(analyzed=False),
], "SELECT qid, clause, docno, freq FROM ph"))
def phrase_match(spark, folder):
    words = queries.phrase_terms(_written_topics(spark, folder), analyzed=False)
    return queries.phrase_match(words, plans.phrase_tokens(inputs.docs(spark, folder), words, AS_WRITTEN))


@query("phrase_match_analyzed", with_ctes(
    [*TOKENS, *query_ctes(True), *phrase_ctes()],
    "SELECT qid, clause, docno, freq FROM ph",
))
def phrase_match_analyzed(spark, folder):
    words = queries.phrase_terms(inputs.topics(spark, folder), analyzer=FULL)
    return queries.phrase_match(words, plans.phrase_tokens(inputs.docs(spark, folder), words, FULL))


# Phrases: frequency as tf, the sum of their words' idf as idf, the rarest word's counts.
IDF = {"BM25": "ln(1 + (n_docs - df + 0.5) / (df + 0.5))"}
PHRASE_SIMILARITY = {
    "BM25": "idf * freq / (freq + 1.2 * (0.25 + 0.75 * dl / avgdl))",
    "BOOLEAN": "1.0",
    "CLASSIC": "sqrt(freq) * idf / sqrt(dl)",
    "LM_DIRICHLET": """greatest(0, ln(1 + freq / (2000.0::DOUBLE * ((ctf + 1) / (sum_dl + 1)::DOUBLE)))
      + ln(2000.0::DOUBLE / (dl + 2000.0::DOUBLE)))""",
    "SWEET_SPOT": "sqrt(freq) * idf / sqrt(0.5::DOUBLE * (abs(dl - 1) + abs(dl - 1)) + 1)",
}


def with_phrases(model: str) -> list[tuple[str, str]]:
    """All scores of a model, phrase clauses included, as CTE ``sc``."""
    idf = IDF.get(model, "1 + ln((n_docs + 1) / (df + 1)::DOUBLE)")
    return [*SEARCH, *scores_ctes(model)[:1], *phrase_ctes(), ("pidf", f"""
  SELECT qid, clause, p.field, any_value(p.weight) AS weight, any_value(fs.avgdl) AS avgdl, any_value(sum_dl) AS sum_dl,
         sum({idf}) AS idf, min(ctf) AS ctf
  FROM pw p JOIN ts ON ts.field = p.field AND ts.term = p.term JOIN fs ON fs.field = p.field
  GROUP BY qid, clause, p.field"""), ("both_parts", f"""
  SELECT qid, docno, part FROM parts
  UNION ALL
  SELECT h.qid, h.docno, weight * ({PHRASE_SIMILARITY[model]}) AS part
  FROM ph h JOIN pidf i ON i.qid = h.qid AND i.clause = h.clause
  JOIN len l ON l.docno = h.docno AND l.field = i.field"""), (
    "sc", "SELECT qid, docno, round(sum(part), 6) AS score FROM both_parts GROUP BY qid, docno")]


WITH_PHRASES = with_phrases("BM25")


def _score_query(model: str) -> Query:
    def run_query(spark: SparkSession, folder: str) -> DataFrame:
        docs, topics = inputs.docs(spark, folder), inputs.topics(spark, folder)
        return plans.scores(docs, topics, model, FULL, phrases="analyzed")

    return run_query


for _model in scoring.MODELS:
    query(f"score_{_model.lower()}", with_ctes(with_phrases(_model), """
SELECT qid, docno, score FROM sc"""))(_score_query(_model))


@query("score_with_phrase", with_ctes(WITH_PHRASES, "SELECT qid, docno, score FROM sc"))
def score_with_phrase(spark, folder):
    return plans.scores(
        inputs.docs(spark, folder), inputs.topics(spark, folder), "BM25", FULL, phrases="analyzed"
    )


TOP = """
SELECT qid, docno, rank, score FROM (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, docno) AS rank FROM sc)
WHERE rank <= {k}"""


@query("topk_run", with_ctes(with_phrases("CLASSIC"), TOP.format(k=plans.MAX_RESULTS)))
def topk_run(spark, folder):
    docs, topics = inputs.docs(spark, folder), inputs.topics(spark, folder)
    return plans.search(docs, topics, "CLASSIC", k=plans.MAX_RESULTS, analyzer=FULL)


@query("search_bm25", with_ctes(WITH_PHRASES, TOP.format(k=1000)))
def search_bm25(spark, folder):
    docs, topics = inputs.docs(spark, folder), inputs.topics(spark, folder)
    return plans.search(docs, topics, "BM25", k=1000, analyzer=FULL)


@query("run_lines", with_ctes(with_phrases("BOOLEAN"), f"""
SELECT qid, CAST(rank AS INTEGER) AS rank,
       printf('%s Q0 %s %d %.6f %s', qid, docno, rank, score, 'CustomBoolean') AS line
FROM ({TOP.format(k=1000)})"""))
def run_lines(spark, folder):
    docs, topics = inputs.docs(spark, folder), inputs.topics(spark, folder)
    scores = plans.scores(docs, topics, "BOOLEAN", FULL)
    tag = tag_of_run(FULL.name, scoring.MODEL_TAGS["BOOLEAN"])
    return lines_of_run(scores, tag, k=1000)


@query("run_tag", with_ctes([("topics", SQL["topics"])], """
SELECT qid, 'CustomLMDirichlet' AS tag FROM topics"""))
def run_tag(spark, folder):
    tag = tag_of_run(FULL.name, scoring.MODEL_TAGS["LM_DIRICHLET"])
    return inputs.topics(spark, folder).select("qid", tag.alias("tag"))


@query("append_index", with_ctes(WITH_PHRASES, TOP.format(k=1000)))
def append_index(spark, folder):
    """Two halves arrive in two batches of a stream; the stored index is then searched.

    A half has as many files as half of the table's splits or cores, so that no task has to read all of it."""
    source, path = new_folder(spark, "arrived"), new_folder(spark, "index")
    arrived = inputs.table(spark, folder, "documents")
    files = -(-max(arrived.rdd.getNumPartitions(), spark.sparkContext.defaultParallelism) // 2)
    arrived.repartitionByRange(2 * files, "doc_id").write.parquet(source)

    def to_docs(rows: DataFrame) -> DataFrame:
        text = F.col("text")
        return rows.select(
            F.concat(F.lit("D"), "doc_id").alias("docno"),
            F.substring_index(text, "\n", 1).alias("headline"),
            F.expr("substring(text, instr(text, '\n') + 1)").alias("text"),
        )

    stream_into_index(
        spark, source, arrived.schema, to_docs, path, f"{path}/progress", FULL, glob="*.parquet", files_per_batch=files
    )
    topics = inputs.topics(spark, folder)
    terms = durable(queries.query_terms(topics, FULL))
    words = durable(queries.phrase_terms(topics, analyzer=FULL))
    tables = stored_index(spark, path)
    found = index.index_of_tables(
        tables["postings"], tables["doc_len"], terms.select("term").union(words.select("term"))
    )
    return plans.search_index(found, terms, "BM25", 1000, words)


# A third of the documents without docno, the others with docnos that occur again.
UNNAMED = "SELECT doc_id, CASE WHEN doc_id % 3 > 0 THEN 'D' || doc_id % 50 END AS docno, headline, text FROM"


@query("search_unnamed_docs", with_ctes([
    ("docs", f"""
  {UNNAMED} (SELECT doc_id, split_part(text, chr(10), 1) AS headline,
                    substr(text, strpos(text, chr(10)) + 1) AS text FROM documents)"""),
    ("flds", """
  SELECT doc_id, docno, 'headline' AS field, headline AS text FROM docs
  UNION ALL SELECT doc_id, docno, 'text' AS field, text FROM docs"""),
    *chain_sql("flds", "doc_id, docno, field", "tok", stem=True),
    ("post", "SELECT doc_id, docno, field, term, count(*) AS tf FROM tok GROUP BY doc_id, docno, field, term"),
    ("len", "SELECT doc_id, field, count(*) AS dl FROM tok GROUP BY doc_id, field"),
    *INDEX[-2:],
    *query_ctes(stem=True),
], f"""
SELECT qid, docno, round(sum(weight * ({SIMILARITY['BM25']})::DOUBLE), 6) AS score
FROM qt q JOIN post p ON p.field = q.field AND p.term = q.term
JOIN len l ON l.doc_id = p.doc_id AND l.field = p.field
JOIN ts ON ts.field = q.field AND ts.term = q.term JOIN fs ON fs.field = q.field
GROUP BY qid, p.doc_id, docno"""))
def search_unnamed_docs(spark, folder):
    text = F.col("text")
    docs = inputs.table(spark, folder, "documents").select(
        F.when(F.col("doc_id") % 3 > 0, F.concat(F.lit("D"), F.col("doc_id") % 50)).alias("docno"),
        F.substring_index(text, "\n", 1).alias("headline"),
        F.expr("substring(text, instr(text, '\n') + 1)").alias("text"),
    )
    return plans.scores(docs, inputs.topics(spark, folder), "BM25", FULL, phrases=None)
