"""From topics to weighted query terms and phrases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.neighbours import neighbours
from ..functions.text import collapsed
from ..session import broadcast_if_small, durable, written
from .analysis import DOC_KEY, Analyzer, analyzed_tokens, document_columns

# Boosts of the three clauses, of the two fields and of the phrase clauses.
CLAUSE_BOOSTS = {"title": 3.5, "description": 2.5, "narrative": 2.0}
FIELD_BOOSTS = {"headline": 0.1, "text": 0.9}
PHRASE_BOOSTS = {
    "title": ("headline", 4.0),
    "description": ("text", 3.0),
    "narrative": ("text", 2.5),
}
# A sentence with one of these says what is not wanted.
IRRELEVANT_MARKS = ("not relevant", "irrelevant")
# Stock phrases removed from wanted and from unwanted sentences.
RELEVANT_PHRASES = (
    "a relevant document identifies|a relevant document could|a relevant document may"
    "|a relevant document must|a relevant document will|a document will|to be relevant"
    "|relevant documents|a document must|relevant|will contain|will discuss|will provide"
    "|must cite"
)
IRRELEVANT_PHRASES = (
    "are also not relevant|are not relevant|are irrelevant|is not relevant|not|NOT"
)


def sentences(topics: DataFrame) -> DataFrame:
    """(qid, no, sentence) of the narratives; a sentence ends at ``.``, ``!`` or ``?``."""
    parts = F.split("narrative", r"(?<=[.!?])\s+")
    return (
        topics.select("qid", F.posexplode(parts).alias("no", "sentence"))
        .filter(F.trim("sentence") != "")
    )


def is_irrelevant(sentence: Column) -> Column:
    found = F.lit(False)
    for mark in IRRELEVANT_MARKS:
        found = found | sentence.contains(mark)
    return found


def relevant_sentences(rows: DataFrame) -> DataFrame:
    return rows.filter(~is_irrelevant(F.col("sentence")))


def irrelevant_sentences(rows: DataFrame) -> DataFrame:
    return rows.filter(is_irrelevant(F.col("sentence")))


def clean_narrative(topics: DataFrame) -> DataFrame:
    """(qid, relevant, irrelevant): both parts of each narrative without stock phrases."""
    rows = sentences(topics)
    bad = is_irrelevant(F.col("sentence"))
    cleaned = rows.select(
        "qid",
        "no",
        bad.alias("bad"),
        F.when(bad, F.regexp_replace("sentence", IRRELEVANT_PHRASES, ""))
        .otherwise(F.regexp_replace("sentence", RELEVANT_PHRASES, ""))
        .alias("sentence"),
    )
    # One group holds the sentences of one topic's narrative.
    at = F.struct("no", "sentence")

    def joined(part: Column) -> Column:
        ordered = F.array_sort(F.collect_list(F.when(part, at)))
        return collapsed(F.array_join(ordered["sentence"], " "))

    return cleaned.groupBy("qid").agg(
        joined(~F.col("bad")).alias("relevant"), joined(F.col("bad")).alias("irrelevant")
    )


def clauses(topics: DataFrame) -> DataFrame:
    """(qid, clause, text): title, description and relevant narrative; empty ones are left out."""
    relevant = clean_narrative(topics).select("qid", F.col("relevant").alias("narrative"))
    rows = topics.select("qid", "title", "description").join(relevant, "qid", "left")
    pairs = F.array(
        *[F.struct(F.lit(n).alias("clause"), F.col(n).alias("text")) for n in CLAUSE_BOOSTS]
    )
    return rows.select("qid", F.inline(pairs)).filter("trim(text) <> ''")


def _boost(table: dict[str, float], column: str) -> Column:
    cases = " ".join(f"WHEN '{name}' THEN {value!r}D" for name, value in table.items())
    return F.expr(f"CASE {column} {cases} END")


def query_terms(topics: DataFrame, analyzer: Analyzer | None = None) -> DataFrame:
    """(qid, field, term, weight): every clause is searched in both fields; repeats add up."""
    terms = analyzed_tokens(clauses(topics), "qid", "clause", analyzer=analyzer)
    boosts = F.array(
        *[F.struct(F.lit(n).alias("field"), F.lit(b).alias("boost")) for n, b in FIELD_BOOSTS.items()]
    )
    return (
        terms.withColumn("clause_boost", _boost(CLAUSE_BOOSTS, "clause"))
        .groupBy("qid", "term")
        .agg(F.sum("clause_boost").alias("weight"))
        .select("qid", "term", "weight", F.inline(boosts))
        .select("qid", "field", "term", (F.col("weight") * F.col("boost")).alias("weight"))
    )


def phrase_terms(
    topics: DataFrame, analyzed: bool = True, analyzer: Analyzer | None = None
) -> DataFrame:
    """(qid, clause, field, weight, pos, term, size): the exact-phrase clauses, a row per word.

    Analysed phrases go through the same chain as the texts and keep their position gaps. Raw
    phrases are the blank-separated words in lower case, consecutive.
    """
    texts = clauses(topics)
    if analyzed:
        words = analyzed_tokens(texts, "qid", "clause", analyzer=analyzer)
    else:
        words = texts.select(
            "qid", "clause", F.posexplode(F.split(F.lower(F.trim("text")), r"\s+")).alias("pos", "term")
        )
    sizes = words.groupBy("qid", "clause").agg(F.count("*").alias("size"))
    fields = {name: field for name, (field, _) in PHRASE_BOOSTS.items()}
    boosts = {name: boost for name, (_, boost) in PHRASE_BOOSTS.items()}
    field_cases = " ".join(f"WHEN '{n}' THEN '{f}'" for n, f in fields.items())
    return words.join(sizes, ["qid", "clause"]).select(
        "qid",
        "clause",
        F.expr(f"CASE clause {field_cases} END").alias("field"),
        _boost(boosts, "clause").alias("weight"),
        "pos",
        "term",
        "size",
    )


def phrase_match(phrases: DataFrame, tokens: DataFrame) -> DataFrame:
    """(qid, clause, docno, freq): how often each phrase occurs in its field.

    ``tokens`` has a row per token (pos) or per word of a text (positions). A phrase occurs where all
    its words meet at the same start, ``pos`` in the text minus ``pos`` in the phrase. Phrases of the
    same words are looked for once. Only texts with the rarest word of a phrase are searched for
    the others, at the starts which that word leaves, so rows grow with the rare words' occurrences. Where
    those are more than the rows of the texts, as with many phrases of common words, the starts are those of
    two neighbouring words of a phrase (:func:`_pair_starts`), whose rows grow with the texts.
    """
    rows = tokens if "positions" in tokens.columns else tokens.withColumn("positions", F.array("pos"))
    document = document_columns(tokens)
    rows, repeated = _by_document(rows.select(*document, "field", "term", "positions"), document)
    place = F.struct(F.col("pos").alias("offset"), "term")
    named = durable(phrases.groupBy("qid", "clause", "field", "size").agg(F.array_sort(F.collect_list(place)).alias("words")))
    alike = ["field", "size", "words"]
    first = named.groupBy(*alike).agg(F.min(F.struct("qid", "clause")).alias("phrase"))
    named = durable(named.join(broadcast_if_small(durable(first)), alike))
    words = named.select("phrase", "field", "size", "words").distinct().select("phrase", "field", "size", F.inline("words"))
    counts = rows.groupBy("field", "term").agg(F.count("*").alias("n"))
    known = durable(
        words.join(counts, ["field", "term"])
        .groupBy("phrase", "field", "size")
        .agg(F.array_sort(F.collect_list(F.struct("offset", "term", "n"))).alias("known"))
        .filter("size(known) = size")
    )
    rarest = F.array_min(F.transform("known", lambda x: F.struct(x["n"], x["term"], x["offset"])))
    searched = known.select(rarest["n"].alias("n")).agg(F.sum("n")).first()[0] or 0
    in_pairs = F.lit(searched > (counts.agg(F.sum("n")).first()[0] or 0)) & (F.col("size") > 1)
    single = known.filter(~in_pairs).select("phrase", "field", rarest["term"].alias("term"), rarest["offset"].alias("offset"))
    starts = F.transform("positions", lambda p: p - F.col("offset"))
    found = (
        rows.join(broadcast_if_small(single), ["field", "term"])
        .groupBy("phrase", *document)
        .agg(F.array_distinct(F.flatten(F.collect_list(starts))).alias("starts"))
    )
    pairs = known.filter(in_pairs)
    freqs = None
    if not pairs.isEmpty():
        from_pairs = _pair_starts(pairs, rows, document)
        # Nothing is left to look for where a phrase has two words.
        freqs = from_pairs.filter("size = 2").select("phrase", *document, F.size("starts").cast("long").alias("freq"))
        longer = pairs.filter("size > 2")
        if not longer.isEmpty():
            found = found.unionByName(_pair_starts(longer, rows, document).drop("size"))
    sought = found.select("phrase", "starts", *[F.col(c).alias(f"_{c}") for c in document]).join(words, "phrase")
    sought = sought.withColumnsRenamed({"field": "_field", "term": "_term"})
    # A document without a name is one of its own here, too.
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in document]
    met = rows.join(sought, [*same, F.col("field") == F.col("_field"), F.col("term") == F.col("_term")])
    at = met.select("phrase", "size", *document, F.explode(F.array_intersect(starts, "starts")).alias("start"))
    if repeated is not None:
        every = repeated.join(words, ["field", "term"])
        at = at.unionByName(every.select("phrase", "size", *document, F.explode(starts).alias("start")))
    hits = (
        at.groupBy("phrase", "size", *document, "start")
        .agg(F.count("*").alias("found"))
        .filter("found = size")
    )
    counted = hits.groupBy("phrase", *document).agg(F.count("*").alias("freq"))
    freqs = counted if freqs is None else freqs.unionByName(counted)
    # Many topics may share a phrase: they go to the documents that hold it, where their number allows.
    asked = broadcast_if_small(named.select("qid", "clause", "phrase"))
    return freqs.join(asked, "phrase").select("qid", "clause", *document, "freq")


def _pair_starts(phrases: DataFrame, rows: DataFrame, document: list[str]) -> DataFrame:
    """(phrase, size, document, starts): where two neighbouring words of a phrase stand as far apart in a text as
    in the phrase; those with the rarest word. Every such pair of a text is a row, whatever the number of phrases.
    """

    def pair(i: Column) -> Column:
        one, two = F.get("known", i), F.get("known", i + 1)
        apart = two["offset"] - one["offset"]
        return F.struct(
            F.least(one["n"], two["n"]).alias("n"), apart.alias("apart"), one["term"].alias("term"),
            two["term"].alias("next"), one["offset"].alias("offset"),
        )

    best = F.array_min(F.transform(F.sequence(F.lit(0), F.size("known") - 2), pair))
    chosen = durable(phrases.select("phrase", "size", "field", best.alias("pair")).select("phrase", "size", "field", "pair.*").drop("n"))
    distances = sorted(r["apart"] for r in chosen.select("apart").distinct().collect())
    wanted = chosen.select("field", "term").union(chosen.select("field", "next")).distinct()
    words = rows.join(broadcast_if_small(wanted), ["field", "term"], "left_semi")
    places = F.flatten(F.collect_list(F.transform("positions", lambda p: F.struct(p.cast("int").alias("pos"), "term"))))
    texts = words.groupBy(*document, "field").agg(places.alias("at"))
    texts = texts.select(*document, "field", F.col("at.term").alias("term"), F.col("at.pos").alias("pos"))
    found = neighbours(texts, distances, *document, "field")
    return found.join(broadcast_if_small(chosen), ["field", "apart", "term", "next"]).select(
        "phrase", "size", *document, F.transform("positions", lambda p: p - F.col("offset")).alias("starts")
    )


def _by_document(rows: DataFrame, document: list[str]) -> tuple[DataFrame, DataFrame | None]:
    """A row per word of a document, and apart from them the rows of names that hold a position
    twice, which happens where documents share a name: there every occurrence counts."""
    if DOC_KEY in document:
        return rows, None
    together = F.flatten(F.collect_list("positions")).alias("positions")
    rows = written(rows.groupBy(*document, "field", "term").agg(together), "entries")
    twice = rows.filter(F.size(F.array_distinct("positions")) < F.size("positions"))
    twice = durable(twice.select(*[F.col(c).alias(f"_{c}") for c in document], F.col("field").alias("_field")).distinct())
    if twice.isEmpty():
        return rows, None
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in (*document, "field")]
    return rows.join(twice, same, "left_anti"), rows.join(twice, same, "left_semi")
