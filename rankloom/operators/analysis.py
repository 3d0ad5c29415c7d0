"""Text analysis on token tables (docno, field, pos, term).

Order of the chain: words, possessive, accents, lower case, length, stop words, synonyms,
stemming. Accents and case are folded on the whole text before it is cut, which gives the
same words for one pass over the text. Positions keep their gaps when words are dropped.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.stem import stemmed, stemmed_arrays, stemmed_positions
from ..functions.text import folded, once_computed, without_possessive, words
from ..session import broadcast_if_small, durable, written

# Shortest and longest word kept.
MIN_LENGTH, MAX_LENGTH = 2, 20
# Words that stand for any entry of the synonym list.
SYNONYM_KEYS = ("country", "countries")
FIELDS = ("headline", "text")
DOC_KEY = "doc_key"


@dataclass(frozen=True)
class Analyzer:
    """Settings of the chain. ``stop`` is a word list or a table with column ``term``;
    ``synonyms`` a table (term, synonym)."""

    stop: Sequence[str] | DataFrame | None = None
    synonyms: DataFrame | None = None
    stem: bool = True

    @property
    def name(self) -> str:
        return "CustomAnalyzer"


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with a ``doc_key`` for every row, whatever its docno; kept if there is one already.

    The number is the row's place in the scan. It holds for one pass over the documents; whoever
    reads them several times brings a key that is stored with them.
    """
    if DOC_KEY in docs.columns:
        return docs
    return docs.withColumn(DOC_KEY, F.monotonically_increasing_id())


def document_columns(rows: DataFrame) -> list[str]:
    """The columns that tell documents apart in a table made from documents."""
    return [c for c in (DOC_KEY, "docno") if c in rows.columns]


def fields(docs: DataFrame, names: Sequence[str] = FIELDS, *keys: str) -> DataFrame:
    """One row per document field: (keys, field, text); ``docno`` is the key if none is named."""
    pairs = F.array(*[F.struct(F.lit(n).alias("field"), F.col(n).alias("text")) for n in names])
    return docs.select(*(keys or ("docno",)), F.inline(pairs)).filter("text IS NOT NULL")


def raw_tokens(texts: DataFrame, *keys: str) -> DataFrame:
    """The words as written, with their positions."""
    return texts.select(*keys, F.posexplode(words(F.translate("text", "’", "'"))).alias("pos", "term"))


def possessive(tokens: DataFrame) -> DataFrame:
    return tokens.withColumn("term", without_possessive(F.col("term")))


def fold_accents(tokens: DataFrame) -> DataFrame:
    """Accents and ligatures off, case lowered (one step: the table holds lower case only)."""
    return tokens.withColumn("term", folded(F.col("term")))


def lower_case(tokens: DataFrame) -> DataFrame:
    return tokens.withColumn("term", F.trim(F.lower("term")))


def keep_length(tokens: DataFrame, low: int = MIN_LENGTH, high: int = MAX_LENGTH) -> DataFrame:
    return tokens.filter(F.length("term").between(low, high))


def remove_stop_words(tokens: DataFrame, stop: Sequence[str] | DataFrame) -> DataFrame:
    """Drop stop words, ignoring case; the other positions stay as they are.

    A list becomes a hashed set inside the scan. A table is anti-joined; the planner
    broadcasts it when its size allows.
    """
    if isinstance(stop, DataFrame):
        listed = stop.select(F.lower(F.trim("term")).alias("_stop")).distinct()
        return tokens.join(listed, F.lower("term") == F.col("_stop"), "left_anti")
    listed = sorted({w.strip().lower() for w in stop})
    return tokens.filter(~F.lower("term").isin(listed)) if listed else tokens


def expand_synonyms(tokens: DataFrame, synonyms: DataFrame) -> DataFrame:
    """Add the synonyms of a word at its own position; the word itself stays."""
    keys = [c for c in tokens.columns if c != "term"]
    table = synonyms.select("term", F.explode(words(folded(F.col("synonym")))).alias("_synonym"))
    added = tokens.join(table, "term").select(*keys, F.col("_synonym").alias("term"))
    return tokens.unionByName(added).distinct()


def vocabulary_stems(tokens: DataFrame) -> DataFrame:
    """(term, stem) of every distinct term: the work grows with the vocabulary.

    Written once. It is read more than once, and the table also keeps the optimizer from
    moving filters on the stem into the long chain of expressions that makes it.
    """
    return durable(stemmed(tokens.select("term").distinct()))


def stem(tokens: DataFrame) -> DataFrame:
    """Replace the terms of a token table by their stems through the vocabulary.

    Texts are better stemmed as entries (:func:`stemmed_entries`): a row per word of a text and not per
    token then meets the vocabulary.
    """
    columns = tokens.columns
    joined = tokens.join(vocabulary_stems(tokens), "term")
    return joined.withColumn("term", F.col("stem")).select(*columns)


def _placed_words(analyzer: Analyzer) -> Column:
    """The kept words of a text as an array of (term, pos), by length and stop list."""
    placed = F.transform(
        words(folded(F.col("text"))),
        lambda w, i: F.struct(without_possessive(w).alias("term"), i.alias("pos")),
    )
    kept = F.filter(placed, lambda x: F.length(x["term"]).between(MIN_LENGTH, MAX_LENGTH))
    if analyzer.stop is None or isinstance(analyzer.stop, DataFrame):
        return kept
    listed = sorted({w.strip().lower() for w in analyzer.stop})
    return F.filter(kept, lambda x: ~x["term"].isin(listed)) if listed else kept


def _grouped_words(placed: Column) -> Column:
    """(term, positions) of each word of an array of (term, pos), inside the row.

    The array is sorted, runs of one word begin where the word changes, and each run is cut out, so
    the work of a text is that of sorting its words.
    """

    def runs(term: Column, pos: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(0), F.size(term) - 1), lambda i: (i == 0) | (F.get(term, i) != F.get(term, i - 1))
        )
        return once_computed(
            starts,
            lambda s: F.transform(
                s,
                lambda i, k: F.struct(
                    F.get(term, i).alias("term"),
                    F.slice(pos, i + 1, F.coalesce(F.get(s, k + 1), F.size(term)) - i).alias("positions"),
                ),
            ),
        )

    def columns(at: Column) -> Column:
        return once_computed(at["term"], lambda term: once_computed(at["pos"], lambda pos: runs(term, pos)))

    empty = F.filter(F.array(F.struct(F.lit("").alias("term"), F.array(F.lit(0)).alias("positions"))), lambda x: F.lit(False))
    return F.when(F.size(placed) > 0, once_computed(F.sort_array(placed), columns)).otherwise(empty)


def text_words(texts: DataFrame, *keys: str, analyzer: Analyzer | None = None) -> DataFrame:
    """(keys..., dl, words) of every text: its length in words, and each word with its positions.

    All of it is made in the text's own row, before stemming, which changes neither lengths
    nor positions. A stop list is applied; stop tables and synonyms are joined by :func:`entries`.
    """
    placed = texts.select(*keys, _placed_words(analyzer or Analyzer()).alias("_placed"))
    return placed.select(*keys, F.size("_placed").cast("long").alias("dl"), _grouped_words(F.col("_placed")).alias("words"))


def placed_words(texts: DataFrame, *keys: str, analyzer: Analyzer | None = None) -> DataFrame:
    """(keys..., dl, term, pos) of every text: its length, its words in order and their positions, as arrays.

    For readers that want few of the words: grouping those costs less than grouping all in their row."""
    placed = texts.select(*keys, _placed_words(analyzer or Analyzer()).alias("_placed"))
    return placed.select(
        *keys, F.size("_placed").cast("long").alias("dl"), F.col("_placed.term").alias("term"), F.col("_placed.pos").alias("pos")
    )


def entries(worded: DataFrame, *keys: str, analyzer: Analyzer | None = None) -> DataFrame:
    """(keys..., term, positions): a row per word of a text, stop tables and synonyms applied."""
    analyzer = analyzer or Analyzer()
    rows = worded.select(*keys, F.inline("words"))
    if isinstance(analyzer.stop, DataFrame):
        rows = remove_stop_words(rows, analyzer.stop)
    if analyzer.synonyms is not None:
        table = analyzer.synonyms.select("term", F.explode(words(folded(F.col("synonym")))).alias("_synonym")).distinct()
        added = rows.join(table, "term").select(*keys, F.col("_synonym").alias("term"), "positions")
        rows = merged(rows.unionByName(added), *keys)
    return rows


def merged(rows: DataFrame, *keys: str) -> DataFrame:
    """Entries (positions) or tokens (pos) of one term of a text put together; each position counts once."""
    found = F.collect_list("pos") if "pos" in rows.columns else F.flatten(F.collect_list("positions"))
    return rows.groupBy(*keys, "term").agg(F.sort_array(F.array_distinct(found)).alias("positions"))


def stemmed_entries(rows: DataFrame, *keys: str, stems: DataFrame | None = None) -> DataFrame:
    """Entries by stem. A text's words meet the vocabulary once each, not once per occurrence, and
    different words of one stem are put together per text.

    A position may hold several words (synonyms) of one stem; it counts once.
    """
    stems = vocabulary_stems(rows) if stems is None else stems
    found = rows.join(broadcast_if_small(stems), "term").select(*keys, F.col("stem").alias("term"), "positions")
    return merged(found, *keys)


def in_own_row(analyzer: Analyzer) -> bool:
    """Whether nothing has to be joined, so that a text's words are made in its own row."""
    return not isinstance(analyzer.stop, DataFrame) and analyzer.synonyms is None


def stemmed_words(texts: DataFrame, *keys: str, analyzer: Analyzer) -> DataFrame:
    """(keys..., term) of every text: the stems of its words in order, as an array."""
    return stemmed_arrays(placed_words(texts, *keys, analyzer=analyzer).select(*keys, "term"))


def by_repeated_keys(texts: DataFrame, *keys: str) -> tuple[DataFrame, DataFrame | None]:
    """The texts whose keys are theirs alone, and those that share them, if there are any."""
    counted = texts.groupBy(*keys).agg(F.count("*").alias("_n")).filter("_n > 1")
    shared = durable(counted.select(*[F.col(k).alias(f"_{k}") for k in keys]))
    if shared.isEmpty():
        return texts, None
    shared = broadcast_if_small(shared)
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return texts.join(shared, same, "left_anti"), texts.join(shared, same, "left_semi")


def text_entries(texts: DataFrame, *keys: str, analyzer: Analyzer | None = None, unique: bool = False) -> DataFrame:
    """(keys..., term, positions) of a table (keys..., text) after the whole chain.

    Stems are made and their positions put together in the text's own row. Only rows of texts that share
    their keys meet in a shuffle; ``unique`` says that none do.
    """
    analyzer = analyzer or Analyzer()
    if not analyzer.stem or not in_own_row(analyzer):
        worded = text_words(texts, *keys, analyzer=analyzer)
        if not analyzer.stem:
            return entries(worded, *keys, analyzer=analyzer)
        return stemmed_entries(entries(written(worded, "words"), *keys, analyzer=analyzer), *keys)
    alone, shared = (texts, None) if unique else by_repeated_keys(texts, *keys)
    rows = _stemmed_in_row(alone, *keys, analyzer=analyzer)
    return rows if shared is None else rows.unionByName(merged(_stemmed_in_row(shared, *keys, analyzer=analyzer), *keys))


def _stemmed_in_row(texts: DataFrame, *keys: str, analyzer: Analyzer) -> DataFrame:
    return stemmed_positions(placed_words(texts, *keys, analyzer=analyzer).select(*keys, "term", "pos"), *keys)


def text_frequencies(texts: DataFrame, *keys: str, analyzer: Analyzer | None = None) -> DataFrame:
    """(keys..., term, tf) after the whole chain, for statistics: positions stay in their rows."""
    analyzer = analyzer or Analyzer()
    if analyzer.synonyms is not None or not analyzer.stem:
        rows = text_entries(texts, *keys, analyzer=analyzer)
        return rows.select(*keys, "term", F.size("positions").cast("long").alias("tf"))
    worded = text_words(texts, *keys, analyzer=analyzer)
    counts = F.transform("words", lambda w: F.struct(w["term"].alias("term"), F.size(w["positions"]).alias("n")))
    rows = written(worded.select(*keys, F.inline(counts)), "words")
    if isinstance(analyzer.stop, DataFrame):
        rows = remove_stop_words(rows, analyzer.stop)
    found = rows.join(broadcast_if_small(vocabulary_stems(rows)), "term")
    return found.groupBy(*keys, F.col("stem").alias("term")).agg(F.sum("n").alias("tf"))


def text_lengths(texts: DataFrame, *keys: str, analyzer: Analyzer | None = None) -> DataFrame:
    """(keys..., dl) of the texts that keep a word; a pass over the texts without a shuffle, unless
    stop tables or synonyms have to be joined."""
    analyzer = analyzer or Analyzer()
    worded = text_words(texts, *keys, analyzer=analyzer)
    if isinstance(analyzer.stop, DataFrame) or analyzer.synonyms is not None:
        counted = entries(worded, *keys, analyzer=analyzer).withColumn("n", F.size("positions"))
        return counted.groupBy(*keys).agg(F.sum("n").cast("long").alias("dl"))
    return kept_lengths(worded, *keys)


def kept_lengths(worded: DataFrame, *keys: str) -> DataFrame:
    """(keys..., dl) of texts with a word. A filter on ``dl`` would be moved below the cutting of
    the words and cut every text once more, so the row goes where it is made."""
    return worded.select(*keys, F.explode(F.filter(F.array("dl"), lambda n: n > 0)).alias("dl"))


def analyzed_tokens(texts: DataFrame, *keys: str, analyzer: Analyzer | None = None) -> DataFrame:
    """(keys..., pos, term) of a table (keys..., text) after the whole chain."""
    if not (analyzer or Analyzer()).stem:
        return unstemmed_tokens(texts, *keys, analyzer=analyzer)
    rows = text_entries(texts, *keys, analyzer=analyzer)
    return rows.select(*keys, F.explode("positions").alias("pos"), "term")


def unstemmed_tokens(texts: DataFrame, *keys: str, analyzer: Analyzer | None = None) -> DataFrame:
    """The chain up to stemming, in one pass over the text without a shuffle."""
    analyzer = analyzer or Analyzer()
    tokens = texts.select(*keys, F.posexplode(words(folded(F.col("text")))).alias("pos", "term"))
    tokens = keep_length(possessive(tokens))
    if analyzer.stop is not None:
        tokens = remove_stop_words(tokens, analyzer.stop)
    if analyzer.synonyms is not None:
        tokens = expand_synonyms(tokens, analyzer.synonyms)
    return tokens


def analyze(texts: DataFrame, *keys: str, analyzer: Analyzer | None = None) -> DataFrame:
    """(keys..., terms): the analysed terms of each text as an ordered array.

    The words of a text are in order where they are cut, and so are their stems; only those of texts that
    share their keys have to be put together.
    """
    analyzer = analyzer or Analyzer()
    if not analyzer.stem or not in_own_row(analyzer):
        return _in_order(text_entries(texts, *keys, analyzer=analyzer), *keys)
    alone, shared = by_repeated_keys(texts, *keys)
    rows = stemmed_words(alone, *keys, analyzer=analyzer).filter(F.size("term") > 0).select(*keys, F.col("term").alias("terms"))
    if shared is None:
        return rows
    return rows.unionByName(_in_order(merged(_stemmed_in_row(shared, *keys, analyzer=analyzer), *keys), *keys))


def _in_order(rows: DataFrame, *keys: str) -> DataFrame:
    placed = F.flatten(F.collect_list(F.transform("positions", lambda p: F.struct(p.alias("pos"), F.col("term")))))
    return rows.groupBy(*keys).agg(F.array_sort(placed).alias("at")).select(*keys, F.col("at.term").alias("terms"))
