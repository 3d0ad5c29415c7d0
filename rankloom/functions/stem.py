"""Porter's stemmer (1980, with the author's later points of departure) as column expressions.

Each step is one or two regular expressions over the word, so stemming runs in the JVM
and stays an ordinary projection. ``stemmed`` takes and gives a DataFrame because each
step is a projection of its own: that keeps the expressions from growing into each other.
``stem_of`` is the same for one word, for texts whose words are stemmed in their own rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..session import bounded_batches

# Words whose stems a Python worker remembers.
CACHED_WORDS = 1 << 17

# Consonant and vowel runs. ``Y`` stands for a leading consonant y.
_C = "[^aeiou][^aeiouy]*"
_V = "[aeiouy][aeiou]*"
MEASURE_ABOVE_0 = f"^(?:{_C})?{_V}{_C}"
MEASURE_IS_1 = f"^(?:{_C})?{_V}{_C}(?:{_V})?$"
MEASURE_ABOVE_1 = f"^(?:{_C})?{_V}{_C}{_V}{_C}"
HAS_VOWEL = f"^(?:{_C})?[aeiouy]"
SHORT_END = f"^{_C}[aeiouy][^aeiouwxy]$"
DOUBLE_END = "(?:bb|cc|dd|ff|gg|hh|jj|kk|mm|nn|pp|qq|rr|tt|vv|ww|xx)$"

# Suffixes and their replacements.
STEP_2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize",
    "bli": "ble", "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous",
    "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive",
    "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble",
    "logi": "log",
}
STEP_3 = {
    "icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "",
    "ness": "",
}
STEP_4 = (
    "al|ance|ence|er|ic|able|ible|ant|ement|ment|ent|ou|ism|ate|iti|ous|ive|ize"
)


def _case_table(table: dict[str, str], suffix: str) -> str:
    cases = " ".join(f"WHEN '{old}' THEN '{new}'" for old, new in table.items())
    return f"CASE {suffix} {cases} END"


def _split(word: str, suffixes: str, part: int) -> str:
    return f"regexp_extract({word}, '^(.+?)({suffixes})$', {part})"


def stem_steps() -> list[tuple[str, str]]:
    """(column, SQL) pairs to be computed one after the other from column ``w``; the last
    one is the stem. The same text runs on any SQL engine with regular expressions."""
    vowel = f"regexp_like({{0}}, '{HAS_VOWEL}')".format
    above0 = f"regexp_like({{0}}, '{MEASURE_ABOVE_0}')".format
    above1 = f"regexp_like({{0}}, '{MEASURE_ABOVE_1}')".format
    step2, step3 = "|".join(STEP_2), "|".join(STEP_3)
    return [
        ("w0", "CASE WHEN left(w, 1) = 'y' THEN concat('Y', substring(w, 2)) ELSE w END"),
        (
            "w1",
            "CASE WHEN regexp_like(w0, '(?:ss|i)es$') THEN left(w0, length(w0) - 2)"
            " WHEN regexp_like(w0, '[^s]s$') THEN left(w0, length(w0) - 1) ELSE w0 END",
        ),
        ("stem_ed", _split("w1", "ed|ing", 1)),
        (
            "w2",
            f"CASE WHEN regexp_like(w1, '.eed$') THEN CASE WHEN {above0('left(w1, length(w1) - 3)')}"
            " THEN left(w1, length(w1) - 1) ELSE w1 END"
            f" WHEN stem_ed <> '' AND {vowel('stem_ed')} THEN"
            " CASE WHEN regexp_like(stem_ed, '(?:at|bl|iz)$') THEN concat(stem_ed, 'e')"
            f" WHEN regexp_like(stem_ed, '{DOUBLE_END}') THEN left(stem_ed, length(stem_ed) - 1)"
            f" WHEN regexp_like(stem_ed, '{SHORT_END}') THEN concat(stem_ed, 'e')"
            " ELSE stem_ed END ELSE w1 END",
        ),
        (
            "w3",
            f"CASE WHEN regexp_like(w2, '.y$') AND {vowel('left(w2, length(w2) - 1)')}"
            " THEN concat(left(w2, length(w2) - 1), 'i') ELSE w2 END",
        ),
        ("stem_2", _split("w3", step2, 1)),
        ("end_2", _split("w3", step2, 2)),
        (
            "w4",
            f"CASE WHEN end_2 <> '' AND {above0('stem_2')}"
            f" THEN concat(stem_2, {_case_table(STEP_2, 'end_2')}) ELSE w3 END",
        ),
        ("stem_3", _split("w4", step3, 1)),
        ("end_3", _split("w4", step3, 2)),
        (
            "w5",
            f"CASE WHEN end_3 <> '' AND {above0('stem_3')}"
            f" THEN concat(stem_3, {_case_table(STEP_3, 'end_3')}) ELSE w4 END",
        ),
        ("stem_4", _split("w5", STEP_4, 1)),
        (
            "w6",
            f"CASE WHEN stem_4 <> '' THEN CASE WHEN {above1('stem_4')} THEN stem_4 ELSE w5 END"
            f" WHEN regexp_like(w5, '.[st]ion$') AND {above1('left(w5, length(w5) - 3)')}"
            " THEN left(w5, length(w5) - 3) ELSE w5 END",
        ),
        ("stem_5", "regexp_extract(w6, '^(.+)e$', 1)"),
        (
            "w7",
            f"CASE WHEN stem_5 <> '' AND ({above1('stem_5')} OR (regexp_like(stem_5, '{MEASURE_IS_1}')"
            f" AND NOT regexp_like(stem_5, '{SHORT_END}'))) THEN stem_5 ELSE w6 END",
        ),
        (
            "w8",
            f"CASE WHEN regexp_like(w7, 'll$') AND {above1('w7')}"
            " THEN left(w7, length(w7) - 1) ELSE w7 END",
        ),
        ("stem", "CASE WHEN length(w) < 3 THEN w ELSE replace(w8, 'Y', 'y') END"),
    ]


def stemmed(vocabulary: DataFrame, term: str = "term", name: str = "stem") -> DataFrame:
    """Add the stem of every lower-case ``term``."""
    columns = vocabulary.columns
    df = vocabulary.withColumn("w", F.col(term))
    for column, sql in stem_steps():
        df = df.withColumn(column, F.expr(sql))
    return df.select(*columns, F.col("stem").alias(name))


_ABOVE_0, _ABOVE_1, _IS_1, _VOWEL, _SHORT, _DOUBLE, _S, _E = (
    re.compile(p).search
    for p in (MEASURE_ABOVE_0, MEASURE_ABOVE_1, MEASURE_IS_1, HAS_VOWEL, SHORT_END, DOUBLE_END, "[^s]s$", "(?:at|bl|iz)$")
)


def _suffixes(listed: str):
    """A function that cuts a word before the longest of the suffixes that leave something of it, or gives ("", "")."""
    ends, cut = tuple(listed.split("|")), re.compile(f"^(.+?)({listed})$").search

    def parts(word: str) -> tuple[str, str]:
        found = cut(word) if word.endswith(ends) else None
        return found.groups() if found else ("", "")

    return parts


_PARTS_ED, _PARTS_4 = _suffixes("ed|ing"), _suffixes(STEP_4)
_TABLES = [(table, _suffixes("|".join(table))) for table in (STEP_2, STEP_3)]


@lru_cache(maxsize=CACHED_WORDS)
def stem_of(word: str) -> str:
    """The stem of one lower-case word: the steps of :func:`stem_steps`, expression by expression."""
    if len(word) < 3:
        return word
    w = "Y" + word[1:] if word[0] == "y" else word
    if w.endswith(("sses", "ies")):
        w = w[:-2]
    elif w[-1] == "s" and _S(w):
        w = w[:-1]
    stem_ed = _PARTS_ED(w)[0]
    if w.endswith("eed") and len(w) > 3:
        w = w[:-1] if _ABOVE_0(w[:-3]) else w
    elif stem_ed and _VOWEL(stem_ed):
        if _E(stem_ed):
            w = stem_ed + "e"
        elif _DOUBLE(stem_ed):
            w = stem_ed[:-1]
        else:
            w = stem_ed + "e" if _SHORT(stem_ed) else stem_ed
    if w[-1] == "y" and len(w) > 1 and _VOWEL(w[:-1]):
        w = w[:-1] + "i"
    for table, parts in _TABLES:
        start, end = parts(w)
        if end and _ABOVE_0(start):
            w = start + table[end]
    start = _PARTS_4(w)[0]
    if start:
        w = start if _ABOVE_1(start) else w
    elif w.endswith(("sion", "tion")) and len(w) > 4 and _ABOVE_1(w[:-3]):
        w = w[:-3]
    start = w[:-1] if w[-1] == "e" else ""
    if start and (_ABOVE_1(start) or (_IS_1(start) and not _SHORT(start))):
        w = start
    if w.endswith("ll") and _ABOVE_1(w):
        w = w[:-1]
    return w.replace("Y", "y")


def _stems_of(words: pa.DictionaryArray) -> pa.Array:
    return pa.array([stem_of(w) for w in words.dictionary.to_pylist()], pa.string())


def stemmed_arrays(df: DataFrame, column: str = "term") -> DataFrame:
    """``df`` with the words of an array column replaced by their stems, in their own rows.

    For whole texts: no vocabulary is made or joined, so nothing is shuffled. The different words of a
    batch of rows are stemmed once each.
    """

    def replaced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(column)
            words = batch.column(at).flatten().dictionary_encode()
            stems = _stems_of(words).take(words.indices)
            arrays = batch.columns
            arrays[at] = lists_of(list_lengths(batch.column(at)), stems)
            yield pa.RecordBatch.from_arrays(arrays, names=batch.schema.names)

    return bounded_batches(df).mapInArrow(replaced, df.schema)


def list_lengths(lists: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def lists_of(lengths: np.ndarray, values: pa.Array) -> pa.ListArray:
    """Lists of the given lengths, one after the other."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), values)


def stemmed_positions(df: DataFrame, *keys: str) -> DataFrame:
    """(keys..., term, positions): a row per stem of each row's words, with their positions in order; from
    (keys..., term, pos), the words of a text in order and their places as arrays. Nothing is shuffled here either.
    """

    def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index("term"))
            words = lists.flatten().dictionary_encode()
            if not len(words):
                continue
            stems = _stems_of(words).dictionary_encode()
            codes = stems.indices.to_numpy()[words.indices.to_numpy()]
            rows = np.repeat(np.arange(len(lists)), list_lengths(lists))
            of = rows * len(stems.dictionary) + codes
            order = np.argsort(of, kind="stable")
            of = of[order]
            starts = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
            first = order[starts]
            lengths = np.diff(np.append(starts, len(of)))
            places = batch.column(batch.schema.get_field_index("pos")).flatten().take(pa.array(order))
            kept = [batch.column(batch.schema.get_field_index(k)).take(pa.array(rows[first])) for k in keys]
            made = [stems.dictionary.take(pa.array(codes[first])), lists_of(lengths, places)]
            yield pa.RecordBatch.from_arrays([*kept, *made], names=[*keys, "term", "positions"])

    fields = [df.schema[k] for k in keys]
    made = [StructField("term", StringType()), StructField("positions", df.schema["pos"].dataType)]
    return bounded_batches(df).mapInArrow(grouped, StructType([*fields, *made]))
