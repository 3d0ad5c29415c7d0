"""Pairs of words that stand a given number of places apart in the same text."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from ..session import bounded_batches
from .stem import list_lengths, lists_of


def neighbours(texts: DataFrame, distances: Sequence[int], *keys: str) -> DataFrame:
    """(keys..., apart, term, next, positions): a row per pair of words of a text, with the places of the first.

    From (keys..., term, pos), the words of a text and their places as arrays in any order; several words may
    stand at a place. ``next`` stands ``apart`` places after ``term``, 0 or more. Texts do not meet, so nothing
    is shuffled.
    """
    distances = list(distances)

    def paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index("term"))
            words = lists.flatten().dictionary_encode()
            places = batch.column(batch.schema.get_field_index("pos")).flatten().to_numpy().astype(np.int64)
            if not len(places):
                continue
            text = np.repeat(np.arange(len(lists)), list_lengths(lists))
            width = int(places.max()) + max(distances, default=0) + 1
            at = text * width + places
            order = np.argsort(at, kind="stable")
            at, codes = at[order], words.indices.to_numpy()[order].astype(np.int64)
            for apart in distances:
                first = np.searchsorted(at, at + apart, "left")
                many = np.searchsorted(at, at + apart, "right") - first
                one = np.repeat(np.arange(len(at)), many)
                two = np.repeat(first, many) + np.arange(len(one)) - np.repeat(np.cumsum(many) - many, many)
                if len(one):
                    yield rows(batch, words.dictionary, at[one], codes[one], codes[two], width, apart)

    def rows(batch, terms, at, one, two, width, apart) -> pa.RecordBatch:
        text, place = np.divmod(at, width)
        order = np.lexsort((place, two, one, text))
        text, place, one, two = text[order], place[order], one[order], two[order]
        new = (text[1:] != text[:-1]) | (one[1:] != one[:-1]) | (two[1:] != two[:-1])
        starts = np.flatnonzero(np.concatenate([[True], new]))
        kept = [batch.column(batch.schema.get_field_index(k)).take(pa.array(text[starts])) for k in keys]
        positions = lists_of(np.diff(np.append(starts, len(text))), pa.array(place.astype(np.int32)))
        made = [pa.array(np.full(len(starts), apart, np.int32)), terms.take(pa.array(one[starts])), terms.take(pa.array(two[starts]))]
        return pa.RecordBatch.from_arrays([*kept, *made, positions], names=[*keys, "apart", "term", "next", "positions"])

    made = [("apart", IntegerType()), ("term", StringType()), ("next", StringType()), ("positions", ArrayType(IntegerType()))]
    schema = StructType([texts.schema[k] for k in keys] + [StructField(*m) for m in made])
    return bounded_batches(texts).mapInArrow(paired, schema)
