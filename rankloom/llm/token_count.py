"""Token counts: texts go to a tokenizer library in batches, only lengths come back."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.llm.common import bounded_batches, kept_columns, set_aside, text_slices

#: Bytes of text in one call of the library, and characters from which a text is cut up.
CALL_BYTES = 1 << 20
LONG_TEXT = 1 << 16
#: Text on which a model that only marks spaces must show itself.
PROBE = " a  b\tﬁ́  ．Ａ　é\n①  "


def cut_at_spaces(text: str, length: int) -> list[str]:
    """Parts of at least ``length`` characters that a library marking each start by a space joins again.

    A cut is at a space behind another character; the space goes, as the library puts it back.
    """
    parts, start = [], 0
    while len(text) - start > length:
        at = text.find(" ", start + length)
        while at > 0 and text[at - 1] in " ▁":
            at = text.find(" ", at + 1)
        if at < 0 or at + 1 == len(text):  # nothing may follow: an empty part has no space put back
            break
        parts.append(text[start:at])
        start = at + 1
    return [*parts, text[start:]]


def _sentencepiece(path: str) -> tuple[Callable[[list[str]], list[int]], bool]:
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    pieces = model.id_to_piece(list(range(model.vocab_size())))
    # Tokens never cross a space behind another character, and the text is used as it is.
    safe = model.normalize(PROBE) == "▁" + PROBE.replace(" ", "▁") and not any(
        "▁" in p.lstrip("▁") for p in pieces
    )
    return lambda texts: [len(x) for x in model.encode(texts, num_threads=1)], safe


def _tokenizers(path: str) -> tuple[Callable[[list[str]], list[int]], bool]:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    model.no_truncation()
    model.no_padding()
    return lambda texts: [len(x.ids) for x in model.encode_batch(texts, add_special_tokens=False)], False


def lengths(texts: list[str], encode: Callable[[list[str]], list[int]], safe: bool) -> list[int]:
    """Tokens of each text; parts of long texts are encoded one by one and added up."""
    parts, owner = [], []
    for i, text in enumerate(texts):
        cut = cut_at_spaces(text, LONG_TEXT) if safe and len(text) > LONG_TEXT else [text]
        parts += cut
        owner += [i] * len(cut)
    found = [0] * len(texts)
    for i, n in zip(owner, encode(parts), strict=True):
        found[i] += n
    return found


def count_tokens(df: DataFrame, path: str, text: str = "text", limit: int = 4096) -> DataFrame:
    """``df`` without its text, with n_bytes, n_tokens and over_limit of each whole text.

    ``path`` is a ``.model`` file (sentencepiece) or a ``.json`` file (tokenizers). A null text
    counts as empty: 0 bytes, 0 tokens. Repeated rows stay rows of their own, an empty table
    gives an empty result, and columns of ``df`` named like a new one are replaced. Texts of a
    model that only marks spaces are cut at spaces when long; with other models they stay whole.
    """
    made = ("n_bytes", "n_tokens", "over_limit")
    keep, there, back = set_aside(c for c in kept_columns(df, made) if c.lower() != text.lower())
    source = df.select(*there, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    load = _sentencepiece if path.endswith(".model") else _tokenizers

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, safe = load(path)
        for part, texts in text_slices(batches, "_text", CALL_BYTES):
            yield pa.RecordBatch.from_arrays(
                [*(part.column(i) for i in range(len(keep) + 1)), pa.array(lengths(texts, encode, safe), pa.int64())],
                names=[*keep, "n_bytes", "n_tokens"],
            )

    # Bytes are counted beside the tokens, before the text is dropped.
    sized = source.select(*keep, F.octet_length("_text").cast("long").alias("n_bytes"), "_text")
    schema = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in source.schema if f.name in keep)
    counted = bounded_batches(sized).mapInArrow(count, schema + "n_bytes bigint, n_tokens bigint")
    return counted.select(*back, "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
