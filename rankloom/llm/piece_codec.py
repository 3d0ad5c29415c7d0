"""Encoding and decoding with a pair-merging piece model, in rounds over flat numpy arrays.

A text is its characters, a mark standing for a space and one more mark in front. Pieces never
cross from another character to a mark, so words, each with the marks before it, are encoded
on their own and every distinct word of a slice once.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.llm.common import bounded_batches, kept_columns, ranges, set_aside, text_slices
from rankloom.llm.token_count import PROBE

MARK = "▁"
NONE = np.int64(1) << 60
CODE_POINTS = 0x110000
WORD = re.compile(" *[^ ]+| +")
#: Distinct words that a task remembers before it starts anew.
WORDS_KEPT = 400_000

# One replacement character for every byte that is not part of a character.
codecs.register_error("each_byte", lambda e: ("�", e.start + 1))


class PieceModel:
    """The vocabulary of a model file as arrays, and the merge rounds.

    A symbol is a piece's id, or the vocabulary size plus a code point for other characters.
    """

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        self.size = n = model.vocab_size()
        pieces = model.id_to_piece(list(range(n)))
        plain = [not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)) for i in range(n)]
        if model.normalize(PROBE) != MARK + PROBE.replace(" ", MARK) or any(map(model.is_unused, range(n))):
            raise ValueError(f"{path}: only models that mark spaces and change nothing else are supported")
        if any(MARK in p.lstrip(MARK) for p, ok in zip(pieces, plain, strict=True) if ok):
            raise ValueError(f"{path}: a piece crosses a word boundary")
        self.symbol = np.arange(CODE_POINTS, dtype=np.int64) + n
        ids = {}
        for i, (piece, ok) in enumerate(zip(pieces, plain, strict=True)):
            if ok:
                ids[piece] = i
                if len(piece) == 1:
                    self.symbol[ord(piece)] = i
        self.width = n + CODE_POINTS

        def symbol_of(part: str) -> int | None:
            return int(self.symbol[ord(part)]) if len(part) == 1 else ids.get(part)

        # Equal scores get equal ranks: then the place decides.
        scores = np.array([-model.get_score(i) for i in ids.values()])
        rank = dict(zip(ids, np.unique(scores, return_inverse=True)[1].tolist(), strict=True))
        pairs = {}
        for piece, i in ids.items():
            for cut in range(1, len(piece)):
                left, right = symbol_of(piece[:cut]), symbol_of(piece[cut:])
                if left is not None and right is not None:
                    pairs[left * self.width + right] = (rank[piece], i)
        self.keys = np.array(sorted(pairs), np.int64)
        self.ranks = np.array([pairs[k][0] for k in self.keys.tolist()], np.int64)
        self.merged = np.array([pairs[k][1] for k in self.keys.tolist()], np.int64)
        byte_ids = {p: i for i, p in enumerate(pieces) if model.is_byte(i)}
        self.byte_id = np.array([byte_ids[f"<0x{b:02X}>"] for b in range(256)], np.int64)
        # What each id stands for when it is decoded.
        surface = [p.replace(MARK, " ").encode() if ok else b"" for p, ok in zip(pieces, plain, strict=True)]
        for b, i in enumerate(self.byte_id.tolist()):
            surface[i] = bytes([b])
        surface[model.unk_id()] = " ⁇ ".encode()
        self.surface = np.frombuffer(b"".join(surface), np.uint8)
        self.surface_len = np.array([len(s) for s in surface], np.int64)
        self.surface_at = np.cumsum(self.surface_len) - self.surface_len
        self.control = np.array([model.is_control(i) for i in range(n)])
        self.marked = np.array([ok and p.startswith(MARK) for p, ok in zip(pieces, plain, strict=True)])

    def lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (NONE without one) and merged symbol of symbol pairs."""
        key = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[at] == key
        return np.where(hit, self.ranks[at], NONE), self.merged[at]

    def pair_ranks(self, symbols: np.ndarray, word: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Ranks of the pairs that begin at ``at``; none across words."""
        found = np.full(len(at), NONE)
        inside = at + 1 < len(symbols)
        inside[inside] = word[at[inside]] == word[at[inside] + 1]
        i = at[inside]
        found[inside] = self.lookup(symbols[i], symbols[i + 1])[0]
        return found

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after the other, and how many each has.

        Each round finds the best rank of every word and merges its pairs of that rank from the
        left, all at once. Where a merge makes a pair of that rank or a better one, the order
        matters, and that word gets its leftmost merge alone.
        """
        chars = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        symbols, word = self.symbol[chars], np.repeat(np.arange(len(words)), sizes)
        ranks = self.pair_ranks(symbols, word, np.arange(len(symbols)))
        done_symbols, done_words = [], []
        while len(symbols):
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            counts = np.diff(np.r_[starts, len(word)])
            best = np.repeat(np.minimum.reduceat(ranks, starts), counts)
            over = best == NONE
            if over.any():  # compaction: finished words leave
                done_symbols.append(symbols[over])
                done_words.append(word[over])
                symbols, word, ranks, best = symbols[~over], word[~over], ranks[~over], best[~over]
                if not len(symbols):
                    break
            chosen = np.flatnonzero(ranks == best)
            # Of overlapping pairs, every second one from the left.
            run = np.flatnonzero(np.r_[True, np.diff(chosen) > 1])
            place = np.arange(len(chosen)) - np.repeat(run, np.diff(np.r_[run, len(chosen)]))
            chosen = chosen[place % 2 == 0]
            made = self.lookup(symbols[chosen], symbols[chosen + 1])[1]
            # Pairs that a merge makes with what is left and right of it at that time.
            after = chosen + 2
            ok = after < len(symbols)
            ok[ok] = word[after[ok]] == word[chosen[ok]]
            clash = np.zeros(len(chosen), bool)
            clash[ok] = self.lookup(made[ok], symbols[after[ok]])[0] <= best[chosen[ok]]
            before = np.where(chosen > 0, symbols[chosen - 1], 0)
            joined = np.flatnonzero(np.r_[False, np.diff(chosen) == 2])
            before[joined] = made[joined - 1]
            ok = chosen > 0
            ok[ok] = word[chosen[ok] - 1] == word[chosen[ok]]
            clash[ok] |= self.lookup(before[ok], made[ok])[0] <= best[chosen[ok]]
            if clash.any():
                owner = word[chosen]
                alone = np.isin(owner, owner[clash])
                take = ~alone | np.r_[True, owner[1:] != owner[:-1]]
                chosen, made = chosen[take], made[take]
            symbols[chosen] = made
            left = np.ones(len(symbols), bool)
            left[chosen + 1] = False
            at = (np.cumsum(left) - 1)[chosen]
            symbols, word, ranks = symbols[left], word[left], ranks[left]
            ranks[at] = self.pair_ranks(symbols, word, at)
            at = at[at > 0] - 1
            ranks[at] = self.pair_ranks(symbols, word, at)
        symbols = np.concatenate(done_symbols) if done_symbols else np.zeros(0, np.int64)
        word = np.concatenate(done_words) if done_words else np.zeros(0, np.int64)
        order = np.argsort(word, kind="stable")
        symbols, word = symbols[order], word[order]
        ids, repeats = self.with_bytes(symbols)
        return ids, np.bincount(np.repeat(word, repeats), minlength=len(words)).astype(np.int64)

    def with_bytes(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of symbols, the bytes' ids for characters outside the vocabulary; ids of each."""
        repeats = np.ones(len(symbols), np.int64)
        other = np.flatnonzero(symbols >= self.size)
        if not len(other):
            return symbols, repeats
        kinds, which = np.unique(symbols[other], return_inverse=True)
        spelled = [chr(k - self.size).encode("utf-8", "surrogatepass") for k in kinds.tolist()]
        sizes = np.array([len(s) for s in spelled])
        repeats[other] = sizes[which]
        ids = np.repeat(symbols, repeats)
        at = np.repeat((np.cumsum(repeats) - repeats)[other], sizes[which]) + ranges(sizes[which])
        source = np.repeat((np.cumsum(sizes) - sizes)[which], sizes[which]) + ranges(sizes[which])
        ids[at] = self.byte_id[np.frombuffer(b"".join(spelled), np.uint8)[source]]
        return ids, repeats

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: marks become spaces, the first one goes, wrong bytes become U+FFFD."""
        ids = ids[~self.control[ids]]
        if not len(ids):
            return ""
        sizes = self.surface_len[ids]
        data = self.surface[np.repeat(self.surface_at[ids], sizes) + ranges(sizes)]
        return data[1 if self.marked[ids[0]] else 0 :].tobytes().decode("utf-8", "each_byte")


@lru_cache(maxsize=2)
def piece_model(path: str) -> PieceModel:
    return PieceModel(path)


class _Words(dict):
    """Numbers words as they come; ``new`` holds those not encoded yet."""

    def __init__(self) -> None:
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = at = len(self)
        self.new.append(word)
        return at


def encode_texts(texts: list[str], model: PieceModel, words: _Words, store: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after the other, and how many each has. ``store``: ids and sizes by word."""
    numbers, counts = [], np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        if text:
            found = WORD.findall(" " + text.replace(MARK, " "))
            counts[i] = len(found)
            numbers.append(np.fromiter(map(words.__getitem__, found), np.int64, len(found)))
    if words.new:
        ids, sizes = model.encode_words([w.replace(" ", MARK) for w in words.new])
        store[0], store[1] = np.concatenate([store[0], ids]), np.concatenate([store[1], sizes])
        words.new.clear()
    which = np.concatenate(numbers) if numbers else np.zeros(0, np.int64)
    sizes = store[1][which]
    starts = (np.cumsum(store[1]) - store[1])[which]
    ids = store[0][np.repeat(starts, sizes) + ranges(sizes)]
    ends = np.r_[0, np.cumsum(sizes)][np.cumsum(counts)]
    return ids, np.diff(np.r_[0, ends])


def encode(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``df`` with its text replaced by ``ids`` (array<int>), as the model's library encodes it.

    No begin or end ids. A null or empty text has no ids. Repeated rows stay, an empty table
    gives an empty one, a column named ``ids`` is replaced.
    """
    keep, there, back = set_aside(c for c in kept_columns(df, ("ids",)) if c.lower() != text.lower())
    source = df.select(*there, F.col(text).alias("_text"))
    schema = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in source.schema if f.name in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(path)
        words, store = _Words(), [np.zeros(0, np.int64), np.zeros(0, np.int64)]
        for part, texts in text_slices(batches, "_text", 4 << 20):
            if len(words) > WORDS_KEPT:
                words, store = _Words(), [np.zeros(0, np.int64), np.zeros(0, np.int64)]
            ids, counts = encode_texts(texts, model, words, store)
            offsets = pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32))
            lists = pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(len(keep))), lists], names=[*keep, "ids"])

    return bounded_batches(source).mapInArrow(run, f"{schema}ids array<int>").select(*back, "ids")


def decode(df: DataFrame, path: str, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """``df`` with the text that ``ids`` stand for in column ``to``; null ids give an empty text."""
    keep = kept_columns(df, (to,))
    source = df.select(*keep)
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in source.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(path)
        for batch in batches:
            lists = batch.column(keep.index(ids))
            texts = [model.decode(x.values.to_numpy()) if x.is_valid else "" for x in lists]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*keep, to])

    return bounded_batches(source).mapInArrow(run, f"{schema}`{to}` string")


def codec_digests(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: number of ids, digest of the ids joined by commas, digest of the decoded text."""
    both = decode(encode(df.select(key, text), path, text), path)
    return both.select(
        key,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
