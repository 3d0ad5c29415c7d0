"""Chat formatting with Spark expressions only, and reading the formatted text back.

Adjacent turns of one role share a block::

    <|im_start|>role\\ntext<|im_sep|>text<|im_end|>\\n

In texts and roles a backslash is doubled and ``<|`` becomes ``<\\|``, so no control string can
come from a text; a line feed in a role becomes ``\\n`` in two characters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.functions.text import depths

START, SEPARATOR, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\\|])", "$1")


def escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit("\\n"))


def unescaped_role(role: Column) -> Column:
    # An "n" behind an odd number of backslashes was a line feed.
    return unescaped(F.regexp_replace(role, r"(?<!\\)((?:\\\\)*)\\n", "$1\n"))


def format_chats(df: DataFrame, key: str = "conv_id", learn: str = "assistant") -> DataFrame:
    """One row per conversation: ``key``, ``formatted`` and ``loss_mask``.

    ``df`` has the key, turn, role and text of each turn. Turns are sorted by turn, then role, then
    text; repeated rows stay turns of their own. A null text or role is an empty one, a null turn
    comes first, rows with a null key form one conversation with that key. An empty table gives
    an empty result; further columns are not read. ``loss_mask`` lists start (from 0) and length,
    in characters of ``formatted``, of every text of the role ``learn``.
    """
    turn = F.struct(
        F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    turns = df.groupBy(F.col(key).alias(key)).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    starts = F.filter(
        F.sequence(F.lit(1), F.size("turns")),
        lambda i: (i == 1)
        | (F.element_at("turns", i)["role"] != F.element_at("turns", F.greatest(i - 1, F.lit(1)))["role"]),
    )

    def block(start: Column, k: Column) -> Column:
        stop = F.coalesce(F.get("starts", k + 1), F.size("turns") + 1)
        texts = F.transform(F.slice("turns", start, stop - start), lambda t: escaped(t["text"]))
        return F.struct(F.element_at("turns", start)["role"].alias("role"), texts.alias("texts"))

    blocks = turns.select(key, "turns", starts.alias("starts")).select(
        key, F.transform("starts", block).alias("blocks")
    )

    def parts(b: Column) -> Column:
        head = F.char_length(escaped_role(b["role"])) + len(START) + 1
        return F.transform(
            b["texts"],
            lambda t, j: F.struct(
                F.when(j == 0, head).otherwise(len(SEPARATOR)).alias("head"),
                F.char_length(t).alias("size"),
                F.when(j == F.size(b["texts"]) - 1, len(END)).otherwise(0).alias("tail"),
                (b["role"] == learn).alias("learn"),
            ),
        )

    text = F.array_join(
        F.transform(
            "blocks",
            lambda b: F.concat(
                F.lit(START), escaped_role(b["role"]), F.lit("\n"), F.array_join(b["texts"], SEPARATOR), F.lit(END)
            ),
        ),
        "",
    )
    # Where each part ends: running sums, made in chunks, so long conversations take time in proportion.
    placed = blocks.select(key, text.alias("formatted"), F.flatten(F.transform("blocks", parts)).alias("parts"))
    ends = depths(F.transform("parts", lambda p: p["head"] + p["size"] + p["tail"]))
    spans = F.zip_with(
        "parts",
        ends,
        lambda p, end: F.struct(
            (end - p["size"] - p["tail"]).alias("start"), p["size"].alias("length"), p["learn"].alias("learn")
        ),
    )
    learned = F.transform(
        F.filter(spans, lambda s: s["learn"]), lambda s: F.struct(s["start"].alias("start"), s["length"].alias("length"))
    )
    return placed.select(key, "formatted", learned.alias("loss_mask"))


def parse_chats(formatted: DataFrame, key: str = "conv_id") -> DataFrame:
    """``key`` and ``turns`` (role, text) that a formatted text holds, separate again."""
    pieces = F.split("formatted", r"<\|im_end\|>\n")

    def turns(b: Column) -> Column:
        at = F.instr(b, "\n")
        role = unescaped_role(F.substring(b, F.lit(len(START) + 1), at - len(START) - 1))
        body = F.substring(b, at + 1, F.char_length(b))
        return F.transform(
            F.split(body, r"<\|im_sep\|>"), lambda t: F.struct(role.alias("role"), unescaped(t).alias("text"))
        )

    return (
        formatted.select("*", pieces.alias("_pieces"))
        .select("*", F.slice("_pieces", 1, F.size("_pieces") - 1).alias("_blocks"))
        .drop("_pieces")
        .select("*", F.flatten(F.transform("_blocks", turns)).alias("turns"))
        .drop("_blocks")
    )


def chat_digests(df: DataFrame, key: str = "conv_id", learn: str = "assistant") -> DataFrame:
    """Numbers and digests of what is read back from the formatted text and its loss mask."""
    parsed = parse_chats(format_chats(df, key, learn), key)
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.transform(
        "loss_mask", lambda s: unescaped(F.substring(F.col("formatted"), s["start"] + 1, s["length"]))
    )
    return parsed.select(
        key,
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.array_join(loss, "").alias("_loss"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    ).select(
        key,
        "n_turns",
        "turns_sha256",
        F.char_length("_loss").cast("long").alias("loss_chars"),
        F.sha2("_loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )
