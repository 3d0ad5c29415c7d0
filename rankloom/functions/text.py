"""Column functions on text. All of them are built-in expressions."""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# What may stand inside a word between two letters, and between two digits (word breaking
# of Unicode's annex 29). An underscore joins anything.
BETWEEN_LETTERS = ":.'··՟״‧‘’․︓﹕：﹒＇．"
BETWEEN_DIGITS = ",;.'‘’․﹒＇．;։،؍٬߸⁄︐︔﹐﹔，；"
_PART = r"[\p{L}\p{M}\p{N}_]"
_JOINT = (
    rf"(?:\p{{L}}\p{{M}}*(?:[{BETWEEN_LETTERS}]\p{{L}}\p{{M}}*)+|\p{{N}}(?:[{BETWEEN_DIGITS}]\p{{N}})+)"
)
#: A word: letters, marks, digits and underscores, joined by the signs above; not underscores alone.
WORD = rf"(?:{_PART}*{_JOINT})+{_PART}*|_*[\p{{L}}\p{{N}}]{_PART}*"
# ASCII characters that neither belong to a word nor may stand inside one.
_APART = r"\x00-\x26\x28-\x2B\x2D\x2F\x3C-\x40\x5B-\x5E\x60\x7B-\x7F"
#: The same for Java, with a way that most words take: letters and digits, with nothing after them that could go
#: on with the word. Other words are tried as above, which goes back over every letter in search of a sign.
#: What is usual in ASCII is asked first, before and after a word, as classes of letters are slow to look up.
FAST_WORD = (
    rf"(?![{_APART},.;:'])(?:[a-zA-Z0-9\p{{L}}\p{{N}}]++(?:(?=[{_APART}]|[,.;:'][{_APART},.;:'_])"
    rf"|(?!{_PART}|[{BETWEEN_LETTERS}{BETWEEN_DIGITS}][\p{{L}}\p{{N}}]))|{WORD})"
)
#: Scripts that are written without blanks; each of their characters is a word of its own. They begin at
#: U+2E80, which is asked first, as the script of a character is slow to find.
SINGLE = r"([\u2E80-\x{10FFFF}&&[\p{IsHan}\p{IsHiragana}]])"
#: Anything that folding could change in a text in lower case.
NOT_ASCII = r"[^\x00-\x7F]"

# Letters whose names do not tell the ASCII letters they stand for.
NAMED_FOLDS = {
    "ð": "d", "þ": "th", "ß": "ss", "ı": "i", "ȷ": "j", "ŋ": "n", "ĸ": "q", "ſ": "s", "ƿ": "w", "ə": "a", "ɛ": "e",
    "ɩ": "i", "ɪ": "i", "ʃ": "s", "ʒ": "z", "ɣ": "g", "ƨ": "s", "ƽ": "5", "ɔ": "o", "ʊ": "u", "ʋ": "v", "ȣ": "ou", "ƣ": "oi", "ŉ": "n",
}
# Punctuation that looks like an ASCII sign.
SIGN_FOLDS = {
    '"': "«»“”„‟″‶❝❞❮❯", "'": "‘’‚‛′‵‹›❛❜", "-": "‐‑‒–—⁻₋", "[": "⁅❲", "]": "⁆❳", "(": "⁽₍❨❪", ")": "⁾₎❩❫",
    "<": "❬❰", ">": "❭❱", "{": "❴", "}": "❵", "+": "⁺₊", "=": "⁼₌", "*": "⁎", ";": "⁏", "/": "⁄",
    "%": "⁒", "~": "⁓", "^": "‸",
}
#: Blocks in which characters are folded: Latin letters of all kinds, phonetic letters, raised and lowered ones,
#: circled and bracketed ones, ligatures and full-width forms.
FOLDED_BLOCKS = (
    (0x00A0, 0x02AF), (0x1D00, 0x1DBF), (0x1E00, 0x1EFF), (0x2070, 0x209C), (0x2184, 0x2184), (0x2460, 0x24FF),
    (0x2776, 0x2793), (0x2C60, 0x2C7F), (0xA722, 0xA7FF), (0xFB00, 0xFB06), (0xFF01, 0xFF5E),
)
# Block tags separate words, other tags do not.
BLOCK_TAGS = "p|div|br|li|ul|ol|tr|td|th|table|h[1-6]|article|section|header|footer|nav|title|hr"
ENTITIES = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&amp;": "&"}


def _plain(letter: str) -> str | None:
    """The lower-case ASCII letters, digits or signs that a character stands for, derived from its
    decomposition or its name; None if there are none."""
    if letter in NAMED_FOLDS:
        return NAMED_FOLDS[letter]
    name = unicodedata.name(letter, "")
    parts = "".join(c for c in unicodedata.normalize("NFKD", letter) if not unicodedata.combining(c))
    parts = parts.replace("⁄", "/")
    if letter.isalpha() or re.match("CIRCLED|PARENTHESIZED|DOUBLE CIRCLED|NEGATIVE|DINGBAT|FULLWIDTH|SUPER|SUB", name) or re.search(r"(FULL STOP|COMMA)$", name):
        if parts and parts.isascii() and parts != letter and " " not in parts:
            return parts.lower()
        found = re.match(r"(?:MODIFIER LETTER |LATIN )(?:SMALL|CAPITAL|LETTER SMALL CAPITAL) (?:LETTER |LIGATURE )?([A-Z]{1,2})(?: WITH .*)?$", name)
        if found:
            return found[1].lower()
        digits = re.match(r"(?:DINGBAT )?(?:NEGATIVE |DOUBLE )?(?:CIRCLED|SANS-SERIF)[A-Z -]*(?:DIGIT|NUMBER) ([A-Z -]+)$", name)
        value = unicodedata.numeric(letter, None)
        if digits and value is not None:
            return str(int(value))
    return None


@lru_cache(maxsize=1)
def fold_tables() -> tuple[str, str, dict[str, str]]:
    """Characters and the single ASCII ones they stand for, and those that stand for several.

    Lower-case forms only, as texts are lower-cased before.
    """
    single, several = {}, {}
    for first, last in FOLDED_BLOCKS:
        for code in range(first, last + 1):
            letter = chr(code)
            if letter != letter.lower() or unicodedata.category(letter) == "Cn":
                continue
            found = _plain(letter)
            if found and len(found) == 1:
                single[letter] = found
            elif found:
                several[letter] = found
    for sign, letters in SIGN_FOLDS.items():
        single |= dict.fromkeys(letters, sign)
    several |= {"‼": "!!", "⁇": "??", "⁈": "?!", "⁉": "!?", "‖": "||"}
    return "".join(single), "".join(single.values()), several


def _all_ascii(text: Column) -> Column:
    """Whether every character takes one byte; no pattern has to look at the text for that."""
    return F.octet_length(text) == F.char_length(text)


def folded(text: Column) -> Column:
    """Lower case, with the ASCII characters that letters, digits and signs of all kinds stand for.

    Applied to the whole text before it is cut into words: one pass per text, not per word. Texts in
    ASCII are only lower-cased. Of others the different characters beyond ASCII are found first, and only
    those that occur are replaced, each in one go.
    """
    single, plain, several = fold_tables()
    letters = F.lit(single + "".join(several))
    spellings = F.array(*[F.lit(v) for v in (*plain, *several.values())])

    def spelled(text: Column) -> Column:
        found = F.array_distinct(F.regexp_extract_all(text, F.lit(NOT_ASCII), F.lit(0)))
        known = F.filter(found, lambda c: F.instr(letters, c) > 0)
        return F.aggregate(known, text, lambda t, c: F.replace(t, c, F.get(spellings, F.instr(letters, c) - 1)))

    return once_computed(F.lower(text), lambda t: F.when(_all_ascii(t), t).otherwise(spelled(t)))


def words(text: Column) -> Column:
    """The words of ``text`` in order, by the rules of Unicode's word breaking; ideographs singly."""
    apart = once_computed(
        text, lambda t: F.when(~_all_ascii(t) & t.rlike(SINGLE), F.regexp_replace(t, SINGLE, " $1 ")).otherwise(t)
    )
    return F.regexp_extract_all(apart, F.lit(FAST_WORD), F.lit(0))


def without_possessive(word: Column) -> Column:
    """Drop a final ``'s``."""
    ends = word.endswith("'s") | word.endswith("'S") | word.endswith("’s") | word.endswith("’S")
    return F.when(ends, F.left(word, F.length(word) - 2)).otherwise(word)


def collapsed(text: Column) -> Column:
    """Runs of blanks as one blank; single blanks, the most of them, are not looked at as matches."""
    return F.trim(F.regexp_replace(text, r"[\t\n\x0B\f\r]\s*+| \s++", " "))


def element(text: Column, tag: str) -> Column:
    """Content of the first ``<tag>`` element; null when there is none."""
    pattern = rf"(?is)<(?:{tag})(?:\s[^>]*)?>(.*?)</(?:{tag})\s*>"

    def content(found: Column) -> Column:
        return F.when(found != "", found).when(text.rlike(pattern), "")  # empty, or none at all

    return once_computed(F.regexp_extract(text, pattern, 1), content)


def elements(text: Column, tag: str) -> Column:
    """Contents of all ``<tag>`` elements joined by blanks; null when there is none."""
    pattern = rf"(?is)<(?:{tag})(?:\s[^>]*)?>(.*?)</(?:{tag})\s*>"
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
    return once_computed(found, lambda x: F.when(F.size(x) > 0, F.array_join(x, " ")))


def once_computed(value: Column, function) -> Column:
    """``function`` of a value that is computed once, however often the function uses it."""
    return F.transform(F.array(value), function)[0]


# Steps that are summed in one go; longer arrays are summed in chunks, so time stays in proportion.
CHUNK = 256


def depths(steps: Column) -> Column:
    """Running sums of an array of whole numbers that never fall below 0.

    A chunk turns a depth x into max(x + a, b), whatever x is; so chunks are summed up first, then
    entered with the depth that the chunks before them lead to.
    """

    def climb(values: Column, start: Column) -> Column:
        return F.aggregate(
            values, F.array(start), lambda d, v: F.concat(d, F.array(F.greatest(F.element_at(d, -1) + v, F.lit(0))))
        )

    def of(s: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(s), F.lit(1)), F.lit(CHUNK))
        effects = F.transform(
            starts,
            lambda at: F.aggregate(
                F.slice(s, at, F.lit(CHUNK)),
                F.struct(F.lit(0).alias("a"), F.lit(0).alias("b")),
                lambda e, v: F.struct((e["a"] + v).alias("a"), F.greatest(e["b"] + v, F.lit(0)).alias("b")),
            ),
        )
        entered = F.aggregate(
            effects,
            F.array(F.lit(0)),
            lambda d, e: F.concat(d, F.array(F.greatest(F.element_at(d, -1) + e["a"], e["b"]))),
        )
        return once_computed(
            entered,
            lambda b: F.flatten(
                F.transform(
                    starts,
                    lambda at, k: F.slice(climb(F.slice(s, at, F.lit(CHUNK)), F.get(b, k)), 2, CHUNK),
                )
            ),
        )

    return once_computed(steps, of)


def outermost(text: Column, tag: str) -> Column:
    """Contents of all outermost ``<tag>`` elements joined by blanks, those inside them included.

    Null when there is none. An element that is not closed reaches to the end of the text.
    """
    pieces = F.regexp_extract_all(text, F.lit(rf"(?is)</?(?:{tag})(?:\s[^<>]*)?>|[^<]+|<"), F.lit(0))

    def step(piece: Column) -> Column:
        return (
            F.when(~piece.startswith("<") | (F.length(piece) < 3) | piece.endswith("/>"), 0)
            .when(piece.startswith("</"), -1)
            .otherwise(1)
        )

    def content(found: Column, depth: Column) -> Column:
        def kept(piece: Column, i: Column) -> Column:
            after, before = F.get(depth, i), F.coalesce(F.get(depth, i - 1), F.lit(0))
            return F.when((before > 0) & (after > 0), piece).when((before == 0) & (after > 0), " ").otherwise("")

        joined = F.array_join(F.transform(found, kept), "")
        return F.when(F.exists(depth, lambda d: d > 0), joined)

    return once_computed(pieces, lambda found: once_computed(depths(F.transform(found, step)), lambda d: content(found, d)))


def without_elements(text: Column, tags: list[str]) -> Column:
    """Remove whole elements of the given tags, their content included."""
    for tag in tags:
        text = F.regexp_replace(text, rf"(?is)<{tag}(?:\s[^>]*)?>.*?</{tag}\s*>", "")
    return text


def plain_text(markup: Column) -> Column:
    """Text of a piece of markup: tags removed, entities decoded, blanks collapsed."""

    def untagged(text: Column) -> Column:
        bare = F.regexp_replace(text, "(?s)<!--.*?-->", "")
        bare = F.regexp_replace(bare, rf"(?i)</?(?:{BLOCK_TAGS})(?:\s[^>]*)?/?>", " ")
        bare = F.regexp_replace(bare, r"</?[A-Za-z!][^>]*>", "")
        return F.when(text.contains("<"), bare).otherwise(text)

    text = once_computed(markup, untagged)
    for entity, letter in ENTITIES.items():
        text = F.replace(text, F.lit(entity), F.lit(letter))
    return collapsed(text)
