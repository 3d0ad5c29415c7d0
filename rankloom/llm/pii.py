"""Format-preserving pseudonyms: validated values are permuted by a keyed Feistel network.

A value becomes a number below the count of all values of its format, the number is permuted, and
the result is written in the same format. Equal values so get equal pseudonyms everywhere, and
whoever holds the key can go back.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect
from collections.abc import Callable, Iterator
from datetime import date, timedelta
from math import isqrt, prod

import pyarrow as pa
from pyspark.sql import DataFrame

from rankloom.llm.common import bounded_batches, kept_columns, text_slices

ROUNDS = 8
KINDS = ("email", "secret", "iban", "card", "ip", "ssn", "date", "phone")

# First and last day of the dates that count as valid.
FIRST_DAY, LAST_DAY = date(1900, 1, 1), date(2099, 12, 31)


def permute(number: int, count: int, key: bytes, tweak: str, back: bool = False) -> int:
    """A keyed permutation of 0..count-1 (or its inverse): Feistel rounds on two halves.

    The halves span at least ``count`` numbers; results beyond it are permuted again. A count of 1
    leaves nothing to permute.
    """
    low = isqrt(count - 1) + 1 if count > 1 else 1
    high = -(-count // low)

    def noise(i: int, half: int) -> int:
        data = f"{tweak}/{count}/{i}/{half}".encode()
        return int.from_bytes(hashlib.blake2b(data, key=key, digest_size=32).digest(), "big")

    while True:
        a, b = divmod(number, low)
        for i in reversed(range(ROUNDS)) if back else range(ROUNDS):
            step = noise(i, a if i % 2 else b)
            step = -step if back else step
            if i % 2:
                b = (b + step) % low
            else:
                a = (a + step) % high
        number = a * low + b
        if number < count:
            return number


def to_number(digits: list[int], sizes: list[int]) -> int:
    number = 0
    for digit, size in zip(digits, sizes, strict=True):
        number = number * size + digit
    return number


def to_digits(number: int, sizes: list[int]) -> list[int]:
    digits = []
    for size in reversed(sizes):
        number, digit = divmod(number, size)
        digits.append(digit)
    return digits[::-1]


def _other(digits: list[int], sizes: list[int], key: bytes, tweak: str) -> list[int]:
    """The permuted digits; never the same ones unless there are no others."""
    number, count = to_number(digits, sizes), prod(sizes)
    found = permute(number, count, key, tweak)
    if found == number and count > 1:
        found = permute((number + 1) % count, count, key, tweak)  # its place is free of itself
    return to_digits(found, sizes)


#: First character and number of the classes of letters and digits.
CLASSES = {"0": 10, "a": 26, "A": 26}


def _letters(text: str, key: bytes, tweak: str) -> str:
    """Every ASCII letter or digit replaced by one of its class, the others as they are."""
    first = ["0" if c.isdigit() else "a" if c.islower() else "A" if c.isupper() else "" for c in text]
    first = [f if c.isascii() else "" for f, c in zip(first, text, strict=True)]
    at = [i for i, f in enumerate(first) if f]
    digits = [ord(text[i]) - ord(first[i]) for i in at]
    out = list(text)
    for i, d in zip(at, _other(digits, [CLASSES[first[i]] for i in at], key, tweak), strict=True):
        out[i] = chr(ord(first[i]) + d)
    return "".join(out)


def _refill(text: str, digits: str) -> str:
    """``text`` with its digits replaced one by one."""
    new = iter(digits)
    return "".join(next(new) if c.isdigit() else c for c in text)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _email(m: re.Match, key: bytes) -> str | None:
    local, _, domain = m.group().partition("@")
    if ".." in local or local[0] == "." or local[-1] == "." or not any(c.isalnum() for c in local):
        return None
    # Case does not tell mailboxes apart, but the format is kept.
    return f"{_letters(local, key, 'email/' + domain.lower())}@{domain}"


def _secret(m: re.Match, key: bytes) -> str | None:
    value = m.group("value")
    return m.group()[: m.start("value") - m.start()] + _letters(value, key, "secret") + m.group()[m.end("value") - m.start() :]


def _iban(text: str, key: bytes) -> str | None:
    plain = text.replace(" ", "")

    def remainder(body: str) -> int:
        return int("".join(str(int(c, 36)) for c in body)) % 97

    if not 15 <= len(plain) <= 34 or remainder(plain[4:] + plain[:4]) != 1:
        return None
    body = _letters(plain[4:], key, "iban/" + plain[:2])
    new = iter(f"{plain[:2]}{98 - remainder(body + plain[:2] + '00'):02d}{body}")
    return "".join(c if c == " " else next(new) for c in text)


def _ibans(text: str, key: bytes) -> Iterator[tuple[int, int, str]]:
    """Place and pseudonym of every account.

    Words and years behind an account look like groups of it, so it may end at any border of groups:
    first where its country's accounts do, then from the longest one on.
    """
    start = 0
    while m := IBAN.search(text, start):
        start = m.start() + 1
        long = m.group()
        ends = [i for i, c in enumerate(long) if c == " "] + [len(long)]
        length = IBAN_LENGTHS.get(long[:2])
        for end in sorted(ends, key=lambda e: (e - long.count(" ", 0, e) != length, -e)):
            if new := _iban(long[:end], key):
                start = m.start() + end
                yield m.start(), start, new
                break


def _card(m: re.Match, key: bytes) -> str | None:
    digits = re.sub(r"\D", "", m.group())
    if not 13 <= len(digits) <= 19 or not luhn(digits) or len(set(digits)) == 1:
        return None
    middle = "".join(map(str, _other([int(c) for c in digits[1:-1]], [10] * (len(digits) - 2), key, "card")))
    check = next(c for c in "0123456789" if luhn(digits[0] + middle + c))
    return _refill(m.group(), digits[0] + middle + check)


def _ip(m: re.Match, key: bytes) -> str | None:
    parts = m.group().split(".")
    if any(int(p) > 255 or p != str(int(p)) for p in parts):
        return None
    # Octets keep their number of digits: 0-9, 10-99, 100-255.
    lows, sizes = zip(*[{1: (0, 10), 2: (10, 90), 3: (100, 156)}[len(p)] for p in parts], strict=True)
    new = _other([int(p) - low for p, low in zip(parts, lows, strict=True)], list(sizes), key, "ip")
    return ".".join(str(d + low) for d, low in zip(new, lows, strict=True))


def _ssn(m: re.Match, key: bytes) -> str | None:
    area, group, serial = map(int, m.group().split("-"))
    if area in (0, 666) or area >= 900 or not group or not serial:
        return None
    # Areas 1-899 without 666 are 898 numbers.
    new = _other([area - 1 - (area > 666), group - 1, serial - 1], [898, 99, 9999], key, "ssn")
    area = new[0] + 1 + (new[0] >= 665)
    return f"{area:03d}-{new[1] + 1:02d}-{new[2] + 1:04d}"


def _date(m: re.Match, key: bytes) -> str | None:
    text = m.group()
    parts = re.split(r"([-/.])", text)
    numbers = [int(p) for p in parts[::2]]
    year_first = len(parts[0]) == 4
    orders = ["ymd"] if year_first else ["mdy", "dmy"] if parts[1] == "/" else ["dmy", "mdy"]
    for order in orders:
        try:
            day = date(*(numbers[order.index(c)] for c in "ymd"))
        except ValueError:
            continue
        if not FIRST_DAY <= day <= LAST_DAY:
            return None
        count = (LAST_DAY - FIRST_DAY).days + 1
        new = FIRST_DAY + timedelta(_other([(day - FIRST_DAY).days], [count], key, "date")[0])
        padded = not any(len(p) == 1 for p in parts[::2])
        out = {"y": f"{new.year:04d}"} | {c: f"{n:02d}" if padded else str(n) for c, n in (("m", new.month), ("d", new.day))}
        return parts[1].join(out[c] for c in order)
    return None


def _phone(m: re.Match, key: bytes) -> str | None:
    text = m.group()
    code = re.match(r"\+([0-9]{1,3})(?=[ .(-])|1(?=[ .-])", text)
    country = code and (code[1] or "1")
    digits = re.sub(r"\D", "", text[code.end() if code else 0 :])
    if len(digits) == 10 and (country == "1" or not code and text[0] != "+"):
        if digits[0] < "2" or digits[3] < "2":  # area and exchange begin with 2-9
            return None
        sizes = [8, 10, 10, 8, *[10] * 6]
        new = _other([int(c) - (8 == s) * 2 for c, s in zip(digits, sizes, strict=True)], sizes, key, "phone/1")
        out = "".join(str(d + (8 == s) * 2) for d, s in zip(new, sizes, strict=True))
    elif text[0] == "+" and 7 <= len(digits) <= 15:
        # Without a separated country code, two digits stay.
        keep = "" if code else digits[:2]
        rest = digits[len(keep) :]
        tweak = f"phone/{country or keep}"
        out = keep + "".join(map(str, _other([int(c) for c in rest], [10] * len(rest), key, tweak)))
    else:
        return None
    start = code.end() if code else 0
    return text[:start] + _refill(text[start:], out)


# All repeats are bounded but that of RUN, which scans one class, so a search takes time in proportion to the text.
EMAIL_BEFORE = re.compile(r"[A-Za-z0-9._%+-]{1,64}\Z")
EMAIL = re.compile(r"[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9-])")
SECRET_WORDS = ("password", "passwd", "secret", "token", "api_key", "api-key", "apikey")
SECRET = re.compile(
    r"(?i:\b(?:password|passwd|secret|token|api[_-]?key)\b[\"']?[ \t]{0,3}[=:][ \t]{0,3}[\"']?)(?P<value>[A-Za-z0-9+/_.-]{8,256})"
)
ACCESS_KEY = re.compile(r"(?<![A-Za-z0-9])(?:AKIA|ASIA)(?P<value>[A-Z0-9]{16})(?![A-Za-z0-9])")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
#: Characters of an account in each country of the registry.
IBAN_LENGTHS = {
    country: length
    for length, countries in {
        15: "NO", 16: "BE", 18: "DK FI FO GL NL", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
        25: "LY PT ST", 26: "IS TR", 27: "FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB PL SV",
        29: "BR EG PS QA UA", 30: "JO KW MU", 31: "MT SC", 32: "LC",
    }.items()
    for country in countries.split()
}
#: Whole stretches in which the kinds made of digits are looked for; none of these values leaves one.
RUN = re.compile(r"[+(]?[0-9](?:[0-9() .+/-]*[0-9])?")
DIGITS: dict[str, tuple[re.Pattern, Callable[[re.Match, bytes], str | None]]] = {
    "card": (
        re.compile(r"(?<![0-9A-Za-z])(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}|[0-9]{4}([ -])[0-9]{6}\2[0-9]{4,5})(?![0-9A-Za-z])"),
        _card,
    ),
    "ip": (re.compile(r"(?<![0-9A-Za-z.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?!\.?[0-9A-Za-z])"), _ip),
    "ssn": (re.compile(r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"), _ssn),
    "date": (
        re.compile(
            r"(?<![0-9A-Za-z/.-])(?:[0-9]{4}([-/.])[0-9]{1,2}\1[0-9]{1,2}|[0-9]{1,2}([-/.])[0-9]{1,2}\2[0-9]{4})"
            r"(?![0-9A-SU-Za-su-z/-]|[Tt](?![0-9]))"  # a time of day may follow
        ),
        _date,
    ),
    "phone": (
        re.compile(
            r"(?<![0-9A-Za-z+.(])(?:\+[0-9]{1,3}(?:[ .-]?\([0-9]{1,4}\)|[ .-][0-9]{1,4})(?:[ .-]?[0-9]{2,8}){1,4}"
            r"|(?:1[ .-])?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}|\+[0-9]{9,15})(?![0-9A-Za-z])"
        ),
        _phone,
    ),
}


def _found(text: str, key: bytes) -> Iterator[tuple[str, int, int, str]]:
    """Kind, place and pseudonym of every validated value, in order of the kinds."""
    at = text.find("@")
    while at >= 0:
        before = EMAIL_BEFORE.search(text[max(0, at - 64) : at])
        m = before and EMAIL.match(text, at - len(before.group()))
        if m and (new := _email(m, key)):
            yield "email", m.start(), m.end(), new
        at = text.find("@", at + 1)
    low = text.lower()
    searches = [(ACCESS_KEY, "AKIA" in text or "ASIA" in text), (SECRET, any(w in low for w in SECRET_WORDS))]
    for pattern, there in searches:
        for m in pattern.finditer(text) if there else ():
            if any(c.isdigit() for c in m.group("value")) or pattern is ACCESS_KEY:
                yield "secret", m.start(), m.end(), _secret(m, key)
    for start, end, new in _ibans(text, key):
        yield "iban", start, end, new
    runs = [m.span() for m in RUN.finditer(text) if m.end() - m.start() > 6]
    for kind, (pattern, change) in DIGITS.items():
        behind = 2 if kind == "date" else 1  # characters that its pattern looks at
        for start, end in runs:
            while m := pattern.search(text, start, min(end + behind, len(text))):
                new = change(m, key)
                if new:
                    yield kind, m.start(), m.end(), new
                start = m.end() if new else m.start() + 1


def pseudonymised(text: str, key: bytes) -> tuple[str, dict[str, int]]:
    """The text with pseudonyms, and how many values of each kind were replaced.

    Of overlapping values the one of the earlier kind in KINDS counts.
    """
    taken: list[tuple[int, int, str, str]] = []  # sorted, without overlaps
    for kind, start, end, new in _found(text, key):
        i = bisect(taken, (start, end, "", ""))
        if not (i and taken[i - 1][1] > start or i < len(taken) and taken[i][0] < end):
            taken.insert(i, (start, end, kind, new))
    counts = dict.fromkeys(KINDS, 0)
    parts, at = [], 0
    for start, end, kind, new in taken:
        parts += [text[at:start], new]
        counts[kind] += 1
        at = end
    return "".join([*parts, text[at:]]), counts


def pseudonymise(df: DataFrame, key: bytes, text: str = "text") -> DataFrame:
    """All rows and columns of ``df``, its text with pseudonyms, and n_<kind> of each of KINDS.

    Validated are e-mail addresses (local part replaced), access keys and assigned secrets, IBANs
    and card numbers by their check digits (new ones fit again), IPv4 addresses, social security
    numbers, dates from 1900 to 2099, and phone numbers. A null text stays null, an empty one
    empty; repeated rows stay; an empty table gives an empty result; columns named like a new one
    are replaced. ``key`` is the secret of the permutation.
    """
    made = [f"n_{k}" for k in KINDS]
    keep = kept_columns(df, made)
    source = df.select(*keep)
    at = keep.index(text)
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in source.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches, text):
            done = [pseudonymised(t, key) for t in texts]
            nulls = part.column(at).is_null().to_pylist()
            new = pa.array([None if n else t for n, (t, _) in zip(nulls, done, strict=True)], pa.string())
            columns = [new if i == at else part.column(i) for i in range(len(keep))]
            counts = [pa.array([c[k] for _, c in done], pa.int64()) for k in KINDS]
            yield pa.RecordBatch.from_arrays([*columns, *counts], names=[*keep, *made])

    return bounded_batches(source).mapInArrow(run, schema + ", ".join(f"{c} bigint" for c in made))
