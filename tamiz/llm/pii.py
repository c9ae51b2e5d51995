"""Format-preserving pseudonyms for personal data.

Found values are validated (check digits, calendar, ranges), written as a number within the set of all valid values
of their format, and moved within that set by a keyed permutation: a Feistel network over the next power of four,
repeated until it falls into the set. So an equal value gets an equal pseudonym in every document, no two values get
the same, the result is valid in the same format and length, and the key turns it back.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from datetime import date
from functools import lru_cache
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamiz.functions.columns import quoted
from tamiz.llm.common import append, unused

ROUNDS = 8
FIRST_DAY, DAYS = date(1900, 1, 1).toordinal(), date(2100, 1, 1).toordinal() - date(1900, 1, 1).toordinal()
DIGITS, UPPER, LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def permute(value: int, size: int, key: bytes, tweak: str, back: bool = False) -> int:
    """A keyed permutation of range(size); ``back`` is its inverse."""
    if size < 2:
        return value
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    mask, width = (1 << half) - 1, (half + 7) // 8
    person = blake2b(tweak.encode(), digest_size=16).digest()

    def mix(r: int, x: int) -> int:
        data = bytes([r]) + x.to_bytes(width, "big")
        return int.from_bytes(blake2b(data, key=key, person=person, digest_size=64).digest(), "big") & mask

    while True:
        left, right = value >> half, value & mask
        if back:
            for r in reversed(range(ROUNDS)):
                left, right = right ^ mix(r, left), left
        else:
            for r in range(ROUNDS):
                left, right = right, left ^ mix(r, right)
        value = left << half | right
        if value < size:
            return value


def move(places: Sequence[tuple[int, int]], key: bytes, tweak: str, back: bool) -> list[int]:
    """New digits for (digit, radix) places, permuted as one number of mixed radix."""
    value, size = 0, 1
    for digit, radix in places:
        value, size = value * radix + digit, size * radix
    value = permute(value, size, key, tweak, back)
    out = []
    for _, radix in reversed(places):
        value, digit = divmod(value, radix)
        out.append(digit)
    return out[::-1]


def move_characters(text: str, key: bytes, kind: str, back: bool, alphabets: Sequence[str]) -> str:
    """Characters of the alphabets change within their own; others stay. The format is part of the key."""
    places, form = [], []
    for c in text:
        alphabet = next((a for a in alphabets if c in a), None)
        form.append(c if alphabet is None else alphabet)
        if alphabet is not None:
            places.append((alphabet.index(c), len(alphabet)))
    tweak = kind + "|" + "|".join(f if len(f) == 1 else str(alphabets.index(f)) for f in form)
    new = iter(move(places, key, tweak, back))
    return "".join(f if len(f) == 1 else f[next(new)] for f in form)


def refill(text: str, digits: str) -> str:
    """``text`` with its letters and digits replaced in order, separators kept."""
    new = iter(digits)
    return "".join(next(new) if c.isalnum() else c for c in text)


def plain(text: str) -> str:
    return "".join(c for c in text if c.isalnum())


def luhn(digits: str) -> int:
    """The check digit that belongs behind ``digits``."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 - i % 2)
        total += d - 9 * (d > 9)
    return -total % 10


def card(text: str, key: bytes, back: bool) -> str | None:
    """The first digit (the network) stays; the check digit is computed anew."""
    digits = plain(text)
    if not 13 <= len(digits) <= 19 or luhn(digits[:-1]) != int(digits[-1]) or len(set(digits)) == 1:
        return None
    body = digits[0] + "".join(
        map(str, move([(int(c), 10) for c in digits[1:-1]], key, f"card|{len(digits)}|{digits[0]}", back))
    )
    return refill(text, body + str(luhn(body)))


def iban_check(country: str, body: str) -> str:
    number = "".join(str(int(c, 36)) for c in body + country + "00")
    return f"{98 - int(number) % 97:02d}"


def iban(text: str, key: bytes, back: bool) -> str | None:
    value = plain(text)
    if not 15 <= len(value) <= 34 or iban_check(value[:2], value[4:]) != value[2:4]:
        return None
    body = move_characters(value[4:], key, "iban|" + value[:2], back, (DIGITS, UPPER))
    return refill(text, value[:2] + iban_check(value[:2], body) + body)


def ipv4(text: str, key: bytes, back: bool) -> str | None:
    """Each part keeps its number of digits."""
    places, form = [], ""
    for part in text.split("."):
        if int(part) > 255 or (len(part) > 1 and part[0] == "0"):
            return None
        low, radix = ((0, 10), (10, 90), (100, 156))[len(part) - 1]
        places.append((int(part) - low, radix))
        form += str(len(part))
    new = move(places, key, "ipv4|" + form, back)
    return ".".join(str(d + (0, 10, 100)[int(f) - 1]) for d, f in zip(new, form, strict=True))


def phone(text: str, key: bytes, back: bool) -> str | None:
    """The country code stays; a digit that begins a group stays on its side of 2, as number plans want."""
    head = re.match(r"\+\d{1,3}(?=\D)|", text).group()
    rest = text[len(head) :]
    if not 7 <= len(plain(rest)) <= 14 or len(plain(text)) > 15:
        return None
    places, form, lows = [], [], []
    for i, c in enumerate(rest):
        if c.isdigit():
            low, radix = (0, 10) if i and rest[i - 1].isdigit() else (2, 8) if c >= "2" else (0, 2)
            places.append((int(c) - low, radix))
            lows.append(low)
            form.append(str(radix))
        else:
            form.append(" ")
    new = move(places, key, f"phone|{head}|{','.join(f for f in form if f != ' ')}", back)
    return head + refill(rest, "".join(str(d + low) for d, low in zip(new, lows, strict=True)))


def ssn(text: str, key: bytes, back: bool) -> str | None:
    area, group, serial = map(int, text.split("-"))
    if not 1 <= area <= 899 or area == 666 or not group or not serial:
        return None
    new = move([(area - 1 - (area > 666), 898), (group - 1, 99), (serial - 1, 9999)], key, "ssn", back)
    a, g, s = new[0] + 1, new[1] + 1, new[2] + 1
    return f"{a + (a >= 666):03d}-{g:02d}-{s:04d}"


@lru_cache(maxsize=2)
def late_days(first: int) -> tuple[list[int], dict[int, int]]:
    """The days of the range whose day of month is ``first`` or later, and their ranks."""
    days = [n for n in range(FIRST_DAY, FIRST_DAY + DAYS) if date.fromordinal(n).day >= first]
    return days, {n: i for i, n in enumerate(days)}


def _day(y: str, m: str, d: str) -> int | None:
    try:
        n = date(int(y), int(m), int(d)).toordinal()
    except ValueError:
        return None
    return n if FIRST_DAY <= n < FIRST_DAY + DAYS else None


def calendar_date(text: str, key: bytes, back: bool) -> str | None:
    """Dates of 1900 to 2099 move within all of them. With slashes the month is first unless that is no date; then
    the day is, and it stays above 12 so that the reading stays."""
    a, sep, b, _, c = re.split(r"(\D)", text)
    if len(a) == 4:
        n, form = _day(a, b, c), f"{{0:%Y{sep}%m{sep}%d}}"
    elif sep == "/" and (n := _day(c, a, b)) is not None:
        form = "{0:%m/%d/%Y}"
    else:
        n, form = _day(c, b, a), f"{{0:%d{sep}%m{sep}%Y}}"
    if n is None:
        return None
    first = 13 if form == "{0:%d/%m/%Y}" else 1
    days, rank = late_days(first)
    if n not in rank:
        return None
    return form.format(date.fromordinal(days[permute(rank[n], len(days), key, "date|" + form, back)]))


def email(text: str, key: bytes, back: bool) -> str | None:
    name, _, host = text.rpartition("@")
    return move_characters(name, key, "email|" + host.lower(), back, (DIGITS, UPPER, LOWER)) + "@" + host


HEX_LOWER, HEX_UPPER = DIGITS + "abcdef", DIGITS + "ABCDEF"


def secret(text: str, key: bytes, back: bool) -> str | None:
    """The name before a value stays, and so does the mark of an access key."""
    head = re.match(r"AKIA|ASIA|.*?[=:]\s*[\"']?", text, re.S).group()
    value = text[len(head) :]
    if not any(c.isdigit() for c in value):
        return None
    form = _form(head, value)
    alphabets = {"hex": (HEX_LOWER,), "mark": (DIGITS + UPPER,), "text": (DIGITS, UPPER, LOWER)}[form]
    moved = value
    while True:
        moved = move_characters(moved, key, f"secret|{len(alphabets)}", back, alphabets)
        # Another form would not be found again: walk on along the permutation, which comes back to one of this form.
        if any(c.isdigit() for c in moved) and _form(head, moved) == form:
            return head + moved


def _form(head: str, value: str) -> str:
    if all(c in HEX_LOWER for c in value):
        return "hex"
    return "mark" if head in ("AKIA", "ASIA") else "text"


KINDS: dict[str, tuple[str, Callable[[str, bytes, bool], str | None]]] = {
    "email": (r"(?<![\w.%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![\w])", email),
    "secret": (
        r"(?<!\w)(?:AKIA|ASIA)[A-Z0-9]{16}(?!\w)"
        r"|(?<!\w)(?:password|passwd|pwd|secret|token|api[_-]?key)\s{0,3}[=:]\s{0,3}[\"']?[A-Za-z0-9_+/-]{8,128}(?![\w+/-])",
        secret,
    ),
    "iban": (r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]){11,30}(?!\w)", iban),
    "date": (r"(?<![\w./-])(?:\d{4}([./-])\d\d\1\d\d|\d\d([./-])\d\d\2\d{4})(?!T\D|[^\WT]|[/-]|\.\d)", calendar_date),
    "ssn": (r"(?<![\w-])\d{3}-\d\d-\d{4}(?![\w-])", ssn),
    "ipv4": (r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w]|\.\d)", ipv4),
    "phone": (
        r"(?<![\w+])\+\d{1,3}[ .-]?\(?\d{1,4}\)?(?:[ .-]?\d{2,4}){2,4}(?![\w-])"
        r"|(?<![\w(])\(\d{3}\) ?\d{3}[ .-]\d{4}(?![\w-])|(?<![\w.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\w-])",
        phone,
    ),
    "card": (r"(?<![\w.-])\d(?:[ -]?\d){12,18}(?![\w-])", card),
}
# Whatever holds personal data holds a digit or an at sign.
MAYBE = re.compile(r"[0-9@]")
PATTERNS = [(kind, re.compile(pattern, re.I if kind == "secret" else 0), change) for kind, (pattern, change) in KINDS.items()]


def replace_personal(text: str, key: bytes, back: bool = False) -> tuple[str, list[tuple[int, int, str]]]:
    """The text with pseudonyms, and (start, end, kind) of each. Earlier kinds of the list win where two overlap."""
    if not MAYBE.search(text):
        return text, []
    spans: list[tuple[int, int, str, str]] = []  # in order, none overlaps another
    for kind, pattern, change in PATTERNS:
        found, at = [], 0
        for m in pattern.finditer(text):
            # Matches come in order, so those of earlier kinds are passed once.
            while at < len(spans) and spans[at][1] <= m.start():
                at += 1
            if at < len(spans) and spans[at][0] < m.end():
                continue
            new = change(m.group(), key, back)
            if new is not None:
                found.append((m.start(), m.end(), kind, new))
        if found:
            spans = sorted(spans + found)
    out, at = [], 0
    for start, end, _, new in spans:
        out += [text[at:start], new]
        at = end
    return "".join([*out, text[at:]]), [s[:3] for s in spans]


RESULT = "struct<text:string,spans:array<struct<start:int,end:int,kind:string>>>"


def _annotated(docs: DataFrame, text: str, key: bytes, back: bool) -> tuple[DataFrame, str]:
    name = unused(docs.columns, "pii")

    def make():
        def step(texts: pa.Array) -> list:
            return [(None, []) if t is None else replace_personal(t, key, back) for t in texts.to_pylist()]

        return step

    return append(docs, [text], make, RESULT, name), name


def pseudonymise(docs: DataFrame, key: bytes, text: str = "text", back: bool = False) -> DataFrame:
    """``docs``, all columns and rows, with pseudonyms in ``text``; ``back`` undoes it under the same key.

    Covered: payment cards (Luhn), IBANs (mod 97), numeric dates (calendar), social security numbers, IPv4
    addresses, phone numbers, e-mail addresses and named secrets. What fails its validation stays. NULL stays NULL, empty
    stays empty; texts without such values come out unchanged; lengths in characters never change.
    """
    df, pii = _annotated(docs, text, key, back)
    return df.withColumn(text, F.col(f"`{pii}`.text")).drop(pii)


def pseudonymised_spans(docs: DataFrame, key: bytes, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, the text with pseudonyms and the spans (start, end, kind) of them."""
    df, pii = _annotated(docs.select(quoted(id_column), quoted(text)), text, key, False)
    return df.select(quoted(id_column), f"`{pii}`.*")

