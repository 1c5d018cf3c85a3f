"""Format-preserving pseudonyms for personal data.

Numbers and dates that pass the validation of their kind are permuted by a keyed Feistel network within the values of
their format: a card number stays a valid card number, a date stays a date. Equal values get equal pseudonyms in every
document, whatever their separators, and the key holder can reverse them. The one exception to equal pseudonyms: where
digits or capitals beside a card or IBAN would form another valid value with its pseudonym, the next one is taken.
"""

from __future__ import annotations

import datetime
import hashlib
import math
import re
from bisect import bisect, bisect_left, insort
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitefacts.llm.batches import text_chunks

ROUNDS = 10
YEARS = range(1900, 2100)
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")


def keyed(key: bytes, kind: str, turn: int, value: int, modulus: int) -> int:
    digest = hashlib.blake2b(b"%s:%d:%d" % (kind.encode(), turn, value), key=key, digest_size=32).digest()
    return int.from_bytes(digest, "big") % modulus


def sides(size: int) -> tuple[int, int]:
    """Two factors near the square root whose product covers ``range(size)``."""
    left = math.isqrt(size - 1) + 1
    return left, -(-size // left)


def permute(value: int, size: int, key: bytes, kind: str, back: bool = False) -> int:
    """A keyed permutation of ``range(size)``: alternating additions on two sides, repeated until within the range."""
    left, right = sides(size)
    while True:
        a, b = divmod(value, right)
        for turn in reversed(range(ROUNDS)) if back else range(ROUNDS):
            sign = -1 if back else 1
            if turn % 2:
                b = (b + sign * keyed(key, kind, turn, a, right)) % right
            else:
                a = (a + sign * keyed(key, kind, turn, b, left)) % left
        value = a * right + b
        if value < size:
            return value


def luhn_digit(payload: str) -> str:
    doubled = sum(sum(divmod(2 * int(d), 10)) for d in payload[::-2])
    return str(-(doubled + sum(map(int, payload[-2::-2]))) % 10)


def refill(text: str, digits: str) -> str:
    """``text`` with its digits replaced in order; separators stay."""
    source = iter(digits)
    return "".join(next(source) if c.isdigit() else c for c in text)


def only_digits(text: str) -> str:
    return "".join(c for c in text if c.isdigit())


def card(text: str, key: bytes, back: bool) -> str | None:
    digits = only_digits(text)
    if not 13 <= len(digits) <= 19 or len(set(digits)) == 1 or luhn_digit(digits[:-1]) != digits[-1]:
        return None
    size = len(digits) - 1
    payload = str(permute(int(digits[:-1]), 10**size, key, f"card{size}", back)).zfill(size)
    return refill(text, payload + luhn_digit(payload))


def ssn_place(digits: str) -> int | None:
    area, group, serial = int(digits[:3]), int(digits[3:5]), int(digits[5:])
    if area in (0, 666) or area >= 900 or not group or not serial:
        return None
    return ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1


def ssn(text: str, key: bytes, back: bool) -> str | None:
    place = ssn_place(only_digits(text))
    if place is None:
        return None
    rest, serial = divmod(permute(place, 898 * 99 * 9999, key, "ssn", back), 9999)
    area, group = divmod(rest, 99)
    area += 1
    return refill(text, f"{area + (area >= 666):03d}{group + 1:02d}{serial + 1:04d}")


def phone(text: str, key: bytes, back: bool) -> str | None:
    """A number of 10 digits with separators, or of 8 to 15 after a plus sign whose country code stays."""
    digits = only_digits(text)
    code = digits[: len(digits) - 10] if text.lstrip("(").startswith("+") and len(digits) > 10 else digits[:2] if text.startswith("+") else ""
    own = digits[len(code) :]
    if text.isdigit() or not 6 <= len(own) <= 12 or len(digits) > 15 or (not text.startswith("+") and len(digits) != 10):
        return None
    return refill(text, code + str(permute(int(own), 10 ** len(own), key, f"phone{len(own)}", back)).zfill(len(own)))


def address(text: str, key: bytes, back: bool) -> str | None:
    """An IPv4 address within those of the same written lengths, so its form stays."""
    octets = text.split(".")
    ranges = {1: (0, 10), 2: (10, 90), 3: (100, 156)}
    if any(int(o) > 255 or len(str(int(o))) != len(o) for o in octets):
        return None
    value, size = 0, 1
    for o in octets:
        low, count = ranges[len(o)]
        value, size = value * count + int(o) - low, size * count
    value, made = permute(value, size, key, "ip" + "".join(str(len(o)) for o in octets), back), []
    for o in reversed(octets):
        low, count = ranges[len(o)]
        value, place = divmod(value, count)
        made.append(str(low + place))
    return ".".join(reversed(made))


def iban_number(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text))


def iban(text: str, key: bytes, back: bool) -> str | None:
    """Country and letters stay, the digits of the account are permuted, the check digits follow."""
    compact = text.replace(" ", "").upper()
    if not 15 <= len(compact) <= 34 or iban_number(compact[4:] + compact[:4]) % 97 != 1:
        return None
    digits = only_digits(compact[4:])
    if len(digits) < 6:
        return None
    moved = str(permute(int(digits), 10 ** len(digits), key, f"iban{compact[:2]}{len(digits)}", back)).zfill(len(digits))
    account = refill(compact[4:], moved)
    check = 98 - iban_number(account + compact[:2] + "00") % 97
    source = iter(f"{check:02d}" + moved)
    return "".join(next(source) if c.isdigit() else c for c in text)


def date_class(month: int, day: int) -> tuple[bool, int]:
    """Dates of one class can be written in each other's place: with as many digits, and in the same order."""
    return month > 9, 2 if day > 12 else int(day > 9)


def days_by_class() -> dict[tuple[bool, int], list[datetime.date]]:
    found: dict[tuple[bool, int], list[datetime.date]] = {}
    for n in range(datetime.date(YEARS[0], 1, 1).toordinal(), datetime.date(YEARS[-1], 12, 31).toordinal() + 1):
        day = datetime.date.fromordinal(n)
        found.setdefault(date_class(day.month, day.day), []).append(day)
    return found


DAYS = days_by_class()


def moved_day(year: int, month: int, day: int, key: bytes, back: bool) -> datetime.date | None:
    """The pseudonym of a day, the same in all forms; none for what is no day or beyond ``YEARS``."""
    try:
        old = datetime.date(year, month, day)
    except ValueError:
        return None
    if year not in YEARS:
        return None
    beyond, part = date_class(month, day)
    days = DAYS[beyond, part]
    return days[permute(bisect(days, old) - 1, len(days), key, f"date{int(beyond)}{part}", back)]


def date(text: str, key: bytes, back: bool) -> str | None:
    """Year first, day first or month first in numbers (day first if both could be), or with an English month name."""
    words = re.split(r"([^\w]+)", text)
    fields = words[::2]
    if len(fields) != 3:
        return None
    named = next((i for i, f in enumerate(fields) if f.isalpha()), None)
    if named is not None:
        number = next((i for i, m in enumerate(MONTHS) if fields[named].lower() in (m, m[:3])), None)
        order = ((named, "m"), (1 - named, "d"), (2, "y"))
        if number is None or named > 1:
            return None
        values = {"m": number + 1, "d": int(fields[1 - named]), "y": int(fields[2])}
    elif len(fields[0]) == 4:
        order, values = ((0, "y"), (1, "m"), (2, "d")), dict(zip("ymd", map(int, fields)))
    else:
        a, b, year = map(int, fields)
        month_first = b > 12
        order = ((0, "m"), (1, "d"), (2, "y")) if month_first else ((0, "d"), (1, "m"), (2, "y"))
        values = {"y": year, "m": a if month_first else b, "d": b if month_first else a}
    new = moved_day(values["y"], values["m"], values["d"], key, back)
    if new is None:
        return None
    for i, part in order:
        if part == "m" and named is not None:
            name = MONTHS[new.month - 1]
            name = name if len(fields[named]) > 3 or fields[named].lower() == "may" else name[:3]
            fields[i] = name.upper() if fields[named].isupper() else name.capitalize() if fields[named][0].isupper() else name
        else:
            value = {"y": new.year, "m": new.month, "d": new.day}[part]
            fields[i] = str(value).zfill(len(fields[i]))
    words[::2] = fields
    return "".join(words)


LETTERS = "abcdefghijklmnopqrstuvwxyz"


def mailbox(text: str, key: bytes, back: bool) -> str | None:
    """The mailbox of an address: letters and digits are permuted together, each place within its class."""
    local, at, host = text.rpartition("@")
    classes = [26 if c.lower() in LETTERS else 10 if c.isdigit() else 0 for c in local]
    value, size = 0, 1
    for c, n in zip(local, classes):
        if n:
            value, size = value * n + (LETTERS.index(c.lower()) if n == 26 else int(c)), size * n
    if size < 2:
        return None
    shape = "".join("a" if n == 26 else "9" if n else c for c, n in zip(local, classes))
    value, made = permute(value, size, key, "mail" + shape, back), []
    for c, n in zip(reversed(local), reversed(classes)):
        if n:
            value, place = divmod(value, n)
            made.append(str(place) if n == 10 else LETTERS[place].upper() if c.isupper() else LETTERS[place])
        else:
            made.append(c)
    return "".join(reversed(made)) + at + host


# Kinds in the order in which they claim a place. Each pattern starts at a digit, a sign or a capital, to scan quickly.
KINDS: tuple[tuple[str, re.Pattern, Callable[[str, bytes, bool], str | None]], ...] = (
    ("email", re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"), mailbox),
    ("iban", re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])"), iban),
    ("card", re.compile(r"(?<![0-9A-Za-z])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z])"), card),
    ("ssn", re.compile(r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"), ssn),
    ("ip", re.compile(r"(?<![0-9A-Za-z.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9A-Za-z]|\.[0-9])"), address),
    ("date", re.compile(r"(?<![0-9A-Za-z/.-])(?:[0-9]{4}([-/.])[0-9]{1,2}\1[0-9]{1,2}|[0-9]{1,2}([-/.])[0-9]{1,2}\2[0-9]{4}|[0-9]{1,2} [A-Za-z]{3,9},? [0-9]{4}|[A-Z][A-Za-z]{2,8} [0-9]{1,2},? [0-9]{4})(?![0-9]|[-/.][0-9])"), date),
    ("phone", re.compile(r"(?<![0-9A-Za-z.+-])(?:\+[0-9]{1,3}[ .-]?)?\(?[0-9]{2,4}\)?(?:[ .-]?[0-9]{2,4}){2,4}(?![0-9A-Za-z]|[.-][0-9])"), phone),
)


def email_spans(text: str, pattern: re.Pattern) -> Iterator[re.Match]:
    """Addresses around each at sign; the pattern is tried from where its mailbox starts only."""
    at = text.find("@")
    while at >= 0:
        start = at
        while start and (text[start - 1].isascii() and text[start - 1].isalnum() or text[start - 1] in "._%+-"):
            start -= 1
        match = pattern.match(text, start) if start < at else None
        if match:
            yield match
        at = text.find("@", max(at + 1, match.end() if match else 0))


CARD_FORMS = {(4, 4, 4, 4), (4, 4, 4, 4, 3), (4, 6, 5), (4, 6, 4), *((n,) for n in range(13, 20))}  # digits of each group
IBAN_LENGTHS = {
    c: int(n)
    for n, codes in (
        line.split(":")
        for line in (
            "15:NO", "16:BE", "18:DK FI FK FO GL NL SD", "19:MK SI", "20:AT BA EE KZ LT LU MN XK", "21:CH CR HR LI LV",
            "22:BG BH DE GB GE IE ME RS VA", "23:AE GI IL IQ OM SO TL", "24:AD CZ ES MD PK RO SA SE SK TN VG", "25:LY PT ST",
            "26:IS TR", "27:BI DJ FR GR IT MC MR SM", "28:AL AZ BY CY DO GT HN HU LB NI PL SV", "29:BR EG PS QA UA",
            "30:JO KW MU YE", "31:MT SC", "32:LC", "33:RU",
        )
    )
    for c in codes.split()
}
SEPARATORS = {"card": " -", "iban": " ", "phone": " "}  # within a match, an extent may end before one
WIDEST = 80  # characters, more than any match of those kinds has


def extents(kind: str, pattern: re.Pattern, text: str) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Where values of a kind may be: the usual written forms, and all others; by start, the longest first.

    A match reaches as far as it can, so what stands beside a value may be in it: every end at a boundary of groups is
    tried, and every start. Of a telephone number within a match the groups of three, three and four digits are tried.
    """
    usual, other, at, reached = [], [], 0, 0
    while match := pattern.search(text, at):
        start, last = match.span()
        at = start + 1
        for end in (last, *(i for i in range(last - 1, start, -1) if text[i] in SEPARATORS.get(kind, ""))):
            part = text[start:end]
            form = tuple(len(g) for g in re.findall("[0-9]+", part))
            if kind == "card":
                if sum(form) >= 13:
                    (usual if form in CARD_FORMS else other).append((start, end))
            elif kind == "iban":
                length = IBAN_LENGTHS.get(part[:2])
                if length == len(part.replace(" ", "")):
                    usual.append((start, end))
                elif length is None or end == last:
                    other.append((start, end))
            elif end == last and start >= reached:
                usual.append((start, end))
            elif kind == "phone" and form == (3, 3, 4):
                other.append((start, end))
        reached = last if start >= reached else reached
    return usual, other


def claim(kind: str, spans, transform: Callable[[str, bytes, bool], str | None], text: str, key: bytes, back: bool, taken: list) -> None:
    """Add the valid ones of ``spans`` to ``taken``, where nothing has their place yet.

    A pseudonym must not make an extent valid that was refused before it, or it would be read differently on the way
    back: it is permuted again until all of those are refused with it too.
    """
    refused: list[list[tuple[int, int]]] = []
    for step in spans:
        refused.append([])
        for start, end in step:
            at = bisect(taken, (start, end))
            if (at and taken[at - 1][1] > start) or (at < len(taken) and taken[at][0] < end):
                continue  # an earlier kind or extent has it
            new = transform(text[start:end], key, back)
            if new is None:
                refused[-1].append((start, end))
                continue
            if kind in ("card", "iban"):
                near = [r for part in refused for r in part[bisect_left(part, (start - WIDEST,)) : bisect_left(part, (end,))] if r[1] > start]
                while any(transform(text[s:start] + new[max(s - start, 0) : max(e - start, 0)] + text[end:e], key, back) is not None for s, e in near):
                    new = transform(new, key, back)
            insort(taken, (start, end, kind, new))


def replace_all(text: str, key: bytes, back: bool = False) -> tuple[str, list[tuple[int, int, str]]]:
    """The text with pseudonyms, and the spans replaced: start, end in code points of the given text, kind."""
    taken: list[tuple[int, int, str, str]] = []
    for kind, pattern, transform in KINDS:
        spans = [[m.span() for m in email_spans(text, pattern)]] if kind == "email" else extents(kind, pattern, text)
        claim(kind, spans, transform, text, key, back, taken)
    out, at = [], 0
    for start, end, _, new in taken:
        out += [text[at:start], new]
        at = end
    return "".join(out) + text[at:], [(s, e, k) for s, e, k, _ in taken]


def pseudonymise(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text", back: bool = False) -> DataFrame:
    """``id_col``, the text with pseudonyms in ``text_col``, and ``found``: an array of ``(kind, start, stop)``.

    Spans are code points of the given text. ``back`` restores the originals of a text made with the same key. A null
    text stays null and an empty one empty, both without spans; null and repeated ids pass; other columns are left
    out. ``key`` must not be empty. Texts are handled whole in their own rows: no shuffle, no shared state.
    """
    if not key:
        raise ValueError("a key is needed")
    secret = hashlib.blake2b(key.encode(), digest_size=32).digest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())])
        for batch in text_chunks(batches):
            texts, spans = [], []
            for text in batch.column("text").to_pylist():
                new, found = replace_all(text, secret, back)
                texts.append(new)
                spans.append([{"kind": k, "start": s, "stop": e} for s, e, k in found])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("absent"), pa.array(texts, pa.string()), pa.array(spans, pa.list_(span))],
                names=["id", "absent", "text", "found"],
            )

    id_type = docs.schema[id_col].dataType.simpleString()
    text = F.col(text_col).cast("string")
    made = docs.select(F.col(id_col).alias("id"), text.isNull().alias("absent"), text.alias("text")).mapInArrow(
        run, f"id {id_type}, absent boolean, text string, found array<struct<kind: string, start: bigint, stop: bigint>>"
    )
    return made.select(F.col("id").alias(id_col), F.when(~F.col("absent"), F.col("text")).alias(text_col), "found")
