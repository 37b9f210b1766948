"""Format-preserving pseudonyms for personal numbers, dates and addresses.

A value is found by its form and kept only if it is valid (check digits, calendar, ranges). It becomes a number below
the count of valid values of its format, is permuted by a Feistel network with a secret key, walking on until the
result is in range again, and is written in the same form. The permutation depends on key and kind only, so equal
values have equal pseudonyms in all documents and distinct values distinct ones. With the key it can be undone, but for
the order of day and month in dates that allow both.

Kinds: card numbers (Luhn), telephone numbers (with a country code that exists, or in a form of ten digits), IPv4 addresses, dates from 1900 to 2099, US social security numbers,
IBANs (mod 97) and the local parts of e-mail addresses. Numbers that are not valid stay as they are, and so do ten
digits without any sign between them, which nothing tells from other numbers.
"""

from __future__ import annotations

import bisect
import datetime
import functools
import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROUNDS = 10
KINDS = ("card", "phone", "ip", "date", "ssn", "iban", "email")
FIRST_DAY, DAYS = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal() - datetime.date(1900, 1, 1).toordinal() + 1


class Permutation:
    """Keyed permutations of ranges of numbers."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def step(self, x: int, kind: bytes, half: int, backwards: bool) -> int:
        mask = (1 << half) - 1
        left, right = x >> half, x & mask
        for r in reversed(range(ROUNDS)) if backwards else range(ROUNDS):
            source = left if backwards else right
            h = hashlib.blake2b(kind + b"%d|%d|" % (half, r) + source.to_bytes((half + 7) // 8, "big"), key=self.key, digest_size=(half + 7) // 8 + 8)
            f = int.from_bytes(h.digest(), "big") & mask
            left, right = (right ^ f, left) if backwards else (right, left ^ f)
        return left << half | right

    def of(self, x: int, n: int, kind: str, backwards: bool = False) -> int:
        """Where x goes among 0..n-1."""
        half = max(1, ((n - 1).bit_length() + 1) // 2)
        tweak = f"{kind}|{n}|".encode()
        while True:
            x = self.step(x, tweak, half, backwards)
            if x < n:
                return x


def luhn_digit(digits: str) -> int:
    """The check digit that makes ``digits`` and it valid."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 - i % 2)
        total += d - 9 if d > 9 else d
    return -total % 10


def refill(form: str, digits: str) -> str:
    """``form`` with its digits replaced in order."""
    new = iter(digits)
    return "".join(next(new) if c.isdigit() else c for c in form)


def card(form: str, move: Callable[[int, int, str], int]) -> str | None:
    digits = re.sub("[^0-9]", "", form)
    if len(set(digits)) == 1 or luhn_digit(digits[:-1]) != int(digits[-1]):
        return None
    n = len(digits) - 1
    body = f"{move(int(digits[:-1]), 10**n, 'card'):0{n}d}"
    return refill(form, f"{body}{luhn_digit(body)}")


# Calling codes of one and of two digits; all others have three.
ONE_DIGIT = "1 7".split()
TWO_DIGITS = "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split()


def country_code(digits: str) -> str | None:
    """The calling code that ``digits`` begin with."""
    if digits[:1] in ONE_DIGIT:
        return digits[:1]
    return None if digits[:1] == "0" else digits[:2] if digits[:2] in TWO_DIGITS else digits[:3]


def phone(form: str, move: Callable[[int, int, str], int]) -> str | None:
    """The digits behind the country code are permuted, and a leading 0 or 1 stays; without a code it is that of ten-digit numbers, 1."""
    digits = re.sub("[^0-9]", "", form)
    code = country_code(digits) if form[0] == "+" else ""
    if code is None:
        return None
    own = digits[len(code) :]
    if not 6 <= len(own) <= 15 - len(code) or len(own) != 10 and code in ("", "1"):
        return None
    n = 10 ** (len(own) - 1)
    least, span = (int(own[0]) * n, n) if own[0] in "01" else (2 * n, 8 * n)
    moved = least + move(int(own) - least, span, f"phone{code or 1}")
    return refill(form, f"{code}{moved:0{len(own)}d}")


def ip(form: str, move: Callable[[int, int, str], int]) -> str | None:
    octets = form.split(".")
    if any(int(o) > 255 or o != str(int(o)) for o in octets):
        return None
    x = move(int.from_bytes(bytes(map(int, octets)), "big"), 1 << 32, "ip")
    return ".".join(map(str, x.to_bytes(4, "big")))


@functools.cache
def days_by_form() -> dict[tuple[bool, bool], list[int]]:
    """The days from FIRST_DAY on, by whether their month and day have two digits without padding."""
    out: dict[tuple[bool, bool], list[int]] = {(m, d): [] for m in (False, True) for d in (False, True)}
    for i in range(DAYS):
        day = datetime.date.fromordinal(FIRST_DAY + i)
        out[day.month > 9, day.day > 9].append(i)
    return out


def date(form: str, move: Callable[[int, int, str], int]) -> str | None:
    """Year first, or day and month (in this order if that is a date) and year.

    The day goes to another with as many digits in month and day, so it has the same form, padded or not, and the same
    pseudonym in every form.
    """
    gap = next(c for c in form if not c.isdigit())
    parts = form.split(gap)
    orders = ((0, 1, 2),) if len(parts[0]) == 4 else ((2, 1, 0), (2, 0, 1))
    for y, m, d in orders:
        try:
            old = datetime.date(int(parts[y]), int(parts[m]), int(parts[d]))
        except ValueError:
            continue
        if not 0 <= old.toordinal() - FIRST_DAY < DAYS:
            continue
        kind = old.month > 9, old.day > 9
        alike = days_by_form()[kind]
        new = datetime.date.fromordinal(FIRST_DAY + alike[move(bisect.bisect_left(alike, old.toordinal() - FIRST_DAY), len(alike), f"date{kind}")])
        out = [""] * 3
        for i, value in ((y, new.year), (m, new.month), (d, new.day)):
            out[i] = f"{value:0{len(parts[i])}d}"
        return gap.join(out)
    return None


def ssn(form: str, move: Callable[[int, int, str], int]) -> str | None:
    area, group, serial = map(int, form.split("-"))
    if area in (0, 666) or area >= 900 or not group or not serial:
        return None
    area -= 1 + (area > 666)
    x = move((area * 99 + group - 1) * 9999 + serial - 1, 898 * 99 * 9999, "ssn")
    x, serial = divmod(x, 9999)
    area, group = divmod(x, 99)
    area += 1
    return f"{area + (area >= 666):03d}-{group + 1:02d}-{serial + 1:04d}"


def mixed(text: str, move: Callable[[int, int, str], int], kind: str) -> str:
    """Digits, capital and small letters are permuted within their class, together; other characters stay."""
    classes = [(ord("0"), 10) if c in "0123456789" else (ord("A"), 26) if "A" <= c <= "Z" else (ord("a"), 26) if "a" <= c <= "z" else None for c in text]
    x, n = 0, 1
    for c, of in zip(text, classes, strict=True):
        if of:
            x, n = x * of[1] + ord(c) - of[0], n * of[1]
    if n == 1:
        return text
    x = move(x, n, f"{kind}|{''.join('-' if not of else chr(of[0]) for of in classes)}")
    out = list(text)
    for i in reversed(range(len(text))):
        if classes[i]:
            x, d = divmod(x, classes[i][1])
            out[i] = chr(classes[i][0] + d)
    return "".join(out)


# The lengths of account numbers by country.
IBAN_LENGTHS = dict((x[:2], int(x[2:])) for x in (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DK18 DO28 EE20 EG29 ES24 FI18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 "
    "LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19 MR27 MT31 MU30 NL18 NO15 PK24 PL28 PS29 PT25 QA29 RO24 RS22 SA24 SC31 SD18 SE24 SI19 SK24 SM27 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20"
).split())


def iban_end(m: re.Match) -> int:
    """Where the number ends that ``m`` found: after as many characters as its country's numbers have, without what follows them."""
    left = IBAN_LENGTHS.get(m[0][:2], len(m[0]))
    for at, c in enumerate(m[0]):
        left -= c != " "
        if not left:
            return m.start() + at + 1
    return m.end()


def iban(form: str, move: Callable[[int, int, str], int]) -> str | None:
    plain = form.replace(" ", "")
    number = lambda s: int("".join(str(int(c, 36)) for c in s))
    if not 15 <= len(plain) <= 34 or number(plain[4:] + plain[:4]) % 97 != 1:
        return None
    account = mixed(plain[4:], move, "iban" + plain[:2])
    new = iter(f"{plain[:2]}{98 - number(account + plain[:2] + '00') % 97:02d}{account}")
    return "".join(c if c == " " else next(new) for c in form)


def email(form: str, move: Callable[[int, int, str], int]) -> str | None:
    local, _, domain = form.partition("@")
    return f"{mixed(local, move, 'email')}@{domain}"


FIND = (
    (("email",), "@", re.compile(r"[A-Za-z0-9](?:[A-Za-z0-9._%+-]{0,62}[A-Za-z0-9_%+-])?@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,8}")),
    (("iban",), None, re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?")),
    (("phone",), "+", re.compile(r"\+(?:[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}|[0-9]{1,3}[ .-]?[0-9](?:[ .-][0-9]{2}){4}|[0-9]{1,3}[ .-]?\(?[0-9]{1,5}\)?[ .-]?[0-9]{4,10}|[0-9]{8,15})(?![0-9])")),
    (("phone",), "(", re.compile(r"\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}")),
    (
        ("date", "ip", "date", "ssn", "phone", "card", "card", "card"),
        None,
        re.compile(r"([0-9]{4}([-/.])[0-9]{1,2}\2[0-9]{1,2})|([0-9]{1,3}(?:\.[0-9]{1,3}){3})|([0-9]{1,2}([-/.])[0-9]{1,2}\5[0-9]{4})|([0-9]{3}-[0-9]{2}-[0-9]{4})|((?:[0-9]{3}(?=[-.])|[2-9][0-9]{2}(?= ))([-. ])[0-9]{3}\8[0-9]{4})|([0-9]{4}([ -])[0-9]{4}\10[0-9]{4}\10[0-9]{4})|([0-9]{4}([ -])[0-9]{6}\12[0-9]{5})|([0-9]{13,19})"),
    ),
)
#: The group of the last pattern that each of its kinds is in.
GROUPS = (1, 3, 4, 6, 7, 9, 11, 13)
RULES = {"card": card, "phone": phone, "ip": ip, "date": date, "ssn": ssn, "iban": iban, "email": email}
DIGIT = re.compile("[0-9]")
DIGITS = re.compile("[0-9]+")
TOKEN = re.compile(r"[A-Za-z0-9_]")
CLOCK = re.compile(r"T[0-9]{2}:?[0-9]{2}")


def alone(text: str, start: int, end: int) -> bool:
    """Whether text[start:end] is not a part of a longer word or number; signs join numbers, not a word and a number."""
    if start and (TOKEN.match(text[start - 1]) or text[start - 1] == "@" or text[start - 1] in ".-+/" and start > 1 and text[start - 2].isdigit()):
        return False
    return not (end < len(text) and (TOKEN.match(text[end]) or text[end] in ".-/@" and end + 1 < len(text) and text[end + 1].isdigit()))


def pseudonymised(text: str, move: Callable[[int, int, str], int]) -> tuple[str, dict[str, int]]:
    """``text`` with its valid values replaced, and their numbers by kind."""
    found: list[tuple[int, int, str, str]] = []
    has_digit = DIGIT.search(text) is not None
    for kinds, must, pattern in FIND:
        if must not in text if must else not has_digit:
            continue
        at = 0
        while m := pattern.search(text, at):
            at = m.end()
            kind = kinds[0] if len(kinds) == 1 else kinds[GROUPS.index(next(g for g in GROUPS if m[g] is not None))]
            end = iban_end(m) if kind == "iban" else m.end()
            whole = alone(text, m.start(), len(text) if kind == "date" and CLOCK.match(text, end) else end)
            new = RULES[kind](text[m.start() : end], move) if whole else None
            if new is None:
                # Another value may begin behind the first number of this one.
                number = DIGITS.search(text, m.start(), m.end())
                at = number.end() if number else m.end()
            else:
                found.append((m.start(), end, kind, new))
                at = end
    counts = dict.fromkeys(KINDS, 0)
    out, done = [], 0
    for start, end, kind, new in sorted(found):
        if start >= done:
            out += [text[done:start], new]
            done = end
            counts[kind] += 1
    return "".join([*out, text[done:]]) if out else text, counts


def pseudonymise(docs: DataFrame, key: bytes) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, text with pseudonyms, and the number of values of each kind (n_card, ...).

    Edge cases: a null text stays null and an empty one empty, without values; texts without valid values are
    unchanged; repeated rows get equal results; a null doc_id stays null; an empty table gives no rows; other columns are ignored.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        move = Permutation(key).of
        for batch in batches:
            out = [pseudonymised(t, move) if t else (t, dict.fromkeys(KINDS, 0)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([t for t, _ in out], pa.string()), *(pa.array([c[k] for _, c in out], pa.int64()) for k in KINDS)], ["doc_id", "text", *(f"n_{k}" for k in KINDS)])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(read, "doc_id long, text string, " + ", ".join(f"n_{k} long" for k in KINDS))
