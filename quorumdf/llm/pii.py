"""Personal data: format-preserving Feistel pseudonyms.

Method.  Candidates are found by patterns and validated (check digits, real
dates, octets, allowed ranges).  The value's place among all values of its
format is permuted by a keyed Feistel network with cycle walking, and the
permuted value is written in the same format, valid again: equal values get
equal pseudonyms in every document, whatever their separators, and the key's
holder can turn them back.

    card    all digits but the first and the check digit, which is made anew
    iban    the account part by character class, check digits made anew
    ssn     the index among allowed numbers
    phone   the digits after the country code, which the digits alone tell; a
            number of ten digits without one counts as one of country code 1
    date    the day among those of 1900..2099
    ip      all 32 bits
    email   letters and digits of the local part, by class
    secret  letters and digits of a quoted credential, by class

Defined results: null text stays null, with nothing found; an empty text stays
empty; of overlapping candidates the one that starts first stays, then the
longer, then the kind listed first; rows that repeat an id are treated each; an
empty table gives none.  Whole texts are read, very long ones too; other columns
are kept.  A column that has the name of an output gives way to it, so name the
outputs otherwise to keep both.

The key is the caller's; the query reads it from ``spark.quorumdf.pii.key``.  A
date's pseudonym links dates of one form of writing.
"""

from __future__ import annotations

import datetime
import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .common import table

KEY_SETTING = "spark.quorumdf.pii.key"
#: What the query takes where no key is set, as on test data.  It is public, so it hides nothing.
TEST_KEY = b"test tables only"
ROUNDS = 8
#: Country codes of one and of two digits; all others have three.
ONE_DIGIT_CODES = "1 7".split()
TWO_DIGIT_CODES = "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split()
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_TRIGGER = re.compile(r"[0-9@]|[\"']\s*[:=]|[:=]\s*[\"']")
PATTERNS = [
    ("email", re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]{1,63}\.)+[A-Za-z]{2,24}(?![A-Za-z0-9-])")),
    ("secret", re.compile(r"(?i)(?<![a-z0-9])(?:token|secret|passw(?:or)?d|api[ _-]?key|access[ _-]?key|key)\b[\"']?\s{0,4}[:=]\s{0,4}[\"']([A-Za-z0-9_\-+/=.]{8,})[\"']")),
    ("iban", re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")),
    ("card", re.compile(r"(?<![\d.])(?:\d{4}([ -])\d{4}\1\d{4}\1\d{1,7}|\d{4}[ -]\d{6}[ -]\d{5}|\d{13,19})(?!\d|\.\d)")),
    ("ip", re.compile(rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\d|\.\d)")),
    ("ssn", re.compile(r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])")),
    ("phone", re.compile(r"(?<![\w+])(?:\+\d{1,3}[ .-]?\(\d{1,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}|\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{1,4}(?:[ .-]?\d{2,4}){1,5}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?![\d-])")),
    ("date", re.compile(r"(?<![\d./-])(?:\d{4}-\d{2}-\d{2}|\d{1,2}([/.])\d{1,2}\1\d{4})(?![\d/-]|\.\d)")),
]
#: Characters of an IBAN by country; one of another country or length ends where its check digits hold.
IBAN_LENGTHS = {
    country: length
    for length, countries in {
        15: "NO", 16: "BE", 18: "DK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
        23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
        28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}
_RANK = {kind: i for i, (kind, _) in enumerate(PATTERNS)}
_FIRST_DAY = datetime.date(1900, 1, 1).toordinal()
_DAYS = datetime.date(2100, 1, 1).toordinal() - _FIRST_DAY


class Permutation:
    """Keyed permutations of 0..n-1 for any n."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _round(self, r: int, half: int, size: int, tweak: bytes) -> int:
        body = bytes([r]) + tweak + b"|" + half.to_bytes(size, "big")
        out, block = b"", 0
        while len(out) < size:
            mark = bytes([block]) if block < 256 else b"\xff" + block.to_bytes(4, "big")
            out += hashlib.blake2b(mark + body, key=self.key, digest_size=min(64, max(8, size))).digest()
            block += 1
        return int.from_bytes(out[:size], "big")

    def apply(self, value: int, n: int, tweak: str, back: bool = False) -> int:
        """Walk the cycle of a balanced Feistel network until inside the range again."""
        if n < 2:
            return value
        width = ((n - 1).bit_length() + 1) // 2
        mask, size = (1 << width) - 1, (width + 7) // 8
        mark = f"{tweak}:{n}".encode() if n.bit_length() < 12_000 else hashlib.blake2b(f"{tweak}:{n:x}".encode()).digest()
        while True:
            left, right = value >> width, value & mask
            for r in reversed(range(ROUNDS)) if back else range(ROUNDS):
                if back:
                    left, right = right ^ (self._round(r, left, size, mark) & mask), left
                else:
                    left, right = right, left ^ (self._round(r, right, size, mark) & mask)
            value = left << width | right
            if value < n:
                return value


def luhn_digit(payload: str) -> str:
    total = 0
    for i, c in enumerate(reversed(payload)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def _refill(shape: str, chars: str) -> str:
    """Put letters and digits back between the separators of ``shape``."""
    it = iter(chars)
    return "".join(next(it) if c.isalnum() else c for c in shape)


def _by_class(chars: str, perm: Permutation, tweak: str, back: bool) -> str:
    """Permute a string within the product of its characters' classes."""
    bases = [(10, "0") if "0" <= c <= "9" else (26, "a") if "a" <= c <= "z" else (26, "A") if "A" <= c <= "Z" else (1, c) for c in chars]
    n = value = 0
    n = 1
    for c, (base, zero) in zip(chars, bases):
        value, n = value * base + (ord(c) - ord(zero)), n * base
    shape = "".join(zero for _, zero in bases)
    value, out = perm.apply(value, n, tweak + shape, back), []
    for base, zero in reversed(bases):
        value, digit = divmod(value, base)
        out.append(chr(ord(zero) + digit))
    return "".join(reversed(out))


def _iban_check(country: str, account: str) -> str:
    number = int("".join(str(int(c, 36)) for c in account + country + "00"))
    return f"{98 - number % 97:02d}"


def code_length(digits: str) -> int:
    """Digits of the country code of an international number, whatever its separators."""
    return 1 if digits[:1] in ONE_DIGIT_CODES else 2 if digits[:2] in TWO_DIGIT_CODES else 3


def _pseudonym(kind: str, value: str, perm: Permutation, back: bool) -> str | None:
    """The value's pseudonym (or original), or None where it isn't valid."""
    if kind == "card":
        digits = re.sub(r"\D", "", value)
        if not 13 <= len(digits) <= 19 or luhn_digit(digits[:-1]) != digits[-1] or len(set(digits)) == 1:
            return None
        n = len(digits) - 2
        body = digits[0] + str(perm.apply(int(digits[1:-1]), 10**n, f"card{len(digits)}", back)).zfill(n)
        return _refill(value, body + luhn_digit(body))
    if kind == "iban":
        chars = value.replace(" ", "")
        if not 15 <= len(chars) <= 34 or _iban_check(chars[:2], chars[4:]) != chars[2:4]:
            return None
        account = _by_class(chars[4:], perm, "iban" + chars[:2], back)
        return _refill(value, chars[:2] + _iban_check(chars[:2], account) + account)
    if kind == "ssn":
        area, group, serial = map(int, value.split("-"))
        if area in (0, 666) or area >= 900 or not group or not serial:
            return None
        areas = [a for a in range(1, 900) if a != 666]
        at = (area - 1 - (area > 666)) * 99 * 9999 + (group - 1) * 9999 + serial - 1
        at = perm.apply(at, 898 * 99 * 9999, "ssn", back)
        return f"{areas[at // (99 * 9999)]:03d}-{at // 9999 % 99 + 1:02d}-{at % 9999 + 1:04d}"
    if kind == "phone":
        digits = re.sub(r"\D", "", value)
        if not 8 <= len(digits) <= 15:
            return None
        keep = code_length(digits) if value[0] == "+" else 0
        n, code = len(digits) - keep, digits[:keep] if keep else "1" * (len(digits) == 10)
        return _refill(value, digits[:keep] + str(perm.apply(int(digits[keep:]), 10**n, f"phone{code}", back)).zfill(n))
    if kind == "date":
        parts = re.split(r"[-/.]", value)
        y, m, d = (0, 1, 2) if len(parts[0]) == 4 else (2, 1, 0)
        swapped = False
        try:
            day = datetime.date(int(parts[y]), int(parts[m]), int(parts[d]))
        except ValueError:
            try:  # month first
                day, swapped = datetime.date(int(parts[y]), int(parts[d]), int(parts[m])), True
            except ValueError:
                return None
        if not 0 <= day.toordinal() - _FIRST_DAY < _DAYS:
            return None
        return _write_day(value, parts, day, perm, back, swapped, y, m, d)
    if kind == "ip":
        n = 0
        for octet in value.split("."):
            n = n << 8 | int(octet)
        n = perm.apply(n, 1 << 32, "ip", back)
        return ".".join(str(n >> s & 255) for s in (24, 16, 8, 0))
    if kind == "email":
        local, domain = value.rsplit("@", 1)
        return _by_class(local, perm, "email" + domain.lower(), back) + "@" + domain
    return _by_class(value, perm, "secret", back)


def _write_day(value, parts, day, perm, back, swapped, y, m, d) -> str:
    """Permute among the days that are written alike.

    With two figures for day and month every day of the range is; a date of
    unpadded figures is permuted among those of equal figures; a date that reads
    only month first stays so, and one that reads day first is never turned into
    the former: each class of days is permuted within itself.
    """
    size = tuple(len(parts[i]) for i in (d, m))
    days = _days_like(size, swapped)
    at = perm.apply(days.index(day.toordinal() - _FIRST_DAY) if len(days) != _DAYS else day.toordinal() - _FIRST_DAY, len(days), f"date{size}{swapped}", back)
    new = datetime.date.fromordinal(days[at] + _FIRST_DAY)
    first, second = (new.month, new.day) if swapped else (new.day, new.month)
    texts = {y: f"{new.year:04d}", d: str(first).zfill(size[0]), m: str(second).zfill(size[1])}
    separators = re.findall(r"[-/.]", value)
    return texts[0] + separators[0] + texts[1] + separators[1] + texts[2]


_DAYS_LIKE: dict = {}


def _days_like(size: tuple[int, int], swapped: bool):
    if (size, swapped) not in _DAYS_LIKE:
        if size == (2, 2) and not swapped:
            _DAYS_LIKE[size, swapped] = range(_DAYS)
        else:
            found = []
            for i in range(_DAYS):
                day = datetime.date.fromordinal(i + _FIRST_DAY)
                first, second = (day.month, day.day) if swapped else (day.day, day.month)
                fits = all(len(str(v)) == s or (s == 2 and v < 10) for v, s in ((first, size[0]), (second, size[1])))
                if fits and (not swapped or day.day > 12):
                    found.append(i)
            _DAYS_LIKE[size, swapped] = found
    return _DAYS_LIKE[size, swapped]


def _ibans(text: str, pattern: re.Pattern):
    """Spans of valid IBANs: upper-case words that follow one aren't part of it."""
    m = pattern.search(text)
    while m:
        a, b = m.span()
        ends = [b, *(i for i in range(b - 1, a, -1) if text[i] == " ")]
        length = IBAN_LENGTHS.get(text[a : a + 2])
        ends.sort(key=lambda e: e - a - text.count(" ", a, e) != length)  # the country's length first, then the longest
        end = next((e for e in ends if _pseudonym("iban", text[a:e], _CHECK, False) is not None), None)
        if end:
            yield a, end
        m = pattern.search(text, end or a + 1)


def find(text: str) -> list[tuple[int, int, str]]:
    """Candidates without overlaps, in order: (start, end, kind)."""
    if not _TRIGGER.search(text):
        return []
    spans = []
    for kind, pattern in PATTERNS:
        if kind == "iban":
            spans += [(a, b, kind) for a, b in _ibans(text, pattern)]
            continue
        for m in pattern.finditer(text):
            a, b = m.span(1) if kind == "secret" else m.span()
            spans.append((a, b, kind))
    out, end = [], 0
    for a, b, kind in sorted(spans, key=lambda s: (s[0], s[0] - s[1], _RANK[s[2]])):
        if a >= end and (kind in ("email", "secret") or _pseudonym(kind, text[a:b], _CHECK, False) is not None):  # any such string is valid
            out.append((a, b, kind))
            end = b
    return out


_CHECK = Permutation(b"")


def pseudonymise(text: str, perm: Permutation, back: bool = False) -> tuple[str, list[tuple[int, int, str]]]:
    """The text with every valid value replaced (or restored), and what was found."""
    spans = find(text)
    if not spans:
        return text, spans
    out, at = [], 0
    for a, b, kind in spans:
        out += [text[at:a], _pseudonym(kind, text[a:b], perm, back)]
        at = b
    return "".join(out) + text[at:], spans


def pseudonymise_documents(docs: DataFrame, key: bytes, text_col: str = "text", back: bool = False, outputs: tuple[str, str] = ("n_private", "kinds")) -> DataFrame:
    """All columns of ``docs`` with the text pseudonymised, plus how many values were found and their kinds."""
    docs = docs.drop(*outputs)
    schema = StructType(docs.schema.fields + [StructField(outputs[0], LongType()), StructField(outputs[1], StringType())])

    def run(batches):
        perm = Permutation(key)
        for batch in batches:
            done = [(None, []) if t is None else pseudonymise(t, perm, back) for t in batch.column(text_col).to_pylist()]
            at = batch.schema.get_field_index(text_col)
            batch = batch.set_column(at, text_col, pa.array([t for t, _ in done], batch.schema.field(at).type))
            batch = batch.append_column(outputs[0], pa.array([len(s) for _, s in done], pa.int64()))
            yield batch.append_column(outputs[1], pa.array([",".join(sorted({k for _, _, k in s})) for _, s in done], pa.string()))

    return docs.mapInArrow(run, schema)


def op4_pii(spark, sf_dir: str) -> DataFrame:
    set_key = spark.conf.get(KEY_SETTING, None)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    hidden = pseudonymise_documents(docs, set_key.encode() if set_key else TEST_KEY)
    return hidden.select("doc_id", "n_private", "kinds", "text")
