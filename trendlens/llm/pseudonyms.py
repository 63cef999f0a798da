"""Personal data replaced by format-preserving pseudonyms.

Every value found and validated becomes an integer in the range of its format; a keyed Feistel network
permutes that range, and the result is written back in the value's own layout. The same value therefore gets
the same pseudonym in every document (records stay linked), two values never share one, and whoever has the
key can reverse it. Values outside a format's valid set are walked on until they are valid again.

Kinds: email (local part; its letters and digits keep their places, the domain stays), card (13 to 19
digits, blanks or hyphens kept; numbers that pass the Luhn test get a check digit that passes, others one
that doesn't), iban (mod-97 valid; country kept, check digits renewed), ssn, phone (country code kept), ipv4
(octets up to 255), date (real days from 1900 to 2099; the layout, and with it the order of day and month,
stays; equal days stay equal in any layout; month before day is read only where day before month is no day).

Map-only over whole texts. Null text stays null; other columns pass unchanged.
"""

from __future__ import annotations

import hashlib
import re
import secrets
from collections.abc import Callable
from datetime import date, timedelta
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlens.llm.common import batches, pass_through

KINDS = ("email", "card", "iban", "ssn", "phone", "ipv4", "date")
DEMO_KEY = b"replace-me-with-a-secret-key"  # for the query and tests
KEY_SETTING = "spark.trendlens.pseudonymKey"
ROUNDS = 8


def feistel(x: int, size: int, key: bytes, tweak: bytes, back: bool = False) -> int:
    """A keyed permutation of range(size): alternating halves a x b >= size, walked on while outside."""
    if size < 2:
        return x
    a = isqrt(size - 1) + 1
    b = -(-size // a)

    def noise(r: int, half: int) -> int:
        data = tweak + b"|%d|%d|%d" % (size, r, half)
        return int.from_bytes(hashlib.blake2b(data, key=key[:64], digest_size=24).digest(), "big")

    while True:
        high, low = divmod(x, a)  # high < b, low < a
        for r in range(ROUNDS - 1, -1, -1) if back else range(ROUNDS):
            sign = -1 if back else 1
            if r % 2:
                high = (high + sign * noise(r, low)) % b
            else:
                low = (low + sign * noise(r, high)) % a
        x = high * a + low
        if x < size:
            return x


def permute_valid(x: int, size: int, valid: Callable[[int], bool], key: bytes, tweak: bytes, back: bool = False) -> int:
    """``feistel`` restricted to the values that ``valid`` accepts; ``x`` must be one of them."""
    while True:
        x = feistel(x, size, key, tweak, back)
        if valid(x):
            return x


def luhn(digits: str) -> bool:
    total = sum(sum(divmod(2 * int(d), 10)) if i % 2 else int(d) for i, d in enumerate(reversed(digits)))
    return total % 10 == 0


def _fill(layout: str, chars: str, kind: Callable[[str], bool]) -> str:
    it = iter(chars)
    return "".join(next(it) if kind(c) else c for c in layout)


def _digit(c: str) -> bool:
    return "0" <= c <= "9"


def _digits(s: str) -> str:
    return "".join(filter(_digit, s))


def _number(s: str, key: bytes, tweak: bytes, back: bool, valid: Callable[[int], bool] = lambda _: True) -> str:
    return str(permute_valid(int(s), 10 ** len(s), valid, key, tweak, back)).zfill(len(s))


def email(m: re.Match, key: bytes, back: bool) -> str | None:
    local, _, domain = m[0].partition("@")
    for tweak, low, chars in ((b"email-a", "a", "abcdefghijklmnopqrstuvwxyz"), (b"email-A", "A", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"), (b"email-0", "0", "0123456789")):
        own, radix = [c for c in local if c in chars], len(chars)
        if own:
            x = 0
            for c in own:
                x = x * radix + ord(c) - ord(low)
            x = feistel(x, radix ** len(own), key, tweak, back)
            new = []
            for _ in own:
                x, r = divmod(x, radix)
                new.append(chars[r])
            local = _fill(local, "".join(reversed(new)), lambda c, chars=chars: c in chars)
    return f"{local}@{domain}"


def card(m: re.Match, key: bytes, back: bool) -> str | None:
    own = _digits(m[0])
    if not 13 <= len(own) <= 19:
        return None
    if not luhn(own):
        new = _number(own, key, b"number", back, lambda x: not luhn(str(x).zfill(len(own))))
    else:
        body = _number(own[:-1], key, b"card", back)
        new = next(body + d for d in "0123456789" if luhn(body + d))
    return _fill(m[0], new, _digit)


def _mod97(country: str, check: str, body: str) -> int:
    return int("".join(str(int(c, 36)) for c in body + country + check)) % 97


def iban(m: re.Match, key: bytes, back: bool) -> str | None:
    own = re.sub(r"[ -]", "", m[0])
    if not 15 <= len(own) <= 34 or _mod97(own[:2], own[2:4], own[4:]) != 1:
        return None
    body = own[4:]
    if digits := _digits(body):
        body = _fill(body, _number(digits, key, b"iban", back), _digit)
    if letters := [c for c in body if not _digit(c)]:
        x = 0
        for c in letters:
            x = x * 26 + ord(c) - 65
        x = feistel(x, 26 ** len(letters), key, b"iban-a", back)
        new = []
        for _ in letters:
            x, r = divmod(x, 26)
            new.append(chr(65 + r))
        body = _fill(body, "".join(reversed(new)), lambda c: not _digit(c))
    check = str(98 - _mod97(own[:2], "00", body)).zfill(2)
    return _fill(m[0], own[:2] + check + body, str.isalnum)


def _ssn(x: int) -> bool:
    area, group, serial = x // 1_000_000, x // 10_000 % 100, x % 10_000
    return 0 < area < 900 and area != 666 and group > 0 and serial > 0


def ssn(m: re.Match, key: bytes, back: bool) -> str | None:
    own = _digits(m[0])
    return _fill(m[0], _number(own, key, b"ssn", back, _ssn), _digit) if _ssn(int(own)) else None


def phone(m: re.Match, key: bytes, back: bool) -> str | None:
    head = m["code"] or ""
    own = _digits(m[0][len(head) :])
    if not 7 <= len(own) <= 13:
        return None
    plan = lambda x: len(own) != 10 or (x // 10**9 > 1 and x // 10**6 % 10 > 1)  # noqa: E731  ten digits: area and exchange start at 2
    valid = plan if plan(int(own)) else lambda x: not plan(x)
    return head + _fill(m[0][len(head) :], _number(own, key, b"phone", back, valid), _digit)


def ipv4(m: re.Match, key: bytes, back: bool) -> str | None:
    parts = [int(p) for p in m[0].split(".")]
    if max(parts) > 255 or any(len(p) > 1 and p[0] == "0" for p in m[0].split(".")):
        return None
    x = feistel(int.from_bytes(bytes(parts), "big"), 1 << 32, key, b"ipv4", back)
    return ".".join(map(str, x.to_bytes(4, "big")))


FIRST, LAST = date(1900, 1, 1), date(2099, 12, 31)


def day(m: re.Match, key: bytes, back: bool) -> str | None:
    parts = re.split(r"[-/.]", m[0])
    year = 0 if len(parts[0]) == 4 else 2
    for month in (1,) if year == 0 else (1, 0):  # day before month, unless only month before day is a real day
        at = {0: (0, 1, 2), 1: (2, 1, 0), 2: (2, 0, 1)}[0 if year == 0 else 1 if month == 1 else 2]
        try:
            own = date(*(int(parts[i]) for i in at))
        except ValueError:
            continue
        if not FIRST <= own <= LAST:
            return None
        new = FIRST + timedelta(feistel((own - FIRST).days, (LAST - FIRST).days + 1, key, b"date", back))
        for i, value in zip(at, (new.year, new.month, new.day), strict=True):
            parts[i] = str(value).zfill(len(parts[i]))
        marks = re.findall(r"[-/.]", m[0])
        return parts[0] + marks[0] + parts[1] + marks[1] + parts[2]
    return None


_MAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}")
# tried in this order at a digit, "+" or "(" that no letter, digit or joined number touches
_NUMBERS = re.compile(
    r"""(?<![\w+])(?<!\d[.,-])(?:
      (?P<ipv4>\d{1,3}(?:\.\d{1,3}){3})(?![\w]|\.\d)
    | (?P<date>\d{4}-\d{1,2}-\d{1,2}|\d{4}/\d{1,2}/\d{1,2}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4}|\d{1,2}-\d{1,2}-\d{4})(?!\w|[-/.]\d)
    | (?P<ssn>\d{3}-\d{2}-\d{4})(?![\w]|-\d)
    | (?P<card>\d(?:[\ -]?\d){12,18})(?![\w]|[-]\d)
    | (?P<phone>(?P<code>\+\d{1,3}[\ .-]?)?(?:\(\d{2,4}\)[\ .-]?)?\d{2,4}[\ .-]\d{3,4}(?:[\ .-]\d{2,4}){0,2}|\+\d{8,15})(?![\w]|[-.]\d)
    )""",
    re.VERBOSE | re.ASCII,
)
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?:[ -]?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_MAKERS = {"email": email, "card": card, "iban": iban, "ssn": ssn, "phone": phone, "ipv4": ipv4, "date": day}


def _phone_like(s: str) -> bool:
    return s.startswith("+") or "(" in s or bool(re.fullmatch(r"\d{3}[ .-]\d{3}[ .-]\d{4}", s))


def pseudonymise(text: str, key: bytes, back: bool = False) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with pseudonyms and the (kind, start, end) of what was replaced; lengths may only differ by octets."""
    if not any(c in text for c in "@0123456789"):
        return text, []
    found: list[tuple[int, int, str, str]] = []
    if "@" in text:
        for m in _MAIL.finditer(text):
            found.append((m.start(), m.end(), "email", email(m, key, back)))
    taken = [(a, b) for a, b, *_ in found]
    free = lambda a, b: all(b <= x or a >= y for x, y in taken)
    for m in _IBAN.finditer(text):
        if free(*m.span()) and (new := iban(m, key, back)):
            found.append((*m.span(), "iban", new))
            taken.append(m.span())
    for m in _NUMBERS.finditer(text):
        kind = next(k for k in ("ipv4", "date", "ssn", "card", "phone") if m[k])
        if kind == "phone" and not _phone_like(m[0]) or not free(*m.span()):
            continue
        if (new := _MAKERS[kind](m, key, back)) is not None:
            found.append((*m.span(), kind, new))
    out, at = [], 0
    for a, b, _, new in sorted(found):
        out += [text[at:a], new]
        at = b
    return "".join(out) + text[at:], [(k, a, b) for a, b, k, _ in sorted(found)]


def secret_key(spark: SparkSession) -> bytes:
    """The key in the setting ``KEY_SETTING``, or a fresh one that nobody keeps: values are linked, but nobody can undo them."""
    key = spark.conf.get(KEY_SETTING, None)
    return key.encode() if key else secrets.token_bytes(32)


def replace_personal_data(docs: DataFrame, key: bytes, with_counts: bool = False) -> DataFrame:
    """``docs`` with pseudonyms in ``text``; with ``with_counts`` also a column n_<kind> for each kind, in place of one of its name."""
    if with_counts:
        docs = docs.drop(*[f"n_{k}" for k in KINDS])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    names = [f"n_{k}" for k in KINDS]
    if with_counts:
        schema += "".join(f", {n} long" for n in names)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        column = batch.column(batch.schema.get_field_index("text"))
        new, counts = [], {n: [] for n in names}
        for text in column.to_pylist():
            out, spans = (None, []) if text is None else pseudonymise(text, key)
            new.append(out)
            for k, n in zip(KINDS, names, strict=True):
                counts[n].append(sum(s[0] == k for s in spans))
        more = {n: pa.array(v, pa.int64()) for n, v in counts.items()} if with_counts else {}
        return pass_through(batch, text=pa.array(new, column.type), **more)

    return docs.withColumn("text", F.col("text").cast("string")).mapInArrow(batches(run), schema)
