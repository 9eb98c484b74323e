"""Format-preserving pseudonyms by a keyed Feistel permutation (operator 1).

Card, account and nine-digit personal numbers, phone numbers, IP addresses of both
versions, mail names and dates are found, validated, and replaced by another valid value of the same format. The replacement is a
keyed permutation of the format's values: equal values get equal pseudonyms in every
document, whatever separators they are written with, different ones stay different, and
whoever has the key can go back. Each text is worked on by itself, so nothing is shuffled.
"""

from __future__ import annotations

import datetime as dt
import ipaddress
import re
from collections.abc import Callable, Iterator
from functools import lru_cache, partial
from hashlib import blake2b
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROUNDS = 10
_FIRST_DAY, _LAST_DAY = dt.date(1900, 1, 1).toordinal(), dt.date(2099, 12, 31).toordinal()


def _round(key: bytes, kind: str, k: int, half: int, modulus: int) -> int:
    message = f"{kind}:{k}:{half}".encode()
    digest = blake2b(message, key=key, digest_size=64).digest()
    return int.from_bytes(digest, "big") % modulus


def permute(value: int, size: int, key: bytes, kind: str, back: bool = False) -> int:
    """A keyed permutation of ``range(size)``.

    A number is written as two digits in bases ``a`` and ``b`` with ``a * b >= size``;
    rounds add a keyed function of one digit to the other. Results outside the range
    are permuted again until one is inside, which keeps it one-to-one.
    """
    if size < 2:
        return value
    a = isqrt(size - 1) + 1
    b = -(-size // a)
    while True:
        x, y = divmod(value, b)
        for k in reversed(range(ROUNDS)) if back else range(ROUNDS):
            sign = -1 if back else 1
            if k % 2:
                y = (y + sign * _round(key, kind, k, x, b)) % b
            else:
                x = (x + sign * _round(key, kind, k, y, a)) % a
        value = x * b + y
        if value < size:
            return value


def _walk(value: int, size: int, key: bytes, kind: str, back: bool, inside: Callable[[int], bool]) -> int:
    """Permute until ``inside`` holds: a permutation of those values for which it does."""
    while True:
        value = permute(value, size, key, kind, back)
        if inside(value):
            return value


def luhn_digit(body: str) -> int:
    """The last digit that makes ``body`` pass the Luhn check."""
    total = 0
    for place, digit in enumerate(reversed(body)):
        doubled = int(digit) * (1 if place % 2 else 2)
        total += doubled - 9 if doubled > 9 else doubled
    return -total % 10


def _refill(written: str, characters: str) -> str:
    """``written`` with its letters and digits replaced in order; separators stay."""
    new = iter(characters)
    return "".join(next(new) if c.isalnum() else c for c in written)


def _digits(text: str, key: bytes, kind: str, back: bool) -> str:
    return str(permute(int(text), 10 ** len(text), key, f"{kind}{len(text)}", back)).zfill(len(text))


def _card(found: str, key: bytes, back: bool) -> str | None:
    digits = re.sub(r"\D", "", found)
    if not 13 <= len(digits) <= 19 or luhn_digit(digits[:-1]) != int(digits[-1]):
        return None
    body = _digits(digits[:-1], key, "card", back)
    return _refill(found, body + str(luhn_digit(body)))


def _iban_check(country: str, body: str) -> int:
    return 98 - int("".join(str(int(c, 36)) for c in body + country + "00")) % 97


def _iban(found: str, key: bytes, back: bool) -> str | None:
    plain = re.sub(r"[ -]", "", found)
    country, check, body = plain[:2], plain[2:4], plain[4:]
    if not 11 <= len(body) <= 30 or _iban_check(country, body) != int(check):
        return None
    if country.upper() not in IBAN_LENGTHS and plain != plain.upper():
        return None  # words in lower case that pass the check by chance
    new = _mixed(body.upper(), key, "iban", back)
    new = "".join(n.lower() if b.islower() else n for n, b in zip(new, body))
    return _refill(found, f"{country}{_iban_check(country, new):02d}{new}")


def _personal_number(found: str, key: bytes, back: bool) -> str | None:
    """Nine digits, of which area, group and serial number are in use."""

    def used(n: int) -> bool:
        area, group, serial = n // 10**6, n // 10**4 % 100, n % 10**4
        return area not in (0, 666) and area < 900 and group > 0 and serial > 0

    value = int(found.replace("-", ""))
    if not used(value):
        return None
    return _refill(found, f"{_walk(value, 10**9, key, 'personal', back, used):09d}")


def _phone(found: str, key: bytes, back: bool) -> str | None:
    digits = re.sub(r"\D", "", found)
    if not 8 <= len(digits) <= 15:
        return None
    code = len(re.match(r"\+?(\d{0,3})", found)[1]) if found[0] == "+" else 0
    return _refill(found, digits[:code] + _digits(digits[code:], key, "phone", back))


def _address(found: str, key: bytes, back: bool) -> str | None:
    parts = [int(p) for p in found.split(".")]
    if max(parts) > 255:
        return None
    value = permute(int.from_bytes(bytes(parts), "big"), 1 << 32, key, "ip", back)
    return ".".join(map(str, value.to_bytes(4, "big")))


def _address6(found: str, key: bytes, back: bool) -> str | None:
    """Every group keeps its number of hexadecimal digits, a group of zeros stays one, so
    an address gets the same pseudonym whether or not its zeros are written."""
    try:
        packed = ipaddress.IPv6Address(found).packed
    except ValueError:
        return None
    groups = [int.from_bytes(packed[i : i + 2], "big") for i in range(0, 16, 2)]
    lengths = [len(f"{g:x}") if g else 0 for g in groups]
    value, size = 0, 1
    for group, length in zip(groups, lengths):
        if length:
            low, many = 16 ** (length - 1), 15 * 16 ** (length - 1)
            value, size = value * many + group - low, size * many

    def hexadecimals(number: int) -> list[str]:
        out = []
        for length in reversed([n for n in lengths if n]):
            number, rest = divmod(number, 15 * 16 ** (length - 1))
            out.append(f"{rest + 16 ** (length - 1):x}")
        return out[::-1]

    def has_digit(number: int) -> bool:  # else it could be two words with colons
        return any(c.isdigit() for h in hexadecimals(number) for c in h)

    if not has_digit(value):
        return None
    new = iter(hexadecimals(_walk(value, size, key, "ip6" + "".join(map(str, lengths)), back, has_digit)))
    written = [next(new).zfill(len(g)) if g.strip("0") else g for g in found.split(":")]
    return ":".join(written).upper() if found != found.lower() else ":".join(written)


def _mixed(text: str, key: bytes, kind: str, back: bool) -> str:
    """Permute ASCII letters and digits, each within its own kind."""
    value, size, bases = 0, 1, []
    for c in text:
        low, base = (48, 10) if c.isdigit() else (97, 26) if c.islower() else (65, 26)
        value, size = value * base + ord(c) - low, size * base
        bases.append((low, base))
    shape = "".join(chr(low) for low, _ in bases)
    value = permute(value, size, key, f"{kind}{shape}", back)
    out = []
    for low, base in reversed(bases):
        value, digit = divmod(value, base)
        out.append(chr(low + digit))
    return "".join(reversed(out))


def _mail(found: str, key: bytes, back: bool) -> str | None:
    name, _, host = found.partition("@")
    plain = re.sub(r"[^A-Za-z0-9]", "", name)
    return f"{_refill(name, _mixed(plain, key, 'mail', back))}@{host}" if plain else None


def _day(year: int, month: int, day: int, key: bytes, back: bool) -> dt.date | None:
    """The day of the month stays below 10, up to 12, or above: so the pseudonym has as many
    digits, and is read in the order in which the date was."""
    try:
        ordinal = dt.date(year, month, day).toordinal()
    except ValueError:
        return None
    if not _FIRST_DAY <= ordinal <= _LAST_DAY:
        return None

    def alike(n: int) -> bool:
        new = dt.date.fromordinal(_FIRST_DAY + n).day
        return (new < 10) == (day < 10) and (new > 12) == (day > 12)

    size = _LAST_DAY - _FIRST_DAY + 1
    return dt.date.fromordinal(_FIRST_DAY + _walk(ordinal - _FIRST_DAY, size, key, "date", back, alike))


def _iso_date(found: str, key: bytes, back: bool) -> str | None:
    new = _day(*map(int, re.split(r"[-/.]", found)), key=key, back=back)
    return new and _refill(found, new.strftime("%Y%m%d"))


def _day_first(found: str, key: bytes, back: bool) -> str | None:
    day, month, year = map(int, re.split(r"[-/.]", found))
    if month > 12:  # the month stands first
        new = _day(year, day, month, key, back)
        return new and _refill(found, new.strftime("%m%d%Y"))
    new = _day(year, month, day, key, back)
    return new and _refill(found, new.strftime("%d%m%Y"))


# Names of the months.
MONTHS = (
    "January", "February", "March", "April", "May", "June", "July", "August", "September",
    "October", "November", "December",
)


def _written_date(found: str, key: bytes, back: bool) -> str | None:
    name = re.search("[A-Za-z]+", found)[0]
    day, year = re.findall(r"\d+", found)
    new = _day(int(year), MONTHS.index(name.capitalize()) + 1, int(day), key, back)
    if new is None:
        return None
    month = MONTHS[new.month - 1]
    month = month.upper() if name.isupper() else month.lower() if name.islower() else month
    parts = iter([f"{new.day:0{len(day)}d}", f"{new.year:04d}"])
    return re.sub(r"[A-Za-z]+|\d+", lambda m: next(parts) if m[0].isdigit() else month, found)


# Characters of an IBAN by country.
IBAN_LENGTHS = {c[:2]: int(c[2:]) for c in (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DK18 DO28 "
    "EE20 EG29 ES24 FI18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HR21 HU28 IE22 IL23 IQ23 IS26 "
    "IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19 MR27 MT31 MU30 "
    "NL18 NO15 PK24 PL28 PS29 PT25 QA29 RO24 RS22 SA24 SC31 SE24 SI19 SK24 SM27 ST25 SV28 TL23 "
    "TN24 TR26 UA29 VA22 VG24 XK20"
).split()}


def _readings(kind: str, found: str) -> list[str]:
    """What of a match to try in turn: a greedy one may run on into the next words."""
    if kind not in ("iban", "phone"):
        return [found]
    ends = [m.start() for m in re.finditer(r"[ .-]", found)]
    parts = [found, *(found[:e] for e in reversed(ends))]  # the longest first
    if kind == "iban":
        length = IBAN_LENGTHS.get(found[:2].upper())
        fixed = [p for p in parts if sum(map(str.isalnum, p)) == length]
        return [*fixed, found] if length else parts
    for e in ends:  # complete: nothing more is taken after a space
        if found[e] == " " and _complete(found[:e]):
            return [found[:e], *(p for p in parts if len(p) < e)]
    return parts


def _complete(phone: str) -> bool:
    """A number of the length that its country has, or one whose last group hangs on a dash
    or dot. Elsewhere lengths vary, and groups set off by spaces may belong to it."""
    n = sum(map(str.isdigit, phone))
    if re.match(r"\+1(?!\d)", phone):
        return n >= 11
    return n >= 8 and re.search(r"[-.]\d{4}$", phone) is not None


_END = r"(?![\w])"
#: Kinds in the order in which they are tried at a place: name, pattern, replacement.
KINDS = [
    ("mail", r"(?<![\w.+-])[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", _mail),
    ("iban", rf"(?<!\w)[A-Za-z]{{2}}\d\d(?:[ -]?[A-Za-z0-9]){{11,30}}{_END}", _iban),
    ("date", rf"(?<![\w./-])\d{{4}}([-/.])\d\d\1\d\d{_END}", _iso_date),
    ("day", rf"(?<![\w./-])\d\d([-/.])\d\d\2\d{{4}}{_END}", _day_first),
    ("written", rf"(?<![\w./-])(?:\d{{1,2}} (?i:{'|'.join(MONTHS)})|(?i:{'|'.join(MONTHS)}) \d{{1,2}}),? \d{{4}}{_END}", _written_date),
    ("ip6", r"(?<![\w:.])[0-9A-Fa-f]{3,4}(?::[0-9A-Fa-f]{0,4}){2,7}(?![\w:])", _address6),
    ("personal", rf"(?<![\w-])\d{{3}}-\d\d-\d{{4}}(?![\w-])", _personal_number),
    ("ip", rf"(?<![\w.])\d{{1,3}}(?:\.\d{{1,3}}){{3}}(?![\w]|\.\d)", _address),
    ("phone", rf"(?<!\w)(?:\+\d{{1,3}}[ .-]?(?:\(\d{{1,4}}\)|\d{{1,4}})(?:[ .-]?\d{{2,4}}){{1,4}}|\(\d{{3}}\) ?\d{{3}}-\d{{4}}|\d{{3}}-\d{{3}}-\d{{4}}){_END}", _phone),
    ("card", rf"(?<!\w)\d{{4}}[ -]?\d{{4}}[ -]?\d{{4}}[ -]?\d{{1,7}}{_END}|(?<!\w)\d{{13,19}}{_END}", _card),
]


@lru_cache
def _pattern() -> re.Pattern:
    parts, groups = [], 0
    for name, pattern, _ in KINDS:
        groups += 1  # the named group itself
        own = re.compile(pattern).groups if "\\2" not in pattern else 1
        pattern = re.sub(r"\\[12]", rf"\\{groups + 1}", pattern) if own else pattern
        groups += own
        parts.append(f"(?P<{name}>{pattern})")
    return re.compile("|".join(parts))


#: No value is found in a text without one of these.
_HINT = re.compile(r"[0-9@]")


def pseudonymize_text(text: str, key: bytes, back: bool = False) -> tuple[str, list[tuple]]:
    """The text with pseudonyms, and ``(kind, start, end)`` of each in the new text.

    ``back`` undoes it.
    """
    if not _HINT.search(text):
        return text, []
    work = {name: make for name, _, make in KINDS}
    out, spans, done, length = [], [], 0, 0
    search, at = _pattern().search, 0
    while found := search(text, at):
        kind, start = found.lastgroup, found.start()
        for value in _readings(kind, found[0]):
            new = work[kind](value, key, back)
            if new is not None:
                break
        else:
            at = start + 1  # another value may begin inside the match
            continue
        out += [text[done:start], new]
        length += start - done
        spans.append((kind, length, length + len(new)))
        length += len(new)
        done = at = start + len(value)
    return "".join([*out, text[done:]]) if out else text, spans


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _batches(
    batches: Iterator[pa.RecordBatch], key: bytes, back: bool
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, spans = [], []
        for value in batch.column(batch.num_columns - 1):
            text = value.as_py()
            new, found = (None, []) if text is None else pseudonymize_text(text, key, back)
            texts.append(new)
            spans.append([{"kind": k, "start": a, "end": b} for k, a, b in found])
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(texts, pa.string()), pa.array(spans, _SPANS)],
            [*batch.schema.names[:-1], "_text_", "_spans_"],
        )


def pseudonymize(
    docs: DataFrame, key: bytes, text: str = "text", spans: str = "pseudonyms", back: bool = False
) -> DataFrame:
    """``docs`` with pseudonyms in ``text`` and their kinds and places in ``spans``.

    A null text stays null, with no spans; an empty one stays empty. A column that has
    the name ``spans`` is replaced, all others are carried along. A row's result
    depends on its text and the key alone.
    """
    others = [c for c in docs.columns if c not in (text, spans)]
    chosen = docs.select(*[F.col(f"`{c}`") for c in others], F.col(f"`{text}`").alias("_text_"))
    schema = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields
    ) + ", _spans_ array<struct<kind:string,start:bigint,end:bigint>>"
    done = chosen.mapInArrow(partial(_batches, key=key, back=back), schema)
    return done.select(
        *[F.col("_text_").alias(text) if c == text else F.col(f"`{c}`") for c in docs.columns if c != spans],
        F.col("_spans_").alias(spans),
    )
