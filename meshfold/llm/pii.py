"""Format-preserving pseudonyms for personal data in texts.

A value is found by its pattern, validated (check digits, ranges, calendar), and replaced by
another valid value of the same format: its free digits and letters are numbers in mixed
radix, permuted by a keyed Feistel network. The permutation depends on the key, the kind and
the canonical value alone, so equal values stay equal across documents, and whoever holds
the key can go back. Values that do not validate are left as they are.
"""

from __future__ import annotations

import re
from datetime import date, timedelta
from hashlib import blake2b
from math import prod

import pyarrow as pa
from pyspark.sql import DataFrame

from meshfold.llm.common import instead, unused

ROUNDS = 10
_FIRST_DAY, _DAYS = date(1900, 1, 1), (date(2100, 1, 1) - date(1900, 1, 1)).days

_PATTERNS = {
    "email": r"(?<![\w.%+-])[\w.%+-]++@(?:[A-Za-z0-9-]++\.)++[A-Za-z]{2,}",
    "iban": r"(?<!\w)[A-Z]{2}\d{2}(?:[A-Z0-9]{11,30}|(?:[ \xa0-][A-Z0-9]{4}){2,7}(?:[ \xa0-][A-Z0-9]{1,3})?)(?!\w)",
    "secret": r"(?<!\w)(?:[0-9a-fA-F]{64}|[0-9a-fA-F]{40}|[0-9a-fA-F]{32})(?!\w)",
    "ip": r"(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?!\w|\.\d)",
    "date": r"(?<![\w./-])(?:\d{4}-\d\d-\d\d(?=T\d\d:)|(?:\d{4}-\d\d-\d\d|\d\d/\d\d/\d{4}|\d\d\.\d\d\.\d{4})(?![\w/-]|\.\d))",
    "ssn": r"(?<![\w-])\d{3}-\d\d-\d{4}(?![\w-])",
    "phone": r"(?<![\w+])(?:\+\d{1,3}[ \xa0.-]?(?:\(\d{2,4}\)|\d{2,4})[ \xa0.-]?\d{2,4}[ \xa0.-]?\d{2,4}|\(\d{3}\)[ \xa0]?\d{3}[ \xa0.-]\d{4}"
             r"|\d{3}-\d{3}-\d{4}|\d{3}\.\d{3}\.\d{4})(?!\w)",
    "card": r"(?<![\w-])(?:\d{13,19}|(?:\d{4}[ \xa0]){3}\d{1,7}|(?:\d{4}-){3}\d{1,7}|\d{4}[ \xa0-]\d{6}[ \xa0-]\d{5})(?![\w-])",
}
_VALUE = re.compile("|".join(f"(?P<{kind}>{pattern})" for kind, pattern in _PATTERNS.items()), re.ASCII)
_ALONE = {kind: re.compile(pattern, re.ASCII) for kind, pattern in _PATTERNS.items()}
_SIGN = re.compile("[0-9@]")
_IBAN_HEAD = re.compile(r"(?<!\w)[A-Z]{2}\d{2}", re.ASCII)
_IBAN_GROUPS = re.compile(r"(?:[ \xa0-][A-Z0-9]{4}){2,7}(?:[ \xa0-][A-Z0-9]{1,3})?(?!\w)", re.ASCII)
_IBAN_GAPS = " \xa0-"
#: Characters of an IBAN by country, as ISO 13616 registers them.
_IBAN_LENGTH = {x[:2]: int(x[2:]) for x in (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 DO28 EE20 EG29 ES24 FI18 "
    "FK18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HN28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 "
    "LU20 LV21 LY25 MC27 MD24 ME22 MK19 MN20 MR27 MT31 MU30 NI28 NL18 NO15 OM23 PK24 PL28 PS29 PT25 QA29 RO24 RS22 RU33 SA24 "
    "SC31 SD18 SE24 SI19 SK24 SM27 SO23 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20 YE30").split()}
_SPACE = re.compile(r"\s")


class Cipher:
    """A keyed permutation of mixed-radix numbers; the digest of a round covers its other half."""

    def __init__(self, key: bytes):
        self.key = blake2b(key, digest_size=64).digest()

    def _round(self, kind: str, number: int, value: int, size: int) -> int:
        width = (value.bit_length() + 7) // 8
        data = b"%s|%d|%d|" % (kind.encode(), number, size) + value.to_bytes(width, "big")
        digest, need = b"", size.bit_length() // 8 + 9
        while len(digest) < need:
            digest += blake2b(data + len(digest).to_bytes(4, "big"), key=self.key).digest()
        return int.from_bytes(digest[:need], "big") % size

    def permute(self, kind: str, digits: list[int], radices: list[int], back: bool = False) -> list[int]:
        """Digits of the permuted number; with ``back``, of the number it came from."""
        half = len(digits) // 2
        sides, sizes = [], []
        for part in (slice(half), slice(half, None)):
            value = 0
            for digit, radix in zip(digits[part], radices[part]):
                value = value * radix + digit
            sides.append(value)
            sizes.append(prod(radices[part]))
        for number in (range(ROUNDS - 1, -1, -1) if back else range(ROUNDS)):
            here = number % 2
            # the sizes of both halves and the length tell formats apart
            step = self._round(f"{kind}{len(digits)}:{sizes[1 - here]}", number, sides[1 - here], sizes[here])
            sides[here] = (sides[here] + (-step if back else step)) % sizes[here]
        result = []
        for value, part in zip(sides, (radices[:half], radices[half:])):
            own = []
            for radix in reversed(part):
                value, digit = divmod(value, radix)
                own.append(digit)
            result += own[::-1]
        return result

    def below(self, kind: str, value: int, size: int, back: bool = False) -> int:
        """A number under ``size``: permuted until it is under ``size`` again."""
        root = 1
        while root * root < size:
            root += 1
        while True:
            high, low = self.permute(kind, list(divmod(value, root)), [root, root], back)
            value = high * root + low
            if value < size:
                return value


def luhn(digits: list[int]) -> int:
    """The check digit for the digits before it."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = d * 2 if i % 2 == 0 else d
        total += d - 9 if d > 9 else d
    return -total % 10


def _put(text: str, symbols: list[str], places: list[int]) -> str:
    chars = list(text)
    for place, symbol in zip(places, symbols):
        chars[place] = symbol
    return "".join(chars)


def _digits(text: str, start: int = 0) -> tuple[list[int], list[int]]:
    places = [i for i in range(start, len(text)) if text[i] in "0123456789"]
    return places, [int(text[i]) for i in places]


def _card(c: Cipher, text: str, back: bool) -> str | None:
    places, digits = _digits(text)
    if not 13 <= len(digits) <= 19 or luhn(digits[:-1]) != digits[-1]:
        return None
    new = c.permute("card", digits[:-1], [10] * (len(digits) - 1), back)
    return _put(text, [str(d) for d in [*new, luhn(new)]], places)


def _iban(c: Cipher, text: str, back: bool) -> str | None:
    bare = "".join(x for x in text if x not in _IBAN_GAPS)
    number = lambda s: int("".join(str(int(x, 36)) for x in s))
    if not 15 <= len(bare) <= 34 or number(bare[4:] + bare[:4]) % 97 != 1 or not 2 <= int(bare[2:4]) <= 98:
        return None  # 00, 01 and 99 also leave 1, but no number is given them
    own = bare[4:]
    radices = [10 if x.isdigit() else 26 for x in own]
    values = [int(x) if x.isdigit() else ord(x) - 65 for x in own]
    new = "".join(str(v) if r == 10 else chr(65 + v) for v, r in zip(c.permute("iban", values, radices, back), radices))
    check = 98 - number(new + bare[:2] + "00") % 97
    places = [i for i, x in enumerate(text) if x not in _IBAN_GAPS]
    return _put(text, list(f"{bare[:2]}{check:02d}{new}"), places)


def _ip(c: Cipher, text: str, back: bool) -> str | None:
    parts = [int(p) for p in text.split(".")]
    if max(parts) > 255:
        return None
    return ".".join(map(str, c.permute("ip", parts, [256] * 4, back)))


def _date(c: Cipher, text: str, back: bool) -> str | None:
    a, b, d = (int(x) for x in re.split(r"[-/.]", text))
    if text[4] == "-":
        orders = [(a, b, d)]
    else:
        orders = [(d, a, b), (d, b, a)] if "/" in text else [(d, b, a)]
    for year, month, day in orders:
        try:
            place = (date(year, month, day) - _FIRST_DAY).days
        except ValueError:
            continue
        if not 0 <= place < _DAYS:
            return None
        # A day that reads in both orders stays one that does, and so comes back the same way.
        return _write_date(c, text, place, (year, month, day) == orders[0], back)
    return None


def _write_date(c: Cipher, text: str, place: int, first: bool, back: bool) -> str:
    while True:
        place = c.below("date", place, _DAYS, back)
        day = _FIRST_DAY + timedelta(days=place)
        if text[4] == "-":
            return day.strftime("%Y-%m-%d")
        if "." in text:
            return day.strftime("%d.%m.%Y")
        if first:
            return day.strftime("%m/%d/%Y")
        if day.day > 12:  # day first: only days beyond 12 read so
            return day.strftime("%d/%m/%Y")


def _ssn(c: Cipher, text: str, back: bool) -> str | None:
    area, group, serial = (int(x) for x in text.split("-"))
    if not (0 < area < 900 and area != 666 and group and serial):
        return None
    area = area - 1 if area < 666 else area - 2
    area, group, serial = c.permute("ssn", [area, group - 1, serial - 1], [898, 99, 9999], back)
    return f"{area + 1 if area < 665 else area + 2:03d}-{group + 1:02d}-{serial + 1:04d}"


def _phone(c: Cipher, text: str, back: bool) -> str | None:
    country = re.match(r"\+\d{1,3}(?=[ \xa0.(-])|\+\d", text)
    places, digits = _digits(text, country.end() if country else 0)
    if not 7 <= len(digits) <= 14:
        return None
    new = c.permute("phone", digits, [10] * len(digits), back)
    return _put(text, [str(d) for d in new], places)


_HEX = "0123456789abcdef"


def _secret(c: Cipher, text: str, back: bool) -> str | None:
    if text != text.lower() and text != text.upper() or text.isdigit() or text.isalpha():
        return None
    new = text.lower()
    while True:  # on until the image is no number and no word either; the way back takes the same steps
        new = "".join(_HEX[d] for d in c.permute("secret", [int(x, 16) for x in new], [16] * len(new), back))
        if not (new.isdigit() or new.isalpha()):
            break
    return new if text == text.lower() else new.upper()


def _email(c: Cipher, text: str, back: bool) -> str | None:
    local = text[:text.index("@")]
    places = [i for i, x in enumerate(local) if x.isascii() and x.isalnum()]
    if not places:
        return None
    kinds = [("0", 10) if text[i].isdigit() else ("a", 26) if text[i].islower() else ("A", 26) for i in places]
    new = c.permute("email", [ord(text[i]) - ord(k) for i, (k, _) in zip(places, kinds)], [r for _, r in kinds], back)
    return _put(text, [chr(ord(k) + v) for v, (k, _) in zip(new, kinds)], places)


_KINDS = {"email": _email, "iban": _iban, "secret": _secret, "ip": _ip, "date": _date, "ssn": _ssn,
          "phone": _phone, "card": _card}


def _regions(text: str):
    """Runs of words with a digit or an at sign, one white-space character apart; the groups
    that may follow the head of an IBAN belong to them, also those of letters only."""
    start = end = 0
    sign = _SIGN.search(text)
    while sign:
        at = sign.start()
        left = end
        for space in " \n\t\r":
            left = max(left, text.rfind(space, end, at) + 1)
        gap = _SPACE.search(text, at)
        right = gap.start() if gap else len(text)
        if gap and right - left >= 4 and _IBAN_HEAD.fullmatch(text, right - 4, right):
            groups = _IBAN_GROUPS.match(text, right)
            if groups:
                gap = _SPACE.search(text, groups.end())
                right = gap.start() if gap else len(text)
        if left - end > 1 or end == 0:
            if end > start:
                yield start, end
            start = left
        end = right
        sign = _SIGN.search(text, end)
    if end > start:
        yield start, end


def _iban_end(text: str) -> int:
    """Where an IBAN ends whose groups may have run on into other words: at its country's length,
    if a group ends there. Told by country and spaces alone, which stay, so the way back is the same."""
    left = _IBAN_LENGTH.get(text[:2], 0)
    for i, x in enumerate(text):
        left -= x not in _IBAN_GAPS
        if not left:
            return i + 1 if text[i + 1:i + 2] in ("", *_IBAN_GAPS) else len(text)
    return len(text)


def _first(text: str, at: int, end: int, cipher: Cipher, back: bool) -> tuple[int, int, str, str] | None:
    """(start, end, kind, permuted value) of the first valid value from ``at``. Where a match is
    not valid the other kinds are tried at its place, and then the search goes on inside it."""
    while match := _VALUE.search(text, at, end):
        start = match.start()
        for kind, pattern in _ALONE.items():
            own = pattern.match(text, start, end)
            if own:
                stop = start + _iban_end(own[0]) if kind == "iban" else own.end()
                new = _KINDS[kind](cipher, text[start:stop], back)
                if new is not None:
                    return start, stop, kind, new
        at = start + 1
    return None


def replace(text: str, cipher: Cipher, back: bool = False) -> tuple[str, int]:
    """The text with its valid values permuted, and how many there were."""
    parts, at, count = [], 0, 0
    for first, end in _regions(text):
        while found := _first(text, first, end, cipher, back):
            start, stop, kind, new = found
            # Permuted until it is found again in its place: an invalid match around it may have become valid.
            low = max(first - 1, 0)
            before, after = text[low:start], text[stop:min(end, stop + 80)]
            while True:
                probe = before + new + after
                again = _first(probe, first - low, len(probe), cipher, back)
                if again and again[:3] == (start - low, start - low + len(new), kind):
                    break
                new = _KINDS[kind](cipher, new, back)
            parts += (text[at:start], new)
            at, count, first = stop, count + 1, stop
    return ("".join([*parts, text[at:]]), count) if count else (text, 0)


def pseudonymise(docs: DataFrame, key: bytes, text: str = "text", count: str | None = None, back: bool = False) -> DataFrame:
    """``docs`` with the valid values of every whole text replaced, and, where ``count`` names a
    column, how many there were. Lengths stay but for the octets of addresses. Null stays null,
    empty stays empty; repeated rows get equal texts; an empty table gives an empty one.
    ``n_chars``, where there is one, counts the characters of the new text. A column of ``docs``
    called like ``count`` gives way to it."""
    cipher = Cipher(key)
    docs = instead(docs, text, *([count] if count else []))
    place = docs.columns.index(text)
    chars = docs.columns.index("n_chars") if "n_chars" in docs.columns else None
    name = count or unused(docs, "found")[0]

    def run(batches):
        for batch in batches:
            old = batch.column(place).to_pylist()
            found = [(None, 0) if t is None else replace(t, cipher, back) for t in old]
            columns = list(batch.columns)
            columns[place] = pa.array([t for t, _ in found], columns[place].type)
            if chars is not None:
                columns[chars] = pa.array([n if t == o else len(t) for n, (t, _), o in zip(
                    columns[chars].to_pylist(), found, old)], columns[chars].type)
            yield pa.RecordBatch.from_arrays([*columns, pa.array([n for _, n in found], pa.int64())],
                                             [*batch.schema.names, name])

    result = docs.mapInArrow(run, ", ".join([*(f"`{c}` {t}" for c, t in docs.dtypes), f"`{name}` bigint"]))
    return result if count else result.drop(name)
