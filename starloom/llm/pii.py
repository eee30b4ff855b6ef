"""Pseudonyms for personal data that keep each value's format, by a keyed Feistel permutation."""

from __future__ import annotations

import datetime
import functools
import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StructField, StructType

from starloom.llm import text as tx

ROUNDS = 10
#: Signs that are permuted together at most.
BLOCK = 512
FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1), datetime.date(2099, 12, 31)
_LETTERS, _HEX = "abcdefghijklmnopqrstuvwxyz", "0123456789abcdef"
_LOWER = str.maketrans(_LETTERS.upper(), _LETTERS)


class Feistel:
    """A keyed permutation of the numbers below any n, and its inverse.

    The number's bits are cut in halves that take turns in being masked by a keyed hash of the
    other. A result that is not below n is permuted again until one is, which keeps it one to
    one. ``tweak`` separates kinds of values.
    """

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _mask(self, tweak: str, turn: int, half: int, bits: int) -> int:
        data = f"{tweak}:{bits}:{turn}:{half:x}".encode()
        size = (bits + 7) // 8
        out = b""
        while len(out) < size:
            block = data + len(out).to_bytes(4, "big")
            out += hashlib.blake2b(block, key=self.key, digest_size=64).digest()
        return int.from_bytes(out[:size], "big") & ((1 << bits) - 1)

    def _once(self, value: int, bits: int, tweak: str, back: bool) -> int:
        left, right = value >> bits, value & ((1 << bits) - 1)
        for turn in reversed(range(ROUNDS)) if back else range(ROUNDS):
            if turn % 2:
                left ^= self._mask(tweak, turn, right, bits)
            else:
                right ^= self._mask(tweak, turn, left, bits)
        return left << bits | right

    def permute(
        self, value: int, n: int, tweak: str, back: bool = False,
        valid: Callable[[int], bool] | None = None,
    ) -> int:
        """``value`` must be below n and valid; the result is so too."""
        bits = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
        while True:
            value = self._once(value, bits, tweak, back)
            if value < n and (valid is None or valid(value)):
                return value

    def mixed(
        self, digits: list[int], sizes: list[int], tweak: str, back: bool = False,
        valid: Callable[[list[int]], bool] | None = None,
    ) -> list[int]:
        """Permutes a list of digits, each below its own size."""

        def apart(value: int) -> list[int]:
            out = []
            for size in reversed(sizes):
                value, digit = divmod(value, size)
                out.append(digit)
            return out[::-1]

        value, n = 0, 1
        for digit, size in zip(digits, sizes):
            value, n = value * size + digit, n * size
        ok = (lambda v: valid(apart(v))) if valid else None
        return apart(self.permute(value, n, tweak, back, ok))

    def text(self, text: str, tweak: str, back: bool = False) -> str:
        """ASCII digits stay digits, letters letters of their case; the rest stays in place.

        Text of hexadecimal digits alone, of one case and at least one a letter, stays so. Long
        text is permuted in blocks of like size, each with its number.
        """
        low = text.translate(_LOWER)
        hexa = set(low) <= set(_HEX) and not low.isdigit() and text in (low, text.upper())
        digits, sizes, tables, where = [], [], [], []
        for i, c in enumerate(low):
            table = _HEX if hexa else "0123456789" if c in "0123456789" else _LETTERS
            if c.isascii() and c.isalnum():
                digits.append(table.index(c))
                sizes.append(len(table))
                tables.append(table)
                where.append(i)
        out, has_case = list(text), hexa and text != low
        blocks = -(-len(digits) // BLOCK)
        for k in range(blocks):
            part = slice(len(digits) * k // blocks, len(digits) * (k + 1) // blocks)
            own, size, valid = digits[part], sizes[part], None
            if hexa and max(own) > 9:  # a letter is left, to tell it by
                valid = lambda d: max(d) > 9
            elif hexa:
                size = [10] * len(own)
            shape = "h" if valid else "d" * len(own) if hexa else "".join("d" if len(t) == 10 else "a" for t in tables[part])
            at = f"{tweak}/{shape}" + (f"/{k}" if k else "")
            for i, table, digit in zip(where[part], tables[part], self.mixed(own, size, at, back, valid)):
                c = table[digit]
                out[i] = c.upper() if has_case or (not hexa and text[i].isupper()) else c
        return "".join(out)


def luhn_digit(payload: list[int]) -> int:
    """The digit that makes payload and it pass the Luhn check."""
    total = 0
    for k, digit in enumerate(reversed(payload)):
        total += digit if k % 2 else digit * 2 - 9 * (digit > 4)
    return -total % 10


_DIGITS = frozenset("0123456789")


def _put(text: str, digits: list[int]) -> str:
    """``text`` with its digits replaced in order."""
    values = iter(digits)
    return "".join(str(next(values)) if c in _DIGITS else c for c in text)


def _digits(text: str) -> list[int]:
    return [int(c) for c in text if c in _DIGITS]


def _email(f: Feistel, text: str, back: bool) -> str | None:
    local, _, domain = text.rpartition("@")
    name, dot, top = domain.rpartition(".")
    return f"{f.text(local, 'local', back)}@{f.text(name, 'domain', back)}{dot}{top}"


def _card(f: Feistel, text: str, back: bool) -> str | None:
    digits = _digits(text)
    if not 13 <= len(digits) <= 19 or luhn_digit(digits[:-1]) != digits[-1] or not digits[0]:
        return None
    payload = [digits[0] - 1, *digits[1:-1]]
    payload = f.mixed(payload, [9] + [10] * (len(payload) - 1), "card", back)
    payload[0] += 1
    return _put(text, [*payload, luhn_digit(payload)])


def _phone(f: Feistel, text: str, back: bool) -> str | None:
    digits = _digits(text)
    if not 8 <= len(digits) <= 15:
        return None
    code = re.match(r"\+?([0-9]{1,3})(?=[ .(-])", text) if text[0] == "+" else None
    n = len(code[1]) if code else 1 if text[0] == "+" else 0
    rest = digits[n:]
    # of ten digits the first is an area code's, which is over 1; others stay below
    low, size = ((2, 8) if rest[0] >= 2 else (0, 2)) if len(rest) == 10 else (0, 10)
    rest = f.mixed([rest[0] - low, *rest[1:]], [size] + [10] * (len(rest) - 1), "phone", back)
    return _put(text, [*digits[:n], rest[0] + low, *rest[1:]])


def _ipv4(f: Feistel, text: str, back: bool) -> str | None:
    parts = text.split(".")
    if any(int(p) > 255 or (len(p) > 1 and p[0] == "0") for p in parts):
        return None
    low = [(0, 10, 100)[len(p) - 1] for p in parts]
    sizes = [(10, 90, 156)[len(p) - 1] for p in parts]
    got = f.mixed([int(p) - a for p, a in zip(parts, low)], sizes, "ipv4", back)
    return ".".join(str(v + a) for v, a in zip(got, low))


def _ssn(f: Feistel, text: str, back: bool) -> str | None:
    def valid(d: list[int]) -> bool:
        area = d[0] * 100 + d[1] * 10 + d[2]
        return 0 < area < 900 and area != 666 and any(d[3:5]) and any(d[5:])

    digits = _digits(text)
    if not valid(digits):
        return None
    return _put(text, f.mixed(digits, [10] * 9, "ssn", back, valid))


def _day(year: int, month: int, day: int) -> int | None:
    try:
        date = datetime.date(year, month, day)
    except ValueError:
        return None
    return (date - FIRST_DAY).days if FIRST_DAY <= date <= LAST_DAY else None


def _date(f: Feistel, text: str, back: bool) -> str | None:
    a, b, c = re.split(r"[-./]", text)
    n = (LAST_DAY - FIRST_DAY).days + 1
    on = lambda day: FIRST_DAY + datetime.timedelta(day)
    two = len(a) == 2 and len(b) == 2 or len(a) == 4 and len(b) == 2 and len(c) == 2
    fit = lambda d: two or (len(str(d.day)), len(str(d.month))) == widths
    if len(a) == 4:
        value, order, widths, kind = _day(int(a), int(b), int(c)), "ymd", (len(c), len(b)), "ymd"
    else:
        value, order, widths, kind = _day(int(c), int(b), int(a)), "dmy", (len(a), len(b)), "dmy"
        if value is None:
            value, order, widths, kind = _day(int(c), int(a), int(b)), "mdy", (len(b), len(a)), "mdy"
    if value is None:
        return None
    late = order == "mdy"  # day first unless the day is over 12; results stay on their side
    ok = lambda v: fit(on(v)) and (not late or on(v).day > 12)
    if not ok(value):
        return None  # digits such as 07 beside 7: not one format
    got = on(f.permute(value, n, f"date/{kind}/{widths if not two else ''}", back, ok))
    form = "02d" if two else "d"
    shown = {"y": f"{got.year:04d}", "m": f"{got.month:{form}}", "d": f"{got.day:{form}}"}
    seps = re.findall(r"[-./]", text)
    x, y, z = (shown[k] for k in order)
    return f"{x}{seps[0]}{y}{seps[1]}{z}"


def _iban(f: Feistel, text: str, back: bool) -> str | None:
    solid = text.replace(" ", "")
    number = lambda s: int("".join(str(int(c, 36)) for c in s))
    if not 15 <= len(solid) <= 34 or number(solid[4:] + solid[:4]) % 97 != 1:
        return None
    body = f.text(solid[4:], "iban" + solid[:2], back)
    check = 98 - number(body + solid[:2] + "00") % 97
    new = iter(f"{solid[:2]}{check:02d}{body}")
    return "".join(c if c == " " else next(new) for c in text)


def _secret(f: Feistel, text: str, back: bool) -> str | None:
    head = re.match(r"(?s).*?[=:]\s*[\"']?", text)[0]
    end = len(text)
    if not re.search("[A-Za-z0-9]", text[len(head) :]):
        return None
    while end > len(head) and not text[end - 1].isalnum():  # signs behind it tell nothing of its kind
        end -= 1
    return head + f.text(text[len(head) : end], "secret", back) + text[end:]


#: Lengths of IBANs by country; elsewhere the longest text that fits the pattern counts.
_IBAN_SIZE = {
    x[:2]: int(x[2:])
    for x in (
        "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 "
        "DO28 EE20 EG29 ES24 FI18 FK18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HR21 HU28 IE22 IL23 IQ23 "
        "IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19 MN20 MR27 MT31 "
        "MU30 NI28 NL18 NO15 OM23 PK24 PL28 PS29 PT25 QA29 RO24 RS22 RU33 SA24 SC31 SD18 SE24 SI19 SK24 "
        "SM27 SO23 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20 YE30"
    ).split()
}

#: Kind, pattern and what permutes it; at a place the first kind whose value validates counts.
KINDS: list[tuple[str, str, Callable]] = [
    ("email", r"(?<![\w.+%-])[A-Za-z0-9][\w.+%-]*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,24}\b", _email),
    ("secret", r"(?is:\b(?:password|passwd|pwd|secret|token|api[_-]?key)\b[\"']?\s{0,4}[=:]\s{0,4}(?:\"(?:[^\"\\]|\\.){6,}\"|'(?:[^'\\]|\\.){6,}'|\S{6,}))", _secret),
    ("iban", r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])", _iban),
    ("date", r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}|[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}|[0-9]{1,2}-[0-9]{1,2}-[0-9]{4})(?![0-9/-]|\.[0-9])", _date),
    ("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", _ssn),
    ("ipv4", r"(?<![0-9])(?<![0-9]\.)[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])", _ipv4),
    ("phone", r"(?:(?<![0-9+])\+[0-9]{1,3}[ .-]?)?\([0-9]{2,4}\)[ .-]?[0-9]{2,4}(?:[ .-][0-9]{2,4}){1,3}(?![0-9])|(?<![0-9+])\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,5}(?![0-9])|(?<![0-9.+-])[0-9]{3}(?:\.[0-9]{3}[ .-]|[ -][0-9]{3}\.)[0-9]{4}(?![0-9])", _phone),
]
_ANY = re.compile("|".join(f"(?:{pattern})" for _, pattern, _ in KINDS))
_EACH = [(kind, re.compile(pattern), how) for kind, pattern, how in KINDS]
_HOW = {kind: how for kind, _, how in KINDS} | {"card": _card}
_MAYBE = re.compile("[0-9@=:]")

_OLD_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b")
#: Phone numbers of known length, and what may stand behind one without being part of it.
_TEN = re.compile(r"(?:(?:\+[0-9]{1,3}[ .-]?)?\([0-9]{3}\)[ .-]?|\+1[ .-]?[0-9]{3}[ .-]?)[0-9]{3}[ .-]?[0-9]{4}(?![0-9])")
_OTHER = re.compile(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9])|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]|[0-9]+[-./][0-9]+[-./][0-9]{4}(?![0-9])|[0-9]{4}([-/])[0-9][0-9]?\2[0-9]|[0-9]+[.:/,][0-9]")
#: Numbers joined by single spaces or dashes; a fraction's digits do not begin one.
_CHAIN = re.compile(r"(?<![0-9])(?<![0-9]\.)[0-9]+(?:[ -][0-9]+)*")
_LAYOUTS = {(4, 4, 4, 4), (4, 4, 4, 4, 3), (4, 6, 5), (4, 6, 4), (4, 4, 4, 1)}


def _ends(kind: str, text: str, found: re.Match) -> list[int]:
    """Where a value that begins as ``found`` may end, the likeliest first.

    Only the shape of the text is looked at, which pseudonyms keep.
    """
    start, end = found.span()
    if kind == "iban":
        if size := _IBAN_SIZE.get(text[start : start + 2]):
            at = [k for k in range(start, end) if text[k] != " "][:size]
            whole = len(at) == size and not text[at[-1] + 1 : at[-1] + 2].isalnum()
            return [at[-1] + 1] if whole else []
        old = _OLD_IBAN.match(text, start)
        return [old.end()] if old else []
    if kind != "phone":
        return [end]
    if ten := _TEN.match(text, start):
        return [ten.end()]
    groups = [g.span() for g in re.finditer(r"[0-9]+", text[start:end])]
    pattern = next(p for k, p, _ in _EACH if k == "phone")
    fits, alone = [], []
    for k in range(len(groups), 1, -1):
        stop = start + groups[k - 1][1]
        cut = pattern.match(text, start, stop)
        if cut and cut.end() == stop and 8 <= sum(b - a for a, b in groups[:k]) <= 15:
            fits.append(stop)
            if not any(_OTHER.match(text, start + a) for a, _ in groups[2:k]):
                alone.append(stop)
    return alone + fits


def _firm(f: Feistel, text: str, back: bool) -> list[tuple[int, int, str]]:
    """Begin, end and replacement of all values whose place follows from their shape."""
    out, at = [], 0
    while found := _ANY.search(text, at):
        start = at = found.start()
        for kind, pattern, how in _EACH:
            one = pattern.match(text, start)
            for end in _ends(kind, text, one) if one else ():
                if (new := how(f, text[start:end], back)) is not None:
                    out.append((start, end, new))
                    break
            else:
                continue
            at = out[-1][1]
            break
        else:
            at += 1
    return out


class _Parse:
    """The cards and ten-digit phone numbers of a chain.

    Of all choices of values that do not overlap, the one of most weight: usual cards, then
    phones, then other groups of 13 to 19 digits that pass Luhn. So no valid card stays whole.
    ``best`` has for each group the weight from there on, the value that begins there, if any, and
    the group to go on with.
    """

    def __init__(self, chain: str):
        self.signs = list(chain)
        self.groups = [g.span() for g in re.finditer("[0-9]+", chain)]
        self.digits = [b - a for a, b in self.groups]
        n = len(self.groups)
        self.best: list[tuple[int, tuple | None, int]] = [(0, None, n)] * (n + 1)
        for i in range(n - 1, -1, -1):
            self.best[i] = self._at(i, {})
        #: Begin, end and kind of each value, by its first group.
        self.values: dict[int, tuple[int, int, str]] = {}
        i = 0
        while i < n:
            if self.best[i][1]:
                self.values[i] = self.best[i][1]
            i = self.best[i][2]

    def _at(self, i: int, fresh: dict[int, tuple]) -> tuple[int, tuple | None, int]:
        groups, digits, n = self.groups, self.digits, len(self.groups)
        after = lambda k: fresh.get(k, self.best[k])[0]
        out: tuple[int, tuple | None, int] = (after(i + 1), None, i + 1)
        size, a = 0, groups[i][0]
        for j in range(i, n):
            size += digits[j]
            if size > 19:
                break
            layout, b = tuple(digits[i : j + 1]), groups[j][1]
            if layout == (3, 3, 4):
                weight, one = 1000, (a, b, "phone")
            elif size < 13 or self.signs[a] == "0" or not _luhn("".join(self.signs[a:b])):
                continue
            else:
                same = len({self.signs[groups[k][1]] for k in range(i, j)}) < 2
                usual = j == i or (same and layout in _LAYOUTS)
                weight = 100 * size if usual else 1050 + size if j - i == n - 1 else size
                one = (a, b, "card")
            if weight + after(j + 1) > out[0]:
                out = (weight + after(j + 1), one, j + 1)
        return out

    def put(self, first: int, value: str) -> bool:
        """Puts ``value`` in the place of the one that begins at that group and tells whether the chain
        has its values at the same places still. Only groups near it are looked at, as far as weights
        to its left have changed."""
        a, b = self.values[first][:2]
        self.signs[a:b] = value
        last, path = self.best[first][2] - 1, self.path
        fresh: dict[int, tuple] = {}
        same = left = 0  # digits of a run of groups of the same weight, and of those left of the value
        for i in range(last, -1, -1):
            fresh[i] = self._at(i, fresh)
            if i in path and fresh[i][1:] != self.best[i][1:]:
                return False
            same = same + self.digits[i] if fresh[i][0] == self.best[i][0] else 0
            left += self.digits[i] if i < first else 0
            if min(same, left) > 40:  # no value reaches over so many digits and the groups beside them
                break
        for i, one in fresh.items():
            self.best[i] = one
        return True

    @functools.cached_property
    def path(self) -> set[int]:
        """The groups that the choice goes through. It stays as long as the values' places do."""
        out, i = set(), 0
        while i < len(self.groups):
            out.add(i)
            i = self.best[i][2]
        return out


def _luhn(text: str) -> bool:
    digits = _digits(text)
    return luhn_digit(digits[:-1]) == digits[-1]


def _chain(f: Feistel, chain: str, back: bool) -> tuple[str, int]:
    """Cards and phone numbers of one chain replaced, and how many.

    One value after another is permuted, again as in ``Feistel`` until the chain has its values at
    the same places. All that this depends on are the others as they are then, so the way back
    takes them in the other order. However many there are, each takes few turns.
    """
    parse = _Parse(chain)
    for first in sorted(parse.values, reverse=back):
        a, b, kind = parse.values[first]
        value = "".join(parse.signs[a:b])
        while True:
            value = _HOW[kind](f, value, back)
            if parse.put(first, value):
                break
    return "".join(parse.signs), len(parse.values)


def pseudonyms(text: str, key: Feistel, back: bool = False) -> tuple[str, int]:
    """The text with each validated value permuted, and how many were. ``back`` undoes it."""
    if not _MAYBE.search(text):
        return text, 0
    out, n, at = [], 0, 0
    for start, end, new in [*_firm(key, text, back), (len(text), len(text), "")]:
        for found in _CHAIN.finditer(text, at, start):
            if found.end() - found.start() > 9:
                value, k = _chain(key, found[0], back)
                out += [text[at : found.start()], value]
                n, at = n + k, found.end()
        out += [text[at:start], new]
        n, at = n + (start < end), end
    return "".join(out), n


def pseudonymize(
    docs: DataFrame, key: bytes, text: str = "text", count: str | None = None
) -> DataFrame:
    """``docs`` with personal data in column ``text`` replaced; all other columns stay.

    Found: e-mail and IPv4 addresses, payment cards (Luhn), IBANs (mod 97), dates of 1900 to
    2099, social security and phone numbers, and values of passwords, tokens and keys, of six
    signs at least: to the closing quote, or up to white space. In these ASCII letters and digits
    change and other signs stay. Values that fail their validation stay. A pseudonym has its value's format: same length and
    separators, valid check digits, a real date. One value has one pseudonym under a key, in
    every document, and who holds the key can undo it. Only a card or phone number with further
    digits one space or dash away may have another there, so that it is found again.

    ``count`` names a column to add with the number of values replaced. Null texts stay null
    with count 0, empty texts empty; rows are neither dropped nor added; whole texts are
    worked on, row by row, so repeated rows give repeated rows. New texts are handed on in runs of
    ``text.CHUNK_BYTES``, so that a worker's memory does not follow the batch.
    """
    schema = docs.schema
    if count:
        if count in docs.columns:
            raise ValueError(f"column {count} exists")
        schema = StructType([*schema.fields, StructField(count, LongType(), False)])
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        feistel = Feistel(key)
        for whole in batches:
            for a, b in tx.chunks(whole.column(at)):
                batch, new, n = whole.slice(a, b - a), [], []
                for value in batch.column(at):
                    value = value.as_py()
                    out, k = pseudonyms(value, feistel) if value is not None else (None, 0)
                    new.append(out)
                    n.append(k)
                columns = list(batch.columns)
                columns[at] = pa.array(new, batch.schema.field(at).type)
                if count:
                    columns.append(pa.array(n, pa.int64()))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.mapInArrow(run, schema)
