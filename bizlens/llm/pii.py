"""Operator 5: personal data replaced by format-preserving Feistel pseudonyms.

Values are found by pattern and kept only if they pass their format's check:
payment cards (Luhn), IBANs (mod 97), social security numbers (issued ranges),
telephone numbers, IPv4 addresses, calendar dates and e-mail addresses. A
value is read as a number below the size of its format's domain and permuted
there by a keyed Feistel network; a result that the format doesn't allow is
permuted again until it is allowed (cycle walking), so valid values map one to
one to valid values. Separators, check digits, letter case and the place of
letters and digits are kept or made anew, so a pseudonym passes the same check.
Equal values get equal pseudonyms in all documents, however they are written:
telephone numbers are read as country code and digits, national forms as of +1.

Defined results: null text stays null; texts without a valid value stay as they
are; a value that fails its check is tried again without its last groups, and then from
its later ones; values overlapping an earlier or (from the same place) a longer one are
part of that one; rows are treated one by one, so repeated rows repeat; an
empty table gives an empty result; all other columns pass unchanged.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from bizlens.llm.common import documents, slices, small_batches

KEY = b"set a secret key of your own in production"
ROUNDS = 10
FIRST_DAY, LAST_DAY = dt.date(1900, 1, 1).toordinal(), dt.date(2099, 12, 31).toordinal()

PATTERNS = {
    "email": re.compile(r"(?<![\w.+%-])[A-Za-z0-9_.+%-]+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}(?![\w-])"),
    "iban": re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])"),
    "ip": re.compile(r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])"),
    "date": re.compile(r"(?<![0-9/.-])(?:[0-9]{4}([-/.])[0-9]{1,2}\1[0-9]{1,2}|[0-9]{1,2}([-/.])[0-9]{1,2}\2[0-9]{4})(?![0-9]|[/.-][0-9])"),
    "ssn": re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])"),
    "phone": re.compile(r"(?<![0-9+])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}|\([2-9][0-9]{2}\) ?[2-9][0-9]{2}[ .-][0-9]{4}|[2-9][0-9]{2}[.-][2-9][0-9]{2}[.-][0-9]{4})(?![0-9])"),
    "card": re.compile(r"(?<![0-9.])[2-6][0-9]{3}(?:[ -]?[0-9]){8,15}(?![0-9]|\.[0-9])"),
}
#: Country codes of two digits; 1 and 7 have one, all others three.
CODES_OF_TWO = frozenset("20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())
#: What stands between the groups of a value that other groups may follow.
GROUPED = {"iban": re.compile(" "), "phone": re.compile(r"[ .-](?=[0-9])"), "card": re.compile("[ -]")}
#: A text without any of these holds no value.
MARK = re.compile(r"[0-9@]")


def permute(x: int, size: int, key: bytes, tweak: str, allowed: Callable[[int], bool] = lambda _: True) -> int:
    """A keyed permutation of the allowed numbers below ``size``."""
    if size < 2:
        return x
    b = 1
    while b * b < size:
        b <<= 1
    a = -(-size // b)
    while True:
        left, right = divmod(x, b)
        for r in range(ROUNDS):
            seen = right if r % 2 == 0 else left
            f = int.from_bytes(hashlib.blake2b(f"{tweak}:{size}:{r}:{seen}".encode(), key=key[:64], digest_size=48).digest(), "big")
            if r % 2 == 0:
                left = (left + f) % a
            else:
                right = (right + f) % b
        x = left * b + right
        if x < size and allowed(x):
            return x


def luhn(digits: str) -> int:
    """The sum that is 0 modulo 10 for a valid number."""
    return sum(int(c) if k % 2 == 0 else (int(c) * 2 - 9 * (c > "4")) for k, c in enumerate(reversed(digits)))


def _written(value: str, digits: str) -> str:
    """``value`` with its digits replaced in turn."""
    it = iter(digits)
    return "".join(next(it) if "0" <= c <= "9" else c for c in value)


def _digits(value: str) -> str:
    return re.sub(r"[^0-9]", "", value)


def _card(value: str, key: bytes) -> str | None:
    d = _digits(value)
    if not 13 <= len(d) <= 19 or luhn(d) % 10 or len(set(d)) == 1:
        return None
    n = len(d) - 2
    body = d[0] + str(permute(int(d[1:-1]), 10**n, key, "card")).zfill(n)
    return _written(value, body + str(-luhn(body + "0") % 10))


def _mixed(text: str, key: bytes, tweak: str) -> str:
    """Letters permuted among letters of their case and digits among digits, as one number."""
    x, size = 0, 1
    for c in text.lower():
        if c.isascii() and c.isalnum():
            base = 10 if c.isdigit() else 26
            x, size = x * base + (int(c) if base == 10 else ord(c) - 97), size * base
    x, out = permute(x, size, key, tweak + re.sub("[A-Za-z]", "a", re.sub("[0-9]", "0", text))), []
    for c in reversed(text):
        if c.isascii() and c.isalnum():
            x, k = divmod(x, 10 if c.isdigit() else 26)
            c = str(k) if c.isdigit() else chr(k + (65 if c.isupper() else 97))
        out.append(c)
    return "".join(reversed(out))


def _email(value: str, key: bytes) -> str | None:
    local, _, host = value.partition("@")
    if ".." in value or local[0] == "." or local[-1] == ".":
        return None
    name, _, top = host.rpartition(".")
    return f"{_mixed(local, key, 'local')}@{_mixed(name, key, 'host')}.{top}"


def _iban_rest(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def _iban(value: str, key: bytes) -> str | None:
    iban = value.replace(" ", "")
    if not 15 <= len(iban) <= 34 or _iban_rest(iban) != 1:
        return None
    body = _mixed(iban[4:], key, "iban" + iban[:2])
    made = iter(f"{iban[:2]}{98 - _iban_rest(iban[:2] + '00' + body):02d}{body}")
    return "".join(c if c == " " else next(made) for c in value)


def _ip(value: str, key: bytes) -> str | None:
    octets = value.split(".")
    if any(int(o) > 255 or o != str(int(o)) for o in octets):
        return None
    x = int.from_bytes(bytes(map(int, octets)), "big")
    public = lambda v: v >> 24 not in (0, 127) and v != 0xFFFFFFFF  # noqa: E731  neither loopback nor broadcast
    return ".".join(map(str, permute(x, 1 << 32, key, "ip", public).to_bytes(4, "big"))) if public(x) else None


def _date(value: str, key: bytes) -> str | None:
    mark = re.search("[-/.]", value).group()
    parts = value.split(mark)
    if len(parts[0]) == 4:
        order = (0, 1, 2)
    else:
        order = (2, 0, 1) if int(parts[1]) > 12 else (2, 1, 0)  # month first only where the day can't be
    try:
        day = dt.date(*(int(parts[k]) for k in order)).toordinal()
    except ValueError:
        return None
    if not FIRST_DAY <= day <= LAST_DAY:
        return None
    made = dt.date.fromordinal(FIRST_DAY + permute(day - FIRST_DAY, LAST_DAY - FIRST_DAY + 1, key, "date"))
    out = [""] * 3
    for k, n in zip(order, (made.year, made.month, made.day), strict=True):
        out[k] = str(n).zfill(2 if len(parts[k]) > 1 else 1)
    return mark.join(out)


def _ssn(value: str, key: bytes) -> str | None:
    issued = lambda x: x // 10**6 not in (0, 666) and x // 10**6 < 900 and x // 10**4 % 100 and x % 10**4
    d = int(_digits(value))
    return _written(value, f"{permute(d, 10**9, key, 'ssn', lambda x: bool(issued(x))):09d}") if issued(d) else None


def _code(digits: str) -> str:
    """The country code that an international number begins with."""
    return digits[: 1 if digits[0] in "17" else 2 if digits[:2] in CODES_OF_TWO else 3]


def _phone(value: str, key: bytes) -> str | None:
    trunk = value.replace("(0)", "(o)")  # not part of the number
    d = _digits(trunk)
    if not 7 <= len(d) <= 15:
        return None
    code, given = (_code(d), True) if value[0] == "+" else ("1", False)
    rest = d[len(code):] if given else d
    national = lambda x: x // 10**9 > 1 and x // 10**6 % 10 > 1  # noqa: E731  area and exchange begin with 2 to 9
    if code == "1" and len(rest) == 10:
        kind = national(int(rest))
        allowed = lambda x: national(x) == kind
    else:
        allowed = lambda x: True
    made = str(permute(int(rest), 10 ** len(rest), key, "phone+" + code, allowed)).zfill(len(rest))
    return _written(trunk, (code if given else "") + made).replace("(o)", "(0)")


PSEUDONYM = {"email": _email, "iban": _iban, "ip": _ip, "date": _date, "ssn": _ssn, "phone": _phone, "card": _card}


def _ends(kind: str, value: str) -> list[str]:
    """``value`` and its shorter forms that end with a group (free digits or words
    may follow), the longest first; a telephone number of its plan's length before these."""
    if kind not in GROUPED:
        return [value]
    ends = [value, *(value[: m.start()] for m in reversed(list(GROUPED[kind].finditer(value))))]
    if kind == "phone" and value.startswith("+1"):
        ends.sort(key=lambda v: len(_digits(v)) != 11)
    return ends


def find(text: str, key: bytes) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, pseudonym) of the valid values, in order, not overlapping."""
    if not MARK.search(text):
        return []
    found = []
    for kind, pattern in PATTERNS.items():
        m = pattern.search(text)
        while m:
            value = m.group()
            for value in _ends(kind, value):
                if (made := PSEUDONYM[kind](value, key)) is not None:
                    found.append((m.start(), -m.start() - len(value), kind, made))
                    break
            else:
                value = "" if kind in GROUPED else value
            m = pattern.search(text, m.start() + max(len(value), 1))  # a value may begin within a failed one
    out, at = [], 0
    for start, end, kind, made in sorted(found):
        if start >= at:
            out.append((start, -end, kind, made))
            at = -end
    return out


def pseudonymise(text: str, key: bytes) -> tuple[str, list[tuple[int, int, str, str]]]:
    found, out, at = find(text, key), [], 0
    for start, end, _, made in found:
        out += [text[at:start], made]
        at = end
    return ("".join([*out, text[at:]]) if found else text), found


def pseudonyms(docs: DataFrame, key: bytes = KEY, text_col: str = "text") -> DataFrame:
    """``docs`` with its texts pseudonymised, and ``pii_count`` and ``pii_spans``
    (``kind:start:end`` in the source text, comma-joined) after its own columns."""
    small_batches(docs.sparkSession)
    schema = StructType(list(docs.schema.fields)).add("pii_count", "long").add("pii_spans", "string")
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi in slices(b.column(at)):
                part = b.slice(lo, hi - lo)
                made = [(None, []) if t is None else pseudonymise(t, key) for t in part.column(at).to_pylist()]
                columns = list(part.columns)
                columns[at] = pa.array([m[0] for m in made], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array([len(m[1]) for m in made], pa.int64()), pa.array([",".join(f"{k}:{a}:{e}" for a, e, k, _ in m[1]) for m in made], pa.string())], schema.names)

    return docs.mapInArrow(run, schema)


def op5_pseudonyms(spark, sf_dir: str) -> DataFrame:
    return pseudonyms(documents(spark, sf_dir).select("doc_id", "text"))
