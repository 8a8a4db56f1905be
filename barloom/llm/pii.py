"""Personal data replaced by format-preserving Feistel pseudonyms."""

from __future__ import annotations

import hashlib
import re
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from barloom.llm.arrow import with_columns

ROUNDS = 8
FIRST_DAY, DAYS = date(1900, 1, 1), 73_049  # to the end of 2099

# Alternatives are tried in this order at each place of a text.
PATTERNS = {
    "email": r"(?<![\w.+-])[A-Za-z0-9][\w.+-]{0,63}@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}",
    "secret": r"\bAKIA[0-9A-Z]{16}\b"
              r"|(?i:\b(?:password|passwd|secret|token|api_?key)\s*[=:]\s*[\"']?)[^\s\"']{8,}",
    "ip": r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?![\d.]*\d)",
    "date": r"(?<![\d/.-])(?:\d{4}-\d\d-\d\d|\d\d[./]\d\d[./]\d{4})(?![\d/-])",
    "iban": r"\b[A-Z]{2}\d\d(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b",
    "phone": r"(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{2,4}\)|\d{2,4})(?:[ .-]?\d{2,4}){2,4}(?!\w)"
             r"|(?<![\w+])\(\d{3}\) ?\d{3}-\d{4}(?!\w)|(?<![\w-])\d{3}-\d{3}-\d{4}(?![\w-])",
    "ssn": r"(?<![\w-])\d{3}-\d\d-\d{4}(?![\w-])",
    "card": r"(?<!\w)\d(?:[ -]?\d){12,18}(?!\w)",
}
_FIND = re.compile("|".join(f"(?P<{kind}>{p})" for kind, p in PATTERNS.items()))
# Every pattern needs one of these; texts without are not searched further.
_NEEDED = re.compile(r"[\d@=:]|AKIA").search


def _zero(digit: str) -> str:
    """The 0 of a decimal digit's script: every script has its ten digits in a row."""
    return chr(ord(digit) - int(digit))


def _plain(text: str) -> str:
    """Decimal digits of any script as 0 to 9."""
    return "".join(str(int(c)) if c.isdecimal() else c for c in text)


def _in_script(digits: str, like: str) -> str:
    """Digits 0 to 9 in the scripts of the digits of ``like``, its last one going on."""
    zeros = [_zero(c) for c in like]
    return "".join(chr(ord(zeros[min(k, len(zeros) - 1)]) + int(d)) for k, d in enumerate(digits))


class Pseudonyms:
    """Keyed permutations of the values of each format: equal values have equal pseudonyms."""

    def __init__(self, key: bytes):
        self._key = hashlib.blake2b(key, digest_size=32).digest()

    def _drawn(self, tweak: str, turn: int, half: int, below: int) -> int:
        """A keyed pseudo-random number below ``below``, with 128 bits to spare."""
        size = (below.bit_length() + 7) // 8 + 16
        text = f"{tweak}|{turn}|{half}|{size}".encode()
        stream = b"".join(hashlib.blake2b(text, key=self._key, salt=k.to_bytes(8, "big")).digest()
                          for k in range((size + 63) // 64))
        return int.from_bytes(stream[:size], "big") % below

    def permute(self, value: int, left: int, right: int, tweak: str) -> int:
        """Feistel permutation of range(left x right): the halves take turns to shift each other."""
        a, b = divmod(value, right)
        for turn in range(ROUNDS):
            if turn % 2:
                b = (b + self._drawn(tweak, turn, a, right)) % right
            else:
                a = (a + self._drawn(tweak, turn, b, left)) % left
        return a * right + b

    def characters(self, value: str, tweak: str) -> str:
        """Digits of each script, a-z and A-Z permuted within their classes; the rest stays."""
        spans = [(k, _zero(c), 10) if c.isdecimal() else (k, "a", 26) if "a" <= c <= "z" else
                 (k, "A", 26) for k, c in enumerate(value)
                 if c.isdecimal() or c.isascii() and c.isalnum()]
        sizes, number = [1, 1], 0
        for place, (k, base, radix) in enumerate(spans):
            sizes[place >= len(spans) // 2] *= radix
            number = number * radix + ord(value[k]) - ord(base)
        shape = "".join(base for _, base, _ in spans)
        number = self.permute(number, sizes[0], sizes[1], f"{tweak}|{shape}")
        out = list(value)
        for k, base, radix in reversed(spans):
            number, digit = divmod(number, radix)
            out[k] = chr(ord(base) + digit)
        return "".join(out)

    def day(self, value: date) -> date:
        """Another day of the range, by walking the permutation of 256 x 286 numbers back into it."""
        number = (value - FIRST_DAY).days
        while True:
            number = self.permute(number, 256, 286, "date")
            if number < DAYS:
                return FIRST_DAY + timedelta(days=number)


def luhn_digit(digits: str) -> str:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (2 - k % 2)
        total += n - 9 * (n > 9)
    return str(-total % 10)


def iban_digits(country: str, account: str) -> str:
    number = "".join(str(int(c, 36)) for c in account + country + "00")
    return f"{98 - int(number) % 97:02d}"


def _laid_out(value: str, compact: str) -> str:
    """``compact`` with the separators of ``value`` at their places."""
    rest = iter(compact)
    return "".join(next(rest) if c.isalnum() else c for c in value)


def _replaced(kind: str, value: str, names: Pseudonyms) -> str | None:
    """The pseudonym of a value, or None where it is not valid in its format."""
    compact = "".join(c for c in value if c.isalnum())
    if kind == "email":
        local, at, domain = value.partition("@")
        return names.characters(local, f"email|{domain.lower()}") + at + domain
    if kind == "secret":
        if value.startswith("AKIA"):
            return value[:4] + names.characters(value[4:], "key")
        head = re.match(r"\w+\s*[=:]\s*[\"']?", value).end()
        return value[:head] + names.characters(value[head:], "secret")
    if kind == "ip":
        parts = [int(p) for p in value.split(".")]
        if max(parts) > 255:
            return None
        number = names.permute(int.from_bytes(bytes(parts), "big"), 65_536, 65_536, "ip")
        return ".".join(_in_script(str(n), old) for n, old in zip(number.to_bytes(4, "big"),
                                                                  value.split(".")))
    if kind == "date":
        return _date(value, names)
    if kind == "iban":
        if iban_digits(compact[:2], compact[4:]) != _plain(compact[2:4]):
            return None
        account = names.characters(compact[4:], f"iban|{compact[:2]}")
        check = _in_script(iban_digits(compact[:2], account), compact[2:4])
        return _laid_out(value, compact[:2] + check + account)
    if kind == "card":
        if luhn_digit(compact[:-1]) != _plain(compact[-1]):
            return names.characters(value, "number")
        body = names.characters(compact[:-1], "card")
        return _laid_out(value, body + _in_script(luhn_digit(body), compact[-1]))
    if kind == "phone" and value[0] == "+":
        head = re.match(r"\+\d{1,3}(?=\D)|\+\d", value).end()
        return value[:head] + names.characters(value[head:], f"phone|{value[:head]}")
    return names.characters(value, kind)


def _date(value: str, names: Pseudonyms) -> str | None:
    sign = value[4] if value[4] in "-" else value[2]
    parts = [int(p) for p in value.split(sign)]
    orders = [(0, 1, 2)] if sign == "-" else [(2, 1, 0), (2, 0, 1)]
    for y, m, d in orders:  # day first, else month first
        try:
            new = names.day(date(parts[y], parts[m], parts[d]))
        except ValueError:
            continue
        if not 1900 <= parts[y] <= 2099:
            return None
        shown = {y: f"{new.year:04d}", m: f"{new.month:02d}", d: f"{new.day:02d}"}
        return sign.join(_in_script(shown[k], old) for k, old in enumerate(value.split(sign)))
    return None


def replace(text: str | None, names: Pseudonyms) -> tuple[str | None, int, str]:
    """(text with pseudonyms, number replaced, their kinds sorted and comma-joined)."""
    if not text or not _NEEDED(text):
        return text, 0, ""
    kinds: list[str] = []

    def one(found: re.Match) -> str:
        new = _replaced(found.lastgroup, found.group(), names)
        if new is None:
            return found.group()
        kinds.append(found.lastgroup)
        return new
    return _FIND.sub(one, text), len(kinds), ",".join(sorted(set(kinds)))


def pseudonymise(docs: DataFrame, key: bytes, text_col: str = "text") -> DataFrame:
    """``docs`` with personal data in ``text_col`` replaced, and ``n_pii`` (long), ``pii_kinds``.

    Mail addresses, IPv4 addresses, dates, IBANs, phone numbers, social security numbers, payment
    cards, other runs of 13 to 19 digits, access keys and passwords. Checked formats stay valid: check
    digits are made anew, addresses and days stay in range; a date or IBAN or address that is not
    valid is left as it is. A value maps to the same pseudonym in every document under one key, and
    different values to different ones. Digits of any script count, and are replaced by digits of the
    same script. Null stays null and empty stays empty, with nothing found;
    all rows and other columns stay; columns named n_pii or pii_kinds are replaced.
    """
    fields = [T.StructField(text_col, T.StringType()), T.StructField("n_pii", T.LongType()),
              T.StructField("pii_kinds", T.StringType())]

    def start():
        names = Pseudonyms(key)
        return lambda text: replace(text, names)
    return with_columns(docs, text_col, fields, start)
