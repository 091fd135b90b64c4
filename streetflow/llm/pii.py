"""PII: format-preserving Feistel pseudonyms.

Personal values are found by patterns and validated (check digits, number plans,
calendar).  Each is replaced by another value of the same format: its variable
characters are read as one number below the count of such values and permuted by a
keyed Feistel network on that range, so a value always gets the same pseudonym, in
every document, different values get different ones, and the key's owner can undo it.

* e-mail addresses: letters and digits of all but the last label, each in its kind;
* card numbers (Luhn): all digits but the check digit, which is set anew;
* IBANs (mod 97): letters and digits of the account, check digits set anew;
* phone numbers: ``+1`` and bare North American ones within the number plan, others
  with ``+`` by all digits after the second;
* IPv4 addresses, social security numbers, dates of 1900 to 2099 (as day numbers);
* access keys, and values assigned to a password, secret or token: character by kind.

Defined cases: a null text stays null, an empty one empty; a value that fails its
validation stays; of overlapping finds the leftmost counts, then the order of
``PATTERNS``, and a find that fails leaves its position to the kinds after it; a card,
account or ``+`` number gives up groups at its end that begin a date, address, social
security or phone number, and a run that begins as a phone number is no card;
rows come back one by one with all their columns (an output column that clashes gets
``_`` in front); an empty table gives no rows.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from streetflow.llm.common import fresh, held, slices

ROUNDS = 8

#: Two letters, two check digits and the account; groups of four may be spaced.
IBAN = r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?"
#: The finds by kind, in order of precedence at one position.
PATTERNS = {
    "value": r"(?i:\b(?:password|passwd|pwd|secret|token|api[_-]?key)\b)\s*[=:]\s*[\"']?(?P<value>[^\s\"']{5,}[^\s\"',.;:!?)])",
    "email": r"(?P<email>[A-Za-z0-9](?:[A-Za-z0-9._%+-]{0,62}[A-Za-z0-9_%+-])?@[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,24})",
    "akey": r"\b(?P<akey>A(?:KIA|SIA)[A-Z0-9]{16})\b",
    "iban": r"\b(?P<iban>" + IBAN + r")\b",
    "ip": r"(?<![\d.])(?P<ip>\d{1,3}(?:\.\d{1,3}){3})(?![\d]|\.\d)",
    "date": r"(?<![\d/.-])(?P<date>\d{4}-\d\d-\d\d|\d\d?/\d\d?/\d{4}|\d\d?\.\d\d?\.\d{4})(?![\d/-])",
    "ssn": r"(?<![\d-])(?P<ssn>\d{3}-\d\d-\d{4})(?![\d-])",
    "card": r"(?<!\d)(?P<card>\d(?:[ -]?\d){12,18})(?!\d)",
    "nanp": r"(?<![\d+])(?P<nanp>(?:\+?1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4})(?!\d)",
    "phone": r"(?<![\d+])(?P<phone>\+\d(?:[ ().-]{0,2}\d){7,14})(?!\d)",
}
PATTERN = re.compile("|".join(PATTERNS.values()))
ALONE = {kind: re.compile(p) for kind, p in PATTERNS.items()}
#: Kinds whose groups at the end may be other words, and short kinds that these may be part of.
GROUPED, SHORT = ("card", "iban", "phone"), ("ip", "date", "ssn", "nanp")
#: More than the longest find of a short kind and what it looks at behind.
SHORT_REACH = 24
#: What each kind cannot do without; a text with none of these has no find.
HINT = re.compile(r"[0-9@]|AKIA|ASIA|(?i:password|passwd|pwd|secret|token|api.?key)")

FIRST_DAY, LAST_DAY = dt.date(1900, 1, 1).toordinal(), dt.date(2099, 12, 31).toordinal()


class Permutation:
    """Keyed permutations of ``range(n)``: a Feistel network over two halves of the
    range's digits, walked on while it leaves the range."""

    def __init__(self, key: bytes):
        self.key = hashlib.sha256(key).digest()

    def _round(self, tweak: bytes, i: int, half: int, size: int) -> int:
        more = b"%b|%d|%x" % (tweak, i, half)
        return int.from_bytes(hashlib.shake_256(self.key + more).digest(size.bit_length() // 8 + 9), "big") % size

    def of(self, x: int, n: int, tweak: str, back: bool = False) -> int:
        if n < 2:
            return x
        a = math.isqrt(n - 1) + 1
        b, kind = -(-n // a), f"{tweak}|{n}".encode()
        steps = list(range(ROUNDS))
        while True:
            left, right = divmod(x, b)
            for i in reversed(steps) if back else steps:
                if i % 2 == 0:
                    f = self._round(kind, i, right, a)
                    left = (left - f if back else left + f) % a
                else:
                    f = self._round(kind, i, left, b)
                    right = (right - f if back else right + f) % b
            x = left * b + right
            if x < n:
                return x


def luhn(digits: str) -> int:
    """The Luhn sum modulo 10; 0 for a valid number."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10


def mod97(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


class Pseudonyms:
    def __init__(self, key: bytes, back: bool = False):
        self.permutation, self.back = Permutation(key), back

    def number(self, x: int, n: int, tweak: str) -> int:
        return self.permutation.of(x, n, tweak, self.back)

    def spelled(self, text: str, tweak: str, kinds: tuple[str, ...] = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")) -> str:
        """The text with its characters of these kinds permuted together, each within its kind."""
        where = {c: k for k in kinds for c in k}
        x, n = 0, 1
        for c in text:
            if c in where:
                x, n = x * len(where[c]) + where[c].index(c), n * len(where[c])
        shape = re.sub(r"\w", "x", text)
        x, out = self.number(x, n, f"{tweak}|{shape}"), []
        for c in reversed(text):
            if c in where:
                x, i = divmod(x, len(where[c]))
                c = where[c][i]
            out.append(c)
        return "".join(reversed(out))

    def digits(self, text: str, new: str) -> str:
        """``text`` with its digits replaced by those of ``new``, separators kept."""
        it = iter(new)
        return "".join(next(it) if c.isdigit() else c for c in text)

    # one method for each kind: the pseudonym, or None if the value is not valid
    def email(self, s: str) -> str | None:
        name, top = s.rsplit(".", 1)
        return f"{self.spelled(name, 'email')}.{top}"

    def akey(self, s: str) -> str | None:
        return s[:4] + self.spelled(s[4:], "akey", ("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789",))

    def value(self, s: str) -> str | None:
        if re.fullmatch(r"[0-9a-f]+", s):
            return self.spelled(s, "hex", ("0123456789abcdef",))
        return self.spelled(s, "value")

    def iban(self, s: str) -> str | None:
        plain = s.replace(" ", "")
        if not 15 <= len(plain) <= 34 or mod97(plain) != 1:
            return None
        account = self.spelled(plain[4:], "iban" + plain[:2])
        new = f"{plain[:2]}{98 - mod97(plain[:2] + '00' + account):02d}{account}"
        it = iter(new)
        return "".join(c if c == " " else next(it) for c in s)

    def ip(self, s: str) -> str | None:
        parts = s.split(".")
        if any(int(p) > 255 or (p[0] == "0" and p != "0") for p in parts):
            return None
        x = self.number(int.from_bytes(bytes(map(int, parts)), "big"), 1 << 32, "ip")
        return ".".join(map(str, x.to_bytes(4, "big")))

    def date(self, s: str) -> str | None:
        """Year-month-day; otherwise day first where that is a date, else month first."""
        sep = re.search(r"\D", s)[0]
        parts = s.split(sep)

        def read(text: list[str]) -> tuple[int, bool] | None:
            a, b, c = map(int, text)
            for y, m, d, day_first in ([(a, b, c, True)] if len(text[0]) == 4 else [(c, b, a, True), (c, a, b, False)]):
                try:
                    day = dt.date(y, m, d).toordinal()
                except ValueError:
                    continue
                return (day, day_first) if FIRST_DAY <= day <= LAST_DAY else None
            return None

        known = read(parts)
        if known is None:
            return None
        day, day_first = known
        padded = all(len(p) >= 2 for p in parts)
        while True:  # walk on until the date is written in the same way
            day = FIRST_DAY + self.number(day - FIRST_DAY, LAST_DAY - FIRST_DAY + 1, "date")
            at = dt.date.fromordinal(day)
            y, m, d = f"{at.year:04d}", *((f"{at.month:02d}", f"{at.day:02d}") if padded else (str(at.month), str(at.day)))
            new = [y, m, d] if len(parts[0]) == 4 else [d, m, y] if day_first else [m, d, y]
            if read(new) == (day, day_first) and (padded or any(len(p) < 2 for p in new)):
                return sep.join(new)

    def ssn(self, s: str) -> str | None:
        def valid(a: int, b: int, c: int) -> bool:
            return 0 < a < 900 and a != 666 and b > 0 and c > 0

        x = int(s.replace("-", ""))
        if not valid(*map(int, s.split("-"))):
            return None
        while True:
            x = self.number(x, 10**9, "ssn")
            new = f"{x:09d}"
            if valid(int(new[:3]), int(new[3:5]), int(new[5:])):
                return f"{new[:3]}-{new[3:5]}-{new[5:]}"

    def card(self, s: str) -> str | None:
        plain = re.sub(r"\D", "", s)
        if len(plain) < 13 or luhn(plain) or len(set(plain)) == 1:
            return None
        body = f"{self.number(int(plain[:-1]), 10 ** (len(plain) - 1), 'card'):0{len(plain) - 1}d}"
        return self.digits(s, f"{body}{-luhn(body + '0') % 10}")

    def nanp(self, s: str) -> str | None:
        """Ten digits; numbers within the plan (area and exchange from 200) stay within, others without."""
        plain = re.sub(r"\D", "", s)

        def planned(x: int) -> bool:
            return x >= 2 * 10**9 and x // 10**4 % 1000 >= 200

        known = x = int(plain[-10:])
        while True:
            x = self.number(x, 10**10, "nanp")
            if planned(x) == planned(known):
                return self.digits(s, f"{plain[:-10]}{x:010d}")

    def phone(self, s: str) -> str | None:
        plain = re.sub(r"\D", "", s)
        if not 8 <= len(plain) <= 15:
            return None
        n = len(plain) - 2
        return self.digits(s, plain[:2] + f"{self.number(int(plain[2:]), 10**n, 'phone' + plain[:2]):0{n}d}")

    def splits(self, text: str, kind: str, begin: int, end: int) -> bool:
        """Whether a find of a short kind begins in ``text[begin:end]`` and goes on behind it,
        or for a card is a phone number at its beginning (no card is grouped so)."""
        if kind == "card" and ALONE["nanp"].match(text, begin):
            return True
        for short in SHORT:
            at = begin
            while (m := ALONE[short].search(text, at, end + SHORT_REACH)) and m.start() < end:
                if m.end() > end and getattr(self, short)(m[short]) is not None:
                    return True
                at = m.start() + 1
        return False

    def replaced(self, text: str, kind: str, begin: int, end: int) -> tuple[str, int] | None:
        """(pseudonym, end) of the find ``text[begin:end]``, less groups at its end that
        make it invalid or part another find; None if it is not valid."""
        if kind not in GROUPED:
            new = getattr(self, kind)(text[begin:end])
            return None if new is None else (new, end)
        longest = None
        while True:
            new = getattr(self, kind)(text[begin:end])
            if new is not None:
                if not self.splits(text, kind, begin, end):
                    return new, end
                longest = longest or (new, end)
            cut = re.match(r"(.*\w)[ ().-]+\w", text[begin:end])
            if cut is None:
                return None if kind == "card" else longest
            end = begin + len(cut[1])

    def text(self, text: str) -> tuple[str, list[tuple[int, int, str]]]:
        """The text with its finds replaced, and (start, length, kind) of each."""
        if not HINT.search(text):
            return text, []
        out, spans, at = [], [], 0
        pos = 0
        while m := PATTERN.search(text, pos):
            kind = m.lastgroup
            found = self.replaced(text, kind, *m.span(kind))
            if found is None:  # not valid: a later kind at the same position may be
                for kind in ORDER[ORDER.index(kind) + 1 :]:
                    if (n := ALONE[kind].match(text, m.start())) and (found := self.replaced(text, kind, *n.span(kind))):
                        m = n
                        break
            if found is None:
                pos = m.start() + 1
                continue
            begin, (new, end) = m.start(kind), found
            out += [text[at:begin], new]
            spans.append((begin, end - begin, kind))
            at = pos = end
        return "".join(out) + text[at:], spans


ORDER = list(PATTERNS)
#: Bytes of text that a task turns into Python objects at once.
SLICE_BYTES = 4 << 20
KINDS = ["email", "card", "iban", "nanp", "phone", "ip", "ssn", "date", "akey", "value"]


def pseudonymize(
    docs: DataFrame, key: bytes, text_col: str = "text", names: tuple[str, str] = ("n_replaced", "kinds")
) -> DataFrame:
    """``docs`` with pseudonyms in ``text_col``, the number of replaced values, and the
    kinds found as ``kind:count`` in ascending order, joined by commas."""
    at, taken = docs.columns.index(text_col), list(docs.columns)
    fields = []
    for name, kind in zip(names, (IntegerType(), StringType()), strict=True):
        fields.append(StructField(fresh(name, taken), kind))
        taken.append(fields[-1].name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = held("pii", key, lambda: Pseudonyms(key))
        for batch in (part for whole in batches for part in slices(whole, text_col, SLICE_BYTES)):
            texts, n, kinds = [], [], []
            for text in batch.column(at).to_pylist():
                new, spans = names.text(text) if text else (text, [])
                texts.append(new)
                n.append(len(spans))
                kinds.append(",".join(f"{k}:{c}" for k, c in sorted(Counter(s[2] for s in spans).items())))
            columns = list(batch.columns)
            columns[at] = pa.array(texts, columns[at].type)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n, pa.int32()), pa.array(kinds, pa.string())], names=[*batch.schema.names, *(f.name for f in fields)])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, *fields]))
