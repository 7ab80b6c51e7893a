"""PII: format-preserving pseudonyms from a keyed Feistel network.

A text is read once from left to right and each value found belongs to one kind: mail addresses, secrets
(values after password=, secret=, token=, api_key= or the like, also as JSON, with a quote before the colon; what
follows Bearer; keys that begin with AKIA, sk-, ghp_ or its kin), phone numbers, cards, dates, social security numbers and IPv4 addresses. Numbers are validated (Luhn for cards, ranges
for social security numbers and addresses, the calendar for dates of 1900 to 2099; phone numbers may have any area
code and exchange). A value is a number in the domain of its format, and the network permutes that domain under a
key. The result has the same format and passes the same validation, equal values get equal pseudonyms in every
document and different ones different. A pseudonym is found where its value was and as the same kind, so the key's
holder can turn texts back. A mail address's local part is permuted as a whole, each character within its class
(small letter, capital, digit), and so are its host and any secret that isn't hexadecimal. Values of more than
CHUNK characters are permuted chunk by chunk, once forwards and once backwards, each chunk under a hash of those before
or after it: time is linear, and every character of the pseudonym depends on every one of the value.

Not covered: names, postal addresses, phone numbers without separators or of other countries' forms, IBAN, IPv6,
secrets in other forms. A part of one or two letters has a small domain: it is hidden from readers, not from guessing.

Texts are rewritten where they lie: no shuffle and no table of values.

Defined results: null stays null, and a text without values stays as it is. Texts and values may have any length. Rows that repeat are
rewritten alike, no rows give none. Other columns are ignored.
"""

from __future__ import annotations

import datetime
import hashlib
import math
import re
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from wickwork.llm.base import table

ROUNDS = 8
#: Characters of a long value that are permuted at once, and bits of a domain up to which a round's function has its short form.
CHUNK, SHORT_BITS = 128, 256
KINDS = ("card", "phone", "ssn", "ip", "date", "email", "secret")
LOWER, UPPER, DIGITS, HEX = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "0123456789abcdef"
FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()

# The patterns. Named groups are the kinds.
SECRET_NAME = r"(?i:password|passwd|pwd|secret|api[_-]?key|access_token|token)"
PATTERN = re.compile(
    r"(?P<email>(?<![\w.%+-])(?P<local>[A-Za-z0-9._%+-]+)@(?P<host>(?:[A-Za-z0-9-]+\.)+)[A-Za-z]{2,}(?!\w))"
    r"|(?P<secret>\b(?:"
    r"(?P<name>" + SECRET_NAME + r"[\"']?\s*[=:]\s*[\"']?)(?:(?P<hex>[0-9a-f]{8,}|[0-9A-F]{8,})(?![\w&!@#$%^*+~-])|(?P<word>(?=[A-Za-z&!@#$%^*_+~-]*[0-9])(?=[0-9&!@#$%^*_+~-]*[A-Za-z])[\w&!@#$%^*+~-]{8,}))"
    r"|(?P<bearer>(?i:bearer)\s+)(?P<ticket>(?=[A-Za-z._~+/-]*[0-9])(?=[0-9._~+/-]*[A-Za-z])[\w.~+/-]{8,}=*)"
    r"|(?P<key>AKIA)(?P<tail>[0-9A-Z]{16})\b|(?P<brand>sk-|gh[pousr]_)(?P<sk>[A-Za-z0-9]{16,})\b))"
    r"|(?<![\w.+-])(?:"
    r"(?P<phone>(?:\+1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4})"
    r"|(?P<card>[0-9]{13,19}|[0-9]{4}(?P<gap>[ -])[0-9]{4}(?P=gap)[0-9]{4}(?P=gap)[0-9]{4}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})"
    r"|(?P<date>[0-9]{4}-[0-9][0-9]-[0-9][0-9]|[0-9][0-9](?P<sep>[/.])[0-9][0-9](?P=sep)[0-9]{4})"
    r"|(?P<ssn>[0-9]{3}-[0-9][0-9]-[0-9]{4})"
    r"|(?P<ip>[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.[0-9])))(?!\w)"
)
#: What every value holds that has no secret's name before it.
SIGN = re.compile(r"[@0-9]")


class Feistel:
    """Keyed permutations of range(n), one for each tag and n; out-of-range results are walked on."""

    def __init__(self, key: bytes) -> None:
        self.key = key
        self.permute = lru_cache(100_000)(self._permute)

    def _round(self, tag: str, n: int, i: int, half: int, size: int) -> int:
        if n.bit_length() <= SHORT_BITS:
            return int.from_bytes(hashlib.blake2b(f"{tag}|{n}|{i}|{half}".encode(), key=self.key, digest_size=24).digest(), "big") % size
        # as many bits as the half has and 64 more, so that none stays where it is and no residue is likelier than another
        number = lambda x: (b := x.to_bytes(x.bit_length() // 8 + 1, "big")) and len(b).to_bytes(8, "big") + b
        seed = hashlib.blake2b(tag.encode() + b"|" + number(n) + number(i) + number(half), key=self.key, digest_size=32).digest()
        return int.from_bytes(hashlib.shake_256(seed).digest((size.bit_length() + 64) // 8 + 1), "big") % size

    def _permute(self, tag: str, n: int, x: int, back: bool = False) -> int:
        a = math.isqrt(n - 1) + 1
        b = -(-n // a)
        while True:
            left, right = divmod(x, b)
            for i in reversed(range(ROUNDS)) if back else range(ROUNDS):
                sign = -1 if back else 1
                if i % 2:
                    right = (right + sign * self._round(tag, n, i, left, b)) % b
                else:
                    left = (left + sign * self._round(tag, n, i, right, a)) % a
            x = left * b + right
            if x < n:
                return x

    def text(self, tag: str, s: str, alphabets: Sequence[str], back: bool = False) -> str:
        """s, whose characters are each in the alphabet of their place, permuted among all such texts."""
        if not s:
            return s
        if len(s) > CHUNK:
            return self._chunks(tag, s, alphabets, back)
        x, n, out = 0, 1, []
        for c, a in zip(s, alphabets, strict=True):
            x, n = x * len(a) + a.index(c), n * len(a)
        x = self.permute(tag, n, x, back)
        for a in reversed(alphabets):
            x, c = divmod(x, len(a))
            out.append(a[c])
        return "".join(reversed(out))

    def _chunks(self, tag: str, s: str, alphabets: Sequence[str], back: bool) -> str:
        """A long text in two passes over its chunks; turned back, each pass finds the chunks that it was keyed with as they were."""
        form = hashlib.blake2b("\n".join([tag, *alphabets]).encode(), digest_size=16).hexdigest()
        at = range(0, len(s), CHUNK)
        parts, own = [s[i : i + CHUNK] for i in at], [alphabets[i : i + CHUNK] for i in at]
        passes = [("forth", list(range(len(parts)))), ("back", list(reversed(range(len(parts)))))]
        for name, order in reversed(passes) if back else passes:
            seen = hashlib.blake2b(f"{name} {form} {len(s)}".encode(), digest_size=16)
            for i in order:
                new = self.text(f"{name} {form} {i} {seen.hexdigest()}", parts[i], own[i], back)
                seen.update((parts[i] if back else new).encode())
                parts[i] = new
        return "".join(parts)

    def classes(self, tag: str, s: str, back: bool = False) -> str:
        """Small letters, capitals and digits of s, each within its class and all together; other characters stay."""
        own = [next((a for a in (LOWER, UPPER, DIGITS) if c in a), c) for c in s]
        form = "".join(a[0] for a in own)
        return self.text(f"{tag} {form}", s, own, back)


def _filled(form: str, digits: str) -> str:
    """form with its digits replaced in order."""
    it = iter(digits)
    return "".join(next(it) if c in DIGITS else c for c in form)


def _digits(s: str) -> str:
    return "".join(c for c in s if c in DIGITS)


def luhn(digits: str) -> int:
    """The check digit that follows these digits."""
    return -sum(sum(divmod(2 * int(c), 10)) if i % 2 == 0 else int(c) for i, c in enumerate(reversed(digits))) % 10


def card(f: Feistel, s: str, back: bool) -> str | None:
    d = _digits(s)
    if luhn(d[:-1]) != int(d[-1]) or len(set(d)) == 1:
        return None
    body = d[0] + f.text("card", d[1:-1], [DIGITS] * (len(d) - 2), back)
    return _filled(s, body + str(luhn(body)))


def phone(f: Feistel, s: str, back: bool) -> str | None:
    d = _digits(s)
    head, d = d[:-10], d[-10:]
    # codes below 200 aren't assigned but written all the same: each of the four forms permutes among itself
    low, size = zip(*((200, 800) if int(p) >= 200 else (0, 200) for p in (d[:3], d[3:6])), strict=True)
    tag = "phone" if low == (200, 200) else f"phone {low[0]} {low[1]}"
    x = f.permute(tag, size[0] * size[1] * 10_000, ((int(d[:3]) - low[0]) * size[1] + int(d[3:6]) - low[1]) * 10_000 + int(d[6:]), back)
    return _filled(s, f"{head}{x // (size[1] * 10_000) + low[0]:03d}{x // 10_000 % size[1] + low[1]:03d}{x % 10_000:04d}")


def ssn(f: Feistel, s: str, back: bool) -> str | None:
    areas = [a for a in range(1, 900) if a != 666]
    area, group, serial = (int(p) for p in s.split("-"))
    if area not in areas or not group or not serial:
        return None
    x = f.permute("ssn", len(areas) * 99 * 9999, (areas.index(area) * 99 + group - 1) * 9999 + serial - 1, back)
    return f"{areas[x // (99 * 9999)]:03d}-{x // 9999 % 99 + 1:02d}-{x % 9999 + 1:04d}"


def ip(f: Feistel, s: str, back: bool) -> str | None:
    parts = [int(p) for p in s.split(".")]
    if max(parts) > 255 or any(p != str(int(p)) for p in s.split(".")):
        return None
    x = f.permute("ip", 1 << 32, int.from_bytes(bytes(parts), "big"), back)
    return ".".join(map(str, x.to_bytes(4, "big")))


def date(f: Feistel, s: str, back: bool) -> str | None:
    p = [int(x) for x in re.split(r"\D", s)]
    year, month, day = p if "-" in s else (p[2], p[1], p[0])
    swapped = "-" not in s and month > 12  # month first
    if swapped:
        month, day = day, month
    try:
        x = datetime.date(year, month, day).toordinal()
    except ValueError:
        return None
    if not FIRST_DAY <= x <= LAST_DAY:
        return None
    if "-" in s:
        return datetime.date.fromordinal(FIRST_DAY + f.permute("date", LAST_DAY - FIRST_DAY + 1, x - FIRST_DAY, back)).isoformat()
    # day/month and month/day can only be told apart after day 12, so each of the three forms permutes among itself
    form = "month first" if swapped else "day first" if day > 12 else "either"
    while True:
        x = FIRST_DAY + f.permute("date " + form, LAST_DAY - FIRST_DAY + 1, x - FIRST_DAY, back)
        new = datetime.date.fromordinal(x)
        if (new.day > 12) == (form != "either"):
            a, b = (new.month, new.day) if swapped else (new.day, new.month)
            return _filled(s, f"{a:02d}{b:02d}{new.year:04d}")


VALUES: dict[str, Callable[[Feistel, str, bool], str | None]] = {"card": card, "phone": phone, "ssn": ssn, "ip": ip, "date": date}


def _walked(step: Callable[[str], str], s: str, fits: Callable[[str], bool]) -> str:
    """step again and again until the result fits, as s does; the inverse step then leads back."""
    s = step(s)
    while not fits(s):
        s = step(s)
    return s


def hexadecimal(f: Feistel, s: str, back: bool) -> str:
    small = s.lower() == s  # digits alone count as small
    alphabet = HEX if small else HEX.upper()
    return _walked(lambda x: f.text("hex" if small else "HEX", x, [alphabet] * len(x), back), s, lambda x: small or x.lower() != x)


def email(f: Feistel, m: re.Match, back: bool) -> str:
    return f"{f.classes('mail', m['local'], back)}@{f.classes('host', m['host'], back)}{m[0][len(m['local']) + 1 + len(m['host']) :]}"


def secret(f: Feistel, m: re.Match, back: bool) -> str:
    if m["key"]:
        return m["key"] + f.text("key", m["tail"], [DIGITS + UPPER] * 16, back)
    if m["sk"]:
        return m["brand"] + f.classes(m["brand"].rstrip("-_"), m["sk"], back)
    if m["ticket"]:
        return m["bearer"] + f.classes("ticket", m["ticket"], back)
    if m["hex"]:
        return m["name"] + hexadecimal(f, m["hex"], back)
    # must not become hexadecimal, or it would be turned back as such
    return m["name"] + _walked(lambda x: f.classes("word", x, back), m["word"], lambda x: not re.fullmatch("[0-9a-f]{8,}|[0-9A-F]{8,}", x))


def rewrite(f: Feistel, text: str, counts: dict[str, int] | None = None, back: bool = False) -> str:
    """text with its values replaced; with back, pseudonyms turned into the values again."""

    def value(m: re.Match) -> str:
        kind = next(k for k in KINDS if m[k])
        new = email(f, m, back) if kind == "email" else secret(f, m, back) if kind == "secret" else VALUES[kind](f, m[0], back)
        if new is None:
            return m[0]
        if counts is not None:
            counts[kind] = counts.get(kind, 0) + 1
        return new

    return PATTERN.sub(value, text) if SIGN.search(text) or re.search(SECRET_NAME, text) else text


def pseudonymised(docs: DataFrame, key: bytes) -> DataFrame:
    """Per row: doc_id, text rewritten, and how many values of each kind were replaced."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = Feistel(key)
        for batch in batches:
            texts, found = [], []
            for text in batch.column("text").to_pylist():
                counts: dict[str, int] = {}
                texts.append(None if text is None else rewrite(f, text, counts))
                found.append(counts)
            columns = [pa.array([c.get(k, 0) for c in found], pa.int64()) for k in KINDS]
            yield pa.record_batch([batch.column("doc_id"), pa.array(texts, pa.string()), *columns], ["doc_id", "text", *(f"n_{k}" for k in KINDS)])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, text string, " + ", ".join(f"n_{k} long" for k in KINDS))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key here is a fixed one, so that reruns agree; a production job passes its own."""
    return pseudonymised(table(spark, sf_dir, "documents"), b"wickwork example key")
