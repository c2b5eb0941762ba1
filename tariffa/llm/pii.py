"""Personal data by anchors.

An Aho-Corasick automaton finds the characters and words that every kind of span must hold: at-signs, plus signs,
digits, schemes, and cues of identifiers. From an anchor a deterministic parser walks to both sides and validates.
The base kinds (email, ip, card, phone) follow fixed grammars, leftmost and not overlapping within a kind; the method
adds `account` (an IBAN with valid check digits, or 6 to 34 digits after an account cue, of groups that are never cut), `address` (the mailbox or
number after a mailto: or tel: scheme) and `login` (user and password before the host of a URL, and values of password,
token or key cues). Positions are code points, ends exclusive.

Nulls and empty texts have no spans; equal rows give equal results; an empty table gives an empty one; other columns are
not looked at, or kept as they are by `redact`.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tariffa.llm.common import slices, spread, table, trimmed

BASE = ("email", "ip", "card", "phone")
ADDED = ("account", "address", "login")
KINDS = BASE + ADDED

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_HOST = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789-")
_DIGITS = frozenset("0123456789")
_PHONE = frozenset("0123456789 ().-")
_TOKEN = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_-./+=")
_USERINFO = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-~!$&'()*,;=:")
#: Words before account numbers, and before secrets.
_ACCOUNT_CUES = ("account", "iban", "acct", "konto", "compte", "cuenta")
#: Most digits of an account number.
ACCOUNT_DIGITS = 34
_LOGIN_CUES = ("password", "passwd", "token", "api_key", "apikey", "secret")
_DIALS = ("mailto:", "tel:", "sms:")


def _automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for d in _DIGITS:
        a.add_word(d, ("digit", d))
    a.add_word("@", ("at", "@"))
    a.add_word("+", ("plus", "+"))
    a.add_word("://", ("scheme", "://"))
    for kind, words in (("account", _ACCOUNT_CUES), ("login", _LOGIN_CUES), ("dial", _DIALS)):
        for w in words:
            for form in {w, w.upper(), w.capitalize()}:
                a.add_word(form, (kind, form))
    a.make_automaton()
    return a


_ANCHORS = _automaton()


def _email(text: str, at: int, floor: int) -> tuple[int, int] | None:
    start = at
    while start > floor and text[start - 1] in _LOCAL:
        start -= 1
    if start == at:
        return None
    end, n, labels = at + 1, len(text), 0
    while True:
        begin = end
        while end < n and text[end] in _HOST:
            end += 1
        if end == begin:
            end -= 1  # the dot before it isn't part of the host
            break
        labels += 1
        if end < n and text[end] == ".":
            end += 1
        else:
            break
    return (start, end) if labels >= 2 else None


def _run(text: str, at: int) -> int:
    n = len(text)
    while at < n and text[at] in _DIGITS:
        at += 1
    return at


def _ips(text: str, at: int, found: list[tuple[int, int]]) -> int:
    """Addresses in the run of dotted numbers that begins at a digit; where to go on."""
    parts = []
    end = at
    while True:
        stop = _run(text, end)
        parts.append((end, stop))
        if stop + 1 < len(text) and text[stop] == "." and text[stop + 1] in _DIGITS:
            end = stop + 1
        else:
            break
    for i in range(0, len(parts) - 3, 4):
        if all(b - a < 4 and int(text[a:b]) <= 255 or not text[a:b].lstrip("0") or (b - a >= 4 and len(text[a:b].lstrip("0")) < 4 and int(text[a:b].lstrip("0")) <= 255) for a, b in parts[i : i + 4]):
            found.append((parts[i][0], parts[i + 3][1]))
    return parts[-1][1]


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def _card(text: str, at: int) -> tuple[int, bool]:
    """End of the digits that begin here, single blanks or hyphens between, and whether they are a card."""
    n, end, digits = len(text), at + 1, [text[at]]
    while end < n:
        if text[end] in _DIGITS:
            digits.append(text[end])
            end += 1
        elif text[end] in " -" and end + 1 < n and text[end + 1] in _DIGITS:
            digits.append(text[end + 1])
            end += 2
        else:
            break
    return end, 16 <= len(digits) <= 19 and _luhn("".join(digits))


def _phone(text: str, plus: int) -> tuple[int, bool] | None:
    n = len(text)
    if plus + 1 >= n or text[plus + 1] not in _DIGITS:
        return None
    end = plus + 2
    while end < n and text[end] in _PHONE:
        end += 1
    while text[end - 1] not in _DIGITS:
        end -= 1
    if end - plus < 4:  # a digit, one of the class, a digit
        return None
    return end, 8 <= sum(c in _DIGITS for c in text[plus:end]) <= 15


def _after_cue(text: str, at: int) -> int:
    """Where the value after a cue begins: past a short separator."""
    n, i = len(text), at
    while i < n and i - at < 12 and text[i] in " \t:=#\"'":
        i += 1
    return i if i > at else -1


def _iban(value: str) -> bool:
    v = value.replace(" ", "").upper()
    if not re.fullmatch(r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}", v):
        return False
    return int("".join(str(int(c, 36)) for c in v[4:] + v[:4])) % 97 == 1


def _account(text: str, cue_end: int) -> tuple[int, int] | None:
    at = cue_end
    if (m := re.compile(r"\s?(?:number|no\.?|nr\.?|num\.?|#)", re.I).match(text, at)) is not None:
        at = m.end()
    start = _after_cue(text, at)
    if start < 0:
        return None
    if (m := re.compile(r"[A-Za-z]{2}[0-9]{2}(?: ?[A-Za-z0-9]){11,30}").match(text, start)) is not None:
        value = m[0]
        while value:  # the longest of its prefixes, at group ends, that has valid check digits
            if _iban(value):
                return start, start + len(value)
            value = value.rpartition(" ")[0]
    end, digits, n, group_end = start, 0, len(text), start
    while end < n and text[end] in _DIGITS:
        stop = _run(text, end)
        digits += stop - end
        if digits > ACCOUNT_DIGITS:  # other numbers may follow; a number is never cut
            digits -= stop - end
            break
        group_end = stop
        end = stop + 1 if stop < n and text[stop] in " -" else n
    return (start, group_end) if digits >= 6 else None


def _login(text: str, cue_end: int) -> tuple[int, int] | None:
    n, at = len(text), cue_end
    while at < n and text[at] in "\"' \t":
        at += 1
    if at >= n or text[at] not in "=:" or at - cue_end > 3:
        return None
    start = _after_cue(text, at)
    end = start
    while 0 <= end < n and text[end] in _TOKEN:
        end += 1
    value = text[start:end].rstrip(".")
    return (start, start + len(value)) if len(value) >= 8 and any(c in _DIGITS for c in value) else None


def find_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """Spans of each kind, by start."""
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    ip_from = card_from = phone_from = email_from = 0
    for last, (kind, word) in _ANCHORS.iter(text):
        start = last + 1 - len(word)
        if kind == "digit":
            if start >= ip_from:
                ip_from = _ips(text, start, found["ip"])
            if start >= card_from:
                end, ok = _card(text, start)
                if ok:
                    found["card"].append((start, end))
                card_from = end
        elif kind == "at":
            if span := _email(text, start, email_from):
                found["email"].append(span)
                email_from = span[1]
        elif kind == "plus":
            if start >= phone_from and (span := _phone(text, start)):
                if span[1]:
                    found["phone"].append((start, span[0]))
                phone_from = span[0]
        elif kind == "scheme":
            end = last + 1
            while end < len(text) and text[end] in _USERINFO:
                end += 1
            if end < len(text) and text[end] == "@" and ":" in text[last + 1 : end]:
                found["login"].append((last + 1, end))
        elif kind == "dial":
            end = last + 1
            while end < len(text) and (text[end] in _LOCAL or text[end] == "@"):
                end += 1
            value = text[last + 1 : end].rstrip(".")
            if value and ("@" in value[1:-1] if word.lower() == "mailto:" else sum(c in _DIGITS for c in value) >= 5):
                found["address"].append((last + 1, last + 1 + len(value)))
        elif start == 0 or not text[start - 1].isalnum():
            if span := (_account if kind == "account" else _login)(text, last + 1):
                found[kind].append(span)
    for kind in ADDED:
        found[kind] = _apart(sorted(set(found[kind])))
    return found


def _apart(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s in spans:
        if not out or s[0] >= out[-1][1]:
            out.append(s)
    return out


def joined(found: dict[str, list[tuple[int, int]]], kinds: Iterable[str]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in kinds for a, b in found[k])


def masked(text: str, found: dict[str, list[tuple[int, int]]]) -> str:
    """The text with each union of overlapping spans replaced by the kind of the first of them."""
    spans = sorted((a, -b, KINDS.index(k)) for k, v in found.items() for a, b in v)
    out, at, i = [], 0, 0
    while i < len(spans):
        a, end, kind = spans[i][0], -spans[i][1], KINDS[spans[i][2]]
        while i < len(spans) and spans[i][0] < end:
            end = max(end, -spans[i][1])
            i += 1
        out += [text[at:a], f"<{kind}>"]
        at = end
    return "".join([*out, text[at:]])


def spans_of(docs: DataFrame, keep: Iterable[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """The kept columns with counts of the base kinds, base_sha256 and spans."""
    keep = list(keep)
    made = T.StructType.fromDDL("n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "__text"):
                rows = []
                for x in part.column("__text"):
                    found = find_spans(x.as_py())
                    rows.append((*(len(found[k]) for k in BASE), hashlib.sha256(joined(found, BASE).encode()).hexdigest(), joined(found, KINDS)))
                cols = [pa.array(c, pa.int64() if i < 4 else pa.string()) for i, c in enumerate(zip(*rows, strict=True))]
                yield pa.RecordBatch.from_arrays([part.column(c) for c in keep] + cols, keep + made.names)

    given = docs.select(*keep, F.coalesce(F.col(text).cast("string"), F.lit("")).alias("__text"))
    return spread(given).mapInArrow(run, T.StructType(docs.select(*keep).schema.fields + made.fields))


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """The same rows and columns; in the text each span gives way to its kind in angle brackets. A null text stays null."""
    at, names = docs.columns.index(text), docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                clean = [None if (t := x.as_py()) is None else masked(t, find_spans(t)) for x in part.column(at)]
                cols = list(part.columns)
                cols[at] = pa.array(clean, part.schema.field(at).type)
                yield pa.RecordBatch.from_arrays(cols, names)

    return spread(docs).mapInArrow(trimmed(run), docs.schema)


def op9_pii_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans_of(table(spark, sf_dir, "documents"))
