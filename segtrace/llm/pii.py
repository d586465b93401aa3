"""Personal data by anchor expansion.

An Aho-Corasick automaton finds anchors: at-signs, URL schemes, identifier cues, `+`, a digit before a dot, two
digits with at most one blank or hyphen between them, a country's code before a digit. A deterministic parser for
each kind expands an anchor to the left and right, and validates the span (label structure, octets, Luhn, digit
counts, check digits).

Base kinds, leftmost and non-overlapping within a kind: email, ip, card, phone. Further kinds: iban
(mod-97; behind its cue, or anywhere with the length of its country), secret (a credential behind an identifier cue: 16
characters, or 6 behind a password's), login (user information in a URL) and account (a number of 6 to 20 characters
behind an account cue).

One row at a time: no shuffle, no skew; memory is one Arrow batch. A null or empty text has no span,
null ids are kept, repeated rows are judged alike, other columns of df are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import own

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "secret", "login", "account")

# Cues in lower case, by the kind of identifier that may follow.
CUES = {
    "secret": ("api_key", "api-key", "apikey", "access_key", "auth_token", "secret", "token"),
    "password": ("password", "passwd", "passwort", "mot de passe", "contraseña"),
    "account": ("account number", "account no", "acct no", "acct", "kontonummer", "numéro de compte", "número de cuenta", "passport no", "passport number", "ssn"),
    "iban": ("iban",),
}

# Characters in an IBAN, by the code of its country.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20, "ES": 24, "FI": 18, "FR": 27, "GB": 22, "GR": 27,
    "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IS": 26, "IT": 27, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MT": 31, "NL": 18, "NO": 15, "PL": 28, "PT": 25,
    "RO": 24, "RS": 22, "SA": 24, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "TR": 26,
}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGITS = frozenset("0123456789")
_IP = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"[:=\x20]{0,3}([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?)(?![A-Za-z0-9])")
_COUNTRY = re.compile(r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,27}")
_PASSWORD = re.compile(r"[\"']?\x20?(?:[:=]|=>)\x20?(?:\"([^\"\s]{6,})\"|'([^'\s]{6,})'|([^\s\"']{6,}))")
_SECRET = re.compile(r"[\"']?\x20?(?:[:=]|=>)\x20?[\"']?([A-Za-z0-9_\-./+]{16,})")
_ACCOUNT = re.compile(r"\.?[:#=\x20]{1,3}([0-9](?:[\x20-]?[0-9]){5,19})(?![0-9])")
_LOGIN = re.compile(r"[^\s/?#@:\"'<>]+:[^\s/?#@\"'<>]+(?=@[A-Za-z0-9])")


def automaton() -> ahocorasick.Automaton:
    """Anchors; an anchor of several kinds names each."""
    anchors: dict[str, list[tuple[str, int]]] = {}
    for kind, cues in CUES.items():
        for cue in cues:
            anchors.setdefault(cue, []).append((kind, len(cue)))
    for anchor, kind in (("@", "email"), ("://", "login"), ("+", "phone")):
        anchors.setdefault(anchor, []).append((kind, len(anchor)))
    for digit in sorted(_DIGITS):
        anchors.setdefault(f"{digit}.", []).append(("ip", 2))
        for country in IBAN_LENGTHS:
            anchors.setdefault(f"{country.lower()}{digit}", []).append(("country", 3))
        for other in sorted(_DIGITS):
            for between in ("", " ", "-"):
                anchors.setdefault(f"{digit}{between}{other}", []).append(("card", 2 + len(between)))
    found = ahocorasick.Automaton()
    for anchor, kinds in anchors.items():
        found.add_word(anchor, kinds)
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(x - 9 if (x := 2 * int(d)) > 9 else x for d in even)) % 10 == 0


def mod97(iban: str) -> bool:
    turned = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _lower(text: str) -> str:
    """Lower case of the same length, so that offsets stay."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(x if len(x := c.lower()) == 1 else c for c in text)


def _email(text: str, at: int, free: int) -> tuple[int, int] | None:
    start = at
    while start > free and text[start - 1] in _LOCAL:
        start -= 1
    m = _DOMAIN.match(text, at + 1) if start < at else None
    return (start, m.end()) if m else None


def _ip(text: str, at: int, free: int) -> tuple[int, int] | None:
    while at > free and text[at - 1] in _DIGITS:
        at -= 1
    m = _IP.match(text, at)
    return m.span() if m else None


def _country(text: str, at: int) -> tuple[int, int] | None:
    """An IBAN of its country's length, on its own."""
    if (size := IBAN_LENGTHS.get(text[at : at + 2])) is None or (at and text[at - 1].isalnum()) or not (m := _COUNTRY.match(text, at)):
        return None
    end = at
    while size and end < m.end():
        size -= text[end] != " "
        end += 1
    return None if size or text[end : end + 1].isalnum() else (at, end)


def _expand(kind: str, text: str, begin: int, end: int, free: int) -> tuple[int, int] | None:
    """The span that grows from an anchor, or None."""
    if kind == "email":
        return _email(text, begin, free)
    if kind == "ip":
        return _ip(text, begin, free)
    if kind == "country":
        return _country(text, begin)
    if kind in ("card", "phone"):
        m = (_CARD if kind == "card" else _PHONE).match(text, begin)
    else:
        m = {"secret": _SECRET, "password": _PASSWORD, "iban": _IBAN, "login": _LOGIN, "account": _ACCOUNT}[kind].match(text, end)
    return m.span(m.lastindex or 0) if m else None


def _digits(piece: str) -> str:
    return "".join(c for c in piece if c in _DIGITS)


def _valid(kind: str, piece: str) -> bool:
    if kind == "ip":
        return all(len(x.lstrip("0")) <= 3 and int(x[-20:]) <= 255 for x in piece.split("."))
    if kind == "card":
        return 13 <= len(digits := _digits(piece)) <= 19 and luhn(digits)
    if kind == "phone":
        return 9 <= len(_digits(piece)) <= 15
    return kind != "iban" or mod97(piece.replace(" ", ""))


def find_spans(text: str, found: ahocorasick.Automaton) -> dict[str, list[tuple[int, int]]]:
    """Spans in code points, end exclusive, by kind in the order of KINDS, rising within a kind."""
    spans: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    if not text:
        return spans
    free = dict.fromkeys(KINDS, 0)  # where each kind may begin next
    for last, anchors in found.iter(_lower(text)):
        for name, width in anchors:
            kind = {"country": "iban", "password": "secret"}.get(name, name)
            begin = last - width + 1
            if begin < free[kind] or not (span := _expand(name, text, begin, last + 1, free[kind])):
                continue
            good = _valid(kind, text[span[0] : span[1]])
            if good or kind in BASE:
                free[kind] = span[1]  # a match of a base kind that fails validation is consumed too
            if good:
                spans[kind].append(span)
    return spans


def join_spans(spans: dict[str, list[tuple[int, int]]], kinds: tuple[str, ...]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in kinds for a, b in spans[k])


def masked(text: str, spans: dict[str, list[tuple[int, int]]]) -> str:
    """The text with each span replaced by its kind; of overlapping spans the first, then longest, counts."""
    out, at = [], 0
    for a, b, k in sorted(((a, b, k) for k, own_spans in spans.items() for a, b in own_spans), key=lambda x: (x[0], -x[1])):
        if a >= at:
            out += [text[at:a], f"<{k.upper()}>"]
            at = b
        elif b > at:
            at = b
    return "".join([*out, text[at:]])


def pii_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of df: counts of the base kinds, base_spans and all spans as text."""
    rows = own(df, id=id_col, text=text_col)
    names = [id_col, *(f"n_{k}" for k in BASE), "base_spans", "spans"]
    kind = rows.schema["id"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = automaton()
        for batch in batches:
            each = [find_spans(x or "", found) for x in batch.column(1).to_pylist()]
            cols = [pa.array([len(s[k]) for s in each], pa.int64()) for k in BASE]
            cols += [pa.array([join_spans(s, which) for s in each], pa.string()) for which in (BASE, KINDS)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], names=names)

    return rows.mapInArrow(scan, f"`{id_col}` {kind}, " + ", ".join(f"n_{k} long" for k in BASE) + ", base_spans string, spans string")


def pii_report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """pii_spans with base_sha256, the digest of base_spans."""
    found = pii_spans(df, id_col, text_col)
    return found.select(f"`{id_col}`", *(f"n_{k}" for k in BASE), F.sha2("base_spans", 256).alias("base_sha256"), "spans")


def mask_pii(df: DataFrame, text_col: str = "text") -> DataFrame:
    """df with personal data in text_col replaced by <KIND>; the other columns and null texts stay."""

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = automaton()
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            new = [x and masked(x, find_spans(x, found)) for x in batch.column(at).to_pylist()]
            yield batch.set_column(at, batch.schema.field(at), pa.array(new, batch.schema.field(at).type))

    return df.mapInArrow(replace, df.schema)


