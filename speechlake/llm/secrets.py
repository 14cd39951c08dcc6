"""Secrets in texts: patterns, and weaker parts of credentials that stand near parts that complete them."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REACH = 200  # code points around a part within which another completes it
BASE = ("assign", "access", "hex")
KINDS = (*BASE, "identifier", "secret", "endpoint")

_SET = r"""["']?\x20*[:=]\x20*["']?"""
# Base patterns. A shorter run of the last two hides no longer one, so their length is in the pattern.
ASSIGN = re.compile(rf"(?ai:password|passwd|secret|token|api_?key){_SET}([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(rb"h{16,}")
_HEX_MARKS = bytes(ord("h") if chr(c) in "0123456789abcdef" else ord(" ") for c in range(256))
# Weak parts.
IDENTIFIER = re.compile(rf"(?ai:\b(?:client_?id|app_?id|access_?key_?id|user_?name|user|login|account)){_SET}([A-Za-z0-9@+/_.=-]{{3,}})")
SECRET = re.compile(rf"(?ai:\b(?:password|passwd|passphrase|pwd|secret|token|api_?key|access_?key|secret_?key|private_?key|auth)){_SET}([A-Za-z0-9+/_.=!@-]{{6,}})")
TOKEN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}")
ADDRESS = re.compile(r"(?ai:https?|ftp|ssh|postgres(?:ql)?|mysql|mongodb|redis|amqps?|s3)://[^\x00-\x20\"'<>\x7F]{3,}")
HOST = re.compile(rf"(?ai:\b(?:hostname|host|server|endpoint|bucket)){_SET}([A-Za-z0-9-]+(?:[.:][A-Za-z0-9-]+)+)")
# Words without which a pattern matches nothing; looked for in the lower-cased text, which is much faster.
_NEEDS = {
    ASSIGN: ("passw", "secret", "token", "api"), IDENTIFIER: ("client", "app", "access", "user", "login", "account"),
    SECRET: ("pass", "pwd", "secret", "token", "key", "auth"), ADDRESS: ("://",), HOST: ("host", "server", "endpoint", "bucket")}
ENTROPY = 3.5  # bits a character that a token without a name needs, and letters of both cases and digits
BLANK = re.compile(r"\n[\x20\t\r]*(?=\n)")


def _entropy(token: str) -> float:
    _, n = np.unique(np.frombuffer(token.encode(), np.uint8), return_counts=True)
    p = n / n.sum()
    return float(-(p * np.log2(p)).sum())


def _random_looking(token: str) -> bool:
    return bool(re.search("[0-9]", token) and re.search("[a-z]", token) and re.search("[A-Z]", token)) and _entropy(token) >= ENTROPY


def _matches(pattern: re.Pattern, text: str, lowered: str) -> Iterator[re.Match]:
    return pattern.finditer(text) if any(w in lowered for w in _NEEDS[pattern]) else iter(())


def base_spans(text: str, lowered: str) -> list[tuple[str, int, int]]:
    """Assignments of 12 characters or more, access identifiers, and runs of hexadecimal digits."""
    found = [("assign", *m.span()) for m in _matches(ASSIGN, text, lowered) if len(m[1]) >= 12]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text)]
    marks = text.encode("ascii", "replace").translate(_HEX_MARKS)  # one byte for each code point
    if b"h" * 16 in marks:
        found += [("hex", *m.span()) for m in HEX.finditer(marks)]
    return found


def _meets(a: np.ndarray, b: np.ndarray, reach: int) -> np.ndarray:
    """Which intervals of ``a`` (rows start, end) come within ``reach`` of one of ``b``: a sorted interval join that keeps no pairs.

    Those of ``b`` that start before the end of a reach are a prefix in order of starts; its largest end decides.
    """
    if not len(a) or not len(b):
        return np.zeros(len(a), bool)
    b = b[np.argsort(b[:, 0], kind="stable")]
    last = np.maximum.accumulate(b[:, 1])
    before = np.searchsorted(b[:, 0], a[:, 1] + reach, side="left")
    return (before > 0) & (last[np.maximum(before, 1) - 1] > a[:, 0] - reach)


def linked_spans(text: str, lowered: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Weak parts that overlap no base span and have what completes them within REACH in the same paragraph.

    An identifier needs a secret, a secret an identifier or an endpoint, an endpoint both of the others. Base spans complete
    weak ones: access identifiers as identifiers, assignments and hexadecimal runs as secrets. Paragraphs end at blank lines.
    """
    strong = {"identifier": [s[1:] for s in base if s[0] == "access"], "secret": [s[1:] for s in base if s[0] != "access"], "endpoint": []}
    weak = {"identifier": [m.span() for m in _matches(IDENTIFIER, text, lowered)],
            "endpoint": [m.span() for p in (ADDRESS, HOST) for m in _matches(p, text, lowered)]}
    if not any((*weak.values(), strong["identifier"])):
        return []  # nothing completes a secret, and secrets alone are not reported
    weak["secret"] = [m.span() for m in _matches(SECRET, text, lowered)] + [m.span() for m in TOKEN.finditer(text) if _random_looking(m[0])]
    breaks = np.array([m.start() for m in BLANK.finditer(text)], np.int64)
    apart = len(text) + 2 * REACH + 2  # paragraphs are moved so far apart that no reach spans two

    def moved(spans) -> np.ndarray:
        at = np.array(list(spans), np.int64).reshape(-1, 2)
        return at + (np.searchsorted(breaks, at[:, 0], side="right") * apart)[:, None]

    taken = moved(s[1:] for s in base)
    parts, whole = {}, {}
    for role, spans in weak.items():
        spans = sorted(set(spans))
        free = ~_meets(moved(spans), taken, 0)
        parts[role] = [s for s, ok in zip(spans, free) if ok]
        whole[role] = moved([*parts[role], *strong[role]])
    near = {(a, b): _meets(moved(parts[a]), whole[b], REACH) for a in parts for b in parts if a != b}
    complete = {"identifier": near["identifier", "secret"], "secret": near["secret", "identifier"] | near["secret", "endpoint"],
                "endpoint": near["endpoint", "identifier"] & near["endpoint", "secret"]}
    return [(role, *s) for role, spans in parts.items() for s, ok in zip(spans, complete[role]) if ok]


def scan_text(text: str) -> list[tuple[str, int, int]]:
    """All spans, by start, then kind as listed in KINDS."""
    lowered = text.lower()
    base = base_spans(text, lowered)
    return sorted(base + linked_spans(text, lowered, base), key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def find_secrets(docs: DataFrame, text: str = "text", out: str = "secrets") -> DataFrame:
    """All columns and ``out``: array of ``(kind, start, end)``, by start, then kind as listed in KINDS.

    Positions count code points from 0, end exclusive. Base spans of a kind do not overlap and always stay; weak ones are
    reported where ``linked_spans`` finds what completes them. Work grows with the length of a text (times a logarithm for its
    parts), whatever parts stand close together. A null or empty text gives an empty array; equal rows give equal rows; a
    column already named ``out`` is replaced. One pass over the rows, no shuffle.
    """

    @F.pandas_udf("array<struct<kind:string,start:long,end:long>>")
    def found(texts: pd.Series) -> pd.Series:
        return pd.Series([[{"kind": k, "start": s, "end": e} for k, s, e in scan_text(t)] if t else [] for t in texts], dtype=object)

    return docs.withColumn(out, found(F.col(text)))


def mask_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with every span replaced by its kind in angle brackets; overlapping spans become one. A null text stays null."""

    @F.pandas_udf("string")
    def masked(texts: pd.Series) -> pd.Series:
        return pd.Series([_masked(t) if t else t for t in texts], dtype=object)

    return docs.withColumn(text, masked(F.col(text))).select(*docs.columns)


def _masked(text: str) -> str:
    done, at = [], 0
    for kind, start, end in scan_text(text):
        if start >= at:
            done += [text[at:start], f"<{kind}>"]
        at = max(at, end)
    return "".join([*done, text[at:]])


def listed(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
