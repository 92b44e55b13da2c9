"""Secrets: fixed key patterns, and sliding-window Shannon entropy over candidate strings.

Candidate strings are runs of key-like characters.  A window slides over each; its character
counts change by one in and one out per step, and with them the sum of c*log2(c) from
which the entropy follows.  Every character class (hex, letters and digits, base64) has its own
alphabet and threshold.  Windows above their threshold are merged into spans of kind
``entropy``.  Pattern spans are cut out of a candidate first, as are its delimited pieces that hold a word of
documentation samples; what is left counts by itself unless the allow list knows it (identifiers, runs of
the alphabet, plain words).  A string shorter than a window is one window, its threshold lowered with the
largest entropy of its length.

The allow list also knows names and addresses: camel-case words, perhaps with a number behind them; paths and
file names, that is, delimited pieces of which half at least are words or short numbers and no other one is as long as a
candidate; and checksums that say so (``sha512-...``).

Null and empty texts have no spans.  Ties: spans are ordered by start, then kind as listed in
``KINDS``.  Repeated rows give repeated results; columns named like a result are replaced.  An empty table
gives an empty result.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField

from dimwright.llm.common import add_columns, table
from dimwright.llm.spans import SPANS, digest_columns

BASE_KINDS = ("assign", "access", "hex")
KINDS = BASE_KINDS + ("entropy",)

#: characters in a window, and the entropy (bits) from which a window of a class counts
WINDOW = 24
#: characters of the shortest candidate
SHORTEST = 16
#: class name, its characters, threshold; the first class that holds every character applies
CLASSES = (
    ("hex", frozenset("0123456789abcdefABCDEF"), 3.0),
    ("alnum", frozenset("0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"), 3.9),
    ("base64", frozenset("0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/_=-"), 4.0),
)

_ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
_ASSIGN_HINT = re.compile(r"pass|secret|token|api", re.I)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
_CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}")
_PIECE = re.compile(r"[A-Za-z0-9]+")

_ALLOWED = re.compile(
    r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"  # identifier in uuid form
    r"|[A-Za-z]+"                                  # one long word
    r"|[0-9]+"                                     # a number
    r"|(?:[A-Za-z]+[-_/+=]+)+[A-Za-z0-9]{0,8}"     # words joined by dashes, underscores or slashes
    r"|[-_=+/]+")                                  # a ruler
_SAMPLE = re.compile(r"example|sample|dummy|placeholder|xxxxxx|changeme|abcdefgh|12345678", re.I)

_CHECKSUM = re.compile(r"(?:^|[=/])(?:sha[0-9]{1,3}|md5)[-=]")
_LOWER_RUN = re.compile(r"[a-z]+")
_CAPITALS = re.compile(r"[A-Z]{5}")

_CLOGC = [0.0] + [c * math.log2(c) for c in range(1, WINDOW + 1)]


def window_class(counts: dict[str, int]) -> float:
    """Entropy threshold of the narrowest class that holds every character of the window."""
    for _, chars, threshold in CLASSES:
        if all(c in chars for c in counts):
            return threshold
    return math.inf


def entropy_spans(text: str) -> list[tuple[int, int]]:
    """Merged windows of high entropy inside one candidate string."""
    window = max(1, min(WINDOW, len(text)))
    most, scale = math.log2(window), math.log2(window) / math.log2(WINDOW)
    counts: dict[str, int] = {}
    total, out = 0.0, []
    for i, ch in enumerate(text):
        c = counts.get(ch, 0)
        total += _CLOGC[c + 1] - _CLOGC[c]
        counts[ch] = c + 1
        if i >= window:
            old = text[i - window]
            c = counts[old]
            total += _CLOGC[c - 1] - _CLOGC[c]
            if c == 1:
                del counts[old]
            else:
                counts[old] = c - 1
        if i >= window - 1 and most - total / window >= window_class(counts) * scale:
            start = i - window + 1
            if out and start <= out[-1][1]:
                out[-1] = (out[-1][0], i + 1)
            else:
                out.append((start, i + 1))
    return out


def sample_spans(text: str) -> list[tuple[int, int]]:
    """Delimited pieces that hold a sample's word and less than two windows besides (in more it stands by chance)."""
    if not _SAMPLE.search(text):
        return []
    return [p.span() for p in _PIECE.finditer(text)
            if (found := _SAMPLE.findall(p.group())) and len(p.group()) - sum(map(len, found)) < 2 * WINDOW]


def wordlike(piece: str) -> bool:
    """Letters, perhaps a number of up to four digits behind them, in runs of lower case as long as words have, or all capitals."""
    letters = piece.rstrip("0123456789")
    if not letters.isalpha() or len(piece) - len(letters) > 4:
        return not letters and len(piece) <= 4
    runs = _LOWER_RUN.findall(letters)
    return letters.isupper() and len(letters) < SHORTEST or sum(map(len, runs)) >= 2.7 * len(runs) > 0 and not _CAPITALS.search(letters)


def ordinary(text: str) -> bool:
    """Whether a candidate is no secret by its form: the allow list, a checksum, a name, or a path of words."""
    if _ALLOWED.fullmatch(text) or _CHECKSUM.search(text):
        return True
    pieces = _PIECE.findall(text)
    words = sum(map(wordlike, pieces))
    return words * 2 >= len(pieces) and not any(len(p) >= SHORTEST and not wordlike(p) for p in pieces)


def remainders(start: int, end: int, cuts: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """What of a span lies outside all (ordered) cuts."""
    out = []
    for a, b in cuts:
        if a < end and start < b:
            out.append((start, a))
            start = b
    return [(a, b) for a, b in out + [(start, end)] if a < b]


def scan(text: str | None) -> list[tuple[str, int, int, bool]]:
    """All spans of a text: (kind, start, end, base)."""
    if not text:
        return []
    found = []
    if _ASSIGN_HINT.search(text):
        found += [("assign", *m.span(), True) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
    if "AKIA" in text:
        found += [("access", *m.span(), True) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [("hex", *m.span(), True) for m in _HEX.finditer(text)]
    covered = sorted((s, e) for _, s, e, _ in found)
    for m in _CANDIDATE.finditer(text):
        if ordinary(m.group()):
            continue
        cuts = sorted(covered + [(s + m.start(), e + m.start()) for s, e in sample_spans(m.group())])
        for start, end in remainders(*m.span(), cuts):
            start += len(text[start:end]) - len(text[start:end].lstrip("+/_=-")) if start > m.start() else 0
            if end - start >= SHORTEST and not ordinary(text[start:end]):
                found += [("entropy", s + start, e + start, False) for s, e in entropy_spans(text[start:end])]
    return sorted(found, key=lambda f: (f[1], KINDS.index(f[0]), f[2]))


def find_secrets(df: DataFrame, text_col: str = "text", out_col: str = "secrets") -> DataFrame:
    """Append ``out_col``: array of (kind, start, end, base) per row."""
    return add_columns(df, [text_col], [StructField(out_col, SPANS)], lambda: lambda texts: [(scan(t),) for t in texts])


def mask(text: str | None, marker: str = "<secret>") -> str | None:
    """The text with every secret replaced; overlapping spans become one marker."""
    spans = scan(text)
    if not spans:
        return text
    out, at = [], 0
    for _, s, e, _ in spans:
        if s >= at:
            out += [text[at:s], marker]
        at = max(at, e)
    return "".join(out) + text[at:]


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = add_columns(docs, ["text"], [StructField("secrets", SPANS)],
                        lambda: lambda texts: [(scan(t),) for t in texts], keep=["doc_id"])
    return found.select("doc_id", *[c.alias(n) for n, c in digest_columns("secrets", BASE_KINDS).items()])
