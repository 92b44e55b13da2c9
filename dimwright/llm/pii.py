"""Personal data by weak supervision.

Candidates come from fixed patterns (``email``, ``ip``, ``card``, ``phone``: the base kinds) and
from looser ones (``local_phone``, ``id_number``, ``iban``, ``masked_email``, ``person``).
Labelers of three sorts vote on each: pattern checks (checksum, ranges, digit count), gazetteers
(domain endings, issuer prefixes, given names) and context (cue words before it, the
neighbouring characters).  A vote is 1 (personal), -1 (not) or 0 (no opinion).

The corpus-wide counts of (kind, votes, length class) form a table whose size is bounded by
the labelers, not by the corpus.  Expectation-maximisation on it estimates each labeler's
reliability per kind and a posterior per cell; a logistic span classifier is then fitted to those
posteriors over votes, kind and length.  Base candidates that pass their checks always stay;
of the others those with a probability of at least one half are added.

Null and empty texts have no spans.  Spans are ordered by start, then kind as in ``KINDS``.
Repeated rows give repeated results and count repeatedly; other columns are not read.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BooleanType, LongType, StringType, StructField,
                               StructType)

from dimwright.llm.common import add_columns, bounded_rows, save_table, table
from dimwright.llm.spans import digest_columns

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = BASE_KINDS + ("local_phone", "id_number", "iban", "masked_email", "person")
LABELERS = ("check", "gazetteer", "cue", "edges", "variety")

#: characters of context in front of a candidate
CONTEXT = 40

# Gazetteers and cue words
ENDINGS = frozenset("com org net edu gov info biz io de fr es it nl uk eu us ca au jp cn ru br in ch at be pl se no "
                    "fi dk pt gr cz hu ro ie nz mx ar cl co za kr tv me".split())
GIVEN_NAMES = frozenset("anna anne maria marie peter paul john james mary robert michael william david thomas sarah "
                        "laura julia emma lena hans klaus jean pierre luis carlos juan jose carmen ana pedro lucas "
                        "sofia olivia noah liam karl fritz claire sophie nicolas antoine martin daniel susan linda".split())
CUES = {
    "email": "mail e-mail email contact write reach correo courriel kontakt",
    "masked_email": "mail e-mail email contact write reach correo courriel kontakt",
    "ip": "ip host server address login addr client adresse",
    "card": "card visa mastercard amex credit payment karte carte tarjeta",
    "phone": "call phone tel telephone mobile fax cell telefon teléfono téléphone",
    "local_phone": "call phone tel telephone mobile fax cell telefon teléfono téléphone",
    "id_number": "ssn social security id passport ausweis dni",
    "iban": "iban account bank konto compte cuenta",
    "person": "name dear from by signed patient",
}
AGAINST = "version isbn issn order page section chapter figure sku part build rev release doi invoice"
_CUES = {k: re.compile(r"\b(?:" + "|".join(map(re.escape, v.split())) + r")\b", re.I) for k, v in CUES.items()}
_AGAINST = re.compile(r"\b(?:" + "|".join(AGAINST.split()) + r")\b", re.I)

_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)+")
_DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PLUS = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL_PHONE = re.compile(r"(?<![0-9+(.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[-.])[0-9]{3}[-.][0-9]{4}(?![0-9-])")
_ID_NUMBER = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_MASKED = re.compile(r"[A-Za-z0-9._%+-]{1,64}\x20?[\[(](?:at|AT)[\])]\x20?[A-Za-z0-9-]{1,63}"
                     r"(?:\x20?(?:\.|[\[(](?:dot|DOT)[\])])\x20?[A-Za-z0-9-]{1,63})+")
_PERSON = re.compile(r"\b(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Monsieur|Señor|Señora)\.?\x20[A-Z][a-zà-ÿ]+(?:\x20[A-Z][a-zà-ÿ]+)?")
_PERSON_HINT = re.compile(r"Mr|Ms|Dr|Prof|Herr|Frau|Mme|Monsieur|Señor")


class Candidate(NamedTuple):
    kind: str
    start: int
    end: int
    base: bool
    cell: str  # kind, votes and length class


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def iban_ok(text: str) -> bool:
    s = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def emails(text: str):
    """(start, end) of each match of the email pattern, found from the ``@`` outwards."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(done, at + 1))


def raw_candidates(text: str):
    """(kind, start, end, passes the check of the kind)."""
    if "@" in text:
        for s, e in emails(text):
            yield "email", s, e, True
    if "(" in text or "[" in text:
        for m in _MASKED.finditer(text):
            yield "masked_email", *m.span(), True
    for m in _DOTTED.finditer(text):
        # the pattern takes four parts at a time from the left
        parts, at = m.group().split("."), m.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i:i + 4]
            end = at + sum(map(len, four)) + 3
            yield "ip", at, end, all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four)
            at = end + 1
    for m in _DIGITS.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits):
                yield "card", *m.span(), len(digits) <= 19 and luhn(digits)
    if "+" in text:
        for m in _PLUS.finditer(text):
            yield "phone", *m.span(), 9 <= sum(c.isdigit() for c in m.group()) <= 15
    for m in _LOCAL_PHONE.finditer(text):
        yield "local_phone", *m.span(), m.group().lstrip("(")[0] not in "01"
    for m in _ID_NUMBER.finditer(text):
        a, b, c = m.group().split("-")
        yield "id_number", *m.span(), a not in ("000", "666") and a < "900" and b != "00" and c != "0000"
    for m in _IBAN.finditer(text):
        yield "iban", *m.span(), iban_ok(m.group())
    if _PERSON_HINT.search(text):
        for m in _PERSON.finditer(text):
            yield "person", *m.span(), True


def gazetteer_vote(kind: str, span: str) -> int:
    if kind in ("email", "masked_email"):
        return 1 if re.split(r"[.\]) ]+", span.lower())[-1] in ENDINGS else -1
    if kind == "card":
        return 1 if re.match(r"4|5[1-5]|2[2-7]|3[47]|6(?:011|5)", span) else -1
    if kind == "ip":
        first = span.split(".")[0].lstrip("0")
        return -1 if first in ("", "127", "255") else 1
    if kind == "person":
        return 1 if any(w.lower() in GIVEN_NAMES for w in span.split()[1:]) else 0
    if kind == "phone":
        return -1 if span[1] == "0" else 1
    return 0


def label(text: str, kind: str, start: int, end: int, passes: bool) -> str:
    """The cell of a candidate: kind, one vote per labeler, length class."""
    span, before = text[start:end], text[max(0, start - CONTEXT):start]
    cue = -1 if _AGAINST.search(before) else 1 if _CUES[kind].search(before) else 0
    tight = (start == 0 or not text[start - 1].isalnum()) and (end == len(text) or not text[end].isalnum())
    votes = (1 if passes else -1, gazetteer_vote(kind, span), cue, 1 if tight else -1,
             1 if len(set(filter(str.isalnum, span))) >= 4 else -1)
    return f"{kind}|{''.join('-0+'[v + 1] for v in votes)}|{min(3, (end - start) // 8)}"


def candidates(text: str | None) -> list[Candidate]:
    if not text:
        return []
    out = [Candidate(k, s, e, ok and k in BASE_KINDS, label(text, k, s, e, ok)) for k, s, e, ok in raw_candidates(text)]
    covered = [(c.start, c.end) for c in out if c.base]
    out = [c for c in out if c.base or not any(a < c.end and c.start < b for a, b in covered)]
    return sorted(out, key=lambda c: (c.start, KINDS.index(c.kind), c.end))


# -- the model: EM over the labelers, then a logistic span classifier ------------


def fit_cells(cells: dict[str, int], rounds: int = 60, steps: int = 400) -> dict:
    """Reliabilities (per kind and labeler: chance of the right vote) and a probability per cell."""
    import numpy as np

    if not cells:
        return {"reliability": {}, "probability": {}}
    names = sorted(cells)
    n = np.array([cells[c] for c in names], float)
    kind = np.array([KINDS.index(c.split("|")[0]) for c in names])
    votes = np.array([["-0+".index(v) - 1 for v in c.split("|")[1]] for c in names], float)
    width = np.array([int(c.split("|")[2]) for c in names])
    post = np.clip(0.5 + 0.15 * votes.sum(axis=1), 0.05, 0.95)
    k = len(KINDS)
    for _ in range(rounds):
        prior = (np.bincount(kind, n * post, k) + 1) / (np.bincount(kind, n, k) + 2)
        # chance of a right vote given the truth, with a weak prior of 0.8 that keeps the classes apart
        right, seen = np.full((k, 2, votes.shape[1]), 8.0), np.full((k, 2, votes.shape[1]), 10.0)
        for c, p in ((1, post), (0, 1 - post)):
            for j in range(votes.shape[1]):
                said = votes[:, j] != 0
                agrees = votes[:, j] == (1 if c else -1)
                right[:, c, j] += np.bincount(kind, n * p * agrees, k)
                seen[:, c, j] += np.bincount(kind, n * p * said, k)
        rate = right / seen
        logit = np.log(prior[kind] / (1 - prior[kind]))
        for j in range(votes.shape[1]):
            plus = np.log(rate[kind, 1, j] / (1 - rate[kind, 0, j]))
            minus = np.log((1 - rate[kind, 1, j]) / rate[kind, 0, j])
            logit += np.where(votes[:, j] > 0, plus, np.where(votes[:, j] < 0, minus, 0.0))
        post = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
    x = np.hstack([votes, np.eye(k)[kind], np.eye(4)[width]])
    w, weight = np.zeros(x.shape[1]), n / n.sum()
    # every kind counts alike, however frequent it is
    weight = weight / np.maximum(np.bincount(kind, weight, k), 1e-12)[kind]
    for _ in range(steps):
        p = 1 / (1 + np.exp(-x @ w))
        w -= 0.5 * (x.T @ (weight * (p - post)) + 1e-3 * w)
    p = 1 / (1 + np.exp(-x @ w))
    return {"reliability": {f"{KINDS[i]}.{LABELERS[j]}": float(rate[i, :, j].mean()) for i in range(k)
                            for j in range(len(LABELERS)) if (kind == i).any()},
            "probability": dict(zip(names, map(float, p)))}


CANDIDATES = ArrayType(StructType([
    StructField("kind", StringType()), StructField("start", LongType()), StructField("end", LongType()),
    StructField("base", BooleanType()), StructField("cell", StringType())]))

#: kinds x votes x length classes
MAX_CELLS = len(KINDS) * 3 ** len(LABELERS) * 4


def find_personal_data(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       out_col: str = "personal_data") -> DataFrame:
    """``id_col`` and ``out_col``: array of (kind, start, end, base) per row of ``df``.

    The texts are read once; the candidates are written to the shared folder, counted there
    for the model, and decided from there.
    """
    raw = add_columns(df, [text_col], [StructField("__candidates", CANDIDATES)],
                      lambda: lambda texts: [([tuple(c) for c in candidates(t)],) for t in texts], keep=[id_col])
    raw = save_table(raw, "personal-data-candidates")
    counted = raw.select(F.explode("__candidates.cell").alias("cell")).groupBy("cell").count()
    model = fit_cells({r["cell"]: r["count"] for r in bounded_rows(counted, MAX_CELLS, "vote cells")})
    wanted = F.array(*[F.lit(c) for c, p in sorted(model["probability"].items()) if p >= 0.5]).cast("array<string>")
    kept = F.filter("__candidates", lambda c: c["base"] | (~c["kind"].isin(*BASE_KINDS) & F.array_contains(wanted, c["cell"])))
    return raw.select(id_col, F.transform(kept, lambda c: F.struct(
        c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"), c["base"].alias("base"))).alias(out_col))


def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *[c.alias(n) for n, c in digest_columns("personal_data", BASE_KINDS).items()])
