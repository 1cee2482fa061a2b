"""Secrets: fixed patterns, and assignment-aware lexing of source and configuration syntax.

Base kinds, always reported: ``assign`` (a telling name, ``:`` or ``=``, a value of 12
characters or more), ``access`` (AKIA keys of 18 characters or more), ``hex`` (16 or
more lower-case hex digits).

The lexer adds the kind ``literal``:

1. It cuts the text into name-value pairs: ``name = value``, ``name: value``,
   ``"name": value``, ``x["name"] = value``, ``name := value``, ``name => value``,
   ``a = b = value`` (a pair for each name), ``--name value`` (sensitive names only) and
   ``<name>value</name>``. A value is a quoted literal, a bare word, a reference
   (``$name``, ``${name}``), or a sum of such terms.
2. Constants are propagated: a term that is a name assigned earlier stands for that
   name's literals, through chains and sums of any length, in text order.
3. Each literal is scored by the most sensitive name it reaches: the name's words
   (``dbPassword`` and ``DB_PASSWORD`` both hold ``password``) give a weight, the
   literal's length and variety another; placeholders such as ``changeme`` or
   ``${VAR}`` score nothing. A bare word that is no known name counts as a literal if it
   holds a digit or its own name is sensitive. Literals scored ``REPORT`` or more are
   reported where they stand, also if the sensitive name comes later.

Per kind, spans are leftmost and do not overlap; a match that fails its check is
dropped and not tried again. NULL and empty texts have no spans.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame

from quizframe.llm.spans import Span, digests, with_spans

BASE = ["assign", "access", "hex"]
KINDS = [*BASE, "literal"]
REPORT = 0.5

_ASSIGN = re.compile(
    r"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII | re.IGNORECASE
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# Runs are maximal, so asking for 16 digits at once drops the same matches.
_HEX = re.compile(r"[0-9a-f]{16,}")
_HINTS = ("password", "passwd", "secret", "token", "api")

_TERM = r"\"(?:[^\"\\\n]|\\.)*+\"|'(?:[^'\\\n]|\\.)*+'|\$\{[A-Za-z_][A-Za-z0-9_]*+\}|[A-Za-z0-9_$./+=-]++"
_SIGN = r"[ \t]*(?::=|=>|=(?!=)|:)[ \t]*"
_PAIR = re.compile(
    rf"(?<![A-Za-z0-9_.-])([A-Za-z_][A-Za-z0-9_.-]*+)(?:[\"']\]?)?{_SIGN}((?:{_TERM})(?:[ \t]*\+[ \t]*(?:{_TERM}))*)"
)
_TERMS = re.compile(_TERM)
_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_.-]*\Z")
# The value of a pair that is the name of the next one.
_TARGET = re.compile(r"[A-Za-z_][A-Za-z0-9_.-]*+(?=[ \t]+(?::=|=(?![=>]))|:?=[ \t]*[\"'$])")
_REFERENCE = re.compile(r"\$(?:\{([A-Za-z_][A-Za-z0-9_]*)\}|([A-Za-z_][A-Za-z0-9_]*))\Z")
_FLAG = re.compile(rf"(?<![A-Za-z0-9_.<-])--?([A-Za-z][A-Za-z0-9_-]*+)(?:=|[ \t]+)({_TERM})")
_ELEMENT = re.compile(r"<([A-Za-z_][A-Za-z0-9_.-]*+)>([^<>]*+)</")
_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")

# How telling the words of a name are.
SENSITIVE = {
    "password": 1.0,
    "passwd": 1.0,
    "pwd": 0.9,
    "passphrase": 1.0,
    "secret": 1.0,
    "token": 0.9,
    "apikey": 1.0,
    "credential": 0.9,
    "credentials": 0.9,
    "private": 0.6,
    "auth": 0.6,
    "key": 0.5,
    "signature": 0.5,
    "salt": 0.5,
}
PLACEHOLDERS = ("changeme", "example", "placeholder", "your", "xxxx", "****", "<", "${", "{{", "none", "null", "true", "false")


def sensitivity(name: str) -> float:
    words = [w.lower() for w in _WORDS.findall(name)]
    best = max((SENSITIVE.get(w, 0.0) for w in words), default=0.0)
    pairs = {a + b for a, b in zip(words, words[1:], strict=False)}
    return 1.0 if pairs & {"apikey", "accesskey", "privatekey", "secretkey"} else best


def strength(literal: str) -> float:
    """0 to 1 by length and by the entropy of the characters; 0 for placeholders."""
    low = literal.lower()
    if len(literal) < 6 or any(p in low for p in PLACEHOLDERS):
        return 0.0
    n = len(literal)
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(literal).values())
    varied = any(c.isdigit() for c in literal) + any(c.isalpha() for c in literal) + any(not c.isalnum() for c in literal)
    return min(1.0, n / 16) * min(1.0, entropy / 3) * (1.0 if varied > 1 else 0.5)


def _pairs(text: str) -> Iterator[tuple[list[str], list[tuple[int, int]]]]:
    """(names from the first to the last target, places of the terms) of every pair, in text order."""
    found: list[tuple[int, list[str], list[tuple[int, int]]]] = []
    at, names = 0, []
    while m := _PAIR.search(text, at):
        names.append(m[1])
        if _TARGET.match(text, m.start(2)):
            # The value is assigned to in its turn: a pair of its own.
            at = m.start(2)
            continue
        found.append((m.start(), names, [(m.start(2) + t.start(), m.start(2) + t.end()) for t in _TERMS.finditer(m[2])]))
        at, names = m.end(), []
    if "-" in text:
        found += [(m.start(), [m[1]], [m.span(2)]) for m in _FLAG.finditer(text) if sensitivity(m[1])]
    if "</" in text:
        for m in _ELEMENT.finditer(text):
            inner = m[2].strip()
            if inner and text.startswith(m[1] + ">", m.end()):
                a = m.start(2) + m[2].index(inner)
                found.append((m.start(), [m[1]], [(a, a + len(inner))]))
    for _, names, terms in sorted(found, key=lambda f: f[0]):
        yield names, terms


def literals(text: str) -> list[Span]:
    """Literals that sensitive names take, directly or through other names."""
    pairs: list[tuple[list, list]] = []  # literals of the pair, and the earlier pairs that it names
    weights: list[float] = []
    latest: dict[str, int] = {}
    for names, terms in _pairs(text):
        weight = max(map(sensitivity, names))
        own, named = [], []
        for start, end in terms:
            word = text[start:end]
            if quoted := word[0] in "\"'" and len(word) > 1:
                start, end = start + 1, end - 1
            if refers := _REFERENCE.match(text[start:end]) if end - start < 200 else None:
                named += [latest[n] for n in refers.groups() if n in latest]
            elif not quoted and word in latest:
                named.append(latest[word])
            elif quoted or weight or any(c.isdigit() for c in word) or not _NAME.match(word):
                own.append((start, end))
        for name in names:
            latest[name] = len(pairs)
        pairs.append((own, named))
        weights.append(weight)
    found = {}
    # Pairs name earlier pairs only: backwards, every weight is final when its pair comes.
    for at in range(len(pairs) - 1, -1, -1):
        (own, named), weight = pairs[at], weights[at]
        for i in named:
            weights[i] = max(weights[i], weight)
        if weight:
            for a, b in own:
                value = weight * strength(text[a:b])
                if value >= REPORT:
                    found[a, b] = max(value, found.get((a, b), 0.0))
    # Leftmost first, the longer of two that begin together; none overlaps one before it.
    out, end = [], 0
    for (a, b), value in sorted(found.items(), key=lambda f: (f[0][0], -f[0][1])):
        if a >= end:
            out.append(("literal", a, b, value))
            end = b
    return out


def find_secrets(text: str) -> list[Span]:
    """All spans of a text, unsorted."""
    found: list[Span] = []
    low = text.lower()
    if any(h in low for h in _HINTS):
        found += [("assign", *m.span(), 1.0) for m in _ASSIGN.finditer(text) if len(m[1]) >= 12]
    if "AKIA" in text:
        found += [("access", *m.span(), 1.0) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [("hex", *m.span(), 0.5) for m in _HEX.finditer(text)]
    if any(c in text for c in "=:<") or "-" in text:
        found += literals(text)
    return found


def secret_spans(docs: DataFrame, text: str = "text", spans: str = "spans") -> DataFrame:
    """``docs`` with an array of (kind, start, end, score) over the whole text."""
    return with_spans(docs, find_secrets, KINDS, text, spans)


def secret_digests(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_assign, n_access, n_hex, base_sha256, spans, scores)`` of every row."""
    return digests(secret_spans(docs.select(key, text), text, "found"), key, "found", BASE)
