"""Personal data: patterns propose spans, checksums confirm them, context words weigh them.

Base kinds, always reported: ``email``, ``ip`` (parts at most 255), ``card`` (14 to
19 digits, Luhn), ``phone`` (international, 10 to 15 digits). Further kinds are
proposed by pattern and reported only from a score of ``REPORT`` on: ``iban`` (mod-97
confirms it), ``local_phone`` and ``national_id`` (no checksum: a context word must be
near). A score starts from the kind's own weight; words of the kind's context within
``NEAR`` characters raise it, words of other numberings lower it.

Per kind, spans are leftmost and do not overlap; a match of a base kind that fails its
check is dropped and not tried again. An ``iban`` is the longest run of 15 to 34 letters
and digits from a country code to the end of a word that mod-97 confirms, so words in
capitals behind it do not hide it. NULL and empty texts have no spans.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

from quizframe.llm.spans import Span, digests, with_spans

BASE = ["email", "ip", "card", "phone"]
KINDS = [*BASE, "iban", "local_phone", "national_id"]
REPORT = 0.6
NEAR = 40

# Weight without context, and the words that raise it.
WEIGHTS = {"email": 0.9, "ip": 0.6, "card": 0.7, "phone": 0.7, "iban": 0.8, "local_phone": 0.4, "national_id": 0.4}
CONTEXT = {
    "email": ("mail", "contact", "write to"),
    "ip": ("ip", "address", "host", "server"),
    "card": ("card", "visa", "credit", "payment", "karte", "carte", "tarjeta"),
    "phone": ("phone", "call", "tel", "mobile", "fax", "whatsapp"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
    "local_phone": ("phone", "call", "tel", "mobile", "fax", "whatsapp"),
    "national_id": ("ssn", "social security", "national id", "tax id"),
}
AGAINST = ("version", "isbn", "order no", "invoice", "serial", "build", "ticket")
RAISE, LOWER = 0.25, 0.3

# A run before "@" is found from the "@", so that a long run without one costs nothing.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*")
# A number that fails from its first digit fails from its later ones too.
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN_HEAD = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}")
_IBAN_BODY = re.compile(r"(?:\x20?[A-Z0-9]){11,30}")
_LOCAL_PHONE = re.compile(r"(?<![0-9+])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])")
_NATIONAL = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def mod97(iban: str) -> bool:
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def ip_part(digits: str) -> bool:
    """At most 255, whatever the number of leading zeros."""
    digits = digits.lstrip("0")
    return len(digits) <= 3 and int(digits or "0") <= 255


def emails(text: str) -> list[tuple[int, int]]:
    found, end = [], 0
    for m in _DOMAIN.finditer(text):
        before = text[end : m.start()][::-1] if m.start() - end < 4096 else text[m.start() - 4096 : m.start()][::-1]
        size = _LOCAL.match(before).end()
        if size == 4096:
            size = _LOCAL.match(text[end : m.start()][::-1]).end()
        if size:
            found.append((m.start() - size, m.end()))
            end = m.end()
    return found


def ibans(text: str) -> list[tuple[int, int]]:
    """Leftmost spans that mod-97 confirms, each as long as it can be."""
    found, end = [], 0
    for head in _IBAN_HEAD.finditer(text):
        if head.start() < end or not (body := _IBAN_BODY.match(text, head.end())):
            continue
        for stop in range(body.end(), head.end() + 10, -1):
            if text[stop - 1] == " " or text[stop : stop + 1].isalnum():
                continue
            compact = text[head.start() : stop].replace(" ", "")
            if len(compact) < 15:
                break
            if mod97(compact):
                found.append((head.start(), stop))
                end = stop
                break
    return found


def digits_of(text: str) -> str:
    return "".join(filter(str.isdigit, text))


def weigh(kind: str, text: str, start: int, end: int) -> float:
    near = text[max(0, start - NEAR) : start].lower() + " " + text[end : end + NEAR].lower()
    score = WEIGHTS[kind] + RAISE * any(w in near for w in CONTEXT[kind]) - LOWER * any(w in near for w in AGAINST)
    return min(1.0, max(0.0, score))


def find_personal(text: str) -> list[Span]:
    """All spans of a text, unsorted."""
    found: list[tuple[str, int, int]] = []
    if "@" in text:
        found += [("email", a, b) for a, b in emails(text)]
    proposed: list[tuple[str, int, int]] = []
    if _DIGIT.search(text):
        found += [("ip", *m.span()) for m in _IP.finditer(text) if all(map(ip_part, m.groups()))]
        for m in _CARD.finditer(text):
            # Longer runs hold too many digits; they are not even counted.
            if 14 <= m.end() - m.start() <= 37 and 14 <= len(d := digits_of(m[0])) <= 19 and luhn(d):
                found.append(("card", *m.span()))
        if "+" in text:
            found += [("phone", *m.span()) for m in _PHONE.finditer(text) if 10 <= len(digits_of(m[0])) <= 15]
        proposed += [("iban", a, b) for a, b in ibans(text)]
        proposed += [("local_phone", *m.span()) for m in _LOCAL_PHONE.finditer(text)]
        proposed += [("national_id", *m.span()) for m in _NATIONAL.finditer(text)]
    spans = [(k, a, b, weigh(k, text, a, b)) for k, a, b in found]
    return spans + [s for s in ((k, a, b, weigh(k, text, a, b)) for k, a, b in proposed) if s[3] >= REPORT]


def personal_spans(docs: DataFrame, text: str = "text", spans: str = "spans") -> DataFrame:
    """``docs`` with an array of (kind, start, end, score) over the whole text."""
    return with_spans(docs, find_personal, KINDS, text, spans)


def personal_digests(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_email, n_ip, n_card, n_phone, base_sha256, spans, scores)`` of every row."""
    return digests(personal_spans(docs.select(key, text), text, "found"), key, "found", BASE)
