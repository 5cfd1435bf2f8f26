"""Personal data: regular expressions propose spans, checksums confirm them, words nearby adjust their scores.

Base kinds (``email``, ``ip``, ``card``, ``phone``) are found leftmost and without overlap; a match that its validator
rejects is dropped and not tried again. Base spans always stay, whatever their score. Added kinds are kept from
``LEAST_SCORE`` on, where they overlap neither a base span nor an added one of a higher score. Scores start from the kind,
grow with a confirmed checksum and with words nearby that name the kind, and shrink with words that name something else.

Starts and ends are code points, ends exclusive. Each text is one row's own work: nothing is shuffled. Patterns are
applied so that each character is read a bounded number of times, also in one word of a million digits or letters.

Null and empty texts have no spans. Repeated rows are judged each for itself; an empty table gives an empty result. Both
functions are column expressions, so other columns of a table, whatever their names, stay as they are.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

BASE_KINDS = ["email", "ip", "card", "phone"]
ADDED_KINDS = ["iban", "short_card", "card_group", "ssn", "national_phone"]
KINDS = BASE_KINDS + ADDED_KINDS

LEAST_SCORE = 0.7
# Code points before and after a span in which words count as nearby.
BEFORE, AFTER = 60, 30

# Score of a match that its validator accepts, without any word nearby.
SCORES = {
    "email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7,
    "iban": 0.9, "short_card": 0.5, "card_group": 0.8, "ssn": 0.5, "national_phone": 0.45,
}
HELPED, HINDERED, PREFIXED = 0.3, 0.3, 0.25

CARD_WORDS = {"card", "credit", "debit", "visa", "mastercard", "amex", "karte", "kreditkarte", "carte", "tarjeta", "cc"}
PHONE_WORDS = {"phone", "tel", "telephone", "call", "mobile", "fax", "telefon", "anruf", "téléphone", "appelez", "teléfono", "llame"}
HELPING = {
    "email": {"email", "mail", "contact", "write", "correo", "courriel"},
    "ip": {"ip", "address", "host", "server", "client", "login"},
    "card": CARD_WORDS,
    "phone": PHONE_WORDS,
    "iban": {"iban", "account", "bank", "konto", "compte", "cuenta"},
    "short_card": CARD_WORDS,
    "card_group": CARD_WORDS,
    "ssn": {"ssn", "social", "security"},
    "national_phone": PHONE_WORDS,
}
HINDERING = {
    "ip": {"version", "release", "v", "section", "chapter"},
    "card": {"isbn", "order", "tracking", "invoice"},
    "phone": {"isbn", "order", "tracking", "invoice"},
    "short_card": {"isbn", "order", "tracking", "invoice"},
    "card_group": {"isbn", "order", "tracking", "invoice"},
    "ssn": {"isbn", "order", "part", "serial"},
    "national_phone": {"isbn", "order", "part", "serial"},
}

# Length of an account number per country, from the public registry.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28, "CH": 21,
    "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27,
    "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26,
    "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MD": 24,
    "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29,
    "RO": 24, "RS": 22, "SA": 24, "SC": 31, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "ST": 25, "SV": 28, "TL": 23, "TN": 24,
    "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20,
}

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
AT_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# A leftmost match starts where its run of digits does, since any later start would leave out digits that fit.
FOUR_PARTS = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
DIGIT_CHAIN = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PLUS_NUMBER = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN_START = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}")
FOUR_GROUPS = re.compile(r"(?<![0-9])[0-9]{4}([\x20-])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9])")
SSN = re.compile(r"(?<![0-9-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")
NATIONAL_PHONE = re.compile(r"(?<![0-9+(])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])")
TOKEN = re.compile(r"[^\W\d_]+")

Match = tuple[int, int]


def luhn(digits: str) -> bool:
    """Whether the last digit is the check digit of the others."""
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def mod97(account: str) -> bool:
    """Whether an account number without spaces has the remainder 1, letters counting from A as 10 on."""
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> Iterator[Match]:
    """An address starts where the run of local characters before its ``@`` does, or where the address before it ends."""
    ended = earlier = 0
    for found in AT_DOMAIN.finditer(text):
        at = found.start()
        earlier = max(ended, text.rfind("@", earlier, at) + 1)
        start = earlier + len(text[earlier:at].rstrip(LOCAL))
        if start < at:
            ended = found.end()
            yield start, ended


def addresses(text: str) -> Iterator[Match]:
    for found in FOUR_PARTS.finditer(text):
        parts = [p.lstrip("0") for p in found.group().split(".")]
        if all(len(p) < 3 or (len(p) == 3 and p <= "255") for p in parts):
            yield found.span()


def chains(text: str) -> Iterator[tuple[Match, str]]:
    for found in DIGIT_CHAIN.finditer(text):
        if 13 <= found.end() - found.start() <= 37:
            yield found.span(), digits_of(found.group())


def cards(text: str) -> Iterator[Match]:
    return (span for span, digits in chains(text) if 16 <= len(digits) <= 19 and luhn(digits))


def phones(text: str) -> Iterator[Match]:
    for found in PLUS_NUMBER.finditer(text):
        if 8 <= sum("0" <= c <= "9" for c in found.group()) <= 15:
            yield found.span()


def ibans(text: str) -> Iterator[Match]:
    """Country, check digits and as many letters and digits as the country has, with single spaces between them."""
    for found in IBAN_START.finditer(text):
        length = IBAN_LENGTHS.get(found.group()[:2])
        if length is None:
            continue
        taken, end = found.group(), found.end()
        while len(taken) < length:
            step = 1 if text[end : end + 1] == " " else 0
            letter = text[end + step : end + step + 1]
            if not (letter.isascii() and (letter.isdigit() or letter.isupper())):
                break
            taken, end = taken + letter, end + step + 1
        follows = text[end : end + 1]
        if len(taken) == length and not (follows.isascii() and follows.isalnum()) and mod97(taken):
            yield found.start(), end


def networked(digits: str) -> bool:
    """Whether a number of 14 or 15 digits begins as its card network prescribes."""
    if len(digits) == 15:
        return digits[:2] in ("34", "37")
    return len(digits) == 14 and (digits[:2] in ("36", "38", "39") or "300" <= digits[:3] <= "305")


def short_cards(text: str) -> Iterator[Match]:
    return (span for span, digits in chains(text) if 13 <= len(digits) <= 15 and luhn(digits))


def card_groups(text: str) -> Iterator[Match]:
    return (found.span() for found in FOUR_GROUPS.finditer(text) if luhn(digits_of(found.group())))


def ssns(text: str) -> Iterator[Match]:
    for found in SSN.finditer(text):
        area, group, serial = found.groups()
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield found.span()


def national_phones(text: str) -> Iterator[Match]:
    return (found.span() for found in NATIONAL_PHONE.finditer(text))


FINDERS: dict[str, Callable[[str], Iterator[Match]]] = {
    "email": emails, "ip": addresses, "card": cards, "phone": phones, "iban": ibans, "short_card": short_cards,
    "card_group": card_groups, "ssn": ssns, "national_phone": national_phones,
}


def score(text: str, kind: str, start: int, end: int) -> float:
    """Score of an accepted match, from its kind and the words nearby."""
    near = text[max(0, start - BEFORE) : start] + " " + text[end : end + AFTER]
    words = {w.lower() for w in TOKEN.findall(near)}
    value = SCORES[kind]
    if words & HELPING[kind]:
        value += HELPED
    if words & HINDERING.get(kind, set()):
        value -= HINDERED
    if kind == "short_card" and networked(digits_of(text[start:end])):
        value += PREFIXED
    return round(min(1.0, max(0.0, value)), 3)


def spans_in(text: str | None) -> list[dict]:
    """All spans of a text by kind, then start, with their scores."""
    if not text:
        return []
    found = [(kind, start, end, score(text, kind, start, end)) for kind in BASE_KINDS for start, end in FINDERS[kind](text)]
    added = [(kind, start, end, score(text, kind, start, end)) for kind in ADDED_KINDS for start, end in FINDERS[kind](text)]
    if added:
        # Accepted spans by start: the kept added ones never overlap each other; base kinds may, so their reach is merged.
        merged: list[list[int]] = []
        for start, end in sorted((s, e) for _, s, e, _ in found):
            if merged and start < merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], end)
            else:
                merged.append([start, end])
        found += _apart([a for a in added if a[3] >= LEAST_SCORE], merged)
    order = {kind: n for n, kind in enumerate(KINDS)}
    found.sort(key=lambda x: (order[x[0]], x[1]))
    return [dict(zip(("kind", "start", "end", "score"), x)) for x in found]


def _apart(added: list[tuple], taken: list[list[int]]) -> list[tuple]:
    """Added spans that overlap no taken one and no added one of a higher score (then of an earlier kind, then start)."""
    order = {kind: n for n, kind in enumerate(KINDS)}
    kept, spans = [], sorted((s, e) for s, e in taken)
    for item in sorted(added, key=lambda x: (-x[3], order[x[0]], x[1])):
        _, start, end, _ = item
        at = bisect_left(spans, (start, start))
        if (at == 0 or spans[at - 1][1] <= start) and (at == len(spans) or spans[at][0] >= end):
            kept.append(item)
            insort(spans, (start, end))
    return kept


SPAN_TYPE = "array<struct<kind:string,start:bigint,end:bigint,score:double>>"
ARROW_SPANS = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
)


def pii_spans(text: str) -> Column:
    """``array<struct<kind,start,end,score>>`` of a text column, by kind as in ``KINDS``, then start."""

    @F.arrow_udf(SPAN_TYPE)
    def find(texts: pa.Array) -> pa.Array:
        return pa.array(map(spans_in, texts.to_pylist()), ARROW_SPANS)

    return find(F.col(text))


def redacted(text: str) -> Column:
    """The text with every span replaced by its kind in capitals and brackets; where spans of several kinds overlap,
    their union is replaced once, named after the first. Null stays null."""

    def clean(value: str | None) -> str | None:
        if not value:
            return value
        pieces, at = [], 0
        for span in sorted(spans_in(value), key=lambda s: (s["start"], -s["end"])):
            if span["start"] >= at:
                pieces += [value[at : span["start"]], f"[{span['kind'].upper()}]"]
            at = max(at, span["end"])
        return "".join(pieces) + value[at:]

    @F.arrow_udf("string")
    def replace(texts: pa.Array) -> pa.Array:
        return pa.array(map(clean, texts.to_pylist()), pa.string())

    return replace(F.col(text))


def spans_text(spans: Column, kinds: list[str]) -> Column:
    """``kind:start:end`` of the spans of some kinds, joined by commas."""
    chosen = F.filter(spans, lambda s: s["kind"].isin(kinds))
    texts = F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(texts, ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
