"""Personal data: regular expressions propose spans, validators confirm them, words nearby adjust the score.

Kinds ``email``, ``ip``, ``card`` (Luhn) and ``phone`` follow fixed rules and are always kept when they pass.
Kinds ``iban`` (mod 97) and ``national_id`` (three groups of digits) are kept when their score, raised by
words of their context, reaches 0.5. Scores are reported for all of them.

Offsets are code points, the end is exclusive. Defined results: a null text counts as empty; an empty text has
no spans; rows that repeat give a row each; a text of any length is read whole, in time linear in its length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, functions as F

from millrace.llm.batches import map_rows

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "national_id")
NEAR = 40  # code points before and after a span
ACCEPTED = 0.5

# The proposals. Starts inside a run of the same characters are skipped, as the run's own start
# has been tried; this changes no match and keeps the search linear.
EMAIL_LOCAL = re.compile(r"[A-Za-z0-9._%+-]++")
EMAIL_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}")
NATIONAL = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")

# Characters of an IBAN by country.
IBAN_LENGTH = {k[:2]: int(k[2:]) for k in (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DK18 DO28 EE20 EG29 ES24 FI18 FO18 FR27 GB22 GE22 "
    "GI23 GL18 GR27 GT28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 MC27 MD24 ME22 MK19 MR27 MT31 "
    "MU30 NL18 NO15 PK24 PL28 PS29 PT25 QA29 RO24 RS22 SA24 SC31 SE24 SI19 SK24 SM27 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20").split()}

# Words that make a kind more likely when they stand nearby, in the languages of the tables.
CONTEXT = {
    "email": ("mail", "e-mail", "email", "contact", "correo", "courriel"),
    "ip": ("ip", "address", "server", "host", "adresse", "dirección"),
    "card": ("card", "visa", "credit", "karte", "carte", "tarjeta"),
    "phone": ("phone", "call", "tel", "mobile", "telefon", "téléphone", "teléfono"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
    "national_id": ("ssn", "social", "security", "id", "insurance"),
}
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.8, "national_id": 0.3}
NEARBY = {kind: re.compile(r"(?<!\w)(?:" + "|".join(map(re.escape, w)) + r")(?!\w)", re.IGNORECASE) for kind, w in CONTEXT.items()}


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def mod97(code: str) -> bool:
    code = code.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from their @: the local part is the whole run of its characters before the @."""
    done = at = 0
    while (at := text.find("@", max(at, done))) >= 0:
        start = at
        while start > done and (c := text[start - 1]).isascii() and (c.isalnum() or c in "._%+-"):
            start -= 1
        domain = EMAIL_DOMAIN.match(text, at) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        at += 1


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for m in IP.finditer(text):
        if all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in m[0].split(".")):
            yield m.span()


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in CARD.finditer(text):
        if m.end() - m.start() <= 37:
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    at = text.find("+")
    while at >= 0:
        m = PHONE.match(text, at)
        if m:
            if 9 <= sum(map(m[0].count, "0123456789")) <= 15:
                yield m.span()
        at = text.find("+", m.end() if m else at + 1)


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """A candidate may run on into the words behind it: ends are tried at the country's length, then as far as it goes.

    Shorter ends at blanks are tried where the country's length is not known.
    """
    at = 0
    while m := IBAN.search(text, at):
        start, at = m.start(), m.start() + 4
        ends, size = [], 0
        for end in range(start + 1, m.end() + 1):
            size += text[end - 1] != " "
            after = text[end:end + 1]
            if size >= 15 and text[end - 1] != " " and not (after.isascii() and after.isalnum()):
                ends.append((size, end))
        known = IBAN_LENGTH.get(text[start:start + 2])
        tried = [e for n, e in ends if n == known] + [e for _, e in reversed(ends if known is None else ends[-1:])]
        if end := next((e for e in tried if mod97(text[start:e])), None):
            yield start, end
            at = end


def _national_ids(text: str) -> Iterator[tuple[int, int]]:
    return (m.span() for m in NATIONAL.finditer(text))


FINDERS = {"email": _emails, "ip": _ips, "card": _cards, "phone": _phones, "iban": _ibans, "national_id": _national_ids}
DIGIT = re.compile("[0-9]")


def score(kind: str, text: str, start: int, end: int) -> float:
    near = NEARBY[kind].search(text[max(0, start - NEAR):start]) or NEARBY[kind].search(text[end:end + NEAR])
    return min(1.0, PRIOR[kind] + (0.3 if near else 0.0))


def spans(text: str) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) by kind, then start."""
    found = []
    digits = DIGIT.search(text) is not None
    for kind in KINDS if digits else ("email",):
        for start, end in FINDERS[kind](text):
            value = score(kind, text, start, end)
            if kind in BASE or value >= ACCEPTED:
                found.append((kind, start, end, value))
    return found


def masked(text: str, found: Sequence[tuple[str, int, int, float]]) -> str:
    """Each stretch of overlapping spans becomes the mark of its first kind."""
    out, at, last = [], 0, -1
    for kind, start, end, _ in sorted(found, key=lambda s: (s[1], -s[2], s[0])):
        if start >= last:
            out += [text[at:start], f"<{kind.upper()}>"]
        last = at = max(last, end)
    return "".join([*out, text[at:]])


SPANS = "array<struct<kind:string,start:bigint,end:bigint,score:double>>"


def find_spans(df: DataFrame, keep: Sequence[str], text_column: str = "text") -> DataFrame:
    """Columns ``keep`` of ``df`` and ``spans``, an array of (kind, start, end, score) by kind and start."""
    return _mapped(df, keep, text_column, SPANS, "spans",
                   lambda text: [dict(zip(("kind", "start", "end", "score"), s)) for s in spans(text or "")])


def mask(df: DataFrame, text_column: str = "text", output: str = "masked") -> DataFrame:
    """All columns of ``df`` and the text with its personal data replaced; null stays null."""
    return _mapped(df, df.columns, text_column, "string", output,
                   lambda text: None if text is None else masked(text, spans(text)))


def _mapped(df: DataFrame, keep: Sequence[str], text_column: str, kind: str, output: str, change) -> DataFrame:
    if output in keep:
        raise ValueError(f"column {output} is there already")

    def rows(texts: Iterator[tuple]) -> Iterator[tuple]:
        for text, *rest in texts:
            yield *rest, change(text)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema.fields)
    return map_rows(df, [F.col(text_column), *[F.col(c) for c in keep]], f"{fields}, `{output}` {kind}", rows, spread=True)
