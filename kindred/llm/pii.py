"""Personal data: expressions propose spans, checks confirm them, words nearby adjust the score.

Kinds ``email, ip, card, phone`` are always reported once their own check holds. ``iban``,
``national_id`` and ``secret`` are reported when their score, raised by a fitting word nearby, reaches
``MIN_SCORE`` and no span of the first four kinds covers them.

All scans are linear in the text, also on long runs of digits or letters. Defined cases: a NULL text is
empty; repeated rows and equal or NULL ids are each searched by themselves; other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm.texts import map_texts

KINDS = ("email", "ip", "card", "phone")
MORE_KINDS = ("iban", "national_id", "secret")
MIN_SCORE = 0.5
NEAR = 48

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOTTED = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)+")
_CHAIN = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
# Characters of a number by country, blanks not counted.
IBAN_LENGTHS = {
    country: int(length) for length, countries in (x.split(":") for x in (
        "15:NO 16:BE 18:DK,FK,FI,FO,GL,NL,SD 19:MK,SI 20:AT,BA,EE,KZ,LT,LU,MN,XK 21:CH,HR,LI,LV "
        "22:BG,BH,CR,DE,GB,GE,IE,ME,RS,VA 23:AE,GI,IL,IQ,OM,SO,TL 24:AD,CZ,ES,MD,PK,RO,SA,SE,SK,TN,VG 25:AO,CV,GW,LY,MZ,PT,ST "
        "26:DZ,IR,IS,TR 27:BI,CF,CG,CM,DJ,GA,GQ,KM,MG,TD,FR,GR,IT,MC,MR,SM 28:AL,AZ,BF,BJ,BY,CI,CY,DO,GT,HN,HU,LB,MA,ML,NE,NI,PL,SN,SV,TG "
        "29:BR,EG,PS,QA,UA 30:JO,KW,MU,YE 31:MT,SC 32:LC 33:RU"
    ).split()) for country in countries.split(",")
}
_NATIONAL = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_SECRET = re.compile(r"(?<![A-Za-z0-9])(?:[0-9a-f]{32,64}|[0-9A-F]{32,64})(?![A-Za-z0-9])")

BASE_SCORE = {"email": 0.9, "ip": 0.6, "card": 0.7, "phone": 0.7, "iban": 0.8, "national_id": 0.3, "secret": 0.3}
CONTEXT = {
    "email": ("mail", "contact", "write"),
    "ip": ("ip", "address", "host", "server"),
    "card": ("card", "visa", "credit", "payment"),
    "phone": ("phone", "call", "tel", "mobile", "fax"),
    "iban": ("iban", "account", "bank", "konto"),
    "national_id": ("ssn", "social", "security", "insurance", "tax"),
    "secret": ("token", "key", "secret", "password", "api", "bearer"),
}
BONUS = 0.3
_NEAR = {kind: re.compile(rf"(?<![^\W\d_])(?:{'|'.join(found)})", re.IGNORECASE) for kind, found in CONTEXT.items()}


@dataclass(frozen=True)
class Span:
    kind: str
    start: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def mod97(iban: str) -> bool:
    turned = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _emails(text: str) -> list[tuple[int, int]]:
    """From each ``@`` back over the local part, then the domain; what a match took is not taken again."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            free = domain.end()
            out.append((start, free))
        else:
            # A local part before a later @ cannot reach over this one.
            free = max(free, at + 1)
        at = text.find("@", max(free, at + 1))
    return out


def _ips(text: str) -> list[tuple[int, int]]:
    """Dotted digit groups, four at a time from the left."""
    out = []
    for chain in _DOTTED.finditer(text):
        groups = chain.group().split(".")
        start = chain.start()
        for first in range(0, len(groups) - 3, 4):
            four = groups[first : first + 4]
            end = start + sum(map(len, four)) + 3
            if all(len(g.lstrip("0")) <= 3 and int(g.lstrip("0") or "0") <= 255 for g in four):
                out.append((start, end))
            start = end + 1
    return out


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _cards(text: str) -> list[tuple[int, int]]:
    out = []
    for m in _CHAIN.finditer(text):
        if m.end() - m.start() >= 13:
            digits = _digits(m.group())
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(m.span())
    return out


def _phones(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15] if "+" in text else []


def _ibans(text: str) -> list[tuple[int, int]]:
    """Proposed spans, cut at a blank where words follow the number; what is no number is searched from its next place on.

    The ending at the country's length goes first, then the whole span.
    """
    out, m = [], _IBAN.search(text)
    while m:
        start, ends = m.start(), [m.end()]
        ends += [m.end() - k for k in range(1, m.end() - m.start()) if text[m.end() - k] == " "]
        length = IBAN_LENGTHS.get(text[start : start + 2])
        sizes = {end: end - start - text.count(" ", start, end) for end in ends}
        tried = [e for e in ends if sizes[e] == length] + ends[:1]
        end = next((e for e in tried if mod97(text[start:e].replace(" ", ""))), None)
        if end is not None:
            out.append((start, end))
        m = _IBAN.search(text, start + 1 if end is None else end)
    return out


def _plain(pattern: re.Pattern) -> callable:
    return lambda text: [m.span() for m in pattern.finditer(text)]


FINDERS = {
    "email": _emails, "ip": _ips, "card": _cards, "phone": _phones, "iban": _ibans,
    "national_id": _plain(_NATIONAL), "secret": _plain(_SECRET),
}


def _score(kind: str, text: str, start: int, end: int) -> float:
    near = text[max(0, start - NEAR) : start] + "\n" + text[end : end + NEAR]
    return min(1.0, BASE_SCORE[kind] + (BONUS if _NEAR[kind].search(near) else 0.0))


def find(text: str | None) -> list[Span]:
    """All spans of a text, by kind as listed and then by start."""
    body = text or ""
    out = [Span(k, s, e, _score(k, body, s, e)) for k in KINDS for s, e in FINDERS[k](body)]
    taken = sorted((x.start, x.end) for x in out)
    for kind in MORE_KINDS:
        for start, end in FINDERS[kind](body):
            score = _score(kind, body, start, end)
            if score >= MIN_SCORE and not _overlaps(taken, start, end):
                out.append(Span(kind, start, end, round(score, 3)))
    return out


def _overlaps(taken: list[tuple[int, int]], start: int, end: int) -> bool:
    """Whether a base span meets the range; spans of the four kinds nest at most four deep."""
    after = bisect_left(taken, (end, 0))
    return any(e > start for _, e in taken[max(0, after - len(KINDS)) : after])


SCHEMA = "_key {key}, spans array<struct<kind:string,start:int,end:int,score:double>>"
_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))


def detect(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``spans``; offsets in code points, end exclusive. One map pass, no shuffle."""
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        spans = [[vars(x) for x in find(body.as_py())] for body in batch.column("_text")]
        return pa.RecordBatch.from_arrays([batch.column("_key"), pa.array(spans, _SPAN)], ["_key", "spans"])

    found = map_texts(rows, run, SCHEMA.format(key=rows.schema["_key"].dataType.simpleString()))
    return found.withColumnRenamed("_key", key)


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts per kind, the hash of the first four kinds' spans and all spans as one string."""

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*KINDS))
    return found.select(
        F.col(key), *[count(kind) for kind in KINDS], F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"), *[count(kind) for kind in MORE_KINDS],
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["score"])), F.lit(0.0)).alias("max_score"),
    )

