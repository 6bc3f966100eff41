"""Personal data: regular expressions propose spans, checksums and ranges confirm them, nearby words move the score."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import ship

ship(__name__)

# Kinds in the order in which spans with the same start are listed; the first four are the base.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn")

# Every kind needs a digit or an at sign; texts without either are not sent to Python.
PREFILTER = "[0-9@]"

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*")
# Digit runs are consumed whether or not an address follows, so that a long run is read once.
_IP = re.compile(r"([0-9]++)(?:\.([0-9]++)\.([0-9]++)\.([0-9]++))?+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")
_NOT_DIGIT = re.compile(r"[^0-9]+")

# Countries by the characters of their account numbers.
_COUNTRIES = {
    15: ("NO",),
    16: ("BE",),
    18: ("DK", "FI", "FK", "FO", "GL", "NL", "SD"),
    19: ("MK", "SI"),
    20: ("AT", "BA", "EE", "KZ", "LT", "LU", "MN", "XK"),
    21: ("CH", "HR", "LI", "LV"),
    22: ("BG", "BH", "CR", "DE", "GB", "GE", "IE", "ME", "RS", "VA"),
    23: ("AE", "GI", "IL", "IQ", "OM", "SO", "TL"),
    24: ("AD", "CZ", "ES", "MD", "PK", "RO", "SA", "SE", "SK", "TN", "VG"),
    25: ("LY", "PT", "ST"),
    26: ("IS", "TR"),
    27: ("BI", "DJ", "FR", "GR", "IT", "MC", "MR", "SM"),
    28: ("AL", "AZ", "BY", "CY", "DO", "GT", "HN", "HU", "LB", "NI", "PL", "SV"),
    29: ("BR", "EG", "PS", "QA", "UA"),
    30: ("JO", "KW", "MU", "YE"),
    31: ("MT", "SC"),
    32: ("LC",),
    33: ("RU",),
}
IBAN_LENGTHS = {country: n for n, countries in _COUNTRIES.items() for country in countries}

# Words within CONTEXT characters that speak for a kind.
CONTEXT = 40
CONTEXT_WORDS = {
    "email": ("mail", "contact", "write", "@"), "ip": ("ip", "host", "server", "address"),
    "card": ("card", "visa", "master", "credit", "payment"), "phone": ("tel", "phone", "call", "mobile", "fax"),
    "iban": ("iban", "bank", "account", "konto", "compte", "cuenta"), "ssn": ("ssn", "social", "security"),
}
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.8, "ssn": 0.4}
CONTEXT_BONUS = 0.2
MIN_SCORE = 0.5


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(c), 10)) for c in digits[-2::-2])) % 10 == 0


def mod97(iban: str) -> bool:
    turned = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _emails(text: str):
    """Leftmost non-overlapping addresses, found from their at sign: the local part is the run before it."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        # The run is looked for in growing pieces, so that a short one costs little.
        step = 64
        while start > end:
            low = max(end, start - step)
            # Backwards, so that every character is read once.
            start -= _LOCAL.match(text[low:start][::-1]).end()
            if start > low:
                break
            step *= 4
        if start < at and (m := _DOMAIN.match(text, at)):
            yield start, m.end()
            end = m.end()
            at = text.find("@", end)
        else:
            at = text.find("@", at + 1)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The base kinds of one text, by kind."""
    found = [("email", s, e) for s, e in _emails(text)]
    if "." in text:
        found += [("ip", m.start(), m.end()) for m in _IP.finditer(text)
                  if m.group(2) and all(len(d := g.lstrip("0")) <= 3 and int(d or "0") <= 255 for g in m.groups())]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(d := _NOT_DIGIT.sub("", m.group())) <= 19 and luhn(d):
            found.append(("card", m.start(), m.end()))
    if "+" in text:
        found += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 10 <= len(_NOT_DIGIT.sub("", m.group())) <= 15]
    return found


def _ibans(text: str):
    """Account numbers with a right check sum: of the length of their country, of another country the longest that ends with a group."""
    m = _IBAN.search(text)
    while m:
        # Ends after each character that no other letter or digit follows, from the longest.
        ends = [e for e in range(m.end(), m.start(), -1) if text[e - 1] != " " and (e == m.end() or text[e] == " ")]
        known = IBAN_LENGTHS.get(m.group()[:2])
        for end in ends:
            number = text[m.start():end].replace(" ", "")
            if (len(number) == known if known else len(number) >= 12) and mod97(number):
                yield m.start(), end
                break
        else:
            end = m.start() + 1
        # What the proposal took beyond the number, or after a wrong first group, may begin another one.
        m = _IBAN.search(text, end)


def more_spans(text: str) -> list[tuple[str, int, int]]:
    """Account numbers with a right check sum, social security numbers of issued areas."""
    found = [("iban", s, e) for s, e in _ibans(text)]
    found += [("ssn", m.start(), m.end()) for m in _SSN.finditer(text)
              if m.group(1) not in ("000", "666") and m.group(1) < "900" and m.group(2) != "00" and m.group(3) != "0000"]
    return found


def scored(text: str) -> list[tuple[str, int, int, float, bool]]:
    """All spans with score, by start and kind: base spans whatever their score, others from ``MIN_SCORE``."""
    out = []
    for base, spans in ((True, base_spans(text)), (False, more_spans(text))):
        for kind, start, end in spans:
            near = f"{text[max(0, start - CONTEXT):start]} {text[end:end + CONTEXT]}".lower()
            score = min(1.0, PRIOR[kind] + CONTEXT_BONUS * any(w in near for w in CONTEXT_WORDS[kind]))
            if base or score >= MIN_SCORE:
                out.append((kind, start, end, score, base))
    out.sort(key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
    return out


SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("base", pa.bool_())])


SPAN_TYPE = "array<struct<kind:string,start:bigint,end:bigint,score:double,base:boolean>>"


def _spans(texts: pa.Array) -> pa.Array:
    fields = [f.name for f in SPAN]
    return pa.array([None if t is None else [dict(zip(fields, s, strict=True)) for s in scored(t)] for t in texts.to_pylist()], pa.list_(SPAN))


def personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, spans`` (kind, start, end exclusive in code points, score, base).

    A null or empty text has no spans. Repeated rows are reported each. The whole text is read, in time
    proportional to its length. No shuffle; texts without digit or at sign stay in the JVM. Other columns
    are not looked at.
    """
    found = F.arrow_udf(_spans, SPAN_TYPE)(F.when(F.col(text).rlike(PREFILTER), F.col(text)))
    return docs.select(F.col(doc_id).alias("doc_id"), found.alias("spans"))


def span_list(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    parts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.coalesce(F.array_join(parts, ","), F.lit(""))


def count_of(spans: Column, kind: str) -> Column:
    """How many base spans of a kind."""
    return F.coalesce(F.size(F.filter(spans, lambda s: s["base"] & (s["kind"] == kind))), F.lit(0)).cast("long")
