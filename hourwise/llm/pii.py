"""Operator 7, PII: anchor expansion.

One Aho-Corasick pass over a text finds the anchors: at-signs, plus signs, schemes (``://``), digits and identifier
cues (IBAN, account, SSN ... in several languages).  At each anchor a deterministic local parser expands to the
boundaries of the span and validates it; every character is looked at a constant number of times, so a very long
text costs time in proportion to its length.

Base kinds (leftmost, non-overlapping in each kind): ``email``; ``ip`` (parts at most 255); ``card`` (12 to 19 digits,
Luhn); ``phone`` (9 to 15 digits).  The method's own kinds, found at cues: ``iban`` (mod-97 check), ``account`` (a cue
word followed by a number of 6 to 20 digits), ``ssn`` (cue and ddd-dd-dddd), ``login`` (user:password part of an URL).

An IBAN may be followed by words that could be its next groups ("... 1332 BIC").  It ends where its country's length
says, or else with the longest run of groups; for a country without a listed length, all ends of groups are tried from
the longest run to the shortest until mod-97 holds.

Defined results: null or empty text -> no span; repeated rows are each parsed; spans of different kinds may overlap
and are all kept; ids may be null; other columns ride along untouched.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, row_and

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "account", "ssn", "login")
RANK = {k: i for i, k in enumerate(KINDS)}

#: Cue words before an account number.
ACCOUNT_CUES = ("account", "acct", "konto", "kontonummer", "cuenta", "compte")

#: Characters of an IBAN by country.
IBAN_LENGTHS = {c: n for n, codes in {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}.items() for c in codes.split()}

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_domain = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_ip = re.compile(r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_card = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_phone = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_iban = re.compile(r"[\x20:#-]{0,3}([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?)(?![A-Za-z0-9])")
_account = re.compile(r"(?:[\x20.]{0,2}(?:number|numero|no|nr|num|id))?[\x20.:#-]{1,4}([0-9](?:[\x20-]?[0-9]){5,19})(?![0-9A-Za-z])", re.I)
_ssn = re.compile(r"[\x20.:#-]{1,4}([0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9-])")
# ends before the next slash, so the parsers at several schemes never read the same characters
_login = re.compile(r"([^\s/?#@:<>\"']++:[^\s/?#@<>\"']++)@[A-Za-z0-9.-]")

_automaton: list = []


def automaton():
    """Anchors with their parser's name (built once per worker)."""
    if not _automaton:
        import ahocorasick

        a = ahocorasick.Automaton()
        for key, name in (("@", "at"), ("+", "plus"), ("://", "scheme"), *((d, "digit") for d in "0123456789")):
            a.add_word(key, (name, len(key)))
        for word, name in (("iban", "iban"), ("ssn", "ssn"), *((w, "account") for w in ACCOUNT_CUES)):
            for key in {word, word.upper(), word.capitalize()}:
                a.add_word(key, (name, len(key)))
        a.make_automaton()
        _automaton.append(a)
    return _automaton[0]


def digits_of(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def valid_ip(s: str) -> bool:
    """Every part at most 255 (a part may be of any length: leading zeros)."""
    return all(len(p := x.lstrip("0")) <= 3 and int(p or "0") <= 255 for x in s.split("."))


def valid_iban(s: str) -> bool:
    s = s.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def iban_end(s: str) -> int:
    """Where the IBAN at the start of ``s``, the longest run of its groups, ends (0: none): at a space or with ``s``."""
    ends = [len(s), *(i for i in range(len(s) - 1, 0, -1) if s[i] == " ")]
    if own := IBAN_LENGTHS.get(s[:2]):
        ends = [*(e for e in ends if e - s.count(" ", 0, e) == own), len(s)]
    return next((e for e in ends if valid_iban(s[:e])), 0)


def find(text: str) -> list[tuple[int, int, str]]:
    """All spans (start, end, kind), by start, then kind as listed."""
    out: list[tuple[int, int, str]] = []
    email_end = ip_end = card_end = phone_end = account_end = 0
    last_digit = -2
    n = len(text)
    for end, (name, size) in automaton().iter(text):
        at = end - size + 1
        if name == "digit":
            new, last_digit = at != last_digit + 1, at
            if not new:
                continue
            if at >= ip_end and (m := _ip.match(text, at)):
                ip_end = m.end()
                if valid_ip(m.group()):
                    out.append((at, ip_end, "ip"))
            if at >= card_end and (m := _card.match(text, at)):
                card_end = m.end()
                d = digits_of(m.group()) if card_end - at <= 40 else ""
                if 12 <= len(d) <= 19 and luhn(d):
                    out.append((at, card_end, "card"))
        elif name == "at":
            a = at
            while a > email_end and text[a - 1] in LOCAL:
                a -= 1
            if a < at and (m := _domain.match(text, at + 1)):
                email_end = m.end()
                out.append((a, email_end, "email"))
        elif name == "plus":
            if at >= phone_end and (m := _phone.match(text, at)):
                phone_end = m.end()
                if 9 <= len(digits_of(m.group())) <= 15:
                    out.append((at, phone_end, "phone"))
        elif at and (text[at - 1].isalnum()) and name != "scheme":
            continue  # a cue inside another word
        elif name == "iban":
            if (m := _iban.match(text, end + 1)) and (size := iban_end(m.group(1))):
                out.append((m.start(1), m.start(1) + size, "iban"))
        elif name == "ssn":
            if m := _ssn.match(text, end + 1):
                out.append((m.start(1), m.end(1), "ssn"))
        elif name == "account":
            if end + 1 > account_end and (m := _account.match(text, end + 1)):
                account_end = m.end()
                out.append((m.start(1), m.end(1), "account"))
        elif name == "scheme" and end + 1 < n:
            if m := _login.match(text, end + 1):
                out.append((end + 1, m.end(1), "login"))
    out.sort(key=lambda s: (s[0], RANK[s[2]], s[1]))
    return out


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


SPANS = "array<struct<start:int,end:int,kind:string>>"
_span_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))


def find_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` in a struct ``_row`` and its ``spans``; one Arrow pass, no shuffle."""
    bounded_batches(docs.sparkSession)
    src = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(f"`{text}`").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            spans = [[{"start": a, "end": e, "kind": k} for a, e, k in find(x)] if x else [] for x in b.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("_row"), pa.array(spans, _span_type)], ["_row", "spans"])

    return src.mapInArrow(run, row_and(src, f"spans {SPANS}"))


def redact(text: str) -> str:
    """``text`` with every span replaced by ``<KIND>``; overlapping spans become one, named after the first."""
    out, at, pending = [], 0, None
    for a, b, k in [*find(text), (len(text) + 1, 0, "")]:
        if pending and a < pending[1]:
            pending = (pending[0], max(b, pending[1]), pending[2])
            continue
        if pending:
            out += [text[at:pending[0]], f"<{pending[2].upper()}>"]
            at = pending[1]
        pending = (a, b, k)
    return "".join(out) + text[at:]


def redacted(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs``, same columns and rows, with the spans in ``text`` replaced; null text stays null."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            i = b.schema.get_field_index(text)
            new = pa.array([x and redact(x) for x in b.column(i).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([new if j == i else b.column(j) for j in range(b.num_columns)], b.schema.names)

    return docs.mapInArrow(run, docs.schema)


def op7_pii(spark, sf_dir: str) -> DataFrame:
    from .common import read

    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    spans = F.col("spans")
    as_text = lambda s: F.array_join(F.transform(s, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    base = F.filter(spans, lambda x: x["kind"].isin(*BASE_KINDS))
    n = lambda kind: F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return find_spans(docs).select("_row.doc_id", *[n(k) for k in BASE_KINDS], F.sha2(as_text(base), 256).alias("base_sha256"),
                                   as_text(spans).alias("spans"))
