import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from hourwise.llm import pii

SF = "/root/testdata/sf0.001"
digits = lambda s: re.sub("[^0-9]", "", s)
BASE = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 12 <= len(digits(s)) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(digits(s)[::-1])) % 10 == 0),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15))


def brute(text):
    out = [(m.start(), i, m.end(), k) for i, (k, r, ok) in enumerate(BASE) for m in re.finditer(r, text or "") if ok(m.group())]
    return [(a, b, k) for a, _, b, k in sorted(out)]


piece = st.sampled_from(["@", ".", "+", "-", " ", "(", ")", "a", "b.c", "1", "22", "255", "256", "10.0.0.1", "4111 1111 1111 1111", "x@y.z", "+1 (555) 123-4567",
                         "4111111111111111", "%", "é", "://", "u:p@h.io", "account", "0", "_"])


@settings(max_examples=600, deadline=None)
@given(st.lists(piece, max_size=14).map("".join))
def test_base_spans_equal_regular_expressions(text):
    assert [s for s in pii.find(text) if s[2] in pii.BASE_KINDS] == brute(text)


def test_documents_equal_regular_expressions(spark):
    from hourwise.llm.registry import QUERIES

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in QUERIES["op7_pii"](spark, SF).collect():
        spans = brute(docs[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, b, k in spans).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[2] == k for s in spans) for k in pii.BASE_KINDS]


def test_cues():
    kinds = lambda t: [(t[a:b], k) for a, b, k in pii.find(t) if k not in pii.BASE_KINDS]
    assert kinds("IBAN: DE89 3704 0044 0532 0130 00.") == [("DE89 3704 0044 0532 0130 00", "iban")]
    assert kinds("IBAN DE88370400440532013000") == []  # wrong check digits
    assert kinds("account no. 12345678, SSN 123-45-6789") == [("12345678", "account"), ("123-45-6789", "ssn")]
    assert kinds("on account of 12345678 and the ibanez 5 https://host/a?b") == []
    assert kinds("see https://bob:secret@host.org/x") == [("bob:secret", "login")]


def test_iban_before_upper_case_words():
    ibans = ("BE68 5390 0754 7034", "AT61 1904 3002 3457 3201", "ES91 2100 0418 4502 0005 1332", "PL61 1090 1014 0000 0712 1981 2874",
             "DE89 3704 0044 0532 0130 00", "NO93 8601 1117 947", "MT84 MALT 0110 0001 2345 MTLC AST0 01S")
    words = (" A", " NR", " BIC CAIXESBB", " EUR 500", " BANK", " BANK OF X", " 2024", " 2024 EUR 1", " ABCD EFGH IJKL MNOP QRST", ".", "\nBIC", " bic")
    for iban in ibans:
        for own in (iban, iban.replace(" ", "")):
            for word in words:
                text = f"IBAN {own}{word}"
                assert [text[a:b] for a, b, k in pii.find(text) if k == "iban"] == [own], text
    assert pii.redact("IBAN ES91 2100 0418 4502 0005 1332 BIC CAIXESBB") == "IBAN <IBAN> BIC CAIXESBB"
    assert [k for *_, k in pii.find("IBAN ZZ59 1234 5678 9012 3456 EUR")] == ["iban"]  # a code without a listed length
    assert "iban" not in [k for *_, k in pii.find("IBAN ES92 2100 0418 4502 0005 1332 BIC CAIXESBB")]  # wrong check digits


def test_login_of_any_length():
    for user, password in (("bob", "s" * 1020), ("bob", "s" * 1019), ("b" * 5000, "x"), ("bob", "p:%" * 500_000)):
        text = f"see https://{user}:{password}@host.org/x"
        assert [(a, b) for a, b, k in pii.find(text) if k == "login"] == [(12, 13 + len(user) + len(password))]
    for text in ("://a:" * 200_000, "://" + "a" * 1_000_000, "://a:" + "b:" * 500_000, "://a:b" * 200_000 + "@h"):
        assert len([k for *_, k in pii.find(text) if k == "login"]) == text.endswith("@h")


def test_long_texts_take_linear_time():
    for text in ("a" * 1_000_000, "1" * 1_000_000, "a@" * 300_000, "1.2.3." * 100_000, "+1 " * 200_000, "." * 500_000 + "@a.b"):
        brute_free = pii.find(text)
        assert all(0 <= a < b <= len(text) for a, b, _ in brute_free)


def test_edge_cases(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, "mail a@b.co now", "x"), (3, "mail a@b.co now", "x"), (None, "1.2.3.4", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    assert [[tuple(s) for s in r.spans] for r in pii.find_spans(df).collect()] == [[], [], [(5, 11, "email")], [(5, 11, "email")], [(0, 7, "ip")]]
    assert [tuple(r) for r in pii.redacted(df).collect()] == [(1, None, "x"), (2, "", "x"), (3, "mail <EMAIL> now", "x"), (3, "mail <EMAIL> now", "x"), (None, "<IP>", "x")]
    assert pii.find_spans(df.limit(0)).count() == 0
