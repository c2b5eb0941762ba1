import hashlib
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from tariffa.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1])) % 10 == 0


def base(text):
    digits = lambda m: re.sub(r"[^0-9]", "", m[0])
    return {
        "email": [m.span() for m in EMAIL.finditer(text)],
        "ip": [m.span() for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))],
        "card": [m.span() for m in CARD.finditer(text) if 16 <= len(digits(m)) <= 19 and luhn(digits(m))],
        "phone": [m.span() for m in PHONE.finditer(text) if 8 <= len(digits(m)) <= 15],
    }


def same(text):
    found = pii.find_spans(text)
    assert {k: found[k] for k in pii.BASE} == base(text), text


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="ab.@-+ ()0123٣é", max_size=40))
def test_base_spans(text):
    same(text)


def test_base_spans_of_numbers():
    rng = random.Random(5)
    for _ in range(3000):
        same("".join(rng.choice("0123456789012345678901234 -.+()@a") for _ in range(rng.randrange(60))))
    same("x 4418452524842581 y 0000.1.255.0001 1.2.3.4.5.6.7.8.9 a.b+c%d@x-y.co.uk. +1 (784) 555-8120")


def test_added_spans_and_masks():
    text = "Account no: GB82 WEST 1234 5698 7654 32 and tel:5551234567, ftp://me:pw1@host/x password=ab12cd34ef; a@b.co"
    found = pii.find_spans(text)
    assert [text[a:b] for a, b in found["account"]] == ["GB82 WEST 1234 5698 7654 32"]
    assert [text[a:b] for a, b in found["address"]] == ["5551234567"]
    assert [text[a:b] for a, b in found["login"]] == ["me:pw1", "ab12cd34ef"]
    assert pii.masked(text, found).endswith("password=<login>; <email>")
    assert pii.masked("clean text", pii.find_spans("clean text")) == "clean text"


def test_rows(spark):
    rows = [(1, "a@b.co", "s"), (1, "a@b.co", "s"), (None, None, "t"), (3, "", None), (4, "x " * 50000 + "1.2.3.4", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    got = sorted(map(tuple, pii.spans_of(df).collect()), key=str)
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = [(1, 1, 0, 0, 0, digest("email:0:6"), "email:0:6")] * 2 + [(3, 0, 0, 0, 0, digest(""), ""), (4, 0, 1, 0, 0, digest("ip:100000:100007"), "ip:100000:100007"), (None, 0, 0, 0, 0, digest(""), "")]
    assert got == sorted(want, key=str)
    clean = {r.doc_id: r for r in pii.redact(df).collect()}
    assert clean[1].text == "<email>" and clean[None].text is None and clean[1].spans == "s"
    assert pii.spans_of(df.limit(0)).count() == 0


def test_query_on_documents(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in pii.op9_pii_anchors(spark, sf).collect():
        found = base(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(pii.joined(found, pii.BASE).encode()).hexdigest()


def test_long_account_numbers_are_masked_whole():
    rng = random.Random(9)
    for cue in ("cuenta", "compte", "account", "konto"):
        for n in range(6, 35):
            digits = "".join(rng.choice("0123456789") for _ in range(n))
            for number in (digits, " ".join(re.findall(".{1,4}", digits)), "-".join(re.findall(".{1,5}", digits))):
                text = f"{cue}: {number}, then"
                assert pii.find_spans(text)["account"] == [(len(cue) + 2, len(cue) + 2 + len(number))], text
                assert not re.search("[0-9]", pii.masked(text, pii.find_spans(text))), text
    assert pii.find_spans("account 12345")["account"] == [] == pii.find_spans("account " + "1" * 35)["account"]
    assert pii.find_spans("account 12345678" + " 4321" * 9)["account"] == [(8, 16 + 5 * 6)]
