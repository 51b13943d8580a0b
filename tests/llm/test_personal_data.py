"""Personal data: spans against plain regular expressions, added kinds, odd tables."""

from __future__ import annotations

import hashlib
import random
import re
import time

import pytest

from ridepulse.llm import catalog, personal_data
from tests.conftest import SF_SMALL

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(number):
    total = 0
    for i, c in enumerate(reversed(number)):
        d = int(c) * (1 + i % 2)
        total += d // 10 + d % 10
    return total % 10 == 0


def brute(text):
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    spans = lambda rx, ok: [m.span() for m in rx.finditer(text) if ok(m)]
    return {
        "email": spans(EMAIL, lambda m: True),
        "ip": spans(IP, lambda m: all(int(x) <= 255 for x in m.group().split("."))),
        "card": spans(CARD, lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m))),
        "phone": spans(PHONE, lambda m: 8 <= len(digits(m)) <= 15),
    }


def text_of(spans):
    return ",".join(f"{k}:{a}:{b}" for k in personal_data.BASE_KINDS for a, b in spans[k])


@pytest.mark.parametrize("alphabet", ["ab@..-_ ", "12.. 5+9-", "0123456789 -+().", "a1@.:é/ +-9", "41 -"])
def test_base_spans_equal_regular_expressions(alphabet):
    rnd = random.Random(alphabet)
    for _ in range(4000):
        text = "".join(rnd.choices(alphabet, k=rnd.randrange(0, 60)))
        got = personal_data.find(text)
        assert {k: [tuple(s) for s in got[k]] for k in personal_data.BASE_KINDS} == brute(text), repr(text)


def test_query_equals_regular_expressions(spark):
    got = {r.doc_id: r for r in catalog.op13_personal_data(spark, SF_SMALL).collect()}
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    assert len(got) == len(docs) and sum(r.n_email + r.n_phone + r.n_ip + r.n_card for r in got.values()) > 10
    for d in docs:
        want, r = brute(d.text or ""), got[d.doc_id]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [len(want[k]) for k in personal_data.BASE_KINDS]
        assert r.base_sha256 == hashlib.sha256(text_of(want).encode()).hexdigest()
        assert r.spans.startswith(text_of(want))


@pytest.mark.parametrize(
    "text, kind, found",
    [
        ("IBAN: DE89 3704 0044 0532 0130 00, thanks", "iban", "DE89 3704 0044 0532 0130 00"),
        ("iban DE89370400440532013001", "iban", None),  # wrong check digits
        ("my account number: 12-345678-90 is", "account", "12-345678-90"),
        ("Passport no. C01234567.", "account", "C01234567"),
        ("accountant 12345678", "account", None),
        ("account of 3 people", "account", None),
        ("arossnng 123456789", "account", None),
        ("SSN 078-05-1120", "account", "078-05-1120"),
        ("an jürgen@müller.example geschrieben", "intl_email", "jürgen@müller.example"),
        ("an jurgen@muller.example geschrieben", "intl_email", None),
        ("ping 2001:db8::8a2e:370:7334.", "ipv6", "2001:db8::8a2e:370:7334"),
        ("at 12:30:45 and a::b::c", "ipv6", None),
        ("std::vector", "ipv6", None),
        ("ftp://bob:s3cret@files.example/x", "login", "bob:s3cret"),
        ("http://host.example/a:b@c", "login", None),
    ],
)
def test_added_kinds(text, kind, found):
    assert [text[a:b] for a, b in personal_data.find(text)[kind]] == ([found] if found else [])


def test_odd_rows(spark, make_docs):
    rows = [(1, None), (2, ""), (None, "a@b.c"), (3, "x@y.z +1 555 010 9999"), (3, "x@y.z +1 555 010 9999"), (4, "é\U0001f600 q@r.s")]
    got = sorted(map(tuple, personal_data.scan(make_docs(rows)).select("doc_id", "spans").collect()), key=repr)
    both = (3, "email:0:5,phone:6:21")
    assert got == sorted([(1, ""), (2, ""), (None, "email:0:5"), both, both, (4, "email:3:8")], key=repr)
    assert personal_data.scan(make_docs([])).collect() == []
    kept = personal_data.mask(make_docs(rows)).collect()
    assert [r.doc_id for r in kept] == [r[0] for r in rows] and {r.ids for r in kept} == {"x"}
    assert [r.text for r in kept][:3] == [None, "", "\u2588" * 5] and kept[5].text == "é\U0001f600 " + "\u2588" * 5


def test_runs_of_zeros_are_parts():
    text = "0" * 6000 + ".1.2.3 1.2.3." + "0" * 5000 + "255 1.2.3.256"
    assert personal_data.find(text)["ip"] == [(0, 6006), (6007, 6007 + 5009)]


@pytest.mark.parametrize("unit", ["a", "a@", "1", "1.", "+1", "a.", "1 ", "+1 (", "::", "f:", "account ", "x://a:"])
def test_long_texts_take_linear_time(unit):
    began = time.time()
    personal_data.find(unit * (400_000 // len(unit)) + "@")
    assert time.time() - began < 5
