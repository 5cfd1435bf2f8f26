"""Personal data against plain patterns, and the spans that the method adds."""

import hashlib
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from mapstrata.llm import pii
from mapstrata.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"

# The contract's patterns, as given.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits(text):
    return re.sub("[^0-9]", "", text)


def checked(number):
    total = 0
    for n, d in enumerate(reversed(number)):
        d = int(d) * (1 + n % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def brute_base(text):
    text = text or ""
    spans = [("email", *m.span()) for m in EMAIL.finditer(text)]
    spans += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    spans += [("card", *m.span()) for m in CARD.finditer(text) if 16 <= len(d := digits(m.group())) <= 19 and checked(d)]
    return spans + [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(digits(m.group())) <= 15]


def base_of(text):
    return [(s["kind"], s["start"], s["end"]) for s in pii.spans_in(text) if s["kind"] in pii.BASE_KINDS]


@settings(max_examples=600, deadline=None)
@given(st.text(alphabet="a1@.-_ +(2é5%", max_size=40))
def test_base_kinds(text):
    assert base_of(text) == brute_base(text)


@settings(max_examples=600, deadline=None)
@given(st.text(alphabet="0123456789012345678901234567890 -a", min_size=10, max_size=60))
def test_cards(text):
    assert base_of(text) == brute_base(text)


@pytest.mark.parametrize("unit", ["a", "1", "1.", "@a.", "+1(", "a@", "1 ", "DE12", "a@b.c@", "(212) "])
def test_one_long_word(unit):
    """Work grows with the text, not with its square."""
    text = unit * (400_000 // len(unit))
    began = time.process_time()
    pii.spans_in(text)
    assert time.process_time() - began < 10


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("IBAN DE89 3704 0044 0532 0130 00.", [("iban", 5, 32)]),
        ("IBAN DE88 3704 0044 0532 0130 00.", []),
        ("GB82WEST12345698765432", [("iban", 0, 22)]),
        ("xGB82WEST12345698765432", []),
        ("GB82WEST123456987654321", []),
        ("amex 3782 822463 10005", [("short_card", 5, 22)]),
        ("number 3782 822463 10006", []),
        ("visa 4222222222222", [("short_card", 5, 18)]),
        ("4222222222222", []),
        ("7 4785-3805-9239-1139 1", [("card_group", 2, 21)]),
        ("ssn 123-45-6789", [("ssn", 4, 15)]),
        ("ssn 666-45-6789", []),
        ("part 123-45-6789", []),
        ("123-45-6789", []),
        ("call (212) 555-0100", [("national_phone", 5, 19)]),
        ("(212) 555-0100", []),
        ("card 4111111111111111", [("card", 5, 21)]),
        ("v 1.2.3.4 mail a@b.c", [("email", 15, 20), ("ip", 2, 9)]),
        (None, []),
        ("", []),
    ],
)
def test_added_kinds(text, expected):
    assert [(s["kind"], s["start"], s["end"]) for s in pii.spans_in(text)] == expected


def test_scores_follow_checks_and_words():
    by_word = {w: pii.spans_in(f"{w} 1.2.3.4")[0]["score"] for w in ("server", "nothing", "version")}
    assert by_word["server"] > by_word["nothing"] > by_word["version"]
    assert pii.spans_in("version 1.2.3.4")[0]["score"] < pii.LEAST_SCORE  # base spans stay


def test_columns_of_any_name(spark):
    texts = [None, "", "mail x@y.zz and +1 (743) 555-3824", "ünï x@y.zz", "ünï x@y.zz", "a@b.c;" * 3]
    rows = [(n, t, "keep", 1, "k") for n, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, pii string, kind long, spans string")
    found = docs.withColumn("found", pii.pii_spans("text")).withColumn("text", pii.redacted("text")).orderBy("doc_id").collect()
    assert [(r.pii, r.kind, r.spans) for r in found] == [("keep", 1, "k")] * len(texts)
    assert [r.text for r in found] == [None, "", "mail [EMAIL] and [PHONE]", "ünï [EMAIL]", "ünï [EMAIL]", "[EMAIL];[EMAIL];[EMAIL];"]
    assert [[(s.kind, s.start, s.end) for s in r.found] for r in found][3] == [("email", 4, 10)]
    assert docs.limit(0).select(pii.pii_spans("text")).count() == 0


def test_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    found = QUERIES["op11_pii"](spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in found) == sorted(docs)
    for r in found:
        spans = brute_base(docs[r.doc_id])
        listed = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for k, _, _ in spans) for kind in pii.BASE_KINDS]
        assert set(listed.split(",")) - {""} <= set(r.spans.split(","))
    assert sum(r.n_email for r in found) > 5 and sum(r.n_card for r in found) > 5


def test_query_on_planted_texts(spark, tmp_path):
    """Spans of the query are those of the patterns, and the added ones, in order of kind and start."""
    text = "call (212) 555-0100, IBAN DE89 3704 0044 0532 0130 00, b@c.d, +49 30 1234567, a@c.d, 4111 1111 1111 1111"
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, text, "en", "s", 1), (2, None, None, None, None)]
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    one, none = sorted(QUERIES["op11_pii"](spark, str(tmp_path)).collect())
    kinds = [s.split(":")[0] for s in one.spans.split(",")]
    assert kinds == ["email", "email", "card", "phone", "iban", "national_phone"]
    assert (none.spans, none.base_sha256) == ("", hashlib.sha256(b"").hexdigest())
