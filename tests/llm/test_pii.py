import hashlib
import random
import re

from llm_helpers import read

from pingloom.llm import pii, queries

FIXED = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    other = [sum(divmod(2 * int(d), 10)) for d in digits[-2::-2]]
    return (sum(map(int, digits[::-2])) + sum(other)) % 10 == 0


def expected(text):
    found = []
    for kind, pattern in FIXED.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": lambda: True, "ip": lambda: all(int("0" + p.lstrip("0")[:4]) < 256 for p in m[0].split(".")),
                "card": lambda: 16 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 8 <= len(digits) <= 15,
            }
            if good[kind]():
                found.append((kind, m.start(), m.end()))
    return found


def named(text):
    return [(pii.KINDS[k], text[a:b]) for k, a, b in pii.spans_of(text)]


def fixed(text):
    return [(pii.KINDS[k], a, b) for k, a, b in pii.spans_of(text) if pii.KINDS[k] in pii.BASE]


def test_base_spans_match_the_patterns_on_crafted_texts():
    pick = random.Random(1)
    for alphabet in ("0123456789.@+-: a1b()éA_%/", "0123.", "01+- ()", "a.@-%", "4 -1", "::af0.1"):
        for _ in range(4000):
            text = "".join(pick.choice(alphabet) for _ in range(pick.randint(0, 45)))
            assert fixed(text) == expected(text), text
    for text in (
        "4111 1111 1111 1111", "4111-1111-1111-1111-9", "4111 1111 1111 1112", "1.2.3.4.5.6.7.8.9", "256.1.1.1 0001.002.3.4",
        "a@b.c@d.e", "+1 (499) 555-6503. +12345678(", "x@" + "a-" * 5000, "0" * 5000 + ".1.2.3",
    ):
        assert fixed(text) == expected(text), text


def test_query_matches_the_patterns(spark, odd_documents):
    documents = read(spark, "/root/testdata/sf0.01", "documents")
    wanted = {}
    for r in documents.collect():
        spans = expected(r["text"])
        digest = hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
        wanted[r["doc_id"]] = (*(sum(k == kind for k, _, _ in spans) for kind in pii.BASE), digest)
    found = queries.op11_anchor_expansion(spark, "/root/testdata/sf0.01").collect()
    assert {r["doc_id"]: (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]) for r in found} == wanted
    for r in found:
        own = [s for s in r["spans"].split(",") if s.split(":")[0] in pii.BASE]
        assert hashlib.sha256(",".join(own).encode()).hexdigest() == r["base_sha256"]


def test_anchors_expand_beyond_the_patterns():
    assert named("maría.lopez@exämple.de ok") == [("mailbox", "maría.lopez@exämple.de")]
    assert named("x@[192.168.1.1] y") == [("ip", "192.168.1.1"), ("mailbox", "x@[192.168.1.1]")]
    assert named("go ftp://bob:pw@host.com:21/x") == [("email", "pw@host.com"), ("login", "ftp://bob:pw@host.com:21")]
    assert named("http://a.b/c@d.e") == [("email", "c@d.e")]
    assert named("at 2001:0db8:85a3::8a2e:0370:7334.") == [("ip6", "2001:0db8:85a3::8a2e:0370:7334")]
    assert named("std::vector 12:30:45 a::b x:y") == []
    assert named("tel:0555-123 4567, Tel:12") == [("tel", "0555-123 4567")]
    assert named("IBAN: DE89 3704 0044 0532 0130 00 und") == [("iban", "DE89 3704 0044 0532 0130 00")]
    assert named("IBAN: DE88 3704 0044 0532 0130 00 und") == []
    assert named("Account no. 1234567890, acct#12-34-5678; account 12") == [("account", "1234567890"), ("account", "12-34-5678")]
    assert named("SSN 123-45-6789 ssn: 000-12-3456 ssn 123-45-678900") == [("ssn", "123-45-6789")]
    assert named("Passport number AB1234567, passports 123456") == [("passport", "AB1234567")]


def test_redaction_keeps_everything_else(spark, odd_documents):
    rows = [(1, "write to maría@exämple.de or a@b.co, +1 499 555-6503!", "s"), (2, None, "s"), (3, "", None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    done = {r["doc_id"]: tuple(r)[1:] for r in pii.redact(frame).collect()}
    assert done == {1: ("write to <mailbox> or <email>, <phone>!", "s"), 2: (None, "s"), 3: ("", None)}
    assert pii.hidden("ftp://bob:pw@host.com/") == "<login>/"
    assert pii.redact(odd_documents).columns == odd_documents.columns


def test_odd_rows(odd_documents, empty_documents):
    found = pii.find(odd_documents).collect()
    assert len(found) == odd_documents.count() and all(r["spans"] == [] for r in found)
    assert pii.find(empty_documents).count() == 0 and pii.redact(empty_documents).count() == 0
