import hashlib
import re

from panelfactors.llm.pii import op1_pii, pii_spans
from tests.conftest import SF_SMALL
from tests.llm.conftest import docs_frame

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
RANK = list(PLAIN)


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c)
        if i % 2:
            v = v * 2 - 9 if v > 4 else v * 2
        total += v
    return total % 10 == 0


def ok(kind, m):
    digits = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(p) <= 255 for p in m.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 10 <= len(digits) <= 15
    return True


def brute(text):
    found = [(m.start(), RANK.index(k), m.end(), k) for k, p in PLAIN.items()
             for m in re.finditer(p, text or "") if ok(k, m.group())]
    return [(k, s, e) for s, _, e, k in sorted(found)]


def got(df):
    return [[(s.kind, s.start, s.end) for s in r.spans] for r in df.orderBy("doc_id").collect()]


CASES = [
    None, "", "plain words only", "a.b+c@x.y-z.org, write", "a@b.c_d@e.f", "x@y@z.w", "a@b", "@a.b", "é😀 me@ex.co 1.2.3.4",
    "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.0255 9.9.9", "4539 1488 0343 6467 then 4539-1488-0343-6468",
    "+1 (415) 555-2671 +12 +1-2-3 ++44 20 7946 0958", "+1+1+1 1 2 3", "12345678901234567890123456789", "a@b.c.", "%@%.%",
    "x" * 3000 + "@y.z", "1." * 3000, "a@" + "b." * 9000 + "c", "7 " * 4000,
]


def test_base_spans_match_plain_patterns(spark):
    for row, text in zip(got(pii_spans(docs_frame(spark, CASES, extra={"spans": "x", "digits": "y", "text_": "z"}))), CASES):
        assert [s for s in row if s[0] in PLAIN] == brute(text), text and text[:80]


def test_added_kinds_need_checksum_or_context(spark):
    texts = ["IBAN DE89 3704 0044 0532 0130 00 here", "DE89 3704 0044 0532 0130 01", "ssn 123-45-6789", "code 123-45-6789",
             "call me 555 123 4567 now", "sizes 555 123 4567 now"]
    kinds = [[s[0] for s in r if s[0] not in PLAIN] for r in got(pii_spans(docs_frame(spark, texts)))]
    assert kinds == [["iban"], [], ["ssn"], [], ["tel"], []]


def test_context_raises_the_score(spark):
    rows = pii_spans(docs_frame(spark, ["card 4539 1488 0343 6467", "abcd 4539 1488 0343 6467"])).orderBy("doc_id").collect()
    assert rows[0].spans[0].score > rows[1].spans[0].score


def test_repeated_rows_and_empty_table(spark):
    df = docs_frame(spark, ["me@x.org"] * 3, ids=[4, 4, None])
    assert got(pii_spans(df)) == [[("email", 0, 8)]] * 3
    assert pii_spans(df.limit(0)).count() == 0


def test_query_digest(spark, sample_texts):
    rows = op1_pii(spark, SF_SMALL).collect()
    assert len(rows) == len(sample_texts)
    for r in rows:
        spans = brute(sample_texts[r.doc_id]["text"])
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[0] == k for s in spans) for k in RANK)


def test_added_kinds_end_before_what_follows(spark):
    de, de4 = "DE89370400440532013000", "DE89 3704 0044 0532 0130 00"
    cases = [(f"IBAN {de4} Thanks", "iban", de4), (f"account {de} Please", "iban", de), (f"bank {de4} 2024", "iban", de4),
             (f"bank {de4} A", "iban", de4), ("bank NO93 8601 1117 947 For 1", "iban", "NO93 8601 1117 947"),
             ("bank GB29 NWBK 6016 1331 9268 19 GB29", "iban", "GB29 NWBK 6016 1331 9268 19"), (f"call {de4}", "iban", de4),
             ("call 555 123 4567 2024", "tel", "555 123 4567"), ("call (555) 123-4567 42424", "tel", "(555) 123-4567"),
             ("call 01 23 45 67 89 2024", "tel", "01 23 45 67 89"), ("call 1234 1234 1234", "tel", "1234 1234 1234")]
    two = "bank DE89370400440532013000 GB29NWBK60161331926819, call 555 123 4567 555 765 4321 (phone)"
    rows = got(pii_spans(docs_frame(spark, [c[0] for c in cases] + [two, f"{de4}X", "card 4539 1488 0343 6467 phone", "7 " * 4000 + "call"])))
    for row, (text, kind, span) in zip(rows, cases):
        assert [(k, text[s:e]) for k, s, e in row if k not in PLAIN] == [(kind, span)], text
    assert [two[s:e] for k, s, e in rows[len(cases)] if k not in PLAIN] == [
        "DE89370400440532013000", "GB29NWBK60161331926819", "555 123 4567", "555 765 4321"]
    assert [[k for k, _, _ in r if k not in PLAIN] for r in rows[-3:]] == [[], [], []]
