"""Personal data spans: regular expressions propose, checksums confirm, context words score.

Every kind has one pattern over the whole text.  Patterns use possessive
quantifiers and start-of-run look-behinds, which give the same leftmost,
non-overlapping matches as the plain forms but never rescan a run, so a very
long run of digits or name characters stays linear.  An IBAN ends at its
country's length and a ``tel`` at a group within 12 digits, so neither takes in
the words or numbers that follow.

Scores: a kind starts at its prior, a passed checksum adds ``CHECKSUM``, a
context word within ``WINDOW`` characters before the span (or half of that
after it) adds ``CONTEXT``.  Base kinds are always kept, whatever their score;
added kinds need ``threshold``:

* ``iban``: ISO 13616 account numbers, confirmed by mod-97 (a country that is
  not in the table: the longest run of 15 to 34 characters);
* ``ssn``: ``ddd-dd-dddd`` outside the never-issued ranges, needs a context word;
* ``tel``: 9 to 12 digits in groups without a leading plus, needs a context
  word; not inside a confirmed IBAN, not part of 16 digits in fours.

A NULL text counts as empty; a text without matches has an empty span list.
Rows are judged one by one (no shuffle), so repeated rows repeat their result
and extra input columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import match_positions, span_digest, text_of

CHECKSUM, CONTEXT, WINDOW = 0.4, 0.35, 40


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    gate: str          # cheap SQL test of the row; a row that fails it cannot match
    valid: str         # SQL predicate over ``s.match``
    prior: float
    checksum: bool
    context: str       # context words, an alternation
    base: bool


def _octets(m: str) -> str:
    return f"rlike({m}, '^0*(25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])([.]0*(25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9]))\\{{3\\}}$')" \
        .replace("\\{", "{").replace("\\}", "}")


def _digits(m: str) -> str:
    return f"regexp_replace({m}, '[^0-9]', '')"


def _luhn(m: str) -> str:
    d = _digits(m)
    return f"""(length({d}) BETWEEN 14 AND 19 AND aggregate(
        transform(reverse(split({d}, '')), (c, i) ->
            CASE WHEN i % 2 = 0 THEN int(c) WHEN int(c) > 4 THEN int(c) * 2 - 9 ELSE int(c) * 2 END),
        0, (a, v) -> a + v) % 10 = 0)"""


def _mod97(m: str) -> str:
    c = f"replace({m}, ' ', '')"
    return f"""(length({c}) BETWEEN 15 AND 34 AND aggregate(
        split(concat(substring({c}, 5), substring({c}, 1, 4)), ''), 0, (a, x) ->
            CASE WHEN x BETWEEN '0' AND '9' THEN (a * 10 + int(x)) % 97
                 ELSE (a * 100 + ascii(x) - 55) % 97 END) = 1)"""


#: IBAN lengths by country (ISO 13616 registry)
IBAN_COUNTRIES = {
    15: "NO", 16: "BE", 18: "DK|FI|FK|FO|GL|NL|SD", 19: "MK|SI", 20: "AT|BA|EE|KZ|LT|LU|MN|XK", 21: "CH|HR|LI|LV",
    22: "BG|BH|CR|DE|GB|GE|IE|ME|RS|VA", 23: "AE|GI|IL|IQ|OM|SO|TL", 24: "AD|CZ|ES|MD|PK|RO|SA|SE|SK|TN|VG", 25: "LY|PT|ST",
    26: "IS|TR", 27: "BI|DJ|FR|GR|IT|MC|MR|SM", 28: "AL|AZ|BY|CY|DO|GT|HN|HU|LB|NI|PL|SV", 29: "BR|EG|PS|QA|UA",
    30: "JO|KW|MU|YE", 31: "MT|SC", 32: "LC", 33: "RU",
}


def _iban() -> str:
    known = "|".join(f"(?:{c})[0-9]{{2}}(?: ?[A-Z0-9]){{{n - 4}}}" for n, c in IBAN_COUNTRIES.items())
    other = f"(?!{'|'.join(IBAN_COUNTRIES.values())})[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]){{11,30}}"
    return f"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{known}|{other})(?![A-Za-z0-9])"


def _tel(groups: int = 1, digits: int = 0) -> str:
    """Groups of 2 to 4 digits, 3 to 5 of them with 9 to 12 digits in all; the longest first."""
    fours = r"(?![0-9]{4}(?:[ .-][0-9]{4}){3}(?![0-9]))(?!(?<=[0-9]{4}[ .-])[0-9]{4}(?:[ .-][0-9]{4}){2}(?![0-9]))"
    before, after = (r"(?<![0-9+().-])" + fours + r"\(?", r"\)?") if groups == 1 else ("[ .-]", "")
    out = []
    for n in (4, 3, 2):
        if digits + n <= 12:
            end = ["(?![0-9-])"] if groups >= 3 and digits + n >= 9 else []
            more = [_tel(groups + 1, digits + n)] if groups < 5 and digits + n <= 10 else []
            if end or more:
                out.append(f"[0-9]{{{n}}}(?![0-9]){after}(?:{'|'.join(more + end)})")
    return f"{before}(?:{'|'.join(out)})" if out else "(?!)"


KINDS = (
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         "instr(text, '@') > 0", "true", 0.8, False, "mail|contact|write", True),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
         "digits", _octets("s.match"), 0.6, False, "ip|host|server|address|login", True),
    Kind("card", r"[0-9](?:[ -]?[0-9])++",
         "digits", _luhn("s.match"), 0.3, True, "card|visa|credit|payment|pay", True),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]",
         "digits AND instr(text, '+') > 0", f"length({_digits('s.match')}) BETWEEN 10 AND 15",
         0.6, False, "phone|call|tel|mobile|fax", True),
    Kind("iban", _iban(),
         "digits", _mod97("s.match"), 0.3, True, "iban|account|bank|konto|cuenta|compte", False),
    Kind("ssn", r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
         "digits AND instr(text, '-') > 0", "true", 0.3, False, "ssn|social|security|insurance", False),
    Kind("tel", _tel(),
         "digits", f"length({_digits('s.match')}) BETWEEN 9 AND 12", 0.3, False,
         "phone|call|tel|mobile|fax", False),
)
BASE = tuple(k.name for k in KINDS if k.base)


def _scored(k: Kind, rank: int, threshold: float) -> Column:
    """The confirmed spans of one kind with their score."""
    near = f"""(rlike(lower(right(s.before, {WINDOW})), '\\\\b(?:{k.context})')
                OR rlike(lower(left(s.after, {WINDOW // 2})), '\\\\b(?:{k.context})'))"""
    score = f"least(1.0D, {k.prior}D + {CHECKSUM if k.checksum else 0.0}D + if({near}, {CONTEXT}D, 0.0D))"
    keep = "true" if k.base else f"s.score >= {threshold}D"
    return F.expr(f"""filter(transform(filter(found_{k.name}, s -> {k.valid}), s -> named_struct(
        'start', s.start, 'rank', {rank}, 'end', s.end, 'kind', '{k.name}', 'match', s.match,
        'score', {score})), s -> {keep})""")


def pii_spans(docs: DataFrame, threshold: float = 0.6, kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """doc_id and ``spans``: array of (start, rank, end, kind, match, score), by start then kind.

    ``threshold``: least score of a span of an added kind.
    """
    d = docs.select("doc_id", text_of(docs).alias("text"))
    d = d.select("*", F.col("text").rlike("[0-9]").alias("digits"))
    d = d.select("*", *[
        F.when(F.expr(k.gate), F.regexp_extract_all("text", F.lit(k.pattern), F.lit(0))).alias(f"m_{k.name}")
        for k in kinds])
    d = d.select("*", *[
        F.when(F.size(f"m_{k.name}") > 0, F.split("text", k.pattern, -1)).alias(f"p_{k.name}") for k in kinds])
    d = d.select("doc_id", *[
        F.when(F.size(f"m_{k.name}") > 0, match_positions(f"m_{k.name}", f"p_{k.name}"))
        .otherwise(F.expr("CAST(array() AS array<struct<start:int,end:int,match:string,before:string,after:string>>)"))
        .alias(f"found_{k.name}") for k in kinds])
    d = d.select("doc_id", F.array_sort(F.concat(*[
        _scored(k, i, threshold) for i, k in enumerate(kinds)])).alias("spans"))
    # an IBAN is not cut into telephone numbers
    return d.select("doc_id", F.expr("""filter(spans, s -> s.kind <> 'tel' OR NOT exists(
        spans, o -> o.kind = 'iban' AND o.start < s.end AND s.start < o.end))""").alias("spans"))


def op1_pii(spark, sf_dir: str) -> DataFrame:
    """Contract digest over all ``documents``: counts of the base kinds, hash of the base spans, all spans."""
    from .common import table
    d = pii_spans(table(spark, sf_dir, "documents"))
    names = ", ".join(f"'{n}'" for n in BASE)
    d = d.select("*", F.expr(f"filter(spans, s -> s.kind IN ({names}))").alias("base"))
    return d.select(
        "doc_id",
        *[F.expr(f"CAST(size(filter(base, s -> s.kind = '{n}')) AS bigint)").alias(f"n_{n}") for n in BASE],
        F.sha2(span_digest("base"), 256).alias("base_sha256"),
        span_digest("spans").alias("spans"))
