"""Secret scanning with a trigram inverted index over the documents.

Each rule's regular expression is turned into a Boolean trigram query: an OR of
clauses, each an AND of trigrams that any match must contain (in lower case).
The index has a posting (trigram, document) for every trigram that some query
uses.  Postings are intersected per clause by counting, the documents that
satisfy a clause are the rule's candidates, and only those are verified with
the regular expression.  A rule without mandatory trigrams scans every
document.

Rules are a short fixed list, so the clause table is a literal and the look-up
of a posting needs no shuffle; postings and candidates are small rows keyed by
document, so a frequent trigram spreads over all tasks.

NULL text counts as empty.  Repeated rows get the same spans; rows without
spans are kept with an empty list.  Extra columns are ignored here; ``redact``
passes them on.
"""

from __future__ import annotations

import re._constants as sre
import re._parser as sre_parser
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, greatest_before, let, match_positions, row_key, span_digest, table, text_of

NO_SPANS = "CAST(array() AS array<struct<start:int,rank:int,end:int,kind:string,match:string>>)"


@dataclass(frozen=True)
class Rule:
    name: str
    pattern: str
    valid: str = "true"    # SQL predicate over ``s.match``
    base: bool = False


_ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""

#: base kinds of the contract, then the added ones.  The length conditions of
#: access and hex are part of the pattern: their matches are whole runs, so a
#: short run cannot hold a long one.  That of assign is not, as a dropped match
#: must not be retried further right.
RULES = (
    Rule("assign", _ASSIGN, "length(regexp_extract(s.match, ASSIGN, 2)) >= 12", True),
    Rule("access", r"AKIA[A-Z0-9]{14,}", base=True),
    Rule("hex", r"(?<![0-9a-f])[0-9a-f]{16,}", base=True),
    Rule("privkey", r"-----BEGIN (?:RSA |EC |DSA |OPENSSH |PGP )?PRIVATE KEY"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("urlauth", r"[a-z]{3,10}://[A-Za-z0-9._~-]+:[A-Za-z0-9._~!$&*+=%-]{6,}@"),
)
BASE = tuple(r.name for r in RULES if r.base)
MAX_FORMS = 64


def _forms(items, icase: bool = False) -> list[list[str]]:
    """The alternatives of a parsed pattern, each a list of literal runs that every match of it contains in order.

    ``""`` at a run's border marks that the text there is not known, so a run
    is never joined over it.
    """
    forms: list[list[str]] = [[""]]

    def extend(options: list[list[str]]) -> None:
        nonlocal forms
        if len(forms) * len(options) > MAX_FORMS:
            options = [["", ""]]   # anything may stand here: breaks the run
        forms = [f[:-1] + [f[-1] + o[0]] + o[1:] for f in forms for o in options]

    for op, arg in items:
        if op is sre.LITERAL:
            extend([[chr(arg).lower()]])
        elif op is sre.IN and len(arg) <= 4 and all(o is sre.LITERAL for o, _ in arg):
            extend([[c] for c in sorted({chr(v).lower() for _, v in arg})])
        elif op is sre.SUBPATTERN:
            extend(_forms(arg[3]))
        elif op is sre.BRANCH:
            extend([f for branch in arg[1] for f in _forms(branch)])
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.POSSESSIVE_REPEAT):
            least, most, body = arg
            once = _forms(body)
            if least == 0 and most == 1:
                extend([[""], *once])
            elif least == 0:
                extend([["", ""]])
            else:
                for _ in range(min(int(least), 3)):
                    extend(once)
                if most != least or least > 3:
                    extend([["", ""]])
        elif op in (sre.ASSERT, sre.ASSERT_NOT, sre.AT):
            pass
        else:
            extend([["", ""]])
    return forms


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """Clauses of mandatory lower-case trigrams, one of which every match satisfies; None: no such query."""
    clauses = {frozenset(run[i:i + 3] for run in form for i in range(len(run) - 2))
               for form in _forms(sre_parser.parse(pattern))}
    if frozenset() in clauses:
        return None
    return sorted((c for c in clauses if not any(o < c for o in clauses)), key=sorted)


def postings(keyed: DataFrame, trigrams: list[str]) -> DataFrame:
    """(key, trigram) for each of ``trigrams`` that the lower-cased text of a document holds."""
    d = keyed.select("key", F.lower("text").alias("text"))
    return d.select("key", F.explode(F.filter(
        F.array(*[F.when(F.contains("text", F.lit(t)), F.lit(t)) for t in trigrams]),
        lambda t: t.isNotNull())).alias("trigram")).distinct()


def candidates(keyed: DataFrame, rules=RULES) -> DataFrame:
    """key and the indices (``hits``) of the indexed rules whose trigram query the document satisfies."""
    clauses = [(i, n, c) for i, r in enumerate(rules) for n, c in enumerate(trigram_query(r.pattern) or [])]
    spark = keyed.sparkSession
    if not clauses:
        return keyed.select("key", F.expr("CAST(array() AS array<int>)").alias("hits")).limit(0)
    needed = spark.createDataFrame([(t, i, n, len(c)) for i, n, c in clauses for t in sorted(c)],
                                   "trigram string, rule int, clause int, size int")
    met = (postings(keyed, sorted({t for _, _, c in clauses for t in c}))
           .join(F.broadcast(needed), "trigram")   # a few rows per rule of the fixed list
           .groupBy("key", "rule", "clause", "size").agg(F.count(F.lit(1)).alias("n"))
           .where("n = size"))
    return met.groupBy("key").agg(F.collect_set("rule").alias("hits"))


def _spans(d: DataFrame, rules, which: list[int], guard: str) -> DataFrame:
    """``d`` (key, text, ...) with ``spans`` of the rules in ``which``; ``guard``: SQL test by rule index ``{i}``."""
    rest = [c for c in d.columns if c != "text"]
    d = d.select("*", *[F.when(F.expr(guard.format(i=i)), F.regexp_extract_all(
        "text", F.lit(rules[i].pattern), F.lit(0))).alias(f"m_{i}") for i in which])
    d = d.select("*", *[F.when(F.size(f"m_{i}") > 0, F.split("text", rules[i].pattern, -1)).alias(f"p_{i}")
                        for i in which])
    d = d.select(*rest, *[F.when(F.size(f"m_{i}") > 0, match_positions(f"m_{i}", f"p_{i}")).alias(f"found_{i}")
                          for i in which])
    assign = "'" + _ASSIGN.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return d.select(*rest, F.concat(*[F.coalesce(F.expr(f"""transform(
        filter(found_{i}, s -> {rules[i].valid.replace('ASSIGN', assign)}), s -> named_struct(
            'start', s.start, 'rank', {i}, 'end', s.end, 'kind', '{rules[i].name}', 'match', s.match))"""),
        F.expr(NO_SPANS)) for i in which]).alias("spans"))


def secret_spans(docs: DataFrame, rules=RULES) -> DataFrame:
    """key, doc_id and ``spans``: array of (start, rank, end, kind, match) by start then kind; one row per input row."""
    keyed = docs.select(row_key(docs).alias("key"), "doc_id", text_of(docs).alias("text"))
    indexed = [i for i, r in enumerate(rules) if trigram_query(r.pattern)]
    scanned = [i for i in range(len(rules)) if i not in indexed]
    every = keyed.select("key", "doc_id", "text")
    every = _spans(every, rules, scanned, "true") if scanned else every.select("key", "doc_id", F.expr(NO_SPANS).alias("spans"))
    if not indexed:
        return every.withColumn("spans", F.array_sort("spans"))
    verified = _spans(keyed.select("key", "text").join(candidates(keyed, rules), "key"), rules, indexed,
                      "array_contains(hits, {i})")
    # no filter on the spans here: pushed below them, it would run the patterns anew for every match
    verified = verified.groupBy("key").agg(F.first("spans").alias("more"))   # repeated rows: one entry
    return every.join(verified, "key", "left").select("key", "doc_id", F.array_sort(F.concat(
        "spans", F.coalesce("more", F.expr(NO_SPANS)))).alias("spans"))


def _merged(spans: str) -> str:
    """SQL of the spans (in order of their starts) with overlapping ones merged: a span that starts inside an earlier one extends it."""
    return let("ends", f"transform({spans}, s -> s.end)", let("most", "array_max(ends)", let(
        "reach", greatest_before("ends"), let(
            "heads", f"filter(sequence(0, size(ends) - 1), i -> i = 0 OR {spans}[i].start >= reach[i])", f"""
            transform(heads, (h, j) -> named_struct('start', {spans}[h].start,
                                                    'end', coalesce(get(reach, get(heads, j + 1)), most)))"""))))


def _between(text: str, spans: str) -> str:
    """SQL of the pieces of text before each of the disjoint spans.

    A substring walks the text from its start, so blocks of spans are cut out
    first, about the square root of their number each.
    """
    def end(i, first):
        return f"if(i = 0, {first}, part[{i}].end)"
    return let("step", f"greatest(1, cast(ceil(sqrt(size({spans}))) as int))", f"""
        flatten(transform(sequence(0, cast((size({spans}) - 1) div step as int)), b -> {
            let("part", f"slice({spans}, b * step + 1, step)", let("at", f"if(b = 0, 0, {spans}[b * step - 1].end)", let(
                "cut", f"substring({text}, at + 1, element_at(part, -1).end - at)", f"""
                transform(part, (s, i) -> substring(cut, {end('i - 1', 'at')} - at + 1, s.start - {end('i - 1', 'at')}))""")))}))""")


def redact(docs: DataFrame, rules=RULES, mark: str = "[SECRET]") -> DataFrame:
    """The input rows with every secret span of the text replaced by ``mark``; all columns stay.

    Overlapping spans are merged into one mark.  ``n_chars``, if there, is set
    to the new length where the text changed.
    """
    name, spans = fresh(docs, "secret_key"), fresh(docs, "secret_spans")
    found = (secret_spans(docs, rules).where("size(spans) > 0").groupBy("key").agg(F.first("spans").alias(spans))
             .select(F.col("key").alias(name), F.expr(_merged(spans)).alias(spans)))
    d = docs.withColumn(name, row_key(docs)).join(found, name, "left")
    text = F.when(F.col(spans).isNull(), F.col("text")).otherwise(F.concat(
        F.array_join(F.expr(_between("text", spans)), mark), F.lit(mark),
        F.expr(f"substring(text, element_at({spans}, -1).end + 1)")))
    d = d.withColumn("text", text)
    if "n_chars" in docs.columns:
        d = d.withColumn("n_chars", F.when(F.col(spans).isNull(), F.col("n_chars"))
                         .otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return d.select(*docs.columns)


def op4_secret_scans(spark, sf_dir: str) -> DataFrame:
    """Contract digest over all ``documents``."""
    d = secret_spans(table(spark, sf_dir, "documents"))
    names = ", ".join(f"'{n}'" for n in BASE)
    d = d.select("doc_id", "spans", F.expr(f"filter(spans, s -> s.kind IN ({names}))").alias("base"))
    return d.select(
        "doc_id",
        *[F.expr(f"CAST(size(filter(base, s -> s.kind = '{n}')) AS bigint)").alias(f"n_{n}") for n in BASE],
        F.sha2(span_digest("base"), 256).alias("base_sha256"),
        span_digest("spans").alias("spans"))
