import random
import re

from panelfactors.llm.quality_rules import keep_good, op3_quality_rules, quality
from tests.conftest import SF_SMALL
from tests.llm.conftest import docs_frame

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    at = {}
    for i in range(len(words) - 7):
        at.setdefault(tuple(words[i:i + 8]), []).append(i)
    repeat = {j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + 8)}
    failed = len(words) < 20 or 100 * len(repeat) > 30 * len(words)
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)),
            len(repeat), failed)


COLS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
BODY = " ".join(f"w{i}" for i in range(60))
CASES = [None, "", " \n\t ", "one", "a " * 100, BODY, BODY + "\n" + BODY, BODY + " x " + " ".join(BODY.split()[10:22]),
         "a\na\n\n b \nb", "é😀#*$%&|<>\x0b\x0c\r", "a\u00a0b\u2028c " * 8, "x" * 200_000, "t u v " * 40_000,
         " ".join(str(i % 9999) for i in range(20_000))]


def test_base_rules(spark):
    df = quality(docs_frame(spark, CASES, extra={"kept": "x", "key": "y", "line": "z", "words": "q"}))
    got = {r.doc_id: r for r in df.collect()}
    for i, text in enumerate(CASES):
        assert tuple(got[i][c] for c in COLS) == brute(text), i
        assert not (got[i].base_failed and got[i].kept)


def test_boilerplate_is_counted_per_host_and_copies_once(spark):
    spam = [f"Buy cheap things here today now {i} \nClick this link to win a big prize now\nz{i} q{i}" + " pad" * 3 for i in range(40)]
    name = [chr(97 + i // 26) + chr(97 + i % 26) for i in range(60)]   # digits fold to 0, so letters tell texts apart
    good = [f"{BODY} unique {n}\nbody {n} line {' '.join(n + m for m in name[:20])}" for n in name]
    copies = [BODY + " same text in many rows\n" + BODY.upper()] * 50
    texts = spam + good + copies
    sources = ["spam"] * 40 + ["good"] * 60 + ["good"] * 50
    rows = {r.doc_id: r for r in quality(docs_frame(spark, texts, sources)).collect()}
    assert not any(rows[i].kept for i in range(40)) and all(rows[i].removed_lines >= 1 for i in range(40))
    assert all(rows[i].kept for i in range(40, 150))
    # one host only: the same line elsewhere stays
    other = docs_frame(spark, spam + [spam[0] + BODY], ["spam"] * 40 + ["else"])
    last = quality(other).where("doc_id = 40").first()
    assert last.removed_lines == 0 and last.kept


def test_repeated_rows_null_keys_and_clashing_columns(spark):
    df = docs_frame(spark, [BODY, BODY, BODY, "few"], sources=[None, None, "a", None], ids=[None, None, 3, 3],
                    extra={"quality_key": "k", "kept": "no"})
    out = keep_good(df)
    assert out.columns == df.columns and out.count() == 3
    assert keep_good(df.limit(0)).count() == 0 and quality(df.limit(0)).count() == 0


def test_query(spark, sample_texts):
    rows = op3_quality_rules(spark, SF_SMALL).collect()
    assert len(rows) == len(sample_texts)
    for r in rows:
        assert tuple(r[c] for c in COLS) == brute(sample_texts[r.doc_id]["text"])
    assert sum(r.kept for r in rows) > 0.8 * sum(not r.base_failed for r in rows)


def near_copy_group(n, lines, words, edits=1):
    """n texts of one base, each with ``edits`` words of its own."""
    r = random.Random(n)
    out = []
    for i in range(n):
        t = [[f"{chr(97 + a)}line{chr(97 + b)}" for b in range(words)] for a in range(lines)]
        for _ in range(edits):
            t[r.randrange(lines)][r.randrange(words)] = "own" + "".join(chr(97 + int(c)) for c in str(i))
        out.append("\n".join(map(" ".join, t)))
    return out


def test_near_copies_count_as_one(spark):
    """A third of a host, and 6 of a small source: no member is rejected, spam beside them still is."""
    name = [chr(97 + i // 26) + chr(97 + i % 26) for i in range(120)]
    plain = [f"{BODY} unique {n}\nbody {n} line {' '.join(n + m for m in name[:20])}" for n in name]
    spam = [f"Buy cheap things here today now {i:02d} \nClick this link to win a big prize now\nz{i} q{i}" + " pad" * 3 for i in range(40)]
    groups = [near_copy_group(80, 10, 8), near_copy_group(80, 10, 8, edits=2), near_copy_group(80, 5, 25), near_copy_group(6, 12, 6)]
    for g in groups:
        others = plain + spam if len(g) > 6 else plain[:60]
        rows = {r.doc_id: r for r in quality(docs_frame(spark, g + others, ["h"] * (len(g) + len(others)))).collect()}
        assert all(rows[i].kept and rows[i].removed_lines == 0 for i in range(len(g)))
        bad = set(range(len(g) + len(plain), len(g) + len(others)))
        assert {i for i in rows if not rows[i].kept} == bad and all(rows[i].removed_lines for i in bad)


def test_boilerplate_lines_are_removed_from_the_text(spark):
    name = [chr(97 + i // 26) + chr(97 + i % 26) for i in range(60)]
    texts = [f"\n{BODY.replace('w', n)}\n\nAll rights reserved {i:02d}\r\n {' '.join(n + m for m in name[:10])} " for i, n in enumerate(name)]
    want = ["\n".join(x for x in t.split("\n") if not x.startswith("All rights")) for t in texts]
    texts, want = texts + texts[:1] + [BODY + "\nno line in common"], want + want[:1] + [BODY + "\nno line in common"]
    df = docs_frame(spark, texts, ["h"] * len(texts), ids=[*range(60), 0, 60], extra={"quality_at": "x", "no": "y"})
    out = keep_good(df).collect()
    assert sorted((r.doc_id, r.text, r.n_chars) for r in out) == sorted((i, t, len(t)) for i, t in zip([*range(60), 0, 60], want))
    rows = quality(df).collect()
    assert sorted((r.doc_id, r.clean_text) for r in rows) == sorted(zip([*range(60), 0, 60], want))
    assert all(r.removed_lines == (r.doc_id < 60) for r in rows)
