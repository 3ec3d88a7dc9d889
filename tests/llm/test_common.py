import random
import re
import time

from pyspark.sql import functions as F

from panelfactors.llm.common import match_positions
from panelfactors.llm.pii import pii_spans
from panelfactors.llm.secret_scan import secret_spans
from tests.llm.conftest import docs_frame


def test_match_positions_equal_finditer(spark):
    r = random.Random(3)
    texts = ["", "none", "7", "77 é 8日9", *["".join(r.choice("ab é日😀123 ") for _ in range(n)) for n in (1, 2, 5, 9, 50, 300, 4000)]]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    df = df.select("*", F.regexp_extract_all("text", F.lit("[0-9]+"), F.lit(0)).alias("m"), F.split("text", "[0-9]+", -1).alias("p"))
    for x in df.select("id", match_positions("m", "p").alias("found")).collect():
        t = texts[x.id]
        want = list(re.finditer("[0-9]+", t))
        assert [(f.start, f.end, f.match) for f in x.found] == [(m.start(), m.end(), m[0]) for m in want]
        assert "".join(f.before + f.match for f in x.found) + (x.found[-1].after if want else t) == t


def test_many_matches_in_one_text(spark):
    """20,000 matches of a kind in one text; a copy of the list per match would take minutes."""
    n = 20_000
    texts = {"ip": "".join(f"at 10.{i % 256}.{i // 256 % 256}.7 x " for i in range(n)), "email": "".join(f"u{i}@ex.org " for i in range(n)),
             "card": "4111 1111 1111 1111, " * n, "phone": "+49 30 123456789; " * n,
             "hex": "".join(f"{i:016x} " for i in range(n))}
    for kind, text in texts.items():
        scan = secret_spans if kind == "hex" else pii_spans
        df = scan(docs_frame(spark, [text]))
        begin = time.time()
        spans = [s for s in df.select("spans").first().spans if s.kind == kind]
        assert len(spans) == n and time.time() - begin < 60, kind
