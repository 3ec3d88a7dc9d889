import json
import os
from datetime import date

from pyspark.sql import functions as F

from panelfactors import schemas as S
from panelfactors.streaming.upsert import read_current, stale, start_upsert, vacuum

KEYS = ["date", "stock_id", "type"]

def version():
    return F.regexp_extract("_metadata.file_path", "wave-([0-9]+)", 1).cast("int")



class Stream:
    def __init__(self, spark, root, buckets=4):
        self.spark, self.buckets = spark, buckets
        self.src, self.table, self.ckpt = (os.path.join(root, x) for x in ("src", "table", "ckpt"))
        os.makedirs(self.src)

    def drop(self, name, rows):
        with open(os.path.join(self.src, name), "w") as f:
            f.write(json.dumps({"data": [{"date": "2020-12-31", "stock_id": s, "type": "Equity", "value": v, "origin_name": None}
                                         for s, v in rows]}) + "\n")

    def run(self):
        start_upsert(self.spark, self.src, S.STATEMENT, KEYS, self.table, self.ckpt, version(), self.buckets).awaitTermination(180)

    def rows(self):
        return sorted((r.stock_id, r.value) for r in read_current(self.spark, self.table, S.STATEMENT).collect())

    def files(self):
        return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(self.table) for f in fs if f.endswith(".parquet")}


def test_newest_version_stays_and_untouched_buckets_are_left_alone(spark, tmp_dir):
    s = Stream(spark, tmp_dir)
    s.drop("wave-1.json", [(str(i), float(i)) for i in range(40)])
    s.run()
    assert s.rows() == sorted((str(i), float(i)) for i in range(40))
    before = s.files()
    s.drop("wave-2.json", [("3", 30.0), ("99", 99.0)])
    s.run()
    want = sorted([(str(i), 30.0 if i == 3 else float(i)) for i in range(40)] + [("99", 99.0)])
    assert s.rows() == want
    after = s.files()
    assert {f: t for f, t in after.items() if f in before} == before   # nothing rewritten in place
    assert len({f.split("_bucket=")[1][0] for f in set(after) - set(before)}) <= 2
    s.drop("wave-1-again.json", [(str(i), -1.0) for i in range(40)])   # an older download, once more
    s.run()
    assert s.rows() == want
    assert stale(spark, s.table, S.STATEMENT).count() == vacuum(spark, s.table, S.STATEMENT) > 0
    assert s.rows() == want and stale(spark, s.table, S.STATEMENT).isEmpty()


def test_a_replayed_batch_gives_the_same_table(spark, tmp_dir):
    """The commit of a batch is lost: it runs again over its own half-written files."""
    s = Stream(spark, tmp_dir)
    s.drop("wave-1.json", [("1", 1.0), ("2", 2.0)])
    s.run()
    s.drop("wave-2.json", [("2", 20.0), ("3", 3.0), (None, 4.0)])
    s.run()
    want = read_current(spark, s.table, S.STATEMENT).orderBy("stock_id").collect()
    commits = os.path.join(s.ckpt, "commits")
    last = max((f for f in os.listdir(commits) if f.isdigit()), key=int)
    for name in (last, f".{last}.crc"):
        if os.path.exists(os.path.join(commits, name)):
            os.remove(os.path.join(commits, name))
    s.run()
    assert read_current(spark, s.table, S.STATEMENT).orderBy("stock_id").collect() == want
    assert [r.value for r in want] == [4.0, 1.0, 20.0, 3.0] and want[1].date == date(2020, 12, 31)
