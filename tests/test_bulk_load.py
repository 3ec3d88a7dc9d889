import os

import pytest
from pyspark.errors import PySparkException

from panelfactors import schemas as S
from panelfactors.sources.bulk_load import bulk_load

LINES = [
    "date,stock_id,type,value,origin_name",
    "2020-03-31,1,Equity,10.5,plain",
    '2020-03-31,2,Equity,11,"a ""quoted"", text"',
    '2020-03-31,3,Equity,12,"two\nlines"',
    "2020-03-31,4,Equity,,",
    "2020-03-31,5,Equity,n/a,x",
    "2020-03-31,6,Equity",
    "2020-03-31,7,Equity,1,x,y",
    "2020-13-31,8,Equity,1,x",
    '2020-03-31,9,Equity,1e3,"é 金融"',
    '2020-13-31,10,Equity,bad,"x\ny"',
]


def write(tmp_dir, name, lines):
    with open(os.path.join(tmp_dir, name), "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")


def test_rows_and_rejects(spark, tmp_dir):
    write(tmp_dir, "a.csv", LINES)
    write(tmp_dir, "b.csv", [LINES[0], "x,y", LINES[1].replace(",1,", ",11,")])
    rows, rejects = bulk_load(spark, tmp_dir, S.STATEMENT)
    assert rows.schema.simpleString() == S.STATEMENT.simpleString()
    got = {r.stock_id: r for r in rows.collect()}
    assert set(got) == {"1", "2", "3", "4", "9", "11"}
    assert got["2"].origin_name == 'a "quoted", text' and got["3"].origin_name == "two\nlines" and got["9"].origin_name == "é 金融"
    assert got["4"].value is None and got["4"].origin_name is None and got["9"].value == 1000.0
    bad = sorted((os.path.basename(r.file), r.record, r.reason) for r in rejects.collect())
    assert bad == sorted([
        ("a.csv", LINES[5], "value: not a double"), ("a.csv", LINES[6], "number of fields"),
        ("a.csv", LINES[7], "number of fields"), ("a.csv", LINES[8], "date: not a date"),
        ("a.csv", LINES[10], "date: not a date"), ("b.csv", "x,y", "number of fields")])


def test_missing_marker_and_share_of_rejects(spark, tmp_dir):
    write(tmp_dir, "a.csv", [*LINES[:2], LINES[5]])
    rows, rejects = bulk_load(spark, tmp_dir, S.STATEMENT, null_value="n/a")
    assert rows.where("value IS NULL").count() == 1 and rejects.isEmpty()
    assert bulk_load(spark, tmp_dir, S.STATEMENT, max_reject_share=0.5)[0].count() == 1
    with pytest.raises(PySparkException, match="of the records are rejects"):
        bulk_load(spark, tmp_dir, S.STATEMENT, max_reject_share=0.2)[0].collect()


def test_files_without_rows(spark, tmp_dir):
    write(tmp_dir, "a.csv", LINES[:1])
    rows, rejects = bulk_load(spark, tmp_dir, S.STATEMENT)
    assert rows.isEmpty() and rejects.isEmpty()
