"""A store kept up by extracts equals one built from the merged tables, and leaves the rest alone."""

import os
import random
from datetime import date

import pytest

from panelfactors import schemas as S
from panelfactors.plans.upkeep import FactorStore


def month(i):
    return date(2000 + i // 12, i % 12 + 1, 1)


def tables(seed=1, stocks=14, months=48):
    r = random.Random(seed)
    rets, caps = {}, {}
    for s in range(stocks):
        for m in range(r.choice([0, 0, 5, 20]), months):
            if r.random() < 0.05:
                continue   # gaps: lags count rows
            rets[str(s), month(m)] = None if r.random() < 0.03 else round(r.uniform(-0.2, 0.25), 6)
            caps[month(m).replace(day=5), str(s)] = r.randrange(1, 10_000)
            caps[month(m).replace(day=25), str(s)] = r.randrange(1, 10_000)
    return rets, caps


def frames(spark, rets, caps):
    return (spark.createDataFrame([(s, m, v) for (s, m), v in rets.items()], S.MONTHRET),
            spark.createDataFrame([(d, s, v) for (d, s), v in caps.items()], S.MARKETCAP))


def rows(df):
    return sorted(tuple(None if x is None else round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect())


def files(path, table):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, fs in os.walk(f"{path}/{table}") for f in fs if f.endswith(".parquet")}


def check(spark, tmp_dir, rets, caps, store):
    whole = FactorStore(spark, os.path.join(tmp_dir, f"whole{random.random()}"), method="window").build(*frames(spark, rets, caps))
    for t in ("factors", "signals", "returns", "caps"):
        assert rows(store.read(t)) == rows(whole.read(t)), t


def test_extract_equals_full_recomputation(spark, tmp_dir):
    rets, caps = tables()
    path = os.path.join(tmp_dir, "store")
    old = ({k: v for k, v in rets.items() if k[1] < month(40)}, {k: v for k, v in caps.items() if k[0] < month(40)})
    store = FactorStore(spark, path, method="window").build(*frames(spark, *old))

    # corrections in months 37-39, a value that is missing now, one that came late, and newer months
    new_r = {k: v for k, v in rets.items() if k[1] >= month(37)}
    new_c = {k: v for k, v in caps.items() if k[0] >= month(39)}
    for n, k in enumerate(sorted(k for k in new_r if k[1] < month(40))):
        if n % 5 == 0:
            new_r[k] = None if n % 10 == 0 else 0.01 * n
    new_r["3", month(38)] = 0.5
    k = min(new_c)
    new_c[k] += 7
    before = {t: files(path, t) for t in ("factors", "signals", "returns", "caps")}
    # months outside the range are not read: their files are spoiled
    spoiled = [f for f in before["returns"] if f.split("period=")[1][:10] < str(month(12))]
    spoiled += [f for f in before["caps"] if f.split("period=")[1][:10] < str(month(30))]
    kept = {f: open(f, "rb").read() for f in spoiled}
    for f in spoiled:
        with open(f, "wb") as out:
            out.write(b"not parquet")
        crc = os.path.join(os.path.dirname(f), f".{os.path.basename(f)}.crc")
        if os.path.exists(crc):
            os.remove(crc)
    report = store.apply_extract(*frames(spark, new_r, new_c))
    assert spoiled and min(report.dirty) == month(37) and max(report.dirty) >= month(47)
    assert report.read_from >= month(12)
    for f, data in kept.items():
        with open(f, "wb") as out:
            out.write(data)
    for t in ("factors", "signals"):
        same = {f for f, at in files(path, t).items() if before[t].get(f) == at}
        assert same == {f for f in before[t] if f.split("period=")[1][:10] < str(month(37))}
    check(spark, tmp_dir, old[0] | new_r, old[1] | new_c, store)

    # the same extract again changes nothing
    assert store.apply_extract(*frames(spark, new_r, new_c)).dirty == []


def test_old_correction_and_caps_only(spark, tmp_dir):
    rets, caps = tables(2)
    store = FactorStore(spark, os.path.join(tmp_dir, "store"), method="window").build(*frames(spark, rets, caps))
    k = sorted(x for x in rets if x[1] >= month(22))[0]
    change = {k: 0.123}
    cap = {sorted(c for c in caps if c[0] >= month(30).replace(day=25))[0]: 123456}
    report = store.apply_extract(*frames(spark, change, cap))
    assert min(report.dirty) == k[1] and len(report.dirty) < 20
    check(spark, tmp_dir, rets | change, caps | cap, store)
    only = {max(caps): 5}
    report = store.apply_extract(spark.createDataFrame([], S.MONTHRET), frames(spark, change, only)[1])
    assert report.dirty == [month(48)] and report.read_from is None
    check(spark, tmp_dir, rets | change, caps | cap | only, store)


def test_a_run_that_is_cut_off_is_run_again(spark, tmp_dir, monkeypatch):
    rets, caps = tables(3, stocks=8, months=30)
    store = FactorStore(spark, os.path.join(tmp_dir, "store"), method="window").build(*frames(spark, rets, caps))
    change = {sorted(x for x in rets if x[1] >= month(20))[1]: -0.4}
    write = FactorStore._write

    def failing(self, table, *a, **k):
        if table == "caps":
            raise RuntimeError("cut off")
        write(self, table, *a, **k)
    monkeypatch.setattr(FactorStore, "_write", failing)
    with pytest.raises(RuntimeError):
        store.apply_extract(*frames(spark, change, {min(caps): 1}))
    monkeypatch.setattr(FactorStore, "_write", write)
    assert store.apply_extract(*frames(spark, change, {min(caps): 1})).dirty
    check(spark, tmp_dir, rets | change, caps | {min(caps): 1}, store)
