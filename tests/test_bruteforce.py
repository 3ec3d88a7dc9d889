"""Brute-force pandas recomputation of the monthly momentum factor on the smallest fixture.

Buckets here come from pandas' interpolated-edge quantile cut, not from the
rank rule the engine uses, so this checks the equivalence on real data.
"""

import numpy as np
import pandas as pd
import pytest

from panelfactors import schemas as S
from panelfactors.plans import pipelines as P
from panelfactors.plans.queries import inputs
from tests.conftest import SF_SMALL


def _umd_pandas(ret: pd.DataFrame, caps: pd.DataFrame) -> pd.DataFrame:
    r = ret.dropna(subset=["ret"]).sort_values(["stock_id", "month"])
    # momentum: product of (1 + ret) over the 11 rows t-12 ... t-2 of each stock
    def signal(s):
        g = (1 + s).shift(2)
        return g.rolling(11, min_periods=11).apply(np.prod, raw=True)
    r["mom"] = r.groupby("stock_id")["ret"].transform(signal)
    mom = r.dropna(subset=["mom"])[["stock_id", "month", "mom"]].copy()
    mom["g_mom"] = mom.groupby("month")["mom"].transform(
        lambda x: pd.qcut(x, S.TERCILE_CUTS, labels=S.MOM_LABELS).astype(str))
    c = caps.sort_values(["stock_id", "date"]).copy()
    c["mc_month"] = c["date"].values.astype("datetime64[M]")
    last = c.groupby(["stock_id", "mc_month"], as_index=False).tail(1)[["stock_id", "mc_month", "market_value"]]
    last["g_size"] = last.groupby("mc_month")["market_value"].transform(
        lambda x: pd.qcut(x, S.SIZE_CUTS, labels=S.SIZE_LABELS).astype(str))
    p = r[["stock_id", "month", "ret"]].copy()
    p["mc_month"] = (p["month"].values.astype("datetime64[M]") - np.timedelta64(1, "M")).astype("datetime64[M]")
    p = p.merge(mom[["stock_id", "month", "g_mom"]], on=["stock_id", "month"])
    p = p.merge(last, on=["stock_id", "mc_month"])
    p["w"] = p["market_value"].astype(float)
    p["wr"] = p["w"] * p["ret"]
    g = p.groupby(["month", "g_size", "g_mom"], as_index=False)[["wr", "w"]].sum()
    g["Port"] = g["g_size"] + "_" + g["g_mom"]
    g["Portret"] = g["wr"] / g["w"]
    wide = g.pivot(index="month", columns="Port", values="Portret")
    wide["UMD"] = (wide["s1_mom3"] + wide["s2_mom3"] - wide["s1_mom1"] - wide["s2_mom1"]) / 2
    return wide


def test_umd_month_matches_pandas_qcut(spark):
    inp = inputs(spark, SF_SMALL)
    ret = inp.monthret.toPandas()
    caps = inp.marketcap.toPandas()
    ret["month"] = pd.to_datetime(ret["month"]).values.astype("datetime64[M]")
    caps["date"] = pd.to_datetime(caps["date"])
    want = _umd_pandas(ret, caps)
    got = P.momentum_factor_table(inp, "month")["wide"].toPandas()
    got["ret_date"] = pd.to_datetime(got["ret_date"]).values.astype("datetime64[M]")
    got = got.set_index("ret_date").sort_index()
    want = want.reindex(got.index)
    assert len(got) == len(want) > 0
    for col in S.MOM_PORTS + ["UMD"]:
        a, b = got[col].to_numpy(dtype=float), want[col].to_numpy(dtype=float)
        assert np.array_equal(np.isnan(a), np.isnan(b)), col
        m = ~np.isnan(a)
        assert a[m] == pytest.approx(b[m], rel=1e-9, abs=1e-12), col
