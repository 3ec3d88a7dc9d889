"""DuckDB oracle SQL: the adapter as CTEs plus one SELECT per query key.

Written independently of the DataFrame code from the same definitions
(FIXTURES.md): buckets by the integer rank rule over window functions,
percentiles by ``quantile_cont``, pivots by FILTER aggregates.  Each key's text
is ``WITH <needed CTEs> <final select>`` over the driver's raw tables.
"""

from __future__ import annotations

from fractions import Fraction

# Literals of the definitions, kept apart from the engine's own constants: a wrong value there must show.
SIZE_CUTS = [Fraction(0), Fraction(1, 2), Fraction(1)]
TERCILE_CUTS = [Fraction(0), Fraction(3, 10), Fraction(7, 10), Fraction(1)]
SIZE_LABELS = ["s1", "s2"]
BM_LABELS = ["bm1", "bm2", "bm3"]
OP_LABELS = ["op1", "op2", "op3"]
INV_LABELS = ["inv1", "inv2", "inv3"]
MOM_LABELS = ["mom1", "mom2", "mom3"]
INCOME_ITEMS = ["Revenue", "CostOfGoodsSold", "OperatingExpenses"]
FF_PORTS = ["s1bm1", "s1bm2", "s1bm3", "s1inv1", "s1inv2", "s1inv3", "s1op1", "s1op2", "s1op3",
            "s2bm1", "s2bm2", "s2bm3", "s2inv1", "s2inv2", "s2inv3", "s2op1", "s2op2", "s2op3"]
MOM_PORTS = ["s1_mom1", "s1_mom2", "s1_mom3", "s2_mom1", "s2_mom2", "s2_mom3"]
FF_FACTORS = ["HML", "RMW", "CMA", "SMB3", "SMB5"]
CHART_FACTORS = ["MKTPR", "SMB5", "HML", "RMW", "CMA", "UMD"]

R = 6  # rounding digits, as in the Spark queries; "+ 0.0" turns a rounded -0.0 into 0.0

RET_START, RET_END = "0001-01-01", "9999-12-31"
GROUP_START, GROUP_END = "0001-01-01", "9999-12-31"
MOM_START, MOM_END = "0001-01-01", "9999-12-31"
UNTIL = "9999-12-31"


def _rebalance(d: str) -> str:
    return f"make_date(CAST(year({d} - INTERVAL 6 MONTH) AS INTEGER) - 1, 12, 1)"


def _month(d: str) -> str:
    return f"CAST(date_trunc('month', {d}) AS DATE)"


def _bucket(col: str, part: str, cuts, labels) -> str:
    """CASE over the integer rank rule: r*b <= (n-1)*a for cut a/b."""
    r = f"(rank() OVER (PARTITION BY {part} ORDER BY {col}) - 1)"
    n = f"(count({col}) OVER (PARTITION BY {part}) - 1)"
    fr = cuts[1:-1]
    whens = " ".join(f"WHEN {r} * {f.denominator} <= {n} * {f.numerator} THEN '{lab}'"
                     for f, lab in zip(fr, labels[:-1]))
    return f"CASE WHEN {col} IS NULL THEN NULL {whens} ELSE '{labels[-1]}' END"


def _wide(src: str, ports: list[str]) -> str:
    cols = ", ".join(f"max(Portret) FILTER (WHERE Port = '{p}') AS {p}" for p in ports)
    return f"SELECT ret_date, {cols} FROM {src} GROUP BY ret_date"


def _spreads() -> str:
    def avg(plus, minus, div):
        return "(" + " + ".join(plus) + " - " + " - ".join(minus) + f") / {div}"
    sm = [f"s1{x}" for x in BM_LABELS]
    bg = [f"s2{x}" for x in BM_LABELS]
    all_ = BM_LABELS + OP_LABELS + INV_LABELS
    return ", ".join([
        f"{avg(['s1bm3', 's2bm3'], ['s1bm1', 's2bm1'], 2)} AS HML",
        f"{avg(['s1op3', 's2op3'], ['s1op1', 's2op1'], 2)} AS RMW",
        f"{avg(['s1inv1', 's2inv1'], ['s1inv3', 's2inv3'], 2)} AS CMA",
        f"((" + " + ".join(sm) + ") - (" + " + ".join(bg) + ")) / 3 AS SMB3",
        f"((" + " + ".join(f's1{x}' for x in all_) + ") - (" + " + ".join(f's2{x}' for x in all_) + ")) / 9 AS SMB5",
    ])


# name -> (sql, dependencies)
CTES: dict[str, tuple[str, list[str]]] = {}


def cte(name: str, deps: list[str], sql: str) -> None:
    CTES[name] = (sql, deps)


# ---- adapter --------------------------------------------------------------
cte("li", [], """
SELECT l_suppkey AS sk, CAST(l_suppkey AS VARCHAR) AS stock_id, CAST(l_shipdate AS DATE) AS d,
       l_quantity AS qty, l_extendedprice AS ep, l_discount AS disc, l_tax AS tax, l_returnflag AS rf
FROM lineitem""")
cte("daily", ["li"], """
SELECT stock_id, d AS date, round(sum(ep), 2) AS money, sum(qty) AS volume,
       max(ep / qty) AS unit_max, min(ep / qty) AS unit_min, count(*) AS lines
FROM li GROUP BY stock_id, d""")
cte("marketcap", ["daily"], "SELECT date, stock_id, CAST(floor(money) AS BIGINT) AS market_value FROM daily")
cte("dayret", ["daily"], """
SELECT stock_id, date,
       (money / volume) / lag(money / volume) OVER (PARTITION BY stock_id ORDER BY date) - 1 AS ret
FROM daily""")
cte("monthret", ["li"], f"""
SELECT stock_id, month, price / lag(price) OVER (PARTITION BY stock_id ORDER BY month) - 1 AS ret
FROM (SELECT stock_id, {_month('d')} AS month, round(sum(ep), 2) / sum(qty) AS price
      FROM li GROUP BY ALL)""")
cte("quarterly", ["li"], """
SELECT sk, stock_id, CAST(last_day(date_trunc('quarter', d) + INTERVAL 2 MONTH) AS DATE) AS date,
       round(sum(CASE WHEN rf = 'R' THEN -ep ELSE ep END), 2) AS equity,
       round(sum(ep), 2) AS assets,
       round(sum(ep * (0.5::DOUBLE + disc)), 4) AS cogs,
       round(sum(ep * tax), 4) AS opex
FROM li GROUP BY ALL""")
cte("balancesheet", ["quarterly"], """
SELECT date, stock_id, 'Equity' AS type, equity AS value, 'equity' AS origin_name FROM quarterly
UNION ALL SELECT date, stock_id, 'TotalAssets', assets, 'totalassets' FROM quarterly""")
cte("incomestatement", ["quarterly"], """
SELECT date, stock_id, 'Revenue' AS type, assets AS value, 'revenue' AS origin_name FROM quarterly
UNION ALL SELECT date, stock_id, 'CostOfGoodsSold', cogs, 'costofgoodssold' FROM quarterly
UNION ALL SELECT date, stock_id, 'OperatingExpenses', opex, CAST(NULL AS VARCHAR) FROM quarterly
          WHERE NOT (sk % 10 = 3 AND quarter(date) = 2)""")
cte("taiex", [], """
SELECT CAST(o_orderdate AS DATE) AS date, 'INDEX' AS stock_id,
       round(sum(o_totalprice), 2) / count(*) AS price
FROM orders GROUP BY 1""")
cte("bond_yield", [], """
SELECT strftime(CAST(o_orderdate AS DATE), '%Y/%m/%d') AS date,
       avg(CASE WHEN o_orderpriority = '1-URGENT' THEN 5.0::DOUBLE ELSE 1.0::DOUBLE END) AS close
FROM orders WHERE day(CAST(o_orderdate AS DATE)) % 3 = 0
GROUP BY CAST(o_orderdate AS DATE)""")
cte("listing", [], """
SELECT CAST(s_suppkey AS VARCHAR) AS stock_id,
       CASE WHEN s_nationkey % 10 = 0 THEN 'FIN' ELSE 'IND' || CAST(s_nationkey AS VARCHAR) END AS industry,
       s_suppkey % 2 AS parity
FROM supplier""")
cte("adjprice", ["daily"], """
SELECT date, stock_id, CAST(volume AS DECIMAL(20,0)) AS Trading_Volume,
       CAST(floor(money) AS DECIMAL(20,0)) AS Trading_money,
       unit_min AS "open", unit_max AS "max", unit_min AS "min", money / volume AS "close",
       unit_max - unit_min AS spread, lines AS Trading_turnover
FROM daily""")

# ---- snapshots ------------------------------------------------------------
cte("yec", ["marketcap"], """
SELECT * FROM (SELECT stock_id, make_date(year(date), 12, 1) AS year,
                      arg_max_null(market_value, date) AS MC
               FROM marketcap GROUP BY ALL) WHERE MC <> 0""")
cte("mec", ["marketcap"], f"""
SELECT stock_id, {_month('date')} AS mc_month, arg_max_null(market_value, date) AS MC
FROM marketcap GROUP BY ALL""")
cte("wb", ["balancesheet"], """
SELECT date, stock_id,
       max(value) FILTER (WHERE type = 'Equity') AS Equity,
       max(value) FILTER (WHERE type = 'TotalAssets') AS TotalAssets
FROM balancesheet WHERE type IN ('Equity', 'TotalAssets') GROUP BY date, stock_id""")
cte("wi", ["incomestatement"], """
SELECT date, stock_id,
       max(value) FILTER (WHERE type = 'Revenue') AS Revenue,
       max(value) FILTER (WHERE type = 'CostOfGoodsSold') AS CostOfGoodsSold,
       max(value) FILTER (WHERE type = 'OperatingExpenses') AS OperatingExpenses
FROM incomestatement WHERE type IN ('Revenue', 'CostOfGoodsSold', 'OperatingExpenses')
GROUP BY date, stock_id""")
cte("ab", ["wb"], f"""
SELECT * FROM (SELECT {_month('date')} AS year, stock_id, Equity, TotalAssets FROM wb)
WHERE Equity > 0 AND month(year) = 12""")
cte("aop", ["wi"], """
SELECT stock_id, make_date(year(date), 12, 1) AS year,
       sum(Revenue - CostOfGoodsSold - OperatingExpenses) AS yOP
FROM wi WHERE Revenue IS NOT NULL AND CostOfGoodsSold IS NOT NULL AND OperatingExpenses IS NOT NULL
GROUP BY ALL""")
cte("fund", ["ab", "yec", "aop"], """
SELECT b.year, b.stock_id, b.Equity, b.TotalAssets, c.MC, o.yOP
FROM ab b JOIN yec c ON b.stock_id = c.stock_id AND b.year = c.year
          JOIN aop o ON b.stock_id = o.stock_id AND b.year = o.year
WHERE b.Equity IS NOT NULL AND b.TotalAssets IS NOT NULL AND c.MC IS NOT NULL AND o.yOP IS NOT NULL""")
cte("excl", ["fund", "listing"], """
SELECT * FROM fund f
WHERE NOT EXISTS (SELECT 1 FROM listing l WHERE l.stock_id = f.stock_id AND contains(l.industry, 'FIN'))""")
cte("chars", ["excl"], """
SELECT * FROM (
  SELECT year, stock_id, Equity, TotalAssets, MC, yOP,
         Equity / MC AS BMratio, yOP / Equity AS OPtoE,
         ln(TotalAssets) - lag(ln(TotalAssets)) OVER (PARTITION BY stock_id ORDER BY year) AS Inv
  FROM excl)
WHERE BMratio IS NOT NULL AND OPtoE IS NOT NULL AND Inv IS NOT NULL""")
cte("yg", ["chars"], f"""
SELECT year, stock_id, MC,
       {_bucket('MC', 'year', SIZE_CUTS, SIZE_LABELS)} AS g_size,
       {_bucket('BMratio', 'year', TERCILE_CUTS, BM_LABELS)} AS g_bm,
       {_bucket('OPtoE', 'year', TERCILE_CUTS, OP_LABELS)} AS g_op,
       {_bucket('Inv', 'year', TERCILE_CUTS, INV_LABELS)} AS g_inv
FROM chars""")

# ---- momentum -------------------------------------------------------------
cte("mom", ["monthret"], """
SELECT stock_id, mom_month, mom FROM (
  SELECT stock_id, month AS mom_month,
         count(ret) OVER w AS cnt, product(1 + ret) OVER w AS mom
  FROM monthret WHERE ret IS NOT NULL
  WINDOW w AS (PARTITION BY stock_id ORDER BY month ROWS BETWEEN 12 PRECEDING AND 2 PRECEDING))
WHERE cnt = 11""")
cte("mom_g", ["mom"], f"""
SELECT stock_id, mom_month, mom, {_bucket('mom', 'mom_month', TERCILE_CUTS, MOM_LABELS)} AS g_mom
FROM mom""")
cte("cap_g", ["mec"], f"""
SELECT stock_id, mc_month, MC, {_bucket('MC', 'mc_month', SIZE_CUTS, SIZE_LABELS)} AS g_size
FROM mec""")

# ---- panels ---------------------------------------------------------------
for freq, src, dcol in (("m", "monthret", "month"), ("d", "dayret", "date")):
    cte(f"ypanel_{freq}", [src, "yg"], f"""
SELECT r.stock_id, r.ret_date, r.ret, r.year, g.MC, g.g_size, g.g_bm, g.g_op, g.g_inv
FROM (SELECT stock_id, {dcol} AS ret_date, ret, {_rebalance(dcol)} AS year
      FROM {src} WHERE ret IS NOT NULL AND {dcol} BETWEEN DATE '{RET_START}' AND DATE '{RET_END}') r
JOIN yg g ON r.stock_id = g.stock_id AND r.year = g.year
WHERE r.year BETWEEN DATE '{GROUP_START}' AND DATE '{GROUP_END}'""")
    cte(f"mpanel_{freq}", [src, "mom_g", "cap_g"], f"""
SELECT r.stock_id, r.ret_date, r.ret, m.g_mom, c.MC, c.g_size
FROM (SELECT stock_id, {dcol} AS ret_date, ret, {_month(dcol)} AS mom_month,
             CAST({_month(dcol)} - INTERVAL 1 MONTH AS DATE) AS mc_month
      FROM {src} WHERE ret IS NOT NULL AND {dcol} BETWEEN DATE '{MOM_START}' AND DATE '{MOM_END}') r
JOIN mom_g m ON r.stock_id = m.stock_id AND r.mom_month = m.mom_month
JOIN cap_g c ON r.stock_id = c.stock_id AND r.mc_month = c.mc_month""")
    cte(f"vwall_{freq}", [f"ypanel_{freq}"], " UNION ALL ".join(
        f"SELECT ret_date, g_size || {g} AS Port, sum(MC * ret) / sum(MC) AS Portret "
        f"FROM ypanel_{freq} GROUP BY ret_date, g_size, {g}" for g in ("g_bm", "g_op", "g_inv")))
    cte(f"ff5_{freq}", [f"vwall_{freq}"], f"SELECT *, {_spreads()} FROM ({_wide(f'vwall_{freq}', FF_PORTS)})")
    cte(f"vwmom_{freq}", [f"mpanel_{freq}"], f"""
SELECT ret_date, g_size || '_' || g_mom AS Port, sum(MC * ret) / sum(MC) AS Portret
FROM mpanel_{freq} GROUP BY ret_date, g_size, g_mom""")
    cte(f"umdw_{freq}", [f"vwmom_{freq}"], f"""
SELECT ret_date, {', '.join(MOM_PORTS)}, (s1_mom3 + s2_mom3 - s1_mom1 - s2_mom1) / 2 AS UMD
FROM ({_wide(f'vwmom_{freq}', MOM_PORTS)})""")

# ---- market ---------------------------------------------------------------
cte("idx_m", ["taiex"], f"""
SELECT ret_date, (price - lag(price) OVER (ORDER BY ret_date)) / price AS ret
FROM (SELECT {_month('date')} AS ret_date, arg_max(price, date) AS price FROM taiex GROUP BY 1)""")
cte("idx_d", ["taiex"], """
SELECT date AS ret_date, (price - lag(price) OVER (ORDER BY date)) / price AS ret FROM taiex""")
cte("rf_m", ["bond_yield"], f"""
SELECT ret_date, close / 1200 AS RFrate
FROM (SELECT {_month("CAST(strptime(date, '%Y/%m/%d') AS DATE)")} AS ret_date,
             arg_max(close, CAST(strptime(date, '%Y/%m/%d') AS DATE)) AS close
      FROM bond_yield GROUP BY 1)""")
cte("rf_d", ["taiex", "bond_yield"], """
SELECT d.ret_date,
       last_value(r.rf IGNORE NULLS) OVER (ORDER BY d.ret_date
                                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS RFrate
FROM (SELECT DISTINCT date AS ret_date FROM taiex) d
LEFT JOIN (SELECT CAST(strptime(date, '%Y/%m/%d') AS DATE) AS ret_date, close / 36500 AS rf
           FROM bond_yield) r ON d.ret_date = r.ret_date""")
for freq in ("m", "d"):
    cte(f"mkt_{freq}", [f"idx_{freq}", f"rf_{freq}"], f"""
SELECT i.ret_date, i.ret - r.RFrate AS MKTPR
FROM idx_{freq} i JOIN rf_{freq} r ON i.ret_date = r.ret_date
WHERE i.ret IS NOT NULL AND r.RFrate IS NOT NULL""")
    cte(f"ffw_{freq}", [f"ff5_{freq}", f"mkt_{freq}"], f"""
SELECT f.*, k.MKTPR FROM ff5_{freq} f LEFT JOIN mkt_{freq} k ON f.ret_date = k.ret_date
WHERE f.ret_date < DATE '{UNTIL}'""")

# ---- six factors and report ----------------------------------------------
cte("six", ["ffw_m", "umdw_m"], f"""
SELECT f.*, {', '.join('u.' + p for p in MOM_PORTS)}, u.UMD
FROM ffw_m f JOIN umdw_m u ON f.ret_date = u.ret_date""")
_SIX_SERIES = [*FF_PORTS, *FF_FACTORS, "MKTPR", *MOM_PORTS, "UMD"]
cte("six_long", ["six"], f"""
SELECT ret_date, unnest([{', '.join(repr(c) for c in _SIX_SERIES)}]) AS Port,
       unnest([{', '.join(_SIX_SERIES)}]) AS Portret
FROM six""")
cte("cum", ["six_long"], """
SELECT ret_date, Port, Portret,
       CASE WHEN Portret IS NOT NULL THEN
            product(1 + Portret) OVER (PARTITION BY Port ORDER BY ret_date
                                       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) * 100 END AS cumret
FROM six_long""")
cte("lastcum", ["cum"], "SELECT Port, arg_max_null(cumret, ret_date) AS last FROM cum GROUP BY Port")
cte("ranks", ["lastcum"], """
SELECT l.Port, r.Portrank FROM lastcum l LEFT JOIN (
  SELECT Port, CAST(rank() OVER (ORDER BY last DESC) AS DOUBLE)
               + CAST(count(*) OVER (PARTITION BY last) - 1 AS DOUBLE) / 2 AS Portrank
  FROM lastcum WHERE last IS NOT NULL) r ON l.Port = r.Port""")
cte("chart", ["six_long"], f"""
SELECT ret_date, Port, Portret * 100 AS Portret FROM six_long
WHERE Port IN ({', '.join(repr(f) for f in CHART_FACTORS)})""")


def _round_cols(cols: dict[str, bool]) -> str:
    return ", ".join(f"round({c}, {R}) + 0.0 AS {c}" if dbl else c for c, dbl in cols.items())


def _rounded_select(src: str, cols: list[str], doubles: set[str]) -> str:
    return f"SELECT {_round_cols({c: c in doubles for c in cols})} FROM {src}"


def _profile(src: str, cols: list[str]) -> str:
    stats = {"count": "CAST(count({c}) AS DOUBLE)", "mean": "avg({c})", "std": "stddev_samp({c})",
             "min": "CAST(min({c}) AS DOUBLE)", "25%": "quantile_cont(CAST({c} AS DOUBLE), 0.25)",
             "50%": "quantile_cont(CAST({c} AS DOUBLE), 0.5)", "75%": "quantile_cont(CAST({c} AS DOUBLE), 0.75)",
             "max": "CAST(max({c}) AS DOUBLE)"}
    return " UNION ALL ".join(
        f"SELECT '{name}' AS summary, " + ", ".join(
            f"""round({f.format(c=f'"{c}"')}, {R}) + 0.0 AS "{c}" """ for c in cols) + f" FROM {src}"
        for name, f in stats.items())


def build(final: str, deps: list[str]) -> str:
    order: list[str] = []

    def visit(n):
        if n in order:
            return
        for d in CTES[n][1]:
            visit(d)
        order.append(n)

    for d in deps:
        visit(d)
    body = ",\n".join(f"{n} AS ({CTES[n][0].strip()})" for n in order)
    return f"WITH {body}\n{final}"


FF_COLS = ["ret_date", *FF_PORTS, *FF_FACTORS, "MKTPR"]
UMD_COLS = ["ret_date", *MOM_PORTS, "UMD"]


def _all_rounded(src, cols, keep=("ret_date",)):
    return _rounded_select(src, cols, set(cols) - set(keep))


SQL: dict[str, str] = {
    "year_end_cap": build("SELECT stock_id, year, MC FROM yec", ["yec"]),
    "month_end_cap": build("SELECT stock_id, mc_month, MC FROM mec", ["mec"]),
    "widen_balance": build(_rounded_select("wb", ["date", "stock_id", "Equity", "TotalAssets"],
                                           {"Equity", "TotalAssets"}), ["wb"]),
    "widen_income": build(_rounded_select("wi", ["date", "stock_id", *INCOME_ITEMS], set(INCOME_ITEMS)),
                          ["wi"]),
    "annual_balance": build(_rounded_select("ab", ["year", "stock_id", "Equity", "TotalAssets"],
                                            {"Equity", "TotalAssets"}), ["ab"]),
    "annual_op": build(_rounded_select("aop", ["stock_id", "year", "yOP"], {"yOP"}), ["aop"]),
    "fundamentals": build(_rounded_select("fund", ["year", "stock_id", "Equity", "TotalAssets", "MC", "yOP"],
                                          {"Equity", "TotalAssets", "yOP"}), ["fund"]),
    "exclude_industry": build(_rounded_select("excl", ["year", "stock_id", "Equity", "TotalAssets", "MC", "yOP"],
                                              {"Equity", "TotalAssets", "yOP"}), ["excl"]),
    "characteristics": build(_rounded_select(
        "chars", ["year", "stock_id", "Equity", "TotalAssets", "MC", "yOP", "BMratio", "OPtoE", "Inv"],
        {"Equity", "TotalAssets", "yOP", "BMratio", "OPtoE", "Inv"}), ["chars"]),
    "momentum": build(_rounded_select("mom", ["stock_id", "mom_month", "mom"], {"mom"}), ["mom"]),
    "bucket_size": build(f"SELECT year, stock_id, MC, {_bucket('MC', 'year', SIZE_CUTS, SIZE_LABELS)} "
                         f"AS g_size FROM chars", ["chars"]),
    "bucket_bm": build(f"SELECT year, stock_id, round(BMratio, {R}) + 0.0 AS BMratio, "
                       f"{_bucket('BMratio', 'year', TERCILE_CUTS, BM_LABELS)} AS g_bm FROM chars",
                       ["chars"]),
    "bucket_mom": build(_rounded_select("mom_g", ["stock_id", "mom_month", "mom", "g_mom"], {"mom"}), ["mom_g"]),
    "bucket_edges": build(f"""
SELECT year, count(BMratio) AS n, round(quantile_cont(BMratio, 0.3), {R}) + 0.0 AS bm_p30,
       round(quantile_cont(BMratio, 0.7), {R}) + 0.0 AS bm_p70,
       round(quantile_cont(CAST(MC AS DOUBLE), 0.5), {R}) + 0.0 AS mc_p50
FROM chars GROUP BY year""", ["chars"]),
    "year_groups": build("SELECT year, stock_id, MC, g_size, g_bm, g_op, g_inv FROM yg", ["yg"]),
    "rebalance_calendar": build(f"""
SELECT * FROM (SELECT DISTINCT month AS ret_date, {_rebalance('month')} AS year FROM monthret
               WHERE month BETWEEN DATE '{RET_START}' AND DATE '{RET_END}')
WHERE year BETWEEN DATE '{GROUP_START}' AND DATE '{GROUP_END}'""", ["monthret"]),
    "monthly_calendar": build(f"""
SELECT DISTINCT date AS ret_date, {_month('date')} AS mom_month,
       CAST({_month('date')} - INTERVAL 1 MONTH AS DATE) AS mc_month
FROM dayret WHERE date BETWEEN DATE '{MOM_START}' AND DATE '{MOM_END}'""", ["dayret"]),
    "factor_panel": build(_rounded_select(
        "ypanel_m", ["stock_id", "ret_date", "ret", "year", "MC", "g_size", "g_bm", "g_op", "g_inv"], {"ret"}),
        ["ypanel_m"]),
    **{f"vw_{k}": build(f"""
SELECT ret_date, g_size || g_{k} AS Port, round(sum(MC * ret) / sum(MC), {R}) + 0.0 AS Portret
FROM ypanel_m GROUP BY ret_date, g_size, g_{k}""", ["ypanel_m"]) for k in ("bm", "op", "inv")},
    "vw_all": build(f"SELECT ret_date, Port, round(Portret, {R}) + 0.0 AS Portret FROM vwall_m", ["vwall_m"]),
    "vw_mom": build(f"SELECT ret_date, Port, round(Portret, {R}) + 0.0 AS Portret FROM vwmom_m", ["vwmom_m"]),
    "vw_weights": build(f"""
SELECT ret_date, stock_id, g_size, g_bm, MC, round(ret, {R}) + 0.0 AS ret,
       round(MC / sum(MC) OVER (PARTITION BY ret_date, g_size, g_bm), {R}) + 0.0 AS weight,
       round(MC / sum(MC) OVER (PARTITION BY ret_date, g_size, g_bm) * ret, {R}) + 0.0 AS weight_ret
FROM ypanel_m""", ["ypanel_m"]),
    "portfolios_wide": build(_all_rounded(f"({_wide('vwall_m', FF_PORTS)})", ["ret_date", *FF_PORTS]),
                             ["vwall_m"]),
    "five_factors": build(_all_rounded("ff5_m", ["ret_date", *FF_PORTS, *FF_FACTORS]), ["ff5_m"]),
    "umd": build(f"SELECT ret_date, round(UMD, {R}) + 0.0 AS UMD FROM umdw_m", ["umdw_m"]),
    "index_ret_month": build(_all_rounded("idx_m", ["ret_date", "ret"]), ["idx_m"]),
    "index_ret_day": build(_all_rounded("idx_d", ["ret_date", "ret"]), ["idx_d"]),
    "rf_month": build(_all_rounded("rf_m", ["ret_date", "RFrate"]), ["rf_m"]),
    "rf_day_ffill": build(_all_rounded("rf_d", ["ret_date", "RFrate"]), ["rf_d"]),
    "mktpr_month": build(_all_rounded("mkt_m", ["ret_date", "MKTPR"]), ["mkt_m"]),
    "mktpr_day": build(_all_rounded("mkt_d", ["ret_date", "MKTPR"]), ["mkt_d"]),
    "five_factor_month": build(_all_rounded("ffw_m", FF_COLS), ["ffw_m"]),
    "five_factor_day": build(_all_rounded("ffw_d", FF_COLS), ["ffw_d"]),
    "umd_month": build(_all_rounded("umdw_m", UMD_COLS), ["umdw_m"]),
    "umd_day": build(_all_rounded("umdw_d", UMD_COLS), ["umdw_d"]),
    "six_factor_wide": build(_all_rounded("six", FF_COLS + UMD_COLS[1:]), ["six"]),
    "six_factor_long": build(_rounded_select("six_long", ["ret_date", "Port", "Portret"], {"Portret"}),
                             ["six_long"]),
    "cumret": build(_rounded_select("cum", ["ret_date", "Port", "Portret", "cumret"], {"Portret", "cumret"}),
                    ["cum"]),
    "port_rank": build(f"SELECT Port, round(Portrank, {R}) + 0.0 AS Portrank FROM ranks", ["ranks"]),
    "report_table": build(f"""
SELECT c.ret_date, c.Port, round(c.Portret * 100, {R}) + 0.0 AS Portret, round(c.cumret, {R}) + 0.0 AS cumret,
       round(r.Portrank, {R}) + 0.0 AS Portrank, round(m.cumret, {R}) + 0.0 AS MKT_cumret
FROM cum c LEFT JOIN ranks r ON c.Port = r.Port
LEFT JOIN (SELECT ret_date, cumret FROM cum WHERE Port = 'MKTPR') m ON c.ret_date = m.ret_date""",
                          ["cum", "ranks"]),
    "chart_feed": build(_rounded_select("chart", ["ret_date", "Port", "Portret"], {"Portret"}), ["chart"]),
    "chart_bounds": build("""
SELECT strftime(min(ret_date), '%Y-%m-%d') AS period_start, strftime(max(ret_date), '%Y-%m-%d') AS period_end,
       CAST(min(ret_date) - INTERVAL 2 MONTH AS DATE) AS axis_start,
       CAST(max(ret_date) + INTERVAL 2 MONTH AS DATE) AS axis_end
FROM chart""", ["chart"]),
    "item_counts": build("""
SELECT count(origin_name) AS counts, origin_name FROM incomestatement
GROUP BY origin_name ORDER BY counts DESC""", ["incomestatement"]),
    "rebalance_calendar_day": build(f"SELECT DISTINCT date AS ret_date, {_rebalance('date')} AS year FROM dayret",
                                    ["dayret"]),
    "profile_caps": build(_profile("marketcap", ["market_value"]), ["marketcap"]),
    "profile_monthret": build(_profile("monthret", ["ret"]), ["monthret"]),
    "profile_prices": build(_profile("(SELECT * FROM adjprice WHERE date >= DATE '2000-06-01')",
                                     ["open", "max", "min", "close", "spread"]), ["adjprice"]),
    "profile_describe": build(f"""
SELECT summary, round(ret, {R}) + 0.0 AS ret FROM (
  SELECT 'count' AS summary, CAST(count(ret) AS DOUBLE) AS ret FROM dayret
  UNION ALL SELECT 'mean', avg(ret) FROM dayret
  UNION ALL SELECT 'std', stddev_samp(ret) FROM dayret
  UNION ALL SELECT 'min', min(ret) FROM dayret
  UNION ALL SELECT '25%', quantile_cont(ret, 0.25) FROM dayret
  UNION ALL SELECT '50%', quantile_cont(ret, 0.5) FROM dayret
  UNION ALL SELECT '75%', quantile_cont(ret, 0.75) FROM dayret
  UNION ALL SELECT 'max', max(ret) FROM dayret)""", ["dayret"]),
    "null_counts": build(" UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM incomestatement"
        for c in ("date", "stock_id", "type", "value", "origin_name")), ["incomestatement"]),
    "null_sentinel": build(f"""
SELECT stock_id, month, CASE WHEN month(month) <> 6 THEN round(ret, {R}) + 0.0 END AS ret FROM monthret""", ["monthret"]),
    "clip_caps": build("""
SELECT date, stock_id, CASE WHEN day(date) % 5 = 0 THEN 0 ELSE market_value END AS market_value FROM marketcap""",
                       ["marketcap"]),
    "clip_negative": build(f"""
SELECT date, stock_id, type, round(CASE WHEN value < 0 THEN 0 ELSE value END, {R}) + 0.0 AS value, origin_name
FROM balancesheet""", ["balancesheet"]),
    "land_json": build(f"""
SELECT date, stock_id, type, round(value, {R}) + 0.0 AS value, origin_name FROM balancesheet""", ["balancesheet"]),
    "csv_roundtrip": build(f"""
SELECT stock_id, month, round(ret, {R}) + 0.0 AS ret FROM monthret""", ["monthret"]),
    "universe": build("""
SELECT stock_id, 'TSE' AS market, false AS delisted FROM listing WHERE parity = 0
UNION ALL SELECT stock_id, 'OTC', false FROM listing WHERE parity = 1
UNION ALL SELECT stock_id, 'DELISTED', true FROM (
  SELECT CASE WHEN length(c) < 4 THEN lpad(c, 4, '0') ELSE c END AS stock_id
  FROM (SELECT CAST(s_suppkey AS VARCHAR) AS c FROM supplier WHERE s_suppkey % 7 = 0))
WHERE length(stock_id) = 4""", ["listing"]),
    "top_rows": build("SELECT date, stock_id, market_value FROM marketcap ORDER BY date, stock_id LIMIT 5",
                      ["marketcap"]),
}

_ADJ_COLS = ["date", "stock_id", "Trading_Volume", "Trading_money", '"open"', '"max"', '"min"', '"close"',
             "spread", "Trading_turnover"]
_ADJ_OUT = ", ".join(
    f"round({c}, {R}) + 0.0 AS {c}" if c in ('"open"', '"max"', '"min"', '"close"', "spread") else c
    for c in _ADJ_COLS)
SQL["merge_extracts"] = build(f"""
SELECT {_ADJ_OUT} FROM (
  SELECT * FROM adjprice WHERE date >= DATE '2000-06-01'
  UNION ALL
  SELECT * FROM adjprice a WHERE date < DATE '2000-07-01'
    AND NOT EXISTS (SELECT 1 FROM adjprice b WHERE b.date >= DATE '2000-06-01'
                    AND b.date = a.date AND b.stock_id = a.stock_id))""", ["adjprice"])

# ---- as-of values, ranks, products ----------------------------------------
for _key, _limit in (("asof_book_day", None), ("asof_book_recent", 60)):
    _take = "b.{c}" if _limit is None else f"CASE WHEN date_diff('day', b.date, m.date) <= {_limit} THEN b.{{c}} END"
    SQL[_key] = build(f"""
SELECT m.date, m.stock_id, m.market_value,
       round({_take.format(c="Equity")}, {R}) + 0.0 AS Equity, round({_take.format(c="TotalAssets")}, {R}) + 0.0 AS TotalAssets
FROM marketcap m ASOF LEFT JOIN wb b ON m.stock_id = b.stock_id AND m.date >= b.date""", ["marketcap", "wb"])
SQL["rank_stocks_month"] = build(f"""
SELECT stock_id, month, round(ret, {R}) + 0.0 AS ret,
       CASE WHEN ret IS NOT NULL THEN rank() OVER (PARTITION BY month ORDER BY ret DESC NULLS LAST)
            + (count(*) OVER (PARTITION BY month, ret) - 1) / 2.0::DOUBLE END AS rank
FROM monthret""", ["monthret"])
SQL["rank_stocks_all"] = build("""
SELECT date, stock_id, market_value, rank() OVER (ORDER BY market_value DESC)
       + (count(*) OVER (PARTITION BY market_value) - 1) / 2.0::DOUBLE AS rank
FROM marketcap""", ["marketcap"])
SQL["cumret_stock_day"] = build(f"""
SELECT stock_id, date, round(ret, {R}) + 0.0 AS ret,
       CASE WHEN ret IS NOT NULL THEN round(100 * product(1 + ret) OVER (PARTITION BY stock_id ORDER BY date), {R}) + 0.0 END AS cumret
FROM dayret""", ["dayret"])

# ---- bulk load, keyed landing, upkeep, contracts --------------------------
_SPOILED = [("3", 0), ("6", 1), ("9", 2), ("12", 3)]
_IS_SPOILED = " OR ".join(f"(CAST(stock_id AS BIGINT) % 4 = {k} AND month(date) = {m})" for m, k in _SPOILED)
SQL["bulk_load_rows"] = build(f"""
SELECT date, stock_id, type, round(value, {R}) + 0.0 AS value,
       CASE WHEN CAST(stock_id AS BIGINT) % 5 = 0 THEN origin_name || ' "A", x' || chr(10) || 'y' ELSE origin_name END AS origin_name
FROM balancesheet WHERE NOT ({_IS_SPOILED})""", ["balancesheet"])
SQL["bulk_load_rejects"] = build(f"""
SELECT CASE month(date) WHEN 3 THEN strftime(date, '%Y-%m-%d') || ',' || stock_id || ',' || type || ',n/a,x'
                        WHEN 6 THEN strftime(date, '%Y-%m-%d') || ',' || stock_id || ',' || type
                        WHEN 9 THEN strftime(date, '%Y-%m-%d') || ',' || stock_id || ',' || type || ',1.5,a,b'
                        ELSE year(date) || '-13-31,' || stock_id || ',' || type || ',1.5,a' END AS record,
       CASE month(date) WHEN 3 THEN 'value: not a double' WHEN 12 THEN 'date: not a date' ELSE 'number of fields' END AS reason
FROM balancesheet WHERE {_IS_SPOILED}""", ["balancesheet"])
SQL["landed_upsert"] = build(f"""
SELECT date, stock_id, type, round(CASE WHEN date < DATE '1996-07-01' THEN value + 1 ELSE value END, {R}) + 0.0 AS value, origin_name
FROM balancesheet""", ["balancesheet"])
SQL["incremental_umd_month"] = SQL["umd_month"]
_RULES = {
    "marketcap": [("date not null", "date IS NULL"), ("stock_id not null", "stock_id IS NULL"),
                  ("market_value not null", "market_value IS NULL"), ("market_value >= 0", "market_value < 0"),
                  ("market_value <= 100000", "market_value > 100000"), ("stock_id up to 20 characters", "length(stock_id) > 20"),
                  ("key date, stock_id", "")],
    "monthret": [("stock_id not null", "stock_id IS NULL"), ("month not null", "month IS NULL"), ("ret not null", "ret IS NULL"),
                 ("ret >= -1", "ret < -1"), ("stock_id up to 20 characters", "length(stock_id) > 20"), ("key stock_id, month", "")],
    "dayret": [("stock_id not null", "stock_id IS NULL"), ("date not null", "date IS NULL"), ("ret not null", "ret IS NULL"),
               ("ret >= -1", "ret < -1"), ("ret <= 0.5", "ret > 0.5"), ("key stock_id, date", "")],
    "balancesheet": [("date not null", "date IS NULL"), ("stock_id not null", "stock_id IS NULL"), ("type not null", "type IS NULL"),
                     ("value not null", "value IS NULL"), ("value >= 0", "value < 0"),
                     ("origin_name up to 6 characters", "length(origin_name) > 6"), ("type in Equity", "type <> 'Equity'"),
                     ("key date, stock_id", "")],
}
SQL["contract_report"] = build(" UNION ALL ".join(
    f"""SELECT '{t}' AS "table", '{name}' AS rule, """
    + (f"count(*) FILTER (WHERE {bad})" if bad else f"count(*) - count(DISTINCT ({name.removeprefix('key ')}))")
    + f""" AS violations, count(*) AS "rows" FROM {t}"""
    for t, rules in _RULES.items() for name, bad in rules), list(_RULES))
SQL["listing_csv"] = build("SELECT stock_id, industry FROM listing", ["listing"])

# ---- tied edges, stored panels, drifting extracts -------------------------
_EDGE_PAIRS = [("size", 0, 0.5), ("size", 0.5, 1), ("tercile", 0, 0.3), ("tercile", 0.3, 0.7), ("tercile", 0.7, 1)]
SQL["bucket_tied_edges"] = build(" UNION ALL ".join(f"""
SELECT mc_month, '{n}' AS sort, {a}::DOUBLE AS low_cut, {b}::DOUBLE AS high_cut, quantile_cont(level, {a}) AS edge
FROM (SELECT mc_month, floor(MC / 50000)::DOUBLE AS level FROM mec)
GROUP BY mc_month HAVING quantile_cont(level, {a}) = quantile_cont(level, {b})""" for n, a, b in _EDGE_PAIRS), ["mec"])
SQL["five_factor_day_range"] = f"""
SELECT * FROM ({SQL["five_factor_day"]}) WHERE {_rebalance('ret_date')} BETWEEN DATE '1998-12-01' AND DATE '1999-12-01'"""
SQL["union_drift"] = build(f"""
SELECT stock_id, month, round(ret, {R}) + 0.0 AS ret, CAST(NULL AS VARCHAR) AS note, CAST(NULL AS BIGINT) AS lots, 'early' AS "extract"
FROM monthret WHERE year(month) < 1997
UNION ALL SELECT stock_id, month, round(ret, {R}) + 0.0, 'checked', month(month), 'middle' FROM monthret WHERE year(month) IN (1997, 1998)
UNION ALL SELECT stock_id, month, NULL, NULL, length(stock_id), 'late' FROM monthret WHERE year(month) > 1998
UNION ALL SELECT stock_id, CAST(month + INTERVAL 120 MONTH AS DATE), NULL, NULL, 7, 'later' FROM monthret WHERE year(month) > 1998""",
                            ["monthret"])
