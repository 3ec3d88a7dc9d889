"""Driver tables -> finance tables (the test-data adapter).

A supplier plays the stock.  Each finance table is a lazy DataFrame derived
from ``lineitem`` / ``orders`` / ``supplier`` with the same definitions the
oracle SQL uses, so its work grows with the given tables.

Money sums are rounded to the decimals their inputs carry (2 for prices, 4 for
price x rate products) so both engines land on the same double regardless of
summation order.
"""

from __future__ import annotations

import threading
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.dates import month_key, quarter_end

# Fixed adapter rules (FIXTURES.md section 2).
FIN_NATION_MOD = 10          # industry 'FIN' where s_nationkey % 10 = 0
DELISTED_MOD = 7             # delisted where s_suppkey % 7 = 0
DELISTED_WIDTH = 4           # delisted code text left-padded to 4
OMIT_OPEX_MOD = 10           # OperatingExpenses row omitted where l_suppkey % 10 = 3
OMIT_OPEX_REM = 3            # ... in the second quarter
OMIT_OPEX_QUARTER = 2
YIELD_DAY_MOD = 3            # yields only on days whose day-of-month % 3 = 0
URGENT_PRIORITY = "1-URGENT"
URGENT_YIELD, OTHER_YIELD = 5.0, 1.0
INDEX_ID = "INDEX"
EXTRACT_SPLIT = "2000-07-01"      # old extract: date < split
EXTRACT_NEW_FROM = "2000-06-01"   # new extract: date >= this (June 2000 in both)
FINANCIAL_PATTERN = "FIN"

# calendar bounds of the driver data: open, every date takes part
DATA_RET_START = "0001-01-01"
DATA_RET_END = "9999-12-31"
DATA_GROUP_START = "0001-01-01"
DATA_GROUP_END = "9999-12-31"


def _read(spark: SparkSession, sf_dir: str, name: str, cols: list[str]) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").select(*cols)


@dataclass
class FinanceTables:
    """Lazily built finance tables over one driver data directory."""

    spark: SparkSession
    sf_dir: str
    _cache: dict = field(default_factory=dict)

    def _memo(self, key, build):
        if key not in self._cache:
            self._cache[key] = build()
        return self._cache[key]

    # ---- lineitem-derived -------------------------------------------------
    def _lines(self) -> DataFrame:
        li = _read(self.spark, self.sf_dir, "lineitem",
                   ["l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                    "l_returnflag", "l_shipdate"])
        return li.select(
            F.col("l_suppkey").alias("sk"),
            F.to_date("l_shipdate").alias("d"),
            F.col("l_quantity").alias("qty"),
            F.col("l_extendedprice").alias("ep"),
            F.col("l_discount").alias("disc"),
            F.col("l_tax").alias("tax"),
            F.col("l_returnflag").alias("rf"),
        )

    def _daily(self) -> DataFrame:
        """Per stock and day: every money sum the finance tables need.

        All other lineitem-derived tables aggregate this table further, and
        carry only the sums they use through its shuffle; the code's text is
        made from the number after it.  Re-rounding a sum of rounded
        daily sums gives the same double as rounding the sum of the lines,
        because each exact sum has at most 2 (or 4) decimals.

        Queries do not read these lazily-derived tables directly: the shared
        adapter (:func:`finance_tables`) writes the ones they ask for once as
        parquet tables and the factor runs scan those files.
        """
        def build():
            unit = F.col("ep") / F.col("qty")
            signed = F.when(F.col("rf") == "R", -F.col("ep")).otherwise(F.col("ep"))
            daily = self._lines().groupBy("sk", F.col("d").alias("date")).agg(
                F.round(F.sum("ep"), 2).alias("money"),
                F.round(F.sum(signed), 2).alias("signed"),
                F.round(F.sum(F.col("ep") * (F.lit(0.5) + F.col("disc"))), 4).alias("cogs"),
                F.round(F.sum(F.col("ep") * F.col("tax")), 4).alias("opex"),
                F.sum("qty").alias("volume"),
                F.max(unit).alias("unit_max"),
                F.min(unit).alias("unit_min"),
                F.count(F.lit(1)).alias("lines"),
            )
            return daily.withColumn("stock_id", F.col("sk").cast("string"))
        return self._memo("daily", build)

    def marketcap(self) -> DataFrame:
        return self._memo("marketcap", lambda: self._daily().select(
            "date", "stock_id", F.floor("money").cast("long").alias("market_value")))

    def dayret(self) -> DataFrame:
        def build():
            price = F.col("money") / F.col("volume")
            w = Window.partitionBy("sk").orderBy("date")
            return (self._daily().select("sk", "stock_id", "date", price.alias("price"))
                    .select("stock_id", "date", (F.col("price") / F.lag("price").over(w) - 1).alias("ret")))
        return self._memo("dayret", build)

    def monthret(self) -> DataFrame:
        def build():
            m = (self._daily().groupBy("sk", month_key("date").alias("month"))
                 .agg((F.round(F.sum("money"), 2) / F.sum("volume")).alias("price")))
            w = Window.partitionBy("sk").orderBy("month")
            return m.select(F.col("sk").cast("string").alias("stock_id"), "month", (F.col("price") / F.lag("price").over(w) - 1).alias("ret"))
        return self._memo("monthret", build)

    def _quarterly(self) -> DataFrame:
        def build():
            money = F.round(F.sum("money"), 2)
            quarterly = self._daily().groupBy("sk", quarter_end("date").alias("date")).agg(
                F.round(F.sum("signed"), 2).alias("Equity"),
                money.alias("TotalAssets"),
                money.alias("Revenue"),
                F.round(F.sum("cogs"), 4).alias("CostOfGoodsSold"),
                F.round(F.sum("opex"), 4).alias("OperatingExpenses"),
            )
            return quarterly.withColumn("stock_id", F.col("sk").cast("string"))
        return self._memo("quarterly", build)

    def balancesheet(self) -> DataFrame:
        def build():
            q = self._quarterly()
            long = q.unpivot(["sk", "stock_id", "date"], ["Equity", "TotalAssets"], "type", "value")
            return long.select("date", "stock_id", "type", "value", F.lower("type").alias("origin_name"))
        return self._memo("balancesheet", build)

    def incomestatement(self) -> DataFrame:
        def build():
            q = self._quarterly()
            long = q.unpivot(["sk", "stock_id", "date"],
                             ["Revenue", "CostOfGoodsSold", "OperatingExpenses"], "type", "value")
            omit = ((F.col("type") == "OperatingExpenses")
                    & (F.col("sk") % OMIT_OPEX_MOD == OMIT_OPEX_REM)
                    & (F.quarter("date") == OMIT_OPEX_QUARTER))
            origin = F.when(F.col("type") != "OperatingExpenses", F.lower("type"))
            return long.filter(~omit).select("date", "stock_id", "type", "value", origin.alias("origin_name"))
        return self._memo("incomestatement", build)

    # ---- orders-derived ---------------------------------------------------
    def _orders_daily(self) -> DataFrame:
        """Per order day: index price and yield, one scan of orders."""
        def build():
            o = _read(self.spark, self.sf_dir, "orders", ["o_orderdate", "o_totalprice", "o_orderpriority"])
            y = F.when(F.col("o_orderpriority") == URGENT_PRIORITY, F.lit(URGENT_YIELD)).otherwise(F.lit(OTHER_YIELD))
            return o.groupBy(F.to_date("o_orderdate").alias("date")).agg(
                (F.round(F.sum("o_totalprice"), 2) / F.count(F.lit(1))).alias("price"),
                F.avg(y).alias("close"),
            )
        return self._memo("orders_daily", build)

    def taiex(self) -> DataFrame:
        return self._memo("taiex", lambda: self._orders_daily().select(
            "date", F.lit(INDEX_ID).alias("stock_id"), "price"))

    def bond_yield(self) -> DataFrame:
        return self._memo("bond_yield", lambda: self._orders_daily()
                          .filter(F.dayofmonth("date") % YIELD_DAY_MOD == 0)
                          .select(F.date_format("date", "yyyy/MM/dd").alias("date"), "close"))

    # ---- supplier-derived -------------------------------------------------
    def _listing(self, parity: int) -> DataFrame:
        s = _read(self.spark, self.sf_dir, "supplier", ["s_suppkey", "s_nationkey"])
        industry = (F.when(F.col("s_nationkey") % FIN_NATION_MOD == 0, F.lit("FIN"))
                    .otherwise(F.concat(F.lit("IND"), F.col("s_nationkey").cast("string"))))
        return (s.filter(F.col("s_suppkey") % 2 == parity)
                .select(F.col("s_suppkey").cast("string").alias("stock_id"), industry.alias("industry")))

    def listing_tse(self) -> DataFrame:
        return self._listing(0)

    def listing_otc(self) -> DataFrame:
        return self._listing(1)

    def delisted(self) -> DataFrame:
        s = _read(self.spark, self.sf_dir, "supplier", ["s_suppkey"])
        code = F.col("s_suppkey").cast("string")
        padded = F.when(F.length(code) < DELISTED_WIDTH, F.lpad(code, DELISTED_WIDTH, "0")).otherwise(code)
        return s.filter(F.col("s_suppkey") % DELISTED_MOD == 0).select(padded.alias("stock_id"))

    # ---- price extracts ---------------------------------------------------
    def _adjprice(self) -> DataFrame:
        d = self._daily()
        return d.select(
            "date", "stock_id",
            F.col("volume").cast("decimal(20,0)").alias("Trading_Volume"),
            F.floor("money").cast("decimal(20,0)").alias("Trading_money"),
            F.col("unit_min").alias("open"),
            F.col("unit_max").alias("max"),
            F.col("unit_min").alias("min"),
            (F.col("money") / F.col("volume")).alias("close"),
            (F.col("unit_max") - F.col("unit_min")).alias("spread"),
            F.col("lines").alias("Trading_turnover"),
        )

    def adjprice_old(self) -> DataFrame:
        return self._adjprice().filter(F.col("date") < F.lit(EXTRACT_SPLIT).cast("date"))

    def adjprice_new(self) -> DataFrame:
        return self._adjprice().filter(F.col("date") >= F.lit(EXTRACT_NEW_FROM).cast("date"))


TABLES = ["marketcap", "monthret", "dayret", "balancesheet", "incomestatement", "taiex", "bond_yield",
          "listing_tse", "listing_otc", "delisted", "adjprice_old", "adjprice_new"]
#: small sums that several tables are made from, stored as well
SHARED_SUMS = {"balancesheet": "quarterly", "incomestatement": "quarterly", "taiex": "orders_daily", "bond_yield": "orders_daily"}


class StoredFinanceTables:
    """Finance tables written once as parquet in the shared checkpoint folder.

    The adapter is an ETL step: a table is written when it is first asked for,
    and every factor query afterwards scans the files - as the reference's runs
    read stored finance tables.  Files in the shared folder survive executor
    loss and cut the lineage back to the driver tables.  Nothing is kept in
    the executors' memory between the writes, and a query pays for the tables
    it reads only: each takes the columns it needs through its own shuffle.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, path: str):
        self.spark, self.sf_dir, self.path = spark, sf_dir, path
        self._lazy = FinanceTables(spark, sf_dir)
        self._cache: dict = {}
        self._lock = threading.RLock()

    def write(self) -> "StoredFinanceTables":
        """Writes every table now."""
        for name in TABLES:
            self._table(name)
        return self

    def _stored(self, name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{self.path}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{name}")

    def _table(self, name: str) -> DataFrame:
        with self._lock:
            sums = SHARED_SUMS.get(name)
            if sums and sums not in self._cache:
                self._cache[sums] = self._lazy._cache[sums] = self._stored(sums, getattr(self._lazy, f"_{sums}")())
            if name not in self._cache:
                self._cache[name] = self._stored(name, getattr(self._lazy, name)())
            return self._cache[name]

    def __getattr__(self, name):
        if name in TABLES:
            return lambda: self._table(name)
        raise AttributeError(name)


_SHARED: dict[tuple, StoredFinanceTables] = {}
_SHARED_LOCK = threading.Lock()


def finance_tables(spark: SparkSession, sf_dir: str, shared: bool = True):
    """The finance tables of one data folder.

    ``shared`` (default): each written once per session and folder, when first
    asked for, into the shared checkpoint folder, then read as parquet by every query.  ``shared=False``:
    the lazy derivation, recomputed inside each plan.
    """
    if not shared:
        return FinanceTables(spark, sf_dir)
    from ..session import scratch_path, session_key
    key = (*session_key(spark), sf_dir.rstrip("/"))
    with _SHARED_LOCK:
        if key not in _SHARED:
            _SHARED[key] = StoredFinanceTables(spark, sf_dir, scratch_path(spark, "finance-tables"))
        return _SHARED[key]
