"""panelfactors: cross-sectional equity factor analytics on Spark.

Long accounting statements, daily market caps, stock returns, an index and a
bond yield become independently sorted, value-weighted 2x3 portfolios, the
size / value / profitability / investment / momentum spreads and the market
premium, at monthly and daily frequency, and a cumulative-return report.

Every step is a DataFrame operator built from Spark's own expressions; see
``panelfactors.plans.pipelines`` for the compositions.
"""

__version__ = "0.1.0"
