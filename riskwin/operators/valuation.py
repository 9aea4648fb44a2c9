"""Portfolio valuation (JN4, STR5): holdings x prices over time.

``prices``: (asset, month, price), observed where data exists; a missing
month keeps the asset's last price (carry forward). ``holdings``:
(asset, share). The value at month ``m`` is ``sum(share * last price)``;
it is built from per-asset price changes, summed per month and accumulated
over months, so no months x assets grid is ever materialised.

Running values go year by year: within a (asset, year) or a year for the rows,
and over the years, of which a calendar has few, for what was there before. So a
busy asset or a long history is never sorted in one task. Months before every
priced holding has a price are not reported; the return is measured against the
first fully priced month. Holdings without any price take no part and are listed
by ``unpriced_holdings``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

VALUE_DIGITS = 2  # currency amounts


def segment_holdings(customer: DataFrame) -> DataFrame:
    """Shares per market segment: its fraction of all customers."""
    total = customer.count()
    return customer.groupBy(F.col("c_mktsegment").alias("asset")).agg((F.count(F.lit(1)) / F.lit(total)).alias("share"))


def valid_prices(prices: DataFrame) -> DataFrame:
    return prices.where(F.col("month").isNotNull() & F.col("price").isNotNull() & ~F.isnan(F.col("price").cast("double")))


def priced_holdings(prices: DataFrame, holdings: DataFrame) -> DataFrame:
    return holdings.join(valid_prices(prices).select("asset").distinct(), "asset", "left_semi")


def unpriced_holdings(prices: DataFrame, holdings: DataFrame) -> DataFrame:
    """Holdings that no price is ever seen for."""
    return holdings.join(valid_prices(prices).select("asset").distinct(), "asset", "left_anti")


def _previous_price(prices: DataFrame, prior_prices: DataFrame | None) -> DataFrame:
    """``prices`` with ``prev``: the asset's price before (NULL for its first)."""
    rows = valid_prices(prices).withColumn("year", F.year("month"))
    in_year = Window.partitionBy("asset", "year").orderBy("month", "price")
    ends = rows.groupBy("asset", "year").agg(F.max_by("price", F.struct("month", "price")).alias("end"))
    if prior_prices is not None:
        ends = ends.unionByName(prior_prices.select("asset", F.lit(-1).alias("year"), F.col("price").alias("end")))
    over_years = Window.partitionBy("asset").orderBy("year")
    carried = ends.select("asset", "year", F.lag("end").over(over_years).alias("carried"))
    return rows.withColumn("lagged", F.lag("price").over(in_year)).join(carried, ["asset", "year"]).withColumn(
        "prev", F.coalesce("lagged", "carried"))


def value_steps(prices: DataFrame, holdings: DataFrame, prior_prices: DataFrame | None = None,
                prior_value: float = 0.0, prior_priced: int = 0) -> DataFrame:
    """(month, assets_priced, portfolio_value) for every month with an
    observation, continuing from a prior state (last price per asset,
    running value and number of priced assets) when one is given."""
    known = prices.join(holdings.select("asset", "share"), "asset")
    moves = _previous_price(known, prior_prices).select(
        "month", "year", (F.col("share") * (F.col("price") - F.coalesce("prev", F.lit(0.0)))).alias("delta"),
        F.col("prev").isNull().cast("long").alias("new"))
    monthly = moves.groupBy("year", "month").agg(F.sum("delta").alias("delta"), F.sum("new").alias("new"))
    over_years = Window.orderBy("year").rowsBetween(Window.unboundedPreceding, -1)  # one row a year
    before = monthly.groupBy("year").agg(F.sum("delta").alias("d"), F.sum("new").alias("k")).select(
        "year", F.coalesce(F.sum("d").over(over_years), F.lit(0.0)).alias("d"),
        F.coalesce(F.sum("k").over(over_years), F.lit(0)).alias("k"))
    upto = Window.partitionBy("year").orderBy("month").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return monthly.select("year", "month", F.sum("delta").over(upto).alias("own_d"), F.sum("new").over(upto).alias("own_k")).join(
        before, "year").select(
        "month", (F.lit(prior_priced) + F.col("k") + F.col("own_k")).alias("assets_priced"),
        (F.lit(prior_value) + F.col("d") + F.col("own_d")).alias("portfolio_value"))


def first_value(steps: DataFrame, n_assets: int) -> DataFrame:
    """One row: the value in the first fully priced month, and that month."""
    return steps.where(F.col("assets_priced") == F.lit(n_assets)).agg(
        F.min_by("portfolio_value", "month").alias("init"), F.min("month").alias("init_month"))


def with_returns(steps: DataFrame, n_assets: int, init: float | None) -> DataFrame:
    """Fully priced months with the return against ``init``."""
    return steps.where(F.col("assets_priced") == F.lit(n_assets)).select(
        "month", "assets_priced",
        F.round("portfolio_value", VALUE_DIGITS).alias("portfolio_value"),
        (F.col("portfolio_value") / F.lit(init).cast("double") - 1).alias("cumulative_return"),
    )


def portfolio_value(prices: DataFrame, holdings: DataFrame) -> DataFrame:
    """(month, assets_priced, portfolio_value, cumulative_return)."""
    held = priced_holdings(prices, holdings)
    n_assets = held.count()
    steps = value_steps(prices, held)
    return with_returns(steps, n_assets, first_value(steps, n_assets).first()["init"])
