"""Portfolio valuation over a stream of price observations (STR5).

Observations (asset, month, price) arrive in any order. Between batches the state
is each asset's last price (one row per asset), a row of counters, and the
observations of held assets so far, written once a batch and read only when one
comes late. A batch after all earlier months continues the running value
(``valuation.value_steps``). One with an observation that is not after the last
month restates: the value before its first month is taken from the observations,
and all months from there on are valued anew; all months there are, if the first
fully priced month, which the returns refer to, may have changed. Months go to
``<sink>/batch_id=<id>`` (overwrite: a replayed batch rewrites itself), and the
latest batch holds (``read_values``). Observations without a month or a price are
unusable, counted and dropped; late ones are counted. The result equals the batch
valuation whatever the order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskwin.operators.valuation import first_value, priced_holdings, valid_prices, value_steps, with_returns
from riskwin.session import checkpoint_root, scratch_path
from riskwin.streaming.replay import BatchState, run_stream, write_in_order

COUNTERS = "value double, priced long, init double, init_month date, last_month date, late long, rejected long"
HISTORY = T.StructType([T.StructField("asset", T.StringType()), T.StructField("month", T.DateType()),
                        T.StructField("price", T.DoubleType()), T.StructField("batch_id", T.LongType())])
PRICES = T.StructType([T.StructField("asset", T.StringType()), T.StructField("price", T.DoubleType())])


class ValuationMonitor:
    """``foreachBatch`` handler: running portfolio value with carry-forward.

    Months are reported once all ``holdings`` have a price."""

    def __init__(self, spark: SparkSession, holdings: DataFrame, sink: str, state: str):
        checkpoint_root(spark)
        self.spark, self.sink = spark, sink
        self.state, self.last_batch = BatchState(spark, state), -1
        self.holdings = holdings.select("asset", "share").checkpoint()  # a row per asset, used in every batch
        self.n_assets = self.holdings.count()

    def late_records(self) -> int:
        """Observations that restated months."""
        return int(self.state.read_row(self.last_batch)["late"]) if self.last_batch >= 0 else 0

    def rejected_records(self) -> int:
        return int(self.state.read_row(self.last_batch)["rejected"]) if self.last_batch >= 0 else 0

    def _earlier(self, batch_id: int) -> DataFrame:
        """The observations of the batches before."""
        return self.spark.read.schema(HISTORY).parquet(f"{self.state.folder}/history").where(
            F.col("batch_id") < batch_id).drop("batch_id")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        if batch_id == 0:
            prices, value, priced, init, init_month, last_month, late, rejected = None, 0.0, 0, None, None, None, 0, 0
        else:
            _, value, priced, init, init_month, last_month, late, rejected = self.state.read_row(batch_id - 1)
            prices = self.state.read("prices", batch_id - 1, PRICES)
        batch = batch.select("asset", "month", F.col("price").cast("double").alias("price")).persist()
        own = valid_prices(batch).join(self.holdings.select("asset"), "asset", "left_semi")
        own.write.mode("overwrite").parquet(f"{self.state.folder}/history/batch_id={batch_id}")
        own = self.spark.read.schema(own.schema).parquet(f"{self.state.folder}/history/batch_id={batch_id}")
        is_late = F.lit(False) if last_month is None else F.col("month") <= F.lit(last_month)
        first_month, n_late = own.agg(F.min("month"), F.count_if(is_late)).first()
        n_bad = batch.count() - valid_prices(batch).count()
        late, rejected = late + n_late, rejected + n_bad
        obs = own
        if n_late:
            earlier = self._earlier(batch_id)
            if init_month is not None and first_month <= init_month:
                init, prices, value, priced = None, None, 0.0, 0
                obs = earlier.unionByName(own)
            else:
                before = F.col("month") < F.lit(first_month)
                prices = self._latest(earlier.where(before)).checkpoint()
                value, priced = prices.join(self.holdings, "asset").agg(
                    F.coalesce(F.sum(F.col("share") * F.col("price")), F.lit(0.0)), F.count(F.lit(1))).first()
                obs = earlier.where(~before).unionByName(own)
        steps = value_steps(obs, self.holdings, prices, value, priced).persist()
        end = steps.agg(F.max("month").alias("m"), F.max_by("portfolio_value", "month").alias("v"),
                        F.max_by("assets_priced", "month").alias("p")).first()
        if end["m"] is not None:
            if init is None:
                init, init_month = first_value(steps, self.n_assets).first()
            with_returns(steps, self.n_assets, init).write.mode("overwrite").parquet(f"{self.sink}/batch_id={batch_id}")
            value, priced, last_month = end["v"], int(end["p"]), end["m"]
        seen = obs.select("asset", "month", "price")
        if prices is not None:
            seen = seen.unionByName(prices.select("asset", F.lit(None).cast("date").alias("month"), "price"))
        self.state.write("prices", batch_id, self._latest(seen))
        self.state.write_row(batch_id, (float(value), priced, init, init_month, last_month, late, rejected), COUNTERS)
        self.last_batch = batch_id
        steps.unpersist()
        batch.unpersist()

    @staticmethod
    def _latest(seen: DataFrame) -> DataFrame:
        """(asset, price): the last of each; a NULL month is before all."""
        first_date = F.to_date(F.lit("0001-01-01"))
        return seen.groupBy("asset").agg(F.max_by("price", F.struct(F.coalesce("month", first_date), "price")).alias("price"))


def read_values(spark: SparkSession, sink: str) -> DataFrame:
    """The months of a sink, each as the latest batch has it."""
    rows = spark.read.parquet(sink)
    columns = [c for c in rows.columns if c not in ("month", "batch_id")]
    return rows.groupBy("month").agg(F.max_by(F.struct(*columns), "batch_id").alias("row")).select("month", "row.*")


def stream_value_from_table(spark: SparkSession, prices: DataFrame, holdings: DataFrame,
                            files: int = 4) -> DataFrame:
    """Replay a price table as a file stream; return the streamed valuation."""
    prices = prices.select("asset", "month", "price").persist()
    src, sink, state, ck = (scratch_path(spark, f"value-{n}") for n in ("src", "sink", "state", "ck"))
    together = write_in_order(prices, src, "month", files)
    handler = ValuationMonitor(spark, priced_holdings(prices, holdings), sink, state)
    run_stream(spark, src, prices.schema, handler, ck, together)
    prices.unpersist()
    return read_values(spark, sink)
