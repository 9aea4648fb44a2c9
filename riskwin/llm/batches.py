"""Arrow batch size for tables of texts."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Rows of an Arrow batch. Texts run to 100 KB and more; Spark's default of
#: 10 000 rows holds tens of MB outside the heap for each running task.
ROWS = 1000
_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Lower the session's batch size to ``ROWS`` if it is higher."""
    if not 0 < int(spark.conf.get(_KEY)) <= ROWS:
        spark.conf.set(_KEY, str(ROWS))
