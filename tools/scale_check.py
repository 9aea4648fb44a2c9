"""Scale check: N synthetic records with gapped IDs through the full monitor.

Usage: python tools/scale_check.py <scratch folder> [records]

Writes the records to Parquet under the scratch folder, runs the monitor with
default parameters and compares the full-history statistics with
a numpy sort of the same data. Not a registered query: the input is synthetic.
"""

import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

from pyspark.sql import functions as F  # noqa: E402

import brute  # noqa: E402
from riskwin.config import PORTFOLIO, STATS  # noqa: E402
from riskwin.operators.overrun import overrun_counts  # noqa: E402
from riskwin.plans.monitor import run_monitor  # noqa: E402
from riskwin.session import build_session  # noqa: E402


def main() -> None:
    out = sys.argv[1]
    n = int(sys.argv[2]) if len(sys.argv) > 2 else 4_000_000
    spark = build_session()
    spark.sparkContext.setLogLevel("ERROR")
    assets = [f"asset_{i}" for i in range(1, 7)]
    src = spark.range(n, numPartitions=16).select(
        (F.col("id") * 3 + F.col("id") % 2).alias("ID"),
        *[F.round(F.randn(17 + i) * 0.05, 4).alias(a) for i, a in enumerate(assets)])
    src.write.mode("overwrite").parquet(out + "/yields")
    wide = spark.read.parquet(out + "/yields")

    t = time.time()
    m = run_monitor(wide, assets)
    print("index + baseline s", round(time.time() - t, 1), flush=True)
    t = time.time()
    counts = {(r.target, r.stat): r.flagged for r in overrun_counts(m.flags, assets).collect()}
    print("windows + flags + counts s", round(time.time() - t, 1), flush=True)

    x = wide.orderBy("ID").toPandas()[assets].to_numpy()
    worst = 0.0
    for j, a in enumerate(assets):
        exp = brute.batch(x[:, j])
        worst = max(worst, *(abs(m.baseline.get(a, s) - exp[s]) for s in STATS))
    exp = brute.batch(x.reshape(-1))
    worst = max(worst, *(abs(m.baseline.get(PORTFOLIO, s) - exp[s]) for s in ("median", "tenth", "tail_mean")))
    print("max |baseline - numpy|", worst)
    print("windows", m.windows.count(), "expected", n - 29)
    print("flags raised", sum(counts.values()))


if __name__ == "__main__":
    main()
