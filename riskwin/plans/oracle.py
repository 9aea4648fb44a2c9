"""DuckDB SQL for every registered query, written independently of the
Spark plans: plain window functions and ``row_number`` ranks over the
pre-registered parquet views. Doubles are rounded like the Spark side.
"""

from __future__ import annotations

import math

from riskwin.config import PORTFOLIO, STATS, WINDOW_SIZE
from riskwin.functions.names import batch_name, flag_name, window_name
from riskwin.functions.rounding import round_exact_sql

ASSETS = [f"asset_{i}" for i in range(1, 7)]
TARGETS = [*ASSETS, PORTFOLIO]
D = 6
W = WINDOW_SIZE

Y1 = "y AS (SELECT vec_id + 1 AS ID, " + ", ".join(
    f"CAST(embedding[{i}] AS DOUBLE) AS asset_{i}" for i in range(1, 7)) + " FROM embeddings)"

Y2 = """y AS (SELECT l_orderkey AS ID,
    sum(l_quantity) / 1000 - 0.1 AS asset_1,
    sum(l_extendedprice) / 1e7 AS asset_2,
    avg(l_discount) - 0.05 AS asset_3,
    avg(l_tax) - 0.04 AS asset_4,
    min(l_discount) - 0.03 AS asset_5,
    max(l_tax) - 0.06 AS asset_6
  FROM lineitem GROUP BY l_orderkey)"""


def _r(expr: str, digits: int = D) -> str:
    """Half-even on the binary value, as the Spark side rounds."""
    return f"(round_even(({expr}) * 1e{digits}, 0) / 1e{digits})"


# ---- full-history statistics ---------------------------------------------------
def _batch_ctes(y: str) -> str:
    """CTEs ending in ``st(target, mean, median, tenth, tail_mean, safety)``."""
    parts = [f"SELECT '{a}' AS target, {a} AS x FROM y" for a in ASSETS]
    parts += [f"SELECT '{PORTFOLIO}' AS target, {a} AS x FROM y" for a in ASSETS]
    return f"""WITH {y},
v AS ({' UNION ALL '.join(parts)}),
c AS (SELECT target, count(*) AS n, avg(x) AS m FROM v GROUP BY target),
cm AS (SELECT target, n, CASE WHEN target = '{PORTFOLIO}'
          THEN (SELECT avg(m) FROM c WHERE target <> '{PORTFOLIO}') ELSE m END AS m FROM c),
rk AS (SELECT target, n, m,
          CAST(ceil(CAST(0.1 AS DOUBLE) * n) AS BIGINT) AS r_tenth,
          CAST(ceil(CAST(0.5 AS DOUBLE) * n) AS BIGINT) AS r_lo,
          CAST(ceil((CAST(n // 2 + 1 AS DOUBLE) / CAST(n AS DOUBLE)) * CAST(n AS DOUBLE)) AS BIGINT) AS r_hi,
          CAST(floor(CAST(0.1 AS DOUBLE) * n) AS BIGINT) AS k
       FROM cm),
o AS (SELECT target, x, row_number() OVER (PARTITION BY target ORDER BY x) AS rn FROM v),
st AS (SELECT rk.target,
          any_value(rk.m) AS mean,
          {round_exact_sql("(max(CASE WHEN rn = r_hi THEN x END) + max(CASE WHEN rn = r_lo THEN x END)) / 2", 4)} AS median,
          max(CASE WHEN rn = r_tenth THEN x END) AS tenth,
          sum(CASE WHEN rn <= k THEN x END) / any_value(k) AS tail_mean,
          any_value(rk.m) - sum(abs(x - rk.m)) / (2 * any_value(rk.n)) AS safety
       FROM o JOIN rk ON o.target = rk.target GROUP BY rk.target)"""


def batch_wide_sql(y: str, stats=STATS) -> str:
    cols = []
    for t in TARGETS:
        for s in stats:
            cols.append(f"{_r(f'max(CASE WHEN target = {chr(39)}{t}{chr(39)} THEN {s} END)')} AS {batch_name(t, s)}")
    return _batch_ctes(y) + "\nSELECT " + ",\n  ".join(cols) + " FROM st"


def batch_long_sql(y: str) -> str:
    parts = [f"SELECT target, '{s}' AS stat, {_r(s)} AS value FROM st" for s in STATS]
    return _batch_ctes(y) + "\n" + " UNION ALL ".join(parts)


def batch_approx_sql(y: str) -> str:
    """What a sketch gives that holds all values: the median is one element, the
    tail mean that of the values up to the tenth quantile."""
    ctes = _batch_ctes(y).split("st AS (")[0]
    parts = [f"SELECT target, '{s}' AS stat, {_r(s)} AS value FROM ap" for s in STATS]
    return ctes + f"""q AS (SELECT rk.target, any_value(rk.m) AS m, any_value(rk.n) AS n, any_value(k) AS k,
    max(CASE WHEN rn = r_lo THEN x END) AS med, max(CASE WHEN rn = r_tenth THEN x END) AS tenth
  FROM o JOIN rk ON o.target = rk.target GROUP BY rk.target),
ap AS (SELECT q.target, any_value(m) AS mean, {round_exact_sql("any_value(med)", 4)} AS median, any_value(tenth) AS tenth,
    CASE WHEN any_value(k) > 0 THEN avg(CASE WHEN x <= tenth THEN x END) END AS tail_mean,
    any_value(m) - sum(abs(x - m)) / (2 * any_value(n)) AS safety
  FROM v JOIN q ON v.target = q.target GROUP BY q.target)
""" + " UNION ALL ".join(parts)


def batch_per_target_sql(y: str) -> str:
    return _batch_ctes(y) + "\nSELECT target, " + ", ".join(f"{_r(s)} AS {s}" for s in STATS) + " FROM st"


def batch_per_stat_sql(y: str) -> str:
    parts = []
    for s in STATS:
        cols = ", ".join(f"{_r(f'max(CASE WHEN target = {chr(39)}{t}{chr(39)} THEN {s} END)')} AS {t}"
                         for t in TARGETS)
        parts.append(f"SELECT '{s}' AS stat, {cols} FROM st")
    return _batch_ctes(y) + "\n" + " UNION ALL ".join(parts)


# ---- rolling statistics ----------------------------------------------------------
def _window_ctes(y: str) -> str:
    lists = ", ".join(f"list({a}) OVER fw AS l_{a}" for a in ASSETS)
    return f"""WITH {y},
nf AS (SELECT count(*) AS n FROM y),
f AS (SELECT row_number() OVER (ORDER BY ID) - 1 AS window_index, count(*) OVER fw AS c, {lists}
      FROM y WINDOW fw AS (ORDER BY ID ROWS BETWEEN CURRENT ROW AND {W - 1} FOLLOWING)),
g AS (SELECT window_index, {', '.join(f'l_{a}, list_sort(l_{a}) AS s_{a}, list_avg(l_{a}) AS m_{a}' for a in ASSETS)},
        flatten([{', '.join(f'l_{a}' for a in ASSETS)}]) AS l_{PORTFOLIO}
      FROM f WHERE c = {W}),
h AS (SELECT *, list_sort(l_{PORTFOLIO}) AS s_{PORTFOLIO}, list_avg(l_{PORTFOLIO}) AS m_{PORTFOLIO} FROM g)"""


def _window_stat(t: str, s: str, median: str = "reference", quantile: str = "reference", safety: str = "history") -> str:
    pooled = t == PORTFOLIO
    size = W * len(ASSETS) if pooled else W
    sv, lv, mv = f"s_{t}", f"l_{t}", f"m_{t}"
    tail = (size // len(ASSETS)) * (len(ASSETS) / 10) if pooled else 0.1 * size
    if s == "mean":
        e = mv
    elif s == "median":
        first = size // 2 + 1 if median == "reference" else size // 2
        e = f"({sv}[{first}] + {sv}[{first + 1}]) / 2"
    elif s == "tenth":
        e = f"{sv}[{int(tail) + 1 if quantile == 'reference' else max(math.ceil(0.1 * size), 1)}]"
    elif s == "tail_mean":
        e = f"list_sum({sv}[1:{int(tail)}]) / CAST({tail!r} AS DOUBLE)"
    else:
        mult = len(ASSETS) if pooled else 1
        n = f"{mult} * (SELECT n FROM nf)" if safety == "history" else str(size)
        e = f"{mv} - list_sum(list_transform({lv}, lambda x: abs(x - {mv}))) / (2.0 * {n})"
    return e


def rolling_sql(y: str, stats=STATS, targets=TARGETS, **options: str) -> str:
    cols = [f"{_r(_window_stat(t, s, **options))} AS {window_name(t, s)}" for t in targets for s in stats]
    return _window_ctes(y) + "\nSELECT window_index, " + ",\n  ".join(cols) + " FROM h"


# ---- overrun ---------------------------------------------------------------------
def _flag(w: str, b: str) -> str:
    return (f"CAST(CASE WHEN {w} IS NULL OR {b} IS NULL OR isnan({w}) OR isnan({b}) THEN 0 "
            f"WHEN 1 + {b} = 0 THEN CASE WHEN {b} > {w} THEN 1 ELSE 0 END "
            f"WHEN isnan(({b} - {w}) / (1 + {b})) THEN 0 "
            f"WHEN ({b} - {w}) / (1 + {b}) >= 0.01 THEN 1 ELSE 0 END AS INTEGER)")


def _flags_ctes(y: str) -> str:
    base = _batch_ctes(y)
    bcols = ", ".join(f"max(CASE WHEN target = '{t}' THEN {s} END) AS b_{t}_{s}" for t in TARGETS for s in STATS)
    wcols = ", ".join(f"{_window_stat(t, s)} AS w_{t}_{s}" for t in TARGETS for s in STATS)
    win = _window_ctes("yy AS (SELECT 1)").split(",\n", 1)[1]
    return (base + f",\nb AS (SELECT {bcols} FROM st),\n" + win
            + f",\nws AS (SELECT window_index, {wcols} FROM h),\n"
            + "fl AS (SELECT window_index, "
            + ", ".join(f"{_flag(f'w_{t}_{s}', f'b_{t}_{s}')} AS {flag_name(t, s)}" for s in STATS for t in TARGETS)
            + " FROM ws, b)")


def flags_sql(y: str) -> str:
    cols = [flag_name(t, s) for s in STATS for t in TARGETS]
    return _flags_ctes(y) + "\nSELECT window_index, " + ", ".join(cols) + " FROM fl"


def alerts_sql(y: str) -> str:
    parts = [f"SELECT window_index, '{t}' AS target, '{s}' AS stat FROM fl WHERE {flag_name(t, s)} = 1"
             for s in STATS for t in TARGETS]
    return _flags_ctes(y) + "\n" + " UNION ALL ".join(parts)


def counts_sql(y: str) -> str:
    parts = [f"SELECT '{t}' AS target, '{s}' AS stat, CAST(coalesce(sum({flag_name(t, s)}), 0) AS BIGINT) AS flagged FROM fl"
             for s in STATS for t in TARGETS]
    return _flags_ctes(y) + "\n" + " UNION ALL ".join(parts)


def lines_sql(y: str) -> str:
    cols = [f"CAST({flag_name(t, s)} AS VARCHAR)" for s in STATS for t in TARGETS]
    return (_flags_ctes(y) + "\nSELECT window_index, CAST(window_index AS VARCHAR) || ' [' || concat_ws(', ', "
            + ", ".join(cols) + ") || ']' AS line FROM fl")


# ---- keyed series (events) --------------------------------------------------------
EV = "e AS (SELECT event_type AS series, event_id AS ID, value AS x FROM events)"


def _series_window() -> str:
    return f"""WITH {EV},
nf AS (SELECT series, count(*) AS n FROM e GROUP BY series),
f AS (SELECT series, row_number() OVER (PARTITION BY series ORDER BY ID) - 1 AS window_index,
         count(*) OVER fw AS c, list(x) OVER fw AS l
      FROM e WINDOW fw AS (PARTITION BY series ORDER BY ID ROWS BETWEEN CURRENT ROW AND {W - 1} FOLLOWING)),
h AS (SELECT f.series, window_index, l, list_sort(l) AS s, list_avg(l) AS m, nf.n
      FROM f JOIN nf ON f.series = nf.series WHERE c = {W}),
ws AS (SELECT series, window_index, m AS mean, (s[{W // 2 + 1}] + s[{W // 2 + 2}]) / 2 AS median,
         s[{int(0.1 * W) + 1}] AS tenth, list_sum(s[1:{int(0.1 * W)}]) / CAST({0.1 * W!r} AS DOUBLE) AS tail_mean,
         m - list_sum(list_transform(l, lambda v: abs(v - m))) / (2.0 * n) AS safety FROM h)"""


def series_rolling_sql() -> str:
    return _series_window() + "\nSELECT series, window_index, " + ", ".join(f"{_r(s)} AS {s}" for s in STATS) + " FROM ws"


def _series_batch() -> str:
    return _keyed_batch("series", "e")


def _keyed_batch(key: str, e: str) -> str:
    """CTEs ending in ``st`` with a row per key of table ``e`` (key, x)."""
    return f"""c AS (SELECT {key}, count(*) AS n, avg(x) AS m FROM {e} GROUP BY {key}),
rk AS (SELECT {key}, n, m,
          CAST(ceil(CAST(0.1 AS DOUBLE) * n) AS BIGINT) AS r_tenth,
          CAST(ceil(CAST(0.5 AS DOUBLE) * n) AS BIGINT) AS r_lo,
          CAST(ceil((CAST(n // 2 + 1 AS DOUBLE) / CAST(n AS DOUBLE)) * CAST(n AS DOUBLE)) AS BIGINT) AS r_hi,
          CAST(floor(CAST(0.1 AS DOUBLE) * n) AS BIGINT) AS k FROM c),
o AS (SELECT {key}, x, row_number() OVER (PARTITION BY {key} ORDER BY x) AS rn FROM {e}),
st AS (SELECT rk.{key}, any_value(rk.m) AS mean, any_value(rk.n) AS n,
          {round_exact_sql("(max(CASE WHEN rn = r_hi THEN x END) + max(CASE WHEN rn = r_lo THEN x END)) / 2", 4)} AS median,
          max(CASE WHEN rn = r_tenth THEN x END) AS tenth,
          sum(CASE WHEN rn <= k THEN x END) / any_value(k) AS tail_mean,
          any_value(rk.m) - sum(abs(x - rk.m)) / (2 * any_value(rk.n)) AS safety
       FROM o JOIN rk ON o.{key} = rk.{key} GROUP BY rk.{key})"""


def series_batch_sql() -> str:
    return f"WITH {EV},\n" + _series_batch() + "\nSELECT series, " + ", ".join(f"{_r(s)} AS {s}" for s in STATS) + " FROM st"


def series_flags_sql() -> str:
    flags = ", ".join(f"{_flag(f'ws.{s}', f'st.{s}')} AS {s}_ovr" for s in STATS)
    return (_series_window() + ",\n" + _series_batch()
            + f"\nSELECT ws.series, ws.window_index, {flags} FROM ws JOIN st ON ws.series = st.series")


# ---- other queries -----------------------------------------------------------------
def k_smallest_sql(k: int = 10) -> str:
    parts = [f"SELECT '{a}' AS target, ID, '{a}' AS asset, {a} AS yield FROM y" for a in ASSETS]
    parts += [f"SELECT '{PORTFOLIO}' AS target, ID, '{a}' AS asset, {a} AS yield FROM y" for a in ASSETS]
    return (f"WITH {Y2}, v AS ({' UNION ALL '.join(parts)}),\n"
            "r AS (SELECT target, ID, asset, yield, row_number() OVER (PARTITION BY target ORDER BY yield, ID, asset) AS rank FROM v)\n"
            f"SELECT target, ID, asset, {_r('yield')} AS yield, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= {k}")


def melt_sql() -> str:
    parts = [f"SELECT ID, '{a}' AS asset, {_r(a)} AS yield FROM y" for a in ASSETS]
    return f"WITH {Y1}\n" + " UNION ALL ".join(parts)


def flatten_sql() -> str:
    parts = [f"SELECT (ID - 1) * 6 + {i} AS flat_idx, ID, '{a}' AS asset, {_r(a)} AS {PORTFOLIO} FROM y"
             for i, a in enumerate(ASSETS)]
    return f"WITH {Y1}\n" + " UNION ALL ".join(parts)


def dense_index_sql() -> str:
    return (f"WITH {Y2}\nSELECT ID, CAST(row_number() OVER (ORDER BY ID) - 1 AS BIGINT) AS idx FROM y")


def parse_sql() -> str:
    return f"WITH {Y1}\nSELECT ID, " + ", ".join(f"{_r(a)} AS {a}" for a in ASSETS) + " FROM y"


def dense_index_repeated_sql() -> str:
    return """SELECT l_orderkey AS ID, l_linenumber, l_partkey, l_suppkey, l_quantity, row_number() OVER (
  ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity) - 1 AS idx FROM lineitem"""


def hot_ties_sql() -> str:
    return ("WITH e AS (SELECT 'l_discount' AS target, l_discount AS x FROM lineitem UNION ALL SELECT 'l_tax', l_tax FROM lineitem),\n"
            + _keyed_batch("target", "e") + "\nSELECT target, n, " + ", ".join(f"{_r(s)} AS {s}" for s in STATS) + " FROM st")


def all_coordinates_sql() -> str:
    return ("WITH e AS (SELECT CAST(i - 1 AS INTEGER) AS target, CAST(embedding[i] AS DOUBLE) AS x FROM (\n"
            "  SELECT embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)),\n"
            + _keyed_batch("target", "e") + "\nSELECT target, n, " + ", ".join(f"{_r(s)} AS {s}" for s in STATS) + " FROM st")


def rejects_sql() -> str:
    return """WITH l AS (SELECT o_orderkey % 7 AS k, CAST(o_orderkey AS VARCHAR) AS o FROM orders)
SELECT CASE k WHEN 1 THEN o || ' 0.1' WHEN 2 THEN o || ' NA 0.2' WHEN 3 THEN o || ' 0.1f 0.2d' WHEN 4 THEN ' ' || chr(9) || ' '
    ELSE 'x' || o || ' 1. +2' END AS line,
  CASE k WHEN 1 THEN 'too few tokens' WHEN 4 THEN 'blank' ELSE 'not a number' END AS reason
FROM l WHERE k IN (1, 2, 3, 4, 6)"""


def odd_lines_sql() -> str:
    return """SELECT o_orderkey AS ID, CASE o_orderkey % 7 WHEN 0 THEN 0.1::DOUBLE ELSE -0.5::DOUBLE END AS asset_1,
  CASE o_orderkey % 7 WHEN 0 THEN 0.2::DOUBLE ELSE 0.001::DOUBLE END AS asset_2
FROM orders WHERE o_orderkey % 7 IN (0, 5)"""


def yield_rejects_sql() -> str:
    return f"""WITH {Y1}
SELECT CASE WHEN ID % 25 <> 0 THEN ID END AS ID, {_r('asset_2')} AS asset_2,
  CASE WHEN ID % 25 = 0 THEN 'missing key' ELSE 'missing or NaN yield' END AS reason
FROM y WHERE ID % 25 = 0 OR ID % 10 = 0 OR ID % 15 = 1"""


def metrics_sql(by: str) -> str:
    outer, inner = (STATS, TARGETS) if by == "stat" else (TARGETS, STATS)
    quote, lines = "'" * 2, []
    for i, o in enumerate(outer):
        entries = []
        for x in inner:
            t, s = (x, o) if by == "stat" else (o, x)
            entries.append(f"'{quote}{batch_name(t, s)}{quote}: ' || printf('%.{D}f', (SELECT {s} FROM st WHERE target = '{t}'))")
        lines.append(f"SELECT {i + 4} AS seq, '{{' || " + " || ', ' || ".join(entries) + " || '}' AS line")
    rule = "-" * 80
    frame = f"SELECT 0 AS seq, '{rule}' AS line UNION ALL SELECT 2, 'Baseline' UNION ALL SELECT 1000000000, '{rule}'"
    return _batch_ctes(Y1) + "\nSELECT CAST(seq AS BIGINT) AS seq, line FROM (" + " UNION ALL ".join([frame, *lines]) + ")"


def portfolio_value_sql() -> str:
    return """WITH p AS (
  SELECT c_mktsegment AS asset, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, avg(o_totalprice) AS price
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
h AS (SELECT c_mktsegment AS asset, count(*) / sum(count(*)) OVER () AS share FROM customer GROUP BY 1),
months AS (SELECT DISTINCT month FROM p),
grid AS (SELECT months.month, h.asset, h.share, p.price FROM months CROSS JOIN h
         LEFT JOIN p ON p.month = months.month AND p.asset = h.asset),
filled AS (SELECT month, asset, share,
             last_value(price IGNORE NULLS) OVER (PARTITION BY asset ORDER BY month
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS price FROM grid),
val AS (SELECT month, count(price) AS assets_priced, sum(share * price) AS v FROM filled GROUP BY month),
ok AS (SELECT * FROM val WHERE assets_priced = (SELECT count(*) FROM h))
SELECT month, assets_priced, round(v, 2) AS portfolio_value,
  (round_even((v / first_value(v) OVER (ORDER BY month) - 1) * 1e6, 0) / 1e6) AS cumulative_return FROM ok"""


def catalog_sql() -> dict[str, str]:
    single = {
        "batch_means": "mean", "batch_medians": "median", "batch_tenth_quantile": "tenth",
        "batch_tail_mean": "tail_mean", "batch_safety": "safety",
    }
    out = {name: batch_wide_sql(Y1, [st]) for name, st in single.items()}
    rolling_single = {
        "rolling_mean": "mean", "rolling_median": "median", "rolling_tenth": "tenth",
        "rolling_tail_mean": "tail_mean", "rolling_safety": "safety",
    }
    out.update({name: rolling_sql(Y1, [st]) for name, st in rolling_single.items()})
    out.update({
        "overrun_flags": flags_sql(Y1),
        "batch_stats_wide": batch_wide_sql(Y1),
        "batch_stats_long": batch_long_sql(Y2),
        "batch_stats_per_asset": batch_per_target_sql(Y1),
        "batch_stats_per_stat": batch_per_stat_sql(Y1),
        "melt_assets": melt_sql(),
        "flatten_records": flatten_sql(),
        "dense_index": dense_index_sql(),
        "rolling_portfolio": rolling_sql(Y1, STATS, [PORTFOLIO]),
        "rolling_all": rolling_sql(Y2),
        "overrun_alerts_long": alerts_sql(Y2),
        "overrun_counts": counts_sql(Y2),
        "overrun_lines": lines_sql(Y1),
        "k_smallest": k_smallest_sql(),
        "parse_yield_lines": parse_sql(),
        "rolling_by_series": series_rolling_sql(),
        "batch_by_series": series_batch_sql(),
        "overrun_by_series": series_flags_sql(),
        "portfolio_value": portfolio_value_sql(),
        "stream_overruns": flags_sql(Y1),
        "stream_overruns_text": flags_sql(Y1),
        "batch_hot_ties": hot_ties_sql(),
        "batch_all_coordinates": all_coordinates_sql(),
        "dense_index_repeated": dense_index_repeated_sql(),
        "rolling_true_median": rolling_sql(Y1, ["median"], median="true"),
        "rolling_disc_quantile": rolling_sql(Y1, ["tenth"], quantile="disc"),
        "rolling_window_safety": rolling_sql(Y1, ["safety"], safety="window"),
        "rolling_all_native": rolling_sql(Y1),
        "parse_rejects": rejects_sql(),
        "parse_odd_lines": odd_lines_sql(),
        "yield_rejects": yield_rejects_sql(),
        "metrics_per_stat": metrics_sql("stat"),
        "metrics_per_asset": metrics_sql("target"),
        "stream_portfolio_value": portfolio_value_sql(),
        "stream_rolling_by_series": series_rolling_sql(),
        "stream_overruns_by_series": series_flags_sql(),
        "batch_stats_approx": batch_approx_sql(Y1),
    })
    return out
