"""Whitespace-separated yield text files (SRC1-SRC3, SRC7).

Line layout: ``ID y1 .. yn``; the ID may be quoted (``"1"``, as R's
``write.table`` writes row names). Tokens after the n-th value are ignored.
Lines that are blank, short, or hold a token that is not a number go to a
rejects table with the reason, instead of failing the job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskwin.sources.fixtures import asset_names


# what a number looks like, as Python's float() takes it (but for underscores)
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$|^[+-]?(?i:inf|infinity|nan)$"


def parse_lines(lines: DataFrame, n_assets: int, line_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """(records, rejects with the reason) of lines; white space of any kind
    parts the tokens and may surround them."""
    bare = F.regexp_replace(F.col(line_col), r"^\s+|\s+$", "")
    tokens = F.split(bare, r"\s+")
    assets = asset_names(n_assets)
    values = [F.get(tokens, i + 1) for i in range(n_assets)]
    parsed = lines.select(
        F.col(line_col).alias("line"),
        F.when(bare.isNull() | (bare == ""), F.lit(0)).otherwise(F.size(tokens)).alias("_n"),
        F.regexp_replace(F.get(tokens, 0), '"', "").try_cast("bigint").alias("ID"),
        *[F.when(v.rlike(NUMBER), v.try_cast("double")).alias(a) for v, a in zip(values, assets)],
    )
    ok = F.col("_n") >= n_assets + 1
    for c in ["ID", *assets]:
        ok = ok & F.col(c).isNotNull()
    good = parsed.where(ok).select("ID", *assets)
    reason = (
        F.when(F.col("_n") == 0, F.lit("blank"))
        .when(F.col("_n") < n_assets + 1, F.lit("too few tokens"))
        .otherwise(F.lit("not a number"))
    )
    bad = parsed.where(~ok).select("line", reason.alias("reason"))
    return good, bad


def read_yield_text(spark: SparkSession, path: str, n_assets: int = 6) -> tuple[DataFrame, DataFrame]:
    """(yields, rejects) from text files; splits come from the file sizes."""
    return parse_lines(spark.read.text(path), n_assets)


def render_lines(wide: DataFrame, assets: Sequence[str], quote_ids: bool = True, keep_id: bool = False) -> DataFrame:
    """One text line per record: ``"ID" y1 .. yn`` (SRC7 layout), beside the ID
    with ``keep_id``."""
    idc = F.concat(F.lit('"'), F.col("ID").cast("string"), F.lit('"')) if quote_ids else F.col("ID").cast("string")
    line = F.concat_ws(" ", idc, *[F.col(a).cast("string") for a in assets]).alias("value")
    return wide.select("ID", line) if keep_id else wide.select(line)


def write_yield_text(wide: DataFrame, path: str, assets: Sequence[str], quote_ids: bool = True) -> None:
    render_lines(wide, assets, quote_ids).write.mode("overwrite").text(path)
