"""Column names that don't clash with those of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def columns(df: DataFrame, without: tuple[str, ...] = ()) -> list[Column]:
    """All columns of ``df`` but those named (in any case)."""
    gone = {c.lower() for c in without}
    return [F.col(f"`{c}`") for c in df.columns if c.lower() not in gone]


def row_key(df: DataFrame, id_col: str, text_col: str) -> Column:
    """(no id, id, hash of the text): tells rows of one id apart, sorts like the id
    (rows without one last) and is never null in any part."""
    kind = dict(df.dtypes)[id_col]
    own = F.col(f"`{id_col}`")
    return F.struct(own.isNull().alias("no_id"), F.coalesce(own, F.lit("0").cast(kind)).alias("id"),
                    F.xxhash64(f"`{text_col}`").alias("hash"))
