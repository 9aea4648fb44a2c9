"""Attaching a table with one row a key to rows of those keys, hot keys too.

The lookup is broadcast only up to ``LOOKUP_ROWS`` rows. A larger one is cut in
two: fewer than ``LOOKUP_ROWS`` keys can each have more than the rows' total over
``LOOKUP_ROWS``, and these are broadcast; the other keys, none of which is hot,
are joined by a shuffle. So rows of a hot key are never dealt by that key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a lookup that may be broadcast.
LOOKUP_ROWS = 100_000
#: Rows of a key that one task takes at most, where the lookup is larger.
KEY_ROWS = 1_000_000


def attach(rows: DataFrame, table: DataFrame, key: str, of: str, n_col: str) -> DataFrame:
    """``rows`` with the columns of ``table`` whose ``of`` is their ``key`` (NULL is
    a key like any other); rows without one are left out. ``n_col`` of ``table``
    counts the rows of the key. ``table`` is read several times."""
    same = F.col(key).eqNullSafe(F.col(of))
    n, total = table.agg(F.count(F.lit(1)), F.sum(n_col)).first()
    if n <= LOOKUP_ROWS:
        return rows.join(F.broadcast(table), same).drop(of)
    hot = table.where(F.col(n_col) > max(KEY_ROWS, total // LOOKUP_ROWS))
    others = rows.join(F.broadcast(hot.select(of)), same, "left_anti")
    return rows.join(F.broadcast(hot), same).unionByName(others.join(table, same)).drop(of)
