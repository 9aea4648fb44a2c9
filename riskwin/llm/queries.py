"""The registered queries of this subpackage, and the SQL of those that have one."""

from __future__ import annotations

import importlib
from collections.abc import Callable

#: Query names, their modules and what holds their SQL (None: SQL has none).
NAMES = {
    "op1_toxicity": ("toxicity", None),
    "op2_langid": ("langid", None),
    "op3_simhash": ("simhash", None),
    "op4_mixing": ("mixing", "mixing_sql"),
    "op5_topk": ("vafile", "TOPK_SQL"),
    "op6_pii": ("pii", None),
    "op7_warc": ("warc", "WARC_SQL"),
    "op8_decontam": ("decontam", None),
    "op9_token_store": ("token_store", None),
    "op10_sharding": ("sharding", None),
    "op11_prefix_trie": ("prefix_trie", "TRIE_SQL"),
    "op12_jaccard": ("token_groups", "JACCARD_SQL"),
    "op13_clusters": ("zonemap", "clusters_sql"),
}


def load(name: str) -> tuple[Callable, str | None]:
    """A query and its SQL."""
    module, sql = NAMES[name]
    found = importlib.import_module(f"riskwin.llm.{module}")
    text = getattr(found, sql) if sql else None
    return getattr(found, name), text() if callable(text) else text


def llm_queries() -> dict[str, Callable]:
    return {name: load(name)[0] for name in NAMES}


def llm_sql() -> dict[str, str]:
    return {name: sql for name in NAMES if (sql := load(name)[1])}
