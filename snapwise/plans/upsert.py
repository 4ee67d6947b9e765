"""Keyed merge primitives.

No table format with MERGE is assumed. An upsert is a keyed full outer join
(or anti-join + union) producing the next state of the table; idempotent by
construction.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def upsert(stored: DataFrame, incoming: DataFrame, key: list[str]) -> DataFrame:
    """ON CONFLICT (key) DO UPDATE SET every column = incoming's value.

    Incoming keys must be unique (deduplicate upstream); stored rows whose key
    is not in ``incoming`` are kept unchanged. Anti-join + union: one shuffle
    of each side by key, no per-row branching."""
    inc = incoming.select(*stored.columns)
    kept = stored.join(inc.select(*key), key, "left_anti")
    return kept.unionByName(inc)


def guarded_append(stored: DataFrame, incoming: DataFrame, key: list[str]) -> DataFrame:
    """C20: INSERT ... WHERE NOT EXISTS (same key already stored)."""
    new = incoming.join(stored.select(*key), key, "left_anti")
    return stored.unionByName(new.select(*stored.columns))


def new_rows(stored: DataFrame, incoming: DataFrame, key: list[str]) -> DataFrame:
    """The rows a guarded append would add (for run reports)."""
    return incoming.join(stored.select(*key), key, "left_anti")
