"""Keyed merge of incoming rows into a stored snapshot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def merge_snapshot(stored: DataFrame | None, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The new snapshot: an incoming row replaces the stored row of its key, the others stay.

    Both sides hold a key at most once. Only the keys of ``incoming`` are matched against the
    stored rows. If Spark knows them to be few (a table just written) it broadcasts them and the
    stored snapshot is streamed through without a shuffle; if not, both sides meet by key.
    The result is for a new location; it never overwrites the snapshot it reads.
    """
    if stored is None:
        return incoming
    untouched = stored.join(incoming.select(*keys), list(keys), "left_anti")
    return incoming.unionByName(untouched.select(*incoming.columns))
