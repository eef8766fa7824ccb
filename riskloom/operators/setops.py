"""Set operations: union of shards / days (H1) and id-set difference (H2)."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame

from riskloom.operators.joins import diff_shards


def union_shards(parts: Iterable[DataFrame]) -> DataFrame:
    """Row-wise concatenation by column name; a column missing from a part
    is NULL there.  (Shards of one product are better read as one multi-file
    scan; this is for frames built separately.)"""
    parts = list(parts)
    if not parts:
        raise ValueError("nothing to union")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


id_set_difference = diff_shards
