"""Set operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by column name; a column missing from a frame is null.

    Columns come in order of first appearance. No shuffle: partitions of
    the inputs are simply concatenated.
    """
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
