"""Which side of a join is small enough to broadcast.

The optimizer's estimate of a table goes by the bytes of its files. Compressed columns
take few of them: a key column of millions of rows can be under the broadcast
threshold, and the driver, which builds the hash table of every broadcast, then holds
hundreds of megabytes. So an estimate alone never leads to a broadcast here: rows and
bytes of text of a side that the estimate calls small are counted first
(``memory_bytes``), and a side that is not small in memory is joined by shuffle, even
where only some of its columns are read in the end.
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)

DEFAULT_BROADCAST_CEILING = 64 * 1024 * 1024
# Bytes of a hash table for each row beside its columns.
ROW_BYTES = 32
# A plan that reads one column of many is estimated at that column's share: up to so many
# times the threshold an estimate of all columns can come under it.
PRUNED = 64


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of a plan, or None when unknown."""
    if not hasattr(df, "_jdf"):  # a remote session shows no plan
        return None
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _bytes_of(field: T.StructField) -> tuple[int, Column | None]:
    """Bytes that every value of a column takes, and what longer ones add."""
    c, kind = F.col(f"`{field.name}`"), field.dataType
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return 8, F.octet_length(c)
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        return 16, F.octet_length(F.to_json(c))
    return (24 if isinstance(kind, T.DecimalType) and kind.precision > 18 else 8), None


# Frames are counted once in a session, by the hash of their plan: the numbers decide
# how a join is carried out, never what comes out.
_counted: dict[tuple[str, int], int] = {}


def memory_bytes(df: DataFrame) -> int:
    """About how many bytes the rows of a frame take in a broadcast's hash table. One
    aggregate of one row, run once for a frame."""
    key = (df.sparkSession.sparkContext.applicationId, df.semanticHash())
    if key not in _counted:
        own, more = zip(*[_bytes_of(f) for f in df.schema.fields]) if df.columns else ((), ())
        text = [F.coalesce(x, F.lit(0)).cast("long") for x in more if x is not None]
        n, extra = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(sum(text, F.lit(0).cast("long"))), F.lit(0))).first()
        _counted[key] = n * (ROW_BYTES + sum(own)) + extra
    return _counted[key]


def fits_broadcast(df: DataFrame, ceiling: int = DEFAULT_BROADCAST_CEILING) -> bool:
    """Whether a frame takes at most ``ceiling`` bytes, by the optimizer's estimate (which
    has to be known) and, where that is under it, in memory."""
    size = estimated_bytes(df)
    if size is not None and size <= ceiling:
        size = memory_bytes(df)
        if size <= ceiling:
            return True
    log.info("not broadcasting: %s bytes > %s", size, ceiling)
    return False


def auto_broadcast_bytes(df: DataFrame) -> int:
    """Up to which estimate the optimizer broadcasts a side by itself."""
    text = str(df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold")).lower().removesuffix("b")
    unit = {"k": 10, "m": 20, "g": 30, "t": 40}.get(text[-1:], 0)
    return int(text[:-1] if unit else text) << unit


def bounded_broadcast(df: DataFrame, ceiling: int = DEFAULT_BROADCAST_CEILING) -> DataFrame:
    """Broadcast hint for a side that takes at most ``ceiling`` bytes (``fits_broadcast``).

    Any other side is marked as in ``shuffled`` and joined by shuffle, unless adaptive
    execution finds a small one where nothing was estimated (a rule table built in memory).
    """
    return F.broadcast(df) if fits_broadcast(df, ceiling) else shuffled(df)


def _tempting(df: DataFrame, limit: int) -> bool:
    """Whether the optimizer may broadcast a frame, or some of its columns, by its estimate."""
    size = estimated_bytes(df)
    return limit > 0 and size is not None and size <= limit * PRUNED


def shuffled(df: DataFrame) -> DataFrame:
    """A side that is not small in memory, marked for a shuffle join where its estimate could
    have it broadcast. Others are left to the optimizer, which goes by real sizes while
    it runs."""
    return df.hint("merge") if _tempting(df, auto_broadcast_bytes(df)) else df


def sized_join(left: DataFrame, right: DataFrame, on, how: str = "inner", like: DataFrame | None = None,
               small: bool | None = None) -> DataFrame:
    """``left.join(right, on, how)``, whose right side is broadcast if it is small in memory,
    and neither side by its estimate alone. ``like``: a frame of the right side's rows and
    at least its columns that is cheaper to count; ``small``: whether the right side is
    small, where the caller has counted it."""
    limit = auto_broadcast_bytes(left)
    if fits_broadcast(right if like is None else like, limit) if small is None else small:
        return left.join(F.broadcast(right), on, how)
    if _tempting(right, limit) or how == "inner" and _tempting(left, limit):
        right = right.hint("merge")
    return left.join(right, on, how)
