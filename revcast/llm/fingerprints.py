"""Document fingerprints from closed syncmers, and their likeness.

A k-mer (of ``K`` bytes) is a closed syncmer if the least of its ``S``-byte
substrings, by a hash, is its first or its last one. Whether a k-mer is chosen
depends on nothing around it, so equal passages have equal anchors wherever
they stand. A fingerprint holds the anchors whose hash is under a fixed limit
(one in 16, whatever the text's length) and the ``SIZE`` least ones at least, each with
its first place. Likeness compares two fingerprints as far as both have all anchors
of their texts: the share of the united ones that both have and that lie in the
same order in both texts (the longest increasing chain of places).

The query compares each document with its edited text and with its neighbour
in descending id order. The rows are dealt once, by ranges of ids, and sorted
within a range; the head of each range (its greatest id) is also sent to the
range before, as there is no window over all rows. Ranges come from quantiles
of the ids; a range's rows are streamed, so a task holds two documents.

Defined results: null reads as an empty text, which has an empty fingerprint;
two empty fingerprints have likeness 1, one empty 0; a text shorter than ``K``
bytes is one anchor. Rows with equal ids are ordered by their texts; a null id
comes last. A single row is its own neighbour. Only key and text are read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import SLICE_BYTES, map_texts, utf8

K = 12
S = 4
# A sketch has a fixed share of the anchors, so it grows with the text, and at least SIZE.
SIZE = 32
LIMIT = (1 << 32) // 16
ROWS_PER_RANGE = 4_000


def _s_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The S-byte substrings at each place as numbers, and their hashes."""
    v = data[:-3].astype(np.uint32)
    for i in range(1, S):
        v = v | (data[i:len(data) - 3 + i].astype(np.uint32) << np.uint32(8 * i))
    h = v * np.uint32(0x9E3779B1)
    h ^= h >> np.uint32(15)
    return v, h * np.uint32(0x85EBCA77)


def syncmers(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and 32-bit hashes of the closed syncmers of some bytes."""
    if len(data) < K:
        return np.zeros(0, np.int64), np.zeros(0, np.uint32)
    v, h = _s_hashes(data)
    w = K - S + 1  # substrings of a k-mer
    least, width = h, 1
    while width < w:  # minimum over w places, by doubling
        grow = min(width, w - width)
        least = np.minimum(least[:-grow], least[grow:])
        width += grow
    n = len(data) - K + 1
    at = np.flatnonzero((h[:n] == least[:n]) | (h[w - 1:w - 1 + n] == least[:n]))
    x = v[at].astype(np.uint64) | (v[at + 4].astype(np.uint64) << np.uint64(32))
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + v[at + 8]
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return at, (x >> np.uint64(32)).astype(np.uint32)


Sketch = tuple[list[int], list[int]]  # hashes, ascending, and their first places


def _least(at: np.ndarray, h: np.ndarray) -> Sketch:
    """All distinct hashes up to LIMIT, the SIZE least ones at least, and their first places."""
    if len(h) > 8 * SIZE:  # most of a long text's anchors are out of question
        few = h <= max(LIMIT, 4 * SIZE * (1 << 32) // len(h))
        if len(np.unique(h[few])) >= SIZE:
            at, h = at[few], h[few]
    values, where = np.unique(h, return_index=True)
    size = max(SIZE, int(np.searchsorted(values, LIMIT, side="right")))
    return values[:size].tolist(), at[where[:size]].tolist()


def _reach(hashes: list[int]) -> int:
    """Up to which hash a sketch has all anchors of its text."""
    return (1 << 32) - 1 if len(hashes) < SIZE else max(LIMIT, hashes[SIZE - 1])


def sketches(data: np.ndarray, offsets: np.ndarray) -> list[Sketch]:
    """The sketch of each text in a flat byte array."""
    at, h = syncmers(data)
    out: list[Sketch] = []
    lo = np.searchsorted(at, offsets[:-1])
    hi = np.searchsorted(at, offsets[1:] - K, side="right")
    for a, b, start, end in zip(lo.tolist(), hi.tolist(), offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        if end - start >= K:
            out.append(_least(at[a:b] - start, h[a:b]))
        elif end > start:
            out.append(([int.from_bytes(hashlib.sha256(data[start:end].tobytes()).digest()[:4], "big")], [0]))
        else:
            out.append(([], []))
    return out


def sketch(text: str) -> Sketch:
    data = np.frombuffer(text.encode(), np.uint8)
    return sketches(data, np.array([0, len(data)]))[0]


def as_string(s: Sketch) -> str:
    return ",".join([f"{h:08x}@{p:x}" for h, p in zip(*s, strict=True)])


def likeness(a: Sketch, b: Sketch) -> float:
    """Share of the united anchors, as far as both sketches have all of them, that stand
    in both in the same order."""
    if a == b:
        return 1.0
    if not a[0] or not b[0]:
        return 0.0
    in_a, in_b = dict(zip(*a, strict=True)), dict(zip(*b, strict=True))
    limit = min(_reach(a[0]), _reach(b[0]))
    union = [h for h in in_a.keys() | in_b.keys() if h <= limit]
    chain: list[int] = []
    for _, p in sorted((in_a[h], -in_b[h]) for h in union if h in in_a and h in in_b):
        k = bisect_left(chain, -p)
        chain[k:k + 1] = [-p]
    return len(chain) / len(union) if union else 0.0


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key and ``fingerprint``, without a shuffle."""
    def work(texts: pa.Array) -> dict[str, object]:
        return {"fingerprint": [as_string(s) for s in sketches(*utf8(texts))]}

    return map_texts(docs, key, text, [T.StructField("fingerprint", T.StringType())], work)


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by the start of the next one."""
    n = len(text) // 3
    return text[:len(text) - n] + following[:n]


def _ranges(docs: DataFrame, key: str) -> tuple[list, dict]:
    """Boundaries of the id ranges, descending order's first range last in
    the list's order (ascending), and each range's greatest id."""
    ids = docs.select(F.col(key).alias("k"))
    n = ids.count()
    parts = max(1, -(-n // ROWS_PER_RANGE))
    at = ids.where(F.col("k").isNotNull()).approxQuantile("k", [i / parts for i in range(1, parts)], 0.25 / parts) \
        if parts > 1 else []
    bounds = sorted({int(x) for x in at})
    rank = _range_of(bounds)
    heads = {r["r"]: r["m"] for r in ids.groupBy(rank("k").alias("r")).agg(F.max("k").alias("m")).collect()}
    return bounds, heads


def _range_of(bounds: list[int]):
    """Range number of an id: 0 holds the greatest ids; null comes last."""
    limits = np.array(bounds, np.int64)

    @F.pandas_udf(T.IntegerType())
    def rank(k):  # pandas is the transport only
        known = k.notna().to_numpy()
        out = np.full(len(k), len(limits) + 1, np.int32)
        out[known] = len(limits) - np.searchsorted(limits, k[known].to_numpy().astype(np.int64), side="right")
        import pandas as pd

        return pd.Series(out)

    return rank


def compare_with_neighbours(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: key, ``n_chars``, ``edited_sha256``, ``fingerprint``,
    ``edited_fingerprint``, ``near_edited`` and ``near_next``."""
    kind = docs.schema[key].dataType
    rows = docs.select(F.col(key).cast("long").alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    bounds, heads = _ranges(rows, "k")
    # The range before each one: its documents need the head of the next.
    filled = sorted(heads)
    before = {r: filled[i - 1] for i, r in enumerate(filled)}  # the first one's head goes to the last
    head_of = {heads[r]: before[r] for r in filled if heads[r] is not None}
    null_before = before[filled[-1]] if filled and heads[filled[-1]] is None else None

    @F.pandas_udf("array<int>")
    def dealt(r, k):
        import pandas as pd

        ids = k.astype("Int64")
        return pd.Series([[a] if (to := null_before if b is pd.NA else head_of.get(b)) is None else [a, to]
                          for a, b in zip(r.tolist(), ids.tolist(), strict=True)])

    placed = rows.withColumn("r", _range_of(bounds)("k")).withColumn("to", dealt("r", "k"))
    placed = placed.select("k", "t", F.posexplode("to").alias("extra", "range"))
    # Each range is a partition of its own: hashes of range numbers would put some together.
    n = max(filled, default=0) + 1
    sorted_rows = placed.repartitionById(n, F.col("range").cast("int")).sortWithinPartitions("range", "extra", F.desc_nulls_last("k"), "t")
    schema = T.StructType([
        T.StructField(key, kind), T.StructField("n_chars", T.LongType()), T.StructField("edited_sha256", T.StringType()),
        T.StructField("fingerprint", T.StringType()), T.StructField("edited_fingerprint", T.StringType()),
        T.StructField("near_edited", T.DoubleType()), T.StructField("near_next", T.DoubleType())])
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by range, its own rows first, then the next range's head."""
        held: list[tuple] = []  # id and text of rows that wait for the next one
        size, where, closed = 0, None, False

        def flush() -> Iterator[pa.RecordBatch]:
            if len(held) > 1:
                yield _compared(held, arrow)

        for part in (b.slice(i, 256) for b in batches for i in range(0, b.num_rows, 256)):
            for k, t, extra, r in zip(*(part.column(n).to_pylist() for n in ("k", "t", "extra", "range")), strict=True):
                if r != where:
                    yield from flush()
                    held, size, where, closed = [], 0, r, False
                if closed:
                    continue
                closed = extra == 1  # more rows with the head's id are not needed
                held.append((k, t))
                size += len(t)
                if size >= SLICE_BYTES // 2 or closed:
                    yield from flush()
                    held, size = held[-1:], len(t)
        yield from flush()

    return sorted_rows.mapInArrow(compare, schema)


def _compared(held: list[tuple], arrow: pa.Schema) -> pa.RecordBatch:
    """Results of all rows but the last, which is the last one's neighbour."""
    texts = [t for _, t in held]
    changed = [edited(a, b) for a, b in zip(texts, texts[1:], strict=False)]
    own = sketches(*utf8(pa.array(texts, pa.large_string())))
    new = sketches(*utf8(pa.array(changed, pa.large_string())))
    n = len(changed)
    return pa.RecordBatch.from_arrays([
        pa.array([k for k, _ in held[:-1]], pa.int64()).cast(arrow.field(0).type),
        pa.array([len(t) for t in texts[:-1]], pa.int64()),
        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed]),
        pa.array([as_string(s) for s in own[:-1]]), pa.array([as_string(s) for s in new]),
        pa.array([likeness(own[i], new[i]) for i in range(n)], pa.float64()),
        pa.array([likeness(own[i], own[i + 1]) for i in range(n)], pa.float64())], names=arrow.names)
