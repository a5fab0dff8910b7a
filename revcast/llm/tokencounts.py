"""Token counts of fields and sections, by offset-mapped attribution.

A document is encoded once, whole, and its tokens' spans are joined with the
spans of its parts: counts of parts encoded one by one would differ, as tokens
depend on what stands beside them. Parts are the lines of a text, or several
columns of a row that are joined by a separator (a line break by default).

The interval join looks up, for all tokens of a slice at once, the parts of a
token's first and last byte in the parts' sorted starts. A token within one
part counts for it. A token that crosses a boundary goes, as a whole, to the
part that holds most of its bytes; of equal shares, to the first of them. A
line holds the line break that ends it; a separator between fields belongs to
the field before it. So the parts' counts add up to the document's count.

There is no shuffle; the tokenizer is a public one, given by path.

Defined results: null reads as the empty text, which has one (empty) line and
no tokens; a null field is an empty one, and its separator stays; rows are
handled one by one, whole. Only the named columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import SLICE, encode_texts, load
from .text import map_texts, ranges, slices, utf8


def attribute(token_size: np.ndarray, first: np.ndarray, part_size: np.ndarray,
              part_first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token counts of all parts, and the tokens of each row that cross a
    boundary. ``first`` and ``part_first`` say where each row's tokens and
    parts begin; both sizes are in bytes, and each row's add up alike."""
    ends = np.cumsum(token_size)
    starts = ends - token_size
    part_end = np.cumsum(part_size)
    part_start = part_end - part_size
    # Parts without bytes hold no token: the last part that begins at or before a byte is not empty.
    a = np.searchsorted(part_end, starts, side="right")
    b = np.searchsorted(part_end, ends - 1, side="right")
    home = a.copy()
    cross = np.flatnonzero(a != b)
    if len(cross):
        n = b[cross] - a[cross] + 1
        token = np.repeat(cross, n)
        part = ranges(a[cross], n)
        held = np.minimum(part_end[part], ends[token]) - np.maximum(part_start[part], starts[token])
        edge = np.cumsum(n) - n
        most = np.repeat(np.maximum.reduceat(held, edge), n)
        best = np.flatnonzero(held == most)
        _, where = np.unique(token[best], return_index=True)  # the first of equal shares
        home[cross] = part[best[where]]
    counts = np.bincount(home, minlength=len(part_size)) if len(home) else np.zeros(len(part_size), np.int64)
    row = np.searchsorted(first, cross, side="right") - 1
    return counts, np.bincount(row, minlength=len(first) - 1)


def line_sizes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all lines, and where each row's begin. A text has one line
    more than it has line breaks, so the last may be empty."""
    breaks = np.flatnonzero(data == 0x0A) + 1
    row_end = offsets[1:]
    ends = np.sort(np.concatenate([breaks, row_end]), kind="stable")
    n = np.diff(np.searchsorted(breaks - 1, offsets)) + 1
    part_first = np.concatenate([[0], np.cumsum(n)])
    return np.diff(np.concatenate([[0], ends])), part_first


def _counted(texts: pa.Array, part_size: np.ndarray, part_first: np.ndarray,
             tokenizer: str | None) -> dict[str, object]:
    v = load(tokenizer)
    ids, first = encode_texts(v, texts)
    counts, cross = attribute(np.asarray(v.sizes, np.int64)[ids], first, part_size, part_first)
    return {"n_tokens": np.diff(first), "n_crossing": cross,
            "counts": pa.ListArray.from_arrays(pa.array(part_first, pa.int32()), pa.array(counts.astype(np.int64)))}


_OUT = [T.StructField("n_tokens", T.LongType()), T.StructField("n_crossing", T.LongType()),
        T.StructField("counts", T.ArrayType(T.LongType()))]


def line_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str | None = None) -> DataFrame:
    """One row per document: key, ``n_tokens``, ``n_crossing`` and ``counts``
    (tokens of each line, in order)."""
    def work(texts: pa.Array) -> dict[str, object]:
        return _counted(texts, *line_sizes(*utf8(texts)), tokenizer)

    return map_texts(docs, key, text, _OUT, work, SLICE)


def field_counts(rows: DataFrame, key: str, fields: list[str], separator: str = "\n",
                 tokenizer: str | None = None) -> DataFrame:
    """One row per row: key, ``n_tokens``, ``n_crossing`` and ``counts``
    (tokens of each field, in order) of the fields joined by ``separator``."""
    kind = rows.schema[key].dataType
    schema = T.StructType([T.StructField(key, kind), *_OUT])
    chosen = rows.select(F.col(key), F.array(*[F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields]))

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in batches:
            parts = [[f + separator for f in x[:-1]] + x[-1:] for x in batch.column(1).to_pylist()]
            texts = pa.array(["".join(x) for x in parts], pa.large_string())
            _, offsets = utf8(texts)
            for i, j in slices(offsets, SLICE):
                sizes = np.array([len(f.encode()) for x in parts[i:j] for f in x], np.int64)
                made = _counted(texts.slice(i, j - i), sizes, np.arange(j - i + 1) * len(fields), tokenizer)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), *(pa.array(made[f.name]).cast(arrow.field(f.name).type)
                                                        for f in _OUT)], names=[key, *(f.name for f in _OUT)])

    return chosen.mapInArrow(run, schema)


def digest(counts: Column) -> Column:
    """Lowercase hex SHA-256 of the counts, comma-joined."""
    return F.sha2(F.array_join(F.transform(counts, lambda c: c.cast("string")), ","), 256)


def line_report(docs: DataFrame, key: str = "doc_id", **how) -> DataFrame:
    """Per document: key, ``n_tokens``, ``n_lines``, ``n_crossing``, the first
    and the largest line's count, and a digest of all counts."""
    found = line_counts(docs, key, **how)
    return found.select(key, "n_tokens", F.size("counts").cast("long").alias("n_lines"), "n_crossing",
                        F.element_at("counts", 1).alias("first_line_tokens"),
                        F.array_max("counts").alias("max_line_tokens"), digest(F.col("counts")).alias("counts_sha256"))
