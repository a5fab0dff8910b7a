"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Test items are cut into windows of ``WINDOW`` consecutive words (an item of
fewer words is one window), and documents are searched for all windows at
once. Windows of one length form a search table after Wu and Manber:

* a block is the last ``BLOCK`` words at the search cursor; a shift table,
  indexed by a hash of the block, says how far the cursor may move without
  passing the end of any window;
* where the shift is zero, the windows with that suffix hash and prefix hash
  are looked up in sorted arrays;
* a hit is confirmed by direct comparison, word by word, of the bytes.

The cursors of many document segments move in step, as numpy arrays, so a
document costs about a ninth of its words in cursor moves. The search table
is broadcast; test sets over ``BLOCK_WORDS`` words are searched in blocks of
that size, one pass over the documents' rows each, without a shuffle.

Defined results: null or empty text has no words and no hits; an item without
words has no window; items with equal windows are all counted; rows are
handled one by one, so repeated documents (or ids) give repeated rows; a
repeated item id counts once, and repeated items are read once; a null item id
stands as an empty one. Empty tables give no rows (documents) or no hits
(benchmark). Only the named columns are read.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import LOWER, map_columns, mix, ranges, slices, span_hashes, utf8, word_spans

WINDOW = 10
BLOCK = 2
SEGMENT = 512
BLOCK_WORDS = 500_000
MAX_CHAINED = 4


@dataclass
class Table:
    """Search table for windows of one length."""

    length: int
    shift: np.ndarray  # by hash of a block of words
    keys: np.ndarray  # sorted: suffix and prefix hash of each window
    windows: np.ndarray  # word numbers of each window, in key order
    first_item: np.ndarray  # window -> range in items
    items: np.ndarray


@dataclass
class Index:
    """Windows of a block of items, by length, and the words they use."""

    tables: list[Table]
    word_hash: np.ndarray  # sorted
    word_start: np.ndarray
    word_end: np.ndarray
    word_bytes: np.ndarray
    item_names: list[str]


def _block_hash(h: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    out = h[ends]
    for k in range(1, size):
        out = mix(out * np.uint64(0x9DDFEA08EB382D69) + h[ends - k])
    return out


def build_index(items: list[tuple[object, str | None]], window: int = WINDOW) -> Index:
    """The search tables of some items: ``(item_id, text)`` pairs."""
    names = sorted({str(i) for i, _ in items})
    number = {n: k for k, n in enumerate(names)}
    data, offsets = utf8(pa.array([t for _, t in items], pa.large_string()))
    low = LOWER[data]
    starts, ends, first = word_spans(low, offsets)
    h = span_hashes(low, starts, ends)
    word_hash, at, word_of = np.unique(h, return_index=True, return_inverse=True)
    found: dict[int, dict[tuple[int, ...], set[int]]] = defaultdict(lambda: defaultdict(set))
    for row, (item, _) in enumerate(items):
        words = word_of[first[row]:first[row + 1]].tolist()
        if words:
            m = min(window, len(words))
            for k in range(len(words) - m + 1):
                found[m][tuple(words[k:k + m])].add(number[str(item)])
    tables = []
    for m, windows in sorted(found.items()):
        ids = np.array(list(windows), np.int64).reshape(len(windows), m)
        hashes = word_hash[ids]
        size = min(BLOCK, m)
        bits = max(12, int(len(ids) * m * 4).bit_length())
        shift = np.full(1 << min(bits, 22), m - size + 1, np.int16)
        flat = hashes.reshape(-1)
        for e in range(size - 1, m):  # later positions allow smaller shifts
            block = _block_hash(flat, np.arange(len(ids)) * m + e, size)
            np.minimum.at(shift, (block & np.uint64(len(shift) - 1)).astype(np.int64), m - 1 - e)
        last = np.arange(len(ids)) * m + m - 1
        key = mix(_block_hash(flat, last, size) + np.uint64(3) * _block_hash(flat, last - (m - size), size))
        order = np.argsort(key, kind="stable")
        lists = [sorted(v) for v in windows.values()]
        tables.append(Table(m, shift, key[order], ids[order],
                            np.concatenate([[0], np.cumsum([len(lists[k]) for k in order])]),
                            np.array([i for k in order for i in lists[k]], np.int64)))
    return Index(tables, word_hash, starts[at], ends[at], low, names)


def _scan(table: Table, h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Word positions at which a window of the table may end."""
    m, size, mask = table.length, min(BLOCK, table.length), np.uint64(len(table.shift) - 1)
    counts = np.maximum(np.diff(first) - m + 1, 0)  # windows that each row has
    pieces = -(-counts // SEGMENT)
    start = ranges(np.zeros(len(pieces), np.int64), pieces) * SEGMENT
    row = np.repeat(np.arange(len(counts)), pieces)
    cursor = first[row] + start + m - 1
    stop = np.minimum(cursor + SEGMENT, first[row] + counts[row] + m - 1)
    hits = []
    while len(cursor):
        move = table.shift[(_block_hash(h, cursor, size) & mask).astype(np.int64)]
        hits.append(cursor[move == 0])
        cursor = cursor + np.maximum(move, 1)
        alive = cursor < stop
        cursor, stop = cursor[alive], stop[alive]
    return np.concatenate(hits) if hits else np.zeros(0, np.int64)


def _occurrences(index: Index, table: Table, h, low, starts, ends, first) -> tuple[np.ndarray, np.ndarray]:
    """End positions and window numbers of the confirmed occurrences."""
    m, size = table.length, min(BLOCK, table.length)
    at = _scan(table, h, first)
    key = mix(_block_hash(h, at, size) + np.uint64(3) * _block_hash(h, at - (m - size), size))
    lo, hi = np.searchsorted(table.keys, key), np.searchsorted(table.keys, key, side="right")
    window, at = ranges(lo, hi - lo), np.repeat(at, hi - lo)
    spot = at[:, None] - np.arange(m - 1, -1, -1)
    same = (index.word_hash[table.windows[window]] == h[spot]).all(axis=1)
    window, at, spot = window[same], at[same], spot[same]
    # Direct comparison: every document word of a hit against the window's word.
    spots, which = np.unique(spot.reshape(-1), return_index=True)
    word = table.windows[window].reshape(-1)[which]
    size_doc, size_word = ends[spots] - starts[spots], index.word_end[word] - index.word_start[word]
    good = size_doc == size_word
    both = np.minimum(size_doc, size_word)
    equal = low[ranges(starts[spots], both)] == index.word_bytes[ranges(index.word_start[word], both)]
    cut = np.concatenate([[0], np.cumsum(both)])[:-1]
    if len(cut):
        good &= np.logical_and.reduceat(equal, cut)
    wrong = spots[~good]
    if len(wrong):  # a word hash that two words share
        fine = ~np.isin(spot, wrong).any(axis=1)
        window, at = window[fine], at[fine]
    return at, window


def search(index: Index, texts: pa.Array) -> list[tuple[int, list[tuple[int, int]], list[str]]]:
    """For each text: its number of words, the merged word ranges that
    occurrences cover, and the items that occur."""
    data, offsets = utf8(texts)
    low = LOWER[data]
    starts, ends, first = word_spans(low, offsets)
    h = span_hashes(low, starts, ends)
    n = len(starts)
    cover = np.zeros(n + 1, np.int64)
    row_of = np.repeat(np.arange(len(texts)), np.diff(first))
    pairs = []
    for table in index.tables:
        at, window = _occurrences(index, table, h, low, starts, ends, first)
        np.add.at(cover, at - table.length + 1, 1)
        np.add.at(cover, at + 1, -1)
        size = table.first_item[window + 1] - table.first_item[window]
        items = table.items[ranges(table.first_item[window], size)]
        pairs.append(np.stack([np.repeat(row_of[at], size), items], axis=1))
    hit = np.cumsum(cover[:-1]) > 0
    found: dict[int, list[str]] = defaultdict(list)
    if pairs:
        for row, item in np.unique(np.concatenate(pairs), axis=0).tolist():
            found[row].append(index.item_names[item])
    out = []
    for row in range(len(texts)):
        spans: list[tuple[int, int]] = []
        if row in found:
            mark = np.diff(np.concatenate([[0], hit[first[row]:first[row + 1]].astype(np.int8), [0]]))
            spans = list(zip(np.flatnonzero(mark == 1).tolist(), np.flatnonzero(mark == -1).tolist(), strict=True))
        out.append((int(first[row + 1] - first[row]), spans, found.get(row, [])))
    return out


def _merge(a: list[tuple[int, int]], b: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(a + b):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], e))
        else:
            out.append((s, e))
    return out


HITS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def item_blocks(benchmark: DataFrame, item: str, text: str, block_words: int) -> list[list[tuple]]:
    """The items in blocks of about ``block_words`` words, each read on its
    own: what is broadcast at once is bounded whatever the test set's size."""
    bench = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("i"), F.col(text).alias("t")).where(
        F.col("t").isNotNull()).distinct()
    chars = bench.agg(F.sum(F.length("t"))).first()[0] or 0
    n = max(1, -(-int(chars) // (6 * block_words)))
    for b in range(n):
        part = bench if n == 1 else bench.where(F.pmod(F.xxhash64("t", "i"), F.lit(n)) == b)
        yield [(r["i"], r["t"]) for r in part.toLocalIterator()]


def find_contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
                       item: str = "item_id", item_text: str = "text", window: int = WINDOW,
                       block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document: key, ``n_words``, ``hits`` (word ranges covered
    by occurring windows) and ``items`` (ids with occurring windows, sorted as
    strings)."""
    sc = docs.sparkSession.sparkContext
    kind = docs.schema[key].dataType
    # Fixed names inside, so that no column of the caller's can clash.
    now = docs.select(F.col(key).alias("k"), F.col(text).alias("t"), F.lit(0).cast("long").alias("n_words"),
                      F.array().cast(HITS).alias("hits"), F.array().cast("array<string>").alias("items"))
    schema = T.StructType([T.StructField("k", kind), T.StructField("t", T.StringType()),
                           T.StructField("n_words", T.LongType()), T.StructField("hits", HITS),
                           T.StructField("items", T.ArrayType(T.StringType()))])
    for number, items in enumerate(item_blocks(benchmark, item, item_text, block_words)):
        if number and number % MAX_CHAINED == 0:  # bound the chain of Python workers in a task
            now = now.checkpoint()
        shared = sc.broadcast(build_index(items, window))
        now = now.mapInArrow(_search_batches(shared), schema)
    return now.select(F.col("k").alias(key), "n_words", "hits", "items")


def _search_batches(shared):
    from pyspark.sql.pandas.types import to_arrow_type

    hits_type = to_arrow_type(HITS)

    def run(batches):
        index = shared.value
        for batch in batches:
            keys, texts, hits0, items0 = (batch.column(n) for n in ("k", "t", "hits", "items"))
            lengths = pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_numpy(zero_copy_only=False)
            for i, j in slices(np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])):
                part = texts.slice(i, j - i)
                found = search(index, part)
                old = [[(h["start"], h["end"]) for h in x] for x in hits0.slice(i, j - i).to_pylist()]
                names = items0.slice(i, j - i).to_pylist()
                yield pa.RecordBatch.from_arrays([
                    keys.slice(i, j - i), part, pa.array([n for n, _, _ in found], pa.int64()),
                    pa.array([[{"start": s, "end": e} for s, e in _merge(o, h)]
                              for o, (_, h, _) in zip(old, found, strict=True)], hits_type),
                    pa.array([sorted({*o, *x}) for o, (_, _, x) in zip(names, found, strict=True)],
                             pa.list_(pa.string()))], names=["k", "t", "n_words", "hits", "items"])

    return run


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id",
                      item_text: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents without an occurrence, all their columns unchanged."""
    at = docs.columns.index(text)
    now = docs
    for number, items in enumerate(item_blocks(benchmark, item, item_text, block_words)):
        if number and number % MAX_CHAINED == 0:
            now = now.checkpoint()
        now = map_columns(now, _keep_clean(docs.sparkSession.sparkContext.broadcast(build_index(items, window)), at),
                          docs.schema.fields)
    return now


def _keep_clean(shared, at: int):
    def run(batches):
        for batch in batches:
            _, offsets = utf8(batch.column(at))
            for i, j in slices(offsets):
                part = batch.slice(i, j - i)
                found = search(shared.value, part.column(at))
                yield part.filter(pa.array([not names for _, _, names in found], pa.bool_()))

    return run


def items_digest(items: F.Column) -> F.Column:
    """Lowercase hex SHA-256 of the ids, comma-joined."""
    return F.sha2(F.array_join(items, ","), 256)


def contamination_report(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """Per document: key, ``n_words``, ``n_hit``, ``n_items``,
    ``items_sha256``, ``contaminated`` and the operator's ``hits``."""
    key = how.get("key", "doc_id")
    found = find_contamination(docs, benchmark, **how)
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda a, h: a + h["end"] - h["start"])
    return found.select(key, "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        items_digest(F.col("items")).alias("items_sha256"), (n_hit > 0).alias("contaminated"))
