"""Quality grades by ordinal cumulative-link regression on hashed text.

A rating's grade is ordered: 0 (poor and toxic), 1 (poor or toxic), 2 (neither).
One weight for each hashed feature is shared by all grades; ordered thresholds
``t_1 < t_2`` turn the score ``f`` into ``P(grade <= k) = 1 / (1 + exp(f -
t_k+1))``. That gives an expected grade, and the tail probability of the top
grade, by which documents are selected.

Features that tell nothing of the grade (see ``LEAST_Z``) get no weight.
Features of a text: its distinct words, and its distinct runs of other bytes
between words (punctuation, table marks, symbols), both hashed, with weight
``1 / sqrt(number of distinct ones)``, and the same words once more without
that weight, for marks that a single word leaves in a long text.

Learning takes ``SAMPLE_RATINGS`` ratings at most on average, by a hash of the
key (the bound is a parameter); their hashed features are what reaches the
driver. A fifth is held out, and the selection threshold is the largest that
keeps ``RECALL`` of the held-out texts of top grade. Scoring reads all
documents whole, without a shuffle.

Defined results: null or empty text has no features and the score of none;
ratings with a null in key, quality or toxic are left out, repeated ones count
each; without any ratings all documents get grade probabilities of equal
thresholds and are kept; repeated rows give repeated results. Only the named
columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import LOWER, WORD, map_texts, slices, span_hashes, utf8, word_spans

GRADES = 3
WORD_BITS, MARK_BITS = 17, 12
WIDTH = (1 << WORD_BITS) + (1 << MARK_BITS)
SAMPLE_RATINGS = 8_000
RECALL = 0.99
LEAST_TEXTS, LEAST_Z = 5, 4.0
EPOCHS, BATCH, RATE, DECAY = 20, 32, 0.3, 1e-4


def text_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct feature numbers of all texts, flat, and where each text's begin."""
    data, offsets = utf8(texts)
    low = LOWER[data]
    codes = []
    for kind, (table, shift, base) in enumerate(((WORD, WORD_BITS, 0), (~WORD, MARK_BITS, 1 << WORD_BITS))):
        starts, ends, first = word_spans(low, offsets, table)
        number = (span_hashes(low, starts, ends) >> np.uint64(64 - shift)).astype(np.int64) + base
        row = np.repeat(np.arange(len(texts)), np.diff(first))
        codes.append(row << (WORD_BITS + 2) | number)
    both = np.unique(np.concatenate(codes))
    return both & ((1 << (WORD_BITS + 2)) - 1), np.searchsorted(both >> (WORD_BITS + 2), np.arange(len(texts) + 1))


@dataclass
class Grader:
    shared: np.ndarray  # weights of features, scaled by the text's size
    marks: np.ndarray  # weights of features as they are
    limits: np.ndarray  # ordered thresholds
    cut: float = 0.0  # least tail probability of a kept document

    def score(self, number: np.ndarray, first: np.ndarray) -> np.ndarray:
        size = np.diff(first)
        a = np.concatenate([[0], np.cumsum(self.shared[number], dtype=np.float64)])
        b = np.concatenate([[0], np.cumsum(self.marks[number], dtype=np.float64)])
        scale = 1 / np.sqrt(np.maximum(size, 1))
        return (a[first[1:]] - a[first[:-1]]) * scale + (b[first[1:]] - b[first[:-1]])

    def tails(self, f: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ..., by column."""
        return 1 / (1 + np.exp(np.clip(self.limits[None, :] - f[:, None], -60, 60)))


def _telling(number: np.ndarray, size: np.ndarray, grade: np.ndarray) -> np.ndarray:
    """Features whose texts' mean grade differs from that of all texts by
    ``LEAST_Z`` standard errors; others would be learned by heart."""
    texts = np.bincount(number, minlength=WIDTH)
    mean = np.bincount(number, np.repeat(grade, size), WIDTH) / np.maximum(texts, 1)
    z = (mean - grade.mean()) * np.sqrt(texts) / max(grade.std(), 1e-6) if len(grade) else np.zeros(WIDTH)
    return (texts >= LEAST_TEXTS) & (np.abs(z) >= LEAST_Z)


def train(number: np.ndarray, first: np.ndarray, grade: np.ndarray, seed: int = 5) -> Grader:
    """Adaptive-gradient ascent of the cumulative-link likelihood."""
    rng = np.random.default_rng(seed)
    top = GRADES - 1
    share = np.array([(grade >= k).mean() if len(grade) else 0.5 for k in range(1, GRADES)])
    share = np.clip(share, 0.01, 0.99)
    share = np.minimum.accumulate(share - np.arange(top) * 1e-3)
    raw = np.log(1 / share - 1)  # the first threshold, then the logs of the steps
    steps = np.concatenate([raw[:1], np.log(np.maximum(np.diff(raw), 1e-3))])
    g = Grader(np.zeros(WIDTH), np.zeros(WIDTH), raw)
    seen_s, seen_m, seen_t = np.full(WIDTH, 1e-8), np.full(WIDTH, 1e-8), np.full(top, 1e-8)
    size = np.diff(first)
    often = _telling(number, size, grade)
    for _ in range(EPOCHS if len(grade) else 0):
        order = rng.permutation(len(grade))
        for rows in np.array_split(order, max(1, len(order) // BATCH)):
            own = np.concatenate([number[first[r]:first[r + 1]] for r in rows])
            edge = np.concatenate([[0], np.cumsum(size[rows])])
            f, y = g.score(own, edge), grade[rows]
            # P(y) = upper - lower, where upper = P(grade <= y) and lower = P(grade <= y - 1).
            below = 1 - np.concatenate([np.ones((len(rows), 1)), g.tails(f), np.zeros((len(rows), 1))], axis=1)
            upper, lower = below[np.arange(len(rows)), y + 1], below[np.arange(len(rows)), y]
            p = np.maximum(upper - lower, 1e-9)
            du, dl = upper * (1 - upper) / p, lower * (1 - lower) / p
            df = (du - dl) / len(rows)  # of the loss by the score
            dt = np.zeros(top)
            np.add.at(dt, y[y < top], -du[y < top] / len(rows))
            np.add.at(dt, y[y > 0] - 1, dl[y > 0] / len(rows))
            grad = np.repeat(df, size[rows])
            scale = np.repeat(1 / np.sqrt(np.maximum(size[rows], 1)), size[rows])
            where, back = np.unique(own[often[own]], return_inverse=True)
            grad, scale = grad[often[own]], scale[often[own]]
            for weights, seen, d in ((g.shared, seen_s, np.bincount(back, grad * scale, len(where))),
                                     (g.marks, seen_m, np.bincount(back, grad, len(where)))):
                d = d + DECAY * weights[where]
                seen[where] += d * d
                weights[where] -= RATE * d / np.sqrt(seen[where])
            ds = np.array([dt.sum(), *(dt[k:].sum() * np.exp(steps[k]) for k in range(1, top))])
            seen_t += ds * ds
            steps -= RATE * ds / np.sqrt(seen_t)
            g.limits = np.cumsum(np.concatenate([steps[:1], np.exp(steps[1:])]))
    return g


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", quality: str = "quality",
        toxic: str = "toxic", sample: int = SAMPLE_RATINGS) -> Grader:
    """Learn from a bounded sample of the ratings."""
    rated = labels.select(F.col(key).alias("k"), F.col(quality).cast("int").alias("q"),
                          F.col(toxic).cast("int").alias("x")).where("k is not null and q is not null and x is not null")
    total = rated.count()
    if total > sample:
        rated = rated.where(F.pmod(F.xxhash64("k", F.lit("rating")), F.lit(1 << 31)) < int(sample / total * (1 << 31)))
    # Bounded by the sample, whatever the tables' sizes.
    joined = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).join(F.broadcast(rated), "k")
    joined = joined.select("k", "t", (F.col("q") + 1 - F.col("x")).cast("int").alias("grade"))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, offsets = utf8(batch.column("t"))
            for i, j in slices(offsets):
                number, first = text_features(batch.column("t").slice(i, j - i))
                lists = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(number.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column("k").slice(i, j - i).cast(pa.int64()),
                                                  batch.column("grade").slice(i, j - i), lists],
                                                 names=["k", "grade", "number"])

    rows = joined.mapInArrow(look, "k long, grade int, number array<int>").toArrow().sort_by(
        [("k", "ascending"), ("grade", "ascending")])
    grade = np.clip(rows.column("grade").to_numpy().astype(np.int64), 0, GRADES - 1)
    lists = rows.column("number").combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    size = pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64) if len(grade) else []
    first = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    number = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64) if len(grade) else np.zeros(0, np.int64)
    held = np.arange(len(grade)) % 5 == 0

    def part(rows_of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        chosen = [number[first[r]:first[r + 1]] for r in rows_of]
        return (np.concatenate(chosen) if chosen else np.zeros(0, np.int64),
                np.concatenate([[0], np.cumsum([len(c) for c in chosen])]).astype(np.int64), grade[rows_of])

    grader = train(*part(np.flatnonzero(~held)))
    n, f, y = part(np.flatnonzero(held))
    good = np.sort(grader.tails(grader.score(n, f))[y == GRADES - 1, -1])
    if len(good):
        grader.cut = min(0.5, float(good[int((1 - RECALL) * len(good))]))
    return grader


def grade_documents(docs: DataFrame, labels: DataFrame | None = None, grader: Grader | None = None,
                    key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, ``expected_grade``, ``top_probability`` and
    ``kept`` (whether that reaches the selection threshold)."""
    shared = docs.sparkSession.sparkContext.broadcast(grader or fit(docs, labels, key, text))

    def work(texts: pa.Array) -> dict[str, object]:
        g = shared.value
        tails = g.tails(g.score(*text_features(texts)))
        return {"expected_grade": tails.sum(axis=1), "top_probability": tails[:, -1], "kept": tails[:, -1] >= g.cut}

    return map_texts(docs, key, text, [
        T.StructField("expected_grade", T.DoubleType()), T.StructField("top_probability", T.DoubleType()),
        T.StructField("kept", T.BooleanType())], work)
