"""Language identification by prediction by partial matching (PPM).

Each language has a variable-order context tree over bytes, up to ``ORDER``
bytes of context. With frozen counts, a byte seen ``n`` times in a context of
``total`` bytes and ``kinds`` different ones costs ``log2((total + kinds)/n)``
bits; an unseen one costs the escape ``log2((total + kinds)/kinds)`` and is
coded in the next shorter context; a context never seen costs nothing; below
order 0 all 256 bytes are alike. A text's language is the one with the
shortest code; the score is its posterior probability under equal priors.

Bytes are folded first: ASCII letters to lower case, runs of other ASCII bytes
to one blank; all bytes of other characters stay.

As the counts are frozen, the code lengths of all (ORDER + 1)-grams that some
language has seen are worked out once. In a text, each byte's gram is found by
two table look-ups (pairs of bytes, then pairs of pairs); grams that no
language has seen go through the escapes, order by order, on sorted arrays.

Learning takes a bounded sample: about ``SAMPLE_DOCS`` documents of each
language, by a hash of the key (the bound is a parameter), counted in the
tasks that read them; what reaches the driver is the distinct grams of the
sample. Prediction reads every document whole, without a shuffle.

Defined results: ``und`` and score 0 where the text is null or has no letter,
or where no language could be learned; equal code lengths go to the language
that comes first by name; repeated rows give repeated results. Only the named
columns are read; language and key are no inputs of a prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import LOWER, map_columns, map_texts, slices, utf8

ORDER = 3
SAMPLE_DOCS = 2_000
UNKNOWN = "und"
_BLANK = 0x20
_FOLD = np.where((LOWER >= ord("a")) & (LOWER <= ord("z")) | (np.arange(256) >= 128), LOWER, _BLANK).astype(np.uint8)
DENSE_PAIRS = 4096  # up to so many different pairs of bytes, grams are found by a dense table


def folded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Folded bytes, with ORDER blanks before each row, and where each row's
    bytes begin and end (n x 2)."""
    n = len(offsets) - 1
    low = _FOLD[data]
    keep = np.ones(len(low), bool)
    keep[1:] = (low[1:] != _BLANK) | (low[:-1] != _BLANK)
    keep[offsets[:-1][offsets[:-1] < len(low)]] = True
    kept = np.concatenate([[0], np.cumsum(keep)])[offsets]
    sizes = np.diff(kept)
    starts = kept[:-1] + ORDER * np.arange(1, n + 1)
    out = np.full(kept[-1] + ORDER * n, _BLANK, np.uint8)
    body = np.ones(len(out), bool)
    body[(starts[:, None] - np.arange(1, ORDER + 1)).reshape(-1)] = False
    out[body] = low[keep]
    return out, np.stack([starts, starts + sizes], axis=1)


def grams(data: np.ndarray, n: int, ends: np.ndarray | slice) -> np.ndarray:
    """The n bytes up to each end (inclusive) as numbers."""
    out = np.zeros(len(data), np.uint32)
    for k in range(n):
        out[k:] |= data[:len(data) - k].astype(np.uint32) << np.uint32(8 * k)
    return out[ends]


def count_grams(data: np.ndarray, offsets: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Counts of the grams of 1 to ORDER + 1 bytes of some rows."""
    low, spans = folded(data, offsets)
    body = np.zeros(len(low) + 1, np.int64)
    np.add.at(body, spans[:, 0], 1)
    np.add.at(body, spans[:, 1], -1)
    at = np.cumsum(body[:-1]) > 0
    return {n: np.unique(grams(low, n, at), return_counts=True) for n in range(1, ORDER + 2)}


@dataclass
class Model:
    """Frozen code lengths in bits; rows are grams, columns languages."""

    languages: list[str]
    keys: list[np.ndarray]  # by gram size - 1: sorted grams that some language has seen
    bits: list[np.ndarray]  # their code lengths in their own contexts
    contexts: list[np.ndarray]  # by context size: sorted contexts
    escapes: list[np.ndarray]  # their escapes' lengths (0 where a language has not seen it)
    pair: np.ndarray | None = None  # two bytes -> number of the pair
    place: np.ndarray | None = None  # two pairs -> row of bits, or -1

    def cost(self, gram: np.ndarray, size: int) -> np.ndarray:
        """Code lengths of grams of one size, by language."""
        if not size:
            return np.full((len(gram), len(self.languages)), 8.0, np.float32)
        where = _find(self.keys[size - 1], gram)
        out = self.bits[size - 1][np.maximum(where, 0)]
        if len(miss := np.flatnonzero(where < 0)):
            out[miss] = self._escaped(gram[miss], size)
        return out

    def _escaped(self, gram: np.ndarray, size: int) -> np.ndarray:
        """Grams that no language has seen: an escape, then a shorter context."""
        where = _find(self.contexts[size - 1], gram >> np.uint32(8))
        escape = np.where(where[:, None] >= 0, self.escapes[size - 1][np.maximum(where, 0)], 0)
        shorter = gram & np.uint32((1 << 8 * (size - 1)) - 1)
        return escape + self.cost(shorter, size - 1)

    def dense(self) -> Model:
        """Add the look-up tables, if the pairs are few enough."""
        top = self.keys[ORDER]
        seen = np.unique(np.concatenate([top >> np.uint32(16), top & np.uint32(0xFFFF)]))
        if ORDER == 3 and len(seen) < DENSE_PAIRS and len(top):
            self.pair = np.zeros(1 << 16, np.int16)
            self.pair[seen] = np.arange(1, len(seen) + 1)
            self.place = np.full((len(seen) + 1) ** 2, -1, np.int32)
            code = self.pair[top >> np.uint32(16)].astype(np.int64) * (len(seen) + 1) + self.pair[top & np.uint32(0xFFFF)]
            self.place[code] = np.arange(len(top))
        return self

    def code_lengths(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bits of each row in each language, and the rows' coded bytes."""
        low, spans = folded(data, offsets)
        size = spans[:, 1] - spans[:, 0]
        out = np.zeros((len(spans), len(self.languages)))
        if not size.sum():
            return out, size
        if self.place is not None:
            two = self.pair[(low[:-1].astype(np.uint16) << np.uint16(8)) | low[1:]].astype(np.int64)
            where = np.full(len(low), -1, np.int32)
            where[3:] = self.place[two[:-2] * int(round(len(self.place) ** 0.5)) + two[2:]]
            cost = self.bits[ORDER][np.maximum(where, 0)]
            if len(miss := np.flatnonzero(where < 0)):
                cost[miss] = self._escaped(grams(low, ORDER + 1, miss), ORDER + 1)
        else:
            cost = self.cost(grams(low, ORDER + 1, slice(None)), ORDER + 1)
        some = size > 0
        for k in range(len(self.languages)):  # sums of all spans, the blanks before them left out
            edges = spans[some].reshape(-1)
            column = np.append(cost[:, k].astype(np.float64), 0)
            out[some, k] = np.add.reduceat(column, edges)[::2]
        return out, size


def _find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places of the wanted numbers in sorted keys, -1 where they are not."""
    if not len(keys):
        return np.full(len(wanted), -1, np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


def build_model(counts: dict[str, dict[int, tuple[np.ndarray, np.ndarray]]]) -> Model:
    """Code lengths from each language's counts (gram size -> grams, counts)."""
    languages = sorted(counts)
    model = Model(languages, [], [], [], [])
    for size in range(1, ORDER + 2):
        keys = np.unique(np.concatenate([counts[x][size][0] for x in languages] or [np.zeros(0, np.uint32)]))
        contexts, context_of = np.unique(keys >> np.uint32(8), return_inverse=True)
        escape = np.zeros((len(contexts), len(languages)), np.float32)
        seen = np.zeros((len(keys), len(languages)))
        for k, x in enumerate(languages):
            seen[np.searchsorted(keys, counts[x][size][0]), k] = counts[x][size][1]
            total = np.bincount(context_of, seen[:, k], len(contexts))
            kinds = np.bincount(context_of, seen[:, k] > 0, len(contexts))
            ok = kinds > 0
            escape[ok, k] = np.log2((total + kinds)[ok] / kinds[ok])
            hit = seen[:, k] > 0
            seen[hit, k] = np.log2((total + kinds)[context_of[hit]] / seen[hit, k])
            seen[~hit, k] = -1
        # A gram that this language has not seen escapes; the shorter gram's cost is known already.
        lower = model.cost(keys & np.uint32((1 << 8 * (size - 1)) - 1), size - 1)
        model.keys.append(keys)
        model.bits.append(np.where(seen >= 0, seen, escape[context_of] + lower).astype(np.float32))
        model.contexts.append(contexts)
        model.escapes.append(escape)
    return model.dense()


def held_out(key: Column) -> Column:
    """Whether a document is kept from learning."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learn(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
          sample_docs: int = SAMPLE_DOCS) -> Model:
    """The model of all languages that documents not held out name."""
    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("t"), F.col(lang).cast("string").alias("l")).where(
        ~held_out(F.col("k")) & F.col("t").isNotNull() & F.col("l").isNotNull())
    sizes = {r["l"]: r["n"] for r in rows.groupBy("l").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return build_model({})
    limits = F.create_map(*[F.lit(v) for x, n in sizes.items()
                            for v in (x, min(1 << 31, -(-sample_docs * (1 << 31) // n)))])
    sample = rows.where(F.pmod(F.xxhash64("k", "t"), F.lit(1 << 31)) < limits[F.col("l")]).select("l", "t")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in pa.compute.unique(batch.column(0)).to_pylist():
                texts = batch.column(1).filter(pa.compute.equal(batch.column(0), x))
                _, offsets = utf8(texts)
                for i, j in slices(offsets):
                    for n, (g, c) in count_grams(*utf8(texts.slice(i, j - i))).items():
                        yield pa.RecordBatch.from_arrays([
                            pa.array([x] * len(g), pa.string()), pa.array(np.full(len(g), n), pa.int32()),
                            pa.array(g.astype(np.int64)), pa.array(c.astype(np.int64))], names=["l", "n", "g", "c"])

    made = sample.mapInArrow(count, "l string, n int, g long, c long").groupBy("l", "n", "g").agg(F.sum("c").alias("c"))
    got = made.toArrow()
    langs, n, g, c = (got.column(x).combine_chunks() for x in ("l", "n", "g", "c"))
    n, g, c = n.to_numpy(), g.to_numpy().astype(np.uint32), c.to_numpy()
    counts = {}
    for x in pa.compute.unique(langs).to_pylist():
        own = pa.compute.equal(langs, x).to_numpy(zero_copy_only=False)
        counts[x] = {}
        for size in range(1, ORDER + 2):
            rows_of = np.flatnonzero(own & (n == size))
            rows_of = rows_of[np.argsort(g[rows_of])]
            counts[x][size] = (g[rows_of], c[rows_of])
    return build_model(counts)


def has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether each row has a letter of any script."""
    letter = (LOWER[data] >= ord("a")) & (LOWER[data] <= ord("z"))
    out = np.diff(np.concatenate([[0], np.cumsum(letter)])[offsets]) > 0
    wide = np.diff(np.concatenate([[0], np.cumsum(data >= 128)])[offsets]) > 0
    for row in np.flatnonzero(~out & wide).tolist():
        out[row] = any(c.isalpha() for c in data[offsets[row]:offsets[row + 1]].tobytes().decode())
    return out


def predict(model: Model, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, posterior and bits a byte of each text."""
    data, offsets = utf8(texts)
    if not model.languages:
        return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
    bits, size = model.code_lengths(data, offsets)
    best = bits.argmin(axis=1)
    least = bits[np.arange(len(bits)), best]
    score = 1 / np.exp2(-np.minimum(bits - least[:, None], 1000)).sum(axis=1)
    known = has_letter(data, offsets)
    return ([model.languages[b] if k else UNKNOWN for b, k in zip(best.tolist(), known.tolist(), strict=True)],
            np.where(known, score, 0.0), np.where(known, least / np.maximum(size, 1), 0.0))


def identify(docs: DataFrame, model: Model | None = None, key: str = "doc_id", text: str = "text",
             lang: str = "lang") -> DataFrame:
    """One row per document: key, ``lang_pred``, ``score`` and
    ``bits_per_byte`` (the model is learned from ``docs`` if not given)."""
    shared = docs.sparkSession.sparkContext.broadcast(model or learn(docs, key, text, lang))

    def work(texts: pa.Array) -> dict[str, object]:
        names, score, rate = predict(shared.value, texts)
        return {"lang_pred": names, "score": score, "bits_per_byte": rate}

    return map_texts(docs, key, text, [
        T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
        T.StructField("bits_per_byte", T.DoubleType())], work)


def keep_identified(docs: DataFrame, model: Model, text: str = "text", least_score: float = 0.5) -> DataFrame:
    """The documents with a known language, all their columns unchanged: no
    letter, or a posterior under ``least_score``, rejects a document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, offsets = utf8(batch.column(at))
            for i, j in slices(offsets):
                part = batch.slice(i, j - i)
                names, score, _ = predict(shared.value, part.column(at))
                yield part.filter(pa.array((np.array(names) != UNKNOWN) & (score >= least_score)))

    return map_columns(docs, run, docs.schema.fields)


def language_report(docs: DataFrame, **how) -> DataFrame:
    """Per document: key, ``held_out``, ``lang_pred``, ``score``,
    ``bits_per_byte``."""
    key = how.get("key", "doc_id")
    found = identify(docs, **how)
    return found.select(key, held_out(F.col(key)).alias("held_out"), "lang_pred", "score", "bits_per_byte")
