"""URL rules through a Bloom filter cascade.

A rule is a host and the start of a path (``example.org/es/``) with a verdict.
A URL's probe keys are its host and parent domains, each with the starts of
its path in the lengths that rules have; a rule fits if its text is one of
them, and the longest wins (of equal length, the longer host). Where no rule
fits, a URL is blocked if its host or a parent domain is on a block list.

Membership of a probe key needs no join: the listed keys are encoded in a
cascade of Bloom filters. Level 0 holds the listed keys, level 1 the keys of
the corpus that level 0 takes wrongly, level 2 the listed keys that level 1
takes wrongly, and so on until nothing is wrong. The false positives are
searched among all distinct probe keys of the corpus, so on these the answer
is exact. Sets of wrong keys shrink by the filters' error rate; each level's
bits are gathered by an aggregation over 64-bit words, so only the finished
filters reach the driver; they are broadcast, and their size, which follows
the number of listed keys, is checked against ``max_filter_bytes``.

Defined results: a null URL, or one without ``://``, has an empty host and
path, fits no rule and is allowed; URLs that repeat are judged alike; an empty
table gives no rows. Only the key and the url column are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The rules of the registered query.
RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)
# A host is on the block list of the registered query if one of
# its labels has one of these words, between dots or hyphens.
BLOCKED_WORDS = ("ads", "adult", "bets", "casino", "pills", "poker", "porn", "spam", "viagra", "xxx")
BITS_PER_KEY = 12
HASHES = 6
MAX_LEVELS = 40
MAX_FILTER_BYTES = 256 << 20
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL (empty where there are none)."""
    has = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    rest = F.when(has, F.substring_index(url, "://", 1)).otherwise("")
    rest = F.when(has, F.substr(url, F.length(rest) + 4)).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def split_rule(rule: str) -> tuple[str, str]:
    host, slash, path = rule.partition("/")
    return host, slash + path


def probe_keys(host: Column, path: Column, lengths: list[int]) -> Column:
    """Keys of all rules that could fit, the longest first."""
    labels = F.split(host, r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)),
                          lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    starts = F.array(*[F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in sorted(lengths, reverse=True)])
    keys = F.flatten(F.transform(domains, lambda d: F.transform(
        F.filter(starts, lambda p: p.isNotNull()), lambda p: F.struct((-F.length(d) - F.length(p)).alias("n"),
                                                                      (-F.length(d)).alias("d"),
                                                                      F.concat(d, p).alias("key")))))
    keys = F.transform(F.array_sort(keys), lambda k: k["key"])
    return F.when(host == "", F.array().cast("array<string>")).otherwise(keys)


# --- the cascade ---------------------------------------------------------

def key_hashes(key: Column) -> tuple[Column, Column]:
    """128 bits that stand for a key."""
    return F.xxhash64(key), F.xxhash64(key, F.lit("second"))


def _bits(a: np.ndarray, b: np.ndarray, level: int, n_bits: int) -> Iterator[np.ndarray]:
    a, b = a.astype(np.uint64), b.astype(np.uint64)
    x = (a ^ np.uint64(0x9E3779B97F4A7C15 * (level + 1) % (1 << 64))) * np.uint64(0xBF58476D1CE4E5B9)
    y = (b + np.uint64(level)) * np.uint64(0x94D049BB133111EB) | np.uint64(1)
    x, y = x ^ (x >> np.uint64(31)), y ^ (y >> np.uint64(29)) | np.uint64(1)
    for i in range(HASHES):
        v = x + np.uint64(i) * y + np.uint64(i * i)
        yield ((v ^ (v >> np.uint64(32))) % np.uint64(n_bits)).astype(np.int64)


@dataclass
class Level:
    n_bits: int
    words: np.ndarray  # uint64

    def takes(self, a: np.ndarray, b: np.ndarray, level: int) -> np.ndarray:
        ok = np.ones(len(a), bool)
        for at in _bits(a, b, level, self.n_bits):
            ok &= (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1
        return ok


@dataclass
class Cascade:
    levels: list[Level]

    def contains(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the keys with these hashes are listed."""
        listed = np.zeros(len(a), bool)
        open_ = np.arange(len(a))
        for n, level in enumerate(self.levels):
            took = level.takes(a[open_], b[open_], n)
            listed[open_[~took]] = n % 2 == 1
            open_ = open_[took]
        listed[open_] = len(self.levels) % 2 == 1
        return listed


def _level(keys: DataFrame, number: int, max_filter_bytes: int) -> Level | None:
    """The filter of the keys with hashes ``a`` and ``b``; None for no keys."""
    n = keys.count()
    if not n:
        return None
    n_bits = max(64, -(-n * BITS_PER_KEY // 64) * 64)
    if n_bits > 8 * max_filter_bytes:
        raise ValueError(f"a filter of {n} keys is over max_filter_bytes={max_filter_bytes}")

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(i).to_numpy() for i in (0, 1))
            at = np.concatenate(list(_bits(a, b, number, n_bits)))
            word, where = np.unique(at >> 6, return_inverse=True)
            bits = np.zeros(len(word), np.uint64)
            np.bitwise_or.at(bits, where, np.uint64(1) << (at & 63).astype(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(bits.view(np.int64))], names=["word", "bits"])

    made = keys.select("a", "b").mapInArrow(words, "word long, bits long") \
        .groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(n_bits // 64, np.uint64)
    out[made["word"].to_numpy()] = made["bits"].to_numpy().view(np.uint64)
    return Level(n_bits, out)


def _passing(keys: DataFrame, level: Level, number: int) -> DataFrame:
    """The keys (with their columns a and b) that a level takes."""
    shared = keys.sparkSession.sparkContext.broadcast(level)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            took = shared.value.takes(batch.column(0).to_numpy(), batch.column(1).to_numpy(), number)
            yield batch.filter(pa.array(took))

    return keys.select("a", "b").mapInArrow(keep, "a long, b long")


def build_cascade(listed: DataFrame, universe: DataFrame, max_filter_bytes: int = MAX_FILTER_BYTES) -> Cascade:
    """The cascade of the ``listed`` keys, exact on them and on all keys of
    ``universe``. Both frames have one string column; nulls and repeats do no
    harm."""
    def hashed(df: DataFrame) -> DataFrame:
        key = F.col(df.columns[0])
        a, b = key_hashes(key)
        return df.where(key.isNotNull()).select(a.alias("a"), b.alias("b")).distinct()

    listed, levels = hashed(listed), []
    sides = [listed, hashed(universe)]  # the set that a level encodes, and the other
    for number in range(MAX_LEVELS):
        level = _level(sides[0], number, max_filter_bytes)
        if level is None:
            return Cascade(levels)
        levels.append(level)
        wrong = _passing(sides[1], level, number)
        if number == 0:  # only here can the other side hold listed keys
            wrong = wrong.join(listed, ["a", "b"], "left_anti")
        sides = [wrong.checkpoint(), sides[0]]  # written, not recomputed by the next level
    raise RuntimeError("two keys have the same 128-bit hash")


# --- the operator --------------------------------------------------------

def hosts_with_words(pages: DataFrame, words: tuple[str, ...] = BLOCKED_WORDS, url: str = "url") -> DataFrame:
    """The corpus's hosts that have one of the words, as a block list."""
    host = url_parts(F.col(url))[0]
    return pages.select(host.alias("host")).where(
        F.col("host").rlike(r"(^|[.-])(" + "|".join(words) + r")([.-]|$)")).distinct()


def judge_urls(pages: DataFrame, rules: tuple[tuple[str, str], ...] = RULES, listed: DataFrame | None = None,
               key: str = "page_id", url: str = "url", max_filter_bytes: int = MAX_FILTER_BYTES) -> DataFrame:
    """One row per page: key, ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules``: texts and verdicts (allow or block). ``listed``: a frame with
    one column of hosts to block, with their subdomains, where no rule fits."""
    spark = pages.sparkSession
    kind = pages.schema[key].dataType
    host, path = url_parts(F.col(url))
    parts = pages.select(F.col(key).alias("k"), host.alias("host"), path.alias("path"))
    lengths = sorted({len(split_rule(r)[1]) for r, _ in rules} | ({0} if listed is not None else set()))
    probes = parts.withColumn("probes", probe_keys(F.col("host"), F.col("path"), lengths))
    universe = probes.select(F.explode("probes").alias("key")).distinct()
    text = T.StructType([T.StructField("key", T.StringType())])

    def cascade(keys: DataFrame) -> Cascade:
        return build_cascade(keys, universe, max_filter_bytes)

    lists = {v: cascade(spark.createDataFrame([(r,) for r, x in rules if x == v], text)) for v in ("allow", "block")}
    if listed is not None:
        lists["listed"] = cascade(listed.select(F.col(listed.columns[0]).cast("string").alias("key")))
    shared = spark.sparkContext.broadcast(lists)

    hashed = probes.select(
        "k", "host", "path", "probes", F.transform("probes", lambda p: key_hashes(p)[0]).alias("a"),
        F.transform("probes", lambda p: key_hashes(p)[1]).alias("b"))
    schema = T.StructType([T.StructField("k", kind), *(T.StructField(n, T.StringType())
                                                       for n in ("host", "path", "rule", "verdict"))])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = {n: batch.column(n) for n in batch.schema.names}
            a, b = (col[n].flatten().to_numpy(zero_copy_only=False) for n in ("a", "b"))
            n_probes = pa.compute.list_value_length(col["probes"]).to_numpy()
            allow, block = (shared.value[v].contains(a, b) for v in ("allow", "block"))
            verdict = np.full(batch.num_rows, "allow", object)
            row_of = np.repeat(np.arange(batch.num_rows), n_probes)
            if "listed" in shared.value:
                verdict[row_of[shared.value["listed"].contains(a, b)]] = "block"
            fits = np.flatnonzero(allow | block)
            row, where = np.unique(row_of[fits], return_index=True)
            first = fits[where]  # the longest rule of each row that has one
            verdict[row] = np.where(block[first], "block", "allow")
            rule = np.full(batch.num_rows, None, object)
            rule[row] = col["probes"].flatten().take(pa.array(first)).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([col["k"], col["host"], col["path"], pa.array(rule, pa.string()),
                                              pa.array(verdict, pa.string())], names=schema.names)

    return hashed.mapInArrow(judge, schema).withColumnRenamed("k", key)
