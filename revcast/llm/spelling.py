"""Spelling variants of the words of a corpus: a frequency-vector trie.

A word's letters fall into ``GROUPS`` groups; its vector holds how many of
them stand in each. Words that differ by one inserted, deleted or replaced letter
have vectors that differ by a surplus of one at most in one group and a deficit of
one at most in another.

1. Words are counted by document, summed up in the tasks and then by word.
2. The trie has a level for each group, and words hang at its leaves. It is dealt
   out by its upper levels, ``STEP`` at a time: a word is a member of the node
   that its counts lead to, and visits each node that a search may reach by
   spending a surplus of one and a deficit of one. (Of two nodes the word of the lesser
   one visits the greater, so that each pair meets once.) Nodes of more than
   ``PAGE`` rows are dealt out by the next levels, the others are pages. Words
   of one whole vector that are still too many are dealt out by their first and by
   their last letters, of which two near words share one.
3. In a page a depth-first search goes down the remaining levels with all visitors
   of a node at once, each with what is left of its budget; at the leaves, words
   are compared letter by letter.
4. Of its near words each word takes the most frequent one as its form, and
   forms are followed to the last by pointer jumping.

Only words and pairs of near words are shuffled; no task holds more than a page.

Defined results: a null or empty text has no words; a null key counts as empty text in
the hash that deletes letters; repeated rows count as often as they stand there; an empty
table gives no rows. Only key and text are read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import settled

GROUPS, STEP = 24, 6
PAGE = 200_000
MIN_LENGTH, MIN_COUNT, DROP_ONE_IN, FACTOR = 5, 3, 97, 2
RUN = re.compile("[A-Za-zÀ-ÿ]{%d,}" % MIN_LENGTH)
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
# Words that a task counts before it hands them on; pairs of a leaf compared one by one.
HELD = 200_000
FEW = 1024
# Nodes of too many rows that are broadcast (there is one for each PAGE rows at most).
BROADCAST_NODES = 100_000


# --- words ----------------------------------------------------------------

def words_of(key: object, text: str, one_in: int = DROP_ONE_IN) -> Iterator[tuple[str, int]]:
    """The words of a document with their counts; where ``one_in`` divides the
    crc32 of key and word, the word lacks a letter."""
    seed = zlib.crc32(f"{'' if key is None else key}:".encode())
    for word, n in Counter(RUN.findall(text)).items():
        word = word.lower() if word.isascii() else word.translate(_LOWER)
        h = zlib.crc32(word.encode(), seed)
        if h % one_in == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1:]
            if len(word) < MIN_LENGTH:
                continue
        yield word, n


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``word`` and ``n`` of all words of at least ``MIN_COUNT`` places."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = defaultdict(int)
        for batch in batches:
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for word, n in words_of(k, t.as_py() or ""):
                    held[word] += n
                if len(held) > HELD:
                    yield _counted(held)
                    held.clear()
        yield _counted(held)

    counts = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInArrow(run, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)


def _counted(held: dict[str, int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
                                      names=["word", "n"])


# --- vectors and nodes ----------------------------------------------------

def vectors(words: list[str]) -> np.ndarray:
    """How many letters of each word stand in each group, a row for each word."""
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    rows = np.repeat(np.arange(len(words)), [len(w) for w in words])
    return np.bincount(rows * GROUPS + flat % GROUPS, minlength=len(words) * GROUPS).reshape(-1, GROUPS).astype(np.int32)


def moves() -> list[tuple[list[int], int, int]]:
    """The ways that ``STEP`` levels can differ from a word's counts: by nothing,
    by one more or one less in one of them, or both. With what each
    spends of the surplus (a node of one less) and of the deficit."""
    none = [0] * STEP
    ups = [none, *([int(i == k) for i in range(STEP)] for k in range(STEP))]
    return [([x - y for x, y in zip(up, down, strict=True)], int(any(down)), int(any(up)))
            for up in ups for down in ups if up != down or not any(up)]


def node_of(counts: list[int]) -> str:
    """The text that stands for the counts of some levels."""
    return bytes(counts).hex() if max(counts) < 256 else ",".join(map(str, counts))


def letters_of(node: str) -> int:
    """How many letters the words of a node have on the levels down to it."""
    return sum(sum(map(int, x.split(","))) if "," in x else sum(bytes.fromhex(x)) for x in node.split("/")[1:])


_ROW = "node string, depth int, word string, n long, member boolean, surplus int, deficit int"


_MOVES = moves()


def _deeper(rows: list[tuple]) -> Iterator[tuple]:
    """The rows of nodes one step down. A member meets the other members of its
    own node there, and of the other nodes it visits the greater ones."""
    made = vectors([r[2] for r in rows])
    own = np.stack([v[r[1]:r[1] + STEP] for r, v in zip(rows, made, strict=True)])
    member, surplus, deficit = (np.array([r[i] for r in rows]) for i in (4, 5, 6))
    for move, less, more in _MOVES:
        here = not any(move)
        greater = not here and next(x for x in move if x) > 0
        counts = own + move
        go = (counts >= 0).all(axis=1) & (surplus >= less) & (deficit >= more) & (~member | here | greater)
        for i, to in zip(np.flatnonzero(go).tolist(), counts[go].tolist(), strict=True):
            node, depth, word, n, is_member, s, d = rows[i]
            yield f"{node}/{node_of(to)}", depth + STEP, word, n, is_member and here, s - less, d - more


def _split(rows: list[tuple]) -> Iterator[tuple]:
    """The rows of whole vectors by first and by last letters (see ``half``)."""
    for node, depth, word, *rest in rows:
        k = half(letters_of(node))
        for piece in ("<" + word[:k], ">" + word[-k:]):
            yield node + piece, depth + STEP, word, *rest


def _dealt(rows: DataFrame, how: object) -> DataFrame:
    schema = pa.schema([("node", pa.string()), ("depth", pa.int32()), ("word", pa.string()), ("n", pa.int64()),
                        ("member", pa.bool_()), ("surplus", pa.int32()), ("deficit", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 2_000):
                columns = [c.to_pylist() for c in batch.slice(i, 2_000).columns]
                made = list(zip(*how(list(zip(*columns, strict=True))), strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(
                    made or [[]] * len(schema), schema, strict=True)], schema=schema)

    return rows.mapInArrow(run, _ROW)


# --- search in a page -----------------------------------------------------

def near(a: str, b: str) -> bool:
    """Whether two words differ by exactly one letter put in, left out or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    lo, hi = 0, len(a)  # the length of the common start, by halving
    if a != b[:hi]:
        while hi - lo > 1:
            mid = (lo + hi) // 2
            lo, hi = (mid, hi) if a[lo:mid] == b[lo:mid] else (lo, mid)
    else:
        lo = hi
    return a[lo + (len(a) == len(b)):] == b[lo + 1:]


def half(length: int) -> int:
    """So many first or so many last letters a word of this length shares with
    each near word: all but one of the shorter one's letters stand before or after the change."""
    return max(1, (length - 2) // 2)


def _verified(members: list[tuple[int, str]], visitors: list[tuple[int, str]]) -> Iterator[tuple[int, int]]:
    """The near pairs of a leaf, whose members have one length: those that share their
    first or their last letters are compared, one by one or (where these are
    many) if they agree in all but one place."""
    k = half(len(members[0][1]))
    if len(members) * len(visitors) <= FEW:
        groups = [(members, visitors, False)]
    else:
        groups = []
        for last in (False, True):
            at: dict[str, tuple[list, list]] = defaultdict(lambda: ([], []))
            for side, words in enumerate((members, visitors)):
                for i, word in words:
                    at[word[-k:] if last else word[:k]][side].append((i, word))
            groups += [(a, b, last) for a, b in at.values() if a and b]
    for own, guests, last in groups:
        for i, a, j, b in _alike(own, guests):
            # What shares its first letters too has been found by them.
            if not (last and a[:k] == b[:k]) and near(a, b):
                yield i, j


def _alike(members: list[tuple[int, str]], visitors: list[tuple[int, str]]) -> Iterator[tuple[int, str, int, str]]:
    """All pairs, or if these are many those that agree in all but one place."""
    if len(members) * len(visitors) <= 4 * FEW:
        for i, a in members:
            for j, b in visitors:
                yield i, a, j, b
        return

    def keys(word: str) -> Iterator[tuple[int, int, int]]:
        up, down = [0], [0]  # hashes of all beginnings and, backwards, of all ends
        for x, y in zip(word, reversed(word), strict=True):
            up.append(hash((up[-1], x)))
            down.append(hash((down[-1], y)))
        for k in range(len(word)):
            yield up[k], down[len(word) - k - 1], k
        for k in range(len(word) + 1):
            yield up[k], down[len(word) - k], ~k

    at = defaultdict(list)
    for i, a in members:
        for key in keys(a):
            at[key].append((i, a))
    for j, b in visitors:
        found = {}
        for x, y, k in keys(b):
            # A letter replaced: one place left out in both. Left out in one: a gap in the other.
            if k >= 0:
                found.update(at.get((x, y, k), ()))
            found.update(at.get((x, y, ~k), ()))
        for i, a in found.items():
            yield i, a, j, b


def search(members: list[str], visitors: list[str], surplus: np.ndarray, deficit: np.ndarray,
           level: int) -> Iterator[tuple[int, int]]:
    """Depth-first search from one node down: near pairs (member, visitor), where
    visitors have this surplus and deficit left."""
    have, want = vectors(members), vectors(visitors)
    by = np.lexsort(have.T[::-1])
    have, order = have[by], by.tolist()
    stack = [(level, 0, len(order), np.arange(len(visitors)), surplus, deficit)]
    while stack:
        level, lo, hi, who, s, d = stack.pop()
        if level == GROUPS:
            yield from _verified([(i, members[i]) for i in order[lo:hi]], [(j, visitors[j]) for j in who.tolist()])
            continue
        if (hi - lo) * len(who) <= FEW:  # all paths of a small subtrie at once
            over = want[who, None, level:] - have[None, lo:hi, level:]
            fits = (np.maximum(over, 0).sum(axis=2) <= s[:, None]) & (np.maximum(-over, 0).sum(axis=2) <= d[:, None])
            for j, i in zip(*(x.tolist() for x in np.nonzero(fits)), strict=True):
                if near(members[order[lo + i]], visitors[int(who[j])]):
                    yield order[lo + i], int(who[j])
            continue
        counts = have[lo:hi, level]
        cuts = [0, *(np.flatnonzero(counts[1:] != counts[:-1]) + 1).tolist(), hi - lo]
        more = want[who, level]
        for a, b in zip(cuts, cuts[1:], strict=False):
            # The visitor's surplus over the trie's count, if positive, is spent; its deficit too.
            over = more - counts[a]
            s2, d2 = s - np.maximum(over, 0), d + np.minimum(over, 0)
            go = np.flatnonzero((s2 >= 0) & (d2 >= 0))
            if len(go):
                stack.append((level + 1, lo + a, lo + b, who[go], s2[go], d2[go]))


_PAIR = "a string, n_a long, b string, n_b long"


def _page(rows: pa.Table) -> pa.Table:
    words, n, member = rows["word"].to_pylist(), rows["n"].to_pylist(), rows["member"].to_numpy()
    own, guests = np.flatnonzero(member).tolist(), np.flatnonzero(~member).tolist()
    if not own:
        return pa.table([pa.array([], f) for f in (pa.string(), pa.int64()) * 2], names=["a", "n_a", "b", "n_b"])
    level = min(GROUPS, rows["depth"][0].as_py())
    every = own + guests
    found = search([words[i] for i in own], [words[i] for i in every], rows["surplus"].to_numpy()[every],
                   rows["deficit"].to_numpy()[every], level)
    # Two members meet twice; a visitor is no member of its own.
    pairs = [(own[i], every[j]) for i, j in found if j >= len(own) or i < j]
    pairs = [(i, j) if words[i] < words[j] else (j, i) for i, j in pairs]
    return pa.table([pa.array([words[i] for i, _ in pairs], pa.string()), pa.array([n[i] for i, _ in pairs], pa.int64()),
                     pa.array([words[j] for _, j in pairs], pa.string()), pa.array([n[j] for _, j in pairs], pa.int64())],
                    names=["a", "n_a", "b", "n_b"])


def near_pairs(words: DataFrame) -> DataFrame:
    """Each pair of near words once: ``a``, ``n_a``, ``b``, ``n_b``."""
    rows = words.select(F.lit("").alias("node"), F.lit(0).alias("depth"), "word", "n", F.lit(True).alias("member"),
                        F.lit(1).alias("surplus"), F.lit(1).alias("deficit"))
    out = None
    for depth in range(0, GROUPS + 1, STEP):
        last = depth == GROUPS
        rows = settled(_dealt(rows, _split if last else _deeper))
        large = settled(rows.groupBy("node").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > PAGE).select("node"))
        n = 0 if last else large.count()
        large = F.broadcast(large) if n <= BROADCAST_NODES else large
        page = rows.join(large, "node", "left_anti") if n else rows
        pairs = page.groupBy("node").applyInArrow(_page, _PAIR)
        # Two words can share their first and their last letters.
        pairs = settled(pairs.distinct() if last else pairs)
        out = pairs if out is None else out.unionByName(pairs)
        if not n:
            return out
        rows = settled(rows.join(large, "node", "left_semi"))
    return out


# --- forms ----------------------------------------------------------------

def last_forms(forms: DataFrame) -> DataFrame:
    """``word`` and ``root``: the forms (word, form) followed to the last."""
    now = settled(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        then = settled(now.join(ahead, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        now = then.drop("moved")
        if then.where("moved").isEmpty():
            return now


def variants(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per word: ``word``, ``n``, ``n_near``, ``form``, ``form_n`` and ``root``."""
    words = settled(word_counts(docs, key, text))
    pairs = near_pairs(words)
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("n_b").alias("m")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("other"), F.col("n_a").alias("m")))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                    F.min(F.struct((-F.col("m")).alias("m"), "other")).alias("best"))
    formed = F.coalesce(-F.col("best.m") >= FACTOR * F.col("n"), F.lit(False))
    made = settled(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(formed, F.col("best.other")).alias("form"), F.when(formed, -F.col("best.m")).alias("form_n")))
    roots = last_forms(made.where("form is not null"))
    return made.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
