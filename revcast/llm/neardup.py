"""MinHash near-duplicates by a multi-index Hamming join.

A document is the set of its distinct word shingles, two are linked if the
sets' Jaccard similarity reaches the threshold, and groups are the connected
components of the links.

1. Each document gets its set's size, a digest of the set and a signature of
   ``CHUNKS * CHUNK`` MinHash values cut to one byte each. Documents with one
   digest are one class, of which only the least id goes on. A further class
   of the same least id goes on under a number above all ids.
2. Multi-index: signatures are split into chunks, and each chunk is indexed
   with every choice of ``ERRORS`` of its values left out. By the pigeonhole
   principle all pairs of signatures that differ in at most
   ``CHUNKS * (ERRORS + 1) - 1`` values meet under some index key; pairs at
   similarity 0.8 meet with a probability of about 1 - 6e-6 in all.
3. Under each key, members are first compared only with the least one, the
   key's hub (found by a grouped minimum), so a large group of copies gives a
   star and not all its pairs. Of a document's candidates the one of the
   nearest signature is confirmed first; pairs that are then in one component
   need no confirmation.
4. Keys whose members are still in several components: all members of the keys
   of one hub make a family; families most of whose members are in a larger one
   become part of it. The hub that is nearest to most of its members is a
   family's centre. Two members ``x`` and ``y`` differ by
   the symmetric difference of their own differences from the centre ``h``. If
   ``x`` is not linked to ``h``, a link of the two needs more than about half of
   ``y``'s difference in common, and all of it but what ``y`` may differ from
   ``x``; so they share an early element of ``y``'s difference, the family's
   rarest elements first. It can be anywhere in ``x``'s, unless ``y`` is not
   linked to ``h`` either, when it is early in both. The first common element
   must leave enough behind it in both differences for a link. Only such pairs
   are compared, and members linked to the centre with the centre: what thousands of members share (the centre, or what they all
   lack of it) comes last, and for members that have little in common with the
   centre (chance meetings) it is the prefix filter of set joins. So every pair
   that meets under a key is confirmed, refuted or in one component: no link
   between components is lost.
5. Links are confirmed on the full sets of 64-bit shingle hashes, which are
   made again from the texts of the documents concerned only.

Signatures, keys and links stay in Spark; nothing of them is collected. Hot
keys are handled by partial aggregation and by joins that adaptive execution
can split. What is used more than once is written by ``checkpoint()``.

Defined results: null or empty text has no words, an empty set and no links; a
text of fewer words than a shingle is one shingle. Rows with one id count as
one document, whose texts are linked. A row without an id is its own group,
with a null component, and is kept. Only key and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import settled, star_components
from .text import LOWER, map_texts, mix, span_hashes, utf8, word_spans

SHINGLE = 5
PERCENT = 80
CHUNKS, CHUNK, ERRORS = 14, 7, 1
VALUES = CHUNKS * CHUNK
# Up to so many ids pick their documents by a broadcast (of ids and digests), more by a shuffle.
BROADCAST_IDS = 1_000_000
# Members of a family that meet one copy of its centre's set; rounds in which
# families become parts of larger ones; elements that about one in so many members
# has are ranked by their number, rarer ones by their hash.
SALT, MERGES, COMMON = 250, 3, 64

_BLANKS = np.ones(256, bool)
_BLANKS[[0x20, *range(0x09, 0x0E)]] = False
_FACTORS = np.random.default_rng(20240229).integers(1, 1 << 63, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each row."""
    low = LOWER[data]
    starts, ends, first = word_spans(low, offsets, _BLANKS)
    h = span_hashes(low, starts, ends)
    factor = np.uint64(0x9DDFEA08EB382D69)
    full = h[:max(0, len(h) - width + 1)].copy()
    for k in range(1, width):
        full = mix(full * factor + h[k:k + len(full)])
    full = mix(full + np.uint64(width))
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        n = b - a
        if n >= width:
            s = np.sort(full[a:b - width + 1])
            out.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
        elif n:
            one = h[a:a + 1]
            for k in range(a + 1, b):
                one = mix(one * factor + h[k:k + 1])
            out.append(mix(one + np.uint64(n)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One byte of each MinHash value, a row for each set (zero if empty)."""
    sizes = np.array([len(s) for s in sets])
    out = np.zeros((len(sets), VALUES), np.uint8)
    some = np.flatnonzero(sizes)
    if len(some):
        flat = np.concatenate(sets)
        starts = np.concatenate([[0], np.cumsum(sizes)])[some]
        for k, factor in enumerate(_FACTORS):
            out[some, k] = mix(np.minimum.reduceat(flat * factor, starts)) >> np.uint64(56)
    return out


def index_keys(sig: np.ndarray) -> np.ndarray:
    """The index keys of each signature: chunk, values left out, the rest."""
    choices = list(combinations(range(CHUNK), CHUNK - ERRORS))
    out = np.zeros((len(sig), CHUNKS * len(choices)), np.int64)
    for c in range(CHUNKS):
        chunk = sig[:, c * CHUNK:(c + 1) * CHUNK].astype(np.int64)
        for k, choice in enumerate(choices):
            key = np.full(len(sig), c * len(choices) + k, np.int64)
            for at in choice:
                key = key << 8 | chunk[:, at]
            out[:, c * len(choices) + k] = key
    return out


def _described(docs: DataFrame, width: int) -> DataFrame:
    """Id, set size, set digest and signature of each document."""
    def work(texts: pa.Array) -> dict[str, object]:
        sets = shingle_hashes(*utf8(texts), width)
        return {"n": [len(s) for s in sets],
                "digest": [_digest(s) if len(s) else None for s in sets],
                "sig": [x.tobytes() for x in signatures(sets)]}

    return map_texts(docs, "id", "t", [T.StructField("n", T.LongType()), T.StructField("digest", T.BinaryType()),
                                       T.StructField("sig", T.BinaryType())], work)


def _index(classes: DataFrame) -> DataFrame:
    """Index keys and ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(-1, VALUES)
            ids = batch.column(0).to_numpy()
            for i in range(0, len(ids), 1000):
                keys = index_keys(sig[i:i + 1000])
                yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1)), pa.array(
                    np.repeat(ids[i:i + 1000], keys.shape[1]))], names=["key", "id"])

    return classes.select("id", "sig").mapInArrow(run, "key long, id long")


def _near(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sizes allow a link, with the number of signature
    values that differ."""
    def side(name: str) -> DataFrame:
        return classes.select(F.col("id").alias(name), F.col("sig").alias("sig_" + name), F.col("n").alias("n_" + name))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(n).to_pylist()), np.uint8).reshape(-1, VALUES)
                    for n in ("sig_a", "sig_b"))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array((x != y).sum(axis=1))],
                                             names=["a", "b", "far"])

    sized = pairs.join(side("a"), "a").join(side("b"), "b").where(
        F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent)
    return sized.select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a long, b long, far long")


def _digest(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s, digest_size=16).digest()


def numbered(by_digest: DataFrame) -> DataFrame:
    """Classes (digest, class, n, sig) with their own numbers ``id``: the class's
    least id for one class of each, numbers above all ids for its others."""
    several = by_digest.groupBy("class").agg(F.min("digest").alias("first"), F.count("*").alias("k")).where("k > 1")
    extra = settled(by_digest.select("digest", "class").join(several, "class").where("digest <> first").select("digest"))
    n = extra.count()
    if not n:
        return by_digest.withColumn("id", F.col("class"))
    top = by_digest.agg(F.max("class")).first()[0]
    if top + n >= 1 << 63:
        raise OverflowError(f"no room above the greatest id for the {n} further texts of repeated ids")
    extra = extra.withColumn("at", F.monotonically_increasing_id()).checkpoint()
    part = F.shiftright("at", 33)
    starts, start = [], top + 1
    for p, k in sorted(extra.groupBy(part.alias("p")).count().collect()):
        starts.append((p, start))
        start += k
    numbers = extra.withColumn("p", part).join(
        F.broadcast(extra.sparkSession.createDataFrame(starts, "p long, start long")), "p").select(
        "digest", (F.col("start") + F.col("at").bitwiseAND((1 << 33) - 1)).alias("number"))
    return by_digest.join(numbers, "digest", "left").withColumn("id", F.coalesce("number", "class")).drop("number")


def _sets(docs: DataFrame, classes: DataFrame, ids: DataFrame, width: int, have: DataFrame | None = None) -> DataFrame:
    """The full sets of some classes, from their texts (and those at hand)."""
    def work(texts: pa.Array) -> dict[str, object]:
        sets = shingle_hashes(*utf8(texts), width)
        return {"set": [s.tobytes() for s in sets], "made": [_digest(s) for s in sets]}

    ids = ids.distinct()
    if have is not None:
        ids = ids.join(have.select("id"), "id", "left_anti")
    ids = settled(ids)
    n = ids.count()
    if have is not None and not n:
        return have
    wanted = classes.join(F.broadcast(ids) if n <= BROADCAST_IDS else ids, "id", "left_semi").select(
        F.col("class").alias("doc"), F.struct("id", "digest").alias("key"))
    picked = docs.withColumnRenamed("id", "doc").join(F.broadcast(wanted) if n <= BROADCAST_IDS else wanted, "doc")
    # A document of a repeated id can have another text than the class.
    made = map_texts(picked, "key", "t", [T.StructField("set", T.BinaryType()), T.StructField("made", T.BinaryType())],
                     work).where("made = key.digest").groupBy(F.col("key.id").alias("id")).agg(
        F.max("set").alias("set")).checkpoint()
    return made if have is None else have.unionByName(made)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
                x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (x, y))
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                both = int((y[np.minimum(at, len(y) - 1)] == x).sum()) if len(y) else 0
                keep.append(both > 0 and 100 * both >= percent * (len(x) + len(y) - both))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)],
                                             names=["a", "b"])

    joined = pairs.select("a", "b").join(sets.select(F.col("id").alias("a"), F.col("set").alias("set_a")), "a").join(
        sets.select(F.col("id").alias("b"), F.col("set").alias("set_b")), "b")
    return joined.select("a", "b", "set_a", "set_b").mapInArrow(run, "a long, b long")


def _apart(pairs: DataFrame, groups: DataFrame | None) -> DataFrame:
    """The pairs whose ends are in different components."""
    if groups is None:
        return pairs
    out = pairs
    for name in ("a", "b"):
        own = groups.select(F.col("node").alias(name), F.col("component").alias("c_" + name))
        out = out.join(own, name, "left").withColumn("c_" + name, F.coalesce("c_" + name, name))
    return out.where("c_a <> c_b").drop("c_a", "c_b")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id")))


def _links(pairs: DataFrame, sets: DataFrame, groups: DataFrame | None, percent: int) -> DataFrame | None:
    """Components after confirming pairs (a, b, far): the nearest of each
    document first, then all others that still join two components."""
    done = None
    for last in (False, True):
        todo = _apart(pairs, groups)
        if done is not None:
            todo = todo.join(done, ["a", "b"], "left_anti")
        if not last:
            todo = todo.groupBy("a").agg(F.min(F.struct("far", "b")).alias("x")).select("a", "x.b")
        todo = settled(todo.select("a", "b"))
        if todo.isEmpty():
            break
        done = todo if done is None else done.unionByName(todo)
        groups = _grown(groups, _confirmed(todo, sets, percent))
    return groups


def _grown(groups: DataFrame | None, links: DataFrame) -> DataFrame | None:
    links = settled(links)
    if links.isEmpty():
        return groups
    if groups is not None:
        links = links.unionByName(groups.select(F.col("node").alias("a"), F.col("component").alias("b")))
    return star_components(links)


def _component(df: DataFrame, groups: DataFrame | None, name: str, out: str) -> DataFrame:
    """The component of each row's ``name``, by default its own."""
    if groups is None:
        return df.withColumn(out, F.col(name))
    own = groups.select(F.col("node").alias(name), F.col("component").alias(out))
    return df.join(own, name, "left").withColumn(out, F.coalesce(out, name))


def _most(votes: DataFrame, of: str, to: str) -> DataFrame:
    """For each ``of`` the ``to`` with the greatest ``k`` (of equal ones the least)."""
    return votes.groupBy(of).agg((-F.max(F.struct("k", (-F.col(to)).alias("to")))["to"]).alias(to))


def _merged(stars: DataFrame) -> DataFrame:
    """Hubs (hub, id) put together to families (hub, family): a few times over, a
    family becomes part of the one that most of its members have as their largest."""
    names = settled(stars.select("hub").distinct().withColumn("family", F.col("hub")))
    for _ in range(MERGES):
        rows = settled(stars.join(names, "hub").select("family", "id").distinct())
        sizes = rows.groupBy("family").agg(F.count(F.lit(1)).alias("k"))
        largest = _most(rows.join(sizes, "family").withColumnRenamed("family", "into"), "id", "into")
        into = _most(rows.join(largest, "id").groupBy("family", "into").agg(F.count(F.lit(1)).alias("k")), "family", "into")
        names = settled(names.join(into, "family").select("hub", F.col("into").alias("family")))
    return names


def _families(members: DataFrame, near: DataFrame, groups: DataFrame | None) -> DataFrame:
    """Families and their members (id, component c): those of the keys of three
    and more whose members are in several components. A family is named by its centre,
    of the hubs that are the nearest of some member that of the most."""
    own = _component(members.select("key", F.col("least").alias("hub"), "id"), groups, "id", "c")
    keys = own.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count(F.lit(1)).alias("size")) \
        .where("lo < hi and size > 2").select("key")
    stars = settled(own.join(keys, "key").select("hub", "id", "c").distinct())
    rows = settled(stars.join(_merged(stars.select("hub", "id")), "hub").select("family", "id", "c").distinct())
    nearest = near.groupBy(F.col("a").alias("id")).agg(F.min(F.struct("far", "b"))["b"].alias("centre"))
    centres = _most(rows.join(nearest, "id").groupBy("family", "centre").agg(F.count(F.lit(1)).alias("k")), "family", "centre")
    rows = settled(rows.join(centres, "family", "left").select(
        F.coalesce("centre", "family").alias("family"), "id", "c").distinct())
    return rows.join(rows.groupBy("family").agg(F.count(F.lit(1)).alias("size")), "family")


def _numbers(column: pa.ChunkedArray) -> list[np.ndarray]:
    return [np.frombuffer(v.as_buffer(), np.uint64) for v in column]


def _elements(members: pa.Table, head: pa.Table) -> pa.Table:
    """The elements that several of these members have in their differences from
    the centre, with their numbers. What one in ``COMMON`` of a family has is among
    those of some part of it."""
    (h,) = _numbers(head["set_h"])
    made = [np.setxor1d(x, h, assume_unique=True) for x in _numbers(members["set_x"])]
    flat, often = np.unique(np.concatenate(made), return_counts=True)
    some = often >= max(2, len(made) // COMMON)
    flat, often = flat[some].view(np.int64), often[some].astype(np.int64)
    return pa.table([pa.array(np.full(len(flat), members["family"][0].as_py(), np.int64)), pa.array(flat), pa.array(often)],
                    names=["family", "element", "often"])


def _ordered(members: pa.Table, head: pa.Table, percent: int) -> pa.Table:
    """Elements of the members' differences with their places, rare ones first:
    the early ones (see step 4), and all of a member that is not linked to the centre
    but can be linked to one that is."""
    (h,) = _numbers(head["set_h"])
    common = head["common"][0].as_py() or []
    common = np.array(common, np.int64).view(np.uint64)
    by = np.argsort(common)
    values, rank = np.append(common[by], ~np.uint64(0)), np.append(by + 1, 0)
    less, more = 100 - percent, 100 + percent  # a share of less / more of both sizes may differ
    rows, flat, places, early, sizes = [], [], [], [], []
    for row, x in enumerate(_numbers(members["set_x"])):
        n, m = len(x), len(h)
        own = np.setxor1d(x, h, assume_unique=True)
        at = np.searchsorted(values[:-1], own)
        own = own[np.lexsort((own, np.where(values[at] == own, rank[at], 0)))]
        delta = len(own)
        linked = more * (n + m - delta) >= 2 * percent * (n + m)
        most = n * 100 // percent  # the size of the largest set that can be linked to this one
        # More than (delta + share * (centre - own size)) / 2 elements are common to a linked pair whose
        # other member is not linked to the centre; and all but as many as two linked sets can differ by.
        first = min(delta - (more * delta + less * (m - n)) // (2 * more), less * (n + most) // more + 1)
        whole = not linked and more * delta <= less * (n + most) + less * (most + m)
        keep = delta if whole else max(0, min(first, delta))
        rows.append(np.full(keep, row))
        flat.append(own[:keep])
        places.append(np.arange(keep))
        early.append(np.arange(keep) < first)
        sizes.append((n, delta, linked))
    take = np.concatenate(rows)
    sizes = np.array(sizes, np.int64)[take]
    return pa.table([*(members[c].take(pa.array(take)) for c in ("family", "id", "c")), pa.array(sizes[:, 0]),
                     pa.array(sizes[:, 1]), pa.array(np.concatenate(flat).view(np.int64)), pa.array(np.concatenate(places)),
                     pa.array(np.concatenate(early)), pa.array(sizes[:, 2].astype(bool))],
                    names=["family", "id", "c", "n", "delta", "element", "place", "early", "linked"])


def _differences(families: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The elements of the members' differences from their centres, as ``_ordered`` has
    them. What many of a family have is counted first; it is a short list, as each of
    its elements takes up so many of the members' differences."""
    salted = families.withColumn("salt", F.pmod(F.xxhash64("id"), F.floor(F.col("size") / SALT) + 1)).join(
        sets.select("id", F.col("set").alias("set_x")), "id").select("family", "salt", "id", "c", "set_x")
    # Under names of their own: cogrouped frames must not share columns.
    heads = families.select(F.col("family").alias("centre"), "size").distinct().join(
        sets.select(F.col("id").alias("centre"), F.col("set").alias("set_h")), "centre").withColumn(
        "salt", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("size") / SALT))))
    by = ["family", "salt"]
    to = ["centre", "salt"]
    found = salted.groupBy(*by).cogroup(heads.groupBy(*to)).applyInArrow(
        _elements, "family long, element long, often long")
    common = found.groupBy("family", "element").agg(F.sum("often").alias("often")).join(
        families.select("family", "size").distinct(), "family").where(
        F.col("often") >= F.greatest(F.lit(2), F.col("size") / COMMON)).groupBy("family").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("often", "element"))), lambda x: x["element"]).alias("common"))
    heads = heads.join(settled(common).withColumnRenamed("family", "centre"), "centre", "left").select(
        *to, "set_h", "common")
    return salted.groupBy(*by).cogroup(heads.groupBy(*to)).applyInArrow(
        lambda left, right: _ordered(left, right, percent),
        "family long, id long, c long, n long, delta long, element long, place long, early boolean, linked boolean")


def _family_pairs(families: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of members of a family, of different components, that may be linked."""
    elements = settled(_differences(families, sets, percent))
    keys = ["family", "element"]
    x, y = (elements.select(*keys, *(F.col(c).alias(f"{c}_{side}") for c in elements.columns if c not in keys))
            for side in ("x", "y"))
    both = x.where("not linked_x").join(y.where("early_y"), keys).where(
        f"c_x <> c_y and (linked_y or early_x and id_y < id_x) and "
        f"100 * least(n_x, n_y) >= {percent} * greatest(n_x, n_y) and "
        f"{100 + percent} * abs(delta_x - delta_y) <= {100 - percent} * (n_x + n_y) and "
        f"{100 + percent} * (delta_x + delta_y - 2 * least(delta_x - place_x, delta_y - place_y)) "
        f"<= {100 - percent} * (n_x + n_y)")
    # Members linked to the centre need not have met it under a key.
    own = elements.where("linked and id <> family").select(F.col("id").alias("id_x"), F.col("family").alias("id_y")).distinct()
    return both.select("id_x", "id_y").unionByName(own).select(
        F.greatest("id_x", "id_y").alias("a"), F.least("id_x", "id_y").alias("b")).distinct()


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = SHINGLE,
                    percent: int = PERCENT) -> DataFrame:
    """One row per document: key, ``n_shingles``, ``component_id`` (the least
    id that it reaches by links) and ``kept`` (whether that is its own)."""
    kind = docs.schema[key].dataType
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("t"))
    described = _described(rows, width).checkpoint()
    by_digest = described.where("digest is not null and id is not null").groupBy("digest").agg(
        F.min("id").alias("class"), F.max("n").alias("n"), F.max("sig").alias("sig"))
    classes = numbered(by_digest.checkpoint()).checkpoint()
    member_of = described.where("id is not null").select("id", "digest", "n").join(
        classes.select("digest", F.col("id").alias("class")), "digest", "left")
    # Rows with one id but several texts: their classes are linked.
    same_id = member_of.where("class is not null").groupBy("id").agg(
        F.min("class").alias("a"), F.max("class").alias("b"), F.count("*").alias("rows"))
    repeated = member_of.join(same_id.where("a < b or rows > 1").select("id", "a"), "id").where("class is not null") \
        .select("a", F.col("class").alias("b")).where("a < b").distinct()

    single = classes.select("id", "n", "sig")
    index = _index(classes.select("id", "sig"))
    live = index.groupBy("key").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most")
    members = index.join(live.select("key", "least"), "key").checkpoint()
    star = members.where("id <> least").select(F.col("id").alias("a"), F.col("least").alias("b")).distinct()
    near = settled(_near(star, single, percent))

    sets = _sets(rows, classes, _ends(near), width)
    groups = _grown(None, repeated)
    groups = _links(near, sets, groups, percent)
    families = settled(_families(members, near, groups))
    if not families.isEmpty():
        ids = families.select("id").unionByName(families.select(F.col("family").alias("id")))
        sets = _sets(rows, classes, ids, width, sets)
        rest = settled(_family_pairs(families, sets, percent))
        if not rest.isEmpty():
            groups = _grown(groups, _confirmed(rest, sets, percent))

    found = described.select("id", "n", "digest").join(classes.select("digest", F.col("id").alias("class")), "digest", "left")
    if groups is not None:
        found = found.join(groups.select(F.col("node").alias("class"), F.col("component")), "class", "left")
    else:
        found = found.withColumn("component", F.lit(None).cast("long"))
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "class", "id"))
    return found.select(F.col("id").cast(kind).alias(key), F.col("n").alias("n_shingles"),
                        component.cast(kind).alias("component_id"),
                        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
