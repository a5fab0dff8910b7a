"""Merkle manifest of a dataset: cogrouped subtree exchange.

Each row is a leaf; the leaves of a group (a language) in key order make a
tree of fan-out ``FANOUT``, and the groups' roots, in group order, one more
tree, whose root stands for the whole table.

1. Leaves get their positions (``ranked``) and are cut into superblocks of
   ``BLOCK`` consecutive ones. Each superblock is reduced to its top node by
   itself; tops are the nodes of the next round, until each tree has one.
2. The way back: nodes of a round and the outer nodes that they need (the path
   from their superblock's top to the root: one row for each superblock) are
   cogrouped by superblock in ``applyInPandas``, which repeats the local
   reduction, joins the local siblings with the outer ones and folds.

So no task sees more than ``BLOCK`` nodes and one path, whatever the size of a
group; a round has 1/512 of the nodes of the one before.

Defined results: a null value is ``-`` in its leaf; a null key sorts first
and a null group is a group of its own, the first; rows of one key
are ordered by their leaves (equal rows have equal leaves, but each its own
proof); an empty table gives no rows. Only key, group and leaf columns are
read, so extra columns may have any name.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranks import ranked

FANOUT = 8
HEIGHT = 3  # levels of a superblock
BLOCK = FANOUT ** HEIGHT
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(values: list[Column]) -> Column:
    """The leaf of a row: the digest of its values, each with its length in bytes."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.when(t.isNull(), "-").otherwise(F.concat(
        F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]), 256)


def levels(nodes: list[str], total: int) -> list[list[str]]:
    """The nodes of a superblock level by level up to its top, in a tree that
    has ``total`` nodes on the first of these levels."""
    out = [nodes]
    for _ in range(HEIGHT):
        if total <= 1:
            break
        total = -(-total // FANOUT)
        out.append([digest("".join(out[-1][i:i + FANOUT])) for i in range(0, len(out[-1]), FANOUT)])
    return out


def siblings(made: list[list[str]], place: int) -> list[str]:
    """For each level under the top the run of a node without the node itself,
    whose place is marked by ``|``."""
    path = []
    for nodes in made[:-1]:
        run = place // FANOUT * FANOUT
        path.append("".join(nodes[run:place]) + "|" + "".join(nodes[place + 1:run + FANOUT]))
        place //= FANOUT
    return path


def fold(node: str, path: list[str]) -> str:
    """The root that a node and its siblings give."""
    for step in path:
        node = digest(step.replace("|", node))
    return node


def _top(key: tuple, nodes: pd.DataFrame) -> pd.DataFrame:
    nodes = nodes.sort_values("position")
    total = int(nodes["total"].iloc[0])
    top = levels(nodes["node"].tolist(), total)[-1]
    assert len(top) == 1
    return pd.DataFrame({"tree": [key[0]], "position": [key[1]], "total": [-(-total // BLOCK)], "node": top})


def _rounds(nodes: DataFrame) -> list[DataFrame]:
    """Tables of nodes (tree, position, total, node): the given ones, their
    superblocks' tops and so on, down to one node for each tree."""
    out = [nodes]
    while True:
        largest = out[-1].agg(F.max("total")).first()[0]
        if largest is None or largest == 1:
            return out
        tops = out[-1].select("tree", "position", "total", "node").groupBy(
            "tree", F.floor(F.col("position") / BLOCK).alias("block")).applyInPandas(
            _top, "tree string, position long, total long, node string")
        out.append(tops.checkpoint())


_PATH = "path array<string>, subroot string, root string"


def _joined(key: tuple, nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    """Local reduction, proofs and folds of one superblock."""
    nodes = nodes.sort_values("position")
    made = levels(nodes["node"].tolist(), int(nodes["total"].iloc[0]))
    above = list(outer["path"].iloc[0])
    paths = [siblings(made, i) + above for i in range(len(nodes))]
    nodes = nodes.assign(path=paths, root=outer["root"].iloc[0], subroot=outer["subroot"].iloc[0])
    if "given" in nodes:
        nodes["folded"] = [fold(g, p) for g, p in zip(nodes["given"], paths, strict=True)]
    return nodes


def _down(nodes: DataFrame, outer: DataFrame, keep: str) -> DataFrame:
    """The nodes with their paths to the root, given those of their superblocks' tops."""
    block = F.floor(F.col("position") / BLOCK).alias("block")
    names = [c.split()[0] for c in (keep + ", " + _PATH).split(", ")]

    def run(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return _joined(key, left, right)[names]

    return nodes.groupBy("tree", block).cogroup(
        outer.groupBy("tree", F.col("position").alias("block"))).applyInPandas(run, f"{keep}, {_PATH}")


def _paths(rounds: list[DataFrame], outer: DataFrame) -> DataFrame:
    """Paths (tree, position) of the second table of ``rounds``, from those of the last."""
    for nodes in reversed(rounds[1:-1]):
        outer = _down(nodes, outer, "tree string, position long").checkpoint()
    return outer


def manifest(docs: DataFrame, key: str = "doc_id", group: str = "lang", columns: tuple[str, ...] = COLUMNS,
             given: Column | None = None) -> DataFrame:
    """One row per row of ``docs``: key, ``leaf``, ``subroot`` (of its group),
    ``root``, ``proof`` (the siblings of each level, with ``|`` at the node's own
    place) and ``folded_root``: what the proof makes of the leaf ``given`` (an
    expression over ``docs``; by default the leaf itself)."""
    kind = docs.schema[key].dataType
    tree = F.when(F.col(group).isNull(), "-").otherwise(F.concat(F.lit(":"), F.col(group).cast("string")))
    leaf = leaf_of([F.col(c) for c in columns])
    rows = docs.select(F.col(key).alias("key"), tree.alias("tree"), leaf.alias("node"),
                       (leaf if given is None else given).alias("given")).checkpoint()
    leaves = ranked(rows, "tree", ["key", "node"]).checkpoint()
    rounds = _rounds(leaves)
    subroots = rounds[-1].select("tree", F.col("node").alias("subroot"))
    upper = ranked(subroots, None, ["tree"]).select(
        F.lit("").alias("tree"), "position", "total", F.col("subroot").alias("node"),
        F.col("tree").alias("group")).checkpoint()
    tops = _rounds(upper)
    root = tops[-1].select("tree", "position", F.array().cast("array<string>").alias("path"),
                           F.lit(None).cast("string").alias("subroot"), F.col("node").alias("root"))
    if len(tops) == 1:  # one group at most: its subroot is the root
        outer = upper.select("group", F.array().cast("array<string>").alias("path"), F.col("node").alias("root"))
    else:
        outer = _down(upper, _paths(tops, root), "group string")
    outer = outer.withColumnRenamed("group", "tree")
    outer = outer.select("tree", "path", "root").join(subroots, "tree").select(
        "tree", F.lit(0).cast("long").alias("position"), "path", "subroot", "root")
    if len(rounds) == 1:
        # No group has two rows: the one superblock of each has no level of its own.
        rounds = [*rounds, rounds[-1]]
    names = f"key {kind.simpleString()}, node string, folded string"
    return _down(leaves, _paths(rounds, outer), names).select(
        F.col("key").alias(key), F.col("node").alias("leaf"), "subroot", "root", F.col("path").alias("proof"),
        F.col("folded").alias("folded_root"))


def tampering_report(docs: DataFrame) -> DataFrame:
    """The manifest, checked against rows of which each third (by the key's
    crc32) has its text lower-cased."""
    changed = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    text = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, changed).otherwise(F.col("text"))
    given = leaf_of([text if c == "text" else F.col(c) for c in COLUMNS])
    return manifest(docs, given=given).select(
        "doc_id", "leaf", "subroot", "root",
        F.sha2(F.translate(F.concat_ws("", "proof"), "|", ""), 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
