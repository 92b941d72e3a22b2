"""Merkle manifest of a table, and the proofs of all its rows by octopus multiproofs.

Every row is a leaf. The leaves of a group, in order, form a tree whose nodes are hashes of up to
``FAN`` children; the groups' roots, in order, form another tree, whose root names the whole table.

Proofs are made per block of ``BLOCK`` consecutive leaves. A block first computes, level by level,
the smallest set of nodes that it can't derive from its own leaves (an octopus multiproof), fetches
those once by a join with the table of nodes, derives the interior nodes that its leaves share, and
expands from them each leaf's own proof. A block may hold a slice of a large group or many small
groups, so no group is ever gathered.

A null in any column is hashed as ``-``, an empty text as ``0:``; texts are hashed whole, whatever
their length, by the JVM. Null groups come first, null ids first inside a group; rows that share an
id are leaves of their own, ordered by their hash, and repeated rows are equal leaves beside each
other. An empty table has no root and no proofs. Columns other than the hashed ones are ignored,
whatever their names.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oreflow.llm.common import ascii_lower
from oreflow.llm.numbering import numbered
from oreflow.session import materialise

# Fixed value: children of a node.
FAN = 16
# Leaves of one multiproof.
BLOCK = 4096
# The number that the tree over the groups' roots goes by; other trees go by the place of their first leaf.
TOP = -1

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
NEEDED = "block long, tree long, level int, at long"
PROOFS = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


@dataclass(frozen=True)
class Manifest:
    """``leaves`` with their addresses, ``nodes`` (tree, level, at, hash) of all levels, number of ``groups``, ``root``."""

    leaves: DataFrame
    nodes: DataFrame
    groups: int
    root: str | None


def leaf_hash(columns: list[Column]) -> Column:
    """The hash of a row: each value with its length in bytes before it, a null as ``-``."""

    def part(column: Column) -> Column:
        text = column.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*(part(c) for c in columns)), 256)


def tampered(docs: DataFrame) -> Column:
    """The hash of a row whose text was lower-cased, for those rows where it is (every fifth or so); else null."""
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return F.when(chosen, leaf_hash([ascii_lower(F.col(c)) if c == "text" else F.col(c) for c in COLUMNS]))


def _parents(level: DataFrame) -> DataFrame:
    """The nodes above ``level`` (tree, size, at, hash); of each tree, ``size`` is the number of nodes of the level."""
    grouped = (
        level.where("size > 1")
        .groupBy("tree", F.ceil(F.col("size") / FAN).alias("size"), F.floor(F.col("at") / FAN).alias("at"))
        .agg(F.sort_array(F.collect_list(F.struct(F.col("at").alias("child"), "hash"))).alias("children"))
    )
    return grouped.select("tree", "size", "at", F.sha2(F.array_join("children.hash", ""), 256).alias("hash"))


def _grown(leaves: DataFrame, largest: int) -> list[DataFrame]:
    """All levels of all trees, from the leaves up; ``largest`` is the size of the largest tree."""
    levels = [leaves]
    while largest > 1:
        largest = -(-largest // FAN)
        levels.append(materialise(_parents(levels[-1]), "nodes"))
    return levels


def build(docs: DataFrame, claimed: Column | None = None, columns: tuple[str, ...] = COLUMNS, group: str = "source", order: str = "doc_id") -> Manifest:
    """The manifest of ``docs``. ``claimed`` is the hash that a row is said to have, where that is not its own."""
    hashed = materialise(
        docs.select(
            F.col(order).cast("long").alias("doc_id"),
            F.col(group).cast("string").alias("group"),
            leaf_hash([F.col(c) for c in columns]).alias("leaf"),
            (F.lit(None).cast("string") if claimed is None else claimed).alias("claimed"),
        ),
        "hashed",
    )
    placed = numbered(hashed, ["group", "doc_id", "leaf"], "sorted-leaves")
    # Where groups begin and how large they are, from one row per group and range: a hot group has a row per range.
    bounds = placed.groupBy("group", "part").agg(F.min("place").alias("low"), F.count("*").alias("n"))
    whole = Window.partitionBy("group")
    bounds = materialise(bounds.select("group", "part", F.min("low").over(whole).alias("tree"), F.sum("n").over(whole).alias("size")), "bounds")
    trees = numbered(bounds.select("tree", "size").distinct(), ["tree"], "trees").select("tree", "size", F.col("place").alias("top"))
    groups, largest = trees.agg(F.count("*"), F.max("size")).first()
    found = bounds.join(trees.drop("size"), "tree").select(F.col("group").alias("g"), F.col("part").alias("p"), "tree", "size", "top")
    leaves = materialise(
        placed.join(found, F.col("group").eqNullSafe(F.col("g")) & (F.col("part") == F.col("p"))).select(
            "doc_id", "leaf", "claimed", "place", "tree", "size", "top", (F.col("place") - F.col("tree")).alias("at")
        ),
        "leaves",
    )
    levels = _grown(leaves.select("tree", "size", "at", F.col("leaf").alias("hash")), largest or 0)
    roots = levels[0].where("size = 1")
    for level in levels[1:]:
        roots = roots.unionByName(level.where("size = 1"))
    top = roots.join(trees.select("tree", "top"), "tree").select(
        F.lit(TOP).cast("long").alias("tree"), F.lit(groups).cast("long").alias("size"), F.col("top").alias("at"), "hash"
    )
    upper = _grown(materialise(top, "group-roots"), groups)
    nodes = None
    for tier in (levels, upper):
        for number, level in enumerate(tier):
            rows = level.select("tree", F.lit(number).alias("level"), "at", "hash")
            nodes = rows if nodes is None else nodes.unionByName(rows)
    root = upper[-1].select("hash").first()
    return Manifest(leaves, nodes, groups, root["hash"] if root else None)


def missing(known: np.ndarray, size: int) -> list[np.ndarray]:
    """For each level of a tree of ``size`` leaves, the nodes that the ``known`` leaves' paths need and can't derive."""
    levels = []
    while size > 1:
        runs = np.unique(known // FAN)
        members = (runs[:, None] * FAN + np.arange(FAN)).ravel()
        levels.append(np.setdiff1d(members[members < size], known, assume_unique=True))
        known, size = runs, -(-size // FAN)
    return levels


def _needs(groups: int):
    def coordinates(key: tuple, leaves: pd.DataFrame) -> pd.DataFrame:
        wanted = [(int(tree), own["at"].to_numpy(), int(own["size"].iloc[0])) for tree, own in leaves.groupby("tree")]
        wanted.append((TOP, leaves["top"].unique(), groups))
        parts = []
        for tree, known, size in wanted:
            for level, at in enumerate(missing(np.unique(known), size)):
                parts.append(pd.DataFrame({"block": key[0], "tree": tree, "level": level, "at": at}))
        return pd.concat([pd.DataFrame({"block": [], "tree": [], "level": [], "at": []}, dtype="int64"), *parts])

    return coordinates


class _Tree:
    """A tree as far as a block needs it: the children of each node on the block's paths, as one text."""

    def __init__(self, known: dict[int, str], size: int, fetched: dict[tuple[int, int], str]):
        self.runs: list[dict[int, str]] = []
        level = 0
        while size > 1:
            joined, above = {}, {}
            for run in dict.fromkeys(at // FAN for at in known):
                ends = min(size, (run + 1) * FAN)
                joined[run] = "".join(known[at] if at in known else fetched[level, at] for at in range(run * FAN, ends))
                above[run] = hashlib.sha256(joined[run].encode()).hexdigest()
            self.runs.append(joined)
            known, size, level = above, -(-size // FAN), level + 1
        self.root = known[0]
        self._rest: dict[tuple[int, int], str] = {}

    def siblings(self, at: int, level: int = 0) -> str:
        """The other nodes of the runs on the way up, level by level."""
        if level == len(self.runs):
            return ""
        if (level, at) not in self._rest:
            run, place = self.runs[level][at // FAN], 64 * (at % FAN)
            own = run[:place] + run[place + 64 :] + self.siblings(at // FAN, level + 1)
            if level == 0:
                return own
            self._rest[level, at] = own
        return self._rest[level, at]

    def fold(self, value: str, at: int) -> str:
        """The root that ``value`` in the place of a leaf leads to."""
        for runs in self.runs:
            run, place = runs[at // FAN], 64 * (at % FAN)
            value = hashlib.sha256((run[:place] + value + run[place + 64 :]).encode()).hexdigest()
            at //= FAN
        return value


def _expand(groups: int):
    def proofs(leaves: pd.DataFrame, nodes: pd.DataFrame) -> pd.DataFrame:
        fetched: dict[int, dict[tuple[int, int], str]] = {}
        for tree, level, at, value in zip(nodes["tree"], nodes["level"], nodes["at"], nodes["hash"], strict=True):
            fetched.setdefault(tree, {})[level, at] = value
        trees, tops = {}, {}
        for tree, own in leaves.groupby("tree"):
            trees[tree] = _Tree(dict(zip(own["at"].tolist(), own["leaf"], strict=True)), int(own["size"].iloc[0]), fetched.get(tree, {}))
            tops[int(own["top"].iloc[0])] = trees[tree].root
        top = _Tree(tops, groups, fetched.get(TOP, {}))
        rows = []
        for doc_id, leaf, claimed, tree, at, place in zip(*(leaves[c].tolist() for c in ("doc_id", "leaf", "claimed", "tree", "at", "top")), strict=True):
            own = trees[tree]
            proof = hashlib.sha256((own.siblings(at) + top.siblings(place)).encode()).hexdigest()
            folded = top.fold(own.fold(claimed or leaf, at), place)
            rows.append((doc_id, leaf, own.root, top.root, proof, folded, folded == top.root))
        out = pd.DataFrame(rows, columns=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])
        return out.astype({"doc_id": "Int64"})

    return proofs


def prove(manifest: Manifest, leaves: DataFrame | None = None, block: int = BLOCK) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of ``leaves``: all of the manifest, or some.

    ``folded_root`` is where the claimed hash leads with the leaf's siblings; a row is verified if that is the root.
    """
    leaves = manifest.leaves if leaves is None else leaves
    blocks = leaves.withColumn("block", F.floor(F.col("place") / block))
    wanted = blocks.select("block", "tree", "size", "at", "top").groupBy("block").applyInPandas(_needs(manifest.groups), NEEDED)
    found = wanted.join(manifest.nodes, ["tree", "level", "at"])
    # New columns: two sides of one cogroup must not share any.
    fetched = found.select((F.col("block") + 0).alias("to"), "tree", "level", "at", "hash")
    return (
        blocks.select("block", F.col("doc_id"), "leaf", "claimed", "tree", "size", "at", "top")
        .groupBy("block")
        .cogroup(fetched.groupBy("to"))
        .applyInPandas(_expand(manifest.groups), PROOFS)
    )


def digest(docs: DataFrame) -> DataFrame:
    """The proofs of all documents, those of every fifth or so from a lower-cased text."""
    return prove(build(docs, tampered(docs)))
