"""Merkle manifest of a table: one tree per group of rows, and a tree over their roots.

Checkpoint and recompute: of a tree only every third level is written (``STRIDE``). A written
node stands for an aligned subtree of up to 512 written nodes below it. To prove leaves, each
subtree is taken again from its stored nodes, the levels between are hashed anew, the siblings
are put out, and the levels are dropped. Proofs go down from the root, so what is above a
subtree is found once for all its leaves.

Positions come from a range-partitioned sort of ids and digests; no text moves, and no task holds
more than one subtree. The last hash of all takes one digest per eight groups, and so on.

Defined cases: a null field is ``-``, so null and empty differ; null ids come first, rows with
one id follow each other by leaf digest; identical rows are leaves of their own; a null group is a
group; the tree of one leaf is the leaf; an empty table has no root and an empty result; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from paperloom.llm.common import numbered
from paperloom.operators.rank import ranked
from paperloom.session import stage_table

FANOUT = 8
# Levels from one written level to the next.
STRIDE = 3
SUBTREE = FANOUT**STRIDE

NODES = "tree string, pos long, n long, digest string"
PATHS = "tree string, pos long, before array<string>, after array<string>"
PROVEN = "row_id long, proof_sha256 string, folded_root string"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def field(value: Column) -> Column:
    """``-`` for null, else the bytes of the value as text, counted in front."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


# --- one subtree ----------------------------------------------------------------------


def levels(nodes: list[str], n: int) -> list[list[str]]:
    """The written ``nodes`` of a subtree and all levels up to its top; ``n`` is how many nodes the
    whole tree has on the written level."""
    found = [nodes]
    while len(found) <= STRIDE if n > SUBTREE else len(found[-1]) > 1:
        below = found[-1]
        found.append([digest("".join(below[i : i + FANOUT])) for i in range(0, len(below), FANOUT)])
    return found


def siblings(found: list[list[str]], place: int) -> Iterator[tuple[str, str]]:
    """What stands before and after the node at ``place`` in its run, level by level."""
    for level in found[:-1]:
        first = place - place % FANOUT
        yield "".join(level[first:place]), "".join(level[place + 1 : first + FANOUT])
        place //= FANOUT


def fold(node: str, path: list[tuple[str, str]]) -> str:
    for before, after in path:
        node = digest(before + node + after)
    return node


# --- the trees ------------------------------------------------------------------------


def _top_of(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("pos")
    n = int(rows["n"].iloc[0])
    top = levels(list(rows["digest"]), n)[-1][0]
    return pd.DataFrame([(key[0], key[1], -(-n // SUBTREE), top)], columns=["tree", "pos", "n", "digest"])


def _subtree() -> Column:
    return F.floor(F.col("pos") / SUBTREE).cast("long").alias("subtree")


def written_levels(nodes: DataFrame) -> list[DataFrame]:
    """``nodes`` (tree, pos, n, digest) and every ``STRIDE``-th level above, up to one node per
    tree. The driver sees the size of the largest tree, once per written level."""
    kept = [nodes]
    while (nodes.agg(F.max("n")).first()[0] or 1) > 1:
        above = nodes.groupBy("tree", _subtree()).applyInPandas(_top_of, NODES)
        nodes = stage_table(above, "merkle-level")
        kept.append(nodes)
    return kept


def _subtree_of(nodes: pd.DataFrame, above: pd.DataFrame) -> tuple[pd.DataFrame, list, list]:
    """Nodes in order, the levels of their subtree, and the path from its top to the root."""
    nodes = nodes.sort_values("pos")
    found = levels(list(nodes["digest"]), int(nodes["n"].iloc[0]))
    return nodes, found, list(zip(above["before"].iloc[0], above["after"].iloc[0]))


def _paths(key: tuple, nodes: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
    nodes, found, rest = _subtree_of(nodes, above)
    rows = []
    for place, pos in enumerate(nodes["pos"]):
        path = [*siblings(found, place), *rest]
        rows.append((key[0], pos, [b for b, _ in path], [a for _, a in path]))
    return pd.DataFrame(rows, columns=["tree", "pos", "before", "after"])


def _proofs(key: tuple, nodes: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
    nodes, found, rest = _subtree_of(nodes, above)
    rows = []
    for place, (row_id, node) in enumerate(zip(nodes["row_id"], nodes["shown"])):
        path = [*siblings(found, place), *rest]
        rows.append((row_id, digest("".join(b + a for b, a in path)), fold(node, path)))
    return pd.DataFrame(rows, columns=["row_id", "proof_sha256", "folded_root"])


def _with_paths(nodes: DataFrame, above: DataFrame, run, schema: str) -> DataFrame:
    """Each subtree of ``nodes`` with the path of its top."""
    tops = above.withColumnRenamed("pos", "subtree")
    subtrees = nodes.withColumn("subtree", _subtree()).groupBy("tree", "subtree")
    return subtrees.cogroup(tops.groupBy("tree", "subtree")).applyInPandas(run, schema)


def paths_down(kept: list[DataFrame], tops: DataFrame, until: int) -> DataFrame:
    """The paths of the nodes of ``kept[until]``, from those of the ``tops`` of the trees."""
    for nodes in reversed(kept[until:-1]):
        tops = stage_table(_with_paths(nodes, tops, _paths, PATHS), "merkle-paths")
    return tops


# --- the manifest ---------------------------------------------------------------------


@dataclass
class Manifest:
    """``leaves``: row_id, kept, tree, pos, n, digest, shown. ``kept``: the written levels of the
    trees. ``subroots``: tree, subroot, and its place ``at`` among all. ``over``: the written levels of
    the tree over the subroots."""

    leaves: DataFrame
    kept: list[DataFrame]
    subroots: DataFrame
    over: list[DataFrame]
    root: str | None


def manifest(rows: DataFrame, group: Column, order_by: Column, leaf_of: Column, shown: Column, keep: list[str]) -> Manifest:
    """The manifest of ``rows``: a tree per ``group`` with its leaves by ``order_by``. ``shown`` is
    the leaf that a holder of the row presents for verification, null where it is ``leaf_of``."""
    leaves = numbered(
        rows.select(
            F.struct(*keep).alias("kept"),
            group.alias("group"),
            field(group).alias("tree"),
            order_by.alias("place"),
            leaf_of.alias("digest"),
            shown.alias("shown"),
        ),
        "merkle-leaves",
    )
    sizes = leaves.groupBy("tree").agg(F.count(F.lit(1)).alias("n"), F.first("group").alias("group"))
    places = ranked(leaves, [F.col("place"), F.col("digest"), F.col("row_id")], ("tree",), "pos")
    placed = places.withColumn("pos", F.col("pos") - 1).drop("place", "group").join(sizes.drop("group"), "tree")
    placed = stage_table(placed.withColumn("shown", F.coalesce("shown", "digest")), "merkle-placed")
    kept = written_levels(placed.select("tree", "pos", "n", "digest"))
    subroots = sizes.drop("n").join(kept[-1].select("tree", F.col("digest").alias("subroot")), "tree")
    in_order = ranked(subroots, [F.col("group")], rank_col="at").select("tree", "subroot", (F.col("at") - 1).alias("at"))
    subroots = stage_table(in_order, "merkle-subroots")
    number = F.lit(subroots.count()).cast("long").alias("n")
    over = written_levels(
        subroots.select(F.lit("").alias("tree"), F.col("at").alias("pos"), number, F.col("subroot").alias("digest"))
    )
    root = over[-1].first()
    return Manifest(placed, kept, subroots, over, root["digest"] if root else None)


def prove(found: Manifest) -> DataFrame:
    """Every leaf's siblings as one digest (``proof_sha256``), and the root that the ``shown`` leaf
    folds to with them."""
    nothing = F.array().cast("array<string>")
    top = found.over[-1].select("tree", "pos", nothing.alias("before"), nothing.alias("after"))
    over = paths_down(found.over, top, 0).withColumnRenamed("pos", "at").drop("tree")
    of_trees = found.subroots.join(over, "at").select("tree", F.lit(0).cast("long").alias("pos"), "before", "after")
    tops = stage_table(of_trees, "merkle-paths")
    lowest = paths_down(found.kept, tops, 1)
    leaves = found.leaves.select("row_id", "tree", "pos", "n", "digest", "shown")
    proven = _with_paths(leaves, lowest, _proofs, PROVEN)
    kept = found.leaves.select("row_id", "tree", "kept", F.col("digest").alias("leaf"))
    joined = kept.join(found.subroots.select("tree", "subroot"), "tree").join(proven, "row_id")
    root = F.lit(found.root).cast("string")
    return joined.select(
        "kept.*",
        "leaf",
        "subroot",
        root.alias("root"),
        "proof_sha256",
        "folded_root",
        (F.col("folded_root") == root).alias("verified"),
    )
