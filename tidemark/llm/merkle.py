"""A Merkle manifest of a table: digests of rows, trees per group, and versions of single changed rows."""

from __future__ import annotations

from collections.abc import Iterable
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import durable

#: Leaves that one range of the ranking holds, about.
RANGE_ROWS = 1_000_000
_NODE = "tree string, at long, n long, digest string"


def row_digest(values: Iterable[Column]) -> Column:
    """SHA-256 of values one after the other: ``-`` for null, else UTF-8 byte count, ``:``, value."""
    spelled = []
    for value in values:
        text = value.cast("string")
        spelled.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*spelled), 256)


def digest(parts: Iterable[str]) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def depth(leaves: int, fan_out: int) -> int:
    """Levels above the leaves until one node is left."""
    levels, held = 0, 1
    while held < leaves:
        levels, held = levels + 1, held * fan_out
    return levels


class Versions:
    """A persistent tree over the nodes of an aligned block.

    Nodes are only ever appended: a digest and the numbers of the children.  A
    version is the number of its root.
    """

    def __init__(self, digests: list[str], levels: int, fan_out: int):
        self.levels, self.fan_out = levels, fan_out
        self.digests, self.children = list(digests), [()] * len(digests)
        row = list(range(len(digests)))
        for _ in range(levels):
            row = [self._add(tuple(row[i : i + fan_out])) for i in range(0, len(row), fan_out)]
        (self.first,) = row

    def _add(self, children: tuple[int, ...]) -> int:
        self.children.append(children)
        self.digests.append(digest(self.digests[c] for c in children))
        return len(self.children) - 1

    def ancestors(self, version: int, at: int) -> list[tuple[int, int]]:
        """From the root down: node, and the place of the child that leads to leaf ``at``."""
        out = []
        for level in range(self.levels - 1, -1, -1):
            place = at // self.fan_out**level % self.fan_out
            out.append((version, place))
            version = self.children[version][place]
        return out

    def siblings(self, version: int, at: int) -> list[str]:
        """From the leaf up, two texts a level: digests left of the path and right of it."""
        out = []
        for node, place in reversed(self.ancestors(version, at)):
            held = [self.digests[c] for c in self.children[node]]
            out += ["".join(held[:place]), "".join(held[place + 1 :])]
        return out

    def replaced(self, version: int, at: int, leaf: str) -> int:
        """The version in which leaf ``at`` has another digest: its ancestors are copied, all else is shared."""
        path = self.ancestors(version, at)
        self.children.append(())
        self.digests.append(leaf)
        new = len(self.children) - 1
        for node, place in reversed(path):
            old = self.children[node]
            new = self._add((*old[:place], new, *old[place + 1 :]))
        return new


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """Add ``at``, the rank of a row in its ``tree``, and ``n``, the rows of the tree.

    Rows are dealt by ranges of ``tree`` and ``order``; the ranges' counts are
    cumulated, and rows are numbered inside a range.  No window spans a tree.
    """
    total = rows.count()
    pieces = max(1, -(-total // RANGE_ROWS))
    dealt = durable(rows.repartitionByRange(pieces, "tree", *order).withColumn("part", F.spark_partition_id()))
    ahead = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("tree")
    parts = dealt.groupBy("tree", "part").agg(F.count("*").alias("c")).select(
        "tree", "part", F.coalesce(F.sum("c").over(ahead), F.lit(0)).alias("ahead"), F.sum("c").over(whole).alias("n")
    )
    inside = Window.partitionBy("tree", "part").orderBy(*order)
    numbered = dealt.withColumn("here", F.row_number().over(inside) - 1)
    return numbered.join(durable(parts), ["tree", "part"]).withColumn("at", F.col("here") + F.col("ahead")).drop("here", "ahead", "part")


def climb(nodes: DataFrame, fan_out: int, block_levels: int) -> tuple[list[DataFrame], DataFrame]:
    """Node tables ``tree, at, n, digest`` from the leaves up, a block of levels apart, and the roots ``tree, digest``."""
    span = fan_out**block_levels

    def fold(key, block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("at")
        n = int(block["n"].iloc[0])
        tree = Versions(block["digest"].tolist(), min(block_levels, depth(n, fan_out)), fan_out)
        return pd.DataFrame([(key[0], key[1], -(-n // span), tree.digests[tree.first])], columns=["tree", "at", "n", "digest"])

    tables = [nodes]
    while True:
        most = tables[-1].agg(F.max("n")).first()[0] or 0
        above = durable(
            tables[-1].select("tree", F.floor(F.col("at") / span).alias("block"), "at", "n", "digest").groupBy("tree", "block").applyInPandas(fold, _NODE)
        )
        if most <= span:
            return tables, above.select("tree", "digest")
        tables.append(above)


def descend(tables: list[DataFrame], tops: DataFrame, fan_out: int, block_levels: int) -> DataFrame:
    """Rows of the lowest table with ``path``, and ``version_root`` of the version that ``changed`` makes.

    ``tops`` has ``tree, path``: what stands beside the root of each tree further
    up.  Each block meets the path of its own root, which is one row.
    """
    span = fan_out**block_levels

    def of_block(lowest: bool):
        def versions(block: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
            block = block.sort_values("at")
            first = int(block["at"].iloc[0])
            tree = Versions(block["digest"].tolist(), min(block_levels, depth(int(block["n"].iloc[0]), fan_out)), fan_out)
            further = list(above["path"].iloc[0])
            paths, roots = [], []
            for at, own, new in zip(block["at"] - first, block["digest"], block["changed"], strict=True):
                paths.append(tree.siblings(tree.first, at) + further)
                root = None
                if lowest:
                    root = tree.digests[tree.replaced(tree.first, at, own if new is None else new)]
                    for left, right in zip(further[::2], further[1::2]):  # the version's copies in the blocks above
                        root = digest((left, root, right))
                roots.append(root)
            return block[["tree", "at", "key", "digest", "changed"]].assign(path=paths, version_root=roots)

        return versions

    upper = tops.select("tree", F.lit(0).cast("long").alias("at"), "path")
    for i in range(len(tables) - 1, -1, -1):
        table = tables[i]
        for name in ("key", "changed"):
            if name not in table.columns:
                table = table.withColumn(name, F.lit(None).cast("string"))
        done = (
            table.select("tree", F.floor(F.col("at") / span).alias("block"), "at", "n", "digest", "changed", "key")
            .groupBy("tree", "block")
            .cogroup(upper.groupBy("tree", "at"))
            .applyInPandas(
                of_block(lowest=i == 0),
                "tree string, at long, key string, digest string, changed string, path array<string>, version_root string",
            )
        )
        if i == 0:
            return done
        upper = durable(done.select("tree", "at", "path"))


def manifest(
    docs: DataFrame,
    fields: list[str],
    tree: str = "lang",
    order: str = "doc_id",
    changes: dict[str, Column] | None = None,
    where: Column | None = None,
    fan_out: int = 8,
    block_levels: int = 4,
) -> DataFrame:
    """``<order>, tree, leaf, changed_leaf, subroot, root, path, version_root`` for every row of ``docs``.

    A row's leaf is the digest of ``fields``.  The leaves of a ``tree`` ascend by
    ``order``; every ``fan_out`` nodes in succession become one (the last of a
    level of fewer, even of one) until one is left, the subroot.  Subroots ascend
    by the name of their tree, null first, and give the root alike.

    ``path`` has two texts a level, from the leaf to the root: the digests left
    and right of the path.  Where ``where`` holds, the columns named in
    ``changes`` take other values (null stays null): ``changed_leaf``.  Each
    changed leaf makes a version of its tree that shares all untouched nodes;
    ``version_root`` is that version's root.  A row without a change is folded
    with its own leaf, so its ``version_root`` proves the path.

    Trees are built in aligned blocks of ``fan_out ** block_levels`` nodes, each
    in one task: the blocks' roots are the nodes of the next table, and the path
    above a block's root is given back to its block, where the versions go on.
    So a task holds one block however large a tree is.

    Rows with a null number come first; rows that repeat a number ascend by their
    leaf.  A null tree is one of its own.  An empty table gives no row.
    """
    values = {f: F.col(f"`{f}`") for f in fields}
    changed = values | {f: F.when(values[f].isNotNull(), e) for f, e in (changes or {}).items()}
    is_changed = F.lit(False) if where is None else F.coalesce(where, F.lit(False))
    leaves = durable(
        docs.select(
            F.coalesce(F.concat(F.lit("="), F.col(f"`{tree}`").cast("string")), F.lit("-")).alias("tree"),
            F.col(f"`{order}`").alias("key"),
            row_digest(values.values()).alias("digest"),
            F.when(is_changed, row_digest(changed.values())).alias("changed"),
            F.monotonically_increasing_id().alias("row"),
        )
    )
    leaves = durable(ranked(leaves, ["key", "digest", "row"]).withColumn("key", F.col("key").cast("string")))
    tables, subroots = climb(leaves, fan_out, block_levels)
    names = durable(ranked(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest"), ["name"]))
    upper, roots = climb(names, fan_out, block_levels)
    whole = roots.select("tree", F.array().cast("array<string>").alias("path"))
    tops = descend([names.withColumn("key", F.col("name")), *upper[1:]], whole, fan_out, block_levels)
    known = names.join(roots.withColumnRenamed("digest", "root"), "tree").select(
        F.col("name").alias("tree"), F.col("digest").alias("subroot"), "root"
    )
    placed = descend(tables, durable(tops.select(F.col("key").alias("tree"), "path")), fan_out, block_levels)
    return placed.join(durable(known), "tree").select(
        F.col("key").cast(docs.schema[order].dataType).alias(order),
        F.when(F.col("tree") != "-", F.expr("substring(tree, 2)")).alias("tree"),
        F.col("digest").alias("leaf"),
        F.col("changed").alias("changed_leaf"),
        "subroot",
        "root",
        "path",
        "version_root",
    )
