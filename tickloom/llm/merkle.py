"""A Merkle manifest of a dataset: a tree of sha256 digests per group, one tree over the groups' roots,
and for every row the siblings that lead from its leaf to the root.

Nodes of a level stand in order, and each run of FAN consecutive ones is hashed into a parent. A window
over one run holds, as columns, the digests at every fixed offset before and after a row (lag and lead),
masked by the row's slot and the run's length: those are the row's siblings, and on the first row of a run
they are all that its parent is made of. A window partition is a run, so it never holds more than FAN
rows, and it is partitioned as the join with the parents is, so siblings never travel.

Rows are numbered by one range sort: the place inside a sorted partition plus the rows of the same group in
the partitions before. A group that holds a third of all rows is spread like any other, and rows that are
equal in everything are told apart by a written row number.

The driver holds one number (the largest count of nodes) per level, and the root.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import numbered, union_all, written

FAN = 16
_PATH = "array<struct<before:string,after:string>>"


def field(value: Column) -> Column:
    """`-` for null, else UTF-8 byte count, colon, value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf(*values: Column) -> Column:
    """The digest of a row, from its values in this order."""
    return digest(*[field(v) for v in values])


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf leads to with the siblings of a path."""
    return F.aggregate(path, start, lambda node, at: digest(at["before"], node, at["after"]))


def proof(path: Column) -> Column:
    """The digest of all siblings, level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda at: F.concat(at["before"], at["after"])), ""))


def _slotted(nodes: DataFrame) -> DataFrame:
    """Nodes (key, place, n, node, ..) with `run`, `slot` and their siblings `before` and `after`."""
    run = "OVER (PARTITION BY key, run ORDER BY slot)"
    length = f"least({FAN}, n - run * {FAN})"
    before = [f"CASE WHEN slot >= {k} THEN lag(node, {k}) {run} END" for k in range(FAN - 1, 0, -1)]
    after = [f"CASE WHEN slot + {k} < {length} THEN lead(node, {k}) {run} END" for k in range(1, FAN)]
    placed = nodes.selectExpr("*", f"place div {FAN} AS run", f"place % {FAN} AS slot")
    return placed.selectExpr(
        "*", f"concat_ws('', {', '.join(before)}) AS before", f"concat_ws('', {', '.join(after)}) AS after"
    )


def _parents(slotted: DataFrame) -> DataFrame:
    up = ["key", "run AS place", f"(n + {FAN - 1}) div {FAN} AS n", "sha2(concat(node, after), 256) AS node"]
    return slotted.where("slot = 0").selectExpr(*up)


@dataclass
class _Trees:
    """The trees of all groups: the nodes of each level from the leaves up, with their siblings, and those
    that are a group's root."""

    levels: list[DataFrame]
    roots: list[DataFrame]

    def root_nodes(self) -> DataFrame:
        return union_all([r.select("key", "node") for r in self.roots])


def _grown(leaves: DataFrame) -> _Trees:
    """Trees over leaves (key, place, n, node, ..). A level above holds a sixteenth of the rows and is written
    with its siblings; those of the leaves are found anew by whoever needs them, which is less than keeping them."""
    largest, nodes = leaves.agg(F.max("n").alias("n")).first()["n"] or 1, leaves
    trees = _Trees([], [])
    while True:
        trees.roots.append(nodes.where("n = 1"))
        if largest == 1:
            return trees
        slotted = _slotted(nodes.where("n > 1"))
        trees.levels.append(written(slotted, "level") if trees.levels else slotted)
        nodes, largest = _parents(trees.levels[-1]), -(-largest // FAN)


def _paths(trees: _Trees, top: DataFrame) -> DataFrame:
    """The leaves with `path`: their own siblings, those of the node above, and so on, then the path that
    `top` (key, path, ..) gives for the group. Other columns of `top` come along."""
    carried = [c for c in top.columns if c not in ("key", "path")]
    above = None
    for level in range(len(trees.roots) - 1, -1, -1):
        alone = trees.roots[level]
        names = alone.columns if level == 0 else ["key", "place"]
        paths = [alone.join(top, "key").select(*names, "path", *carried)]
        if above is not None:
            up = above.select("key", F.col("place").alias("run"), F.col("path").alias("rest"), *carried)
            path = F.concat(F.array(F.struct("before", "after")), F.col("rest"))
            inner = trees.levels[level].join(up, ["key", "run"])
            paths.append(inner.select(*names, path.alias("path"), *carried))
        above = union_all(paths)
        if level == 1:
            above = written(above, "paths")
    return above


def manifest(rows: DataFrame, group: str, order: list[str], leaf_column: str) -> DataFrame:
    """The rows with `path`, `subroot` and `root`, all other columns as they are.

    `rows` has the digest of each row in `leaf_column`. Groups are ordered with null first, then by their UTF-8
    bytes; a null group is one of its own. Rows of a group ascend by the `order` columns, null first, and then by
    their digest, so rows that share an id have one order. An empty table gives no rows. The columns key, place, n,
    node, run, slot, before, after, path, subroot, root and those that begin with an underscore are taken.
    """
    key = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("-"))
    ordered = [c for c in order if c != leaf_column]
    given = rows.withColumns({"key": key, "node": F.col(leaf_column)})
    leaves = written(numbered(given, [*ordered, "node"]), "leaves")
    trees = _grown(leaves)
    subroots = written(trees.root_nodes().select(F.lit("").alias("key"), F.col("key").alias("name"), "node"), "subroots")
    upper = _grown(written(numbered(subroots, ["name"]), "groups"))
    found = upper.root_nodes().first()
    over = _paths(upper, _no_path(rows, found["node"] if found else None))
    top = written(over.select(F.col("name").alias("key"), "path", F.col("node").alias("subroot"), "root"), "tops")
    return _paths(trees, top).select(*[F.col(f"`{c}`") for c in rows.columns], "path", "subroot", "root")


def _no_path(rows: DataFrame, root: str | None) -> DataFrame:
    """What lies above the root of all: one row."""
    return rows.sparkSession.createDataFrame([("", [], root)], f"key string, path {_PATH}, root string")
