"""Forests as tables: one row per node, walked level by level with joins.

Nodes are (tree, node, feature, threshold, left, right, value). ``left`` and
``right`` are node numbers of the same tree and NULL in a leaf; a row goes left
when its feature is at most the threshold. A root is nobody's child.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilth.session import materialize

NODE_COLUMNS = ("tree", "node", "feature", "threshold", "left", "right", "value")
#: Nodes of one level that are copied to every task; a level with more is joined by a shuffle.
BROADCAST_NODES = 1 << 19
#: Levels walked in one compiled method; with fifteen it nears the 8000 bytes beyond which the JVM interprets.
LEVELS_PER_METHOD = 4
#: More than a table's partitions, so that ``coalesce`` leaves them as they are and only parts the compiled code.
AS_THEY_ARE = 1 << 20
#: The two branches of a node and the lines that name them, in the order of the text.
IF, LEFT, ELSE, RIGHT = "0123"


def with_paths(nodes: DataFrame) -> DataFrame:
    """Adds ``path``, the branches from the root, and ``level``, how many; runs jobs.

    Each round joins a node with the ancestor it has reached so far and takes over the
    way of that one, so rounds grow with the logarithm of the depth.
    """
    children = nodes.where("left is not null").select(
        "tree",
        F.col("node").alias("up"),
        F.explode(F.array(*(F.struct(F.col(c).alias("node"), F.lit(p).alias("path")) for c, p in (("left", LEFT), ("right", RIGHT))))).alias("child"),
    )
    reached = children.select("tree", "child.node", "up", "child.path")
    own = nodes.select("tree", "node").join(reached, ["tree", "node"], "left").withColumn("path", F.coalesce("path", F.lit("")))
    own = materialize(own, "ways")
    while not own.where("up is not null").isEmpty():
        above = own.select("tree", F.col("node").alias("up"), F.col("up").alias("__up"), F.col("path").alias("__path"))
        own = own.join(above, ["tree", "up"], "left").select(
            "tree", "node", F.col("__up").alias("up"), F.concat(F.coalesce("__path", F.lit("")), "path").alias("path")
        )
        own = materialize(own, "ways")
    return nodes.join(own.select("tree", "node", "path"), ["tree", "node"]).withColumn("level", F.length("path"))


def walk(rows: DataFrame, nodes: DataFrame, features: Sequence[str], ids: Sequence[str], out: str = "prediction") -> DataFrame:
    """``ids`` and the mean of the leaves that a row reaches in all trees; runs jobs over the nodes.

    ``ids`` tell rows apart. All trees go down together, one join per level with that
    level's inner nodes; the values of a row are added up where they are before one
    number per row is shuffled. A NULL feature goes right. Without nodes there are no rows.
    """
    nodes = materialize(with_paths(nodes), "nodes")
    sizes = {r["level"]: r["n"] for r in nodes.where("left is not null").groupBy("level").agg(F.count("*").alias("n")).collect()}
    roots = [F.struct(F.lit(r["tree"]).alias("tree"), F.lit(r["node"]).alias("node")) for r in nodes.where("level = 0").select("tree", "node").collect()]
    if not roots:
        return rows.select(*ids, F.lit(0.0).alias(out)).limit(0)
    x = F.array(*(F.col(c).cast("double") for c in features))
    at = rows.select(*ids, x.alias("__x"), F.explode(F.array(*roots)).alias("__at")).select(*ids, "__x", "__at.*")
    for n, (level, size) in enumerate(sorted(sizes.items())):
        if n and n % LEVELS_PER_METHOD == 0:
            at = at.coalesce(AS_THEY_ARE)
        inner = nodes.where((F.col("level") == level) & F.col("left").isNotNull()).select("tree", "node", "feature", "threshold", "left", "right")
        inner = F.broadcast(inner) if size <= BROADCAST_NODES else inner
        side = F.when(F.get("__x", F.col("feature")) <= F.col("threshold"), F.col("left")).otherwise(F.col("right"))
        at = at.join(inner, ["tree", "node"], "left").select(*ids, "__x", "tree", F.coalesce(side, "node").alias("node"))
    leaves = nodes.where("left is null").select("tree", "node", "value")
    return at.drop("__x").join(leaves, ["tree", "node"]).groupBy(*ids).agg(F.avg("value").alias(out))


def tree_text(nodes: DataFrame) -> DataFrame:
    """(tree_id, tree): each tree's nodes on one line, parted by ``#``, from the root down; runs jobs.

    A text is as long as its tree, whatever the data it was learned from.
    """
    number = F.concat(F.lit("(feature "), F.col("feature").cast("string"))
    line = lambda sign: F.concat(number, F.lit(f" {sign} "), F.col("threshold").cast("string"), F.lit(")"))
    entry = lambda mark, text: F.struct(F.concat("path", F.lit(mark)).alias("place"), text.alias("line"))
    inner = F.array(entry(IF, F.concat(F.lit("If "), line("<="))), entry(ELSE, F.concat(F.lit("Else "), line(">"))))
    leaf = F.array(entry("", F.concat(F.lit("Predict: "), F.col("value").cast("string"))))
    lines = with_paths(nodes).select("tree", F.explode(F.when(F.col("left").isNull(), leaf).otherwise(inner)).alias("entry"))
    ordered = F.transform(F.array_sort(F.collect_list("entry")), lambda e: e["line"])
    return lines.groupBy(F.col("tree").alias("tree_id")).agg(F.array_join(ordered, "#").alias("tree"))


def forest_size(nodes: DataFrame) -> DataFrame:
    """(tree, n_nodes, n_leaves, depth) of each tree; runs jobs."""
    return with_paths(nodes).groupBy("tree").agg(
        F.count("*").alias("n_nodes"), F.count_if(F.col("left").isNull()).alias("n_leaves"), F.max("level").alias("depth")
    )
