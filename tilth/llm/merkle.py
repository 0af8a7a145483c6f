"""Merkle manifest of a table by lag and lead windows.

Rows are leaves, numbered inside their group. On each level a window over a run of ``FAN``
nodes gives fixed-offset lag and lead columns; masked by the node's slot and the length of
its run they are its siblings, and the run's first row hashes the parent. Paths come down
again level by level: a node's siblings and the path of its parent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tilth.llm.common import written

FAN = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def record(*values: Column) -> Column:
    """Values as one string that tells them apart: UTF-8 byte count, colon, value; ``-`` for null."""
    texts = [v.cast("string") for v in values]
    return F.concat(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts))


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and the siblings of its path give."""
    return F.aggregate(path, start, lambda digest, s: F.sha2(F.concat(s["left"], digest, s["right"]), 256))


def proof_text(path: Column) -> Column:
    """All siblings of a path, level by level, from left to right."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """The rows with ``idx``, their place in the order of their ``key``, and ``n``, the key's rows; runs jobs.

    Ranges of (key, order) are sorted on their own; the ranges that hold rows of a key add up
    before each of them, so a key that holds much of the table is in many tasks.
    """
    spread = rows.repartitionByRange("key", *order).sortWithinPartitions("key", *order)
    spread = written(spread.withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.shiftright("at", 33)), "ranges")
    ranges = spread.groupBy("key", "part").agg(F.min("at").alias("first"), F.count("*").alias("rows"))
    own = W.partitionBy("key")
    ahead = own.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    base = (F.coalesce(F.sum("rows").over(ahead), F.lit(0)) - F.col("first")).alias("base")
    ranges = written(ranges.select("key", "part", base, F.sum("rows").over(own).alias("n")), "bases")
    placed = spread.join(ranges, ["key", "part"]).withColumn("idx", F.col("base") + F.col("at"))
    return placed.select(*rows.columns, "idx", "n")


def beside(nodes: DataFrame) -> DataFrame:
    """Adds ``run``, the run of a node, and ``left`` and ``right``, the joined digests of its siblings there."""
    run = F.expr(f"idx div {FAN}")
    slot, length = F.col("idx") % FAN, F.least(F.lit(FAN), F.col("n") - F.col("run") * FAN)
    w = W.partitionBy("key", "run").orderBy("idx")
    left = [F.when(slot >= o, F.lag("digest", o).over(w)).otherwise("") for o in range(FAN - 1, 0, -1)]
    right = [F.when(slot + o < length, F.lead("digest", o).over(w)).otherwise("") for o in range(1, FAN)]
    return nodes.withColumn("run", run).withColumns({"left": F.concat(*left), "right": F.concat(*right)})


def levels(leaves: DataFrame) -> list[DataFrame]:
    """``leaves`` (key, idx, n, digest, ...), a written table, and the levels of parents above it; runs a job for each.

    A key's last node has n = 1, on the level where its tree ends.
    """
    found = [leaves]
    widest = leaves.agg(F.max("n")).first()[0] or 0
    while widest > 1:
        runs = beside(found[-1].where("n > 1").select("key", "idx", "n", "digest"))
        first = runs.where(f"idx % {FAN} = 0")
        up = first.select("key", F.col("run").alias("idx"), F.expr(f"(n + {FAN - 1}) div {FAN}").alias("n"), F.sha2(F.concat("digest", "right"), 256).alias("digest"))
        found.append(written(up, "level"))
        widest = -(-widest // FAN)
    return found


def paths(found: list[DataFrame], above: DataFrame) -> DataFrame:
    """The leaves with ``subroot`` and ``path`` (left, right)[] up to the root; above: (key, subroot, path) of each key's last node."""
    upper = None
    for nodes in reversed(found):
        own = nodes.columns
        ended = nodes.where("n = 1").join(above, "key").select(*own, "subroot", "path")
        if upper is not None:
            parents = upper.select("key", F.col("idx").alias("run"), "subroot", F.col("path").alias("rest"))
            path = F.concat(F.array(F.struct("left", "right")), F.col("rest"))
            inner = beside(nodes.where("n > 1")).join(parents, ["key", "run"]).withColumn("path", path)
            ended = ended.unionByName(inner.select(*own, "subroot", "path"))
        upper = ended
    return upper


def manifest(
    docs: DataFrame, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", group_col: str = "source", claims: dict[str, Column] | None = None
) -> DataFrame:
    """(doc_id, leaf, claimed, subroot, root, path) of every row; runs jobs.

    leaf: sha256 of the row's ``record``. A group's leaves ascend by id (null first, equal
    ids by leaf); every 16 consecutive nodes become the sha256 of their joined digests until
    one is left, the subroot; subroots in order of group (null first, bytewise) give the root
    likewise. path: the siblings from leaf to root, as (left, right) for each level of the
    row's own trees. claimed: the leaf of the row with ``claims`` in place of its columns,
    null where it is the same row; ``folded`` tells the root that it leads to. Repeated rows
    are leaves of their own, null texts and ids are recorded as null, and an empty table has
    no rows. Other columns are neither read nor hashed.
    """
    key = F.coalesce(F.concat(F.lit("="), docs[group_col].cast("string")), F.lit(""))
    leaf = F.sha2(record(*(docs[f] for f in fields)), 256)
    other = F.sha2(record(*((claims or {}).get(f, docs[f]) for f in fields)), 256)
    named = docs.select(key.alias("key"), docs[id_col].alias("doc_id"), leaf.alias("digest"), other.alias("claimed"))
    named = named.withColumn("claimed", F.when(F.col("claimed") != F.col("digest"), F.col("claimed")))
    # the row's number keeps repeated rows apart, so that ranges can cut between them
    leaves = written(named.withColumn("row", F.monotonically_increasing_id()), "leaves")
    leaves = written(numbered(leaves, "doc_id", "digest", "row").drop("row"), "leaves")
    trees = levels(leaves)
    roots = trees[0].where("n = 1").select("key", "digest")
    for nodes in trees[1:]:
        roots = roots.unionByName(nodes.where("n = 1").select("key", "digest"))
    roots = written(numbered(roots.select(F.lit("").alias("key"), F.col("key").alias("name"), "digest"), "name"), "subroots")
    tops = levels(roots)
    root = tops[-1].where("n = 1").select("digest").first()
    end = docs.sparkSession.createDataFrame([("", "", [])], "key string, subroot string, path array<struct<left:string,right:string>>")
    above = paths(tops, end).select(F.col("name").alias("key"), F.col("digest").alias("subroot"), "path")
    out = paths(trees, above)
    return out.select("doc_id", F.col("digest").alias("leaf"), "claimed", "subroot", F.lit(root["digest"] if root else None).cast("string").alias("root"), "path")


def tamper_report(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row; runs jobs.

    Of rows whose crc32 of the id is divisible by five the text is claimed with A-Z in lower
    case; folded_root is what the claimed row and the siblings of the true one give.
    """
    chosen = F.crc32(docs["doc_id"].cast("string").cast("binary")) % 5 == 0
    lower = F.translate(docs["text"], "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    told = manifest(docs, claims={"text": F.when(chosen, lower).otherwise(docs["text"])})
    told = told.withColumn("proof_sha256", F.sha2(proof_text(F.col("path")), 256)).withColumn("folded_root", folded(F.coalesce("claimed", "leaf"), F.col("path")))
    return told.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
