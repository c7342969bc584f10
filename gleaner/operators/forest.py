"""Reply trees as edge tables, expanded by pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.functions.ranking import row_number_within
from gleaner.session import materialize

# Sort-key elements of a node; longer keys are replaced by their rank.
PATH_ELEMENTS = 32


def expand_comment_forest(edges: DataFrame, id_col: str = "id", parent_col: str = "parent_id",
                          sibling_col: str = "sibling_key") -> DataFrame:
    """PRJ-3: every node of a reply forest with its root, depth and
    breadth-first position inside its tree (depth, then sibling order of
    the path from the root; equal sibling keys by id).

    A node whose parent is not among the ids starts a tree of its own and is
    flagged ``is_orphan``.  Nodes on a cycle, or below one, have no root:
    root, depth and position are null.

    Every node points at an ancestor and holds the path below it.  A round
    joins the nodes that have not reached a root with the rows of the
    ancestors they point at and takes over their pointers, so distances
    double: a tree of depth d takes log2(d) rounds, each one equi-join that
    adaptive execution splits where very many nodes point at one ancestor,
    written once to the shared checkpoint folder.  A round in which no node
    reaches its root leaves only cycles.  Paths are compared between nodes of
    one depth only, whose paths are made of parts of the same lengths, so a
    part may be replaced by its rank among all nodes."""
    given = edges.select(F.col(id_col).alias("_id"), F.col(parent_col).alias("_parent"), F.col(sibling_col).alias("_sib"))
    placed = row_number_within(given, [], ["_sib", "_id"], out="_no").drop("_sib")
    nodes = _pointers(materialize(placed, "forest-nodes"))
    left, length = _unfinished(nodes), 1
    while left:
        if 2 * length > PATH_ELEMENTS:
            nodes, length = _ranked(nodes), 1
        nodes, length = _jump(nodes), 2 * length
        before, left = left, _unfinished(nodes)
        if left == before:
            break
    numbered = row_number_within(nodes.where("_done"), ["_up"], ["_depth", "_path"], out="bfs_no")
    reached = numbered.select("_id", "_parent", F.col("_up").alias("_root"), "_depth", "bfs_no", "_orphan")
    none = lambda c, kind: F.lit(None).cast(kind).alias(c)
    lost = nodes.where("not _done").select("_id", "_parent", none("_root", reached.schema["_root"].dataType), none("_depth", "int"),
                                           none("bfs_no", "long"), "_orphan")
    return reached.unionByName(lost).select(
        F.col("_id").alias(id_col), F.col("_parent").alias(parent_col), F.col("_root").alias("root_id"),
        F.col("_depth").alias("depth"), F.col("bfs_no").cast("long").alias("bfs_no"), F.col("_orphan").alias("is_orphan"))


def _pointers(placed: DataFrame) -> DataFrame:
    """Nodes (_id, _parent, _no) pointing at their parents; roots and orphans
    at themselves, with an empty path."""
    parents = placed.select(F.col("_id").alias("_known"), F.col("_parent").isNull().alias("_root_above"))
    joined = placed.join(parents, placed["_parent"] == parents["_known"], "left")
    top = F.col("_known").isNull()
    return materialize(joined.select(
        "_id", "_parent", (top & F.col("_parent").isNotNull()).alias("_orphan"),
        F.when(top, F.col("_id")).otherwise(F.col("_known")).alias("_up"), F.when(top, 0).otherwise(1).alias("_depth"),
        F.when(top, F.array().cast("array<long>")).otherwise(F.array("_no")).alias("_path"),
        (top | F.coalesce("_root_above", F.lit(False))).alias("_done")), "forest-pointers")


def _jump(nodes: DataFrame) -> DataFrame:
    """Unfinished nodes take over the pointers of the ancestors they point at."""
    above = nodes.select(F.col("_id").alias("_at"), F.col("_up").alias("_next"), F.col("_depth").alias("_far"),
                         F.col("_path").alias("_over"), F.col("_done").alias("_ends"))
    open_ = nodes.where("not _done").drop("_done")
    moved = open_.join(above, open_["_up"] == above["_at"]).select(
        "_id", "_parent", "_orphan", F.col("_next").alias("_up"), (F.col("_depth") + F.col("_far")).alias("_depth"),
        F.concat("_over", "_path").alias("_path"), F.col("_ends").alias("_done"))
    return materialize(nodes.where("_done").unionByName(moved), "forest-pointers")


def _ranked(nodes: DataFrame) -> DataFrame:
    """Every path as one element, its rank among all (paths that differ in
    length are never compared; an empty one stays empty)."""
    ranked = row_number_within(nodes, [], ["_path", "_id"], out="_no")
    short = F.when(F.size("_path") == 0, F.col("_path")).otherwise(F.array("_no"))
    return materialize(ranked.withColumn("_path", short).drop("_no"), "forest-pointers")


def _unfinished(nodes: DataFrame) -> int:
    return nodes.where("not _done").count()
