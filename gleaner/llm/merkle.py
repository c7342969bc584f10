"""Merkle manifest of a dataset, checked by a recursive climb.

A document is a leaf.  Leaves of a language, by doc_id, are hashed pairwise
until one node, the subroot, remains; subroots, by language, are hashed
likewise to the root.  Levels are built in runs of ``levels``: 2 ** levels
consecutive nodes are one group, whose levels are worked out together, so a
tree over a thousand million leaves takes three shuffles of nodes.  The node
rows of a run are written with their siblings on all its levels and a link to
the parent, the node that their group becomes.

A recursive query then climbs from every leaf: each step appends the siblings
of the run, folds them into the leaf's hash, which for a tampered leaf is the
tampered one, and follows the parent link.  ``levels = 1`` climbs level by
level; larger runs make fewer steps with the same rows.  Node rows above the
first run are copied for each first-run group below them, so a link is
followed by at most 2 ** levels leaves and a language with a third of all rows
is no hot key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.functions.ranking import row_number_within
from gleaner.session import materialize

LEVELS = 10         # levels of a run: groups of 1,024 nodes, 32 bytes a sibling
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_hash(**other: Column) -> Column:
    """SHA-256 of the document's fields, each ``-`` if null, else its length
    in UTF-8 bytes, ``:`` and its value; ``other`` replaces fields."""
    parts = []
    for name in FIELDS:
        value = other.get(name, F.col(name)).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def tampered_leaf() -> Column:
    """The leaf with one more in n_chars (a null stays)."""
    return leaf_hash(n_chars=F.col("n_chars") + 1)


def _grouped(nodes: DataFrame, levels: int) -> DataFrame:
    """tree, grp, items, built: nodes (tree, pos, hash, doc_id, other) in groups
    of 2 ** levels consecutive ones, with all levels of each group, leaves first.

    The only group of a tree ends at one node; where a tree has more groups
    (group 0 is full then) each rises the whole run, alone or not."""
    size = 1 << levels
    groups = nodes.groupBy("tree", F.shiftright("pos", levels).alias("grp")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "hash", "doc_id", "other"))).alias("items"))   # 2 ** levels at most
    alone = (F.col("grp") == 0) & (F.size("items") < size)
    rise = F.when(alone, F.ceil(F.log2(F.size("items"))).cast("int")).otherwise(F.lit(levels))

    def parents(row: Column) -> Column:
        pair = lambda i: F.sha2(F.concat(F.get(row, 2 * i), F.coalesce(F.get(row, 2 * i + 1), F.lit(""))), 256)
        return F.transform(F.sequence(F.lit(0), F.ceil(F.size(row) / 2).cast("int") - 1), pair)

    up = lambda built, _: F.concat(built, F.array(parents(F.element_at(built, -1))))
    steps = F.slice(F.sequence(F.lit(1), F.lit(levels)), F.lit(1), F.col("rise"))
    return (groups.withColumn("rise", rise).withColumn("base", F.transform("items", lambda x: x["hash"]))
            .select("tree", "grp", "items", F.aggregate(steps, F.array("base"), up).alias("built")))


def _links(grouped: DataFrame, levels: int) -> DataFrame:
    """tree, pos, grp, hash, doc_id, other, siblings: every node of the groups
    with its siblings up to the group's top, null where there is none."""
    rows = grouped.select("tree", "grp", F.slice("built", F.lit(1), F.size("built") - 1).alias("run"),
                          F.posexplode("items").alias("at", "item"))
    sibling = lambda row, i: F.unhex(F.get(row, F.call_function("shiftright", F.col("at"), i).bitwiseXOR(F.lit(1))))
    return rows.select("tree", (F.shiftleft("grp", levels) + F.col("at")).alias("pos"), "grp", F.unhex("item.hash").alias("hash"),
                       "item.doc_id", F.unhex("item.other").alias("other"), F.transform("run", sibling).alias("siblings"))


def _rise(nodes: DataFrame, levels: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """(written links of each run, roots (tree, hash)) of nodes (tree, pos, hash, doc_id, other)."""
    runs = []
    while True:
        grouped = materialize(_grouped(nodes, levels), f"merkle-{name}")
        runs.append(materialize(_links(grouped, levels), f"merkle-{name}-links"))
        nodes = _inner(grouped.select("tree", F.col("grp").alias("pos"), F.element_at(F.element_at("built", -1), 1).alias("hash")))
        if grouped.where("grp > 0").isEmpty():
            return runs, nodes.select("tree", "hash")


def _inner(nodes: DataFrame) -> DataFrame:
    return nodes.select("tree", "pos", "hash", F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("other"))


def build(leaves: DataFrame, levels: int = LEVELS) -> tuple[DataFrame, DataFrame, int, str]:
    """(leaf rows, node rows, steps, root): the written tree over ``leaves``
    (tree, pos from 0, hash, doc_id, other).

    Leaf rows: tree, pos, grp, hash, doc_id, other, siblings; the parent of a
    leaf's run is node (tree, grp, step 1).  Node rows: tree, first, step,
    place, siblings, subroot; the parent of (tree, first, step) is (tree,
    first, step + 1).  There is one for each first-run group, so a link is
    followed by 2 ** levels leaves at most.  ``subroot`` is set where the
    climb reaches it; the climb ends after ``steps`` steps at the root."""
    runs, roots = _rise(leaves, levels, "language")
    placed = row_number_within(roots, [], ["tree"], out="n").select("tree", "hash", (F.col("n") - 1).alias("place"))
    placed = materialize(placed, "merkle-subroots")
    tops, root = _rise(_inner(placed.select(F.lit("").alias("tree"), F.col("place").alias("pos"), "hash")), levels, "top")
    firsts = materialize(runs[0].select("tree", F.col("grp").alias("first")).distinct(), "merkle-firsts")

    nodes = None
    for step, run in enumerate(runs + tops):
        if step == 0:
            continue
        if step < len(runs):
            below = firsts.withColumn("pos", F.shiftright("first", levels * (step - 1)))
            rows = below.join(run, ["tree", "pos"]).withColumn("subroot", F.lit(None).cast("binary"))
        else:
            mine = placed.select("tree", F.shiftright("place", levels * (step - len(runs))).alias("pos"), F.unhex("hash").alias("subroot"))
            rows = firsts.join(mine.join(run.select("pos", "siblings"), "pos"), "tree")
        rows = rows.select("tree", "first", F.lit(step).alias("step"), F.col("pos").alias("place"), "siblings", "subroot")
        nodes = rows if nodes is None else nodes.unionByName(rows)
    return runs[0], materialize(nodes, "merkle-nodes"), len(runs) + len(tops), root.first()["hash"]


# A step folds the siblings that a row holds, appends them to its proof and
# takes up the parent's; the last one keeps the proof's hash only.
CLIMB = """
WITH RECURSIVE climb(tree, first, step, place, siblings, doc_id, leaf, fold, proof, subroot) AS (
  SELECT tree, grp, 0, pos, siblings, doc_id, hash, coalesce(other, hash), CAST('' AS BINARY), CAST(NULL AS BINARY) FROM {leaves}
  UNION ALL
  SELECT tree, first, step, place, siblings, doc_id, leaf,
    unhex(aggregate(sequence(1, {levels}), lower(hex(fold)), (h, i) -> CASE WHEN i > size(held) THEN h
      WHEN (shiftright(at, i - 1) & 1) = 1 THEN sha2(concat(lower(hex(get(held, i - 1))), h), 256)
      ELSE sha2(concat(h, coalesce(lower(hex(get(held, i - 1))), '')), 256) END)),
    CASE WHEN step = {steps} THEN unhex(sha2(lower(hex(longer)), 256)) ELSE longer END, subroot
  FROM (
    SELECT c.tree, c.first, c.step + 1 AS step, c.place AS at, c.siblings AS held, n.place, n.siblings, c.doc_id, c.leaf, c.fold,
      concat(c.proof, aggregate(c.siblings, CAST('' AS BINARY), (p, s) -> concat(p, coalesce(s, CAST('' AS BINARY))))) AS longer,
      coalesce(c.subroot, n.subroot) AS subroot
    FROM climb c LEFT JOIN {nodes} n ON n.tree = c.tree AND n.first = c.first AND n.step = c.step + 1
    WHERE c.step < {steps}))
SELECT doc_id, lower(hex(leaf)) AS leaf, lower(hex(subroot)) AS subroot, '{root}' AS root, lower(hex(proof)) AS proof_sha256,
  lower(hex(fold)) AS folded_root, lower(hex(fold)) = '{root}' AS verified
FROM climb WHERE step = {steps}"""

_ROWS, _DEPTH = "spark.sql.cteRecursionRowLimit", "spark.sql.cteRecursionLevelLimit"


def climb(leaves: DataFrame, nodes: DataFrame, steps: int, root: str, levels: int = LEVELS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of
    every leaf row.

    Spark bounds the rows of a recursive query; this one makes ``steps`` + 1
    rows a leaf, so the bound is lifted while the climb is written."""
    spark = leaves.sparkSession
    leaves.createOrReplaceTempView("merkle_leaves")
    nodes.createOrReplaceTempView("merkle_nodes")
    kept = {k: spark.conf.get(k) for k in (_ROWS, _DEPTH)}
    try:
        spark.conf.set(_ROWS, "-1")
        spark.conf.set(_DEPTH, str(max(100, steps + 2)))
        return materialize(spark.sql(CLIMB.format(leaves="merkle_leaves", nodes="merkle_nodes", levels=levels, steps=steps, root=root)),
                           "merkle-climb")
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
        spark.catalog.dropTempView("merkle_leaves")
        spark.catalog.dropTempView("merkle_nodes")


def verified_leaves(docs: DataFrame, is_tampered: Column, levels: int = LEVELS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256 (of the untampered tree),
    folded_root and verified of every document, where those for which
    ``is_tampered`` (over the columns of documents) holds are folded from
    their tampered leaf.

    Null fields are hashed as ``-``; a null language is a tree of its own and
    comes first, null ids come first in theirs; rows with one id follow one
    another by their leaf, equal rows in any order; an empty table gives no
    rows.  Columns other than those of documents are not looked at."""
    spark = docs.sparkSession
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "lang", F.col("n_chars").cast("long").alias("n_chars"), "text")
    # a tree's name keeps the order of its language: null first, then bytewise
    tree = F.coalesce(F.concat(F.lit("1"), "lang"), F.lit("0"))
    shown = plain.select(tree.alias("tree"), "doc_id", leaf_hash().alias("hash"),
                         F.when(is_tampered, tampered_leaf()).alias("other"))
    if docs.isEmpty():
        return spark.createDataFrame([], "doc_id long, leaf string, subroot string, root string, proof_sha256 string, "
                                         "folded_root string, verified boolean")
    leaves = row_number_within(shown, ["tree"], ["doc_id", "hash"], out="n").withColumn("pos", F.col("n") - 1).drop("n")
    rows, nodes, steps, root = build(leaves, levels)
    return climb(rows, nodes, steps, root, levels)


def one_in_seven() -> Column:
    """The rows that the query tampers with: 7 divides crc32 of the decimal doc_id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False))
