"""N-gram Jaccard join as a blocked sparse product with size-derived bounds.

The incidence matrix has a row per distinct shingle set (a node; exact copies
are one node) and a column per shingle.  Only the entries that a link must
share are multiplied: in one global order of shingles, two sets of Jaccard
similarity t or more meet in the first n - ceil(t n) + 1 shingles of each
(n the set's size).  Spark blocks the product by shingle.

1. One pass over the texts gives each row its node, size and a parity sketch
   (every shingle flips one bit), and counts shingles that
   repeat inside a batch.  The most frequent of these, a bounded list, come
   last in the global order, so passages that many texts share stay out of
   the prefixes.  The order changes cost only, never links.
2. A second pass emits the prefix entries (shingle, node).  Shingles with one
   node fall away.
3. Star rounds: in each block every node is paired with one leader only (the
   least node, then others for nodes not yet in the leader's component), so a
   group of near copies costs a few pairs a node.  Blocks fall into LEADERS
   classes whose leaders differ, so a node meets several of its group in one
   round.  Verified links, contracted inside tasks, give provisional components;
   rounds go on while they join many nodes.
4. Cross round: nodes of one block that are still in different components are
   paired.  Pairs inside a component need no look: they change nothing.  So
   every link between components is found, and no link is lost.  An entry
   carries the two shingles before it in its node's prefix: where one of them
   is common too, the pair has met there already and is not made again, so a
   pair comes out once a stretch of common shingles, not once a shingle.  At
   its first common shingle a pair has no common one in front, and no more
   common ones than are left in either set: a pair for which these are too few,
   or whose folded sketches (PARITY words an entry) are too far apart, is not
   made either.

A pair is discarded when its sizes cannot reach the threshold, or when its
sketches differ in more bits than the size-derived bound on the symmetric
difference allows (the sketches' distance never exceeds that difference).
Surviving pairs are counted exactly on the whole texts of their documents; a Bloom filter of fixed size keeps other texts
out of that shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.llm.common import connected_components, contracted, mix64, texts_of, utf8_parts
from gleaner.llm.shingles import shingle_sets
from gleaner.session import materialize

WORDS = 4                # words of a shingle
PERCENT = 85             # 100 * intersection >= PERCENT * union
PARITY = 4               # 64-bit words of the folded sketch that cross entries carry
SKETCH_WORDS = 16        # least 64-bit words of a parity sketch
LEADERS = 8              # classes of blocks with leaders of their own in a star round
LAST_ROUND = 50          # no more star rounds after one with fewer than 1 / LAST_ROUND of the first one's links
FREQUENT = 300_000       # shingles moved to the end of the order: 2.4 MB
REPEATS = 2              # different sets of one slice that hold a shingle before it counts as frequent
SLICE = 2_000_000        # shingles of a slice


def _sketch(shingles: np.ndarray) -> list[int]:
    """Parity bits, a power of two of them and as many as shingles at least,
    so that the bound on the difference of two sets of any size can bite."""
    size = max(64 * SKETCH_WORDS, 1 << (len(shingles) - 1).bit_length())
    at = (mix64(shingles + np.uint64(77)) & np.uint64(size - 1)).astype(np.int64)
    bits = (np.bincount(at, minlength=size) & 1).astype(np.uint8)
    return np.packbits(bits, bitorder="little").view("<i8").tolist()


def _node_of(shingles: np.ndarray) -> int:
    """A 64-bit name of the set."""
    n = np.uint64(len(shingles))
    a = mix64(np.bitwise_xor.reduce(mix64(shingles)) + n)
    return int(mix64(np.array([np.sum(shingles * (shingles | np.uint64(1)))], np.uint64) ^ a)[0].astype(np.int64))


def _profile(size: int):
    names = ["kind", "doc_id", "text_hash", "node", "n", "sketch"]

    def repeated(seen: list[np.ndarray]) -> pa.RecordBatch:
        found, counts = np.unique(np.concatenate(seen), return_counts=True)
        often = np.flatnonzero(counts >= REPEATS)
        k, none = len(often), lambda t: pa.nulls(len(often), t)
        return pa.RecordBatch.from_arrays([
            pa.array(np.ones(k, np.int32)), none(pa.int64()), none(pa.int64()), pa.array(found[often].astype(np.int64)),
            pa.array(counts[often].astype(np.int64)), none(pa.list_(pa.int64()))], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, held, counted = [], 0, set()
        for batch in batches:
            nodes, sizes, sketches = [], [], []
            for _, s in shingle_sets(*utf8_parts(batch.column(1)), size):
                nodes.append(_node_of(s) if len(s) else None)
                sizes.append(len(s))
                sketches.append(_sketch(s) if len(s) else None)
                if not len(s) or nodes[-1] in counted:       # exact copies are one node
                    continue
                counted.add(nodes[-1])
                seen.append(s)
                held += len(s)
                if held >= SLICE:
                    yield repeated(seen)
                    seen, held, counted = [], 0, set()
            yield pa.RecordBatch.from_arrays([
                pa.array(np.zeros(len(nodes), np.int32)), batch.column(0), batch.column(2), pa.array(nodes, pa.int64()),
                pa.array(sizes, pa.int64()), pa.array(sketches, pa.list_(pa.int64()))], names)
        if seen:
            yield repeated(seen)
    return run


def _prefixes(size: int, percent: int, frequent: np.ndarray):
    """Entries (shingle, node, pos, b1, b2) of each text's prefix: the place
    in the set's order and the two shingles in front (null for none)."""
    order = np.argsort(frequent)
    known, place = frequent[order], order            # place: how frequent, 0 the most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shingles, nodes, lengths = [], [], []
            done = set()                             # copies in one batch are emitted once
            for _, s in shingle_sets(*utf8_parts(batch.column(0)), size):
                n = len(s)
                node = _node_of(s) if n else None
                if node is None or node in done:
                    continue
                done.add(node)
                take = n - -(-percent * n // 100) + 1
                if len(known):
                    at = np.minimum(np.searchsorted(known, s), len(known) - 1)
                    late = known[at] == s
                    if late.any():
                        rest = s[late]
                        s_ordered = np.concatenate([s[~late], rest[np.argsort(-place[at[late]])]])
                    else:
                        s_ordered = s
                else:
                    s_ordered = s
                shingles.append(s_ordered[:take])
                nodes.append(node)
                lengths.append(take)
            flat = (np.concatenate(shingles) if shingles else np.zeros(0, np.uint64)).astype(np.int64)
            counts = np.array(lengths, np.int64)
            pos = np.arange(len(flat)) - np.repeat(np.cumsum(counts) - counts, counts)
            one, two = (pa.array(np.concatenate([np.zeros(min(k, len(flat)), np.int64), flat[:-k]]), mask=pos < k) for k in (1, 2))
            yield pa.RecordBatch.from_arrays(
                [pa.array(flat), pa.array(np.repeat(np.array(nodes, np.int64), counts)), pa.array(pos.astype(np.int32)), one, two],
                ["shingle", "node", "pos", "b1", "b2"])
    return run


def _overlaps(size: int, percent: int):
    """Links among (a, b, text of a, text of b), by exact counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column(0), batch.column(1)
            keep = []
            left, right = (shingle_sets(*utf8_parts(batch.column(i)), size) for i in (2, 3))
            for (_, x), (_, y) in zip(left, right):
                both = 0
                if len(x) and len(y):
                    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                    both = int((y[at] == x).sum())
                keep.append(both > 0 and 100 * both >= percent * (len(x) + len(y) - both))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([a.filter(mask), b.filter(mask)], ["u", "v"])
    return run


def _parity(k: int) -> Column:
    """Word ``k`` of a sketch folded to PARITY words."""
    mine = F.filter("sketch", lambda _, i: i % PARITY == k)
    return F.aggregate(mine, F.lit(0).cast("long"), lambda s, x: s.bitwiseXOR(x))


def _reachable(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose sizes and sketches allow a link."""
    left = sketches.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    right = sketches.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
    both = pairs.join(left, "a").join(right, "b")
    xor = lambda x, y: x.bitwiseXOR(y)

    def folded(mine: str, other: str) -> Column:
        """The longer sketch folded to the other's length (sizes that can link differ by one fold at most)."""
        half = F.size(other)
        return F.when(F.size(mine) > half, F.zip_with(F.slice(mine, 1, half), F.slice(mine, half + 1, half), xor)).otherwise(F.col(mine))

    apart = F.aggregate(F.zip_with(folded("sa", "sb"), folded("sb", "sa"), lambda x, y: F.bit_count(xor(x, y))),
                        F.lit(0), lambda s, x: s + x)
    small, large = F.least("na", "nb"), F.greatest("na", "nb")
    # overlap >= t * union  <=>  symmetric difference <= (1 - t) / (1 + t) * (na + nb)
    return (both.where(100 * small >= percent * large)       # first: only such sketches fold to one length
            .where(apart * (100 + percent) <= (100 - percent) * (F.col("na") + F.col("nb"))).select("a", "b"))


def _verified(docs: DataFrame, owners: DataFrame, pairs: DataFrame, size: int, percent: int) -> DataFrame:
    """The links (u, v) among ``pairs`` by exact counts on whole texts.  A
    text is about half the size of its shingles' hashes, so texts move."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(owners, "node")
    named = (texts_of(docs, wanted).withColumn("text_hash", F.xxhash64("text"))
             .join(owners, ["doc_id", "text_hash"]))            # rows of one id may differ in text
    again = Window.partitionBy("doc_id", "text_hash").orderBy("doc_id")
    texts = materialize(named.withColumn("_n", F.row_number().over(again)).where("_n = 1").select("node", "text"), "jaccard-texts")
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("x"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(_overlaps(size, percent), "u long, v long")


def jaccard_components(docs: DataFrame, size: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per document row: doc_id, n_shingles, component_id (the least
    doc_id reachable by links of ``percent`` or more, itself included).

    Null, empty and blank texts have no shingles and link with nothing; rows
    of one doc_id count as documents of their own that share that id; a null
    doc_id takes its group's least id, or null alone."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    profile = materialize(docs.withColumn("text_hash", F.xxhash64("text")).mapInArrow(
        _profile(size), "kind int, doc_id long, text_hash long, node long, n long, sketch array<long>"), "jaccard-profile")
    rows = profile.where("kind = 0")
    often = (profile.where("kind = 1").groupBy("node").agg(F.sum("n").alias("c"))
             .orderBy(F.desc("c"), "node").limit(FREQUENT).select("node").toArrow())      # FREQUENT numbers at most
    frequent = often.column(0).to_numpy().astype(np.int64).astype(np.uint64)
    owner = F.min(F.struct(F.col("doc_id").isNull().alias("lacks"), "doc_id", "text_hash"))
    nodes = materialize(rows.where("node is not null").groupBy("node").agg(
        F.first("n").alias("n"), F.first("sketch").alias("sketch"), owner.alias("owner"))
        .select("node", "n", "sketch", "owner.doc_id", "owner.text_hash"), "jaccard-nodes")
    sketches = nodes.select("node", "n", "sketch")
    # a row without an id is found by its text's hash in the id's place
    owners = nodes.select("node", F.coalesce("doc_id", "text_hash").alias("doc_id"), "text_hash")
    keyed = docs.select(F.coalesce("doc_id", F.xxhash64("text")).alias("doc_id"), "text")

    entries = materialize(docs.select("text").mapInArrow(_prefixes(size, percent, frequent), "shingle long, node long, pos int, b1 long, b2 long"),
                          "jaccard-entries")
    blocks = (entries.groupBy("shingle").agg(F.min("node").alias("least"), F.max("node").alias("most"))
              .where("least != most").select("shingle", "least"))
    shared = materialize(entries.join(blocks, "shingle").distinct(), "jaccard-shared")

    # star rounds: the least node of a block first, then other leaders for nodes not yet with the last one
    # tree: edges (u, v), fewer than all links so far, with their components
    tree, held, first, turn = None, 0, 0, 0
    while True:
        if turn == 0:
            star = shared.where("node != least").select(F.col("node"), F.col("least").alias("lead"))
        else:
            rooted = shared.select("shingle", "node").join(found, "node", "left").select(
                "shingle", "node", F.coalesce("component", "node").alias("root"))
            rank = F.xxhash64("node", F.pmod("shingle", F.lit(LEADERS)), F.lit(turn))
            lead = rooted.groupBy("shingle").agg(F.max(F.struct(rank, "node", "root")).alias("l"))
            star = (rooted.join(lead, "shingle").where("root != l.root").select("node", F.col("l.node").alias("lead")))
        star = star.select(F.least("node", "lead").alias("a"), F.greatest("node", "lead").alias("b")).distinct()
        star = materialize(_reachable(star, sketches, percent), "jaccard-star")
        new = materialize(_verified(keyed, owners, star, size, percent), "jaccard-links")
        joined = new.count()
        first = max(first, joined)
        # components only have to be right, not whole, until the cross round: no rounds until nothing changes
        edges = new if tree is None else new.unionAll(tree) if joined else None
        if edges is not None:
            tree = materialize(contracted(edges, held + joined), "jaccard-tree")
            held = tree.count()
            found = tree.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
        if turn and joined * LAST_ROUND <= first:
            break
        turn += 1

    placed = materialize(shared.join(found, "node", "left").withColumn("root", F.coalesce("component", "node")).drop("component"),
                         "jaccard-placed")
    mixed = (placed.groupBy("shingle").agg(F.min("root").alias("low"), F.max("root").alias("high"))
             .where("low != high").select("shingle"))
    words = [f"w{k}" for k in range(PARITY)]
    sized = nodes.select("node", "n", *[_parity(k).alias(w) for k, w in enumerate(words)])
    open_ = materialize(placed.join(mixed, "shingle").join(sized, "node"), "jaccard-open")
    left, right = (open_.select("shingle", *[F.col(c).alias(side + c) for c in open_.columns if c != "shingle"]) for side in "xy")
    met = " or ".join(f"coalesce(x{a} = y{b}, false)" for a in ("b1", "b2") for b in ("b1", "b2"))
    apart = sum((F.bit_count(F.col("x" + w).bitwiseXOR(F.col("y" + w))) for w in words), F.lit(0))
    total = F.col("xn") + F.col("yn")
    rest = F.least(F.col("xn") - F.col("xpos"), F.col("yn") - F.col("ypos"))    # common shingles there can be from here on
    cross = (left.join(right, "shingle").where("xroot < yroot").where(f"not ({met})")
             .where(100 * F.least("xn", "yn") >= percent * F.greatest("xn", "yn"))
             .where((100 + percent) * rest >= percent * total)
             .where((100 + percent) * apart <= (100 - percent) * total)
             .select(F.least("xnode", "ynode").alias("a"), F.greatest("xnode", "ynode").alias("b")).distinct())
    cross = materialize(_reachable(cross, sketches, percent), "jaccard-cross")
    more = materialize(_verified(keyed, owners, cross, size, percent), "jaccard-links")
    groups = connected_components(contracted(more.unionAll(tree), held + more.count()))

    named = nodes.select("node", "doc_id").join(groups, "node", "left").select("node", "doc_id", F.coalesce("component", "node").alias("root"))
    least = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    of_node = named.join(least, "root").select("node", "component_id")
    linked = rows.where("node is not null").select("doc_id", "node", "n").join(of_node, "node")
    alone = rows.where("node is null").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return (linked.select("doc_id", "n", "component_id").unionAll(alone)
            .select("doc_id", F.col("n").alias("n_shingles"), "component_id"))


def drop_near_duplicates(docs: DataFrame, size: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One document of each group stays, the one of the least doc_id; columns
    unchanged.  Rows that repeat an id and a text are one document; rows with
    a null id stay."""
    kept = materialize(jaccard_components(docs, size, percent).where("doc_id = component_id").select(
        F.col("doc_id").alias("_kept")).distinct(), "jaccard-kept")
    names = [f"_c{i}" for i in range(len(docs.columns))]       # clear of any column's name
    rows = docs.select(*[docs[c].alias(n) for c, n in zip(docs.columns, names)],
                       docs["doc_id"].cast("long").alias("_kept"), F.xxhash64(docs["text"]).alias("_text"))
    stay = rows.join(kept, "_kept")
    again = Window.partitionBy("_kept", "_text").orderBy("_kept")
    stay = stay.withColumn("_again", F.row_number().over(again)).where("_again = 1")
    out = [F.col(n).alias(c) for c, n in zip(docs.columns, names)]
    return stay.select(*out).unionAll(rows.where("_kept is null").select(*out))
