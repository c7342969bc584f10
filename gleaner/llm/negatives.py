"""Hard negatives by Kronecker-packed integer products.

Vectors become integers, floor(256 x).  Anchors and candidates are cut into
blocks, every pair of blocks is one tile, found by an equi-join on the block
numbers.  In a tile the components of all candidates at one dimension are
biased to be non-negative and written side by side into the fields of one wide
integer, field width wide enough for a whole inner product.  An anchor then
takes one multiplication a component: the sum over dimensions of biased
component times wide integer holds the biased inner products of all candidates
in its fields, which are taken apart and freed of the biases exactly.

Two joins of that kind follow one another: candidates of the anchor's label
give its positives, the best of all tiles; those of other labels give, for each
positive, the best negatives inside the score window.  Tiles keep their best
only, so what is merged is a few rows a tile and anchor, and nothing is lost.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.session import materialize

SCALE = 256
TILE_VALUES = 65_536      # components of a tile's candidates: 1,024 of 64 dimensions
ANCHOR_VALUES = 524_288   # components of a tile's anchors


class PackedBlock:
    """Integer vectors, packed dimension by dimension, that can be multiplied
    with another vector; exact for integers of any size."""

    def __init__(self, codes: np.ndarray, largest: int):
        """``codes``: rows by dimensions; ``largest``: the greatest magnitude
        of a component of the vectors it will be multiplied with."""
        self.rows, self.dims = codes.shape
        self.bias = max(0, -int(codes.min(initial=0)))
        self.other_bias = largest
        top = (int(codes.max(initial=0)) + self.bias) * 2 * largest * max(self.dims, 1)
        self.width = 4 if top < 1 << 32 else 8 if top < 1 << 62 else max(9, -(-top.bit_length() // 8))
        biased = codes + self.bias
        if self.width <= 8:
            fields = biased.astype(np.dtype(f"<u{self.width}"))
            self.packed = [int.from_bytes(fields[:, d].tobytes(), "little") for d in range(self.dims)]
            self.sums = fields.astype(np.int64).sum(axis=1)
        else:
            self.packed = [int.from_bytes(b"".join(int(row[d]).to_bytes(self.width, "little") for row in biased), "little")
                           for d in range(self.dims)]
            self.sums = np.array([sum(int(v) for v in row) for row in biased] + [None], object)[:-1]

    def products(self, vector: list[int]) -> np.ndarray:
        """Inner product of ``vector`` with every row: one multiplication of
        the wide integer a component, then the fields without their biases."""
        wide = 0
        for component, packed in zip(vector, self.packed):
            wide += (component + self.other_bias) * packed
        raw = wide.to_bytes(self.rows * self.width, "little")
        if self.width <= 8:
            fields = np.frombuffer(raw, np.dtype(f"<u{self.width}")).astype(np.int64)
        else:
            fields = np.array([int.from_bytes(raw[i:i + self.width], "little") for i in range(0, len(raw), self.width)] + [None], object)[:-1]
        # sum (v + s)(c + b) = sum v c + b sum v + s sum (c + b)
        return fields - self.bias * sum(vector) - self.other_bias * self.sums


def codes_of(lists: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """The floors of equally long lists of doubles as a matrix, of Python
    integers where they may pass 53 bits."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    flat = np.floor(lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    if np.abs(flat).max(initial=0) < 2.0 ** 53:
        whole = flat.astype(np.int64)
    else:
        whole = np.array([int(x) for x in flat], object)
    return whole.reshape(len(lists), len(flat) // max(len(lists), 1))


def _longs(scores: np.ndarray) -> np.ndarray:
    """Scores as longs; beyond 64 bits the nearest long."""
    if scores.dtype != object:
        return scores
    low, high = -(1 << 63), (1 << 63) - 1
    return np.array([min(max(s, low), high) for s in scores], np.int64)


def _block(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(ids, labels, codes, is anchor) of a tile's rows."""
    return (rows.column("vec_id").to_numpy(), rows.column("label").to_numpy(),
            codes_of(rows.column("scaled")), rows.column("asks").to_numpy())


def _best(scores: np.ndarray, ids: np.ndarray, mask: np.ndarray, k: int) -> np.ndarray:
    """Places of the k greatest scores inside the mask, ties to smaller ids."""
    at = np.nonzero(mask)[0]
    if len(at) > 4 * k:        # all that reach the k-th score stay for the ties
        least = np.partition(scores[at], len(at) - k)[len(at) - k]
        at = at[scores[at] >= least]
    order = sorted(at.tolist(), key=lambda i: (-int(scores[i]), int(ids[i])))
    return np.array(order[:k], np.int64)


PAIR = "anchor_id long, vec_id long, score long"
TRIPLE = "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long"


def _positives_of(k: int):
    def tile(rows: pa.Table) -> pa.Table:
        ids, _, codes, asks = _block(rows)
        out: list[tuple[int, int, int]] = []
        if asks.any() and not asks.all():
            c_ids, a_codes = ids[~asks], codes[asks]
            block = PackedBlock(codes[~asks], _largest(a_codes))
            for anchor, vector in zip(ids[asks].tolist(), a_codes.tolist()):
                scores = _longs(block.products(vector))
                best = _best(scores, c_ids, c_ids != anchor, k)
                out += zip([anchor] * len(best), c_ids[best].tolist(), scores[best].tolist())
        return _table(out, PAIR)
    return tile


def _negatives_of(k: int, share: int):
    def tile(rows: pa.Table) -> pa.Table:
        ids, labels, codes, asks = _block(rows)
        out: list[tuple[int, int, int, int, int]] = []
        if asks.any() and not asks.all():
            c_ids, c_labels, a_codes = ids[~asks], labels[~asks], codes[asks]
            positives = [p for p, a in zip(rows.column("positives").to_pylist(), asks) if a]
            block = PackedBlock(codes[~asks], _largest(a_codes))
            for anchor, label, vector, own in zip(ids[asks].tolist(), labels[asks].tolist(), a_codes.tolist(), positives):
                scores = _longs(block.products(vector))
                other = c_labels != label
                for p in own:
                    # share * p <= 100 n <= 100 p, in whole numbers
                    least = -(-share * p["score"] // 100)
                    best = _best(scores, c_ids, other & (scores >= least) & (scores <= p["score"]), k)
                    out += zip([anchor] * len(best), [p["vec_id"]] * len(best), c_ids[best].tolist(),
                               [p["score"]] * len(best), scores[best].tolist())
        return _table(out, TRIPLE)
    return tile


def _largest(codes: np.ndarray) -> int:
    return max(abs(int(codes.min(initial=0))), abs(int(codes.max(initial=0))))


def _table(rows: list[tuple], schema: str) -> pa.Table:
    names = [c.split()[0] for c in schema.split(", ")]
    columns = zip(*rows) if rows else [[] for _ in names]
    return pa.table({n: pa.array(list(c), pa.int64()) for n, c in zip(names, columns)})


def _usable(v: Column, label: Column) -> Column:
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * SCALE) != float("inf")))
    return F.coalesce(v.isNotNull() & label.isNotNull() & finite, F.lit(False))


def _first(rows: DataFrame, by: list[str], score: str, vec: str, k: int) -> DataFrame:
    """The k best of each group with their rank (a partial top-k comes before the shuffle)."""
    order = Window.partitionBy(*by).orderBy(F.col(score).desc(), F.col(vec))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, is_anchor: Column, n_positives: int = 5, n_negatives: int = 5,
                   share: int = 80) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score,
    negative_score: for every row for which ``is_anchor`` (over vec_id) holds
    and each of its ``n_positives`` best rows of the same label, the
    ``n_negatives`` best rows of other labels whose score is at most the
    positive's and at least ``share`` percent of it.

    The score is the inner product of floor(256 x); higher comes first, ties to
    the smaller vec_id.  Rows with a null id, label or vector, or with a null or
    non-finite component, take no part; of a repeated id the least row counts;
    vectors of different lengths are not compared; empty vectors score 0.
    Scores beyond 64 bits count as the nearest long.  No anchors, no rows."""
    v, label = F.col("embedding"), F.col("label")
    row = F.struct(label.cast("long").alias("label"), v.cast("array<double>").alias("embedding"))
    one = (vectors.where(_usable(v, label) & F.col("vec_id").isNotNull())
           .select(F.col("vec_id").cast("long").alias("vec_id"), row.alias("r"))
           .groupBy("vec_id").agg(F.min("r").alias("r")))
    scaled = F.transform("r.embedding", lambda x: x * SCALE)      # exact; tiles take the floor, of any size
    rows = materialize(one.select("vec_id", F.col("r.label").alias("label"), scaled.alias("scaled"),
                                  F.size("r.embedding").alias("dim"), is_anchor.alias("asks")), "negatives-vectors")
    size = rows.agg(F.coalesce(F.sum(F.col("dim") + 1), F.lit(0)), F.coalesce(F.sum(F.when(F.col("asks"), F.col("dim") + 1)), F.lit(0))).first()
    c_blocks, a_blocks = (max(1, -(-n // most)) for n, most in ((size[0], TILE_VALUES), (size[1], ANCHOR_VALUES)))

    def tiles(anchors: DataFrame, group: list[str]) -> DataFrame:
        """Rows of every tile: anchors of block qb beside candidates of block cb."""
        place = lambda n, seed: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(n)).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        asked = anchors.withColumn("qb", place(a_blocks, "a")).withColumn("cb", every(c_blocks))
        others = (rows.withColumn("asks", F.lit(False)).withColumn("cb", place(c_blocks, "c")).withColumn("qb", every(a_blocks)))
        return asked.unionByName(others, allowMissingColumns=True).groupBy(*group, "dim", "qb", "cb")

    anchors = rows.where("asks")
    pairs = tiles(anchors, ["label"]).applyInArrow(_positives_of(n_positives), PAIR)
    best = _first(pairs, ["anchor_id"], "score", "vec_id", n_positives)
    positives = best.groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.collect_list(F.struct("vec_id", "score")).alias("positives"))          # n_positives at most
    asked = materialize(anchors.join(positives, "vec_id"), "negatives-anchors")
    found = tiles(asked, []).applyInArrow(_negatives_of(n_negatives, share), TRIPLE)
    return _first(found, ["anchor_id", "positive_id"], "negative_score", "negative_id", n_negatives).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def query_labels(vectors: DataFrame) -> DataFrame:
    """The table with (label + 1) % 10 as the label where 7 divides vec_id."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    return vectors.select("vec_id", "embedding", moved.alias("label"))
