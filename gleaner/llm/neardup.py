"""Embedding near-dedup with randomised-rotation binary codes.

Unit vectors are rotated by seeded random orthogonal matrices; the sign of
each rotated component is a bit.  Two uses:

* Candidates.  The bits of independent rotations are cut into tables of
  ``bits`` bits; vectors of one label that agree on a table meet in a bucket.
  At similarity t a bit differs with probability acos(t) / pi, so the number
  of tables is set for a chance below ``MISS`` that a linked pair never meets.
  ``bits`` grows with the logarithm of the row count, so a bucket's expected
  size does not grow with the data.
* Estimates.  For a vector o with code x (signs / sqrt(d)) the factor <x, o>
  is kept.  <x, q> / <x, o> is an unbiased estimate of <o, q>; its error stays
  within BOUND * sqrt((1 - <x, o>^2) / <x, o>^2 / (d - 1)) but for a vanishing
  chance.  A pair whose estimates from either side lie below the threshold by
  more than that is discarded; the rest are computed exactly in double
  precision.

Copies are one vector with a multiplicity.  A bucket of many vectors is cut
into blocks by hash and its pairs into block tiles, so no task holds more than
two blocks of a bucket; tiles return each vector's number of links and a
spanning forest of their links, never the pairs.  A pair that meets in several
tables is counted in the first alone.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm.common import connected_components
from gleaner.llm.vectors import matrix, one_per_id, usable
from gleaner.session import materialize

THRESHOLD = 0.98
MISS = 1e-6          # chance that a pair at the threshold meets in no table
BOUND = 5.0          # width of the confidence bound, in standard errors
BLOCK = 1024         # rows of a bucket's block


def rotation(dim: int, number: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng([dim, number]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def table_codes(unit: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """Codes of each vector in each table (rows x tables)."""
    dim = unit.shape[1]
    need = bits * tables
    signs = [unit @ rotation(dim, 1 + i).T >= 0 for i in range(-(-need // dim))]
    flat = np.concatenate(signs, axis=1)[:, :need].reshape(len(unit), tables, bits)
    return flat @ (np.int64(1) << np.arange(bits, dtype=np.int64))


def estimates(o: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(estimate of <o, q>, its bound) for unit vectors, rows by rows."""
    dim = o.shape[1]
    turn = rotation(dim, 0).T
    ro, rq = o @ turn, q @ turn
    code = np.where(ro >= 0, 1.0, -1.0) / math.sqrt(dim)
    factor = np.einsum("ij,ij->i", code, ro)
    bound = BOUND * np.sqrt(np.maximum(1 - factor ** 2, 0) / factor ** 2 / max(dim - 1, 1))
    return (code @ rq.T) / factor[:, None], bound


def tile_links(ids, x, weight, codes, block, lo: int, hi: int, table: int, threshold: float):
    """(id, links) and forest edges of the pairs between blocks lo and hi."""
    a = np.flatnonzero(block == lo)
    b = np.flatnonzero(block == hi) if hi != lo else a
    if not len(a) or not len(b):
        return [], []
    norm = np.linalg.norm(x, axis=1)
    unit = x / norm[:, None]
    est, bound = estimates(unit[a], unit[b])
    back, back_bound = estimates(unit[b], unit[a])
    maybe = (est + bound[:, None] >= threshold) & (back.T + back_bound >= threshold)
    if lo == hi:
        maybe &= np.arange(len(a))[:, None] < np.arange(len(b))
    r, c = np.nonzero(maybe)
    i, j = a[r], b[c]
    if table:
        fresh = np.ones(len(i), bool)
        for s in range(0, len(i), 65_536):
            fresh[s:s + 65_536] = ~(codes[i[s:s + 65_536], :table] == codes[j[s:s + 65_536], :table]).any(axis=1)
        i, j = i[fresh], j[fresh]
    cos = np.empty(len(i))
    for s in range(0, len(i), 65_536):
        p, q = i[s:s + 65_536], j[s:s + 65_536]
        cos[s:s + 65_536] = np.einsum("ij,ij->i", x[p], x[q]) / (norm[p] * norm[q])
    link = cos >= threshold
    i, j = i[link], j[link]
    count = np.bincount(i, weight[j], len(ids)) + np.bincount(j, weight[i], len(ids))
    parent = list(range(len(ids)))

    def root(n: int) -> int:
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    edges = []
    for p, q in zip(i.tolist(), j.tolist()):
        u, v = root(p), root(q)
        if u != v:
            parent[u] = v
            edges.append((int(ids[p]), int(ids[q])))
    some = np.flatnonzero(count)
    return list(zip(ids[some].tolist(), count[some].astype(np.int64).tolist())), edges


_KEYS = ["label", "dim", "tab", "code", "lo", "hi"]


def _tiles(threshold: float):
    """Rows sorted by tile -> links and forest edges, tile after tile."""
    def close(tile: pa.Table, links: list, edges: list) -> None:
        key = [tile.column(k)[0].as_py() for k in _KEYS]
        got = tile_links(tile.column("vec_id").to_numpy(), matrix(tile.column("embedding")),
                         tile.column("weight").to_numpy().astype(float),
                         np.array(tile.column("codes").combine_chunks().flatten()).reshape(tile.num_rows, -1),
                         tile.column("block").to_numpy(), key[4], key[5], key[2], threshold)
        links += got[0]
        edges += got[1]

    def rows(links: list, edges: list) -> pa.RecordBatch:
        a = [i for i, _ in links] + [u for u, _ in edges]
        return pa.RecordBatch.from_arrays([
            pa.array(a, pa.int64()), pa.array([None] * len(links) + [v for _, v in edges], pa.int64()),
            pa.array([n for _, n in links] + [None] * len(edges), pa.int64())], ["a", "b", "links"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            here = pa.Table.from_batches([batch])
            if rest is not None:
                here = pa.concat_tables([rest, here]).combine_chunks()
            new = np.zeros(here.num_rows, bool)
            for k in _KEYS:
                v = here.column(k).to_numpy()
                new[1:] |= v[1:] != v[:-1]
            cuts = [0, *np.flatnonzero(new).tolist()]
            links, edges = [], []
            for s, e in zip(cuts, cuts[1:]):
                close(here.slice(s, e - s), links, edges)
            rest = here.slice(cuts[-1])
            yield rows(links, edges)
        if rest is not None:
            links, edges = [], []
            close(rest, links, edges)
            yield rows(links, edges)
    return run


def near_duplicate_vectors(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per vec_id: vec_id, n_links, component_id, kept.

    Only vectors of equal labels that are not null are compared.  Null, zero
    and non-finite vectors, and those without a label, link with nothing; of a
    repeated id the least row counts, null ids give no row; vectors of
    different lengths are not compared; a vector's copies count as links."""
    every = materialize(one_per_id(vectors, "label", "embedding"), "neardup-vectors")
    able = every.where(F.col("label").isNotNull() & usable(F.col("embedding"))).withColumn("dim", F.size("embedding"))
    member = able.groupBy("label", "dim", "embedding").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("weight"))
    reps = member.select("label", "dim", F.col("rep").alias("vec_id"), "weight", "embedding")
    n = max(every.count(), 2)
    differ = math.acos(threshold) / math.pi
    bits = min(max(8, math.ceil(math.log2(n))), 48)
    tables = math.ceil(math.log(MISS) / math.log(1 - (1 - differ) ** bits))

    @F.arrow_udf("array<long>")
    def codes_of(lists: pa.Array) -> pa.Array:
        dims = np.diff(lists.offsets.to_numpy())
        out = np.zeros((len(lists), tables), np.int64)
        for d in np.unique(dims):
            at = np.flatnonzero(dims == d)
            x = matrix(lists.take(pa.array(at)))
            out[at] = table_codes(x / np.linalg.norm(x, axis=1)[:, None], bits, tables)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(lists) + 1, dtype=np.int32) * tables), pa.array(out.ravel()))

    coded = materialize(reps.withColumn("codes", codes_of("embedding")), "neardup-codes")
    placed = coded.select("label", "dim", "vec_id", F.posexplode("codes").alias("tab", "code"))
    buckets = (placed.groupBy("label", "dim", "tab", "code").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
               .withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int")))
    met = placed.join(buckets, ["label", "dim", "tab", "code"])
    block = F.pmod(F.xxhash64("vec_id", F.lit("block")), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    met = (met.withColumn("block", block).withColumn("_o", other)
           .select("label", "dim", "vec_id", "tab", "code", "block", F.least("block", "_o").alias("lo"),
                   F.greatest("block", "_o").alias("hi")))
    tiles = met.join(coded.select("vec_id", "weight", "embedding", "codes"), "vec_id")
    found = materialize(tiles.repartition(*_KEYS).sortWithinPartitions(*_KEYS).mapInArrow(
        _tiles(threshold), "a long, b long, links long"), "neardup-links")

    counts = found.where("links is not null").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    groups = connected_components(found.where("b is not null").select(F.col("a").alias("u"), F.col("b").alias("v")))
    of_rep = (reps.select("label", "dim", "embedding", F.col("vec_id").alias("rep"), "weight")
              .join(counts, "rep", "left").join(groups.withColumnRenamed("node", "rep"), "rep", "left")
              .select("label", "dim", "embedding", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
                      F.coalesce("component", "rep").alias("component_id")))
    linked = able.join(of_rep, ["label", "dim", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = (every.where(~(F.col("label").isNotNull() & usable(F.col("embedding"))))
             .select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
    return linked.unionAll(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))
