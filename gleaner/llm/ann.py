"""Nearest neighbours by a block matrix join over int8 product tiles.

Queries and candidates are cut into blocks by hash; every pair of a query
block and a candidate block is one tile, found by an equi-join on the pair of
block numbers.  In a tile each vector x becomes int8 codes c with one scale s
(x = s c + e, the error's norm kept).  The product of the code matrices gives

    x . y = s_x s_y (c_x . c_y)  within  |e_x| |s_y c_y| + |x| |e_y|

and so a lower and an upper bound of every squared distance.  A pair survives
where its lower bound does not exceed the query's k-th least upper bound;
survivors are computed in double precision on the original vectors, and each
tile keeps its k nearest of each query.  Tiles are merged by a heap a query.
No pair that can be among the k nearest is discarded, so results are exact.

Codes are multiplied as floats, which is exact while 127 * 127 * dimensions
stays below 2**24 (1,040 dimensions; doubles are used beyond).
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.llm.vectors import matrix, one_per_id, usable
from gleaner.session import materialize

QUERY_BLOCK = 32_768      # queries of a tile
CANDIDATE_BLOCK = 2_048   # candidates of a tile
PRODUCT_ROWS = 256        # queries multiplied at once


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(int8 codes, scale, norm of scale * codes, norm of the error)."""
    scale = np.abs(x).max(axis=1) / 127.0
    codes = np.rint(x / scale[:, None]).astype(np.int8)
    near = codes * scale[:, None]
    return codes, scale, np.linalg.norm(near, axis=1), np.linalg.norm(x - near, axis=1)


def tile_nearest(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int):
    """(query id, candidate id, distance) of the k nearest of each query."""
    kind = np.float32 if q.shape[1] <= 1040 else np.float64
    cq, sq, _, eq = quantise(q)
    cc, sc, nc, ec = quantise(c)
    cc = cc.astype(kind).T
    q_norm, c_norm = np.linalg.norm(q, axis=1), np.linalg.norm(c, axis=1)
    out = []
    for a in range(0, len(q), PRODUCT_ROWS):
        b = min(a + PRODUCT_ROWS, len(q))
        product = (cq[a:b].astype(kind) @ cc).astype(np.float64)
        product *= sq[a:b, None]
        product *= sc
        square = q_norm[a:b, None] ** 2 + c_norm ** 2 - 2 * product
        slack = 2 * (eq[a:b, None] * nc + q_norm[a:b, None] * ec) + 1e-9 * (q_norm[a:b, None] + c_norm) ** 2
        own = q_ids[a:b, None] == c_ids
        high = np.where(own, np.inf, square + slack)
        limit = np.partition(high, k - 1, axis=1)[:, k - 1] if high.shape[1] >= k else np.full(b - a, np.inf)
        rows, cols = np.nonzero((square - slack <= limit[:, None]) & ~own)
        score = np.empty(len(rows))
        for s in range(0, len(rows), 65_536):
            r, j = rows[s:s + 65_536], cols[s:s + 65_536]
            d = q[a + r] - c[j]
            score[s:s + 65_536] = np.sqrt(np.einsum("ij,ij->i", d, d))
        order = np.lexsort((c_ids[cols], score, rows))
        rows, cols, score = rows[order], cols[order], score[order]
        first = np.searchsorted(rows, np.arange(b - a))
        keep = np.arange(len(rows)) - first[rows] < k
        out.append((q_ids[a + rows[keep]], c_ids[cols[keep]], score[keep]))
    return tuple(np.concatenate(x) for x in zip(*out))


def nearest(vectors: DataFrame, is_query: Column, k: int = 10) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` nearest others (all,
    if fewer) of each vector for which ``is_query`` (over vec_id) holds, by
    Euclidean distance, ties to the smaller vec_id.

    Vectors that are null, zero or hold null or non-finite components, and
    null ids, take no part; of a repeated id the least row counts; vectors of
    different lengths are not compared; no queries give no rows."""
    usable_rows = materialize(one_per_id(vectors.where(usable(vectors["embedding"])), "embedding")
                              .withColumn("dim", F.size("embedding")), "ann-vectors")
    total = usable_rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(is_query.cast("long")), F.lit(0))).first()
    q_blocks, c_blocks = (max(1, -(-n // size)) for n, size in ((total[1], QUERY_BLOCK), (total[0], CANDIDATE_BLOCK)))

    def blocks(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    place = lambda n, seed: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(n)).cast("int")
    queries = usable_rows.where(is_query).select(F.lit(True).alias("q"), "vec_id", "embedding", "dim",
                                                 place(q_blocks, "q").alias("qb"), blocks(c_blocks).alias("cb"))
    candidates = usable_rows.select(F.lit(False).alias("q"), "vec_id", "embedding", "dim",
                                    blocks(q_blocks).alias("qb"), place(c_blocks, "c").alias("cb"))

    def tile(rows: pa.Table) -> pa.Table:
        asks = rows.column("q").to_numpy()
        ids = rows.column("vec_id").to_numpy()
        x = matrix(rows.column("embedding"))
        if asks.any() and not asks.all():
            got = tile_nearest(ids[asks], x[asks], ids[~asks], x[~asks], k)
        else:
            got = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        return pa.table({"query_id": pa.array(got[0], pa.int64()), "vec_id": pa.array(got[1], pa.int64()),
                         "score": pa.array(got[2], pa.float64())})

    tops = queries.unionAll(candidates).groupBy("dim", "qb", "cb").applyInArrow(tile, "query_id long, vec_id long, score double")

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        best = heapq.nsmallest(k, zip(pdf["score"], pdf["vec_id"]))
        return pd.DataFrame({"query_id": pdf["query_id"].iloc[0], "rank": np.arange(1, len(best) + 1, dtype=np.int32),
                             "vec_id": [int(v) for _, v in best], "score": [float(s) for s, _ in best]})

    return tops.groupBy("query_id").applyInPandas(merge, "query_id long, rank int, vec_id long, score double")
