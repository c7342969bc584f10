"""Vectors that take part in searches and joins."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(v: Column) -> Column:
    """Not null, not zero, every component a finite number."""
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def one_per_id(vectors: DataFrame, *columns: str) -> DataFrame:
    """One row per vec_id that is not null: of repeated ids the least row."""
    row = F.struct(*[F.col(c) for c in columns])
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), *[F.col(c).alias(c) for c in columns])
            .where("vec_id is not null").groupBy("vec_id").agg(F.min(row).alias("r"))
            .select("vec_id", *[F.col(f"r.{c}").alias(c) for c in columns]))


def matrix(lists: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Equally long list rows as a float64 matrix."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(lists), -1)
