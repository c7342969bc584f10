"""Content-derived keys, computed identically by DuckDB (md5 hex)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def review_key(body: Column | str) -> Column:
    """Id of a review from its body; a missing body hashes as ''.  Equal
    bodies share a key (same collision rule as hashing the text)."""
    body = F.col(body) if isinstance(body, str) else body
    return F.md5(F.coalesce(body, F.lit("")))


def review_uid(*cols: Column | str) -> Column:
    """Collision-free variant over product, author, date and body."""
    return F.md5(F.concat_ws("\u0001", *[F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))
                                          for c in cols]))


def hash_bucket(key: Column | str, seed: int, buckets: int = 100) -> Column:
    """Stable bucket in [0, buckets) from md5(seed:key): independent of
    partitioning and reproducible in SQL."""
    key = F.col(key) if isinstance(key, str) else key
    h = F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string")))
    return (F.conv(F.substring(h, 1, 8), 16, 10).cast("long") % buckets).cast("int")
