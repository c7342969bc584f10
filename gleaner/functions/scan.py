"""Running sums that never put a whole key into one task.

The order column is a dense 1-based index within the key.  Rows are cut into
blocks of ``block`` consecutive positions and blocks into blocks of blocks: a
window sums inside a block, and what lies before it comes from the running
sum over block totals, found the same way.  With three levels a window holds
``block`` rows, and the top one the row count divided by ``block`` squared,
whatever the number of keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleaner.session import materialize

DEFAULT_BLOCK = 100_000
LEVELS = 3


def blocked_running_sum(df: DataFrame, value: str, order: str, by: list[str] | tuple = (),
                        out: str = "running", block: int = DEFAULT_BLOCK) -> DataFrame:
    """Inclusive running sum of ``value`` by the dense 1-based ``order``
    within ``by``.  The input is computed once (written to the shared
    checkpoint folder)."""
    return _running(materialize(df, "running"), value, order, list(by), out, block, LEVELS)


def _running(df: DataFrame, value: str, order: str, by: list[str], out: str, block: int, levels: int) -> DataFrame:
    if levels == 1:
        w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumn(out, F.sum(value).over(w))
    blk, total, pos, incl, off = (f"_{x}{levels}" for x in ("blk", "total", "pos", "incl", "off"))
    df = df.withColumn(blk, F.floor((F.col(order) - 1) / F.lit(block)).cast("long"))
    totals = df.groupBy(*by, blk).agg(F.sum(value).alias(total)).withColumn(pos, F.col(blk) + 1)
    before = (_running(totals, total, pos, by, incl, block, levels - 1)
              .select(*by, blk, (F.col(incl) - F.col(total)).alias(off)))
    inside = Window.partitionBy(*by, blk).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return (df.withColumn(incl, F.sum(value).over(inside)).join(before, [*by, blk])
            .withColumn(out, F.col(incl) + F.col(off)).drop(blk, incl, off))
