"""Row numbers inside a group without putting the group in one task.

``row_number() OVER (PARTITION BY g ORDER BY o)`` sends every row of a group
to one task.  Here rows are range-partitioned on (g, o), so a group of any
size is spread over as many ranges as it fills, and the ranges of a group
follow one another.  A window inside (range, group) numbers the rows of a
range; the rows that a group has in earlier ranges are a prefix sum over one
row per (range, group), joined back.  The ranged rows are written once to the
shared checkpoint folder, so the range number of a row is fixed."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleaner.session import materialize


def row_number_within(df: DataFrame, group: list[str], order: list[str], out: str = "pos",
                      partitions: int | None = None) -> DataFrame:
    """Add ``out`` = 1-based position of each row inside its group, by the
    ascending ``order`` columns (which must make rows unique in a group)."""
    n = partitions or max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    ranged = materialize(df.repartitionByRange(n, *group, *order)
                         .withColumn("_range", F.spark_partition_id()), "ranged")
    inside = Window.partitionBy("_range", *group).orderBy(*order)
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = (ranged.groupBy("_range", *group).agg(F.count(F.lit(1)).alias("_n"))
              .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
              .select(F.col("_range").alias("_r"), *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], "_before"))
    local = ranged.withColumn("_local", F.row_number().over(inside))
    same = [local["_range"] == counts["_r"]] + [local[g].eqNullSafe(counts[f"_g{i}"]) for i, g in enumerate(group)]
    return (local.join(counts, same)
            .select(*[local[c] for c in df.columns], (F.col("_local") + F.col("_before")).cast("long").alias(out)))
