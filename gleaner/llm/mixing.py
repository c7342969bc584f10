"""Mixing sources to target weights by Pfair scheduling.

A source's documents, in an order shuffled by hash, are cut into blocks of
``block_docs``.  Weights become the smallest whole quotas in their proportions,
so a round of as many slots as they add up to holds every source's share
exactly.  The share itself is a fluid: after u rounds a source with quota q and
n blocks has had min(q * u, n) of them, at slot t(u), the sum of these over all
sources.  So weights hold until a source's last block and the others go on in
their proportions from there, in the middle of a round too.  Block k (from 0)
is released at slot floor(t(k / q)) and due before slot ceil(t((k + 1) / q));
every slot takes the released block with the earliest deadline.  On one
resource that keeps every source less than one block from its share at every
slot, whatever the sources' sizes.

At the end of a round every source is exactly at its share, so all rounds with
the same blocks have the same schedule.  Rounds change only where a source
runs out: its last round holds what is left, later rounds go on without it,
and no document is dropped or repeated.  With S weighted sources there are at
most 2 S + 1 phases of equal rounds.  Their bounds are worked out from one
count a source; the slots of each phase are scheduled in a Spark task of its
own, and every block finds its slot by an equi-join.

The scheduled sources are those named in ``weights``; all others share one
entry, so the schedule's size follows the parameters, never the data.
Documents are numbered inside windows over (source, hash range) of about
``RANGE_ROWS`` rows, so a source with a third of all rows is spread like any
other.
"""

from __future__ import annotations

import heapq
from collections.abc import Mapping
from fractions import Fraction
from math import gcd, lcm

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.session import materialize

ROUND_SLOTS = 1000    # blocks of a full round where the weights have no exact one of EXACT_SLOTS
EXACT_SLOTS = 100_000 # longest round taken to hold the weights exactly
BLOCK_DOCS = 16       # documents of a block
RANGE_ROWS = 4096     # rows aimed at in one numbering window
REST = "(rest)"       # the entry of sources without a weight of their own


def pfair_slots(blocks: Mapping[str, int], quotas: Mapping[str, int] | None = None) -> list[tuple[int, str, int]]:
    """(slot, source, k) of one round: the earliest deadline first among
    released blocks, ties by source name.  ``quotas`` are those of a full
    round, of which the sources still have ``blocks``; None: the same."""
    quotas = quotas or blocks
    held = [(quotas[s], n) for s, n in blocks.items() if n > 0]

    def scaled(s: str, k: int) -> int:
        """The slot, times s's quota, at which s's share reaches k blocks."""
        return sum(min(q * k, n * quotas[s]) for q, n in held)

    def entry(s: str, k: int) -> tuple[int, int, str, int]:
        return scaled(s, k) // quotas[s], -(-scaled(s, k + 1) // quotas[s]), s, k     # release, deadline, source, k

    waiting = [entry(s, 0) for s, n in blocks.items() if n > 0]
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int]] = []
    out = []
    for slot in range(sum(blocks.values())):
        while waiting and waiting[0][0] <= slot:
            _, due, s, k = heapq.heappop(waiting)
            heapq.heappush(ready, (due, s, k))
        _, s, k = heapq.heappop(ready)
        out.append((slot, s, k))
        if k + 1 < blocks[s]:
            heapq.heappush(waiting, entry(s, k + 1))
    return out


def exact_quotas(weights: Mapping[str, float]) -> dict[str, int]:
    """The smallest whole numbers in the weights' proportions; weights whose
    round would be longer than EXACT_SLOTS are rounded to ROUND_SLOTS."""
    if any(not w > 0 for w in weights.values()):
        raise ValueError("weights must be positive")
    parts = {s: Fraction(str(w)) for s, w in weights.items()}       # as written: 0.1 is a tenth
    whole = lcm(*[f.denominator for f in parts.values()])
    quotas = {s: int(f * whole) for s, f in parts.items()}
    shared = gcd(*quotas.values())
    quotas = {s: q // shared for s, q in quotas.items()}
    return quotas if sum(quotas.values()) <= EXACT_SLOTS else round_quotas(weights, max(ROUND_SLOTS, len(weights)))


def round_quotas(weights: Mapping[str, float], round_slots: int) -> dict[str, int]:
    """Whole quotas of a round, at least one each, by largest remainder."""
    if any(not w > 0 for w in weights.values()):
        raise ValueError("weights must be positive")
    if len(weights) > round_slots:
        raise ValueError(f"{len(weights)} weighted sources need a round of as many slots at least")
    total = sum(weights.values())
    exact = {s: w * round_slots / total for s, w in weights.items()}
    quotas = {s: max(1, int(x)) for s, x in exact.items()}
    by_rest = sorted(weights, key=lambda s: (int(exact[s]) - exact[s], s))
    for s in by_rest[:max(0, round_slots - sum(quotas.values()))]:
        quotas[s] += 1
    return quotas


def phases(blocks: Mapping[str, int], quotas: Mapping[str, int]) -> list[tuple[int, int, dict[str, int]]]:
    """(first round, first slot, blocks of a round) of each stretch of equal rounds."""
    marks = sorted({0} | {b // quotas[s] for s, b in blocks.items()} | {-(-b // quotas[s]) for s, b in blocks.items()})
    out, start = [], 0
    for a, b in zip(marks, marks[1:]):
        own = {s: min(quotas[s], n - a * quotas[s]) for s, n in blocks.items() if n > a * quotas[s]}
        out.append((a, start, own))
        start += (b - a) * sum(own.values())
    return out


def _unit_key() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text"))


def _entry(weights: Mapping[str, float]) -> Column:
    source = F.col("source").cast("string")
    return F.when(source.isin(list(weights)), source).otherwise(F.lit(REST))


def mix_positions(docs: DataFrame, weights: Mapping[str, float], rest_weight: float = 1.0,
                  block_docs: int = BLOCK_DOCS, round_slots: int | None = None) -> DataFrame:
    """The mixed order: one row per (mix_source, mix_key) with block, slot
    and position, ``position`` rising in mixed order (slot * block_docs +
    place in the block).

    mix_key is the doc_id, or the text's hash where the id is null; repeated
    rows share their place.  Null sources count with the rest; weights of
    absent sources have no effect; no rows give no rows.

    ``round_slots`` asks for rounds of a fixed length, each spread evenly on
    its own: there the blocks of a source's last round follow what is left of
    it, not the weights.  None (all queries) keeps to the weights throughout."""
    spark = docs.sparkSession
    weights = {**weights, REST: rest_weight}
    units = materialize(docs.select(_entry(weights).alias("mix_source"), _unit_key().alias("mix_key")).distinct(), "mix-units")
    sizes = {r["mix_source"]: r["count"] for r in units.groupBy("mix_source").count().collect()}   # one row a weight at most
    if not sizes:
        return units.select("mix_source", "mix_key", *[F.lit(0).cast("long").alias(c) for c in ("block", "slot", "position")])
    present = {s: weights[s] for s in sizes}
    quotas = exact_quotas(present) if round_slots is None else round_quotas(present, round_slots)
    plan = phases({s: -(-n // block_docs) for s, n in sizes.items()}, quotas)

    # place in the source: hash ranges, rows inside a range, rows before it
    ranges = max(1, sum(sizes.values()) // RANGE_ROWS)
    units = units.withColumn("_h", F.xxhash64("mix_key", F.lit("mix")))
    units = units.withColumn("_range", F.floor((F.col("_h").cast("double") / F.lit(2.0 ** 64) + 0.5) * ranges).cast("long"))
    inside = Window.partitionBy("mix_source", "_range").orderBy("_h", "mix_key")
    before = Window.partitionBy("mix_source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (units.groupBy("mix_source", "_range").agg(F.count(F.lit(1)).alias("_n"))
               .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0).cast("long"))).drop("_n"))
    placed = (units.withColumn("_rn", F.row_number().over(inside)).join(offsets, ["mix_source", "_range"])
              .withColumn("_i", F.col("_before") + F.col("_rn") - 1)
              .withColumn("block", F.floor(F.col("_i") / block_docs).cast("long")))

    quota = F.element_at(F.create_map(*[F.lit(x) for s, q in quotas.items() for x in (s, q)]), F.col("mix_source"))
    starts = F.array(*[F.lit(a).cast("long") for a, _, _ in plan])       # 2 S + 1 at most
    placed = (placed.withColumn("_round", F.floor(F.col("block") / quota).cast("long"))
              .withColumn("k", F.col("block") % quota)
              .withColumn("first_round", F.array_max(F.filter(starts, lambda a: a <= F.col("_round")))))

    table = spark.createDataFrame([(a, start, sum(own.values()), own) for a, start, own in plan],
                                  "first_round long, first_slot long, period long, blocks map<string,long>")

    def schedule(batches):
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                blocks = {s: int(n) for s, n in dict(r.blocks).items()}
                got = pd.DataFrame(pfair_slots(blocks, quotas if round_slots is None else None), columns=["at", "mix_source", "k"])
                yield got.assign(first_round=r.first_round, first_slot=r.first_slot, period=r.period)

    slots = materialize(table.repartition(max(1, len(plan))).mapInPandas(
        schedule, "at long, mix_source string, k long, first_round long, first_slot long, period long"), "mix-slots")
    slot = F.col("first_slot") + (F.col("_round") - F.col("first_round")) * F.col("period") + F.col("at")
    return (placed.join(slots, ["mix_source", "first_round", "k"])
            .select("mix_source", "mix_key", "block", slot.alias("slot"),
                    (slot * block_docs + F.col("_i") % block_docs).alias("position")))


def mixed_order(docs: DataFrame, weights: Mapping[str, float], rest_weight: float = 1.0,
                block_docs: int = BLOCK_DOCS, round_slots: int | None = None) -> DataFrame:
    """One row per document row: doc_id, source, block, slot, position."""
    places = mix_positions(docs, weights, rest_weight, block_docs, round_slots)
    rows = docs.select(F.col("doc_id").alias("doc_id"), F.col("source").alias("source"),
                       _entry(weights).alias("mix_source"), _unit_key().alias("mix_key"))
    return rows.join(places, ["mix_source", "mix_key"]).select("doc_id", "source", "block", "slot", "position")


def mix_documents(docs: DataFrame, weights: Mapping[str, float], rest_weight: float = 1.0,
                  block_docs: int = BLOCK_DOCS, round_slots: int | None = None) -> DataFrame:
    """All rows of ``docs``, columns unchanged, laid out in mixed order: the
    partitions follow one another in position, and so do the rows in each.
    Positions are dense, so partition bounds are arithmetic, not sampled."""
    spark = docs.sparkSession
    places = materialize(mix_positions(docs, weights, rest_weight, block_docs, round_slots)
                         .select(F.col("mix_source").alias("_mix_source"), F.col("mix_key").alias("_mix_key"),
                                 F.col("position").alias("_mix_position")), "mix-places")
    top = places.agg(F.max("_mix_position")).first()[0]
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    names = [f"_c{i}" for i in range(len(docs.columns))]       # clear of any column's name
    rows = docs.select(*[docs[c].alias(n) for c, n in zip(docs.columns, names)],
                       _entry(weights).alias("_mix_source"), _unit_key().alias("_mix_key"))
    rows = rows.join(places, ["_mix_source", "_mix_key"])
    part = F.floor(F.col("_mix_position") * parts / F.lit((top or 0) + 1)).cast("int")
    laid = rows.repartitionById(parts, part).sortWithinPartitions("_mix_position", "_mix_key")
    return laid.select(*[F.col(n).alias(c) for c, n in zip(docs.columns, names)])
