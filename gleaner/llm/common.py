"""Helpers shared by the operators: Arrow text access, chunking, connected
components over plain DataFrame joins."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.session import materialize

# Bytes of text one numpy pass works on: temporaries are a few dozen bytes
# per text byte, so a task's memory follows this and its longest document.
CHUNK_BYTES = 1 << 19
EDGES = 1 << 20          # edges of a graph that one numpy pass contracts
BLOOM_BITS = 1 << 23     # of the filter in texts_of: 131,072 rows of 64 bits at most


def utf8_parts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary Arrow array; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("" if pa.types.is_string(texts.type) or pa.types.is_large_string(texts.type) else b"")
    large = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    width = np.int64 if large else np.int32
    _, offsets, values = texts.buffers()
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offsets, width)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def row_chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each (one row at least)."""
    start, n = 0, len(offsets) - 1
    while start < n:
        end = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        end = min(max(end, start + 1), n)
        yield start, end
        start = end


def mix64(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix64's), elementwise."""
    x = np.asarray(x, np.uint64).copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def least_nodes(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, the least node that each reaches by the edges u, v)."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b, low = at[:len(u)], at[len(u):], np.arange(len(nodes))
    while len(a):
        x, y = low[a], low[b]
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(low, np.maximum(x, y), np.minimum(x, y))
        while (low[low] != low).any():
            low = low[low]
    return nodes, nodes[low]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def star(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        nodes, least = least_nodes(*(np.concatenate([b.column(i).to_numpy() for b in held]) for i in (0, 1)))
        other = nodes != least
        return pa.RecordBatch.from_arrays([pa.array(nodes[other]), pa.array(least[other])], ["u", "v"])

    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= EDGES:
            yield star(held)
            held, rows = [], 0
    if held:
        yield star(held)


def contracted(edges: DataFrame, count: int) -> DataFrame:
    """Fewer edges (u, v) with the same components, for about ``count`` edges
    between long ids: a task replaces every EDGES of its edges by one edge a
    node, to the least node it reaches by them.  Nothing is shuffled; there
    is a task for each EDGES edges, and one more."""
    return (edges.where("u is not null and v is not null").select("u", "v").coalesce(2 + count // EDGES)
            .mapInArrow(_contract, "u long, v long"))


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v), the component
    being its smallest node.

    Alternating large-star / small-star: each half round is one partial
    aggregate and one equi-join whose streamed side adaptive execution can
    split, so a hub with very many neighbours is never one task.  Every
    round is written to the shared checkpoint folder.  Self-loops and null
    ends are ignored; no edges give no rows."""
    spark = edges.sparkSession
    pairs = (edges.where("u is not null and v is not null and u != v")
             .select(F.greatest("u", "v").alias("a"), F.least("u", "v").alias("b")).distinct())
    pairs = materialize(pairs, "cc")
    mark = None
    for _ in range(max_rounds):
        both = pairs.select(F.col("b").alias("n"), F.col("a").alias("x")).unionAll(
            pairs.select(F.col("a").alias("n"), F.col("b").alias("x")))
        low = both.groupBy("n").agg(F.min("x").alias("m")).select("n", F.least("n", "m").alias("m"))
        large = (pairs.join(low, pairs["b"] == low["n"]).where("a != m")
                 .select("a", F.col("m").alias("b")).distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionAll(least.select("a", F.col("m").alias("b"))).distinct())
        pairs = materialize(small, "cc")
        got = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").bitwiseAND(F.lit((1 << 40) - 1)))).first()
        if got == mark:
            break
        mark = got
    else:
        raise RuntimeError(f"connected components: no fixed point after {max_rounds} rounds")
    roots = pairs.select(F.col("b").alias("node")).distinct()
    return (pairs.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .unionAll(roots.select("node", F.col("node").alias("component"))))


def texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc_id, text) of the documents whose ids are in ``wanted``.

    A Bloom filter of fixed size, built from all wanted ids, is broadcast
    first, so that few other texts enter the join's shuffle; the join decides."""
    ids = materialize(wanted.select("doc_id").distinct(), "wanted")
    bit = F.pmod(F.xxhash64("doc_id", F.lit("bloom")), F.lit(BLOOM_BITS))
    word, mask = (bit / 64).cast("int"), F.call_function("shiftleft", F.lit(1).cast("long"), (bit % 64).cast("int"))
    words = ids.select(word.alias("_word"), mask.alias("_mask")).groupBy("_word").agg(F.bit_or("_mask").alias("_bits"))
    return (docs.select("doc_id", "text").withColumn("_word", word).join(F.broadcast(words), "_word")   # BLOOM_BITS / 64 rows at most
            .where(F.col("_bits").bitwiseAND(mask) != 0).select("doc_id", "text").join(ids, "doc_id", "left_semi"))
