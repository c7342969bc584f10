"""Exact dedup by a cuckoo-filter index over content digests.

Digests are spread over shards by hash.  A shard keeps a cuckoo filter (two
buckets of four 16-bit fingerprints a digest) and, beside every fingerprint,
a reference to the stored key, so an answer of the filter is never believed:
a hit is compared with the whole digests that the bucket refers to, and in the
end with the texts.  A shard whose filter overflows doubles it and places its
stored keys anew; an index whose shards hold too many keys is cut into more
shards from its stored keys.  Filters and keys are rows of a written table;
``insert``, ``delete`` and ``lookup`` are one cogrouped job each and leave the
index that they were given as it was.

Rows are merged per digest and arrival lane before they are shuffled, so a
text that is a third of all rows reaches its shard as ``LANES`` rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm.common import BLOOM_BITS
from gleaner.session import materialize

SPACE = " \t\n\x0b\x0c\r"
SLOTS = 4            # fingerprints of a bucket
KICKS = 200          # moves before a filter counts as full
SHARD_KEYS = 1024    # digests a shard is planned for
LANES = 8            # rows of one digest that one insertion can bring to a shard
HOT_SHARE = 1000     # a group of more than 1 / HOT_SHARE of all rows is joined by broadcast: HOT_SHARE rows at most

KEY = "shard int, ref int, digest string, keep_id long, points long, mark long, copies long"
STATE = KEY + ", buckets int, prints binary, refs binary"
_NAMES = ["shard", "ref", "digest", "keep_id", "points", "mark", "copies", "buckets", "prints", "refs"]


class CuckooFilter:
    """Fingerprints of live keys with references to the keys themselves."""

    def __init__(self, buckets: int = 16):
        self.keys: list[str | None] = []
        self.free: list[int] = []
        self._clear(buckets)

    def _clear(self, buckets: int) -> None:
        self.buckets = buckets
        self.prints = [0] * (buckets * SLOTS)       # 0: an empty slot
        self.refs = [-1] * (buckets * SLOTS)

    def _places(self, key: str) -> tuple[int, int, int]:
        h = int.from_bytes(hashlib.blake2b(key.encode("utf-8"), digest_size=8).digest(), "little")
        mark = (h & 0xFFFF) or 1
        first = (h >> 16) & (self.buckets - 1)
        return mark, first, self._other(first, mark)

    def _other(self, bucket: int, mark: int) -> int:
        return bucket ^ ((mark * 0x5BD1E995) & (self.buckets - 1))

    def _slot(self, key: str) -> int:
        """Slot of a live key: fingerprints propose, stored keys decide."""
        mark, a, b = self._places(key)
        for bucket in (a, b):
            for s in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if self.prints[s] == mark and self.keys[self.refs[s]] == key:
                    return s
        return -1

    def find(self, key: str) -> int:
        """Reference of a live key, or -1."""
        s = self._slot(key)
        return -1 if s < 0 else self.refs[s]

    def insert(self, key: str) -> int:
        """Reference of the key, which must not be live yet."""
        if self.free:
            ref = self.free.pop()
            self.keys[ref] = key
        else:
            ref = len(self.keys)
            self.keys.append(key)
        if not self._place(key, ref):
            self._resize()
        return ref

    def delete(self, key: str) -> int:
        """Take a live key out; its reference, or -1 where there is none."""
        s = self._slot(key)
        if s < 0:
            return -1
        ref = self.refs[s]
        self.prints[s], self.refs[s], self.keys[ref] = 0, -1, None
        self.free.append(ref)
        return ref

    def _place(self, key: str, ref: int) -> bool:
        mark, bucket, other = self._places(key)
        for b in (bucket, other):
            for s in range(b * SLOTS, b * SLOTS + SLOTS):
                if not self.prints[s]:
                    self.prints[s], self.refs[s] = mark, ref
                    return True
        for k in range(KICKS):                      # move residents to their other bucket
            s = bucket * SLOTS + k % SLOTS
            mark, self.prints[s] = self.prints[s], mark
            ref, self.refs[s] = self.refs[s], ref
            bucket = self._other(bucket, mark)
            for t in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if not self.prints[t]:
                    self.prints[t], self.refs[t] = mark, ref
                    return True
        return False

    def _resize(self) -> None:
        """Double the filter until every stored key has its place."""
        while True:
            self._clear(self.buckets * 2)
            if all(self._place(key, ref) for ref, key in enumerate(self.keys) if key is not None):
                return


@dataclass(frozen=True)
class Index:
    """Written rows of filters (``ref`` null) and stored keys, in 2 ** bits shards."""
    state: DataFrame
    bits: int

    def keys(self) -> DataFrame:
        """digest, keep_id, points, mark, copies of the live digests."""
        return self.state.where("ref is not null").select("digest", "keep_id", "points", "mark", "copies")


def empty_index(spark: SparkSession, bits: int = 0) -> Index:
    return Index(spark.createDataFrame([], STATE), bits)


def _shard(bits: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(1 << bits)).cast("int")


def _load(state: pa.Table) -> tuple[CuckooFilter, dict[int, list]]:
    """The shard's filter and its entries [keep_id, points, mark, copies] by reference."""
    cuckoo, entries, stored = CuckooFilter(), {}, None
    for r in state.to_pylist():
        if r["ref"] is None:
            stored = r
        else:
            entries[r["ref"]] = [r["digest"], r["keep_id"], r["points"], r["mark"], r["copies"]]
    if stored is not None:
        cuckoo.buckets = stored["buckets"]
        cuckoo.prints = np.frombuffer(stored["prints"], np.uint16).tolist()
        cuckoo.refs = np.frombuffer(stored["refs"], np.int32).tolist()
        cuckoo.keys = [None] * (max(entries, default=-1) + 1)
        for ref, entry in entries.items():
            cuckoo.keys[ref] = entry[0]
        cuckoo.free = [ref for ref, key in enumerate(cuckoo.keys) if key is None]
    return cuckoo, {ref: entry[1:] for ref, entry in entries.items()}


def _store(shard: int, cuckoo: CuckooFilter, entries: dict[int, list]) -> pa.Table:
    refs = sorted(entries)
    n = len(refs)
    columns = {
        "shard": [shard] * (n + 1), "ref": [*refs, None], "digest": [*(cuckoo.keys[r] for r in refs), None],
        **{c: [*(entries[r][i] for r in refs), None] for i, c in enumerate(("keep_id", "points", "mark", "copies"))},
        "buckets": [None] * n + [cuckoo.buckets],
        "prints": [None] * n + [np.asarray(cuckoo.prints, np.uint16).tobytes()],
        "refs": [None] * n + [np.asarray(cuckoo.refs, np.int32).tobytes()]}
    kinds = {"shard": pa.int32(), "ref": pa.int32(), "digest": pa.string(), "buckets": pa.int32(), "prints": pa.binary(), "refs": pa.binary()}
    return pa.table({c: pa.array(columns[c], kinds.get(c, pa.int64())) for c in _NAMES})


def _better(a: list, b: list) -> bool:
    """Whether entry a = [keep_id, points, mark, ...] stays before b: more code
    points, then the smaller id (a null id last), then the earlier row."""
    if a[1] != b[1]:
        return a[1] > b[1]
    if a[0] != b[0]:
        return b[0] is None or (a[0] is not None and a[0] < b[0])
    return a[2] < b[2]


def _insert(arrivals: pa.Table, state: pa.Table) -> pa.Table:
    cuckoo, entries = _load(state)
    for r in arrivals.to_pylist():
        entry = [r["keep_id"], r["points"], r["mark"], r["copies"]]
        ref = cuckoo.find(r["digest"])
        if ref < 0:
            entries[cuckoo.insert(r["digest"])] = entry
            continue
        live = entries[ref]
        copies = live[3] + entry[3]
        entries[ref] = entry if _better(entry, live) else live
        entries[ref][3] = copies
    shard = (arrivals if arrivals.num_rows else state).column("shard")[0].as_py()
    return _store(shard, cuckoo, entries)


def _delete(gone: pa.Table, state: pa.Table) -> pa.Table:
    cuckoo, entries = _load(state)
    for digest in gone.column("digest").to_pylist():
        entries.pop(cuckoo.delete(digest), None)
    shard = (gone if gone.num_rows else state).column("shard")[0].as_py()
    return _store(shard, cuckoo, entries)


def _lookup(asked: pa.Table, state: pa.Table) -> pa.Table:
    cuckoo, entries = _load(state)
    found = [(d, ref) for d in asked.column("digest").to_pylist() if (ref := cuckoo.find(d)) >= 0]
    return pa.table({"digest": pa.array([d for d, _ in found], pa.string()),
                     "keep_id": pa.array([entries[ref][0] for _, ref in found], pa.int64()),
                     "copies": pa.array([entries[ref][3] for _, ref in found], pa.int64())})


def _cogroup(rows: DataFrame, index: Index, step: Callable, schema: str) -> DataFrame:
    return rows.groupBy("shard").cogroup(index.state.groupBy("shard")).applyInArrow(step, schema)


def bits_for(keys: int) -> int:
    return max(0, (max(keys, 1) - 1) // SHARD_KEYS).bit_length()


def arrivals(rows: DataFrame) -> DataFrame:
    """digest, keep_id, points, mark, copies: ``rows`` (doc_id, points, mark,
    digest) merged per digest and lane, the row that stays first."""
    best = F.max(F.struct("points", F.bitwise_not("doc_id").alias("id"), F.bitwise_not("mark").alias("m")))
    return (rows.groupBy("digest", F.pmod("mark", F.lit(LANES)).alias("lane")).agg(best.alias("b"), F.count(F.lit(1)).alias("copies"))
            .select("digest", F.bitwise_not("b.id").alias("keep_id"), F.col("b.points").cast("long").alias("points"),
                    F.bitwise_not("b.m").alias("mark"), "copies"))


def insert(index: Index, rows: DataFrame) -> Index:
    """The index with ``rows`` (doc_id, points, mark, digest); a digest that is
    live already gains their copies and keeps the better row.

    ``mark`` numbers rows uniquely.  Null digests take no part."""
    new = arrivals(rows.where("digest is not null"))
    stored = index.keys()
    bits = max(index.bits, bits_for(rows.count() + stored.count()))
    if bits > index.bits:          # more shards: every filter is built anew from the stored keys
        new = new.unionByName(stored)
        index = empty_index(new.sparkSession, bits)
    state = _cogroup(new.withColumn("shard", _shard(bits)), index, _insert, STATE)
    return Index(materialize(state, "cuckoo"), bits)


def delete(index: Index, digests: DataFrame) -> Index:
    """The index without the given digests (column ``digest``); those that
    are not live, and nulls, change nothing."""
    gone = digests.select("digest").where("digest is not null").distinct().withColumn("shard", _shard(index.bits))
    return Index(materialize(_cogroup(gone, index, _delete, STATE), "cuckoo"), index.bits)


def lookup(index: Index, digests: DataFrame) -> DataFrame:
    """digest, keep_id, copies of the given digests that are live."""
    asked = digests.select("digest").where("digest is not null").distinct().withColumn("shard", _shard(index.bits))
    return _cogroup(asked, index, _lookup, "digest string, keep_id long, copies long")


def normalised(text: Column) -> Column:
    """The text without white space; null is empty."""
    return F.translate(F.coalesce(text, F.lit("")), SPACE, "")


def colliding(contents: DataFrame, index: Index) -> DataFrame:
    """Digests of ``contents`` (digest, content) that stand for several texts.

    Only digests with copies need the look: they go through a Bloom filter of
    fixed size, which lets some others pass and none of them out."""
    bit = F.pmod(F.xxhash64("digest", F.lit("bloom")), F.lit(BLOOM_BITS))
    word, mask = (bit / 64).cast("int"), F.call_function("shiftleft", F.lit(1).cast("long"), (bit % 64).cast("int"))
    words = (index.keys().where("copies > 1").select(word.alias("_word"), mask.alias("_mask"))
             .groupBy("_word").agg(F.bit_or("_mask").alias("_bits")))
    return (contents.withColumn("_word", word).join(F.broadcast(words), "_word")     # BLOOM_BITS / 64 rows at most
            .where(F.col("_bits").bitwiseAND(mask) != 0).select("digest", "content").distinct()
            .groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("digest"))


def exact_duplicates(docs: DataFrame, digest: Callable[[Column], Column] | None = None) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of ``docs``.

    Texts are equal when identical without white space; a null text is empty.
    Of equal texts the row with the most code points stays, then the one with
    the smallest doc_id (null ids last); of wholly equal rows one.  An empty
    table gives no rows; other columns are not looked at.

    ``digest`` (of the normalised text, SHA-256 where not given) only finds
    candidates: where it gives several texts one digest, these texts' own
    content is their key and the index is built again."""
    text = normalised(F.col("text"))
    of = F.sha2(text, 256) if digest is None else digest(text)
    shown = docs.select(F.monotonically_increasing_id().alias("mark"), F.col("doc_id").cast("long").alias("doc_id"),
                        F.length(F.coalesce("text", F.lit(""))).alias("points"), F.sha2(text, 256).alias("text_sha256"),
                        of.alias("digest"), text.alias("content"))
    rows = materialize(shown.drop("content"), "cuckoo-rows")
    index = insert(empty_index(docs.sparkSession), rows)
    several = materialize(colliding(shown.select("digest", "content"), index), "cuckoo-collisions")
    if not several.isEmpty():
        own = F.when(F.col("several"), F.concat("digest", F.lit(":"), "content")).otherwise(F.col("digest"))
        told = shown.join(several.withColumn("several", F.lit(True)), "digest", "left").withColumn("digest", own)
        rows = materialize(told.drop("several", "content"), "cuckoo-rows")
        index = insert(empty_index(docs.sparkSession), rows)
    return _verdicts(rows, index)


def _verdicts(rows: DataFrame, index: Index) -> DataFrame:
    """Every row with its group.  Groups of more than 1 / HOT_SHARE of the
    rows, which are fewer than HOT_SHARE, are broadcast; the rest are joined."""
    groups = index.keys().select("digest", "keep_id", F.col("mark").alias("keep_mark"), F.col("copies").alias("group_size"))
    limit = rows.count() // HOT_SHARE
    hot = F.broadcast(groups.where(F.col("group_size") > limit))
    shown = lambda df: df.select("doc_id", "keep_id", "group_size", (F.col("mark") == F.col("keep_mark")).alias("kept"), "text_sha256")
    some = rows.join(F.broadcast(groups.where(F.col("group_size") > limit).select("digest")), "digest", "left_anti")
    return shown(rows.join(hot, "digest")).unionByName(shown(some.join(groups.where(F.col("group_size") <= limit), "digest")))
