"""Cuckoo index, Merkle manifest, hard negatives: brute force, odd rows."""

import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from gleaner.llm import cuckoo, merkle, negatives
from gleaner.llm.queries import ORACLES
from tests.oracle import _rows

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
VECTORS = "vec_id long, embedding array<float>, label int"


def sql_rows(name, table, df, tmp_path):
    df.coalesce(1).write.parquet(str(tmp_path / table))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{tmp_path}/{table}/*.parquet')")
    res = con.execute(ORACLES[name])
    return _rows([d[0] for d in res.description], res.fetchall())


def shown(df):
    return _rows(df.columns, [tuple(r) for r in df.collect()])


# ---------------------------------------------------------------- 11 exact dedup

def test_cuckoo_filter_insert_delete_and_resize():
    rnd = random.Random(3)
    cuckoo_filter, live, refs = cuckoo.CuckooFilter(2), set(), {}
    for step in range(4000):
        if live and rnd.random() < 0.35:
            key = rnd.choice(sorted(live))
            assert cuckoo_filter.delete(key) == refs.pop(key)
            live.discard(key)
        else:
            key = f"k{rnd.randint(0, 3000)}"
            if cuckoo_filter.find(key) < 0:
                assert key not in live
                refs[key] = cuckoo_filter.insert(key)
                live.add(key)
            else:
                assert key in live
    assert cuckoo_filter.buckets > 2                                  # it overflowed and grew
    assert all(cuckoo_filter.find(k) == refs[k] for k in live)
    assert all(cuckoo_filter.find(f"absent{i}") < 0 for i in range(3000))
    assert cuckoo_filter.delete("absent") == -1
    assert sum(p != 0 for p in cuckoo_filter.prints) == len(live)


def test_hits_are_verified_on_stored_keys():
    """Equal fingerprints and buckets do not make keys equal."""
    f = cuckoo.CuckooFilter(1)
    f._places = lambda key: (7, 0, 0)
    for i in range(4):
        f.insert(f"k{i}")
    assert [f.find(f"k{i}") for i in range(4)] == [0, 1, 2, 3] and f.find("k9") == -1
    f.delete("k1")
    assert f.find("k1") == -1 and f.find("k3") == 3


def index_rows(spark, digests, first=0):
    return spark.createDataFrame([(first + i, 5, first + i, d) for i, d in enumerate(digests)],
                                 "doc_id long, points long, mark long, digest string")


def live_of(index):
    return {r["digest"]: (r["keep_id"], r["copies"]) for r in index.keys().collect()}


def test_index_insert_delete_lookup_and_growth(spark, monkeypatch):
    monkeypatch.setattr(cuckoo, "SHARD_KEYS", 16)
    first = cuckoo.insert(cuckoo.empty_index(spark), index_rows(spark, [f"d{i % 40}" for i in range(60)]))
    assert live_of(first) == {f"d{i}": (i, 2 if i < 20 else 1) for i in range(40)}
    gone = cuckoo.delete(first, spark.createDataFrame([("d3",), ("d39",), ("none",), (None,)], "digest string"))
    assert set(live_of(first)) - set(live_of(gone)) == {"d3", "d39"}     # the index given is as it was
    more = cuckoo.insert(gone, index_rows(spark, [f"d{i}" for i in range(300)], first=1000))
    assert more.bits > gone.bits > 0
    want = {f"d{i}": (i, 3 if i < 20 else 2) if i < 40 and i not in (3, 39) else (1000 + i, 1) for i in range(300)}
    assert live_of(more) == want
    asked = spark.createDataFrame([("d3",), ("d3",), ("d7",), ("none",), (None,)], "digest string")
    assert {tuple(r) for r in cuckoo.lookup(more, asked).collect()} == {("d3", 1003, 1), ("d7", 7, 3)}
    assert cuckoo.lookup(cuckoo.empty_index(spark), asked).count() == 0


def dup_texts():
    rnd = random.Random(5)
    base = ["", " \t", "a b", "ab", "a b", "a  b\n", "\U0001f600 x", "x" * 200_000, " " + "x" * 200_000, None, "\x0b\x0ca", "a"]
    return base + [rnd.choice(base[2:8]) for _ in range(60)] + ["hot text"] * 80 + ["hot  text"] * 3


def test_exact_duplicates_equal_sql_on_odd_rows(spark, tmp_path):
    docs = spark.createDataFrame([(i * 7 % 1009, t, None if i % 5 else "en", "s", None) for i, t in enumerate(dup_texts())], DOCS)
    got = cuckoo.exact_duplicates(docs.withColumn("digest", F.lit("clash")).withColumn("mark", F.lit(0)).withColumn("kept", F.lit(1)))
    assert shown(got) == sql_rows("op11_cuckoo_dedup", "documents", docs, tmp_path)


def test_colliding_digests_are_told_apart(spark, tmp_path):
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(dup_texts())], DOCS)
    weak = cuckoo.exact_duplicates(docs, digest=lambda t: (F.length(t) % 3).cast("string"))
    assert shown(weak) == sql_rows("op11_cuckoo_dedup", "documents", docs, tmp_path)


def test_exact_duplicates_repeated_rows_null_ids_empty_table(spark):
    docs = spark.createDataFrame([(4, "a", "l", "s", 1)] * 5 + [(None, "a ", "l", "s", 1), (None, "b", "l", "s", 1), (2, "b", "l", "s", 1)], DOCS)
    got = [tuple(r)[:4] for r in cuckoo.exact_duplicates(docs).collect()]
    assert sorted(got, key=repr) == sorted([(4, None, 6, False)] * 5 + [(None, None, 6, True), (None, 2, 2, False), (2, 2, 2, True)], key=repr)
    one = [tuple(r)[:4] for r in cuckoo.exact_duplicates(docs.where("doc_id = 4")).collect()]
    assert sorted(one) == [(4, 4, 5, False)] * 4 + [(4, 4, 5, True)]
    assert cuckoo.exact_duplicates(docs.where("doc_id = 99")).collect() == []


# ---------------------------------------------------------------- 12 Merkle manifest

def _sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def brute_merkle(rows):
    enc = lambda *v: _sha("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in v))

    def levels(h):
        out = [h]
        while len(out[-1]) > 1:
            out.append([_sha("".join(out[-1][i:i + 2])) for i in range(0, len(out[-1]), 2)])
        return out
    leaf = lambda r, more=0: enc(r[0], r[3], r[2], None if r[4] is None else r[4] + more, r[1])
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    of = {k: sorted((r for r in rows if r[2] == k), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for k in langs}
    trees = {k: levels([leaf(r) for r in of[k]]) for k in langs}
    top = levels([trees[k][-1][0] for k in langs])
    out = []
    for place, k in enumerate(langs):
        for i, r in enumerate(of[k]):
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            fold, proof = leaf(r, 1 if tampered else 0), ""
            for tree, p in ((trees[k], i), (top, place)):
                for level in tree[:-1]:
                    sibling = level[p ^ 1] if p ^ 1 < len(level) else ""
                    proof += sibling
                    fold = _sha(sibling + fold if p & 1 else fold + sibling)
                    p //= 2
            out.append((r[0], leaf(r), trees[k][-1][0], top[-1][0], _sha(proof), fold, fold == top[-1][0]))
    return sorted(out, key=repr)


def merkle_docs():
    rows = [(i * 3, f"text {i}", "aa", "s", i) for i in range(37)] + [(i, "", "bb", None, None) for i in range(500, 516)]
    rows += [(900 + i, None, None, "s", i) for i in range(5)] + [(1000, "lone", "zz", "é", 4), (1001, "x" * 100_000, "Zz", "s", 1)]
    rows += [(2000, "same", "cc", "s", 1)] * 3 + [(2000, "other", "cc", "s", 1), (None, "no id", "cc", "s", 2), (None, None, None, None, None)]
    return rows


@pytest.mark.parametrize("levels", [1, 2, 10])
def test_verified_leaves_equal_brute_force(spark, levels):
    rows = merkle_docs()
    docs = spark.createDataFrame(rows, DOCS).withColumn("leaf", F.lit("clash")).withColumn("tree", F.lit(1)).repartition(5)
    got = merkle.verified_leaves(docs, merkle.one_in_seven(), levels)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_merkle(rows)


def test_merkle_small_tables_and_oracle(spark, tmp_path):
    docs = spark.createDataFrame([r for r in merkle_docs() if r[0] not in (None, 2000)], DOCS)
    assert shown(merkle.verified_leaves(docs, merkle.one_in_seven())) == sql_rows("op12_merkle_manifest", "documents", docs, tmp_path)
    one = merkle.verified_leaves(docs.where("doc_id = 1000"), F.lit(False)).collect()
    assert len(one) == 1 and one[0]["leaf"] == one[0]["subroot"] == one[0]["root"] == one[0]["folded_root"]
    assert one[0]["verified"] and one[0]["proof_sha256"] == _sha("")
    assert merkle.verified_leaves(docs.where("doc_id = -1"), F.lit(True)).collect() == []
    every = merkle.verified_leaves(docs, F.lit(True))          # a null n_chars stays null: not tampered
    assert {r["verified"] for r in every.where("doc_id < 111 or doc_id > 899").collect()} == {False}
    assert {r["verified"] for r in every.where("doc_id between 500 and 515").collect()} == {True}
    # the recursion bounds of the session are as they were
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") == "1000000"


# ---------------------------------------------------------------- 13 hard negatives

@pytest.mark.parametrize("high", [1, 300, 10 ** 5, 10 ** 9, 10 ** 20])
def test_packed_products_are_exact(high):
    rnd = random.Random(high)
    codes = np.array([[rnd.randint(-high, high) for _ in range(7)] for _ in range(33)], object if high > 10 ** 15 else np.int64)
    block = negatives.PackedBlock(codes, high)
    for _ in range(20):
        vector = [rnd.choice([0, high, -high, rnd.randint(-high, high)]) for _ in range(7)]
        want = [sum(int(a) * int(b) for a, b in zip(row, vector)) for row in codes]
        assert [int(x) for x in block.products(vector)] == want
    assert block.width == (4 if high <= 300 else 8 if high <= 10 ** 5 else block.width)


def vector_rows(n, dims=6, labels=3, seed=1):
    rnd = random.Random(seed)
    return [(i, [rnd.choice([rnd.uniform(-1, 1), 0.5, -0.5]) for _ in range(dims)], rnd.randrange(labels)) for i in range(n)]


@pytest.mark.parametrize("tile", [64, 65_536])
def test_hard_negatives_equal_sql(spark, tmp_path, monkeypatch, tile):
    monkeypatch.setattr(negatives, "TILE_VALUES", tile)
    monkeypatch.setattr(negatives, "ANCHOR_VALUES", 2 * tile)
    rows = vector_rows(350) + [(400 + i, [0.5] * 6, i % 2) for i in range(150)]           # many ties
    rows += [(900, [0.1] * 5 + [None], 1), (1000, [float("nan")] * 6, 1), (1100, [float("inf")] + [0.0] * 5, 1),
             (1200, None, 1), (1300, [0.25] * 6, None), (1400, [0.0] * 6, 2), (1401, [-1e-9] * 6, 2), (1500, [-0.5] * 6, 2)]
    vectors = spark.createDataFrame(rows, VECTORS)
    got = negatives.hard_negatives(negatives.query_labels(vectors.withColumn("scaled", F.lit(1)).withColumn("qb", F.lit(2))),
                                   F.col("vec_id") % 100 == 0)
    want = sql_rows("op13_hard_negatives", "embeddings", vectors, tmp_path)
    assert shown(got) == want and len(want) > 50


def test_hard_negatives_odd_tables(spark):
    run = lambda rows: sorted(tuple(r) for r in negatives.hard_negatives(
        spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 100 == 0).collect())
    assert run([]) == [] and run([(1, [1.0], 1), (2, [1.0], 2)]) == []
    # repeated and null ids, other lengths, empty vectors
    rows = [(100, [1.0, 0.0], 1)] * 2 + [(None, [1.0, 0.0], 2), (1, [1.0, 0.0], 1), (2, [0.9, 0.0], 2), (3, [0.9], 2),
                                         (200, [], 4), (4, [], 4), (5, [], 5)]
    assert run(rows) == [(100, 1, 1, 2, 65536, 58880), (200, 4, 1, 5, 0, 0)]
    # components far beyond 53 bits
    big = [(100, [1e18], 1), (1, [1e-18], 1), (2, [1e30], 1), (3, [9e29], 2)]
    assert [r[:4] for r in run(big)] == [(100, 2, 1, 3)]
