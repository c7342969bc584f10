"""Mixing, vectors, urls, the pipeline and the registration."""

import random
from fractions import Fraction

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from gleaner.llm import ann, mixing, neardup, queries, url_filter
from tests.conftest import SF_SMALL

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


# ---------------------------------------------------------------- 1 mixing

def test_pfair_slots_stay_within_one_block():
    rnd = random.Random(1)
    for _ in range(150):
        quotas = {f"s{i}": rnd.randint(1, 40) for i in range(rnd.randint(1, 9))}
        total, got = sum(quotas.values()), dict.fromkeys(quotas, 0)
        for slot, s, k in mixing.pfair_slots(quotas):
            assert k == got[s]
            got[s] += 1
            assert all(abs(got[t] - quotas[t] * (slot + 1) / total) < 1 for t in quotas)
        assert got == quotas


def brute_mix(blocks, quotas):
    """Round by round, without phases."""
    out, r = [], 0
    while any(n > r * quotas[s] for s, n in blocks.items()):
        own = {s: min(quotas[s], n - r * quotas[s]) for s, n in blocks.items() if n > r * quotas[s]}
        out += [(s, r * quotas[s] + k) for _, s, k in mixing.pfair_slots(own)]
        r += 1
    return out


def test_mixed_order_equals_round_by_round_schedule(spark):
    rows = [(i, f"t{i}", "en", s, 2) for i, s in enumerate(["a"] * 300 + ["b"] * 70 + ["c"] * 33 + [None] * 5 + ["d"])]
    docs = spark.createDataFrame(rows, DOCS)
    weights = {"a": 3.0, "b": 1.0, "c": 0.5, "absent": 9.0}
    got = mixing.mixed_order(docs, weights, rest_weight=0.5, block_docs=4, round_slots=20).collect()
    assert len(got) == len(rows) and len({r["position"] for r in got}) == len(rows)
    name = lambda s: s if s in ("a", "b", "c") else mixing.REST
    blocks = {"a": 75, "b": 18, "c": 9, mixing.REST: 2}
    quotas = mixing.round_quotas({"a": 3.0, "b": 1.0, "c": 0.5, mixing.REST: 0.5}, 20)
    want = brute_mix(blocks, quotas)
    slots = {}
    for r in got:
        slots.setdefault(r["slot"], set()).add((name(r["source"]), r["block"]))
    assert [slots[i] for i in range(len(want))] == [{w} for w in want]
    # the prefix of each length follows the target while every source lasts
    full = sum(quotas.values())
    taken = [s for s, _ in want[:full]]
    assert all(taken.count(s) == q for s, q in quotas.items())


def shares(blocks, weights):
    """Each source's share at every slot: weights among the sources that last, a block at a time in fractions."""
    out, have = [], dict.fromkeys(blocks, Fraction(0))
    for _ in range(sum(blocks.values())):
        left = Fraction(1)
        while left:
            active = [s for s in blocks if have[s] < blocks[s]]
            total = sum(weights[s] for s in active)
            step = min([left] + [(blocks[s] - have[s]) * total / weights[s] for s in active])
            for s in active:
                have[s] += step * weights[s] / total
            left -= step
        out.append(dict(have))
    return out


@pytest.mark.parametrize("sizes", [[4] * 20, [32] * 20, [1 + 7 * i % 40 for i in range(20)]])
def test_every_prefix_follows_the_weights(spark, sizes):
    names = [f"src{i}" for i in range(20)]
    blocks = dict(zip(names, sizes))
    rows = [(i, f"t{i}", "en", s, 2) for i, s in enumerate(s for s, n in blocks.items() for _ in range(2 * n))]
    got = mixing.mixed_order(spark.createDataFrame(rows, DOCS), corpus_pipeline.MIX_WEIGHTS, block_docs=2).collect()
    at = {r["slot"]: r["source"] for r in got}
    assert len(got) == len(rows) and sorted(at) == list(range(sum(sizes)))
    weights = {s: Fraction(w) for s, w in corpus_pipeline.MIX_WEIGHTS.items()}
    have = dict.fromkeys(names, 0)
    for slot, share in enumerate(shares(blocks, weights)):
        have[at[slot]] += 1
        assert all(abs(have[s] - share[s]) < 1 for s in names), slot


def test_rounds_are_the_smallest_exact_ones():
    assert sum(mixing.exact_quotas(corpus_pipeline.MIX_WEIGHTS).values()) == 35
    assert mixing.exact_quotas({"a": 0.3, "b": 0.1, "c": 2.0}) == {"a": 3, "b": 1, "c": 20}
    assert sum(mixing.exact_quotas({"a": 0.123456789, "b": 1.0}).values()) == mixing.ROUND_SLOTS
    with pytest.raises(ValueError):
        mixing.exact_quotas({"a": 0.0})


def test_mixing_edge_cases(spark):
    docs = spark.createDataFrame([(1, "x", "en", "a", 1), (1, "x", "en", "a", 1), (None, "y", "en", "a", 1), (None, None, None, None, None)], DOCS)
    both = docs.withColumn("slot", F.lit(7)).withColumn("mix_source", F.lit("own"))
    out = mixing.mix_documents(both, {"a": 1.0})
    assert out.columns == both.columns and sorted(map(repr, out.collect())) == sorted(map(repr, both.collect()))
    assert mixing.mixed_order(docs.limit(0), {"a": 1.0}).count() == 0
    assert mixing.mix_documents(docs.limit(0), {"a": 1.0}).count() == 0
    with pytest.raises(ValueError):
        mixing.round_quotas({"a": 0.0}, 10)
    with pytest.raises(ValueError):
        mixing.round_quotas({str(i): 1.0 for i in range(11)}, 10)


def test_mixed_files_follow_the_order(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    mixing.mix_documents(docs, corpus_pipeline.MIX_WEIGHTS).write.parquet(str(tmp_path / "out"))
    files = sorted((tmp_path / "out").glob("part-*"))
    ids = [i for f in files for i in pq.read_table(f).column("doc_id").to_pylist()]
    want = [r["doc_id"] for r in mixing.mixed_order(docs, corpus_pipeline.MIX_WEIGHTS).orderBy("position").collect()]
    assert ids == want


# ---------------------------------------------------------------- 2 and 8 vectors

VECTORS = "vec_id long, embedding array<float>, label int"


def vector_rows(n=420, dim=16, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dim)).astype(np.float32)
    for i in range(0, 150, 3):
        x[i + 1] = x[i] + 0.02 * rng.standard_normal(dim)       # near copies
        x[i + 2] = x[i]                                         # copies
    for i in range(300, 400):
        x[i] = x[299] + 0.03 * rng.standard_normal(dim)         # a hot group
    rows = [(i, x[i].tolist(), int(i % 3 == 0 and i < 6) if i < 10 else (7 if 290 < i < 400 else i // 3 % 4)) for i in range(n)]
    bad = [(n, None, 1), (n + 1, [0.0] * dim, 1), (n + 2, [float("nan")] + [1.0] * (dim - 1), 1), (n + 3, [float("inf")] + [1.0] * (dim - 1), 1),
           (n + 4, [None] + [1.0] * (dim - 1), 1), (n + 5, [], 1), (n + 6, x[0].tolist(), None), (None, x[0].tolist(), 1), (5, rows[5][1], rows[5][2])]
    return rows, bad


def usable(v):
    return bool(v) and all(c is not None and np.isfinite(c) for c in v) and any(v)


def test_nearest_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ann, "CANDIDATE_BLOCK", 64)
    monkeypatch.setattr(ann, "QUERY_BLOCK", 16)
    monkeypatch.setattr(ann, "PRODUCT_ROWS", 5)
    rows, bad = vector_rows()
    got = ann.nearest(spark.createDataFrame(rows + bad, VECTORS).withColumn("rank", F.lit("own")), F.col("vec_id") % 10 == 0, 10).collect()
    keep = {i: np.array(v, float) for i, v, _ in rows + bad if i is not None and usable(v)}
    ids = np.array(sorted(keep))
    x = np.array([keep[i] for i in ids])
    by = {}
    for r in got:
        by.setdefault(r["query_id"], []).append(r)
    assert sorted(by) == [i for i in ids if i % 10 == 0]
    for q, rs in by.items():
        d = np.sqrt(((x - keep[q]) ** 2).sum(1))
        order = [j for j in np.lexsort((ids, d)) if ids[j] != q][:10]
        rs.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in rs] == list(range(1, 11))
        assert [r["vec_id"] for r in rs] == ids[order].tolist() and np.allclose([r["score"] for r in rs], d[order])


def test_nearest_with_few_candidates_and_none(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0], 1), (1, [0.0, 1.0], 1), (2, [5.0, 5.0, 5.0], 1)], VECTORS)
    got = ann.nearest(df, F.col("vec_id") == 0, 10).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in got] == [(0, 1, 1)]
    assert ann.nearest(df.limit(0), F.col("vec_id") == 0, 10).count() == 0


def test_quantisation_bounds_hold():
    rng = np.random.default_rng(5)
    q, c = rng.standard_normal((40, 24)), rng.standard_normal((60, 24)) * 3
    cq, sq, _, eq = ann.quantise(q)
    cc, sc, nc, ec = ann.quantise(c)
    approx = (cq.astype(float) * sq[:, None]) @ (cc.astype(float) * sc[:, None]).T
    bound = eq[:, None] * nc + np.linalg.norm(q, axis=1)[:, None] * ec
    assert (np.abs(q @ c.T - approx) <= bound + 1e-12).all()
    assert bound.max() < 0.02 * (np.linalg.norm(q, axis=1)[:, None] * np.linalg.norm(c, axis=1)).max()


def brute_links(rows, threshold=0.98):
    seen = {}
    for i, v, label in rows:
        if i is not None:
            seen[i] = min(seen.get(i, (label, v)), (label, v), key=repr)
    ids = sorted(seen)
    ok = [i for i in ids if seen[i][0] is not None and usable(seen[i][1])]
    unit = {i: np.array(seen[i][1], float) / np.linalg.norm(seen[i][1]) for i in ok}
    near = {i: [j for j in ok if j != i and seen[j][0] == seen[i][0] and unit[i] @ unit[j] >= threshold] for i in ok}
    comp = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for i in ok:
            least = min([comp[i]] + [comp[j] for j in near[i]])
            changed, comp[i] = changed or least != comp[i], least
    return {i: (len(near.get(i, [])), comp[i], comp[i] == i) for i in ids}


@pytest.mark.parametrize("block", [1024, 16])
def test_vector_links_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(neardup, "BLOCK", block)
    rows, bad = vector_rows()
    got = neardup.near_duplicate_vectors(spark.createDataFrame(rows + bad, VECTORS)).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got} == brute_links(rows + bad)
    assert max(r["n_links"] for r in got) > 50


def test_vector_dedup_of_nothing(spark):
    assert neardup.near_duplicate_vectors(spark.createDataFrame([], VECTORS)).count() == 0


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(8)
    x = rng.standard_normal((300, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    est, bound = neardup.estimates(x[:150], x[150:])
    error = est - x[:150] @ x[150:].T
    assert abs(error.mean()) < 0.01 and (np.abs(error) <= bound[:, None]).mean() > 0.9999


# ---------------------------------------------------------------- 5 urls

def test_rules_hosts_and_paths(spark):
    cases = {
        1: ("https://A.Example.ORG/es/x?q#f", "a.example.org", "/es/x", "example.org/es/", "block"),
        2: ("http://example.org/en/12", "example.org", "/en/12", "example.org/en/1", "block"),
        3: ("http://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"),
        4: ("http://x.com/fr/a", "x.com", "/fr/a", "com/fr/", "allow"),
        5: ("http://x.com/de/", "x.com", "/de/", "com/de/", "block"),
        6: ("http://x.com/en/", "x.com", "/en/", None, "allow"),
        7: (None, "", "", None, "allow"), 8: ("no scheme", "", "", None, "allow"),
        9: ("http://example.org", "example.org", "", None, "allow"),
        10: ("a://b://c.org/", "b:", "//c.org/", None, "allow"), 11: ("x://É.ORG?y=/", "É.org", "", None, "allow"),
    }
    df = spark.createDataFrame([(i, c[0], None) for i, c in cases.items()], "page_id long, url string, html string")
    got = {r["page_id"]: tuple(r)[1:] for r in url_filter.url_verdicts(df).select("page_id", "host", "path", "rule", "verdict").collect()}
    assert got == {i: c[1:] for i, c in cases.items()}
    assert url_filter.url_verdicts(df.limit(0)).count() == 0


def test_aliases_take_the_class_decision_and_allow_wins(spark):
    link = '<html><link href="{}" rel="canonical"></html>'.format
    refresh = "<META http-equiv=refresh content=\"0; url={}\">".format
    pages = [(1, "http://x.net/a", link("http://y.com/de/1")),           # names a blocked url
             (2, "https://x.net/a#top", None),                          # the same node as 1
             (3, "http://z.net/b", refresh("http://x.net/a?utm_source=q")),   # a chain
             (4, "http://w.net/c", link("http://y.com/de/2")), (5, "http://v.com/fr/", link("http://w.net/c")),   # an allowed member
             (6, "http://u.net/", link("/d")), (7, "http://u.net/d", None),
             (8, "http://y.com/de/9", link("http://v.com/fr/")),        # its own rule stands
             (9, "http://t.net/p/q", link("../r")), (10, "http://t.net/", link("mailto:a@b.c"))]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r["page_id"]: r["verdict"] for r in url_filter.url_verdicts(df).collect()}
    assert got == {1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "allow", 7: "allow", 8: "block", 9: "allow", 10: "allow"}
    assert "Python" not in url_filter.url_verdicts(df)._jdf.queryExecution().executedPlan().toString()


def test_urls_of_one_key_are_one_class_without_edges(spark):
    link = '<link rel="canonical" href="{}">'.format
    pages = [(1, "http://example.com:80/de/a", None), (2, "http://example.com/de/a", None),      # block by the port-less url's rule
             (3, "http://example.com:80/de/b", None), (4, "http://example.com:80/x", None),
             (5, "http://n.net/p/q/x", link("../de/1")), (6, "http://n.net/p/de/1", link("http://example.com/de/z")),
             (7, "http://n.net/k/x", link("http://example.com/a/./../de/9?u=../v")), (8, None, None), (9, "no url", None),
             (10, "http://n.net:80/a", None), (11, "http://n.net/a", link("http://example.com/de/k"))]
    got = {r["page_id"]: r["verdict"] for r in url_filter.url_verdicts(
        spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert {k for k, v in got.items() if v == "block"} == {1, 2, 5, 6, 7, 10, 11} and len(got) == len(pages)


def test_resolve_removes_dot_segments(spark):
    cases = {"../de/1": "http://h.net/de/1", "../../../d": "http://h.net/d", "./": "http://h.net/p/", "..": "http://h.net/",
             "a/b/../c?x=/../y#/./z": "http://h.net/p/a/c?x=/../y#/./z", "a..b/.c": "http://h.net/p/a..b/.c", "/.": "http://h.net/",
             "//k.net/a/../b": "http://k.net/b", "x//../y": "http://h.net/p/x/y", "mailto:a@b.c": None}
    df = spark.createDataFrame([(t,) for t in cases], "t string")
    got = {r["t"]: r["r"] for r in df.select("t", url_filter.resolve(F.col("t"), F.lit("http://h.net/p/q")).alias("r")).collect()}
    assert got == cases


# ---------------------------------------------------------------- pipeline, registration

def test_one_query_each_and_the_pipeline():
    names = entry.queries()
    assert [sum(k.startswith(f"op{n}_") for k in names) for n in range(1, 11)] == [1] * 10
    assert "pipeline" in names and set(queries.ORACLES) <= set(queries.QUERIES)


def test_pipeline_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    kept, before = docs, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, SF_SMALL).cache()
        assert kept.columns == docs.columns, name
        assert 0.5 * before < kept.count() <= before, name
        before = kept.count()
    texts = {r["doc_id"]: r["text"] for r in kept.collect()}
    out = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert {r["doc_id"] for r in out} == set(texts) and len(out) == len(texts)
    tok = queries.bpe.Tokenizer(corpus_pipeline.public_tokenizers.path(corpus_pipeline.VOCABULARY), corpus_pipeline.public_tokenizers.PATTERN)
    for r in out[:50]:
        assert tok.decode(np.array(r["tokens"], "<u4").tobytes()).decode() == (texts[r["doc_id"]] or "")


def test_pipeline_of_an_empty_table(spark):
    docs = spark.createDataFrame([], DOCS)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_SMALL)
    assert docs.count() == 0
