"""Operators over documents: brute force, round trips and defined cases."""

import hashlib
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gleaner import session
from gleaner.llm import bpe, jaccard, langid, passages, secret_scan, shingles, toxicity
from gleaner.llm.common import connected_components, utf8_parts
from tests.conftest import SF_SMALL

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, texts, first=0):
    return spark.createDataFrame([(first + i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(texts)], DOCS)


def rows_by(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


# ---------------------------------------------------------------- shared pieces

def test_word_hashes_split_and_fold_like_python():
    texts = ["The  cat\tsat", "", " the CAT sat ", "x", "\x0b\x0c", "tHe\ncat sat É É"]
    raw, off = utf8_parts(pa.array(texts))
    got = [w.tolist() for _, w in shingles.text_words(raw, off)]
    assert [len(g) for g in got] == [3, 0, 3, 1, 0, 5]
    assert got[0] == got[2] == got[5][:3] and got[5][3] == got[5][4]
    sliced = pa.array(["zz"] + texts).slice(1)
    assert [w.tolist() for _, w in shingles.text_words(*utf8_parts(sliced))] == got


def test_connected_components_against_union_find(spark):
    rnd = random.Random(4)
    edges = [(rnd.randint(0, 400), rnd.randint(0, 400)) for _ in range(260)] + [(1000, x) for x in range(1001, 1400)]
    edges += [(i, i + 1) for i in range(2000, 2040)] + [(5, 5), (None, 3)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in edges:
        if u is not None and u != v:
            a, b = root(u), root(v)
            parent[max(a, b)] = min(a, b)
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: root(x) for x in parent}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_contracted_edges_keep_the_components(spark, monkeypatch):
    from gleaner.llm import common
    rnd = random.Random(9)
    edges = [(rnd.randint(0, 300), rnd.randint(0, 300)) for _ in range(250)] + [(i + 1, i) for i in range(1000, 1100)] + [(7, 7)]
    df = spark.createDataFrame([*edges, (None, 3), (4, None)], "u long, v long").repartition(8)
    whole = sorted(tuple(r) for r in connected_components(df).collect())
    fewer = common.contracted(df, len(edges))
    assert fewer.rdd.getNumPartitions() == 2 and fewer.count() < len(edges)
    assert sorted(tuple(r) for r in connected_components(fewer).collect()) == whole
    # several passes in one task: each holds about EDGES edges at most
    monkeypatch.setattr(common, "EDGES", 40)
    batch = pa.RecordBatch.from_arrays([pa.array([e[i] for e in edges], pa.int64()) for i in (0, 1)], ["u", "v"])
    passes = [b.to_pylist() for b in common._contract(batch.slice(k, 20) for k in range(0, len(edges), 20))]
    assert len(passes) == 9 and all(len({r["u"] for r in p}) == len(p) <= 80 for p in passes)
    got = spark.createDataFrame([(r["u"], r["v"]) for p in passes for r in p], "u long, v long")
    assert sorted(tuple(r) for r in connected_components(got).collect()) == whole


def test_star_rounds_need_no_whole_components(spark, monkeypatch):
    """One exact run of connected components, however many star rounds; the links are those of brute force."""
    runs = []
    monkeypatch.setattr(jaccard, "connected_components", lambda edges: runs.append(1) or connected_components(edges))
    rnd = random.Random(3)
    base = [f"w{rnd.randint(0, 999)}" for _ in range(120)]
    docs = []
    for i in range(60):                                # near copies: a chain of components needs several rounds
        words = list(base)
        for at in rnd.sample(range(120), 2):
            words[at] = f"x{rnd.randint(0, 3)}"
        docs.append((i, " ".join(words)))
    docs += [(100 + i, " ".join(f"v{rnd.randint(0, 999)}" for _ in range(50))) for i in range(10)]
    got = {r["doc_id"]: r["component_id"] for r in jaccard.jaccard_components(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert len(runs) == 1
    sets = {i: {tuple(w[k:k + 4]) for k in range(len(w) - 3)} for i, t in docs for w in [t.split()]}
    low = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                    low[a] = low[b] = min(low[a], low[b])
    assert got == low and len(set(got.values())) < len(sets)


# ---------------------------------------------------------------- 3 secrets

FIXED = [("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)),
         ("access", re.compile(r"AKIA[A-Z0-9]+")), ("hex", re.compile(r"[0-9a-f]+"))]


def base_of(text):
    out = []
    for order, (kind, pattern) in enumerate(FIXED):
        for m in pattern.finditer(text or ""):
            enough = {"assign": lambda: len(m[2]) >= 6, "access": lambda: len(m[0]) >= 20, "hex": lambda: len(m[0]) >= 24}[kind]()
            if enough:
                out.append((m.start(), order, m.end(), kind))
    return sorted(out)


def entropy_of(text, base):
    """The entropy spans window by window, without incremental counts, over
    what the base spans leave of each run."""
    out, allowed = [], "|".join(f"(?:{p})" for p in secret_scan.ALLOW)
    taken = {i for s, _, e, _ in base for i in range(s, e)}
    for m in re.finditer(r"[A-Za-z0-9+/_=-]{20,}", text or ""):
        if re.fullmatch(allowed, m[0]):
            continue
        free = "".join("x" if i not in taken else " " for i in range(m.start(), m.end()))
        for piece in re.finditer("x{20,}", free):
            start = m.start() + piece.start()
            run = text[start:m.start() + piece.end()]
            if re.fullmatch(allowed, run):
                continue
            limit = next(c[3] for c in secret_scan.CLASSES if re.fullmatch(c[1], run))
            spans = []
            for i in range(len(run) - 19):
                w = run[i:i + 20]
                h = -sum(w.count(c) / 20 * math.log2(w.count(c) / 20) for c in set(w))
                if h >= limit - 1e-9:
                    if spans and spans[-1][1] >= i:
                        spans[-1][1] = i + 20
                    else:
                        spans.append([i, i + 20])
            out += [(start + a, 3, start + b, "entropy") for a, b in spans]
    return out


BESIDE = ["0123456789abcdef" * 2 + "-Zk3vT9qLmX2rB7wYpN4cQ8s", "AKIA" + "Q7" * 8 + "/" + "Zk3vT9qLmX2rB7wYpN4cH6dJ8fK1gS5aE0uW3xRy",
          "Zk3vT9qLmX2rB7wYpN4cH6dJ8fK1gS5aE0uW3xRysecret=abc123"]      # random parts beside base spans


def secret_texts():
    rnd = random.Random(11)
    pick = lambda s, n: "".join(rnd.choice(s) for _ in range(n))
    mixed = "ABCDEFabcdefXYZxyz0123456789+/_=-"
    texts = [None, "", "no secrets here", "token: token: abcdefgh", "é" * 9 + " Token='abc.def' api_key=\"x1y2z3w4\"",
             "secret=password=abcdefgh1234", "AKIA" + "Z" * 15, "AKIA" + "Z" * 16 + "é", "a" * 23 + " " + "b" * 24,
             "AKIAAKIA" + pick("ABC123", 30) + " 😀 " + pick("0123456789abcdef", 40), "token" + " " * 3000 + "= abcdef",
             "aaaaaaaaaaaaaaaaaaaaaaaaa1", "path/to/some/very-long-file_name.html", "https://x.example/abcdefghijklmnopqrstuvwx",
             "550e8400-e29b-41d4-a716-446655440000", "x" * 50 + pick(mixed, 40) + "y" * 50, "0" * 40 + "f" * 30, *BESIDE]
    for _ in range(60):
        parts = [rnd.choice(["word", "token=", "secret : ", "AKIA", "é", "\n", pick(mixed, rnd.randint(15, 60)),
                             pick("0123456789abcdef", rnd.randint(10, 50)), pick("ABCDEFGH0123", rnd.randint(10, 30)), " "])
                 for _ in range(12)]
        texts.append("".join(parts))
    return texts


def test_secret_report_equals_brute_force(spark):
    texts = secret_texts()
    got = rows_by(secret_scan.secret_report(docs_of(spark, texts)))
    found = 0
    for i, t in enumerate(texts):
        base = base_of(t)
        join = lambda spans: ",".join(f"{k}:{s}:{e}" for s, _, e, k in spans)
        kinds = [k for *_, k in base]
        assert (got[i]["n_assign"], got[i]["n_access"], got[i]["n_hex"]) == tuple(kinds.count(k) for k in ("assign", "access", "hex")), t
        assert got[i]["base_sha256"] == hashlib.sha256(join(base).encode()).hexdigest(), t
        extra = entropy_of(t, base)
        found += len(extra)
        assert got[i]["spans"] == join(sorted(base + extra)), t
        assert t not in BESIDE or extra, t
    assert found >= 5


def test_redaction_masks_spans_and_keeps_the_rest(spark):
    texts = secret_texts()
    before = docs_of(spark, texts)
    after = rows_by(secret_scan.redact_secrets(before))
    assert len(after) == len(texts)
    for i, t in enumerate(texts):
        spans = sorted(base_of(t) + entropy_of(t, base_of(t)))
        out, at = "", 0
        for s, _, e, _ in spans:
            if s >= at:
                out += (t or "")[at:s] + secret_scan.MASK
            at = max(at, e)
        want = t if not spans else out + t[at:]
        assert after[i]["text"] == want
        assert after[i]["n_chars"] == (None if want is None else len(want))


def test_secret_scan_runs_no_python_and_keeps_clashing_columns(spark):
    df = docs_of(spark, ["token=abcdefgh", None]).withColumn("spans", F.lit(1)).withColumn("base_spans", F.lit("x"))
    out = secret_scan.redact_secrets(df)
    assert out.columns == df.columns and out.where("base_spans = 'x' and spans = 1").count() == 2
    plan = secret_scan.secret_report(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
    assert secret_scan.secret_report(docs_of(spark, [])).count() == 0


# ---------------------------------------------------------------- 4 n-gram Jaccard

def shingle_set(text, size):
    fold = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x20\x09-\x0D]+", fold)
    if not words:
        return set()
    return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)} if len(words) >= size else {tuple(words)}


def components_of(sets, percent):
    """sets: list of (doc_id, set) -> component of each position."""
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            a, b = sets[i][1], sets[j][1]
            both = len(a & b)
            if both and 100 * both >= percent * (len(a) + len(b) - both):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(sets):
        least[root(i)] = min(least.get(root(i), d), d)
    return [least[root(i)] for i in range(len(sets))]


def near_copies(seed=5):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    common = " ".join(rnd.choice(vocabulary) for _ in range(60))       # a passage many texts share
    texts = [None, "", "  \n", "one two", "one two", "One  TWO", "a b c d", "a b c d e"]
    for _ in range(14):
        base = [rnd.choice(vocabulary) for _ in range(rnd.randint(20, 160))]
        for _ in range(rnd.randint(1, 7)):
            copy = list(base)
            for _ in range(rnd.randint(0, 6)):
                copy[rnd.randrange(len(copy))] = rnd.choice(vocabulary)
            texts.append(" ".join(copy))
    texts += [common + " " + " ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(5, 120))) for _ in range(25)]
    texts += [texts[10]] * 6
    return texts


@pytest.mark.parametrize("size,percent", [(4, 85), (5, 80)])
def test_jaccard_components_equal_brute_force(spark, size, percent):
    texts = near_copies()
    sets = [(i, shingle_set(t, size)) for i, t in enumerate(texts)]
    want = components_of(sets, percent)
    got = rows_by(jaccard.jaccard_components(docs_of(spark, texts), size, percent))
    assert {i: (len(s), want[i]) for i, s in sets} == {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()}
    assert len(set(want)) < len(texts) - 10


def test_jaccard_links_through_texts_without_an_id(spark):
    rnd = random.Random(8)
    base = [f"v{i}" for i in range(140)]
    chain = [list(base)]
    for k in range(6):                                        # each a near copy of the last only
        step = list(chain[-1])
        step[10 + 20 * k:13 + 20 * k] = [f"x{k}", f"y{k}", f"z{k}"]
        chain.append(step)
    texts = [" ".join(c) for c in chain]
    ids = [1, None, 3, None, None, 6, 7]
    rows = [(i, t, "en", "s", len(t)) for i, t in zip(ids, texts)] + [(9, " ".join(rnd.sample(base, 60)), "en", "s", 9)]
    out = jaccard.jaccard_components(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"]) for r in out) == [(0, 1)] * 3 + [(1, 1), (3, 1), (6, 1), (7, 1), (9, 9)]


def test_jaccard_families_below_the_threshold_stay_apart(spark):
    """Texts that share most of one text, each pair just below the threshold."""
    rnd = random.Random(3)
    base = [f"b{i}" for i in range(200)]
    texts = []
    for i in range(120):
        own = list(base)
        for k in rnd.sample(range(200), 6):
            own[k] = f"own{i}x{k}"
        texts.append(" ".join(own))
    sets = [(i, shingle_set(t, 4)) for i, t in enumerate(texts)]
    got = rows_by(jaccard.jaccard_components(docs_of(spark, texts)))
    want = components_of(sets, 85)
    assert {i: want[i] for i, _ in sets} == {i: r["component_id"] for i, r in got.items()}


def test_jaccard_frequent_order_never_changes_links(spark, monkeypatch):
    texts = near_copies(6)
    plain = rows_by(jaccard.jaccard_components(docs_of(spark, texts)))
    monkeypatch.setattr(jaccard, "FREQUENT", 1)
    assert rows_by(jaccard.jaccard_components(docs_of(spark, texts))) == plain


def test_near_duplicates_keep_one_of_each_group(spark):
    texts = near_copies()
    before = docs_of(spark, texts).withColumn("node", F.lit("own"))
    twice = before.unionAll(before.where("doc_id % 7 = 0")).unionAll(before.limit(1).withColumn("doc_id", F.lit(None).cast("long")))
    out = jaccard.drop_near_duplicates(twice, 5, 80)
    assert out.columns == before.columns
    kept = [r["doc_id"] for r in out.collect()]
    want = components_of([(i, shingle_set(t, 5)) for i, t in enumerate(texts)], 80)
    assert sorted(k for k in kept if k is not None) == sorted(set(want)) and kept.count(None) == 1
    assert jaccard.drop_near_duplicates(docs_of(spark, [])).count() == 0


# ---------------------------------------------------------------- 6 byte-level BPE

@pytest.fixture(scope="module")
def vocabulary():
    public = pytest.importorskip("public_tokenizers")
    return public.path("byte_bpe_50k.tiktoken"), public.PATTERN


def test_bpe_equals_the_public_library(spark, vocabulary):
    tiktoken = pytest.importorskip("tiktoken")
    path, pattern = vocabulary
    tok = bpe.Tokenizer(path, pattern)
    public = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=tok.vocab.ranks, special_tokens={})
    rnd = random.Random(2)
    texts = [None, "", " ", "\n\n  x", "<|endoftext|>", "don't  stop", "a" * 3000, "é" * 40, "😀漢字" * 30, "x" * 33, "y" * 32]
    texts += ["".join(rnd.choice("etaoin shrdlu'\n\t.,;:!?éñ0123456789ABC😀") for _ in range(rnd.randint(1, 400))) for _ in range(120)]
    texts += ["".join(rnd.choice("etaoinshrdlu") for _ in range(rnd.randint(30, 90))) for _ in range(60)]
    texts += [r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(60).collect()]
    got = rows_by(bpe.token_digests(docs_of(spark, texts), path, pattern))
    for i, t in enumerate(texts):
        ids = np.array(public.encode_ordinary(t or ""), "<u4").tobytes()
        assert got[i]["n_tokens"] == len(ids) // 4
        assert got[i]["ids_sha256"] == hashlib.sha256(ids).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()
    encoded = bpe.encode_documents(docs_of(spark, texts), path, pattern)
    back = rows_by(bpe.decode_documents(encoded, path, pattern))
    assert all(back[i]["text"] == (t or "") for i, t in enumerate(texts))


def test_segment_trees_agree(vocabulary):
    """Batched lanes, the single tree and repeated scanning merge alike."""
    vocab = bpe.Vocabulary.read(vocabulary[0])
    rnd = random.Random(8)
    pieces = [bytes(rnd.choice(b"etaoinshr dlu\xc3\xa9") for _ in range(rnd.randint(1, bpe.LANE))) for _ in range(300)]

    def scan(piece):
        parts = [bytes([b]) for b in piece]
        while True:
            ranks = [(vocab.ranks.get(a + b, math.inf), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
            if not ranks or min(ranks)[0] == math.inf:
                return [vocab.ranks[p] for p in parts]
            i = min(ranks)[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]

    ids, counts = bpe.encode_lanes(pieces, vocab)
    flat, at = np.frombuffer(ids, "<u4"), 0
    for piece, n in zip(pieces, counts):
        want = scan(piece)
        assert flat[at:at + n].tolist() == want == bpe.encode_long(piece, vocab).tolist()
        at += n


def test_piece_map_stays_bounded(vocabulary, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_PIECES", 50)
    tok = bpe.Tokenizer(*vocabulary)
    texts = [f"alpha{i} beta{i * 7} gamma" for i in range(200)]
    want = [bpe.Tokenizer(*vocabulary).encode_batch([t])[0] for t in texts[:20]]
    got = [tok.encode_batch([t])[0] for t in texts]
    assert got[:20] == want and len(tok.known) <= 60


# ---------------------------------------------------------------- 7 passages

def test_compact_windows_equal_brute_force():
    rnd = random.Random(3)
    lengths = [70, 5, 46, 47, 0, 130]
    flat = np.array([rnd.randrange(1 << 60) for _ in range(sum(lengths))], np.uint64)
    flat[100:110] = flat[90:100]                       # repeated shingles
    text = np.repeat(np.arange(len(lengths)), lengths)
    least = 10
    c, l, r = passages.compact_windows(flat, text, 2, least)
    h = (passages.mix64(flat ^ passages.mix64(np.array([3], np.uint64))) >> np.uint64(28)).tolist()
    want, start = {}, 0
    for n in lengths:
        for i in range(start, start + n - least + 1):
            best = min(range(i, i + least), key=lambda p: (h[p], p))
            lo, hi = want.get(best, (i, i + least - 1))
            want[best] = (min(lo, i), max(hi, i + least - 1))
        start += n
    assert {int(a): (int(b), int(d)) for a, b, d in zip(c, l, r)} == want


def test_passages_find_exact_and_near_repeats_and_leave_clean_texts(spark):
    rnd = random.Random(9)
    words = lambda n: [f"v{rnd.randrange(100_000)}" for _ in range(n)]
    shared, near = words(51), words(80)
    changed = list(near)
    changed[40] = "other"
    texts = {i: words(300) for i in range(30)}
    for i in range(6):
        texts[i][100:100] = shared
    texts[10][20:20] = near
    texts[11][200:200] = changed
    texts[12] = list(texts[13])
    line = "the same line again and again "
    texts[14] = texts[15] = (line * 30).split()
    texts[16][5:5] = words(49)
    texts[17][9:9] = texts[16][5:45]                   # too short a passage
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in texts.items()] + [(90, None), (91, ""), (None, " ".join(shared))],
                               "doc_id long, text string")
    got = passages.near_duplicate_passages(df).collect()
    pairs = {frozenset((r["doc_id"], r["partner_id"])) for r in got}
    seen = {d for p in pairs for d in p}
    assert seen == {0, 1, 2, 3, 4, 5, 10, 11, 12, 13, 14, 15}
    assert {frozenset((10, 11)), frozenset((12, 13)), frozenset((14, 15))} <= pairs
    assert len(got) < 40                               # not all pairs of the shared passage
    for r in got:
        assert r["similarity"] >= 0.8 and r["stop"] - r["start"] >= 50
        if r["similarity"] == 1.0 and r["doc_id"] < 10:
            a, b = texts[r["doc_id"]][r["start"]:r["stop"]], texts[r["partner_id"]][r["partner_start"]:r["partner_stop"]]
            assert a == b
    assert passages.near_duplicate_passages(df.where("doc_id is null")).count() == 0


@pytest.mark.parametrize("quotes", [5, 20])
def test_short_quotes_before_full_copies_hide_no_passage(spark, quotes):
    rnd, count = random.Random(quotes), iter(range(10 ** 6))
    words = lambda n: [f"q{next(count)}" for _ in range(n)]
    texts, want = {}, set()
    for case in range(40):
        passage, first = words(60), 100 * case
        for i in range(quotes):
            n = rnd.randint(30, 49)
            a = rnd.randint(0, 60 - n)
            texts[first + i] = words(30) + passage[a:a + n] + words(30)
        for i in (50, 51):
            texts[first + i] = words(40) + passage + words(40)
        want.add((first + 51, first + 50))
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in texts.items()], "doc_id long, text string")
    got = passages.near_duplicate_passages(df).collect()
    pairs = {(max(r["doc_id"], r["partner_id"]), min(r["doc_id"], r["partner_id"])) for r in got}
    assert pairs == want
    assert all(r["similarity"] == 1.0 and r["stop"] - r["start"] == 60 for r in got)


def test_passages_keep_no_dead_tables_and_verify_in_runs(spark, monkeypatch, tmp_path):
    rnd, count = random.Random(4), iter(range(10 ** 6))
    words = lambda n: [f"r{next(count)}" for _ in range(n)]
    passage, texts = words(60), {}
    for i in range(8):
        a = rnd.randint(0, 20)
        texts[i] = words(30) + passage[a:a + 40] + words(30)
    for i in range(50, 53):
        texts[i] = words(40) + passage + words(40)
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in texts.items()], "doc_id long, text string")
    written = []
    monkeypatch.setattr(session, "scratch_dir", lambda s, name=None: written.append(f"{tmp_path}/{len(written)}-{name}") or written[-1])
    want = {tuple(r) for r in passages.near_duplicate_passages(df).collect()}
    assert {(r[0], r[3]) for r in want} >= {(51, 50), (52, 50)}
    # the tables of windows, pairs, shingles and open windows are gone, and so are the shuffles' files
    assert {"passage-windows", "passage-parts", "passage-open", "passage-cross"} <= {w.rsplit("/", 1)[1].split("-", 1)[1] for w in written}
    assert {p.name.split("-", 1)[1] for p in tmp_path.iterdir()} <= {"passage-found", "wanted"}
    runs = sum(w.endswith("passage-found") for w in written)
    monkeypatch.setattr(passages, "MOVED", 1)
    assert {tuple(r) for r in passages.near_duplicate_passages(df).collect()} == want
    assert sum(w.endswith("passage-found") for w in written) > 2 * runs


def test_materialize_leaves_no_shuffle_files(spark):
    blocks = lambda: {str(b) for b in spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllBlocks().mkString(" ").split()
                      if str(b).startswith("shuffle_")}
    before = blocks()
    got = session.materialize(spark.range(1000).selectExpr("id % 7 as k").groupBy("k").count())
    assert got.count() == 7
    stay = blocks() - before
    session.materialize(spark.range(1000).selectExpr("id % 5 as k").groupBy("k").count(), "again")
    assert blocks() - before <= stay                   # only got.count() left any, the written plans did not


def test_cross_pairs_equal_those_of_all_windows(spark):
    rnd = random.Random(21)
    rows = []
    for _ in range(900):
        signature, f = rnd.randrange(12), rnd.randrange(4)
        place = rnd.randrange(400)
        rows.append((signature * 4 + f, rnd.randrange(2), rnd.randrange(2), rnd.randrange(40),
                     (place + 45 << 20) | (rnd.randrange(46) << 12) | (rnd.randrange(46) << 4) | f, rnd.random() < 0.2))
    keys = ["signature", "which", "side"]
    df = spark.createDataFrame(rows, "signature long, which int, side long, doc_id long, window long, open boolean")
    got = passages._cross(df.where("open").drop("open"), df.drop("open"), keys, 4, 2).collect()
    met = {}
    for a in rows:
        for b in rows:
            if a[5] and a[:3] == b[:3] and a[3] != b[3]:
                x, y = (a, b) if a[3] > b[3] else (b, a)
                ends = lambda w: (((w >> 20) - (w >> 12 & 255)), (w >> 20) + (w >> 4 & 255))
                met.setdefault((x[3], y[3]), []).append((*ends(x[4]), *ends(y[4]), x[4] & 15))
    want = set()
    for (x, y), m in met.items():
        if len({r[4] for r in m}) >= 2:
            first, last = min(r[0] for r in m), max(r[1] for r in m)
            want.add((x, y, first, last, max(min(r[2] - r[0] for r in m) + first, 0), max(r[3] - r[1] for r in m) + last))
    assert len(want) > 50 and {tuple(r) for r in got} == want and len(got) == len(want)


def test_pairs_searched_together_equal_those_searched_alone():
    rnd, rows, plain = random.Random(14), [], 0
    for n in range(400):
        x = [rnd.randrange(10 ** 6) for _ in range(rnd.randint(60, 300))]
        y, rate = list(x), rnd.choice([0.0, 0.02, 0.05, 0.1, 0.3])
        for i in range(len(y)):
            if rnd.random() < rate:
                y[i] = rnd.randrange(10 ** 6)
        a, b = sorted(rnd.sample(range(len(y)), 2))
        kind = n % 5
        if kind == 1:
            y = y[:a] + [rnd.randrange(10 ** 6) for _ in range(rnd.randint(1, 40))] + y[b:]
        elif kind == 2:
            y = y[b:] + y[a:b] + y[:a]                 # another order
        elif kind == 3:
            x[a:b] = [x[a]] * (b - a)                  # a line that repeats itself
            y[a:b] = [x[a]] * (b - a)
        rows.append((n, np.array(x, np.uint64), np.array(y, np.uint64)))
        plain += len(set(x)) == len(x) and len(set(y)) == len(y)
    for least, similarity in ((46, 0.8), (20, 0.7), (30, 0.9), (25, 0.83)):
        want = sorted((n, *r) for n, x, y in rows for r in passages.shared_passages(x, y, least, similarity))
        got = sorted(passages._searched(iter(rows), least, similarity))
        assert got == want and len(want) > 100 and plain > 150


def test_hopeless_texts_equal_brute_force():
    rnd = np.random.default_rng(5)
    seen = set()
    for _ in range(300):
        length = rnd.integers(1, 40, rnd.integers(1, 5))
        marked, twice = rnd.random(length.sum()) < rnd.choice([0.3, 0.7, 0.8, 0.9]), rnd.random(length.sum()) < 0.2
        want, start = [], 0
        for n in length:
            m, t = marked[start:start + n], twice[start:start + n]
            start += n
            want.append(not any(m[i] and m[j] and 0.2 * m[i:j + 1].sum() - 0.8 * (~m[i:j + 1] & ~t[i:j + 1]).sum() >= -1e-6
                                for i in range(n) for j in range(i + 7, n)))
        assert passages._hopeless(marked, twice, length, 8, 0.8).tolist() == want
        seen |= set(want)
    assert seen == {True, False}


def _family(n):
    """Near copies of a text behind a common line, each with changes of its own, and texts that share the line only."""
    rnd = random.Random(31)
    words = lambda n: [f"w{rnd.randrange(10 ** 7)}" for _ in range(n)]
    line, base, own, texts = words(12), words(260), "again and ".split(), {}
    for i in range(n):
        text = [w if rnd.random() > 0.025 else words(1)[0] for w in base]
        texts[i] = line + (text if i % 3 else own * 60 + text[:100]) if i % 4 else line + words(100)
    return texts


def test_passages_of_tiles_equal_those_of_pairs(spark, monkeypatch):
    texts = _family(40)
    rnd, rows, keys = random.Random(2), [], ["signature", "which", "side"]
    for i, t in texts.items():
        for g in range(24):                            # windows everywhere, some open
            place = rnd.randrange(45, max(46, len(t) - 5))
            rows.append((4 * (g // 4 + 6 * rnd.randrange(2)) + g % 4, 0, 0, i, (place << 20) | (45 << 12) | (rnd.randrange(46) << 4) | g % 4, rnd.random() < 0.3))
    df = spark.createDataFrame(rows, "signature long, which int, side long, doc_id long, window long, open boolean")
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string")
    open_, crowd = df.where("open").drop("open"), df.drop("open")
    hashes = dict(zip(texts, (s for _, some in passages._sequences(*passages.utf8_parts(pa.array([" ".join(t) for t in texts.values()])), 5) for s in some)))
    pairs, want = passages._cross(open_, crowd, keys, 4, 2).collect(), []
    for d, p, first, last, p_first, p_last in pairs:
        want += [(d, first + i, first + j + 5, p, p_first + k, p_first + m + 5, v) for i, j, k, m, v in passages.shared_passages(
            hashes[d][first:last + 1], hashes[p][p_first:p_last + 1], 46, 0.8)]
    assert len(want) > 100 and len({(w[0], w[3]) for w in want}) < len(pairs)
    for block in (passages.BLOCK, 7):                  # one block, and tiles of two
        monkeypatch.setattr(passages, "BLOCK", block)
        got = passages._crossed(docs, session.materialize(passages._cells(open_, crowd, keys, 2)), 5, 46, 2, 0.8).collect()
        assert sorted(tuple(r) for r in got) == sorted(want)


def test_pairs_of_the_cross_round_are_no_rows(spark, monkeypatch):
    texts, made = _family(60), []
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string")
    inner = session.materialize
    monkeypatch.setattr(passages, "materialize", lambda table, name="table": made.append((name, inner(table, name))) or made[-1][1])
    monkeypatch.setattr(passages, "discard", lambda *tables: None)
    got = passages.near_duplicate_passages(df).collect()
    names = [name for name, _ in made]
    assert "passage-cross" in names
    # a row a document, not a row a pair
    assert dict(made)["passage-cross"].count() <= len(texts)
    assert len({(r["doc_id"], r["partner_id"]) for r in got}) > len(texts)


def word_shingles(words):
    return np.array([int.from_bytes(hashlib.sha1(" ".join(map(str, words[i:i + 5])).encode()).digest()[:7]) for i in range(len(words) - 4)], np.uint64)


def passage_places(x, y, least=46, similarity=0.8):
    """Common shingles of x inside any stretch, from one common shingle to
    another, that reaches the threshold (texts that do not repeat themselves)."""
    spot = {v: i for i, v in enumerate(y.tolist())}
    at = [i for i, v in enumerate(x.tolist()) if v in spot]
    to = [spot[v] for v in x[at].tolist()]
    out = set()
    for a in range(len(at)):
        for b in range(a, len(at)):
            n, both = at[b] - at[a] + 1, b - a + 1
            other = max(to[a:b + 1]) - min(to[a:b + 1]) + 1
            if n >= least and both >= similarity * (n + other - both):
                out.update(at[a:b + 1])
    return out


def found_places(x, y):
    got = passages.shared_passages(x, y, 46, 0.8)
    assert all(f[1] - f[0] >= 45 and f[4] >= 0.8 for f in got)
    common = np.flatnonzero(np.isin(x, y)).tolist()
    return {i for f in got for i in common if f[0] <= i <= f[1]}


def test_passages_inside_weaker_chains_are_found():
    rnd, count = random.Random(12), iter(range(10 ** 6))
    words = lambda n: [next(count) for _ in range(n)]
    for _ in range(25):
        near, weak = words(60), words(rnd.randint(30, 90))
        changed, weaker = list(near), list(weak)
        changed[30] = next(count)                      # Jaccard 0.84, no exact run of 46
        weaker[7::8] = words(len(weaker[7::8]))        # three common shingles in eight: the chain goes on
        x, y = word_shingles(words(9) + near + weak), word_shingles(changed + weaker + words(20))
        want = passage_places(x, y)
        assert want and found_places(x, y) == want
    runs, between = words(98), words(7)                # two runs of 45 shingles, 11 changed between: 0.80 as a whole
    x, y = word_shingles(runs[:49] + between + runs[49:]), word_shingles(runs[:49] + words(7) + runs[49:])
    assert len(passages.shared_passages(x, y, 46, 0.8)) == 1


def test_passages_cover_all_stretches_of_edited_texts():
    rnd, count = random.Random(13), iter(range(10 ** 6))
    words = lambda n: [next(count) for _ in range(n)]
    some = 0
    for _ in range(60):
        text = words(rnd.randint(60, 160))
        other = list(text)
        for _ in range(rnd.randint(1, 16)):
            i, n = rnd.randrange(len(other)), rnd.choice([0, 1, 1, 9])
            other[i:i + n] = words(rnd.choice([0, 1, 1, 12]))
        x, y = word_shingles(text), word_shingles(other)
        want = passage_places(x, y)
        some += bool(want) and len(want) < len(x) // 2
        assert found_places(x, y) == want
    assert some >= 3
    phrase = words(3)
    line = [w for _ in range(40) for w in phrase]      # texts that repeat themselves, among other words
    assert [f[:2] for f in passages.shared_passages(word_shingles(words(30) + line), word_shingles(line + words(50)), 46, 0.8)] == [(30, 145)]
    block = words(20) * 4
    assert found_places(word_shingles(words(40) + block), word_shingles(words(5) + block))


# ---------------------------------------------------------------- 9 language, 10 toxicity

def test_language_id_holds_out_accuracy_and_defined_cases(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    odd = spark.createDataFrame([(100001, None, "en", "s", 0), (100002, "123 !?", "en", "s", 6), (100003, "", None, "s", 0),
                                 (None, "the and of", "en", "s", 9), (100004, "the and " * 20000, None, "s", 0)], DOCS)
    got = langid.predict_language(docs.unionAll(odd))
    assert got.count() == docs.count() + 5
    by = rows_by(got)
    assert all(by[i]["lang_pred"] == "und" and by[i]["score"] == 0 for i in (100001, 100002, 100003))
    assert by[100004]["lang_pred"] == "en" and not by[None]["held_out"]
    j = got.join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    assert j.where("lang = lang_pred").count() >= 0.95 * j.count() > 0
    assert got.where("score < 0 or score > 1").count() == 0
    blank = langid.predict_language(docs_of(spark, ["a b", None]).withColumn("lang", F.lit(None).cast("string"))).collect()
    assert [r["lang_pred"] for r in blank] == ["und", "und"]


def test_trigram_counts_equal_brute_force():
    texts = ["Ab, c!", "", "ab", "xyzé " * 3]
    got = langid.counts_of(*utf8_parts(pa.array(texts)))
    for i, t in enumerate(texts):
        folded = re.sub(rb"[^a-z\x80-\xff]+", b"\0", bytes(b + 32 if 65 <= b <= 90 else b for b in t.encode()))
        want = np.zeros(langid.DIMENSIONS)
        for k in range(len(folded) - 2):
            g = np.uint64(folded[k] << 16 | folded[k + 1] << 8 | folded[k + 2])
            want[int(langid.mix64(np.array([g]))[0] % np.uint64(langid.DIMENSIONS))] += 1
        assert (got[i] == want).all()


def toxic_corpus(spark, n=400, seed=1):
    rnd = random.Random(seed)
    syllables = ["an", "the", "or", "ing", "st", "er", "on", "ha", "wh", "ti"]
    word = lambda: "".join(rnd.choice(syllables) for _ in range(rnd.randint(1, 4)))
    docs, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rnd.randint(20, 80))]
        toxic = int(i % 4 == 0)
        if toxic:
            for bad in rnd.sample(["idiot", "moron", "scumbag", "pathetic"], 2):
                words.insert(rnd.randrange(len(words)), bad)
        docs.append((i, " ".join(words), "en", "s", 0))
        if i % 3:
            labels.append((i, 1, toxic))
    return spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_learns_and_tolerates_gaps(spark):
    docs, labels = toxic_corpus(spark)
    tricks = ["you i d i o t and mo.ron here", "what an id-iot, so path3tic", "an idxiot of a M O R O N", "PATHETIC scum-bag"]
    clean = [None, "", "the string is here on the hat", "12345 67890", "ing " * 30000]
    extra = spark.createDataFrame([(1000 + i, t, "en", "s", 0) for i, t in enumerate(tricks + clean)] + [(None, "hat", "en", "s", 0)], DOCS)
    got = toxicity.score_toxicity(docs.unionAll(extra), labels)
    by = rows_by(got)
    truth = {i: int(i % 4 == 0) for i in range(400)}
    held = [i for i in truth if by[i]["held_out"]]
    assert len(held) > 40 and sum(by[i]["predicted"] == truth[i] for i in held) >= 0.97 * len(held)
    assert [by[1000 + i]["predicted"] for i in range(len(tricks))] == [1] * len(tricks)
    assert [by[1000 + len(tricks) + i]["predicted"] for i in range(len(clean))] == [0] * len(clean)
    assert got.where("score is null or score < 0 or score > 1").count() == 0 and by[None]["held_out"] is False


def test_toxicity_without_labels_or_one_class(spark):
    docs, labels = toxic_corpus(spark, 40)
    assert {r["score"] for r in toxicity.score_toxicity(docs, labels.limit(0)).collect()} == {0.0}
    assert {r["predicted"] for r in toxicity.score_toxicity(docs, labels.where("toxic = 0")).collect()} == {0}
    out = toxicity.drop_toxic(docs.withColumn("score", F.lit("own")), labels.limit(0))
    assert out.columns == docs.columns + ["score"] and out.count() == 40


def test_window_scores_equal_the_explicit_kernel():
    """The folded table scores a word as the kernel sum over landmarks does."""
    rnd = random.Random(0)
    words = [bytes(rnd.randint(1, 26) for _ in range(rnd.randint(2, 8))) for _ in range(40)]

    def phi(word):
        s, out = b"\0" + word, {}
        for i in range(len(s)):
            for b in range(2, toxicity.SPAN):
                for a in range(1, b):
                    if i + b < len(s):
                        key = (s[i], s[i + a], s[i + b])
                        out[key] = out.get(key, 0) + toxicity.DECAY ** (b - 2)
        norm = math.sqrt(sum(toxicity.DECAY ** (2 * (b - 2)) for i in range(len(s)) for b in range(2, toxicity.SPAN)
                             for a in range(1, b) if i + b < len(s)))
        return {k: v / norm for k, v in out.items()}

    weights = np.zeros(64 ** 3)
    for j, word in enumerate(words[:10]):
        for (x, y, z), v in phi(word).items():
            weights[x << 12 | y << 6 | z] += (j - 4) * v
    text = " ".join("".join(chr(96 + c) for c in w) for w in words)
    w = toxicity.read_words(*utf8_parts(pa.array([text])))
    got = toxicity.window_scores(w, weights, 0.0)
    want = [sum(v * weights[x << 12 | y << 6 | z] for (x, y, z), v in phi(word).items()) for word in words]
    assert np.allclose(got, want, atol=1e-5)
