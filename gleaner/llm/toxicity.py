"""Toxicity: a string-kernel SVM with Nystroem landmarks.

Kernel.  A text is read as words over a 64-symbol alphabet (letters folded,
common digit look-alikes folded, other signs dropped, runs of single letters
joined, a word-start mark in front).  Two strings are compared by the
gap-weighted subsequence kernel of length three: every subsequence of three
symbols that spans at most ``SPAN`` symbols counts with ``DECAY ** gaps``, so
gapped insults and inserted characters still match.  Vectors are normalised
by the norm a string of that length has without repeats.

Training.  On a bounded sample of labelled rows (``SAMPLE_PER_CLASS`` of each
class, chosen by hash).  Sentences of rejected documents are weak positives:
words and word beginnings that occur there far more than chance allows are
candidates, and the fewest that cover every such document twice seed
the positive class (chance words add no cover), with the words they begin;
words of clean sentences are the negatives, and the highest scoring clean
words are mined as hard negatives for refits.  Landmark
strings of both classes give the Nystroem map; a squared-hinge linear SVM is
fitted on it by Newton steps, and a logistic layer over a document's two highest
words and its length gives the score.

Scoring.  The SVM's value is linear in the subsequence counts, so the
landmark sum folds into one 64**3 table and every text is scored whole by
array look-ups in an Arrow UDF: narrow, no shuffle.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm.common import row_chunks, utf8_parts
from gleaner.session import materialize

SPAN = 5                  # a subsequence spans at most this many symbols
DECAY = 0.6               # weight of each skipped symbol
WINDOW = 10               # longest string compared at once (word mark included)
SAMPLE_PER_CLASS = 2000   # labelled rows of a class used for the fit
LANDMARKS = 400
POSITIVE_WORDS, NEGATIVE_WORDS, MINED_WORDS = 300, 6000, 3000
CANDIDATE_WORDS = 5000    # candidates the cover chooses from
STEMS = (4, 5, 6)         # letters of the word beginnings among them
COVER = 2                 # seeds wanted in each rejected document
_SKIP = 255
FLOOR = -1e9               # score of a window that does not count
LOWEST = -3.0              # highest word of a text without words
_LOOKALIKE = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}


def _alphabet() -> np.ndarray:
    table = np.full(256, _SKIP, np.uint8)
    for c in b" \t\n\r\x0b\x0c":
        table[c] = 0
    for i in range(26):
        table[ord("a") + i] = table[ord("A") + i] = i + 1
    for sign, letter in _LOOKALIKE.items():
        table[ord(sign)] = ord(letter) - 96
    for b in range(128, 256):
        table[b] = 27 + (b - 128) % 37
    return table


_TABLE = _alphabet()


@dataclass
class Words:
    """Symbols of many texts: each word is a 0 mark and its letters."""
    symbols: np.ndarray    # uint8
    word: np.ndarray       # int32, word of each symbol
    starts: np.ndarray     # int64, first symbol of each word
    doc: np.ndarray        # int32, text of each word


def read_words(raw: np.ndarray, offsets: np.ndarray) -> Words:
    codes = _TABLE[raw]
    doc = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
    keep = codes != _SKIP
    codes, doc = codes[keep], doc[keep]
    letter = codes != 0
    prev_letter = np.zeros(len(codes), bool)
    prev_letter[1:] = letter[:-1] & (doc[1:] == doc[:-1])
    start = letter & ~prev_letter
    letters, ldoc = codes[letter], doc[letter]
    word = np.cumsum(start[letter], dtype=np.int32) - 1
    if not len(letters):
        return Words(np.zeros(0, np.uint8), np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int32))
    # runs of single letters ("i d i o t") are one word
    size = np.bincount(word)
    first = np.flatnonzero(start[letter])
    wdoc = ldoc[first]
    glue = np.zeros(len(size), bool)
    glue[1:] = (size[1:] == 1) & (size[:-1] == 1) & (wdoc[1:] == wdoc[:-1])
    new = np.cumsum(~glue, dtype=np.int32) - 1
    word, wdoc = new[word], wdoc[~glue]
    n_words = len(wdoc)
    symbols = np.zeros(len(letters) + n_words, np.uint8)
    symbols[np.arange(len(letters)) + word + 1] = letters
    starts = np.flatnonzero(symbols == 0)
    lengths = np.diff(np.append(starts, len(symbols)))
    return Words(symbols, np.repeat(np.arange(n_words, dtype=np.int32), lengths), starts, wdoc)


def subsequences(w: Words) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """(first symbol's position, triple key, weight) for each gap pattern."""
    s = w.symbols.astype(np.int32)
    n = len(s)
    for b in range(2, SPAN):
        if n <= b:
            return
        at = np.flatnonzero(w.word[:-b] == w.word[b:])
        head, tail = s[at] << 12, s[at + b]
        for a in range(1, b):
            yield at, head | (s[at + a] << 6) | tail, DECAY ** (b - 2)


def window_scores(w: Words, weights: np.ndarray, bias: float) -> np.ndarray:
    """Highest window score of each word: windows of up to WINDOW symbols
    at the word start, and every full window inside longer words."""
    n = len(w.symbols)
    value = np.zeros(n, np.float64)
    norm = np.zeros(n, np.float64)
    for at, key, weight in subsequences(w):
        value[at] += weights[key] * weight
        norm[at] += weight * weight
    total = np.concatenate(([0.0], np.cumsum(value)))
    squares = np.concatenate(([0.0], np.cumsum(norm)))
    ends = np.append(w.starts[1:], n)
    if len(w.starts) == 0:
        return np.zeros(0)
    pos = np.arange(n)
    end = ends[w.word]
    stop = np.minimum(pos + WINDOW, end)
    whole = (pos == w.starts[w.word]) | (stop - pos == WINDOW)
    sq = squares[stop] - squares[pos]
    score = np.where(whole & (sq > 0), (total[stop] - total[pos]) / np.sqrt(np.maximum(sq, 1e-9)) + bias, FLOOR)
    return np.maximum.reduceat(score, w.starts)


def document_features(w: Words, scores: np.ndarray, n_docs: int) -> np.ndarray:
    """(highest word, second highest word, log of words) of each text: a
    clean text may hold one chance word, and a long one a higher one."""
    out = np.full((n_docs, 3), LOWEST)
    out[:, 2] = 0.0
    if len(scores):
        scores = np.maximum(scores, LOWEST)
        docs, first, counts = np.unique(w.doc, return_index=True, return_counts=True)
        top = np.maximum.reduceat(scores, first)
        at_top = np.flatnonzero(scores == np.repeat(top, counts))
        once = at_top[np.unique(w.doc[at_top], return_index=True)[1]]
        rest = scores.copy()
        rest[once] = LOWEST
        out[docs, 0] = top
        out[docs, 1] = np.maximum.reduceat(rest, first)
        out[docs, 2] = np.log1p(counts)
    return out


def _word_vectors(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse normalised kernel vectors of symbol strings (row, key, value)."""
    cut = [x[:WINDOW - 1] for x in words]
    lengths = np.array([len(x) + 1 for x in cut])
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1])) if len(cut) else np.zeros(0, np.int64)
    symbols = np.frombuffer(b"".join(b"\0" + x for x in cut), np.uint8)
    word = np.repeat(np.arange(len(cut), dtype=np.int32), lengths)
    w = Words(symbols, word, starts, word[:0])
    rows, keys, vals = [], [], []
    for at, key, weight in subsequences(w):
        rows.append(word[at])
        keys.append(key)
        vals.append(np.full(len(at), weight))
    if not rows:
        return np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0)
    row, key, val = np.concatenate(rows), np.concatenate(keys), np.concatenate(vals)
    norm = np.sqrt(np.maximum(np.bincount(row, val * val, minlength=len(cut)), 1e-9))
    return row, key, val / norm[row]


def _newton_svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray, ridge: float = 0.1, steps: int = 25):
    """Squared-hinge SVM in the primal; ``y`` in {-1, 1}; bias is last."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    reg = np.full(x.shape[1], ridge)
    reg[-1] = 1e-3
    for _ in range(steps):
        live = y * (x @ w) < 1
        xa = x[live]
        ca = cost[live][:, None]
        h = (xa * ca).T @ xa + np.diag(reg)
        new = np.linalg.solve(h, xa.T @ (cost[live] * y[live]))
        if np.allclose(new, w, atol=1e-7):
            break
        w = new
    return w[:-1], float(w[-1])


def _logistic(x: np.ndarray, y: np.ndarray, cost: np.ndarray, ridge: float = 0.05, steps: int = 40) -> np.ndarray:
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    reg = np.diag([ridge] * (x.shape[1] - 1) + [1e-6])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (cost * (p - y)) + reg @ w
        h = (x * (cost * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + reg
        step = np.linalg.solve(h, g)
        w -= step * min(1.0, 4.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return w


@dataclass
class ToxicityModel:
    weights: np.ndarray | None    # 64**3 table; None: no fit was possible
    bias: float
    logit: np.ndarray             # over the document features
    prior: float                  # score of every text when nothing was fitted

    def features(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        out = []
        for a, b in row_chunks(offsets):
            w = read_words(raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
            out.append(document_features(w, window_scores(w, self.weights, self.bias), b - a))
        return np.vstack(out) if out else np.zeros((0, 3))

    def scores(self, texts: pa.Array) -> np.ndarray:
        if self.weights is None:
            return np.full(len(texts), self.prior)
        f = self.features(*utf8_parts(texts))
        z = np.hstack([f, np.ones((len(f), 1))]) @ self.logit
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _document_words(raw: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, set[bytes]]]:
    for a, b in row_chunks(offsets):
        w = read_words(raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
        if not len(w.starts):
            continue
        docs, first = np.unique(w.doc, return_index=True)
        cuts = np.append(w.starts[first], len(w.symbols))
        data = w.symbols.tobytes()
        for i, d in enumerate(docs):
            yield a + int(d), set(data[cuts[i]:cuts[i + 1]].split(b"\0")) - {b""}


def _with_stems(words: set[bytes]) -> set[bytes]:
    return words | {w[:n] for w in words for n in STEMS if len(w) > n}


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        labels = batch.column(1).to_numpy(zero_copy_only=False)
        counts: dict[bytes, list[int]] = {}
        for d, words in _document_words(*utf8_parts(batch.column(0))):
            for word in _with_stems(words):
                counts.setdefault(word, [0, 0])[labels[d]] += 1
        keys = list(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.binary()), pa.array([counts[k][1] for k in keys], pa.int64()),
             pa.array([counts[k][0] for k in keys], pa.int64())], ["word", "pos", "neg"])


def labelled_sample(docs: DataFrame, labels: DataFrame, train: Column, per_class: int) -> DataFrame:
    """(text, toxic) of at most ``per_class`` labelled rows of each class,
    by hash of the id; ids in conflict count as toxic."""
    picked = (labels.where("doc_id is not null and toxic in (0, 1)").where(train)
              .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")))
    classes = [picked.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for c in (0, 1)]
    chosen = materialize(classes[0].unionAll(classes[1]), "toxic-sample")   # 2 x per_class ids at most
    # one text per id, so a repeated id cannot grow the sample past its bound
    texts = (docs.select(F.col("doc_id").alias("doc_id"), F.col("text").alias("text")).where("text is not null")
             .join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text")))
    return materialize(texts.select(F.lower("text").alias("text"), "toxic"), "toxic-texts")


def fit_toxicity(docs: DataFrame, labels: DataFrame, train: Column | None = None,
                 per_class: int = SAMPLE_PER_CLASS) -> ToxicityModel:
    """Fit on labelled rows for which ``train`` (over labels.doc_id) holds.

    No row of one class in the sample: nothing can be told apart, and the
    model scores every text with the share of toxic rows (0 without rows)."""
    sample = labelled_sample(docs, labels, F.lit(True) if train is None else train, per_class)
    totals = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n_pos, n_neg = totals.get(1, 0), totals.get(0, 0)
    prior = n_pos / max(n_pos + n_neg, 1)
    if not n_pos or not n_neg:
        return ToxicityModel(None, 0.0, np.zeros(4), prior)
    counts = materialize(sample.mapInArrow(_count_words, "word binary, pos long, neg long")
                         .groupBy("word").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")), "toxic-words")
    long_enough = counts.where(F.length("word") >= 2)
    # log-likelihood gain over the sample's share of toxic rows; of all strings that occur three times or
    # more, fewer than one is expected to gain this much by chance
    tested = long_enough.where(F.col("pos") + F.col("neg") >= 3)
    bar = math.log(max(tested.count(), 2))
    share = F.col("pos") / (F.col("pos") + F.col("neg"))
    gain = F.col("pos") * F.log(share / prior) + F.when(F.col("neg") > 0, F.col("neg") * F.log((1 - share) / (1 - prior))).otherwise(0.0)
    candidates = (tested.where((F.col("pos") > 0) & (share > 0.5) & (share > prior)).withColumn("gain", gain).where(F.col("gain") >= bar)
                  .orderBy(F.desc("gain"), "word").limit(CANDIDATE_WORDS))
    chosen = _cover(sample, [bytes(r["word"]) for r in candidates.collect()])
    starts = F.lit(False)
    for n in STEMS:
        stems = [bytearray(w) for w in chosen if len(w) == n]
        starts = starts | (F.substring("word", 1, n).isin(stems) if stems else F.lit(False))
    begun = long_enough.where((F.col("neg") == 0) & starts).orderBy(F.desc("pos"), "word").limit(POSITIVE_WORDS)
    positive = sorted(set(chosen) | {bytes(r["word"]) for r in begun.collect()})
    clean = long_enough.where(F.col("neg") > 0)
    frequent = clean.orderBy(F.desc("neg"), "word").limit(NEGATIVE_WORDS // 2)
    spread = clean.orderBy(F.xxhash64("word"), "word").limit(NEGATIVE_WORDS // 2)
    known = set(positive)
    negative = sorted({bytes(r["word"]) for r in frequent.unionAll(spread).select("word").collect()} - known)
    if not positive or not negative:
        return ToxicityModel(None, 0.0, np.zeros(4), prior)

    model = _fit_words(positive, negative)
    for _ in range(2):
        mined = _mine(sample, model)
        negative = sorted((set(negative) | mined) - known)
        model = _fit_words(positive, negative)
    rows = [r for r in sample.mapInArrow(_Features(model), "f0 double, f1 double, f2 double, toxic int").collect()]
    x = np.array([[r["f0"], r["f1"], r["f2"]] for r in rows])
    y = np.array([r["toxic"] for r in rows], float)
    # clean documents weigh at least five times the toxic ones: a false rejection costs text
    cost = np.where(y == 1, 1.0, max(1.0, 5.0 * n_pos / n_neg))
    model.logit = _logistic(x, y, cost)
    model.prior = prior
    return model


class _Features:
    def __init__(self, model: ToxicityModel):
        self.model = model

    def __call__(self, batches):
        for batch in batches:
            f = self.model.features(*utf8_parts(batch.column(0)))
            yield pa.RecordBatch.from_arrays([pa.array(f[:, i]) for i in range(3)] + [batch.column(1).cast(pa.int32())],
                                             ["f0", "f1", "f2", "toxic"])


def _cover(sample: DataFrame, words: list[bytes]) -> list[bytes]:
    """The greedy choice of words until each rejected text holds COVER of
    them; a word must be new to two texts at least."""
    wanted = {w: i for i, w in enumerate(words)}

    def hits(batches):
        for batch in batches:
            found = [sorted(wanted[w] for w in _with_stems(ws) & wanted.keys())
                     for _, ws in _document_words(*utf8_parts(batch.column(0)))]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int32()))], ["hits"])

    rows = sample.where("toxic = 1").select("text").mapInArrow(hits, "hits array<int>").collect()  # SAMPLE_PER_CLASS rows at most
    texts: list[list[int]] = [[] for _ in words]
    for d, row in enumerate(rows):
        for i in row["hits"]:
            texts[i].append(d)
    need = np.full(len(rows), COVER)
    heap = [(-len(t), i) for i, t in enumerate(texts)]
    heapq.heapify(heap)
    chosen = []
    while heap and len(chosen) < POSITIVE_WORDS:
        _, i = heapq.heappop(heap)
        gain = int((need[texts[i]] > 0).sum())
        if gain < 2:
            continue
        if heap and gain < -heap[0][0]:
            heapq.heappush(heap, (-gain, i))
            continue
        chosen.append(words[i])
        need[texts[i]] -= 1
    return chosen


def _mine(sample: DataFrame, model: ToxicityModel) -> set[bytes]:
    """The clean words the model scores highest (at most MINED_WORDS)."""
    def top(batches):
        for batch in batches:
            words, scores = [], []
            raw, off = utf8_parts(batch.column(0))
            for a, b in row_chunks(off):
                w = read_words(raw[off[a]:off[b]], off[a:b + 1] - off[a])
                s = window_scores(w, model.weights, model.bias)
                ends = np.append(w.starts[1:], len(w.symbols))
                for i in np.argsort(-s)[:64]:
                    words.append(w.symbols[w.starts[i] + 1:ends[i]].tobytes())
                    scores.append(float(s[i]))
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(scores, pa.float64())], ["word", "score"])

    clean = sample.where("toxic = 0").select("text")
    best = (clean.mapInArrow(top, "word binary, score double").groupBy("word").agg(F.max("score").alias("score"))
            .orderBy(F.desc("score"), "word").limit(MINED_WORDS))
    return {bytes(r["word"]) for r in best.collect()}


def _fit_words(positive: list[bytes], negative: list[bytes]) -> ToxicityModel:
    half = LANDMARKS // 2
    marks = positive[::max(1, len(positive) // half)][:half] + negative[::max(1, len(negative) // half)][:half]
    words = positive + negative
    zr, zk, zv = _word_vectors(marks)
    keys = np.unique(zk)
    z = np.zeros((len(marks), len(keys)))
    np.add.at(z, (zr, np.searchsorted(keys, zk)), zv)
    r, k, v = _word_vectors(words)
    at = np.searchsorted(keys, k)
    hit = (at < len(keys)) & (keys[np.minimum(at, len(keys) - 1)] == k)
    x = np.zeros((len(words), len(keys)))
    np.add.at(x, (r[hit], at[hit]), v[hit])
    gram = x @ z.T                                   # kernel of words against landmarks
    values, vectors = np.linalg.eigh(z @ z.T)
    ok = values > 1e-6 * values.max()
    root = vectors[:, ok] / np.sqrt(values[ok])      # Nystroem map
    y = np.where(np.arange(len(words)) < len(positive), 1.0, -1.0)
    cost = np.where(y > 0, 0.5 / len(positive), 0.5 / len(negative)) * len(words)
    w, bias = _newton_svm(gram @ root, y, cost)
    weights = np.zeros(64 ** 3, np.float32)
    weights[keys] = (root @ w) @ z
    return ToxicityModel(weights, bias, np.zeros(4), 0.0)


def toxicity_score(spark: SparkSession, text: Column, model: ToxicityModel) -> Column:
    """Score column in [0, 1]; null text scores as the empty text."""
    shared = spark.sparkContext.broadcast(model)      # one 1 MB table

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array(shared.value.scores(texts), pa.float64())

    return score.asNondeterministic()(F.lower(F.coalesce(text, F.lit(""))))


def not_held_out(doc_id: Column | str = "doc_id", folds: int = 5) -> Column:
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(col.cast("string")) % folds != 0


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Null and empty texts score as a text without words; a null doc_id is
    never held out and never learnt from; repeated rows are scored each;
    other columns of either table are not read."""
    model = fit_toxicity(docs, labels, not_held_out())
    scored = docs.select(F.col("doc_id").alias("doc_id"),
                         toxicity_score(docs.sparkSession, docs["text"], model).alias("score"))
    return scored.select("doc_id", F.coalesce(~not_held_out(), F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents whose score is below 0.5, columns unchanged."""
    model = fit_toxicity(docs, labels, not_held_out())
    mark = "_toxicity"
    while mark in docs.columns:
        mark += "_"
    kept = docs.withColumn(mark, toxicity_score(docs.sparkSession, docs["text"], model))
    return kept.where(F.col(mark) < 0.5).select(*[kept[c] for c in docs.columns])
