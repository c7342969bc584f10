"""Language ID by nearest centroid over TF-IDF character n-grams.

A text's letters, runs of anything else folded to one space, are read as
byte trigrams hashed to ``DIMENSIONS`` columns; a vector holds
log(1 + count) * idf, normalised.  Document frequencies come from every
training document.  Each language is clustered by spherical k-means on a
bounded sample (``SAMPLE`` documents of it, chosen by hash), which gives
``CENTROIDS`` centroids; a text belongs to the language of the centroid with
the greatest cosine.  A text farther from it than ``TAIL`` of that centroid's
own documents is flagged as rejected.

Training counts are sums of fixed-size arrays; scoring is an Arrow UDF with
the centroids (languages x centroids x dimensions numbers) broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.llm.common import mix64, row_chunks, utf8_parts
from gleaner.session import materialize

DIMENSIONS = 4096
CENTROIDS = 3
SAMPLE = 800          # documents of a language used for its centroids
LANGUAGES = 1000      # most languages one model may hold
TAIL = 0.005
UNKNOWN = "und"

_FOLD = np.zeros(256, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def counts_of(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Trigram counts of each text (texts x DIMENSIONS)."""
    n = len(offsets) - 1
    codes = _FOLD[raw]
    doc = np.repeat(np.arange(n, dtype=np.int64), np.diff(offsets))
    gap = codes == 0
    drop = np.zeros(len(codes), bool)
    drop[1:] = gap[1:] & gap[:-1] & (doc[1:] == doc[:-1])
    codes, doc = codes[~drop].astype(np.int64), doc[~drop]
    if len(codes) < 3:
        return np.zeros((n, DIMENSIONS), np.float32)
    gram = (codes[:-2] << 16) | (codes[1:-1] << 8) | codes[2:]
    column = (mix64(gram.astype(np.uint64)) % np.uint64(DIMENSIONS)).astype(np.int64)
    inside = doc[:-2] == doc[2:]
    flat = np.bincount(doc[:-2][inside] * DIMENSIONS + column[inside], minlength=n * DIMENSIONS)
    return flat.reshape(n, DIMENSIONS).astype(np.float32)


def count_chunks(texts: pa.Array, rows: int = 256) -> Iterator[np.ndarray]:
    """Counts of a few texts at a time, in order."""
    raw, offsets = utf8_parts(texts)
    for a, b in row_chunks(offsets):
        for s in range(a, b, rows):
            e = min(s + rows, b)
            yield counts_of(raw[offsets[s]:offsets[e]], offsets[s:e + 1] - offsets[s])


def normalised(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(counts) * idf
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)


def spherical_kmeans(v: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Unit centroids: seeds by farthest point, then mean directions."""
    seeds = [int(np.argmax(v @ v.mean(axis=0)))]
    while len(seeds) < min(k, len(v)):
        seeds.append(int(np.argmin((v @ v[seeds].T).max(axis=1))))
    centres = v[seeds]
    for _ in range(rounds):
        own = np.argmax(v @ centres.T, axis=1)
        new = np.vstack([v[own == i].mean(axis=0) if (own == i).any() else centres[i] for i in range(len(centres))])
        new /= np.maximum(np.linalg.norm(new, axis=1, keepdims=True), 1e-12)
        if np.allclose(new, centres, atol=1e-6):
            break
        centres = new
    return centres


@dataclass
class LanguageModel:
    languages: list[str]       # of each centroid
    centres: np.ndarray        # centroids x DIMENSIONS
    floors: np.ndarray         # least cosine not rejected, of each centroid
    idf: np.ndarray

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        names, scores, rejected = [], [], []
        for counts in count_chunks(texts):
            cos = normalised(counts, self.idf) @ self.centres.T
            best = np.argmax(cos, axis=1)                  # ties: languages are in order
            top = cos[np.arange(len(cos)), best]
            names += [self.languages[i] for i in best]
            scores.append(np.clip(top, 0, 1))
            rejected.append(top < self.floors[best])
        return names, np.concatenate(scores), np.concatenate(rejected)


def fit_languages(docs: DataFrame, train: Column | None = None) -> LanguageModel | None:
    """Fit on rows with text and lang for which ``train`` holds; None when
    there are none."""
    rows = docs.where("text is not null and lang is not null").where(F.lit(True) if train is None else train)
    rows = rows.select(F.col("doc_id").alias("doc_id"), F.col("lang").alias("lang"), F.col("text").alias("text"))

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(DIMENSIONS, np.int64), 0
        for batch in batches:
            for counts in count_chunks(batch.column(0)):
                total += (counts > 0).sum(axis=0)
                n += len(counts)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(np.arange(DIMENSIONS), -1)), pa.array(np.append(total, n))],
                                         ["dim", "n"])

    found = {r["dim"]: r["n"] for r in rows.select("text").mapInArrow(frequencies, "dim long, n long")
             .groupBy("dim").agg(F.sum("n").alias("n")).collect()}           # DIMENSIONS + 1 rows
    n = found.pop(-1, 0)
    if not n:
        return None
    idf = np.array([np.log((1 + n) / (1 + found.get(d, 0))) + 1 for d in range(DIMENSIONS)], np.float32)

    sizes = rows.groupBy("lang").count().orderBy(F.desc("count")).limit(LANGUAGES + 1).collect()
    if len(sizes) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    # rows of each language by hash: all of a rare one, about SAMPLE of a common one, never above twice that
    share = F.element_at(F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], SAMPLE / r["count"])]), F.col("lang"))
    dealt = F.pmod(F.xxhash64("doc_id", F.lit("lang")), F.lit(1 << 30)).cast("double") / float(1 << 30)
    sample = rows.where(dealt < share)

    def cluster(pdf: pd.DataFrame) -> pd.DataFrame:
        texts = pa.array(pdf.sort_values("doc_id")["text"].iloc[:2 * SAMPLE])
        v = normalised(np.vstack(list(count_chunks(texts))), idf)
        v = v[np.linalg.norm(v, axis=1) > 0]
        if not len(v):
            return pd.DataFrame({"lang": [], "centre": [], "floor": []})
        centres = spherical_kmeans(v, CENTROIDS)
        cos = v @ centres.T
        own = np.argmax(cos, axis=1)
        floors = [float(np.quantile(cos[own == i, i], TAIL)) if (own == i).any() else 0.0 for i in range(len(centres))]
        return pd.DataFrame({"lang": pdf["lang"].iloc[0], "centre": [c.astype(np.float32).tobytes() for c in centres], "floor": floors})

    got = sorted((r["lang"], bytes(r["centre"]), r["floor"]) for r in materialize(
        sample.groupBy("lang").applyInPandas(cluster, "lang string, centre binary, floor double"), "languages").collect())
    if not got:
        return None
    return LanguageModel([g[0] for g in got], np.vstack([np.frombuffer(g[1], np.float32) for g in got]),
                         np.array([g[2] for g in got]), idf)


def not_held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % 3 != 1


def predict_language(docs: DataFrame) -> DataFrame:
    """One row per document row: doc_id, held_out, lang_pred, score, rejected.

    Text that is null or has no letter is ``und`` with score 0; so is every
    text when nothing could be learnt.  A null doc_id is neither held out nor
    learnt from."""
    model = fit_languages(docs, not_held_out())
    schema = "lang string, score double, rejected boolean"
    rows = docs.select(F.col("doc_id").alias("doc_id"), F.col("text").alias("text"))
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    if model is None:
        rows = rows.withColumn("p", F.lit(None).cast("struct<lang:string,score:double,rejected:boolean>"))
    else:
        shared = docs.sparkSession.sparkContext.broadcast(model)

        @F.arrow_udf(schema)
        def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for texts in batches:
                names, scores, rejected = shared.value.predict(texts) if len(texts) else ([], [], [])
                yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64()),
                                                  pa.array(rejected, pa.bool_())], ["lang", "score", "rejected"])

        rows = rows.withColumn("p", predict.asNondeterministic()(F.coalesce(F.col("text"), F.lit(""))))
    known = lettered & F.col("p.lang").isNotNull()
    return rows.select("doc_id", F.coalesce(~not_held_out(), F.lit(False)).alias("held_out"),
                       F.when(known, F.col("p.lang")).otherwise(F.lit(UNKNOWN)).alias("lang_pred"),
                       F.when(known, F.col("p.score")).otherwise(F.lit(0.0)).alias("score"),
                       F.coalesce(F.when(known, F.col("p.rejected")), F.lit(True)).alias("rejected"))
