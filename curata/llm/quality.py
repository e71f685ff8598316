"""Quality scores by nearest-neighbour voting among labelled latent-semantic vectors.

A bounded sample of labelled documents (``SAMPLE``, the least by a hash of doc_id) gives the
model: hashed terms of the whole text, of two kinds - shapes (runs of letter case, digits and
signs, and words that repeat) and words (A-Z in lower case) - weighted by log frequency and
inverse document frequency, projected on the first ``LATENT`` singular directions. The labelled vectors are broadcast (SAMPLE x LATENT
floats, about 1 MB, whatever the corpus). Every document's exact cosine with all of them is
computed in blocks; its ``NEIGHBOURS`` nearest vote with weights that fall with distance.

Defined results: null and empty texts have the terms of an empty text and a score like any
other; several labels of a document count by their mean, ties as 0; null labels and null
doc_ids teach nothing; of rows with one labelled doc_id that of the least text hash teaches;
without any label the score is 0.5; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curata.llm.buffers import column, slices, span_hashes, texts, tune

SAMPLE, LATENT, NEIGHBOURS, SHAPES, WORDS = 4096, 48, 15, 2048, 2048
TERMS = SHAPES + WORDS
KINDS = ((0, SHAPES, 1.0), (SHAPES, TERMS, 0.6))  # each kind's terms, and its weight beside the other
REPEATS = 3.0  # weight of the terms for words that repeat, few as they are among the shapes: taught by rows of remainders 2 to 4 and judged on remainder 1, all of them rows that may teach, 2 to 4 keep a third of the bad documents that 1 keeps
THRESHOLD = 0.3
_SHAPE = np.full(256, 2, np.uint32)  # non-ASCII bytes count as small letters
_SHAPE[:128] = np.arange(128) + 8
_SHAPE[ord("a") : ord("z") + 1] = 2
_SHAPE[ord("A") : ord("Z") + 1] = 3
_SHAPE[ord("0") : ord("9") + 1] = 4
_SHAPE[[0x20, 0x09, 0x0D]] = 1
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def terms(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """[texts, TERMS] term counts: shapes of 2 and 4 bytes, words that repeat one of the 3 before, their number; and words."""
    n = len(offsets) - 1
    if not len(data):
        return np.zeros((n, TERMS), np.float32)
    shape, size = _SHAPE[data], np.diff(offsets)
    owner = np.repeat(np.arange(n, dtype=np.int64) * TERMS, size)
    flat = np.zeros(n * TERMS, np.int64)
    for width, salt in ((2, 0x9E3779B1), (4, 0x85EBCA6B)):
        if len(data) < width:
            continue
        code = shape[: len(data) - width + 1].copy()
        for k in range(1, width):
            code = code * np.uint32(0x01000193) + shape[k : len(data) - width + 1 + k]
        code = ((code * np.uint32(salt)) >> np.uint32(18)) % np.uint32(SHAPES - 8)
        whole = np.ones(len(code), bool)  # not across two texts
        for k in range(1, width):
            inner = offsets[1:-1] - k
            whole[inner[(inner >= 0) & (inner < len(code))]] = False
        flat += np.bincount((owner[: len(code)] + code)[whole], minlength=n * TERMS)
    solid = ~_BLANK[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets[:-1]] = True
    first = first[:-1]
    starts, ends = solid.copy(), np.zeros(len(data), bool)
    starts[1:] &= ~solid[:-1] | first[1:]
    ends[:-1] = solid[:-1] & (~solid[1:] | first[1:])
    ends[-1] = solid[-1]
    starts = np.flatnonzero(starts)
    words = span_hashes(_LOWER[data], starts, np.flatnonzero(ends) + 1)
    bounds = np.searchsorted(starts, offsets)
    of = np.repeat(np.arange(n, dtype=np.int64), np.diff(bounds)) * TERMS
    for lag in (1, 2, 3):
        same = (words[lag:] == words[:-lag]) & (of[lag:] == of[:-lag])
        flat += np.bincount(of[lag:][same] + SHAPES - lag, minlength=n * TERMS)
    flat += np.bincount(of + SHAPES + (words % np.uint64(WORDS)).astype(np.int64), minlength=n * TERMS)
    counts = flat.reshape(n, TERMS)
    counts[:, SHAPES - 4] = np.diff(bounds)
    return counts.astype(np.float32)


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Log frequencies a thousand terms of a kind, times idf; the kinds by their weights, rows of length 1 (an empty text: 0)."""
    out = np.empty_like(counts)
    for a, b, weight in KINDS:
        x = out[:, a:b]
        np.multiply(counts[:, a:b], 1000 / np.maximum(counts[:, a:b].sum(axis=1, keepdims=True), 1), out=x)
        np.log1p(x, out=x)
        x *= idf[a:b]
        x *= weight / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    out /= np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)
    return out


def _directions(x: np.ndarray, k: int, rounds: int = 6) -> np.ndarray:
    """The first right singular directions [TERMS, k], by seeded subspace iteration."""
    basis = np.random.default_rng(0).standard_normal((x.shape[1], k + 8))
    for _ in range(rounds):
        basis, _ = np.linalg.qr(x.T @ (x @ basis.astype(np.float32)))
    small = x @ basis.astype(np.float32)
    _, rotation = np.linalg.eigh(small.T.astype(np.float64) @ small)
    return np.ascontiguousarray((basis @ rotation[:, ::-1])[:, :k], dtype=np.float32)


class Model:
    """idf, projection, labelled vectors and their labels."""

    def __init__(self, counts: np.ndarray, labels: np.ndarray):
        there = (counts > 0).sum(axis=0)
        self.idf = np.log((1 + len(counts)) / (1 + there)).astype(np.float32) + 1
        self.idf[SHAPES - 3 : SHAPES] *= REPEATS
        x = weighted(counts, self.idf)
        self.projection = _directions(x, LATENT)
        self.vectors, self.labels = self._latent(x), labels.astype(np.float32)

    def _latent(self, x):
        z = x @ self.projection
        return z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-9)

    def scores(self, counts: np.ndarray) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(counts), 0.5)
        cosine = self._latent(weighted(counts, self.idf)) @ self.vectors.T
        k = min(NEIGHBOURS, len(self.labels))
        near = np.argpartition(cosine, -k, axis=1)[:, -k:]
        weight = np.exp(8 * (np.take_along_axis(cosine, near, axis=1).astype(np.float64) - 1))
        return np.clip((weight * self.labels[near]).sum(axis=1) / weight.sum(axis=1), 0, 1)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, learnt_from=lambda doc_id: ~held_out(doc_id)) -> Model:
    """Learns from the ``sample`` labelled documents with the least hashes of doc_id among those allowed."""
    tune(docs.sparkSession)
    known = labels.where("quality is not null and doc_id is not null").select(F.col("doc_id").cast("long").alias("id"), "quality").where(learnt_from(F.col("id")))
    known = known.groupBy("id").agg(F.avg("quality").alias("quality")).orderBy(F.xxhash64("id"), "id").limit(sample)

    def run(batches):
        for batch in batches:
            data, offsets = texts(column(batch, "text"))
            for i, j in slices(offsets):
                found = terms(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]).astype(np.int32)
                where = [np.flatnonzero(x) for x in found]
                columns = [column(batch, "id")[i:j], column(batch, "tie")[i:j], pa.array(where, pa.list_(pa.int32())), pa.array([x[w] for x, w in zip(found, where, strict=True)], pa.list_(pa.int32())), column(batch, "quality")[i:j]]
                yield pa.RecordBatch.from_arrays(columns, ["id", "tie", "term", "n", "quality"])

    rows = docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(F.broadcast(known), "id").select("id", F.xxhash64("text").alias("tie"), "text", "quality")
    rows = rows.mapInArrow(run, "id long, tie long, term array<int>, n array<int>, quality double")
    # of rows with one doc_id, that of the least hash; combined before the shuffle
    rows = rows.groupBy("id").agg(F.min(F.struct("tie", "term", "n", "quality")).alias("x")).select("id", "x.term", "x.n", "x.quality").orderBy("id").toArrow()
    counts = np.zeros((len(rows), TERMS), np.float32)
    term, n = rows["term"].combine_chunks(), rows["n"].combine_chunks()
    counts[np.repeat(np.arange(len(rows)), term.value_lengths().to_numpy()), term.flatten().to_numpy()] = n.flatten().to_numpy()
    return Model(counts, (rows["quality"].to_numpy() > 0.5).astype(np.float32))


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score, predicted of every document."""
    return _scored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model, threshold, keep_text=False)


def kept(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that aren't rejected, with all their columns."""
    return _scored(docs, model, threshold, keep_text=True)


def _scored(docs: DataFrame, model: Model, threshold: float, keep_text: bool) -> DataFrame:
    spark = docs.sparkSession
    tune(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        own = shared.value
        for batch in batches:
            data, offsets = texts(column(batch, "text"))
            for i, j in slices(offsets):
                result = own.scores(terms(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]))
                if keep_text:
                    yield batch.slice(i, j - i).filter(pa.array(result >= threshold))
                else:
                    yield pa.RecordBatch.from_arrays([column(batch, "doc_id")[i:j], pa.array(result), pa.array((result >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    return docs.mapInArrow(run, docs.schema if keep_text else "doc_id long, score double, predicted int")
