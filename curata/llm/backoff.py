"""Stupid-backoff scores from relational n-gram count tables partitioned by hash.

1. Documents are read once into blocks of about ``BLOCK_BYTES`` of text, written to the shared
   folder: doc_ids, words a document, the block's distinct word hashes and its word stream.
2. Each block explodes its n-grams of all orders and counts the distinct ones; they are dealt
   to buckets by the top bits of their hash. A block sends an n-gram once, however often and
   in however many documents it stands, so a very common n-gram costs one entry a block and
   all buckets are alike. On the way the columns of n-grams are packed.
3. A bucket is one partition of the count tables. There the exploded n-grams are a table with
   a row an n-gram; the count table is its sum by n-gram, and is joined back to it.
4. Each block gets its n-grams' counts and scores every position; Spark sums the scores of a
   document's positions.

S(w | context) is count(context w) / count(context) where the whole n-gram was counted
``least`` times at least, else ``alpha`` times the score of w after the context less its first
word; a single word scores count / all words. Counts cover all documents.

Words are ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z in lower case; n-grams don't cross
documents. Defined results: null, empty and blank texts have n_words 0, log_score 0 and a
null mean; repeated rows count and are scored each; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curata.functions.storage import shuffles_dropped, written
from curata.llm.buffers import column, mix, settings, span_hashes, texts, tune
from curata.llm.minhash import _BLANK, _LOWER

BLOCK_BYTES = 10 << 20
BUCKET_ENTRIES, POSITIONS = 2_000_000, 1 << 16
ORDER, ALPHA, LEAST = 3, 0.4, 2


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, number of words of each text)."""
    data = _LOWER[data]
    solid = ~_BLANK[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets[:-1]] = True
    first = first[:-1]
    starts, ends = solid.copy(), np.zeros(len(data), bool)
    if len(data):
        starts[1:] &= ~solid[:-1] | first[1:]
        ends[:-1] = solid[:-1] & (~solid[1:] | first[1:])
        ends[-1] = solid[-1]
    starts = np.flatnonzero(starts)
    return span_hashes(data, starts, np.flatnonzero(ends) + 1), np.diff(np.searchsorted(starts, offsets))


def _pack(values: np.ndarray) -> bytes:
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpack(payload: bytes, kind) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(payload), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(kind).ravel()


def ngrams(hashes: np.ndarray, per: np.ndarray, order: int):
    """For each order k from 1: (hash of the n-gram that ends at each place, whether it lies within one text)."""
    rank = (np.arange(len(hashes)) - np.repeat(np.cumsum(per) - per, per)).astype(np.int32)
    have = hashes
    yield have, np.ones(len(hashes), bool)
    for k in range(2, order + 1):
        longer = np.zeros_like(have)
        longer[1:] = mix(have[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:] + np.uint64(k))
        yield longer, rank >= k - 1
        have = longer


def _blocks(docs: DataFrame) -> DataFrame:
    def run(batches):
        task, n = TaskContext.get().partitionId() << 36, 0
        ids, hashes, per, size = [], [], [], 0

        def full():
            vocabulary, stream, count = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
            rank = np.empty(len(count), np.uint32)
            rank[_by_count(count)] = np.arange(len(count), dtype=np.uint32)
            own = np.concatenate(per)
            columns = [pa.array([task + n]), pa.array([sum((x.to_pylist() for x in ids), [])], pa.list_(pa.int64())), pa.array([own.astype(np.int32)], pa.list_(pa.int32())), pa.array([_pack(np.diff(vocabulary, prepend=np.uint64(0)))], pa.binary()), pa.array([_pack(count.astype(np.uint32))], pa.binary()), pa.array([_pack(rank[stream])], pa.binary()), pa.array([len(stream)])]
            return pa.RecordBatch.from_arrays(columns, ["block", "doc_ids", "per", "vocabulary", "vocabulary_n", "stream", "n"])

        for batch in batches:
            data, offsets = texts(column(batch, "text"))
            i = 0
            while i < len(batch):
                j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + BLOCK_BYTES - size, side="right")) - 1)
                for a in range(i, j, 256):  # bounds the temporaries
                    b = min(a + 256, j)
                    found = words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                    hashes.append(found[0])
                    per.append(found[1])
                ids.append(column(batch, "doc_id")[i:j])
                size += int(offsets[j] - offsets[i])
                i = j
                if size >= BLOCK_BYTES - 65536:
                    yield full()
                    n += 1
                    ids, hashes, per, size = [], [], [], 0
        if ids:
            yield full()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "block long, doc_ids array<long>, per array<int>, vocabulary binary, vocabulary_n binary, stream binary, n long")


def _by_count(count: np.ndarray) -> np.ndarray:
    """Places of the vocabulary by falling count: common words get small numbers, which pack well."""
    return np.argsort(-count.astype(np.int64), kind="stable")


def _opened(batch: pa.RecordBatch, k: int) -> np.ndarray:
    """The word hashes of block k of a batch, in order."""
    vocabulary = np.cumsum(_unpack(column(batch, "vocabulary")[k].as_py(), np.uint64), dtype=np.uint64)
    order = _by_count(_unpack(column(batch, "vocabulary_n")[k].as_py(), np.uint32))
    return vocabulary[order][_unpack(column(batch, "stream")[k].as_py(), np.uint32)]


def score(docs: DataFrame, order: int = ORDER, alpha: float = ALPHA, least: int = LEAST) -> DataFrame:
    """doc_id, n_words, log_score (sum of natural logarithms), mean_log of every document."""
    tune(docs.sparkSession)
    blocks = written(_blocks(docs), "word-blocks")
    total = blocks.agg(F.sum("n").alias("n")).first()["n"] or 0
    bits = max(6, (int(total * order / BUCKET_ENTRIES)).bit_length())
    shift = np.uint64(64 - bits)

    def explode(batches):
        for batch in batches:
            for k in range(len(batch)):
                block = column(batch, "block")[k].as_py()
                hashes = _opened(batch, k)
                per = np.array(column(batch, "per")[k].as_py(), np.int64)
                for size, (codes, whole) in enumerate(ngrams(hashes, per, order), 1):
                    keys, n = np.unique(codes[whole], return_counts=True)
                    bounds = np.searchsorted(keys >> shift, np.arange((1 << bits) + 1, dtype=np.uint64))
                    rows = [(b, block, size, _pack(np.diff(keys[i:j], prepend=np.uint64(0))), _pack(n[i:j].astype(np.uint32))) for b, (i, j) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)) if j > i]
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary()), strict=True)], ["bucket", "block", "size", "keys", "times"])

    def counted(table: pa.Table) -> pa.Table:
        ngrams_, times, lengths = [], [], []
        for keys, n in zip(table["keys"], table["times"], strict=True):
            ngrams_.append(np.cumsum(_unpack(keys.as_py(), np.uint64), dtype=np.uint64))
            times.append(_unpack(n.as_py(), np.uint32))
            lengths.append(len(ngrams_[-1]))
        exploded = pa.table({"size": np.repeat(table["size"].to_numpy(), lengths), "ngram": np.concatenate(ngrams_), "times": np.concatenate(times), "place": np.arange(sum(lengths))})
        counts = exploded.group_by(["size", "ngram"], use_threads=False).aggregate([("times", "sum")])
        joined = exploded.select(["size", "ngram", "place"]).join(counts, ["size", "ngram"], use_threads=False)
        total = np.empty(len(exploded), np.uint64)
        total[joined["place"].to_numpy()] = joined["times_sum"].to_numpy()
        packed = [_pack(x) for x in np.split(total, np.cumsum(lengths)[:-1])]
        return table.select(["block", "bucket", "size"]).append_column("counts", pa.array(packed, pa.binary()))

    def scored(batches):
        for batch in batches:
            for k in range(len(batch)):
                hashes, per = _opened(batch, k), np.array(column(batch, "per")[k].as_py(), np.int64)
                parts = column(batch, "parts")[k].as_py() or []
                counts = []
                for size, (codes, whole) in enumerate(ngrams(hashes, per, order), 1):
                    own = [_unpack(x["counts"], np.uint64) for x in parts if x["size"] == size]  # in the order of the buckets, so of the keys
                    n = np.zeros(len(codes), np.int64)
                    if own:
                        _, where = np.unique(codes[whole], return_inverse=True)
                        n[whole] = np.concatenate(own)[where]
                    counts.append(n)
                logs = position_scores(counts, total, alpha, least)
                # a row a position, and one without a word for each document
                block, i = column(batch, "block")[k].as_py(), np.arange(len(per), dtype=np.int32)
                for doc, n, log in ((i, 0, np.zeros(len(i))), (np.repeat(i, per), 1, logs)):
                    for a in range(0, len(doc), POSITIONS):
                        own = doc[a : a + POSITIONS]
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), block)), pa.array(own), pa.array(np.full(len(own), n, np.int64)), pa.array(log[a : a + POSITIONS])], ["block", "i", "n", "log"])

    session = docs.sparkSession
    with settings(session, {"spark.sql.execution.arrow.maxRecordsPerBatch": "1"}):  # rows are blocks here
        exploded = blocks.select("block", "per", "vocabulary", "vocabulary_n", "stream").mapInArrow(explode, "bucket int, block long, size int, keys binary, times binary")
        counts = exploded.groupBy("bucket").applyInArrow(counted, "block long, bucket int, size int, counts binary")
        with shuffles_dropped(session):  # the exploded n-grams are the largest thing here, and not needed once counted
            counts = written(counts, "ngram-counts")
        parts = counts.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("size", "bucket", "counts"))).alias("parts"))
        joined = blocks.join(parts, "block", "left").select("block", "per", "vocabulary", "vocabulary_n", "stream", "parts")
        logs = joined.mapInArrow(scored, "block long, i int, n long, log double")
        sums = written(logs.groupBy("block", "i").agg(F.sum("n").alias("n_words"), F.sum("log").alias("log_score")), "scores")
    ids = blocks.select("block", F.posexplode("doc_ids").alias("i", "doc_id"))
    return ids.join(sums, ["block", "i"]).select("doc_id", "n_words", "log_score", F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words")).alias("mean_log"))


def position_scores(counts: list[np.ndarray], total: int, alpha: float, least: int) -> np.ndarray:
    """The logarithm of the score at each place. counts: by order, of the n-gram that ends there (0: it would begin before the text)."""
    out = np.log(np.maximum(counts[0], 1)) - np.log(max(total, 1))
    for k in range(1, len(counts)):
        context = np.zeros_like(counts[k])
        context[1:] = counts[k - 1][:-1]
        exists, seen = counts[k] > 0, counts[k] >= least
        out = np.where(exists & ~seen, np.log(alpha) + out, out)
        out[seen] = np.log(counts[k][seen]) - np.log(context[seen])
    return out


ORACLE = """
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
p AS (SELECT r, i, w[i] AS w0, CASE WHEN i > 1 THEN w[i - 1] END AS w1, CASE WHEN i > 2 THEN w[i - 2] END AS w2 FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM docs)),
n AS (SELECT count(*)::DOUBLE AS n FROM p),
c1 AS (SELECT w0, count(*)::DOUBLE AS c FROM p GROUP BY ALL),
c2 AS (SELECT w1, w0, count(*)::DOUBLE AS c FROM p WHERE w1 IS NOT NULL GROUP BY ALL),
c3 AS (SELECT w2, w1, w0, count(*)::DOUBLE AS c FROM p WHERE w2 IS NOT NULL GROUP BY ALL),
s AS (
  SELECT p.r, CASE
    WHEN c3.c >= 2 THEN ln(c3.c) - ln(b2.c)
    WHEN c2.c >= 2 THEN (CASE WHEN p.w2 IS NOT NULL THEN ln(0.4) ELSE 0 END) + ln(c2.c) - ln(b1.c)
    ELSE (CASE WHEN p.w2 IS NOT NULL THEN 2 * ln(0.4) WHEN p.w1 IS NOT NULL THEN ln(0.4) ELSE 0 END) + ln(c1.c) - ln(n.n) END AS s
  FROM p CROSS JOIN n JOIN c1 ON p.w0 = c1.w0
  LEFT JOIN c2 ON p.w1 = c2.w1 AND p.w0 = c2.w0 LEFT JOIN c1 b1 ON p.w1 = b1.w0
  LEFT JOIN c3 ON p.w2 = c3.w2 AND p.w1 = c3.w1 AND p.w0 = c3.w0 LEFT JOIN c2 b2 ON p.w2 = b2.w1 AND p.w1 = b2.w0)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, round(coalesce(t.s, 0), 4) AS log_score, round(t.s / len(d.w), 6) AS mean_log
FROM docs d LEFT JOIN (SELECT r, sum(s) AS s FROM s GROUP BY r) t USING (r)
"""
