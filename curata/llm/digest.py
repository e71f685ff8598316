"""Document fingerprints: improbable-feature digests.

Every ``WINDOW``-byte window of the whole text gets a rarity from its (collision) entropy: the
number of equal byte pairs within it, by distance from what running text has; windows of
very low entropy (runs, padding) are passed over. In each stretch of ``WINDOW`` neighbouring
windows the rarest (leftmost of equals) scores a point, and windows with ``POPULAR`` points
are the text's features. They go, in order, into a chain of Bloom filters of ``FILTER_BITS``
bits, ``PER_FILTER`` features each, ``HASHES`` bits a feature.

Two digests are compared filter by filter: bits in common, less those expected by chance,
over the most there could be; each filter of the shorter chain takes its best partner, and
the mean is the likeness, 0 to 1. A filter of so few bits that they would lie in one of the
other chain's filters by chance counts less.

Defined results: null and empty texts have the empty fingerprint, alike (1) to each other
and unlike (0) all others; a text without a feature (shorter than a window, or all of low
entropy) has one feature, itself; equal texts have equal fingerprints. For ``with_next``: rows
with the same doc_id follow one another by a hash of the text; null ids come last; a single
document is its own next; further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curata.llm.buffers import SLICE_BYTES, column, span_hashes, tune
from curata.operators.ordered import bucket_of, buckets_for, splitters

WINDOW, POPULAR = 64, 16
TYPICAL, WEAK = 140, 900  # equal pairs in a window of running text; above WEAK it says little
FILTER_BITS, PER_FILTER, HASHES = 2048, 160, 5
SURE = 3  # decades
BUCKETS = 192
_LOW = np.uint64(0xFFFFFFFF)


def equal_pairs(data: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """For each window's start, how many pairs of its bytes are equal."""
    n = len(data)
    if n < window:
        return np.zeros(0, np.int32)
    back, ahead = np.zeros(n, np.uint8), np.zeros(n, np.uint8)
    for d in range(1, window):
        same = (data[d:] == data[:-d]).view(np.uint8)
        back[d:] += same
        ahead[:-d] += same
    back, ahead = np.cumsum(back, dtype=np.int64), np.cumsum(ahead, dtype=np.int64)
    out = back[window - 1 :].copy()
    out[1:] -= ahead[: n - window]
    return out.astype(np.int32)


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each feature, number of features of each text), in order."""
    n_texts, size = len(offsets) - 1, np.diff(offsets)
    pairs = equal_pairs(data)
    chosen = np.zeros(0, np.int64)
    if len(pairs):
        rarity = np.abs(pairs - TYPICAL).astype(np.uint64) + np.uint64(1)
        rarity[pairs > WEAK] = 0
        place = np.arange(len(pairs), dtype=np.uint64)
        valid = np.ones(len(pairs), bool)
        for end in offsets[1:-1].tolist():  # windows across two texts
            valid[max(0, end - WINDOW + 1) : end] = False
        key = np.where(valid & (rarity > 0), (rarity << np.uint64(32)) | (_LOW - place), np.uint64(0))
        best, width = key, 1
        while width < WINDOW:  # the largest key of WINDOW neighbours
            best = best.copy()
            best[:-width] = np.maximum(best[:-width], best[width:]) if width < len(best) else best[:-width]
            width *= 2
        best = best[valid]
        best = best[best > 0]
        at = (_LOW - (best & _LOW)).astype(np.int64)
        if len(at):
            new = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
            chosen = at[new][np.diff(np.append(new, len(at))) >= POPULAR]
    per = np.diff(np.searchsorted(chosen, offsets))
    hashes = span_hashes(data, chosen, chosen + WINDOW)
    none = np.flatnonzero((per == 0) & (size > 0))
    if len(none):  # the text itself
        whole = span_hashes(data, offsets[none], offsets[none + 1])
        hashes = np.insert(hashes, np.cumsum(per)[none], whole)
        per[none] = 1
    return hashes, per


def filters(hashes: np.ndarray, per: np.ndarray) -> list[np.ndarray]:
    """The chain of packed filters [n, FILTER_BITS / 8] of each text."""
    chain = -(-per // PER_FILTER)
    first = np.cumsum(chain) - chain
    rank = np.arange(len(hashes)) - np.repeat(np.cumsum(per) - per, per)
    which = np.repeat(first, per) + rank // PER_FILTER
    bits = np.zeros((int(chain.sum()), FILTER_BITS), bool)
    step = np.uint64(FILTER_BITS.bit_length() - 1)
    for k in range(HASHES):
        bits[which, ((hashes >> (step * np.uint64(k))) & np.uint64(FILTER_BITS - 1)).astype(np.int64)] = True
    return np.split(np.packbits(bits, axis=1), np.cumsum(chain)[:-1]) if len(chain) else []


def digests(texts: list[bytes]) -> list[np.ndarray]:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in texts], dtype=np.int64)]).astype(np.int64)
    return filters(*features(np.frombuffer(b"".join(texts), np.uint8), offsets))


def rendered(digest: np.ndarray) -> str:
    """The fingerprint as text: filters in base64, joined by a colon."""
    return ":".join(base64.b64encode(x.tobytes()).decode() for x in digest)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    if not len(a) or not len(b):
        return 1.0 if len(a) == len(b) else 0.0
    if len(a) > len(b):
        a, b = b, a
    na, nb = np.bitwise_count(a).sum(axis=1), np.bitwise_count(b).sum(axis=1)
    both = np.zeros((len(a), len(b)), np.int64)
    for k in range(len(a)):
        both[k] = np.bitwise_count(a[k] & b).sum(axis=1)
    chance = na[:, None] * nb[None, :] / FILTER_BITS
    most = np.minimum(na[:, None], nb[None, :])
    share = np.clip((both - chance) / np.maximum(most - chance, 1e-9), 0, 1)
    # decades by which it is unlikely that the bits of a filter of a lie in one of the len(b) filters by chance
    sure = -(np.log10(len(b)) + na[:, None] * np.log10(nb[None, :] / FILTER_BITS))
    return float((share * np.clip(sure / SURE, 0, 1)).max(axis=1).mean())


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint of every document."""
    tune(docs.sparkSession)

    def run(batches):
        for batch in batches:
            rows = [(x or "").encode() for x in column(batch, "text").to_pylist()]
            for i, j in _parts([len(x) for x in rows]):
                yield pa.RecordBatch.from_arrays([column(batch, "doc_id")[i:j], pa.array([rendered(x) for x in digests(rows[i:j])], pa.string())], ["doc_id", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fingerprint string")


def _parts(sizes: list[int], most: int = SLICE_BYTES):
    i = total = 0
    for j, size in enumerate(sizes):
        if j > i and total + size > most:
            yield i, j
            i, total = j, 0
        total += size
    if i < len(sizes):
        yield i, len(sizes)


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by as many (or all) of the first of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def with_next(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next document in descending order of doc_id lies in the same range bucket, or is the
    first of the bucket below (of the lowest: of the highest). Those first ones, one a
    bucket, are sent to both buckets; a task then streams its sorted rows. There are BUCKETS
    buckets, or more where they would grow large.
    """
    spark = docs.sparkSession
    tune(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("key", F.coalesce("doc_id", F.lit(-(1 << 63))))
    bounds = splitters(rows, "key", buckets or buckets_for(docs, BUCKETS))
    rows = rows.withColumn("bucket", bucket_of(F.col("key"), bounds))
    tops = rows.groupBy("bucket").agg(F.max("key").alias("key")).orderBy("bucket").collect()  # one row a bucket
    guards = [(r["bucket"], r["key"], tops[(i + 1) % len(tops)]["bucket"]) for i, r in enumerate(tops)]
    guards = spark.createDataFrame(guards, "bucket int, key long, above int")
    first = rows.join(F.broadcast(guards), ["bucket", "key"]).select("doc_id", "text", "key", F.col("above").alias("bucket"), F.lit(True).alias("guard"))
    both = rows.withColumn("guard", F.lit(False)).unionByName(first)
    both = both.withColumn("tie", F.xxhash64("text")).repartition("bucket").sortWithinPartitions("bucket", "guard", F.desc("key"), F.desc("tie"))

    def run(batches):
        held = None  # (bucket, doc_id, text, digest) of a row whose next isn't known yet
        for batch in batches:
            values = [column(batch, x).to_pylist() for x in ("bucket", "doc_id", "text", "guard")]
            for i, j in _parts([len(x) for x in values[2]], SLICE_BYTES // 2):
                part = list(zip(*(v[i:j] for v in values), strict=True))
                own = digests([x[2].encode() for x in part])
                pairs = []
                for (bucket, doc_id, text, guard), digest in zip(part, own, strict=True):
                    if held is not None and held[0] == bucket:
                        pairs.append((*held[1:], text, digest))
                    held = None if guard else (bucket, doc_id, text, digest)
                if pairs:
                    new = [edited(p[1], p[3]).encode() for p in pairs]
                    changed = digests(new)
                    out = [(p[0], len(p[1]), hashlib.sha256(raw).hexdigest(), rendered(p[2]), rendered(c), likeness(p[2], c), likeness(p[2], p[4])) for p, raw, c in zip(pairs, new, changed, strict=True)]
                    types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True)], ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    return both.select("bucket", "doc_id", "text", "guard").mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
