"""Language identification by language-bitmask n-gram filters.

Byte n-grams (n = ``GRAM``) of case-folded text with all that isn't a letter taken as one
blank. A bounded sample of labelled documents of each language (``SAMPLE``) gives the
n-grams a language contains: those that make up ``FLOOR`` of its n-grams at least (so 1 / FLOOR
at most) and are no less than ``SHARE`` times as common in it as in the language where they
are commonest. All languages
share one bit-sliced Bloom filter: each of its cells is a mask of one bit a language, and the
AND of an n-gram's ``HASHES`` cells names all languages that contain it. A document's hits
of each language (popcounts of its bit) are corrected for that language's false positive
rate, known from the fill of its slice; most corrected hits decide.

Defined results: null text or text without a letter is ``und`` with score 0; a text too short
for an n-gram, or without hits, gets the commonest language of the sample; ties go to the
commoner language; without any labelled document everything is ``und``; rows without lang or
doc_id teach nothing; rows of one doc_id each teach their own text under their own lang, equal
ones once; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curata.llm.buffers import column, mix, slices, texts, tune
from curata.llm.columns import fresh

GRAM, SAMPLE, FLOOR, SHARE, HASHES, BITS_PER_GRAM = 4, 1500, 4e-6, 0.4, 3, 24
ENOUGH = 8  # n-grams from which on a text without a known language can be rejected
UNKNOWN = "und"
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[[i for i in range(128) if not chr(i).isalpha()]] = 32


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes, text of each): the n-grams that begin and end within a text and aren't blank; a run of blanks counts as one."""
    folded = _FOLD[data]
    if len(data) > 1:  # U+00C0..U+00DE fold to U+00E0..U+00FE
        upper = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)
        folded[1:][upper] += 32
    first = np.zeros(len(data) + 1, bool)
    first[offsets[:-1]] = True
    keep = np.ones(len(data), bool)
    keep[1:] = (folded[1:] != 32) | (folded[:-1] != 32) | first[1:-1]
    owner = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))[keep]
    folded = folded[keep].astype(np.uint64)
    n = len(folded) - GRAM + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int32)
    code = np.zeros(n, np.uint64)
    for k in range(GRAM):
        code = (code << np.uint64(8)) | folded[k : n + k]
    own = owner[:n] == owner[GRAM - 1 :]
    return code[own], owner[:n][own]


class Filters:
    """The bit-sliced Bloom filter. counts: {language: (codes, counts)}, commonest language first."""

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]]):
        self.languages = list(counts)
        self.words = max(1, -(-len(counts) // 64))
        share: dict[int, float] = {}
        for codes, n in counts.values():
            for code, x in zip(codes.tolist(), (n / max(1, n.sum())).tolist(), strict=True):
                share[code] = max(share.get(code, 0), x)
        sets = []
        for codes, n in counts.values():
            own, most = n / max(1, n.sum()), np.array([share[c] for c in codes.tolist()])
            sets.append(codes[own >= SHARE * most])
        size = max(64, BITS_PER_GRAM * max([1, *map(len, sets)]))
        self.mask = np.uint64((1 << (size - 1).bit_length()) - 1)
        self.cells = np.zeros((int(self.mask) + 1, self.words), np.uint64)
        rate = []
        for k, codes in enumerate(sets):
            bit = np.uint64(1 << (k % 64))
            for slot in self._slots(codes):
                self.cells[slot, k // 64] |= bit
            rate.append(float(((self.cells[:, k // 64] & bit) > 0).mean()) ** HASHES)
        self.rate = np.array(rate)
        self.learnt = any(map(len, sets))

    def _slots(self, codes: np.ndarray) -> list[np.ndarray]:
        one = mix(codes)
        two = (one >> np.uint64(32)) | np.uint64(1)
        return [((one + two * np.uint64(i)) & self.mask).astype(np.int64) for i in range(HASHES)]

    def masks(self, codes: np.ndarray) -> np.ndarray:
        """[n, words]: the languages that contain each n-gram, and some by chance."""
        found = None
        for slot in self._slots(codes):
            found = self.cells[slot] if found is None else found & self.cells[slot]
        return found

    def hits(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(corrected hits [texts, languages], n-grams of each text)."""
        codes, owner = grams(data, offsets)
        n_texts = len(offsets) - 1
        total = np.bincount(owner, minlength=n_texts).astype(np.float64)
        masks, out = self.masks(codes), np.zeros((n_texts, len(self.languages)))
        for k in range(len(self.languages)):
            on = (masks[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1) > 0
            raw = np.bincount(owner[on], minlength=n_texts)
            out[:, k] = np.maximum(0, raw - total * self.rate[k]) / (1 - self.rate[k])
        return out, total

    def decide(self, data: np.ndarray, offsets: np.ndarray) -> tuple[list[str], np.ndarray]:
        """(language, score) of each text; the score is the best language's share of all corrected hits, times a
        factor that grows with the share of its n-grams the language contains."""
        hits, total = self.hits(data, offsets)
        best = hits.argmax(axis=1)
        top, all_ = hits[np.arange(len(best)), best], hits.sum(axis=1)
        score = np.where(all_ > 0, top / np.maximum(all_, 1e-9), 1 / len(self.languages)) * np.where(total > 0, np.minimum(1, 0.5 + top / np.maximum(total, 1)), 0.5)
        return [self.languages[k] for k in best.tolist()], np.clip(score, 0, 1)


    def plausible(self, data: np.ndarray, offsets: np.ndarray, least: float) -> np.ndarray:
        """Whether the best language contains the ``least`` share of a text's n-grams, corrected; true of texts of less than
        ENOUGH n-grams, and if no language is known. Neither the number of languages nor what they share counts."""
        hits, total = self.hits(data, offsets)
        return (hits.max(axis=1) >= least * total) | (total < ENOUGH) | (not self.learnt)


def fit(docs: DataFrame, sample: int = SAMPLE, learnt_from=lambda doc_id: ~held_out(doc_id)) -> Filters:
    """Learns from at most ``sample`` documents of each language, those with the least hashes of doc_id and text.

    A document is a distinct doc_id, language and text, each taught once under its own language: rows of one doc_id
    may differ in either, and copies of a row count once.
    """
    spark = docs.sparkSession
    tune(spark)
    own = F.xxhash64("id", "text")
    known = docs.where("lang is not null and doc_id is not null").select(F.col("doc_id").cast("long").alias("id"), F.col("lang").alias("label"), "text").where(learnt_from(F.col("id"))).withColumn("key", own)
    counts = known.groupBy("label").agg(F.count("*").alias("count"), F.approx_count_distinct("key").alias("n")).orderBy(F.desc("count"), "label").collect()  # one row a language
    if not counts:
        return Filters({UNKNOWN: (np.zeros(0, np.uint64), np.zeros(0, np.int64))})
    # first by a threshold on the hash, so that no language's rows meet in one task, then exactly; copies are combined before they travel
    u = F.shiftrightunsigned("key", 11) / float(1 << 53)
    part = F.element_at(F.create_map(*[x for r in counts for x in (F.lit(r["label"]), F.lit(min(1.0, (1.4 * sample + 50) / max(1, r["n"]))))]), F.col("label"))
    near = known.withColumn("u", u).where(F.col("u") <= part).select("label", "u", "key", "id").distinct()
    chosen = near.withColumn("i", F.row_number().over(Window.partitionBy("label").orderBy("u", "key", "id"))).where(F.col("i") <= sample)
    chosen = chosen.select("label", "key", "id")  # sample rows a language at most

    def run(batches):
        for batch in batches:
            data, offsets = texts(column(batch, "text"))
            labels = np.array(column(batch, "label").to_pylist())
            for i, j in slices(offsets):
                codes, owner = grams(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                for label in np.unique(labels[i:j]):
                    code, n = np.unique(codes[labels[i:j][owner] == label], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([label] * len(code), pa.string()), pa.array(code.astype(np.int64)), pa.array(n, pa.int64())], ["label", "code", "n"])

    once = known.join(F.broadcast(chosen), ["label", "key", "id"]).groupBy("label", "key", "id").agg(F.first("text").alias("text"))
    found = once.select("text", "label").mapInArrow(run, "label string, code long, n long")
    found = found.groupBy("label", "code").agg(F.sum("n").alias("n"))
    totals = found.groupBy("label").agg(F.sum("n").alias("total"))  # one row a language
    rows = found.join(F.broadcast(totals), "label").where(F.col("n") >= FLOOR * F.col("total")).select("label", "code", "n").toPandas()
    return Filters({r["label"]: (own["code"].to_numpy().astype(np.uint64), own["n"].to_numpy()) for r in counts for own in [rows[rows["label"] == r["label"]].sort_values("code")]})


def identify(docs: DataFrame, filters: Filters) -> DataFrame:
    """doc_id, lang_pred, score of every document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters"))
    spark = docs.sparkSession
    tune(spark)
    shared = spark.sparkContext.broadcast(filters)

    def run(batches):
        own = shared.value
        for batch in batches:
            data, offsets = texts(column(batch, "text"))
            letters = column(batch, "letters").to_numpy(zero_copy_only=False)
            for i, j in slices(offsets):
                language, score = own.decide(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                has = letters[i:j]
                language = [x if y else UNKNOWN for x, y in zip(language, has, strict=True)]
                yield pa.RecordBatch.from_arrays([column(batch, "doc_id")[i:j], pa.array(language), pa.array(np.where(has, score, 0.0))], ["doc_id", "lang_pred", "score"])

    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")


def kept(docs: DataFrame, filters: Filters, least: float) -> DataFrame:
    """The documents with a letter of whose n-grams some language contains the ``least`` share, or that are too short to judge, with all their columns."""
    spark, schema = docs.sparkSession, docs.schema
    tune(spark)
    shared = spark.sparkContext.broadcast(filters)
    (letters,) = fresh(docs, "letters")

    def run(batches):
        own = shared.value
        for batch in batches:
            data, offsets = texts(column(batch, "text"))
            has = column(batch, letters).to_numpy(zero_copy_only=False)
            rest = batch.drop_columns([letters])
            for i, j in slices(offsets):
                good = own.plausible(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], least)
                yield rest.slice(i, j - i).filter(pa.array(has[i:j] & good))

    return docs.withColumn(letters, F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))).mapInArrow(run, schema)
