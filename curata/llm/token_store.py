"""A content-addressed store of token ids.

Layout of a store, all Parquet, below one folder:

``objects/kind=chunk``  digest, payload: every distinct chunk of ids once, addressed by the
                        BLAKE2b-128 of its ids; payload is zstd over little-endian words
``objects/kind=ref``    digest, doc_id, row, seq, n: which chunk stands where in a document
``recipes``             position, doc_id, start, n_tokens, digests, root; ascending doc_id
``manifest``            level, node, hash: a Merkle tree of fan-out 256 over the roots

A rolling (gear) hash over ids cuts the stream of a document where its low bits are zero, so
a passage that two documents share gives shared chunks. Copies within a task send their
payload once; payloads alone are shuffled by digest, so a chunk that a third of all
documents hold brings one row a task, and references stay spread.

Defined results: null and empty texts consist of the end id; rows with the same doc_id are
documents of their own, next to one another; null doc_ids come last; further columns are
ignored. Reading back derives a document's CRC-32 from the CRC-32 of each stored chunk's
bytes (CRC-32 of a concatenation follows from those of its parts), so payloads aren't
shuffled a second time.
"""

from __future__ import annotations

import functools
import hashlib
import os
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curata.functions.storage import new_folder
from curata.llm.buffers import column, expand, mix, slices, texts, tune
from curata.llm.pieces import Encoder
from curata.operators.ordered import prefix

LEAST, MASK_BITS, MOST = 64, 8, 2048
WINDOW = 16
SEEN = 200_000
FAN_OUT = 256
FIELDS = "digest binary, payload binary, doc_id long, row long, seq int, n int"


def cuts(ids: np.ndarray) -> np.ndarray:
    """Ends of the chunks of one document: where the rolling hash of the last WINDOW ids has
    MASK_BITS zero bits, LEAST ids after the cut before at least, MOST ids at most."""
    n = len(ids)
    if n <= LEAST:
        return np.array([n])
    h, width = mix(ids.astype(np.uint64) + np.uint64(1)), 1
    while width < WINDOW:  # h[i] = sum of g(ids[i - j]) << j over j < width
        h[width:] = h[width:] + (h[:-width] << np.uint64(width))
        width *= 2
    places = np.flatnonzero((mix(h) & np.uint64((1 << MASK_BITS) - 1)) == 0) + 1
    ends, last = [], 0
    for place in [*places.tolist(), n]:
        while place - last > MOST:
            last += MOST
            ends.append(last)
        if place - last >= LEAST or place == n and place > last:
            ends.append(place)
            last = place
    return np.array(ends)


@functools.cache
def library(path: str) -> Encoder:
    """Ids by the tokenizers library; each distinct piece goes to it once for each worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    special = list(tokenizer.get_added_tokens_decoder().items())
    if len(special) > 1:
        raise ValueError("one special string at most")

    def learn(pieces):
        found = tokenizer.encode([x.decode("utf-8") for x in pieces], is_pretokenized=True, add_special_tokens=False)
        ids = np.array(found.ids, np.int32)
        return np.bincount(np.array(found.word_ids, np.int64), minlength=len(pieces)), ids

    return Encoder(learn, *([special[0][1].content.encode(), (special[0][0],)] if special else []))


def _encoded(path: str, data, offsets, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    encoder = library(path)
    index, per_text = encoder(data, offsets)
    count = encoder.table.count[index].astype(np.int64)
    ids = encoder.table.flat[expand(encoder.table.first[index], count)]
    bounds = np.concatenate([[0], np.cumsum(count)])[np.concatenate([[0], np.cumsum(per_text)])]
    return np.insert(ids, bounds[1:], end_id), np.diff(bounds) + 1


def _payload(ids: np.ndarray, words: str, press) -> bytes:
    flat = ids.astype(words)
    return press.compress(flat.view(np.uint8).reshape(-1, flat.itemsize).T.tobytes())  # byte planes


def _opened(payload: bytes, words: str, open_) -> np.ndarray:
    size = np.dtype(words).itemsize
    return np.ascontiguousarray(np.frombuffer(open_.decompress(payload), np.uint8).reshape(size, -1).T).view(words).ravel()


def _address(ids: np.ndarray) -> bytes:
    return hashlib.blake2b(ids.astype("<u4").tobytes(), digest_size=16).digest()


def write_store(docs: DataFrame, path: str, folder: str, end_id: int = 2, vocabulary: int = 1 << 16) -> None:
    """Encodes every whole text, appends end_id, and writes a store into folder."""
    spark, words = docs.sparkSession, "<u2" if vocabulary <= 1 << 16 else "<u4"
    tune(spark)

    def chunked(batches):
        seen: set[bytes] = set()
        press, row = zstandard.ZstdCompressor(level=1), TaskContext.get().partitionId() << 36
        for batch in batches:
            data, offsets = texts(column(batch, "text"))
            keys = column(batch, "doc_id").to_pylist()
            for i, j in slices(offsets):
                ids, counts = _encoded(path, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], end_id)
                out: list[tuple] = []
                for key, own in zip(keys[i:j], np.split(ids, np.cumsum(counts)[:-1]), strict=True):
                    begin = 0
                    for seq, end in enumerate(cuts(own).tolist()):
                        part, begin = own[begin:end], end
                        digest = _address(part)
                        payload = None
                        if digest not in seen:
                            if len(seen) < SEEN:
                                seen.add(digest)
                            payload = _payload(part, words, press)
                        route = int.from_bytes(digest[:8], "little", signed=True) if payload is not None else (row * 0x9E3779B1 + seq) & (2**63 - 1)
                        out.append((route, digest, payload, key, row, seq, len(part)))
                    row += 1
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int32()), strict=True)], ["route", "digest", "payload", "doc_id", "row", "seq", "n"])

    def once(batches):
        """Rows come sorted by the digest of their payload (null: none), so equal chunks are neighbours."""
        last = None
        for batch in batches:
            names = ["digest", "payload", "doc_id", "row", "seq", "n"]
            refs = [column(batch, x) for x in names]
            refs[1] = pa.nulls(len(batch), pa.binary())
            yield pa.RecordBatch.from_arrays([*refs, pa.array(["ref"] * len(batch))], [*names, "kind"])
            first = []
            for k, digest in enumerate(column(batch, "own").to_pylist()):
                if digest is not None and digest != last:
                    first.append(k)
                    last = digest
            own = batch.take(pa.array(first, pa.int64()))
            yield pa.RecordBatch.from_arrays([column(own, "digest"), column(own, "payload"), *(pa.nulls(len(own), t) for t in (pa.int64(), pa.int64(), pa.int32())), column(own, "n"), pa.array(["chunk"] * len(own), pa.string())], [*names, "kind"])

    fields = FIELDS
    rows = docs.select(docs["doc_id"].cast("long"), "text").mapInArrow(chunked, f"route long, {fields}").repartition("route")
    rows = rows.withColumn("own", F.when(F.col("payload").isNotNull(), F.col("digest"))).sortWithinPartitions("own").mapInArrow(once, f"{fields}, kind string")
    rows.write.partitionBy("kind").option("compression", "zstd").parquet(f"{folder}/objects")

    refs = _objects(spark, folder, "ref").drop("payload", "kind")
    part = F.array_sort(F.collect_list(F.struct("seq", "n", "digest")))
    recipes = refs.groupBy("doc_id", "row").agg(F.sum("n").alias("n_tokens"), part.alias("parts"))
    recipes = recipes.withColumn("digests", F.col("parts.digest")).withColumn("root", _root(F.col("digests"))).drop("parts")
    recipes.select("doc_id", "row", "n_tokens", "digests", "root").write.parquet(f"{folder}/unordered")
    recipes = prefix(spark.read.parquet(f"{folder}/unordered"), "doc_id", "n_tokens", ["row"])
    recipes.sortWithinPartitions("bucket", "position").select("position", "doc_id", "start", "n_tokens", "digests", "root").write.parquet(f"{folder}/recipes")
    _drop(spark, f"{folder}/unordered")
    tree(spark.read.parquet(f"{folder}/recipes").select("position", "root"), f"{folder}/manifest")


def _objects(spark: SparkSession, folder: str, kind: str) -> DataFrame:
    return spark.read.schema(f"{FIELDS}, kind string").parquet(f"{folder}/objects").where(F.col("kind") == kind)


def _root(digests):
    return F.sha2(F.array_join(F.transform(digests, lambda x: F.hex(x)), ""), 256)


def _drop(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def tree(leaves: DataFrame, folder: str) -> str:
    """Writes a Merkle tree over (position, root); the hash at its top (of no leaves: the empty string's)."""
    spark, level = leaves.sparkSession, 0
    nodes = leaves.select(F.col("position").alias("node"), F.col("root").alias("hash"))
    while True:
        nodes = nodes.groupBy(F.floor(F.col("node") / FAN_OUT).cast("long").alias("node")).agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("node", "hash"))), lambda x: x["hash"]), ""), 256).alias("hash"))
        nodes.write.parquet(f"{folder}/level={level}")
        nodes = spark.read.schema("node long, hash string").parquet(f"{folder}/level={level}")
        top = nodes.limit(2).collect()
        if len(top) < 2:
            return top[0]["hash"] if top else hashlib.sha256(b"").hexdigest()
        level += 1


def top_hash(spark: SparkSession, folder: str) -> str:
    levels = spark.read.parquet(f"{folder}/manifest")
    row = levels.agg(F.max_by("hash", "level").alias("h")).first()
    return row["h"] or hashlib.sha256(b"").hexdigest()


@functools.cache
def _shifts() -> list[np.ndarray]:
    """For each k, tables [4, 256]: what 2**k zero bytes make of a CRC-32, by each of its bytes."""
    column_of = np.array([1 << i for i in range(32)], np.uint32)

    def apply(matrix, values):
        out = np.zeros(len(values), np.uint32)
        for i in range(32):
            out ^= np.where((values >> np.uint32(i)) & 1, matrix[i], 0).astype(np.uint32)
        return out

    one_bit = np.array([0xEDB88320, *(1 << i for i in range(31))], np.uint32)  # the CRC-32 polynomial, reflected
    matrix = column_of
    for _ in range(8):
        matrix = apply(one_bit, matrix)
    tables, byte = [], np.arange(256, dtype=np.uint32)
    for _ in range(48):
        tables.append(np.stack([apply(matrix, byte << np.uint32(8 * k)) for k in range(4)]))
        matrix = apply(matrix, matrix)
    return tables


def joined_crc32(crcs: np.ndarray, sizes: np.ndarray, per: np.ndarray) -> np.ndarray:
    """CRC-32 of each concatenation, from those of its parts: crcs and byte sizes of all parts, per: parts of each (1 or more)."""
    total = np.cumsum(sizes)
    ends = np.cumsum(per)
    after = np.repeat(total[ends - 1], per) - total
    crcs = crcs.astype(np.uint32)
    for k, table in enumerate(_shifts()):
        on = np.flatnonzero((after >> k) & 1)
        if len(on):
            c = crcs[on]
            crcs[on] = table[0][c & 255] ^ table[1][(c >> 8) & 255] ^ table[2][(c >> 16) & 255] ^ table[3][c >> 24]
    return np.bitwise_xor.reduceat(crcs, ends - per) if len(per) else crcs


def read_digests(spark: SparkSession, folder: str, vocabulary: int = 1 << 16) -> DataFrame:
    """position, doc_id, start, n_tokens, ids_crc32 from the files; fails if a chunk is missing or damaged,
    or the documents don't give the manifest's top hash."""
    words = "<u2" if vocabulary <= 1 << 16 else "<u4"

    def opened(batches):
        open_ = zstandard.ZstdDecompressor()
        for batch in batches:
            ids = [_opened(x, words, open_) for x in column(batch, "payload").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([_address(x) for x in ids], pa.binary()), pa.array([len(x) for x in ids], pa.int32()), pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64())], ["digest", "n", "crc"])

    def whole(batches):
        for batch in batches:
            if not len(batch):
                continue
            lists = column(batch, "parts")
            flat, per = lists.flatten(), lists.value_lengths().to_numpy().astype(np.int64)
            crc = joined_crc32(flat.field("crc").to_numpy(), flat.field("n").to_numpy().astype(np.int64) * 4, per)
            yield pa.RecordBatch.from_arrays([*(column(batch, x) for x in ("position", "doc_id", "start", "n_tokens")), pa.array(crc.astype(np.int64)), column(batch, "root")], ["position", "doc_id", "start", "n_tokens", "ids_crc32", "root"])

    chunks = _objects(spark, folder, "chunk").select("payload").mapInArrow(opened, "digest binary, n int, crc long")
    recipes = spark.read.parquet(f"{folder}/recipes")
    places = recipes.select("position", F.posexplode("digests").alias("seq", "digest"))
    parts = places.join(chunks, "digest").groupBy("position").agg(F.array_sort(F.collect_list(F.struct("seq", "n", "crc", "digest"))).alias("parts"))
    rows = recipes.select("position", "doc_id", "start", "n_tokens", F.size("digests").alias("k")).join(parts, "position", "left")
    sound = (F.size("parts") == F.col("k")) & (F.aggregate("parts", F.lit(0).cast("long"), lambda a, x: a + x["n"]) == F.col("n_tokens"))
    rows = rows.withColumn("parts", F.when(sound, F.col("parts")).otherwise(F.raise_error(F.concat(F.lit("chunks missing of document "), F.col("doc_id").cast("string"))))).withColumn("root", _root(F.col("parts.digest")))
    found = rows.select("position", "doc_id", "start", "n_tokens", "parts", "root").mapInArrow(whole, "position long, doc_id long, start long, n_tokens long, ids_crc32 long, root string")
    found.write.parquet(f"{folder}/read")
    found = spark.read.schema(found.schema).parquet(f"{folder}/read")
    if (top := tree(found.select("position", "root"), f"{folder}/again")) != (kept := top_hash(spark, folder)):
        raise ValueError(f"the documents read give {top}, the manifest has {kept}")
    return found.drop("root")


def read_ids(spark: SparkSession, folder: str, vocabulary: int = 1 << 16) -> DataFrame:
    """position, doc_id, ids array<int>: the documents themselves."""
    words = "<u2" if vocabulary <= 1 << 16 else "<u4"

    def whole(batches):
        open_ = zstandard.ZstdDecompressor()
        for batch in batches:
            ids = [np.concatenate([_opened(x["payload"], words, open_) for x in parts]).astype(np.int32) for parts in column(batch, "parts").to_pylist()]
            yield pa.RecordBatch.from_arrays([column(batch, "position"), column(batch, "doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["position", "doc_id", "ids"])

    chunks = _objects(spark, folder, "chunk").select("digest", "payload")
    places = spark.read.parquet(f"{folder}/recipes").select("position", "doc_id", F.posexplode("digests").alias("seq", "digest"))
    parts = places.join(chunks, "digest").groupBy("position", "doc_id").agg(F.array_sort(F.collect_list(F.struct("seq", "payload"))).alias("parts"))
    return parts.mapInArrow(whole, "position long, doc_id long, ids array<int>")


def stored(docs: DataFrame, path: str, end_id: int = 2) -> DataFrame:
    """Writes a store in the shared folder and reads it back: doc_id, start, n_tokens, ids_crc32."""
    spark = docs.sparkSession
    folder = new_folder(spark, "token-store")
    write_store(docs, path, folder, end_id)
    return read_digests(spark, folder).select("doc_id", "start", "n_tokens", "ids_crc32")
