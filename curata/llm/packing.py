"""Cost-balanced packing of token ids into training sequences.

1. Every whole text is encoded by the tokenizers library (each distinct word of a worker once)
   and ended by ``end_id``. A document is cut after every ``capacity`` ids.
2. Pieces are dealt into groups of about ``GROUP_BYTES`` of text by a hash of their row, so a
   hot source, a hot doc_id or one very long document spreads over all groups.
3. A group of T ids gets T // capacity full sequences, and for what is left one of each power of
   two in its binary form: sequences of such a length need no padding, so a group has none.
   Its pieces are taken in descending length. Each goes to the sequence of lowest cost so far
   that has room for all of it; cost is linear in a piece's length (projections) plus quadratic
   (attention within the document). A piece for which none has room is cut: what fills the
   sequence with the most room goes there, the rest is placed anew.

A group is a few megabytes of ids whatever the corpus; groups share nothing, so a lost executor
costs its groups only. Only ids of pieces that may still be cut travel, two bytes each where
the vocabulary allows; full pieces travel as lengths unless their ids are asked for.

Defined results: null and empty texts consist of the end id; rows with equal doc_id are
documents of their own; null doc_ids stay null; a table without rows gives none; further
columns are ignored. Needs columns doc_id, text.
"""

from __future__ import annotations

import functools
import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curata.llm.buffers import column, expand, slices, texts, tune
from curata.llm.pieces import Encoder

CAPACITY = 2048
LINEAR, QUADRATIC = 1.0, 1 / 4096  # at 4,096 tokens attention costs as much as all else
GROUP_BYTES = 8 << 20
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_PIECES = ["group", "row", "doc_id", "start", "length", "doc_tokens", "ids_crc32", "ids"]
_TYPES = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
_SCHEMA = "group int, row long, doc_id long, start long, length long, doc_tokens long, ids_crc32 long, ids binary"


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, words of each text): what stands between ASCII white space."""
    solid, begins = ~_BLANK[data], np.zeros(len(data) + 1, bool)
    begins[offsets[:-1]] = True
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets) - 1, np.int64)
    starts, ends = solid.copy(), solid.copy()
    starts[1:] &= ~solid[:-1] | begins[1:-1]
    ends[:-1] &= ~solid[1:] | begins[1:-1]
    starts = np.flatnonzero(starts)
    return starts, np.flatnonzero(ends) + 1, np.diff(np.searchsorted(starts, offsets))


@functools.cache
def library(path: str) -> tuple[Encoder, int]:
    """(ids of texts by the tokenizers library, number of ids), one for each worker process.

    Holds for vocabularies whose white space is only a boundary: dropped, and with no rule that reaches across it.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    for text in ("a b", " a\n\tb  c ", "x's 'y 12 3"):
        if tokenizer.encode(text, add_special_tokens=False).ids != [i for w in text.split() for i in tokenizer.encode(w, add_special_tokens=False).ids]:
            raise ValueError("a vocabulary that drops white space is needed")

    def learn(pieces):
        found = tokenizer.encode([x.decode("utf-8") for x in pieces], is_pretokenized=True, add_special_tokens=False)
        return np.bincount(np.array(found.word_ids, np.int64), minlength=len(pieces)), np.array(found.ids, np.int32)

    return Encoder(learn, spans=words), tokenizer.get_vocab_size()


def encoded(path: str, data: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts one after another, each ended by end_id; number of each text's)."""
    encoder, _ = library(path)
    index, per_text = encoder(data, offsets)
    count = encoder.table.count[index].astype(np.int64)
    ids = encoder.table.flat[expand(encoder.table.first[index], count)]
    bounds = np.concatenate([[0], np.cumsum(count)])[np.concatenate([[0], np.cumsum(per_text)])]
    return np.insert(ids, bounds[1:], end_id), np.diff(bounds) + 1


def capacities(total: int, capacity: int = CAPACITY) -> np.ndarray:
    """Full sequences, and one for each bit of what is left, that hold exactly total ids."""
    rest = total % capacity
    return np.array([capacity] * (total // capacity) + [1 << k for k in reversed(range(rest.bit_length())) if rest >> k & 1], np.int64)


def placed(lengths: np.ndarray, capacity: int = CAPACITY, linear: float = LINEAR, quadratic: float = QUADRATIC) -> tuple[np.ndarray, ...]:
    """(piece, begin within it, length, sequence, offset) of every part, and the cost of each sequence.

    lengths: of at most capacity, descending.
    """
    room = capacities(int(lengths.sum()), capacity)
    full, cost, out = room.copy(), np.zeros(len(room)), []
    for piece, length in enumerate(lengths.tolist()):
        begin = 0
        while begin < length:
            part = length - begin
            at = int(np.where(room >= part, cost, np.inf).argmin())
            if room[at] < part:
                at = int(room.argmax())
                part = int(room[at])
            out.append((piece, begin, part, at, full[at] - room[at]))
            room[at] -= part
            cost[at] += linear * part + quadratic * part * part
            begin += part
    parts = np.array(out, np.int64).reshape(-1, 5)
    return (*parts.T, cost)


def pack(docs: DataFrame, path: str, end_id: int = 1, capacity: int = CAPACITY, linear: float = LINEAR, quadratic: float = QUADRATIC, with_ids: bool = True) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, sequence_cost and (if asked for) ids array<int> of every piece."""
    spark = docs.sparkSession
    tune(spark)
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text")
    size = rows.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 1)).first()[0] or 0
    groups = max(1, -(-size // GROUP_BYTES))

    def pieces(batches):
        row, width = TaskContext.get().partitionId() << 36, "<u2" if library(path)[1] <= 1 << 16 and end_id < 1 << 16 else "<u4"
        for batch in batches:
            data, offsets = texts(column(batch, "text"))
            keys = column(batch, "doc_id").to_pylist()
            for i, j in slices(offsets):
                ids, counts = encoded(path, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], end_id)
                out: list[tuple] = []
                for key, own in zip(keys[i:j], np.split(ids, np.cumsum(counts)[:-1]), strict=True):
                    for start in range(0, len(own), capacity):
                        part = own[start : start + capacity]
                        whole = len(part) == capacity
                        group = (row * 0x9E3779B97F4A7C15 + start * 0xC2B2AE3D27D4EB4F) % (1 << 64) * groups >> 64
                        out.append((group, row, key, start, len(part), len(own), zlib.crc32(part.astype("<u4").tobytes()) if whole else None, None if whole and not with_ids else part.astype(width).tobytes()))
                    row += 1
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), _TYPES, strict=True)], _PIECES)

    def together(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("row", "ascending"), ("start", "ascending")])
        piece, begin, length, sequence, offset, cost = placed(table["length"].to_numpy(), capacity, linear, quadratic)
        own, crcs, width, lists = table["ids"].to_pylist(), table["ids_crc32"].to_pylist(), np.dtype("<u2"), []
        for k in range(len(own)):
            if own[k] is not None:
                width = np.dtype(f"<u{len(own[k]) // table['length'][k].as_py()}")
                break
        crc = []
        for p, b, n in zip(piece.tolist(), begin.tolist(), length.tolist(), strict=True):
            ids = None if own[p] is None else np.frombuffer(own[p], width, n, b * width.itemsize).astype("<u4")
            crc.append(crcs[p] if crcs[p] is not None and n == capacity else zlib.crc32(ids.tobytes()))
            lists.append(ids)
        of = table.take(pa.array(piece))
        columns = {"doc_id": of["doc_id"], "start": pa.array(of["start"].to_numpy() + begin), "length": pa.array(length), "ids_crc32": pa.array(crc, pa.int64()), "doc_tokens": of["doc_tokens"]}
        columns |= {"sequence_id": pa.array((table["group"][0].as_py() << 32) + sequence), "offset": pa.array(offset), "sequence_cost": pa.array(cost[sequence])}
        return pa.table(columns | ({"ids": pa.array([x.astype(np.int32) for x in lists], pa.list_(pa.int32()))} if with_ids else {}))

    found = rows.mapInArrow(pieces, _SCHEMA)
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_cost double" + ", ids array<int>" * with_ids
    return found.groupBy("group").applyInArrow(together, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, ids array<int>, ends array<int> (where each piece ends, for attention within documents) of every sequence of ``pack``."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "length", "ids")))  # of one sequence: at most capacity ids
    rows = packed.groupBy("sequence_id").agg(parts.alias("parts"))
    return rows.select("sequence_id", F.flatten("parts.ids").alias("ids"), F.transform("parts", lambda p: (p["offset"] + p["length"]).cast("int")).alias("ends"))
