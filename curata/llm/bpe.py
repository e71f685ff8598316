"""Byte-level BPE encoding and decoding over length-bucketed, padded matrices.

Distinct unknown pieces of a slice are laid into one matrix per length bucket, a row a
piece and a column a symbol. In each round every row finds its leftmost pair of least rank
(ranks of pairs stand in a hashed table), merges it and closes the gap; finished rows leave
the matrix. Pieces above ``LONG`` symbols are merged on their own by the same order, all
the places of the least pair at once where that provably gives the same result.

Defined results: null and empty texts have no ids (and decode to no bytes); repeated rows
are encoded alike; further columns of the input are ignored. Needs columns doc_id, text.
"""

from __future__ import annotations

import base64
import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from curata.llm.buffers import column, expand, slices, texts, tune
from curata.llm.pieces import Encoder

NONE = np.int32(2**31 - 1)
LONG = 256


class Ranks:
    """A rank file: token bytes with their ranks, which are the ids too."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.ids = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        tokens = [b""] * (max(self.ids.values()) + 1)
        for token, rank in self.ids.items():
            tokens[rank] = token
        self.lengths = np.array([len(x) for x in tokens], np.int64)
        self.begins = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.single = np.array([self.ids[bytes([i])] for i in range(256)], np.int32)
        pairs = [(self.ids[t[:k]], self.ids[t[k:]], r) for t, r in self.ids.items() for k in range(1, len(t)) if t[:k] in self.ids and t[k:] in self.ids]
        left, right, rank = (np.array(x, np.int64) for x in zip(*pairs, strict=True))
        self._fill(self._key(left, right), rank.astype(np.int32))

    @staticmethod
    def _key(left, right):
        return (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)

    def _slot(self, key):
        return (key * np.uint64(0x9E3779B97F4A7C15)) >> self.shift

    def _fill(self, key, rank) -> None:
        bits = int(len(key) * 2).bit_length() + 1
        self.shift, self.size = np.uint64(64 - bits), 1 << bits
        self.keys, self.rank = np.full(self.size, 2**64 - 1, np.uint64), np.full(self.size, NONE, np.int32)
        open_, slot, empty = np.arange(len(key)), self._slot(key), np.uint64(2**64 - 1)
        while len(open_):
            free = self.keys[slot] == empty
            self.keys[slot[free]] = key[open_[free]]
            done = self.keys[slot] == key[open_]
            self.rank[slot[done]] = rank[open_[done]]
            open_, slot = open_[~done], (slot[~done] + np.uint64(1)) & np.uint64(self.size - 1)

    def pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, NONE where it is no token; a side below 0 is no symbol."""
        key = self._key(np.maximum(left, 0), np.maximum(right, 0)).ravel()
        out, real = np.full(len(key), NONE, np.int32), ((left >= 0) & (right >= 0)).ravel()
        open_, empty = np.flatnonzero(real), np.uint64(2**64 - 1)
        slot = self._slot(key[open_])
        while len(open_):
            found = self.keys[slot]
            hit = found == key[open_]
            out[open_[hit]] = self.rank[slot[hit]]
            go = ~hit & (found != empty)
            open_, slot = open_[go], (slot[go] + np.uint64(1)) & np.uint64(self.size - 1)
        return out.reshape(left.shape)

    def merge_rows(self, rows: np.ndarray) -> list[np.ndarray]:
        """rows: symbols, padded with -1. The symbols that remain of each."""
        left, ranks = np.arange(len(rows)), self.pair(rows[:, :-1], rows[:, 1:])
        result: list = [None] * len(rows)
        while len(left):
            at = ranks.argmin(axis=1)
            here = np.arange(len(left))
            best = ranks[here, at]
            done = best == NONE
            for i in np.flatnonzero(done):
                result[left[i]] = rows[i][rows[i] >= 0]
            if done.any():
                keep = ~done
                left, rows, ranks, at, best = left[keep], rows[keep], ranks[keep], at[keep], best[keep]
                if not len(left):
                    break
                here = np.arange(len(left))
            columns = np.arange(rows.shape[1] - 1)
            rows[here, at] = best
            rows = np.take_along_axis(rows, columns + (columns > at[:, None]), axis=1)  # closes the gap behind the merge
            columns = columns[:-1]
            ranks = np.take_along_axis(ranks, columns + (columns > at[:, None]), axis=1) if ranks.shape[1] > 1 else ranks[:, :0]
            if not ranks.shape[1]:
                ranks = np.full((len(left), 1), NONE, np.int32)
                rows = np.concatenate([rows, np.full((len(left), 1), -1, np.int32)], axis=1)
                continue
            before = at > 0
            ranks[here[before], at[before] - 1] = self.pair(rows[here[before], at[before] - 1], rows[here[before], at[before]])
            inside = at < ranks.shape[1]
            ranks[here[inside], at[inside]] = self.pair(rows[here[inside], at[inside]], rows[here[inside], at[inside] + 1])
        return result

    def merge_long(self, row: np.ndarray) -> np.ndarray:
        """One long piece. All places of the least pair merge in one round, unless a pair of lower rank comes up on the way.

        From left to right, each merge makes a pair with the symbol before it (which has its final form by then)
        and with the one behind it (which has not): both must rank above the pair that is being merged.
        """
        while len(row) > 1:
            ranks = self.pair(row[:-1], row[1:])
            best = ranks.min()
            if best == NONE:
                break
            at = np.flatnonzero(ranks == best)
            if len(at) > 1:  # of places that overlap, every other one from the left
                run = np.concatenate([[True], np.diff(at) > 1])
                at = at[(np.arange(len(at)) - np.flatnonzero(run)[np.cumsum(run) - 1]) % 2 == 0]
            merged = self._merged(row, at, best)
            if len(at) > 1:
                where, behind = at - np.arange(len(at)), at[at + 2 < len(row)] + 2
                near = where[where > 0] - 1
                lower = (self.pair(merged[near], merged[near + 1]) <= best).any() or (self.pair(np.full(len(behind), best, row.dtype), row[behind]) <= best).any()
                if lower:
                    merged = self._merged(row, at[:1], best)
            row = merged
        return row

    @staticmethod
    def _merged(row, at, best):
        row = row.copy()
        row[at] = best
        return np.delete(row, at + 1)

    def learn(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct pieces, as the reference library merges them."""
        result: list = [None] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            if (known := self.ids.get(piece)) is not None:
                result[i] = np.array([known], np.int32)
            elif len(piece) > LONG:
                result[i] = self.merge_long(self.single[np.frombuffer(piece, np.uint8)])
            else:
                buckets.setdefault((len(piece) - 1).bit_length(), []).append(i)
        for bits, members in buckets.items():
            width, most = 1 << bits, max(1, (1 << 20) >> bits)
            for k in range(0, len(members), most):
                part = members[k : k + most]
                flat = np.frombuffer(b"".join(pieces[i] for i in part), np.uint8)
                size = np.array([len(pieces[i]) for i in part])
                rows = np.full((len(part), width), -1, np.int32)
                rows[np.arange(width) < size[:, None]] = self.single[flat]
                for i, ids in zip(part, self.merge_rows(rows), strict=True):
                    result[i] = ids
        return np.array([len(x) for x in result], np.int64), np.concatenate(result) if result else np.zeros(0, np.int32)

    def decode(self, ids: np.ndarray) -> bytes:
        return self.bytes[expand(self.begins[ids], self.lengths[ids])].tobytes()


@functools.cache
def codec(path: str) -> tuple[Ranks, Encoder]:
    """One for each worker process and rank file."""
    ranks = Ranks(path)
    return ranks, Encoder(ranks.learn)


def encoded(path: str, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts one after another, number of each text's)."""
    _, encoder = codec(path)
    index, per_text = encoder(data, offsets)
    table = encoder.table
    count = table.count[index].astype(np.int64)
    ids = table.flat[expand(table.first[index], count)]
    bounds = np.concatenate([[0], np.cumsum(count)])[np.concatenate([[0], np.cumsum(per_text)])]
    return ids, np.diff(bounds)


@functools.cache
def _decimals() -> tuple[np.ndarray, np.ndarray]:
    words = [f"{i} ".encode() for i in range(1 << 17)]
    size = np.array([len(x) for x in words], np.int64)
    return np.frombuffer(b"".join(words), np.uint8), np.cumsum(np.append(0, size))


def decimal_line(ids: np.ndarray) -> bytes:
    """Decimal ids joined by one space."""
    if not len(ids):
        return b""
    flat, begin = _decimals()
    if ids.max() >= len(begin) - 1:
        return " ".join(map(str, ids.tolist())).encode()
    return flat[expand(begin[ids], begin[ids + 1] - begin[ids])][:-1].tobytes()


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids array<int>: every text's ids."""
    tune(docs.sparkSession)

    def run(batches):
        for batch in batches:
            data, offsets = texts(column(batch, "text"))
            for i, j in slices(offsets):
                ids, counts = encoded(path, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)), pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([column(batch, "doc_id")[i:j], lists], ["doc_id", "ids"])

    return docs.select(docs["doc_id"].cast("long"), "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded_docs: DataFrame, path: str) -> DataFrame:
    """doc_id, decoded binary: the bytes that the ids stand for; a null list is empty."""
    tune(encoded_docs.sparkSession)

    def run(batches):
        ranks, _ = codec(path)
        for batch in batches:
            rows = [ranks.decode(np.array(x or [], np.int64)) for x in column(batch, "ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(rows, pa.binary())], ["doc_id", "decoded"])

    return encoded_docs.select("doc_id", "ids").mapInArrow(run, "doc_id long, decoded binary")


def round_trip_digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encodes, then decodes the ids, within one pass."""
    return _round_trip(docs, path, with_ids=False)


def encoded_and_decoded(docs: DataFrame, path: str) -> DataFrame:
    """As round_trip_digests, with the ids themselves: doc_id, n_tokens, ids array<int>, ids_sha256, decoded_sha256."""
    return _round_trip(docs, path, with_ids=True)


def _round_trip(docs: DataFrame, path: str, with_ids: bool) -> DataFrame:
    tune(docs.sparkSession)

    def run(batches):
        ranks, _ = codec(path)
        for batch in batches:
            data, offsets = texts(column(batch, "text"))
            for i, j in slices(offsets):
                ids, counts = encoded(path, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                parts = np.split(ids, np.cumsum(counts)[:-1])
                columns = {"doc_id": column(batch, "doc_id")[i:j], "n_tokens": pa.array(counts, pa.int64())}
                if with_ids:
                    columns["ids"] = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)), pa.int32()), pa.array(ids, pa.int32()))
                columns["ids_sha256"] = pa.array([hashlib.sha256(decimal_line(x)).hexdigest() for x in parts])
                columns["decoded_sha256"] = pa.array([hashlib.sha256(ranks.decode(x)).hexdigest() for x in parts])
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return docs.select(docs["doc_id"].cast("long"), "text").mapInArrow(run, f"doc_id long, n_tokens long,{' ids array<int>,' * with_ids} ids_sha256 string, decoded_sha256 string")
