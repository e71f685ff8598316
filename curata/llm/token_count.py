"""Token counts by heap-and-linked-list byte-pair merging; no identifiers are emitted.

For each distinct piece a heap holds its adjacent pairs by (rank, place). The pair of
lowest rank is popped, its right symbol leaves the linked list, and the two new pairs are
pushed; entries that no longer stand are skipped. The count is the number of initial
symbols less the number of merges.

Defined results: null and empty texts count 0 tokens and 0 bytes; special strings inside
texts count one each, as is the library's default; further columns are ignored.
"""

from __future__ import annotations

import functools
import heapq
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from curata.llm.buffers import column, slices, texts, tune
from curata.llm.pieces import Encoder


@functools.cache
def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary file: printable Latin-1 itself, others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(rest)}


class Merges:
    """The merge list of a byte-level .json vocabulary: (left, right) -> (rank, merged), by own symbol numbers."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_letters()
        to_bytes = lambda s: bytes(letters[c] for c in s)
        symbols = {bytes([i]): i for i in range(256)}
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = map(to_bytes, pair.split(" ") if isinstance(pair, str) else pair)
            merged = symbols.setdefault(left + right, len(symbols))
            self.pairs[symbols[left], symbols[right]] = (rank, merged)
        self.special = [x["content"].encode() for x in spec["added_tokens"]]

    def merges(self, piece: bytes) -> int:
        """How many merges the piece goes through."""
        pairs, n = self.pairs, len(piece)
        symbol, after, before = list(piece), list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(found[0], i, found[1], symbol[i], symbol[i + 1]) for i in range(n - 1) if (found := pairs.get((symbol[i], symbol[i + 1])))]
        heapq.heapify(heap)
        done = 0
        while heap:
            _, i, merged, left, right = heapq.heappop(heap)
            j = after[i]
            if symbol[i] != left or j >= n or symbol[j] != right:
                continue
            symbol[i], symbol[j] = merged, -1
            done += 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if found := pairs.get((merged, symbol[k])):
                    heapq.heappush(heap, (found[0], i, found[1], merged, symbol[k]))
            h = before[i]
            if h >= 0 and (found := pairs.get((symbol[h], merged))):
                heapq.heappush(heap, (found[0], h, found[1], symbol[h], merged))
        return done

    def learn(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """One number a piece: initial symbols less merges."""
        counts = np.fromiter((len(x) - self.merges(x) for x in pieces), np.int32, len(pieces))
        return np.ones(len(pieces), np.int64), counts


@functools.cache
def counter(path: str) -> Encoder:
    merges = Merges(path)
    if len(merges.special) > 1:
        raise ValueError("one special string at most")
    return Encoder(merges.learn, *([merges.special[0], (1,)] if merges.special else []))


def token_counts(docs: DataFrame, path: str, limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every document."""
    tune(docs.sparkSession)

    def run(batches):
        encoder = counter(path)
        for batch in batches:
            data, offsets = texts(column(batch, "text"))
            for i, j in slices(offsets):
                index, per_text = encoder(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                sums = np.concatenate([[0], np.cumsum(encoder.table.flat[index], dtype=np.int64)])
                tokens = np.diff(sums[np.concatenate([[0], np.cumsum(per_text)])])
                columns = [column(batch, "doc_id")[i:j], pa.array(np.diff(offsets[i : j + 1])), pa.array(tokens), pa.array(tokens > limit)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(docs["doc_id"].cast("long"), "text").mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
