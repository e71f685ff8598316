"""Pre-tokenisation: the pieces that public_tokenizers.PATTERN matches, found with array operations.

The pattern takes, in order: an English contraction, letters, digits or other signs with
one space before them, and white space up to (not including) the last before a word. All
of that follows from the class of each code point and its neighbours, so a whole slice of
documents is cut at once; the letter, digit and space classes are asked of the library
whose results are to be met.
"""

from __future__ import annotations

import functools

import numpy as np

from curata.llm.buffers import span_hashes

OTHER, LETTER, DIGIT, SPACE = 0, 1, 2, 3
_QUOTE, _BLANK = 0x27, 0x20
LEARN = 100_000  # pieces learnt at once, so that a text of many distinct ones needs no list of all


@functools.cache
def classes() -> np.ndarray:
    """The class of every code point, from the tokenizer library's own Unicode tables."""
    import tiktoken

    everything = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    table = np.zeros(0x110000, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}"), (DIGIT, r"\p{N}"), (SPACE, r"\s")):
        matched = tiktoken.Encoding("bytes", pat_str=pattern, mergeable_ranks={bytes([i]): i for i in range(256)}, special_tokens={}).encode_ordinary(everything)
        table[np.frombuffer(bytes(matched).decode().encode("utf-32-le"), np.uint32)] = kind
    return table


def cut(data: np.ndarray, offsets: np.ndarray, special: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
    """(byte starts of all pieces, number of pieces of each text) of texts that lie one after another.

    special: a string that is a piece of its own wherever it stands; what stands before
    and after it is cut as texts of their own. Empty texts have no piece.
    """
    n_texts, raw = len(offsets) - 1, data.tobytes()
    if not raw:
        return np.zeros(0, np.int64), np.zeros(n_texts, np.int64)
    code = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), np.uint32)
    n = len(code)
    at = np.arange(n) if n == len(data) else np.flatnonzero((data & 0xC0) != 0x80)
    first = np.zeros(n + 1, bool)  # a text begins here
    begins = offsets[:-1][np.diff(offsets) > 0]
    first[begins if n == len(data) else np.searchsorted(at, begins)] = True
    first[n] = True
    inside = []
    if special:
        start = raw.find(special)
        while start >= 0:  # its bytes are ASCII; a match cannot cross texts unless a start lies inside
            a = int(np.searchsorted(at, start))
            if not first[a + 1 : a + len(special)].any():
                inside.append(a)
                first[[a, a + len(special)]] = True
            start = raw.find(special, start + len(special) if inside and inside[-1] == a else start + 1)
    kind = classes()[code]
    mark = first[:n].copy()
    mark[1:] |= kind[1:] != kind[:-1]
    space = kind == SPACE
    last = np.flatnonzero(space[:-1] & ~space[1:] & ~first[1:n])  # the last space before a word
    mark[last] = True
    mark[last + 1] = code[last] != _BLANK
    quote = np.flatnonzero((code == _QUOTE) & mark)
    if len(quote):
        padded, ends = np.concatenate([code, np.zeros(3, np.uint32)]), np.concatenate([first, np.ones(3, bool)])
        one, two = padded[quote + 1], padded[quote + 2]
        short = np.isin(one, [ord(c) for c in "stmd"]) & ~ends[quote + 1]
        long = (((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))) & ~ends[quote + 1] & ~ends[quote + 2]
        for hit, length in ((quote[short], 2), (quote[long], 3)):
            mark[hit + 1] = False
            after = hit + length
            mark[after[after < n]] = True
    for a in inside:
        mark[a + 1 : a + len(special)] = False
        mark[a] = True
    starts = at[mark]
    return starts, np.diff(np.searchsorted(starts, offsets))


def names(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit numbers that name each span: exact up to 8 bytes (hash and size), else two independent hashes."""
    size = ends - starts
    check, long = size.astype(np.uint64), np.flatnonzero(size > 8)
    check[long] = span_hashes(data, starts[long], ends[long], seed=1) | np.uint64(16)
    return span_hashes(data, starts, ends), check


class PieceTable:
    """What is known of pieces by their names: a list of numbers each. Open addressing, at most half full: it grows by load."""

    def __init__(self, bits: int = 16, most: int = 1_000_000):
        self.bits, self.most = bits, most
        self.clear()

    def clear(self) -> None:
        self._empty(self.bits)
        self.n, self.used = 0, 0
        self.first, self.count = np.zeros(1024, np.int64), np.zeros(1024, np.int32)
        self.flat = np.zeros(4096, np.int32)

    def _empty(self, bits: int) -> None:
        size = 1 << bits
        self.mask = np.uint64(size - 1)
        self.keys, self.checks, self.index = np.zeros(size, np.uint64), np.zeros(size, np.uint64), np.full(size, -1, np.int32)

    def find(self, hashes: np.ndarray, checks: np.ndarray) -> np.ndarray:
        """The index of each name, or -1."""
        out = np.full(len(hashes), -1, np.int32)
        open_, slot = np.arange(len(hashes)), hashes & self.mask
        while len(open_):
            index = self.index[slot]
            hit = (index >= 0) & (self.keys[slot] == hashes[open_]) & (self.checks[slot] == checks[open_])
            out[open_[hit]] = index[hit]
            go = (index >= 0) & ~hit
            open_, slot = open_[go], (slot[go] + np.uint64(1)) & self.mask
        return out

    def add(self, hashes: np.ndarray, checks: np.ndarray, counts: np.ndarray, flat: np.ndarray) -> None:
        """New distinct names with their numbers, all one after another in flat."""
        k, m = len(hashes), len(flat)
        while self.n + k > len(self.first):
            self.first, self.count = (np.concatenate([x, np.zeros_like(x)]) for x in (self.first, self.count))
        while self.used + m > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.count[self.n : self.n + k] = counts
        self.first[self.n : self.n + k] = self.used + np.cumsum(counts) - counts
        self.flat[self.used : self.used + m] = flat
        if 2 * (self.n + k) > len(self.index):
            there = np.flatnonzero(self.index >= 0)
            keys, own, index = self.keys[there], self.checks[there], self.index[there]
            self._empty(int(2 * (self.n + k)).bit_length() + 1)
            self._place(keys, own, index)
        self._place(hashes, checks, np.arange(self.n, self.n + k, dtype=np.int32))
        self.n, self.used = self.n + k, self.used + m

    def _place(self, hashes: np.ndarray, checks: np.ndarray, index: np.ndarray) -> None:
        open_, slot = np.arange(len(hashes)), hashes & self.mask
        while len(open_):
            free = self.index[slot] < 0
            self.index[slot[free]] = index[open_[free]]  # of several for one slot the last stays
            mine = self.index[slot] == index[open_]
            self.keys[slot[mine]], self.checks[slot[mine]] = hashes[open_[mine]], checks[open_[mine]]
            open_, slot = open_[~mine], (slot[~mine] + np.uint64(1)) & self.mask


class Encoder:
    """Numbers of every text: pieces are cut, looked up, and only unknown ones given to ``learn``.

    learn(list of bytes) -> (counts, flat numbers). The table is per worker and begins anew once it holds more than ``most``.
    spans(data, offsets) -> (starts, ends, pieces of each text): another way to cut, which knows no special string.
    """

    def __init__(self, learn, special: bytes = b"", special_ids=(), most: int = 1_000_000, spans=None):
        self.learn, self.special, self.special_ids, self.spans = learn, special, special_ids, spans
        self.table = PieceTable(most=most)

    def _preset(self) -> None:
        if self.special and not self.table.n:
            data = np.frombuffer(self.special, np.uint8)
            self.table.add(*names(data, np.array([0]), np.array([len(data)])), np.array([len(self.special_ids)]), np.array(self.special_ids, np.int32))

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of each piece in the table, pieces of each text)."""
        if self.spans:
            starts, ends, per_text = self.spans(data, offsets)
        else:
            starts, per_text = cut(data, offsets, self.special)
            ends = np.append(starts[1:], len(data)) if len(starts) else starts
        hashes, checks = names(data, starts, ends)
        self._preset()
        if self.table.n > self.table.most:
            self.table.clear()
            self._preset()
        index = self.table.find(hashes, checks)
        unknown = np.flatnonzero(index < 0)
        if len(unknown):
            order = unknown[np.lexsort((checks[unknown], hashes[unknown]))]
            new = np.concatenate([[True], (hashes[order[1:]] != hashes[order[:-1]]) | (checks[order[1:]] != checks[order[:-1]])])
            raw = data.tobytes()
            for where in np.array_split(order[new], -(-int(new.sum()) // LEARN)):
                pieces = [raw[a:b] for a, b in zip(starts[where].tolist(), ends[where].tolist(), strict=True)]
                self.table.add(hashes[where], checks[where], *self.learn(pieces))
            index[unknown] = self.table.find(hashes[unknown], checks[unknown])
        return index, per_text
