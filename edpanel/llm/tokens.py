"""Byte-level BPE ids of whole texts with the ``tokenizers`` library.

The UTF-8 bytes of a batch are cut into pre-tokens by the byte-level split rule with array
operations; each distinct pre-token is known by a 64-bit hash and goes through the library's
BPE model once per worker, and ids are gathered from a pool. Texts with characters whose class
is not plain from the bytes (all but ASCII without the separators 1C-1F, and Latin letters
C0-24F) go to the library whole, as do pre-tokens of over ``WORD_BYTES`` bytes and texts that
hold the string of an added token, which the library turns into that token's id.
"""

from __future__ import annotations

import hashlib
import os

import numpy as np
import pyarrow as pa

VOCABULARY = "byte_bpe_50k.json"
END_ID = 0
CACHE_WORDS = 800_000
CACHE_IDS = 5_000_000
WORD_BYTES = 64
PIECE_BYTES = 1 << 20

_LETTER, _DIGIT, _OTHER, _SPACE = 0, 1, 2, 3
_CLASS = np.full(256, _LETTER, np.uint8)
_CLASS[:128] = [_SPACE if 9 <= b <= 13 or b == 32 else _DIGIT if 48 <= b <= 57 else _LETTER if chr(b).isalpha() else _OTHER
                for b in range(128)]
_UNPLAIN = np.zeros(256, bool)
_UNPLAIN[0x1C:0x20] = _UNPLAIN[0xC2] = _UNPLAIN[0xCA:] = True
_BASE = 0x9E3779B97F4A7C15 | 1


def _mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64."""
    out = np.ones(1, np.uint64)
    while len(out) < n:
        out = np.concatenate([out, out * np.uint64(pow(base, len(out), 1 << 64))])
    return out[:n]


class SpanHash:
    """64-bit hashes of byte spans of one array, by prefix sums of a polynomial; another ``base``
    gives independent ones. Spans of over ``DIGEST_BYTES`` bytes get a cryptographic digest, as a
    polynomial modulo 2 ** 64 collides on structured spans from 1,024 bytes on."""

    DIGEST_BYTES = 128

    def __init__(self, base: int = _BASE):
        self.base = base
        self.table = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(base))
        self.power, self.inverse = _powers(base, 1 << 16), _powers(pow(base, -1, 1 << 64), 1 << 16)

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        while len(self.power) <= len(data):
            n = 2 * len(self.power)
            self.power, self.inverse = _powers(self.base, n), _powers(pow(self.base, -1, 1 << 64), n)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.table[data] * self.power[:len(data)], out=sums[1:])
        out = _mix((sums[ends] - sums[starts]) * self.inverse[starts] + (ends - starts).astype(np.uint64))
        salt = self.base.to_bytes(8, "little")
        for k in np.flatnonzero(ends - starts > self.DIGEST_BYTES).tolist():
            digest = hashlib.blake2b(data[starts[k]:ends[k]].tobytes(), digest_size=8, salt=salt).digest()
            out[k] = np.uint64(int.from_bytes(digest, "little"))
        return out


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string array in one row and the n + 1 bounds of its texts."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64, len(texts) + 1, 8 * texts.offset)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[bounds[0]:bounds[-1]], bounds - bounds[0]


def word_starts(data: np.ndarray, bounds: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Start positions of the pre-tokens of texts ``bounds``; a text marked ``whole`` is one."""
    n = len(data)
    kind = _CLASS[data]
    start = np.ones(n, bool)
    np.not_equal(kind[1:], kind[:-1], out=start[1:])
    first = bounds[:-1][np.diff(bounds) > 0]
    start[first] = True
    inner = np.zeros(n, bool)
    inner[first] = True  # a text's first byte has nothing before it
    after = np.flatnonzero(start & (kind != _SPACE) & ~inner)
    after = after[kind[after - 1] == _SPACE]  # words that follow white space in their text
    start[after - 1] = True
    start[after[data[after - 1] == 32]] = False
    quote = np.flatnonzero(start & (data == 39))  # contractions
    if len(quote):
        stop = bounds[np.searchsorted(bounds, quote, side="right")]
        after = np.concatenate([data, np.zeros(3, np.uint8)])
        a, b = after[quote + 1], after[quote + 2]
        one = np.isin(a, np.frombuffer(b"stmd", np.uint8)) & (quote + 2 <= stop)
        two = ((b == ord("e")) & ((a == ord("r")) | (a == ord("v"))) | (a == ord("l")) & (b == ord("l"))) & (quote + 3 <= stop)
        for hit, size in ((one, 2), (two & ~one, 3)):
            at, end = quote[hit], stop[hit]
            start[at + 1] = False
            start[(at + size)[at + size < end]] = True
    for k in np.flatnonzero(whole).tolist():
        start[bounds[k] + 1:bounds[k + 1]] = False
    return np.flatnonzero(start)


class Encoder:
    """Encodes arrays of texts; keeps the ids of pre-tokens it has met, within a bound."""

    def __init__(self, path: str | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        if path is None:
            import public_tokenizers
            path = public_tokenizers.path(VOCABULARY)
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        self.hash = SpanHash()
        plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        rest = iter(range(256, 512))  # the byte-level alphabet: the other bytes are shown from 256 on
        self.shown = {b: chr(b) if b in plain else chr(next(rest)) for b in range(256)}
        self._clear()

    def _clear(self) -> None:
        self.mask = (1 << 16) - 1
        self.keys, self.slots = np.zeros(1 << 16, np.uint64), np.zeros(1 << 16, np.int64)
        self.words = self.used = self.cached = 0
        self.pool = np.empty(1 << 16, np.uint32)
        self.offset, self.length = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def _append(self, found: list[list[int]]) -> np.ndarray:
        """Puts id lists into the pool; their numbers."""
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        total, first = int(lengths.sum()), self.words
        self.words += len(found)
        while self.words > len(self.offset):
            self.offset, self.length = (np.concatenate([a, np.zeros_like(a)]) for a in (self.offset, self.length))
        while self.used + total > len(self.pool):
            self.pool = np.concatenate([self.pool, np.empty_like(self.pool)])
        self.length[first:self.words] = lengths
        self.offset[first:self.words] = self.used + np.cumsum(lengths) - lengths
        self.pool[self.used:self.used + total] = np.fromiter((i for ids in found for i in ids), np.uint32, total)
        self.used += total
        return np.arange(first, self.words)

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """Numbers of pre-tokens by hash, -1 for unknown ones (linear probing)."""
        out, todo, at = np.full(len(keys), -1, np.int64), np.arange(len(keys)), (keys & np.uint64(self.mask)).astype(np.int64)
        while len(todo):
            held = self.keys[at]
            hit = held == keys[todo]
            out[todo[hit]] = self.slots[at[hit]]
            more = ~hit & (held != 0)
            todo, at = todo[more], (at[more] + 1) & self.mask
        return out

    def _store(self, keys: np.ndarray, numbers: np.ndarray) -> None:
        if 2 * (self.cached + len(keys)) > self.mask:
            old, slots = self.keys[self.keys != 0], self.slots[self.keys != 0]
            while 2 * (self.cached + len(keys)) > self.mask:
                self.mask = 2 * self.mask + 1
            self.keys, self.slots = np.zeros(self.mask + 1, np.uint64), np.zeros(self.mask + 1, np.int64)
            self.cached = 0
            self._store(old, slots)
        self.cached += len(keys)
        at = (keys & np.uint64(self.mask)).astype(np.int64)
        while len(keys):
            free = self.keys[at] == 0
            self.keys[at[free]], self.slots[at[free]] = keys[free], numbers[free]
            lost = self.keys[at] != keys  # the slot was taken, or another new key won it
            keys, numbers, at = keys[lost], numbers[lost], (at[lost] + 1) & self.mask

    def encode(self, texts: pa.Array | list, end_id: int | None = END_ID) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in a row (uint32) and each text's count; ``end_id`` is put
        after every text, and a null text counts as empty."""
        data, bounds = text_bytes(texts if isinstance(texts, (pa.Array, pa.ChunkedArray)) else pa.array(texts, pa.string()))
        parts, sizes, at = [], [], 0
        while at < len(bounds) - 1:  # pieces of about PIECE_BYTES, whole texts
            to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + PIECE_BYTES, side="right")) - 1)
            ids, n = self._piece(data[bounds[at]:bounds[to]], bounds[at:to + 1] - bounds[at])
            parts.append(ids)
            sizes.append(n)
            at = to
        ids = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
        sizes = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
        if end_id is None:
            return ids, sizes
        out, keep = np.full(len(ids) + len(sizes), end_id, np.uint32), np.ones(len(ids) + len(sizes), bool)
        keep[np.cumsum(sizes + 1) - 1] = False
        out[keep] = ids
        return out, sizes + 1

    def _piece(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if self.words > CACHE_WORDS or self.used > CACHE_IDS:
            self._clear()
        whole = np.zeros(len(bounds) - 1, bool)
        following = np.concatenate([data[1:], [0]]) if len(data) else data
        odd = np.flatnonzero(_UNPLAIN[data] | (data == 0xC3) & ((following == 0x97) | (following == 0xB7)) | (data == 0xC9) & (following >= 0x90))
        whole[np.searchsorted(bounds, odd, side="right") - 1] = True
        raw = data.tobytes()
        for token in self.added:
            at = raw.find(token)
            while at >= 0:  # on to the next text
                k = int(np.searchsorted(bounds, at, side="right")) - 1
                whole[k] = True
                at = raw.find(token, int(bounds[k + 1]))
        starts = word_starts(data, bounds, whole) if len(data) else np.zeros(0, np.int64)
        ends = np.append(starts[1:], len(data)) if len(starts) else starts
        text_of = np.searchsorted(bounds, starts, side="right") - 1
        number = np.full(len(starts), -1, np.int64)
        direct = whole[text_of] | (ends - starts > WORD_BYTES)
        at = np.flatnonzero(direct)
        if len(at):
            spans = [raw[s:e].decode() for s, e in zip(starts[at].tolist(), ends[at].tolist())]
            number[at] = self._append([x.ids for x in self.tokenizer.encode_batch_fast(spans, add_special_tokens=False)])
        rest = np.flatnonzero(~direct)
        keys = self.hash(data, starts[rest], ends[rest])
        keys[keys == 0] = 1
        found = self._find(keys)
        new = np.flatnonzero(found < 0)
        if len(new):
            fresh, first, back = np.unique(keys[new], return_index=True, return_inverse=True)
            tokenize, shown = self.tokenizer.model.tokenize, self.shown
            lists = [[t.id for t in tokenize(raw[s:e].decode("latin-1").translate(shown))]
                     for s, e in zip(starts[rest[new[first]]].tolist(), ends[rest[new[first]]].tolist())]
            numbers = self._append(lists)
            self._store(fresh, numbers)
            found[new] = numbers[back]
        number[rest] = found
        lengths = self.length[number]
        last = np.cumsum(lengths)
        total = int(last[-1]) if len(last) else 0
        ids = self.pool[np.repeat(self.offset[number] - (last - lengths), lengths) + np.arange(total)]
        edge = np.concatenate([[0], last])
        word_bound = np.searchsorted(starts, bounds)
        return ids, np.diff(edge[word_bound])


_ENCODERS: dict[str | None, Encoder] = {}


def encoder(path: str | None = None) -> Encoder:
    """One encoder per worker process; it serves all tasks that the worker runs."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
