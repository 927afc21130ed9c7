"""Words of texts and rolling hashes of word windows, on the UTF-8 bytes of an Arrow batch."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from edpanel.llm.tokens import SpanHash, _mix, _powers, text_bytes

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
ALPHANUMERIC = np.zeros(256, bool)  # 0-9, a-z and all from U+0080 on
ALPHANUMERIC[48:58] = ALPHANUMERIC[97:123] = ALPHANUMERIC[128:] = True
NOT_SPACE = np.ones(256, bool)  # all but ASCII white space
NOT_SPACE[9:14] = NOT_SPACE[32] = False
_STEP = 0xD6E8FEB86659FD93 | 1
_SECOND_STEP, SECOND_BASE = 0xA0761D6478BD642F | 1, 0xE7037ED1A0B428DB | 1


class Words:
    """The words (runs of ``inside_word`` bytes, A-Z lower-cased) of texts: byte spans, hashes, and the bounds of each text's words."""

    def __init__(self, texts: pa.Array, span_hash: SpanHash, inside_word: np.ndarray = ALPHANUMERIC):
        raw, bounds = text_bytes(texts)
        self.data, self.bounds = _LOWER[raw], bounds
        inside = inside_word[self.data]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        edge = bounds[1:-1]
        edge = edge[edge < len(raw)]
        first[edge] = inside[edge]  # a text's end parts words
        last = inside.copy()
        last[:-1] &= ~inside[1:] | first[1:]
        self.starts, self.ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.word_bounds = np.searchsorted(self.starts, bounds)
        self.rehash(span_hash, _STEP)

    def rehash(self, span_hash: SpanHash, step: int = _SECOND_STEP) -> None:
        """Hash the same words anew; window hashes follow."""
        self.hashes = span_hash(self.data, self.starts, self.ends)
        n = len(self.starts) + 1
        power = _powers(step, n)
        self.sums = np.zeros(n, np.uint64)
        np.cumsum(self.hashes * power[:-1], out=self.sums[1:])
        self.inverse = _powers(pow(step, -1, 1 << 64), n)

    def windows(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """First words of all windows of ``length`` words within one text, and their hashes."""
        n = len(self.starts) - length + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = np.arange(n)
        text_end = self.word_bounds[np.searchsorted(self.word_bounds, at, side="right")]
        at = at[at + length <= text_end]
        return at, _mix((self.sums[at + length] - self.sums[at]) * self.inverse[at] + np.uint64(length))

    def words(self, at: int, length: int) -> tuple[bytes, ...]:
        return tuple(self.data[s:e].tobytes() for s, e in zip(self.starts[at:at + length].tolist(), self.ends[at:at + length].tolist()))
