"""Terms of texts as byte spans: maximal runs of given bytes, A-Z lower-cased.

Used by the ranked search and the divergence audit. Bytes from 0x80 on always belong to
terms, so a multi-byte UTF-8 character is never cut.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from statlake.llm.common import span_hashes, utf8, word_spans


def byte_map(ascii_kept: bytes) -> np.ndarray:
    """What each byte becomes: itself if kept (A-Z lower-cased) or above ASCII, else a space."""
    out = np.full(256, 32, np.uint8)
    out[128:] = np.arange(128, 256)
    for c in ascii_kept:
        out[c] = c + 32 if 65 <= c <= 90 else c
    return out


_UPPER, _LOWER, _DIGITS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789"
LETTERS = byte_map(_UPPER + _LOWER)
LETTERS_DIGITS = byte_map(_UPPER + _LOWER + _DIGITS)


class Terms:
    """Terms of some texts: bytes ``raw``, spans ``first`` to ``last``, the n+1 offsets ``at``
    of the texts in them, each term's text ``owner`` and 64-bit hash ``h``."""

    def __init__(self, column: pa.Array, kept: np.ndarray):
        raw, at = utf8(column)
        self.raw = kept[raw]
        self.first, self.last, self.at = word_spans(self.raw, at)
        self.n = np.diff(self.at)
        self.owner = np.repeat(np.arange(len(self.n)), self.n)
        self.h = span_hashes(self.raw, self.first, self.last)

    def strings(self, some: np.ndarray) -> pa.Array:
        """The chosen terms as an Arrow string column."""
        size = self.last[some] - self.first[some]
        edge = np.concatenate([[0], np.cumsum(size)])
        place = np.repeat(self.first[some] - edge[:-1], size) + np.arange(edge[-1])
        data = self.raw[place]
        return pa.LargeStringArray.from_buffers(len(some), pa.py_buffer(edge.astype(np.int64)), pa.py_buffer(data)).cast(pa.string())
