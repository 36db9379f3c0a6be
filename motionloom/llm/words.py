"""Words of whole text columns at once: letters, digits and everything outside ASCII, A-Z lower-cased, on the bytes of UTF-8."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_BYTES = np.arange(256, dtype=np.uint8)
_LOWER = np.where((_BYTES >= ord("A")) & (_BYTES <= ord("Z")), _BYTES + 32, _BYTES).astype(np.uint8)
_IS_WORD = (_BYTES >= 0x80) | ((_BYTES >= ord("0")) & (_BYTES <= ord("9"))) | ((_LOWER >= ord("a")) & (_LOWER <= ord("z")))


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(all words in order, as large_binary; the number of words of each text). Null is a text without words."""
    col = texts.cast(pa.large_string()).cast(pa.large_binary()).fill_null(b"")
    at = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1] if len(col) else np.zeros(1, np.int64)
    data = np.frombuffer(col.buffers()[2], np.uint8)[at[0] : at[-1]] if at[-1] > at[0] else np.zeros(0, np.uint8)
    at = at - at[0]
    inside = _IS_WORD[data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    first = at[:-1][at[:-1] < at[1:]]
    starts[first] = inside[first]
    where = np.flatnonzero(starts)
    letters = _LOWER[data[inside]]
    # a word's length is the number of word bytes up to the next word's start
    offsets = np.append(np.cumsum(inside)[where] - 1, len(letters)).astype(np.int64) if len(where) else np.zeros(1, np.int64)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(where), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
    return words, np.diff(np.searchsorted(where, at))
