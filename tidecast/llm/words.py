"""Texts of an Arrow batch as arrays of words.

Words are runs of bytes other than the six ASCII white-space characters, as the pattern
``[^\\x20\\x09-\\x0D]+`` has them; a null text has none.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

KEPT = "_tidecast_kept"  # what a Python worker keeps between tasks, beside the interpreter's modules
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACES.encode())] = True
PIECE_BYTES = 4 << 20

_rng = np.random.default_rng(20_240_607)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one byte array, and where each begins, with the end of the last."""
    whole = pc.fill_null(texts.cast(pa.large_string()), "")
    at = np.frombuffer(whole.buffers()[1], np.int64)[whole.offset : whole.offset + len(whole) + 1]
    data = whole.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def in_pieces(
    batches: Iterator[pa.RecordBatch], column: str, limit: int = PIECE_BYTES, keep: bool = False
) -> Iterator[pa.RecordBatch]:
    """The batches, cut where the texts in ``column`` would exceed ``limit`` bytes.

    A task without use for what earlier ones have kept in its worker (``keep``) frees it.
    """
    if not keep:
        sys.__dict__.pop(KEPT, None)
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        through = np.cumsum(sizes)
        first = 0
        while first < batch.num_rows:
            before = through[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(through, before + limit, "right")))
            yield batch.slice(first, last - first)
            first = last


def word_spans(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte, end, and number of words before each text (with the total at the end)."""
    inner = ~IS_SPACE[raw]
    begins = inner.copy()
    begins[1:] &= ~inner[:-1]
    ends = inner.copy()
    ends[:-1] &= ~inner[1:]
    cuts = at[:-1][at[:-1] < at[1:]]  # a word never runs over the border of two texts
    begins[cuts] = inner[cuts]
    ends[cuts[1:] - 1] = inner[cuts[1:] - 1]
    first, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return first, end, np.searchsorted(first, at)


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit values over all bits."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def word_hashes(raw: np.ndarray, first: np.ndarray, end: np.ndarray, step: int = 1 << 17) -> np.ndarray:
    """A 64-bit hash of the bytes of each word; ``step`` words at a time bound the memory."""
    out = np.zeros(len(first), np.uint64)
    for k in range(0, len(first), step):
        begins, sizes = first[k : k + step], end[k : k + step] - first[k : k + step]
        row = np.cumsum(sizes) - sizes
        inside = np.arange(int(sizes.sum())) - np.repeat(row, sizes)
        values = _BYTE[raw[inside + np.repeat(begins, sizes)]] * powers(_STEP, int(sizes.max()))[inside]
        out[k : k + step] = mix(np.add.reduceat(values, row) + sizes.astype(np.uint64))
    return out
