"""Word hashes of whole Arrow columns of text, in numpy, without a Python object per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text is worked on in runs of about so many bytes; a longer text makes a run of its own.
RUN_BYTES = 1_000_000
RUN_TEXTS = 20_000
_ODD = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def unit(x: np.ndarray) -> np.ndarray:
    """Hashes as numbers in (0, 1)."""
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


_BLANK = np.zeros(256, dtype=bool)
_BLANK[[32, *range(9, 14)]] = True
_VALUE = np.where(_BLANK, np.uint64(0), mix(np.arange(1, 257, dtype=np.uint64) * _ODD))
_FOLDED = _VALUE.copy()
_FOLDED[65:91] = _VALUE[97:123]
_powers = np.ones(1, dtype=np.uint64)


def _power(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        _powers = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(max(4096, n), _STEP)]))
    return _powers


def runs(texts: pa.Array, most: int = RUN_TEXTS) -> Iterator[tuple[int, int]]:
    """Index ranges of about RUN_BYTES of text and ``most`` rows at most."""
    ends = np.cumsum(np.asarray(pc.binary_length(texts), dtype=np.int64))
    at = 0
    while at < len(texts):
        limit = (ends[at - 1] if at else 0) + RUN_BYTES
        to = min(max(at + 1, int(np.searchsorted(ends, limit, side="right"))), at + most)
        yield at, to
        at = to


def word_hashes(texts: pa.Array, fold: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word in order, number of words of each text); no nulls.

    Words are runs of bytes other than the ASCII blanks, which never cut a UTF-8 character.
    fold: A-Z count as a-z.
    """
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    solid = ~_BLANK[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    first[edges] = solid[edges]
    starts = np.flatnonzero(first)
    counts = np.diff(np.searchsorted(starts, offsets))
    if not len(starts):
        return np.zeros(0, np.uint64), counts
    spans = np.diff(np.append(starts, len(data)))
    place = np.arange(starts[0], len(data)) - np.repeat(starts, spans)
    values = (_FOLDED if fold else _VALUE)[data[starts[0] :]] * _power(int(spans.max()) + 1)[place]
    return mix(np.add.reduceat(values, starts - starts[0])), counts
