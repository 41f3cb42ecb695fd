"""Array kernels shared by the operators that read whole texts in Arrow batches.

All work on UTF-8 bytes, a bounded chunk of rows at a time; nothing here knows about Spark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 500_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX_2 = np.uint64(0x94D049BB133111EB)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of words between white space (space, tab to carriage return).
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[32, 9, 10, 11, 12, 13]] = False
#: Bytes of lower-case alphanumeric words; every byte of a character beyond ASCII counts.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True

_powers = np.ones(1, np.uint64)
_inverse_powers = np.ones(1, np.uint64)


def text_chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows with about ``limit`` bytes; null is empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    first = 0
    while first < len(texts):
        end = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        end = min(max(end, first + 1), len(texts))
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def mix(values: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    values = (values ^ (values >> np.uint64(30))) * _MIX_1
    values = (values ^ (values >> np.uint64(27))) * _MIX_2
    return values ^ (values >> np.uint64(31))


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverse_powers
    if len(_powers) < size:
        base, inverse = int(_BASE), pow(int(_BASE), -1, 1 << 64)
        steps = np.full(size, base, np.uint64), np.full(size, inverse, np.uint64)
        steps[0][0] = steps[1][0] = 1
        _powers, _inverse_powers = np.cumprod(steps[0]), np.cumprod(steps[1])
    return _powers, _inverse_powers


def words_of(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and row numbers of the words; no word crosses rows."""
    mask = is_word[data]
    breaks = np.zeros(len(data) + 1, bool)
    breaks[offsets] = True
    starts = mask.copy()
    starts[1:] &= ~mask[:-1] | breaks[1:-1]
    ends = mask.copy()
    ends[:-1] &= ~mask[1:] | breaks[1:-1]
    first = np.flatnonzero(starts)
    return first, np.flatnonzero(ends) + 1, np.searchsorted(offsets, first, "right") - 1


def slice_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte slices, equal wherever the bytes are. ``starts`` may be in any order."""
    if len(data) <= 2 * CHUNK_BYTES:
        return _slice_hashes(data, starts, ends)
    order = np.argsort(starts, kind="stable")
    out = np.zeros(len(starts), np.uint64)
    cuts = np.searchsorted(starts[order], np.arange(0, len(data) + CHUNK_BYTES, CHUNK_BYTES))
    for k, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
        if a < b:
            chosen, low = order[a:b], k * CHUNK_BYTES
            out[chosen] = _slice_hashes(data[low : int(ends[chosen].max())], starts[chosen] - low, ends[chosen] - low)
    return out


def _slice_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    powers, inverse = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[: len(data)], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * inverse[starts]
    return mix(hashes ^ (ends - starts).astype(np.uint64))


_BLOCKS = 1 << 17
#: What to keep of eight bytes when so many of them belong to the word.
_KEPT = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def _eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on as one value; zeros follow the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray(len(data) + 1, "<u8", padded.data, 0, (1,))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of words: every eight bytes are mixed with their place before they are added.

    Unlike sums of powers, no two families of words are known to collide. Work grows with the bytes of the words.
    """
    sums = np.zeros(len(starts), np.uint64)
    if not len(starts):
        return sums
    eights, blocks = _eights(data), (ends - starts + 7) // 8
    first = np.cumsum(blocks) - blocks
    for low in range(0, int(blocks.sum()), _BLOCKS):
        numbers = np.arange(low, min(low + _BLOCKS, int(blocks.sum())))
        words = np.searchsorted(first, numbers, "right") - 1
        places = numbers - first[words]
        at = starts[words] + 8 * places
        values = eights[at] & _KEPT[np.minimum(ends[words] - at, 8)]
        mixed = mix(mix(values ^ mix((places + 1).astype(np.uint64) * _BASE)) + places.astype(np.uint64))
        begins = np.flatnonzero(np.diff(words, prepend=-1))
        sums[words[begins]] += np.add.reduceat(mixed, begins)
    return mix(sums ^ ((ends - starts).astype(np.uint64) * _MIX_2))


def same_bytes(data, starts, ends, others, other_starts, other_ends) -> np.ndarray:
    """Which pairs of slices hold equal bytes."""
    equal = ends - starts == other_ends - other_starts
    left, right = _eights(data), _eights(others)
    open_, done = np.flatnonzero(equal), 0
    while len(open_):
        size = ends[open_] - starts[open_] - done
        open_ = open_[size > 0]
        kept = _KEPT[np.minimum(size[size > 0], 8)]
        differs = ((left[starts[open_] + done] ^ right[other_starts[open_] + done]) & kept) != 0
        equal[open_[differs]] = False
        open_, done = open_[~differs], done + 8
    return equal


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` consecutive values; runs of different sizes never share one by design."""
    count = len(hashes) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(count, (size * 0xD6E8FEB86659FD93) & (2**64 - 1), np.uint64)
    factors = mix(np.arange(1, size + 1, dtype=np.uint64) * _BASE) | np.uint64(1)
    for k in range(size):
        total += hashes[k : k + count] * factors[k]
    return mix(total)


def row_ranges(rows: np.ndarray, count: int) -> np.ndarray:
    """For sorted row numbers: the position where each row's entries begin, and the end."""
    return np.searchsorted(rows, np.arange(count + 1))


def covered(starts: np.ndarray, sizes: np.ndarray | int, length: int) -> np.ndarray:
    """Which of ``length`` places lie in a run that begins at one of ``starts``."""
    begun, ended = np.bincount(starts, minlength=length + 1), np.bincount(starts + sizes, minlength=length + 1)
    return np.cumsum((begun - ended)[:length]) > 0


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal true runs."""
    edges = np.diff(np.concatenate(([0], mask.view(np.int8), [0])))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
