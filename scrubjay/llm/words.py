"""Words of Arrow string columns as 64-bit hashes, computed with numpy over the
column's byte buffer. Works on UTF-8 bytes: both word classes below treat every
byte of a non-ASCII character as part of a word."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Bytes of words, after A-Z became a-z.
_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32
NOT_SPACE = np.ones(256, bool)  # [^\x20\x09-\x0D]+
NOT_SPACE[[32, 9, 10, 11, 12, 13]] = False
ALNUM = np.zeros(256, bool)  # [^\x00-\x2F\x3A-\x60\x7B-\x7F]+
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True

SEGMENT = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)[_lower]
_powers: dict[str, np.ndarray] = {}


def _power_tables() -> tuple[np.ndarray, np.ndarray]:
    if not _powers:
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            t = np.full(SEGMENT + 1, base, dtype=np.uint64)
            t[0] = 1
            _powers[name] = np.multiply.accumulate(t)
    return _powers["up"], _powers["down"]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser: spreads differences over all bits."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets (n + 1) of a string column; null is empty."""
    column = column.fill_null("") if column.null_count else column
    column = column.cast(pa.large_string())
    off = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def _long_word(data: np.ndarray, at: int, limit: int, kind: np.ndarray) -> tuple[np.ndarray, int]:
    """Hash and end of a word that begins at ``at`` and is longer than a segment; ``limit`` is the end of its document."""
    up, _ = _power_tables()
    end = at
    while end < limit:
        outside = np.flatnonzero(~kind[data[end:min(limit, end + SEGMENT)]])
        if len(outside):
            end += int(outside[0])
            break
        end = min(limit, end + SEGMENT)
    total = 0
    for o in range(at, end, SEGMENT):
        piece = data[o:min(end, o + SEGMENT)]
        total += int(np.sum(_BYTE[piece] * up[:len(piece)], dtype=np.uint64)) * pow(_BASE, o - at, 1 << 64)
    return mix(np.array([(total + end - at) % (1 << 64)], np.uint64)), end


def word_hashes(data: np.ndarray, off: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and for each document the number of words
    before it (n + 1 entries). A word ends where its document ends. Long inputs
    are worked through in segments that end between words; a longer word is hashed in pieces."""
    up, down = _power_tables()
    hashes, starts = [], []
    at, n = 0, len(data)
    while at < n:
        stop = min(n, at + SEGMENT)
        inside = kind[data[at:stop]]
        if stop < n and inside[-1]:  # do not cut a word
            cut = np.flatnonzero(~inside)
            last_doc = off[np.searchsorted(off, stop, side="right") - 1]
            whole = max(at + int(cut[-1]) + 1 if len(cut) else 0, int(last_doc) if last_doc > at else 0)
            if not whole:
                h, end = _long_word(data, at, int(off[np.searchsorted(off, at, side="right")]), kind)
                hashes.append(h)
                starts.append(np.array([at]))
                at = end
                continue
            stop = whole
            inside = inside[:stop - at]
        begin = inside.copy()
        begin[1:] &= ~inside[:-1]
        docs = off[np.searchsorted(off, at):np.searchsorted(off, stop)] - at
        begin[docs] = inside[docs]
        first = np.flatnonzero(begin)
        if len(first):
            end = inside.copy()
            end[:-1] &= ~inside[1:] | begin[1:]
            last = np.flatnonzero(end)
            total = np.cumsum(_BYTE[data[at:stop]] * up[:stop - at], dtype=np.uint64)
            before = np.where(first > 0, total[first - 1], np.uint64(0))
            hashes.append(mix((total[last] - before) * down[first] + (last - first + 1).astype(np.uint64)))
            starts.append(first + at)
        at = stop
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(off), np.int64)
    starts = np.concatenate(starts)
    return np.concatenate(hashes), np.searchsorted(starts, off).astype(np.int64)


def slices(column: pa.Array, limit: int = 1 << 20, rows: int = 1 << 20) -> list[tuple[int, int]]:
    """Runs of at most ``rows`` rows and about ``limit`` bytes of text; one longer text is a run."""
    if not len(column):
        return []
    ends = buffers(column)[1][1:]
    out, a = [], 0
    while a < len(column):
        base = ends[a - 1] if a else 0
        b = min(a + rows, max(a + 1, int(np.searchsorted(ends, base + limit, side="right"))))
        out.append((a, b))
        a = b
    return out
