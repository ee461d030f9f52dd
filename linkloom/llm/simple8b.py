"""Simple-8b: unsigned integers in 64-bit words, a 4-bit selector and up to 60 bits of values each.

Values are coded in blocks of ``BLOCK``; each block's first word is in an offset table, so all blocks are decoded
side by side. The last word of a block may stand for fewer values than its selector says. Selector 0 is the escape:
the next word is a value of its own, all 64 bits.
"""

from __future__ import annotations

import numpy as np

#: (values in a word, bits of each), by selector. Fixed values of this format.
SELECTORS = [(1, 64), (120, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60)]
BLOCK = 1024
_MOST = 120
_COUNT = np.array([n for n, _ in SELECTORS])
_U = np.uint64
#: Bit lengths of small values.
_LENGTH = np.zeros(1 << 20, np.int8)
for _b in range(20):
    _LENGTH[1 << _b : 2 << _b] = _b + 1


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words, and the index of each block's first word."""
    n = len(values)
    blocks = -(-n // BLOCK)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint32)
    v = np.zeros((blocks, BLOCK + _MOST), np.uint64)
    padded = np.zeros(blocks * BLOCK, np.uint64)
    padded[:n] = values
    v[:, :BLOCK] = padded.reshape(blocks, BLOCK)
    bits = _LENGTH[np.minimum(v, _U(len(_LENGTH) - 1)).astype(np.int32)]
    big = v >= _U(len(_LENGTH))
    if big.any():
        bits[big] = [int(x).bit_length() for x in v[big]]
    # the widest of the next k values, for each k a selector has
    widest = {1: bits}
    k = 1
    while k < _MOST:
        wide = widest[k].copy()
        wide[:, :-k] = np.maximum(wide[:, :-k], widest[k][:, k:])
        k *= 2
        widest[k] = wide

    def over(m: int) -> np.ndarray:
        p = 1 << (m.bit_length() - 1)
        out = widest[p].copy()
        if m > p:
            out[:, : -(m - p)] = np.maximum(out[:, : -(m - p)], widest[p][:, m - p :])
        return out

    choice = np.zeros(v.shape, np.int8)
    for s in range(len(SELECTORS) - 1, 0, -1):
        m, b = SELECTORS[s]
        choice[over(m) <= b] = s
    starts = np.zeros(v.shape, bool)
    at, row = np.zeros(blocks, np.int64), np.arange(blocks)
    size = np.minimum(BLOCK, n - row * BLOCK)
    while len(row):
        starts[row, at] = True
        at = at + _COUNT[choice[row, at]]
        on = at < size[row]
        at, row = at[on], row[on]
    flat = np.flatnonzero(starts)
    sel, vals = choice.ravel()[flat], v.ravel()
    width = np.where(sel == 0, 2, 1)
    place = np.cumsum(width) - width
    words = np.zeros(int(width.sum()), np.uint64)
    for s, (m, b) in enumerate(SELECTORS):
        own = np.flatnonzero(sel == s)
        if not len(own):
            continue
        if s == 0:
            words[place[own] + 1] = vals[flat[own]]
            continue
        w = np.full(len(own), s << 60, np.uint64)
        if b:
            for j in range(m):
                w |= vals[flat[own] + j] << _U(j * b)
        words[place[own]] = w
    first = np.searchsorted(flat, row_start := np.arange(blocks) * v.shape[1])
    del row_start
    return words, place[first].astype(np.uint32)


def decode(words: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` values."""
    if not n:
        return np.zeros(0, np.uint64)
    sel = (words >> _U(60)).astype(np.int64)
    raw = np.zeros(len(words) + 1, bool)
    for i in np.flatnonzero(sel == 0):
        if not raw[i]:
            raw[i + 1] = True
    raw = raw[:-1]
    count = np.where(raw, 0, _COUNT[sel])
    run = np.cumsum(count) - count
    block = np.zeros(len(words), np.int64)
    block[offsets[1:]] = 1
    block = np.cumsum(block)
    at = run - run[offsets][block]
    out = np.zeros((len(offsets), BLOCK + _MOST), np.uint64)
    flat, base = out.ravel(), block * out.shape[1] + at
    for s, (m, b) in enumerate(SELECTORS):
        own = np.flatnonzero((sel == s) & ~raw)
        if s == 0:
            flat[base[own]] = words[own + 1]
        elif b:
            for j in range(m):
                flat[base[own] + j] = (words[own] >> _U(j * b)) & _U((1 << b) - 1)
    return out[:, :BLOCK].ravel()[:n]
