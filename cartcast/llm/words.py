"""Words of many texts at once, as 64-bit hashes.

A word is a run of anything but the six ASCII white-space characters, in ASCII
lower case.  All texts of a block are laid side by side in one byte array, so that numpy
finds and hashes all words in a few passes, eight bytes at a time.
"""

from __future__ import annotations

import numpy as np

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)
_K1, _K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def mix(x):
    """A bijection of 64 bits that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: list[str]):
    """Hashes of the words of all texts in order, and where each text's words end."""
    parts = [t.encode().lower() for t in texts]  # on bytes: ASCII case only
    data = b" ".join([*parts, bytes(8)])
    lengths = np.fromiter(map(len, parts), np.int64, len(parts)) + 1
    stops = np.cumsum(lengths)
    size = int(stops[-1]) if len(parts) else 0
    a = np.frombuffer(data, np.uint8)[:size]
    space = _SPACE[a]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if size and not space[0]:
        edge = np.concatenate([[0], edge])
    starts, ends = edge[0::2], edge[1::2]  # a text is followed by a space, so every word ends
    starts = starts[:len(ends)]
    size_of = ends - starts
    eight = np.ndarray((max(len(data) - 7, 0),), "<u8", data, strides=(1,))  # the eight bytes from each place on
    h = size_of.astype(np.uint64) * _K2
    at, live = 0, None  # first eight bytes: all words
    while True:
        s, n = (starts, size_of) if live is None else (starts[live], size_of[live])
        v = eight[s + at] & _MASKS[np.minimum(n - at, 8)]
        if live is None:
            h = (h ^ v) * _K1
            h ^= h >> np.uint64(32)
        else:
            x = (h[live] ^ v) * _K1
            h[live] = x ^ (x >> np.uint64(32))
        at += 8
        live = np.flatnonzero(size_of > at) if live is None else live[n > at]
        if not len(live):
            break
    return mix(h), np.searchsorted(starts, stops)
