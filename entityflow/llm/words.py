"""Word hashing that the n-gram operators share: words between ASCII white space, ASCII letters without case, as 64-bit hashes.

All words of a batch are hashed at once: with random values for the bytes, prefix sums of value * P^place
(modulo 2^64) give every word's polynomial as one difference, which P^-start makes independent of its place.
"""

from __future__ import annotations

import numpy as np

_P = 0x9E3779B97F4A7C15 | 1
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_VALUE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_VALUE[65:91] = _VALUE[97:123]
#: Punctuation that ``strip`` takes off the ends of words.
_EDGE = np.zeros(256, bool)
_EDGE[list(b".,;:!?\"'()[]{}")] = True
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: Odd random weights of a window's places: a window's hash is a weighted sum of its word hashes.
WEIGHTS = np.random.default_rng(20240608).integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Bytes hashed at once.
CHUNK = 1 << 20
_POWERS: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    return x ^ (x >> np.uint64(29))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("p", ())) < n:
        size = max(n, CHUNK + 4096)
        for name, base in (("p", _P), ("i", pow(_P, -1, 1 << 64))):
            a = np.full(size, base, np.uint64)
            a[0] = 1
            np.multiply.accumulate(a, out=a)
            if n > 4 * CHUNK:  # not kept: one huge word
                _POWERS.pop(name, None)
                _POWERS[name + "_once"] = a
            else:
                _POWERS[name] = a
        if n > 4 * CHUNK:
            return _POWERS.pop("p_once"), _POWERS.pop("i_once")
    return _POWERS["p"], _POWERS["i"]


def _hash(raw: bytes, strip: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and end places of the words of a byte string."""
    b = np.frombuffer(raw, np.uint8)
    n = len(b)
    inside = np.zeros(n + 2, np.int8)
    inside[1:-1] = ~_SPACE[b]
    step = np.diff(inside)
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    places = ends
    if strip and len(starts):
        core = ~(_EDGE[b] | _SPACE[b])
        at = np.arange(n)
        after = np.append(np.minimum.accumulate(np.where(core, at, n)[::-1])[::-1], n)[starts]
        before = np.maximum.accumulate(np.where(core, at, -1))[ends - 1] + 1
        whole = after >= ends
        starts, ends = np.where(whole, starts, after), np.where(whole, ends, before)
    p, inverse = _powers(n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_VALUE[b] * p[:n], out=total[1:])
    h = (total[ends] - total[starts]) * inverse[starts]
    return mix(h + (ends - starts).astype(np.uint64) * _M2), places


def word_hashes(texts: list[str | None], strip: bool = False) -> list[np.ndarray]:
    """Hashes of each text's words in order (null and empty: none)."""
    out: list[np.ndarray] = []
    group: list[bytes] = []
    size = 0

    def flush():
        nonlocal size
        if group:
            h, places = _hash(b"\n".join(group), strip)
            cuts = np.searchsorted(places, np.cumsum([len(g) + 1 for g in group])[:-1])
            out.extend(np.split(h, cuts))
            group.clear()
            size = 0

    for t in texts:
        raw = t.encode() if t else b""
        if len(raw) > CHUNK:
            flush()
            out.append(_long(raw, strip))
            continue
        if size + len(raw) > CHUNK:
            flush()
        group.append(raw)
        size += len(raw) + 1
    flush()
    return out


def _long(raw: bytes, strip: bool) -> np.ndarray:
    """A long text piece by piece, cut at white space."""
    parts, at = [], 0
    while at < len(raw):
        end = min(len(raw), at + CHUNK)
        while end < len(raw) and not _SPACE[raw[end]]:
            end += 1
        parts.append(_hash(raw[at:end], strip)[0])
        at = end
    return np.concatenate(parts)


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of all k-word runs; fewer words make one shingle of them all, no words none."""
    n = len(words)
    if not n:
        return words
    width = min(k, n)
    h = np.full(n - width + 1, np.uint64(width))
    for i in range(width):
        h += words[i : n - width + 1 + i] * WEIGHTS[i % len(WEIGHTS)]
    h = mix(h)
    h.sort()
    keep = np.empty(len(h), bool)
    keep[0] = True
    np.not_equal(h[1:], h[:-1], out=keep[1:])
    return h[keep]
