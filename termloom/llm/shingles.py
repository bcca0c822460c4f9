"""Word shingles of whole texts as sets of 64-bit hashes, vectorised over batches of texts.

Words are maximal runs of bytes other than 0x20 and 0x09 to 0x0D of the UTF-8 text, A-Z lower-cased. A text with fewer
words than a shingle has its whole sequence as its one shingle; a text without words has none.
"""

from __future__ import annotations

import numpy as np

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: dict[str, np.ndarray] = {}


def mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse, modulo 2**64."""
    if "up" not in _POWERS or len(_POWERS["up"]) < n:
        size = max(n, 1 << 20)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            step = np.full(size, base, dtype=np.uint64)
            step[0] = 1
            _POWERS[name] = np.cumprod(step, dtype=np.uint64)
    return _POWERS["up"], _POWERS["down"]


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts in order, and the text of each."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    buf = _LOWER[np.frombuffer(b"\n".join(raw) + b"\n", dtype=np.uint8)]
    inside = ~_SPACE[buf]
    edge = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0)))
    start, end = edge[0::2], edge[1::2]
    up, down = _powers(len(buf) + 1)
    total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * up[: len(buf)], dtype=np.uint64)])
    h = mix64((total[end] - total[start]) * down[start])
    first = np.cumsum([0, *(len(r) + 1 for r in raw)])[:-1]
    return h, np.searchsorted(first, start, side="right") - 1


def shingle_sets(texts: list[str], words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of each text: hashes, and ends of the texts' runs (length len(texts) + 1)."""
    h, owner = word_hashes(texts)
    k = np.uint64(0xD6E8FEB86659FD93)
    n = len(h) - words + 1
    per = np.bincount(owner, minlength=len(texts))
    parts, owners = [], []
    if n > 0:
        s = np.zeros(n, dtype=np.uint64)
        for j in range(words):
            s = s * k + h[j : j + n]
        same = owner[:n] == owner[words - 1 :]
        parts.append(mix64(s[same]))
        owners.append(owner[:n][same])
    first = np.concatenate([[0], np.cumsum(per)])
    for t in np.flatnonzero((per > 0) & (per < words)):
        s = np.uint64(per[t])
        with np.errstate(over="ignore"):
            for x in h[first[t] : first[t + 1]]:
                s = s * k + x
        parts.append(mix64(np.array([s ^ np.uint64(0xA5A5A5A5)], dtype=np.uint64)))
        owners.append(np.array([t]))
    if not parts:
        return np.zeros(0, dtype=np.uint64), np.zeros(len(texts) + 1, dtype=np.int64)
    s, o = np.concatenate(parts), np.concatenate(owners)
    order = np.lexsort((s, o))
    s, o = s[order], o[order]
    keep = np.ones(len(s), dtype=bool)
    keep[1:] = (s[1:] != s[:-1]) | (o[1:] != o[:-1])
    s, o = s[keep], o[keep]
    return s, np.searchsorted(o, np.arange(len(texts) + 1))
