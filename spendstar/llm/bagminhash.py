"""BagMinHash signatures of multisets of word shingles, in numpy over batches of documents.

A multiset gives each shingle an integer weight, its count. Weights are
discretised at 1, 2, 3, ... and a shingle of count c owns the levels up to c. Each
level carries a Poisson process of rate ``SIZE`` whose points are dealt evenly to
the ``SIZE`` components; a component's value is the earliest point that falls to
it. Two multisets then agree in a component with the probability of their
weighted Jaccard similarity, sum of minima over sum of maxima.

The processes are held hierarchically: levels are joined in bands (1], (1, 2],
(2, 4], (4, 8], ..., and a band of s levels is one process of rate s * SIZE. A
point's place among the halves of its band is read from further bits of its hash
and says its level; points above the shingle's count are passed over. So a count
of c costs about log2(c) processes. A process ends when its next point lies after
the document's latest component.
"""

from __future__ import annotations

import numpy as np

SHINGLE_WORDS = 5
BANDS, ROWS = 25, 5
SIZE = BANDS * ROWS

_GOLD = np.uint64(0x9E3779B97F4A7C15)
_C1, _C2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_ODD = [np.uint64(x) for x in (1, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3)]
# A shingle's hash has 53 bits, so that a text number of a batch fits beside it.
HASH_BITS = 53
MOST_TEXTS = 1 << (64 - HASH_BITS)
_HASH = np.uint64((1 << HASH_BITS) - 1)
# Points of a process that are drawn at once after the first rounds.
_AT_ONCE = 16


class WordHashes(dict):
    """64-bit hashes of words, at most ``limit`` of them kept."""

    def __init__(self, limit: int = 500_000):
        super().__init__()
        import xxhash

        self.limit, self.hash = limit, xxhash.xxh3_64_intdigest

    def __missing__(self, word: str) -> int:
        if len(self) >= self.limit:
            self.clear()
        out = self[word] = self.hash(word)
        return out


def mix(z: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix constants, fixed values)."""
    z = (z ^ (z >> np.uint64(30))) * _C1
    z = (z ^ (z >> np.uint64(27))) * _C2
    return z ^ (z >> np.uint64(31))


def _sorted_pairs(owner: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs sorted by text, then hash: both fit in one 64-bit number."""
    keys = (owner.astype(np.uint64) << np.uint64(HASH_BITS)) | h
    keys.sort()
    return (keys >> np.uint64(HASH_BITS)).astype(np.int64), keys & _HASH


def shingles(texts: list[str], hashes: dict) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of every occurrence of a shingle, sorted; at most ``MOST_TEXTS`` texts.

    A shingle is five neighbouring lower-cased words; a text of fewer words is one.
    """
    words: list[str] = []
    ends = []
    for t in texts:
        words.extend(t.lower().split())
        ends.append(len(words))
    h = mix(np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words)))
    end = np.array(ends, dtype=np.int64)
    start = np.concatenate([[0], end[:-1]]) if len(end) else end
    n = end - start
    full = np.maximum(n - SHINGLE_WORDS + 1, 0)
    with np.errstate(over="ignore"):
        owner = np.repeat(np.arange(len(texts)), full)
        out = np.zeros(0, np.uint64)
        if len(owner):
            m = len(h) - SHINGLE_WORDS + 1
            rolled = h[:m].copy()
            for j in range(1, SHINGLE_WORDS):
                rolled += h[j : j + m] * _ODD[j]
            first = np.repeat(start - (np.cumsum(full) - full), full)
            out = mix(rolled[np.arange(len(owner)) + first])
        short = np.flatnonzero((n > 0) & (n < SHINGLE_WORDS))
        extra = [
            mix(sum(h[start[i] + j] * _ODD[j + 1] for j in range(n[i])) * _ODD[1] + np.uint64(n[i]))
            for i in short
        ]
    owner = np.concatenate([owner, short])
    out = np.concatenate([out, np.array(extra, dtype=np.uint64)])
    return _sorted_pairs(owner, out & _HASH)


def counted(owner: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, hash) with their counts, of sorted occurrences."""
    if not len(h):
        return owner, h, np.zeros(0, np.int64)
    new = np.concatenate([[True], (owner[1:] != owner[:-1]) | (h[1:] != h[:-1])])
    at = np.flatnonzero(new)
    return owner[at], h[at], np.diff(np.append(at, len(h)))


def expanded(owner: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each occurrence as an element of its own: the k-th copy of a shingle gets the k-th name.

    The Jaccard similarity of the resulting sets is the multisets' weighted one.
    """
    _, _, count = counted(owner, h)
    if not len(h) or count.max() == 1:
        return owner, h
    copy = np.arange(len(h)) - np.repeat(np.cumsum(count) - count, count)
    with np.errstate(over="ignore"):
        names = np.where(copy == 0, h, mix(h + copy.astype(np.uint64) * _GOLD) & _HASH)
    return _sorted_pairs(owner, names)


def digests(n_texts: int, owner: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits for each multiset that don't depend on the order of its elements."""
    out = np.zeros((2, n_texts), np.uint64)
    with np.errstate(over="ignore"):
        np.add.at(out[0], owner, mix(h + _GOLD))
        np.add.at(out[1], owner, mix(h ^ _C1))
    return out[0], out[1]


def signatures(n_texts: int, owner: np.ndarray, h: np.ndarray, count: np.ndarray) -> np.ndarray:
    """(texts, SIZE) component values; infinite for texts without shingles."""
    values = np.full(n_texts * SIZE, np.inf)
    if not len(h):
        return values.reshape(n_texts, SIZE)
    # one process for each shingle and band that its count reaches
    reach = np.ceil(np.log2(count)).astype(np.int64)
    k = np.repeat(np.arange(len(h)), reach + 1)
    band = np.arange(len(k)) - np.repeat(np.cumsum(reach + 1) - (reach + 1), reach + 1)
    levels = np.where(band == 0, 1, 1 << np.maximum(band - 1, 0))
    below = np.where(band == 0, 0, levels)
    with np.errstate(over="ignore"):
        seed = mix(h[k] + (band.astype(np.uint64) + np.uint64(1)) * _C2)
    text, most = owner[k], count[k]
    x = np.zeros(len(k))
    latest = np.full(n_texts, np.inf)
    drawn, step = 0, 1
    while len(seed):
        with np.errstate(over="ignore"):
            turn = (np.arange(drawn + 1, drawn + step + 1, dtype=np.uint64) * _GOLD)[None, :]
            z = mix(seed[:, None] + turn)
            other = mix(z ^ _C2)
        u = ((z >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
        gap = -np.log(u) / (levels * float(SIZE))[:, None]
        gap[:, 0] += x
        points = np.cumsum(gap, axis=1)
        part = (other >> np.uint64(32)) % np.uint64(SIZE)
        level = below[:, None] + 1 + ((other & np.uint64(0xFFFFFFFF)).astype(np.int64) % levels[:, None])
        ok = (level <= most[:, None]) & (points <= latest[text][:, None])
        place = (text[:, None] * SIZE + part.astype(np.int64))[ok]
        np.minimum.at(values, place, points[ok])
        latest = values.reshape(n_texts, SIZE).max(axis=1)
        x = points[:, -1]
        drawn += step
        alive = x <= latest[text]
        seed, text, most, levels, below, x = (a[alive] for a in (seed, text, most, levels, below, x))
        if drawn >= 4:
            step = _AT_ONCE
    return values.reshape(n_texts, SIZE)


def band_keys(values: np.ndarray) -> np.ndarray:
    """(texts, BANDS) 64-bit keys of the bands of ``ROWS`` components."""
    bits = values.view(np.uint64).reshape(len(values), BANDS, ROWS)
    with np.errstate(over="ignore"):
        keys = np.zeros((len(values), BANDS), np.uint64)
        for j in range(ROWS):
            keys = mix(keys * _ODD[1] + bits[:, :, j] + np.uint64(j + 1))
        keys = mix(keys + np.arange(1, BANDS + 1, dtype=np.uint64) * _GOLD)
    return keys.view(np.int64)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sorted sets (two empty sets: 1)."""
    if len(a) > len(b):
        a, b = b, a
    if not len(b):
        return 1.0
    if not len(a):
        return 0.0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    common = int((b[at] == a).sum())
    return common / (len(a) + len(b) - common)
