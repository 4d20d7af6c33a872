"""Word shingles of whole texts as 64-bit hashes, MinHash samples of them, and
odd sketches of the samples: numpy code that runs inside tasks."""

from __future__ import annotations

import numpy as np

from graphloom.llm.worker import only

_U = np.uint64
_MIX1, _MIX2 = _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)
_STEP = _U(0x9E3779B97F4A7C15)
#: Words whose hash is kept (about 150 bytes each).
WORDS_KEPT = 200_000
#: Shingles hashed by all functions at once, at most.
BLOCK = 4096


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> _U(30))) * _MIX1
    x = (x ^ (x >> _U(27))) * _MIX2
    return x ^ (x >> _U(31))


class _Words(dict):
    """word (bytes) -> 64-bit hash, kept for the words in use."""

    def __missing__(self, w: bytes) -> int:
        import xxhash

        if len(self) > WORDS_KEPT:
            self.clear()
        h = xxhash.xxh3_64_intdigest(w)
        if len(w) <= 64:
            self[w] = h
        return h


_WORDS = _Words()


def keep_words() -> None:
    """At the start of a task: this worker's tables are the words' hashes."""
    only("shingles", _WORDS.clear)


def shingle_set(text: bytes | None, k: int) -> np.ndarray:
    """Distinct k-word shingles of a UTF-8 text, sorted: A-Z lower-cased, words
    are runs without space and \\x09-\\x0D (which is what bytes.split takes).
    Fewer words than k: the whole sequence as one; none: the empty set."""
    words = text.lower().split() if text else ()
    n = len(words)
    if not n:
        return np.empty(0, _U)
    h = np.fromiter(map(_WORDS.__getitem__, words), _U, n)
    width = min(k, n)
    # a short text is not equal to any k-word shingle: its width goes in
    s = np.full(n - width + 1, width, _U)
    for j in range(width):
        s = mix(s * _STEP + h[j:n - width + 1 + j])
    return np.unique(s)


class Sketcher:
    """MinHash samples, band keys and odd sketches with fixed seeds."""

    def __init__(self, bands: int, rows: int, bits: int, seed: int = 1):
        r = np.random.RandomState(seed)
        m = bands * rows
        self.bands, self.rows, self.bits = bands, rows, bits
        self.a = (r.randint(0, 2**63, m, dtype=np.int64).astype(_U) << _U(1)) | _U(1)
        self.b = mix(np.arange(1, m + 1, dtype=_U) * _STEP)
        self.place = np.arange(m, dtype=_U)

    def samples(self, s: np.ndarray) -> np.ndarray:
        """The smallest value of each hash function over a non-empty set."""
        out = np.full(len(self.a), _U(2**64 - 1))
        for i in range(0, len(s), BLOCK):
            part = s[i:i + BLOCK]
            for j in range(0, len(self.a), 16):
                v = np.multiply.outer(self.a[j:j + 16], part)
                v += self.b[j:j + 16, None]
                np.minimum(out[j:j + 16], v.min(1), out=out[j:j + 16])
        return out

    def band_keys(self, samples: np.ndarray) -> np.ndarray:
        g = samples.reshape(self.bands, self.rows)
        key = np.arange(1, self.bands + 1, dtype=_U)
        for j in range(self.rows):
            key = mix(key * _STEP + g[:, j])
        return key.view(np.int64)

    def odd(self, samples: np.ndarray) -> np.ndarray:
        """Parity bitmap of the (position, value) samples, as longs: each
        sample flips one bit, so equal samples cancel in the XOR of two."""
        bit = mix(samples + self.place * _STEP) % _U(self.bits)
        flips = np.bincount(bit.astype(np.int64), minlength=self.bits) & 1
        return np.packbits(flips.astype(np.uint8)).view("<i8").astype(np.int64)


def similarity(flipped, bits: int, samples: int):
    """Estimated Jaccard similarity from the population count of an XOR."""
    q = np.minimum(np.asarray(flipped, float) * 2 / bits, 1 - 1e-9)
    differing = np.log1p(-q) / np.log1p(-2 / bits) / 2
    return 1 - differing / samples


def most_flips(threshold: float, bits: int, samples: int, sigmas: float) -> int:
    """The population count that a pair at the threshold exceeds with the
    probability of ``sigmas`` standard deviations: sampling noise of the
    MinHash samples and collision noise of the parity bits together."""
    d = samples * (1 - threshold)
    sd = (samples * threshold * (1 - threshold)) ** 0.5
    mean = bits / 2 * (1 - (1 - 2 / bits) ** (2 * d))
    slope = bits * (1 - 2 / bits) ** (2 * d) * 2 / bits
    # variance of the number of odd cells after 2d throws into `bits` cells
    one, two = (1 - 2 / bits) ** (2 * d), (1 - 4 / bits) ** (2 * d)
    var = bits / 4 + bits * (bits - 1) / 4 * two - bits * bits / 4 * one * one
    return int(mean + sigmas * ((slope * sd) ** 2 + max(var, 0)) ** 0.5)
