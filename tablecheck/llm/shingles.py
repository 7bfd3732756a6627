"""Words and word shingles of a text as 64-bit hashes."""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash

_BASE = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(words: list[bytes], seed: int = 0) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words, repeat(seed)), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sequence(words: list[bytes], size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words in order; of all words if there are fewer."""
    hashes = word_hashes(words)
    size = min(size, len(words))
    if not size:
        return hashes
    n = len(words) - size + 1
    value = np.full(n, size, np.uint64)
    for i in range(size):
        value = mixed(value * _BASE + hashes[i: i + n])
    return value


def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """The distinct ones of ``shingle_sequence``, sorted."""
    return np.unique(shingle_sequence(words, size))


def window_hashes(hashes: np.ndarray, size: int, starts: np.ndarray, base: int = 0xD6E8FEB86659FD93) -> np.ndarray:
    """Hashes of the runs of ``size`` words at ``starts``, from running sums over the words.

    Sums and powers wrap at 64 bits; ``base`` is odd, so its powers can be divided out.
    """
    odd = np.uint64(base | 1)
    inverse = np.uint64(pow(base | 1, -1, 1 << 64))
    powers = np.full(len(hashes) + 1, odd)
    powers[0] = 1
    powers = np.cumprod(powers, dtype=np.uint64)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * powers[:-1], dtype=np.uint64)])
    back = np.full(len(hashes) + 1, inverse)
    back[0] = 1
    back = np.cumprod(back, dtype=np.uint64)
    return mixed((sums[starts + size] - sums[starts]) * back[starts])


def list_array(arrays: list[np.ndarray | None], kind: pa.DataType) -> pa.ListArray:
    """One list a row; None becomes an empty list."""
    sizes = [0 if a is None else len(a) for a in arrays]
    offsets = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]).astype(np.int32)
    filled = [a for a in arrays if a is not None and len(a)]
    values = np.concatenate(filled) if filled else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


_PLAIN = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def plain_words(text: bytes | None) -> list[bytes]:
    """Letters and digits in lower case, cut at ASCII punctuation and white space."""
    if not text:
        return []
    if not text.isascii():
        text = text.decode("utf-8", "replace").lower().encode()
    return text.translate(_PLAIN).split()
