"""Sets of word shingles, and fast similarity sketches of such sets (Dahlgaard, Knudsen and Thorup, 2017).

A sketch has ``bins`` coordinates. In round i every element draws a value in [0, 1) and a bin; a bin keeps the least
i + value it meets. For the first ``bins`` rounds the bin is drawn at random, in later ones round i fills bin i - bins, so
no coordinate stays empty, and with n elements about bins * ln(bins) / n rounds do. Two sets agree in each coordinate
with a probability equal to their Jaccard similarity, with Chernoff-type concentration over the coordinates.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import xxhash

U = np.uint64
_VALUE_BITS = U(48)


class Words(dict):
    """Words and their numbers, from 1 on; with each number a 64-bit hash for the sketches and a 128-bit digest for names."""

    def __init__(self, hashed: Callable[[bytes], int] = xxhash.xxh3_64_intdigest):
        super().__init__()
        self.hashed = hashed
        self.hashes, self.digests = np.zeros(1024, dtype=np.uint64), np.zeros((1024, 2), dtype=np.uint64)

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self) + 1
        if n >= len(self.hashes):
            self.hashes, self.digests = np.concatenate([self.hashes, np.zeros_like(self.hashes)]), np.concatenate([self.digests, np.zeros_like(self.digests)])
        self.hashes[n] = self.hashed(word)
        self.digests[n] = np.frombuffer(hashlib.blake2b(word, digest_size=16).digest(), dtype=np.uint64)
        return n


def numbered(text: str | None, words: Words) -> np.ndarray:
    """The text's words as numbers: A-Z in lower case, parted by U+0020 and U+0009 to U+000D."""
    found = (text or "").encode("utf-8", "replace").lower().split()  # bytes: A-Z and the ASCII white space only
    return np.fromiter(map(words.__getitem__, found), dtype=np.int64, count=len(found))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers with good diffusion (the finaliser of SplitMix64)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _exact(columns: list[np.ndarray], size: int) -> np.ndarray:
    """One number for each row of ``columns`` (all below ``size``), equal for equal rows only."""
    code, bound = columns[0], size
    for column in columns[1:]:
        if bound * size >= 1 << 62:
            code = np.unique(code, return_inverse=True)[1]
            bound = len(code)
        code, bound = code * size + column, bound * size
    return code


def shingles(ids: np.ndarray, width: int, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes, by hash, of the distinct runs of ``width`` words; of the whole sequence if it is shorter.

    Runs are told apart by their words; a hash only sorts them.
    """
    used = min(width, len(ids))
    if not used:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
    h, n = words.hashes[ids], len(ids) - used + 1
    hashes = np.full(n, used, dtype=np.uint64)
    for k in range(used):
        hashes = mixed(hashes * U(0x9E3779B97F4A7C15) + h[k : n + k])
    code = _exact([ids[k : n + k] for k in range(used)], len(words) + 1)
    order = np.argsort(hashes)
    sorted_code, sorted_hash = code[order], hashes[order]
    same = sorted_hash[1:] == sorted_hash[:-1]
    if (sorted_code[1:] != sorted_code[:-1])[same].any():  # runs that share a hash: in the order of their words' digests
        first = np.unique(code, return_index=True)[1]
        keys = [words.digests[ids[first + k]][:, half] for k in range(used - 1, -1, -1) for half in (1, 0)]
        first = first[np.lexsort((*keys, hashes[first]))]
        return first, hashes[first]
    first = order[np.concatenate([[True], ~same])]
    return first, hashes[first]


def exact_sets(texts: list[str | None], width: int) -> list[np.ndarray]:
    """The texts' shingles as sorted distinct numbers that are equal, among these texts, for equal shingles only."""
    words, columns, counts = Words(), [], []
    for text in texts:
        ids = numbered(text, words)
        used = min(width, len(ids))
        n = len(ids) - used + 1 if used else 0
        counts.append(n)
        columns.append(np.stack([ids[k : n + k] if k < used else np.zeros(n, dtype=np.int64) for k in range(width)]))
    code = _exact(list(np.concatenate(columns, axis=1)), len(words) + 1) if columns else np.empty(0, dtype=np.int64)
    return [np.unique(part) for part in np.split(code, np.cumsum(counts)[:-1])]


def sketch(elements: np.ndarray, bins: int) -> np.ndarray:
    """``bins`` coordinates of a set with at least one element."""
    least = np.full(bins, ~U(0), dtype=np.uint64)
    done, step = 0, max(1, int(bins * (np.log(bins) + 3) / len(elements)))
    while done < 2 * bins and (least == ~U(0)).any():
        rounds = np.arange(done, min(2 * bins, done + step), dtype=np.uint64)[:, None]
        drawn = mixed(elements[None, :] ^ mixed(rounds + U(0x632BE59BD9B4E019)))
        value = (rounds << _VALUE_BITS) | (drawn & ((U(1) << _VALUE_BITS) - U(1)))
        free = (drawn >> _VALUE_BITS) * U(bins) >> U(16)
        where = np.where(rounds < bins, free, rounds - U(bins))
        np.minimum.at(least, where.ravel().astype(np.int64), value.ravel())
        done, step = done + len(rounds), step * 2
    return least


def bands(coordinates: np.ndarray, rows: int) -> np.ndarray:
    """One hash for each group of ``rows`` coordinates, different between bands."""
    grid = coordinates.reshape(-1, rows)
    out = np.arange(1, len(grid) + 1, dtype=np.uint64)
    for k in range(rows):
        out = mixed(out * U(0x9E3779B97F4A7C15) + grid[:, k])
    return out


def signature(ids: np.ndarray, first: np.ndarray, width: int, words: Words) -> bytes:
    """A name of the set: SHA-256 over the 128-bit digests of its shingles' words."""
    rows = [words.digests[ids[first + k]] for k in range(min(width, len(ids)))]
    return hashlib.sha256(np.concatenate(rows, axis=1).tobytes() if rows else b"").digest()
