"""Sets of hashed five-word shingles, and their MinHash signatures."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

from loamline.llm.pieces import coded_spans, word_spans

WORDS = 5
_ODD = np.uint64(0x9E3779B97F4A7C15)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def shingle_sets(raw: np.ndarray, rows: np.ndarray, words: int = WORDS) -> Iterator[np.ndarray]:
    """For each text its sorted distinct 64-bit hashes of runs of ``words`` words.

    A text with fewer words has one shingle of them all, one without words none.
    """
    starts, stops = word_spans(raw, rows)
    which, distinct = coded_spans(raw, starts, stops)
    hashed = np.fromiter(
        (xxhash.xxh64_intdigest(w) for w in distinct.to_pylist()), np.uint64, len(distinct)
    )[which]
    bounds = np.searchsorted(starts, rows)
    n = max(len(hashed) - words + 1, 0)
    runs = np.zeros(n, dtype=np.uint64)
    for k in range(words):
        runs = runs * _ODD + hashed[k : k + n]
    runs = mixed(runs)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= words:
            yield np.unique(runs[a : b - words + 1])
        elif b > a:
            value = np.uint64(b - a)
            for h in hashed[a:b]:
                with np.errstate(over="ignore"):
                    value = value * _ODD + h
            yield mixed(np.array([value], dtype=np.uint64))
        else:
            yield np.zeros(0, dtype=np.uint64)


def multipliers(size: int, seed: int) -> np.ndarray:
    return mixed(np.arange(1, size + 1, dtype=np.uint64) + np.uint64(seed << 20)) | np.uint64(1)


def signature(hashes: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Least value under each hash function, as 32-bit numbers; equal sets have equal ones."""
    least = np.full(len(factors), np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(hashes), 2048):
        part = hashes[at : at + 2048, None] * factors[None, :]
        np.minimum(least, part.min(axis=0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32).view(np.int32)
