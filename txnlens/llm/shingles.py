"""Word shingles of texts as 64-bit hashes, for use inside Spark tasks.

Words are runs of anything but ASCII white space, with A-Z lower-cased. A text's set holds the
distinct runs of ``k`` words; with fewer words, the whole sequence is its one member; without
words the set is empty. Equal runs have equal hashes in every process.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import xxhash

#: Characters of text worked on at once.
CHUNK_CHARS = 2_000_000

_ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def chunks(texts: Sequence[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``CHUNK_CHARS`` together; one longer text is a range of its own."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= CHUNK_CHARS:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def shingle_sets(texts: Sequence[str | None], k: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    found: list[np.ndarray] = []
    for start, end in chunks(texts):
        split = [words(t) for t in texts[start:end]]
        lengths = np.array([len(x) for x in split], dtype=np.int64)
        flat = np.empty(int(lengths.sum()), dtype=object)
        flat[:] = [w for x in split for w in x]
        codes, distinct = pd.factorize(flat)
        table = np.array([xxhash.xxh3_64_intdigest(w) for w in distinct], dtype=np.uint64)
        hashes = np.concatenate([table[codes] if len(codes) else table[:0], np.zeros(k, dtype=np.uint64)])
        powers = np.cumprod(np.full(k, _ODD, dtype=np.uint64))
        rolled = np.zeros(len(hashes) - k, dtype=np.uint64)
        for j in range(k):
            rolled += mix(hashes[j : len(hashes) - k + j] + np.uint64(j)) * powers[j]
        rolled = mix(rolled)
        place = 0
        for n in lengths.tolist():
            if n >= k:
                found.append(np.unique(rolled[place : place + n - k + 1]))
            elif n:
                # Too short for a shingle: all its words, apart from any run of k words.
                own = hashes[place : place + n] + np.arange(n, dtype=np.uint64)
                found.append(mix(np.array([(mix(own) * powers[:n]).sum() + np.uint64(n)], dtype=np.uint64)))
            else:
                found.append(np.empty(0, dtype=np.uint64))
            place += n
    return found
