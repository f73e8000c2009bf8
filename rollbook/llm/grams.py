"""Prefix keys of words: letter pieces in order of their rarity, as many as one of which two alike words must share.

A word is the set of its pieces of ``size`` neighbouring letters, its ends marked. A
slip - a letter added, dropped or changed, or two neighbours swapped - touches
``size + 1`` pieces at most, so two words within ``e`` slips of each other share all
but ``e * (size + 1)`` pieces of the larger set, and by the prefix principle one of
the ``e * (size + 1) + 1`` rarest pieces of each. Rarity is counted over all words;
pieces are counted in ``BUCKETS`` classes of their hash, which bounds what goes to
the tasks and keeps the order total.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Classes in which the frequency of pieces is counted.
BUCKETS = 1 << 16


def slips_in(length: int) -> int:
    """Slips that two words, the shorter of ``length`` letters, may be apart: one from four letters on, two from eight."""
    return 2 if length >= 8 else 1 if length >= 4 else 0


def pieces(words: list[str], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the different pieces of each word, as (index of the word, hash below 2**32)."""
    pad = "_" * (size - 1)
    padded = [f"{pad}{w}{pad}" if w else "" for w in words]
    lengths = np.array([len(w) for w in padded], np.int64)
    letters = np.frombuffer("".join(padded).encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    if not len(letters):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(words)), lengths)
    n = len(letters) - size + 1
    h = np.zeros(n, np.uint64)
    for k in range(size):
        h = (h ^ letters[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    inside = owner[:n] == owner[size - 1 :]
    found = np.unique(np.stack([owner[:n][inside], (h[inside] >> np.uint64(32)).astype(np.int64)], 1), axis=0)
    return found[:, 0], found[:, 1]


def prefixes(words: list[str], size: int, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rarest pieces of each word that decide whether a like word can exist, as (index of the word, piece); none for the empty word."""
    owner, h = pieces(words, size)
    order = np.lexsort((h, counts[h % BUCKETS], owner))
    owner, h = owner[order], h[order]
    many = np.bincount(owner, minlength=len(words))
    rank = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)
    lost = np.array([slips_in(len(w)) * (size + 1) for w in words], np.int64)
    kept = rank <= lost[owner]
    # Words of so few different pieces may share none: they meet at a key of their own.
    few = np.nonzero((many > 0) & (many <= lost))[0]
    return np.concatenate([owner[kept], few]), np.concatenate([h[kept], np.full(len(few), -1, np.int64)])


def piece_counts(rows: DataFrame, words: Callable[[pd.DataFrame], list[str]], size: int) -> np.ndarray:
    """How often each class of pieces occurs in the words that ``words`` takes from a batch of ``rows``."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(BUCKETS, np.int64)
        for pdf in batches:
            total += np.bincount(pieces(words(pdf), size)[1] % BUCKETS, minlength=BUCKETS)
        at = np.nonzero(total)[0]
        yield pd.DataFrame({"bucket": at.astype(np.int32), "n": total[at]})

    counted = rows.mapInPandas(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()  # BUCKETS rows at most
    out = np.zeros(BUCKETS, np.int64)
    out[counted["bucket"].to_numpy(np.int64)] = counted["n"].to_numpy(np.int64)
    return out


def keys_of(tags: np.ndarray, found: np.ndarray) -> np.ndarray:
    """A signed 64-bit key for each pair of a tag and a piece."""
    x = tags.astype(np.int64).view(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) + (found + 2).astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    return x.view(np.int64)
