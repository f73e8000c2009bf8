"""Evaluation passages that leaked into training texts.

Spaced-seed hashing. Fixed masks over a stretch of words ignore some positions, so
a hit survives a changed word; dropped or added words shift later words into other
stretches, which are looked at as well. Hashes of test items are few and go to
every task in blocks of a bounded size; texts are hashed where they lie and joined
to them there. Around hits, word alignments are grown that bear isolated changed,
dropped and added words; a text leaks an item if one or two of these passages hold
at least half of the item's words.
"""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Places of a stretch that count. Weight four each; together they meet any stretch of eight words with two changes apart.
MASKS = ((0, 1, 2, 3), (0, 1, 3, 4), (0, 2, 3, 5), (0, 1, 4, 6))
SPAN = 1 + max(m[-1] for m in MASKS)
#: Words of test items that one pass takes to every task; more items go in further passes.
BLOCK_WORDS = 2_000_000
HALF = 0.5
#: Words that may lie between two matched ones of a passage, on either side.
GAP = 3
#: A passage holds this many of the item's words at least; less is a turn of phrase. Items of fewer words must stand whole.
PASSAGE = 6
#: Words around a seed, in text and item, in which its passage may go on without another seed; isolated changes leave seeds closer than that.
REACH = SPAN + GAP
#: Words of texts that are hashed at once.
BATCH_WORDS = 400_000

_INVISIBLE = re.compile("[­​-‏‪-‮⁠-⁤﻿]")
_TAG = re.compile(r"<[^<>]*>|&[a-z]{2,8};|&#\d{1,6};", re.IGNORECASE)
_WORD = re.compile(r"[^\W_]+")
#: Scripts written without blanks: each character is a word.
_UNSPACED = re.compile("([\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff])")


def words_of(text: str | None) -> list[str]:
    """Words in lower case without punctuation, markup, accents' spelling or invisible characters.

    Where a script has no blanks between words, its characters are words.
    """
    if not text:
        return []
    if not text.isascii():
        text = _UNSPACED.sub(r" \1 ", _INVISIBLE.sub("", unicodedata.normalize("NFKC", text)))
    text = re.sub(r"['’ʼ`]", "", _TAG.sub(" ", text.lower()))
    # A word parted at a line's end is one word.
    text = re.sub(r"(?<=[a-z])-[ \t]*\r?\n[ \t>|*]*(?=[a-z])", "", text)
    return _WORD.findall(text)


class _Codes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        code = self[word] = xxhash.xxh64_intdigest(word)
        return code


_codes = _Codes()


def codes_of(words: list[str]) -> np.ndarray:
    """A 64-bit code of each word."""
    return np.array([_codes[w] for w in words], np.uint64)


def _hashed(codes: np.ndarray, places: tuple[int, ...], start: int) -> np.ndarray:
    """Hashes of the codes at ``places`` of every stretch."""
    n = max(0, len(codes) - places[-1])
    h = np.full(n, start, np.uint64)
    for place in places:
        h = (h ^ codes[place : place + n]) * np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(32)
    return h


def seeds_of(codes: np.ndarray) -> list[np.ndarray]:
    """Hashes of all stretches, one array for each mask; entry k belongs to the stretch at word k."""
    return [_hashed(codes, mask, 0x9E3779B97F4A7C15 + number) for number, mask in enumerate(MASKS)]


class _Table:
    """Sorted hashes, with a bit table that rules most others out."""

    BITS = 22

    def __init__(self, hashes: np.ndarray):
        self.order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[self.order]
        self.bits = np.zeros(1 << self.BITS, bool)
        self.bits[(self.hashes >> np.uint64(64 - self.BITS)).astype(np.int64)] = True

    def find(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index in ``wanted`` and in the hashes of every match."""
        maybe = np.nonzero(self.bits[(wanted >> np.uint64(64 - self.BITS)).astype(np.int64)])[0]
        lo = np.searchsorted(self.hashes, wanted[maybe], "left")
        n = np.searchsorted(self.hashes, wanted[maybe], "right") - lo
        starts = np.repeat(lo - np.cumsum(n) + n, n)
        return np.repeat(maybe, n), self.order[starts + np.arange(len(starts))]


class ItemIndex:
    """Seeds of a block of test items with item and place of each, and items too short for passages as a whole."""

    def __init__(self, items: list[tuple[int, str]]):
        self.codes = {item: codes_of(words_of(text)) for item, text in items}
        empty = np.empty(0, np.uint64)
        hashes, owners, places = [empty], [empty.astype(np.int64)], [empty.astype(np.int64)]
        short: dict[int, list[int]] = defaultdict(list)
        for item, codes in self.codes.items():
            if len(codes) < PASSAGE:
                if len(codes):
                    short[len(codes)].append(item)
                continue
            for seeds in seeds_of(codes):
                hashes.append(seeds)
                owners.append(np.full(len(seeds), item, np.int64))
                places.append(np.arange(len(seeds)))
        self.seeds = _Table(np.concatenate(hashes))
        self.owners, self.places = np.concatenate(owners), np.concatenate(places)
        self.whole = {
            n: (_Table(np.concatenate([_hashed(self.codes[i], tuple(range(n)), n) for i in found])), np.array(found)) for n, found in short.items()
        }

    def hits(self, codes: np.ndarray) -> dict[int, list[tuple[int, int]]]:
        """``hits_in`` of one text, by item."""
        return {item: found for _, item, found in self.hits_in([codes])}

    def hits_in(self, texts: list[np.ndarray]) -> Iterator[tuple[int, int, list[tuple[int, int]]]]:
        """Index of a text, item, and the (text place, item place) of their common seeds.

        Left out are items of which the text around the common seeds cannot hold half:
        a passage stands within ``REACH`` words of its seeds.
        """
        sizes = np.array([len(t) for t in texts], np.int64)
        if not sizes.sum():
            return
        codes = np.concatenate(texts)
        text = np.repeat(np.arange(len(texts)), sizes)
        begins = np.cumsum(sizes) - sizes
        ats, ks = [], []
        for seeds, mask in zip(seeds_of(codes), MASKS):
            at, k = self.seeds.find(seeds)
            inside = text[at] == text[at + mask[-1]]
            ats.append(at[inside])
            ks.append(k[inside])
        at, k = np.concatenate(ats), np.concatenate(ks)
        if not len(at):
            return
        owner, place = self.owners[k], self.places[k]
        order = np.lexsort((at, owner, text[at]))
        at, owner, place = at[order], owner[order], place[order]
        fresh = np.ones(len(at), bool)
        fresh[1:] = (owner[1:] != owner[:-1]) | (text[at[1:]] != text[at[:-1]])
        first = np.nonzero(fresh)[0]
        # Words of text and item within reach of seeds: half of the item must lie there.
        covered = np.full(len(at), 2 * REACH + 1)
        covered[1:][~fresh[1:]] = np.minimum(np.diff(at)[~fresh[1:]], 2 * REACH + 1)
        around = np.add.reduceat(covered, first)
        lengths = np.array([len(self.codes[i]) for i in owner[first].tolist()])
        bounds = np.append(first, len(at))
        for n in np.nonzero(around >= HALF * lengths)[0]:
            lo, hi = int(bounds[n]), int(bounds[n + 1])
            inside = np.zeros(lengths[n] + 1, np.int64)
            np.add.at(inside, np.maximum(place[lo:hi] - REACH, 0), 1)
            np.add.at(inside, np.minimum(place[lo:hi] + REACH + 1, lengths[n]), -1)
            if (np.cumsum(inside)[:-1] > 0).sum() >= HALF * lengths[n]:
                t = int(text[at[lo]])
                yield t, int(owner[lo]), list(zip((at[lo:hi] - begins[t]).tolist(), place[lo:hi].tolist()))

    def stand_whole(self, texts: list[np.ndarray]) -> set[tuple[int, int]]:
        """Index of a text and short item whose words it holds in one stretch."""
        found = set()
        for n, (table, items) in self.whole.items():
            for t, codes in enumerate(texts):
                for at, k in zip(*table.find(_hashed(codes, tuple(range(n)), n))):
                    if np.array_equal(codes[at : at + n], self.codes[items[k]]):
                        found.add((t, int(items[k])))
        return found


#: Words onward in text and item from one matched word of a passage to the next.
_STEPS = [(da, db) for da in range(1, GAP + 2) for db in range(1, GAP + 2) if abs(da - db) <= 2]


def areas_of(length: int, hits: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Stretches of a text of ``length`` words around seeds, as far as a passage may go on."""
    areas: list[tuple[int, int]] = []
    for a in sorted({a for a, _ in hits}):
        lo, hi = max(0, a - REACH), min(length, a + REACH + 1)
        if areas and lo <= areas[-1][1]:
            areas[-1] = (areas[-1][0], hi)
        else:
            areas.append((lo, hi))
    return areas


def passages(text: np.ndarray, item: np.ndarray, hits: list[tuple[int, int]]) -> list[frozenset[int]]:
    """Item places that each passage of the text holds, in the item's order, largest first.

    Matched words near seeds are chained: the next is at most ``GAP`` words further
    on both sides. Chains are the longest of that kind ending at each match.
    """
    where: dict[int, list[int]] = defaultdict(list)
    near = {j for _, b in hits for j in range(b - REACH, b + REACH + 1)}
    for j, code in enumerate(item.tolist()):
        if j in near:
            where[code].append(j)
    seeded: dict[int, set[int]] = defaultdict(set)
    for a, b in hits:
        for k in range(SPAN):
            if a + k < len(text) and b + k < len(item) and text[a + k] == item[b + k]:
                seeded[a + k].add(b + k)
    found: list[frozenset[int]] = []
    for lo, hi in areas_of(len(text), hits):
        codes = text[lo:hi].tolist()
        # Matches that a chain with a seed can hold: those reached from seeds, onward or back.
        reached: dict[int, set[int]] = {}
        for way in (1, -1):
            allowed: dict[int, set[int]] = {}
            for a in range(lo, hi) if way > 0 else range(hi - 1, lo - 1, -1):
                cells, own = allowed.pop(a, None), seeded.get(a)
                if cells is None and own is None:
                    continue
                here = {b for b in where.get(codes[a - lo], ()) if (cells and b in cells) or (own and b in own)}
                if not here:
                    continue
                reached.setdefault(a, set()).update(here)
                for b in here:
                    for da, db in _STEPS:
                        allowed.setdefault(a + way * da, set()).add(b + way * db)
        # Chains that end at an item place: text place, length, number of the chain.
        ends: list[list[tuple[int, int, int]]] = [[] for _ in range(len(item))]
        chains: list[tuple[int, int]] = []  # back pointer, item place
        best: dict[int, tuple[int, int]] = {}  # root of a chain: length, end
        roots: list[int] = []
        seeds_in: list[bool] = []
        for a in sorted(reached):
            fresh = []
            for b in sorted(reached[a]):
                length, back = 1, -1
                for pb in range(max(0, b - GAP - 1), b):
                    for pa, n, k in ends[pb]:
                        if n >= length and a - pa <= GAP + 1 and abs((b - pb) - (a - pa)) <= 2:
                            length, back = n + 1, k
                k = len(chains)
                chains.append((back, b))
                roots.append(roots[back] if back >= 0 else k)
                seeds_in.append((seeds_in[back] if back >= 0 else False) or (a in seeded and b in seeded[a]))
                fresh.append((b, length, k))
                if seeds_in[k] and length > best.get(roots[k], (0, 0))[0]:
                    best[roots[k]] = (length, k)
            for b, length, k in fresh:
                ends[b] = [x for x in ends[b] if a - x[0] <= GAP] + [(a, length, k)]
        for length, k in best.values():
            if length >= PASSAGE:
                held = []
                while k >= 0:
                    k, b = chains[k]
                    held.append(b)
                found.append(frozenset(held))
    return sorted(found, key=len, reverse=True)


def held_share(text: np.ndarray, item: np.ndarray, hits: list[tuple[int, int]]) -> float:
    """Largest share of the item's words in one or two passages of the text."""
    if not len(item):
        return 0.0
    # Two stretches around seeds with fewer words in common than half: no need to align.
    near = {j for _, b in hits for j in range(max(0, b - REACH), min(len(item), b + REACH + 1))}
    codes = item[sorted(near)].tolist()
    common = sorted(sum(map(set(text[lo:hi].tolist()).__contains__, codes)) for lo, hi in areas_of(len(text), hits))
    if sum(common[-2:]) < HALF * len(item):
        return 0.0
    found: list[frozenset[int]] = []
    # A passage inside a larger one adds nothing to any other.
    for one in dict.fromkeys(passages(text, item, hits)):
        if not any(one <= larger for larger in found):
            found.append(one)
    best = 0
    for k, one in enumerate(found):
        best = max(best, len(one))
        for other in found[k + 1 :]:
            if len(one) + len(other) <= best:
                break
            best = max(best, len(one | other))
    return best / len(item)


_built: list[tuple[list, ItemIndex]] = []


def _index_of(block: list[tuple[int, str]]) -> ItemIndex:
    """The index of a block, built once in a worker."""
    if not _built or _built[0][0] is not block:
        _built[:] = [(block, ItemIndex(block))]
    return _built[0][1]


def leaks(documents: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id") -> DataFrame:
    """Documents that hold at least half of a test item's words: ``<key>, <item>, share``.

    NULL, empty and blank texts and items match nothing; an item of fewer than
    ``PASSAGE`` words must stand whole; copies each count; other columns are ignored.
    """
    spark = documents.sparkSession
    texts = documents.where(F.trim(text) != "").select(F.col(key).cast("long").alias(key), F.col(text).alias("text"))
    found = None
    for block in item_blocks(items, item, text):
        shared = spark.sparkContext.broadcast(block)  # at most BLOCK_WORDS words

        def run(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            index = _index_of(shared.value)
            for pdf in batches:
                rows, group, ids, words = [], [], [], 0
                for n, (i, t) in enumerate(zip(pdf[key], pdf["text"]), 1):
                    group.append(codes_of(words_of(t)))
                    ids.append(i)
                    words += len(group[-1])
                    if words > BATCH_WORDS or n == len(pdf):
                        for at, number, hits in index.hits_in(group):
                            share = held_share(group[at], index.codes[number], hits)
                            if share >= HALF:
                                rows.append((ids[at], number, share))
                        rows += [(ids[at], number, 1.0) for at, number in sorted(index.stand_whole(group))]
                        group, ids, words = [], [], 0
                yield pd.DataFrame(rows, columns=[key, item, "share"])

        part = texts.mapInPandas(run, f"{key} long, {item} long, share double")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], f"{key} long, {item} long, share double")
    return found


def item_blocks(items: DataFrame, item: str, text: str) -> Iterator[list[tuple[int, str]]]:
    """Test items in blocks of ``BLOCK_WORDS`` words, read one partition at a time."""
    block, words = [], 0
    rows = items.where(F.trim(text) != "").select(F.col(item).cast("long").alias("i"), F.col(text).alias("t"))
    for r in rows.toLocalIterator():
        n = len(r.t.split())
        if block and words + n > BLOCK_WORDS:
            yield block
            block, words = [], 0
        block.append((r.i, r.t))
        words += n
    if block:
        yield block
