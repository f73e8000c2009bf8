"""Text decoded with a wrong character set: found, and restored where it can be.

Noisy-channel decoding. A span of text is taken back to the bytes it may have been
read from - a lattice, as a lost byte (the replacement sign, or a question mark
inside damage) may have been any - and the reading of those bytes that the corpus
makes most likely is found by Viterbi search, keeping the text as it is being one
of the readings. Character and word frequencies are counted over the whole corpus.
A text is damaged where another reading beats the given one by a clear margin.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.session import cut

LOST = "�"
#: Character sets a text may wrongly have been read in, and true ones of one or two bytes besides UTF-8.
READ_AS = ("cp1252", "latin_1", "mac_roman", "cp437", "cp850", "cp1251", "koi8_r", "cp1250", "iso8859_15", "mac_cyrillic", "cp866")
TRUE_BYTES = ("cp1252", "cp1251", "koi8_r", "gbk", "big5", "mac_roman", "cp437", "cp1258", "cp866")
#: Nats by which another reading must win: per step for a decoded character, per line for a whole line.
STEP_COST = 4.0
LINE_MARGIN = 9.0
#: The same for a line that is damaged for sure.
LEAST_GAIN = 4.0
#: Counts are kept for characters (bounded by Unicode) and for words in at least this share of texts.
WORD_SHARE = 1 / 50_000
WORD_LEAST = 3
MAX_DEPTH = 3


@lru_cache
def bytes_of(codec: str) -> dict[str, int]:
    """Byte that was read as each character above ASCII; bytes without one show as control characters."""
    out = {}
    for b in range(128, 256):
        try:
            out[bytes([b]).decode(codec)] = b
        except UnicodeDecodeError:
            pass
    for b in range(128, 160):
        out.setdefault(chr(b), b)
    return out


@lru_cache
def _to_bytes(codec: str) -> dict[int, str]:
    """Translation of characters to their bytes as characters up to 255; what has no byte becomes a mark."""

    class Table(dict):
        def __missing__(self, code):
            return "\x00"

    table = Table({ord(c): chr(b) for c, b in bytes_of(codec).items()})
    table.update({k: chr(k) for k in range(128)})
    table[ord(LOST)] = "\x01"
    table[ord("?")] = "\x02"
    return table


@lru_cache
def _leads(codec: str) -> frozenset[str]:
    """Characters that may have been the first byte of two or more."""
    return frozenset(c for c, b in bytes_of(codec).items() if 0xC2 <= b <= 0xF4) | {LOST}


#: Two to four bytes of UTF-8, some of which may be lost.
_UTF8 = re.compile(
    "[\xc2-\xdf][\x80-\xbf\x01\x02]|[\xe0-\xef][\x80-\xbf\x01\x02]{2}|[\xf0-\xf4][\x80-\xbf\x01\x02]{3}|\x01[\x80-\xbf]{1,3}"
)
_HIGH = re.compile(r"[^\x00-\x7f]")
#: Runs in which bytes of one character may stand: neighbours above ASCII, or lost ones among them.
_SPAN = re.compile(r"[^\x00-\x7f](?:[^\x00-\x7f]|\?)+|\?[^\x00-\x7f](?:[^\x00-\x7f]|\?)*")
_LATIN_RUN = re.compile("[\x80-\xff–-™ŒœŠšŽžŸƒˆ˜]{4,}")


@lru_cache(100_000)
def script_of(c: str) -> int:
    """A coarse script: Latin, Greek, Cyrillic, East Asian, signs, else the block."""
    k = ord(c)
    if 0xC0 <= k < 0x250 and k not in (0xD7, 0xF7) or 0x1E00 <= k < 0x1F00:
        return 1
    if 0x370 <= k < 0x400:
        return 2
    if 0x400 <= k < 0x530:
        return 3
    if 0x2E80 <= k < 0xA000 or 0xFF00 <= k < 0xFFF0:
        return 4
    if k < 0xC0 or k in (0xD7, 0xF7) or 0x2000 <= k < 0x2C00:
        return 5
    return 0x1000 + (k >> 8)


class Frequencies:
    """Corpus frequencies: log probability of characters, common words, and characters by partly known bytes."""

    def __init__(self, chars: dict[str, int], words: dict[str, int]):
        total = max(1, sum(chars.values()))
        self.floor = -math.log(total) - 3.0
        self.char = {c: math.log(n / total) for c, n in chars.items() if n > 0}
        scripts: Counter = Counter()
        for c, n in chars.items():
            if ord(c) > 127:
                scripts[script_of(c)] += n
        high = max(1, sum(scripts.values()))
        #: Log probability of turning to a script, and of a character within its script.
        self.turn = {k: math.log(n / high) for k, n in scripts.items()}
        self.inside = {c: math.log(n / scripts[script_of(c)]) for c, n in chars.items() if ord(c) > 127 and n > 0}
        self.words = words
        self.gains: dict[str, np.ndarray] = {}
        self.by_bytes: dict[tuple, tuple[float, str]] = {}
        for c, p in self.char.items():
            if ord(c) < 128 or c == LOST or 128 <= ord(c) < 160:
                continue
            raw = c.encode("utf-8", "ignore")
            for mask in range(1, 1 << len(raw)):
                key = tuple(b if mask >> k & 1 else None for k, b in enumerate(raw))
                if p > self.by_bytes.get(key, (-1e9, ""))[0]:
                    self.by_bytes[key] = (p, c)
        self.gaps: dict[str, tuple[int, str]] = {}
        for w, n in words.items():
            high = [k for k, c in enumerate(w) if ord(c) > 127]
            if 1 <= len(high) <= 6:
                key = "".join(LOST if ord(c) > 127 else c for c in w)
                if n > self.gaps.get(key, (0, ""))[0]:
                    self.gaps[key] = (n, w)

    def of(self, c: str) -> float:
        return self.char.get(c, self.floor)

    def step(self, c: str, before: int) -> float:
        """Log probability of a character above ASCII after one of script ``before``."""
        if c == LOST:
            return self.floor - 2
        k = script_of(c)
        return (0.0 if k == before else self.turn.get(k, self.floor)) + self.inside.get(c, self.floor)

    def cost(self, text: str) -> float:
        """Log probability of the characters above ASCII of a text."""
        total, before = 0.0, 0
        for c in text:
            if ord(c) > 127:
                total += self.step(c, before)
                before = script_of(c)
        return total


def _viterbi(text: str, raw: str, freq: Frequencies, step: float = STEP_COST) -> tuple[float, str]:
    """Best reading of a span: each place keeps its character, or two to four become one of UTF-8. Gain and text."""
    n = len(text)
    best = [0.0] + [-1e18] * n
    script = [0] * (n + 1)
    back: list[tuple[int, str]] = [(0, "")] * (n + 1)
    for i in range(n):
        if best[i] < -1e17:
            continue
        c = text[i]
        keep = best[i] + (0.0 if ord(c) < 128 else freq.step(c, script[i]))
        if keep > best[i + 1]:
            best[i + 1], back[i + 1], script[i + 1] = keep, (i, c), script_of(c) if ord(c) > 127 else script[i]
        for size in (2, 3, 4):
            if i + size > n:
                break
            codes = [ord(x) for x in raw[i : i + size]]
            key = tuple(None if b in (1, 2) else b for b in codes)
            if 0 in codes or all(b is None for b in key):
                continue
            if None in key:
                found = freq.by_bytes.get(key, (0.0, ""))[1]
            else:
                try:
                    found = bytes(codes).decode("utf-8")
                except (UnicodeDecodeError, ValueError):
                    continue
            if len(found) == 1 and found in freq.inside:
                # A question mark is rarely a lost byte.
                score = best[i] + freq.step(found, script[i]) - step - 3.0 * codes.count(2)
                if score > best[i + size]:
                    best[i + size], back[i + size], script[i + size] = score, (i, found), script_of(found)
    out, i = [], n
    while i:
        i, piece = back[i]
        out.append(piece)
    return best[n], "".join(reversed(out))


def _as_utf8(line: str, freq: Frequencies) -> tuple[float, str]:
    """Best gain over the sets the line may have been read in; spans of possible UTF-8 only are searched."""
    top = (0.0, line)
    spans = [(m.start(), m.end(), m[0]) for m in _SPAN.finditer(line)]
    if not spans:
        return top
    letters = set().union(*(x[2] for x in spans))
    best_codec = None
    for codec in READ_AS:
        if letters.isdisjoint(_leads(codec)):
            continue
        gain, _ = _decode_spans(line, spans, codec, freq, STEP_COST)
        if gain > top[0]:
            top, best_codec = (gain, line), codec
    if best_codec:
        # Where a set was misread once in a line, the next character of it costs nothing.
        top = (top[0], _decode_spans(line, spans, best_codec, freq, 0.0)[1])
    return top


def _decode_spans(line: str, spans: list[tuple[int, int, str]], codec: str, freq: Frequencies, step: float) -> tuple[float, str]:
    """Gain and text if the line was read in ``codec``."""
    gain, out, last = 0.0, [], 0
    for a, b, span in spans:
        raw = span.translate(_to_bytes(codec))
        if not _UTF8.search(raw):
            continue
        score, text = _viterbi(span, raw, freq, step)
        won = score - freq.cost(span)
        if won > 0 and text != span:
            gain += won
            out += [line[last:a], text]
            last = b
    return gain, "".join(out) + line[last:]


_PAIRS = [(c, t) for c in READ_AS for t in TRUE_BYTES if c != t and t not in ("gbk", "big5")]


def _byte_gains(c: str, freq: Frequencies) -> np.ndarray:
    """What each pair of sets would win by reading a character anew."""
    if (known := freq.gains.get(c)) is None:
        known = np.full(len(_PAIRS), -50.0)
        for k, (codec, true) in enumerate(_PAIRS):
            if c == LOST:
                known[k] = 0.0
            elif (b := bytes_of(codec).get(c)) is not None:
                try:
                    known[k] = freq.of(bytes([b]).decode(true)) - freq.of(c)
                except UnicodeDecodeError:
                    pass
        freq.gains[c] = known
    return known


def _word_gain(old: str, new: str, freq: Frequencies) -> float | None:
    """What the words that a new reading changes win by their corpus frequencies, in nats; None unless at least half of them become more common."""
    better = seen = 0
    gain = 0.0
    for a, b in zip(old.split(), new.split()):
        if a == b:
            continue
        words = [w for w in _LETTERS.findall(b.lower()) if not w.isascii() and len(w) >= 3]
        if not words:
            continue
        seen += 1
        before = max([freq.words.get(w, 0) for w in _LETTERS.findall(a.lower()) if len(w) >= 3] or [0])
        after = max(freq.words.get(w, 0) for w in words)
        better += after > 2 * before
        gain += math.log((after + 1) / (before + 1))
    return gain if seen and 2 * better >= seen else None


def _as_bytes(line: str, freq: Frequencies) -> tuple[float, str]:
    """Gain and text of the line's upper characters read in another set of one or two bytes.

    Of all pairs of sets that win by characters, each distinct reading is weighed by characters and words.
    """
    top = (0.0, line)
    high = Counter(_HIGH.findall(line))
    gains = sum(_byte_gains(c, freq) * n for c, n in high.items())
    best, tried = -math.inf, {line}
    for k in np.argsort(-gains):
        if gains[k] < LEAST_GAIN:
            break
        codec, true = _PAIRS[k]
        table = bytes_of(codec)
        try:
            text = line.translate({ord(c): bytes([table[c]]).decode(true) for c in high if c in table})
        except UnicodeDecodeError:  # a byte that the other set does not have
            continue
        if text in tried:
            continue
        tried.add(text)
        words = _word_gain(line, text, freq)
        if words is not None and gains[k] + words > best:
            best, top = gains[k] + words, (float(gains[k]), text)
    if _LATIN_RUN.search(line):
        before = freq.cost(line)
        for codec in ("cp1252", "latin_1"):
            table = bytes_of(codec)
            if not all(c in table for c in high):
                continue
            raw = b"".join(bytes([table[c]]) if c in table else c.encode("ascii", "replace") for c in line)
            for true in ("gbk", "big5"):
                text = raw.decode(true, "replace")
                after = freq.cost(text) - before
                if after > top[0] and LOST not in text:
                    top = (after, text)
    return top


def _fill_lost(line: str, freq: Frequencies) -> str:
    """Words with lost characters completed from common words."""

    def fill(m: re.Match) -> str:
        word = m[0]
        for key, case in ((word, str), (word.lower(), str.capitalize if word[:1].isupper() else str), (word.lower(), str.upper)):
            if found := freq.gaps.get(key):
                return case(found[1])
        return word

    return re.sub(r"[\w" + LOST + r"]*" + LOST + r"[\w" + LOST + r"]*", fill, line)


_LETTERS = re.compile(r"[^\W\d_]+")
#: Controls of the second set never stand in proper text, except the line sign.
_CONTROL = re.compile("[\x80-\x84\x86-\x9f]")
_SIGNS = {chr(b): bytes([b]).decode("cp1252") for b in range(128, 160) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)}


def repair(text: str | None, freq: Frequencies) -> tuple[bool, str]:
    """Whether a text was read in a wrong character set, wholly or in places, and its most likely original.

    NULL, empty, blank and ASCII texts are sound. What cannot be restored stays as it is.
    """
    if not text or text.isascii():
        return False, text or ""
    damaged = False
    lines = text.split("\n")
    for k, line in enumerate(lines):
        if line.isascii():
            continue
        bad = LOST in line or bool(_CONTROL.search(line))
        for _ in range(MAX_DEPTH):
            gain, better = _as_utf8(line, freq)
            least = 1.0
            if gain < least:
                gain, better = _as_bytes(line, freq)
                least = LEAST_GAIN if bad else LINE_MARGIN
            if gain < least:
                break
            bad, line = True, better
            if line.isascii():
                break
        if bad:
            damaged = True
            # A control that is left was a sign of the Western set.
            line = _CONTROL.sub(lambda m: _SIGNS.get(m[0], m[0]), line)
            lines[k] = _fill_lost(line, freq) if LOST in line else line
    return damaged, "\n".join(lines)


def corpus_frequencies(documents: DataFrame, text: str = "text") -> tuple[dict[str, int], dict[str, int]]:
    """Characters above ASCII (and the number of others) and common words with such characters, over all distinct texts.

    Characters are bounded by Unicode, words by the share of texts they need.
    """
    texts = documents.where(F.col(text).rlike(r"[^\x00-\x7f]")).select(F.col(text).alias("text"))
    distinct = texts.groupBy(F.xxhash64("text").alias("h")).agg(F.first("text").alias("text"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            chars: Counter = Counter()
            words: Counter = Counter()
            texts_here = 0
            for t in pdf["text"]:
                texts_here += 1
                high = _HIGH.findall(t)
                chars.update(high)
                chars[" "] += len(t) - len(high)
                words.update({w.lower() for w in re.findall(r"[^\W\d_]+", t) if 3 <= len(w) <= 30 and not w.isascii()})
            rows = [("c", c, n) for c, n in chars.items()] + [("w", w, n) for w, n in words.items()] + [("n", "", texts_here)]
            yield pd.DataFrame(rows, columns=["kind", "key", "n"])

    # Written once: the number of texts decides which words are kept.
    counts = cut(distinct.select("text").mapInPandas(count, "kind string, key string, n long").groupBy("kind", "key").agg(F.sum("n").alias("n")))
    totals = counts.where("kind = 'n'").first()
    least = max(WORD_LEAST, (totals.n if totals else 0) * WORD_SHARE)
    kept = counts.where((F.col("kind") == "c") | ((F.col("kind") == "w") & (F.col("n") >= least))).collect()
    return {r.key: r.n for r in kept if r.kind == "c"}, {r.key: r.n for r in kept if r.kind == "w"}


def repaired(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Damaged documents with their most likely original: ``key, restored``.

    NULL, empty and blank texts are sound; copies each count; other columns are ignored.
    """
    chars, words = corpus_frequencies(documents, text)
    shared = documents.sparkSession.sparkContext.broadcast((chars, words))  # bounded, see corpus_frequencies
    suspects = documents.where(F.col(text).rlike(r"[^\x00-\x7f]")).select(F.col(key).cast("long").alias(key), F.col(text).alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        freq = Frequencies(*shared.value)
        for pdf in batches:
            rows = []
            for i, t in zip(pdf[key], pdf["text"]):
                damaged, restored = repair(t, freq)
                if damaged:
                    rows.append((i, restored))
            yield pd.DataFrame(rows, columns=[key, "restored"])

    return suspects.mapInPandas(run, f"{key} long, restored string")
