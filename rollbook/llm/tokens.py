"""A corpus encoded with a public byte-level BPE vocabulary.

Overlapping chunk encoding, for texts of every length. A text is cut into chunks
that overlap; chunks are pre-tokenised each from its own start. A pre-token depends on what
follows it only, so a chunk is right from its first certain boundary on - behind a
letter or digit run, or before a blank, every pre-token ends - and where two
neighbouring chunks have one boundary in common they agree from there: the first
such place in the overlap is where they are stitched. The pieces between stitches
are encoded on their own, all pieces of a batch of texts at once; their ids are the
text's. Where an overlap has no common boundary (one pre-token longer than it),
the chunks stay one piece, so a piece is as long as its longest pre-token needs.
Decoding concatenates the bytes of ids.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable
from functools import lru_cache
from itertools import chain, islice, pairwise

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed value: the pattern that splits text before the merges of these vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
FOLDER = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k.tiktoken"
#: Characters of a chunk, and by how many it runs into the next: less than ordinary texts have.
CHUNK = 1_000
OVERLAP = 100
#: Longest ending of PATTERN that looks at more than runs of one kind, and one.
CONTRACTION = 4
#: Ids of NULL and of empty texts: none.
EMPTY: tuple[int, ...] = ()


@lru_cache(4)
def encoding(path: str):
    """The encoding of a rank file, loaded once in each worker."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def encode(text: str | None, path: str) -> list[int]:
    """Ids of a text without special tokens; ``EMPTY`` for NULL and empty texts."""
    return encoding(path).encode_ordinary(text) if text else list(EMPTY)


def decode(ids: list[int], path: str) -> str:
    """Text of ids: their bytes, concatenated."""
    tokens = encoding(path)
    return b"".join(tokens.decode_single_token_bytes(i) for i in ids).decode("utf-8")


@lru_cache(1)
def _pattern():
    return regex.compile(PATTERN)


#: Behind these every pre-token of PATTERN ends, wherever reading began.
_CERTAIN = regex.compile(r"\p{L}(?=\P{L})|\p{N}(?=\P{N})|\S(?=\s)")


def _ends(text: str, begin: int, low: int, high: int) -> set[int]:
    """Places in [low, high] at which a pre-token ends if reading begins at ``begin``."""
    out = set()
    # What the last pre-tokens look at may lie behind ``high``.
    for m in _pattern().finditer(text, begin, min(len(text), high + CONTRACTION)):
        if m.end() > high:
            break
        if m.end() >= low:
            out.add(m.end())
    return out


def stitches(text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> list[int]:
    """Places where a text may be cut without changing its ids, one in each overlap that has one."""
    out = []
    certain = 0  # the last place before the overlap at which every reading is right
    for start in range(chunk, len(text), chunk):
        high = min(start + overlap, len(text)) - 1
        sure = _CERTAIN.search(text, start, min(len(text), high + 1))
        if not sure:
            continue
        for m in _CERTAIN.finditer(text, max(certain, start - overlap), start):
            certain = m.end()
        common = _ends(text, certain, sure.end(), high) & _ends(text, start, sure.end(), high)
        if common:
            out.append(min(common))
            certain = out[-1]
    return out


def encode_texts(texts: Iterable[str | None], path: str, chunk: int = CHUNK, overlap: int = OVERLAP, threads: int = 1) -> list[list[int]]:
    """Ids of texts by their stitched pieces; ``EMPTY`` for NULL and empty texts."""
    pieces, counts = [], []
    for text in texts:
        cuts = [0, *stitches(text, chunk, overlap), len(text)] if text else [0]
        pieces += [text[a:b] for a, b in pairwise(cuts)]
        counts.append(len(cuts) - 1)
    tokens = encoding(path)
    # One core to a task is the rule: a pool of threads pays only where a task has more.
    encoded = map(tokens.encode_ordinary, pieces) if threads == 1 else iter(tokens.encode_ordinary_batch(pieces, num_threads=threads))
    return [list(chain.from_iterable(islice(encoded, n))) if n else list(EMPTY) for n in counts]


def encode_corpus(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    folder: str = FOLDER,
    vocabulary: str = VOCABULARY,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """``<key>, ids`` of every document; NULL and empty texts have no ids, blank ones those of their blanks.

    Other columns are ignored; repeated keys each have a row. An empty table gives no
    rows. One pass over the texts without a shuffle: a text, whatever its length, is
    one row of one task, its chunks go through the encoder side by side.
    """
    path = f"{folder}/{vocabulary}"

    @F.pandas_udf("array<int>")
    def ids_of(texts: pd.Series) -> pd.Series:
        return pd.Series(encode_texts(texts, path, chunk, overlap), dtype=object)

    return documents.select(F.col(key).alias(key), ids_of(F.col(text)).alias("ids"))


def decode_corpus(encoded: DataFrame, key: str = "doc_id", folder: str = FOLDER, vocabulary: str = VOCABULARY) -> DataFrame:
    """``<key>, text`` of ids; no ids give the empty text."""
    path = f"{folder}/{vocabulary}"

    @F.pandas_udf("string")
    def text_of(ids: pd.Series) -> pd.Series:
        return pd.Series([decode(list(x), path) for x in ids])

    return encoded.select(key, text_of("ids").alias("text"))
