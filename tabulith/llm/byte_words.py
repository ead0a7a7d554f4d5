"""Words of Arrow string columns, found and hashed on the bytes with numpy.

A word is a run of the ASCII digits, the ASCII letters (A-Z are lower-cased) and all characters
beyond ASCII; in UTF-8 that is a class of bytes, so that texts need not be decoded.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes hashed at once: the tables of powers stay in the processor's cache. A longer document is taken by itself.
CHUNK = 1 << 19
U64 = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)

FOLD = np.arange(256, dtype=np.uint8)
FOLD[0x41:0x5B] += 0x20
FOLD[[*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = 0

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 ... base ** (n - 1), modulo 2^64."""
    held = _powers.get(base)
    if held is None or len(held) < n:
        steps = np.full(max(n, CHUNK + 1), base, dtype=U64)
        steps[0] = 1
        held = np.multiply.accumulate(steps)
        if n <= CHUNK + 1:
            _powers[base] = held
    return held[:n]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits whose output bits all depend on all input bits."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x ^= x >> U64(33)
    x *= U64(0xC4CEB9FE1A85EC53)
    x ^= x >> U64(33)
    return x


@dataclass
class Words:
    """The words of documents first ... first + n - 1 of a column."""

    first: int
    n: int
    hashes: np.ndarray  # uint64, a word
    docs: np.ndarray  # of which document (0 ... n - 1), a word
    bounds: np.ndarray  # n + 1: document d's words are bounds[d] ... bounds[d + 1] - 1


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, dtype=np.int64)
    body = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    return body[offs[0] : offs[-1]], offs - offs[0]


def words_of(column: pa.Array, chunk: int = CHUNK) -> Iterator[Words]:
    """Words by groups of documents of about chunk bytes; of a longer document, its words are found piece by piece."""
    body, offs = utf8(column)
    n, at = len(offs) - 1, 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offs, offs[at] + chunk, side="right")) - 1)
        if offs[to] - offs[at] > chunk:
            hashes = np.concatenate([_words(p, np.array([0, len(p)], dtype=np.int64), at).hashes for p in _pieces(body[offs[at] : offs[to]], chunk)])
            yield Words(at, 1, hashes, np.zeros(len(hashes), dtype=np.int64), np.array([0, len(hashes)], dtype=np.int64))
        else:
            yield _words(body[offs[at] : offs[to]], offs[at : to + 1] - offs[at], at)
        at = to


def _pieces(body: np.ndarray, chunk: int) -> Iterator[np.ndarray]:
    """A document in pieces of about chunk bytes, cut between words; a longer word stays whole."""
    at, n = 0, len(body)
    while at < n:
        to = at + chunk
        while to < n:
            gaps = np.flatnonzero(FOLD[body[to : to + chunk]] == 0)
            if len(gaps):
                to += int(gaps[0])
                break
            to += chunk
        yield body[at : min(to, n)]
        at = min(to, n)


def _words(body: np.ndarray, offs: np.ndarray, first: int) -> Words:
    n, size = len(offs) - 1, len(body)
    if not size:
        return Words(first, n, np.zeros(0, dtype=U64), np.zeros(0, dtype=np.int64), np.zeros(n + 1, dtype=np.int64))
    folded = FOLD[body]
    inside = folded != 0
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cuts = offs[1:-1][offs[1:-1] < size]  # a document's first byte begins a word even after a word's byte
    begins[cuts] = inside[cuts]
    starts = np.flatnonzero(begins)
    ends_at = inside.copy()
    ends_at[:-1] &= ~inside[1:]
    last = cuts[cuts > 0] - 1
    ends_at[last] = inside[last]
    ends = np.flatnonzero(ends_at) + 1
    sums = np.zeros(size + 1, dtype=U64)
    np.cumsum(folded * powers(BASE, size), out=sums[1:])
    hashes = mix64((sums[ends] - sums[starts]) * powers(INVERSE, size)[starts])
    bounds = np.searchsorted(starts, offs, side="left")
    docs = np.repeat(np.arange(n), np.diff(bounds))
    return Words(first, n, hashes, docs, bounds)


def word_hashes(text: str) -> np.ndarray:
    return np.concatenate([w.hashes for w in words_of(pa.array([text], pa.large_string()))] or [np.zeros(0, dtype=U64)])


def shingles(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of every run of width words; a document of fewer words, but not none, has one shingle of them all."""
    h, b = words.hashes, words.bounds
    counts = np.diff(b)
    if not len(h):
        return h, words.docs
    rolled = np.zeros(len(h), dtype=U64)
    valid = np.zeros(len(h), dtype=bool)
    full = len(h) - width + 1
    if full > 0:
        acc = np.zeros(full, dtype=U64)
        for j in range(width):
            acc = acc * U64(0x2545F4914F6CDD1D) + h[j : j + full]
        rolled[:full] = mix64(acc)
        valid[:full] = words.docs[:full] == words.docs[width - 1 :]
    for d in np.flatnonzero((counts > 0) & (counts < width)):
        acc = U64(counts[d])
        with np.errstate(over="ignore"):
            for x in h[b[d] : b[d + 1]]:
                acc = acc * U64(0x2545F4914F6CDD1D) + x
        rolled[b[d]] = mix64(np.array([acc], dtype=U64))[0]
        valid[b[d]] = True
    return rolled[valid], words.docs[valid]
