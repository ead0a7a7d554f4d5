"""Benchmark decontamination by a distributed positional inverted index.

The corpus is indexed by blocks of documents (local inverted files): a block's row holds its
documents, and for each term the ascending positions of its postings. The index is stored. A phrase of
test terms is found in a block by intersecting posting lists, each shifted by its term's offset in the
phrase, from the block's rarest term to its most frequent one. No posting list crosses blocks, so that
a frequent term or a passage that many documents share never meets in one task. Items are taken to the
blocks in groups of a bounded number of words; a corpus pass is made for each group, and the driver and the
tasks hold one group at a time. Proximity matches are found in the same index: postings of an item's rarest
term with one of every other term of it nearby.

Edges: null texts and texts without words have no words and no hits; a null item_id counts as an
item named by the empty string; repeated items count once; repeated documents each get a row; an
empty benchmark hits nothing; an empty table gives an empty result; keys keep their type and may be null. A very long
text is a block by itself, its words found piece by piece; a very long item is taken in parts that overlap by a
window. Other columns than key and text are left out (contamination) or carried along whatever their
names (clean_documents).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulith.llm.byte_words import Words, word_hashes, words_of
from tabulith.llm.common import shared_path, small_batches, stored

WINDOW = 10
#: Words of items that go to the executors at once: 8 bytes each as they are sent, about 60 as windows in a task.
ITEM_WORDS = 500_000
INDEX = "block long, keys array<{kind}>, bounds binary, terms binary, starts binary, positions binary"


class Postings:
    """The inverted file of one block: terms, sorted, and their postings' positions in the block."""

    def __init__(self, bounds: np.ndarray, terms: np.ndarray, starts: np.ndarray, positions: np.ndarray):
        self.bounds, self.terms, self.starts, self.positions = bounds, terms, starts, positions

    @classmethod
    def of(cls, words: Words) -> Postings:
        order = np.argsort(words.hashes, kind="stable")
        terms, starts = np.unique(words.hashes[order], return_index=True)
        return cls(words.bounds.astype(np.int64), terms, np.append(starts, len(order)).astype(np.uint32), order.astype(np.uint32))

    def row(self) -> list[bytes]:
        return [self.bounds.astype(np.uint32).tobytes(), self.terms.tobytes(), self.starts.tobytes(), self.positions.tobytes()]

    @classmethod
    def read(cls, bounds, terms, starts, positions) -> Postings:
        at = lambda x, kind: np.frombuffer(x.as_buffer(), dtype=kind)
        return cls(at(bounds, np.uint32).astype(np.int64), at(terms, np.uint64), at(starts, np.uint32), at(positions, np.uint32))

    def find(self, vocabulary: np.ndarray) -> np.ndarray:
        """The place of each term in this block, or -1."""
        if not len(self.terms):
            return np.full(len(vocabulary), -1)
        at = np.minimum(np.searchsorted(self.terms, vocabulary), len(self.terms) - 1)
        return np.where(self.terms[at] == vocabulary, at, -1)

    def doc_of(self, position: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.bounds, position, side="right") - 1


class Phrases:
    """Windows of item words: vocabulary, and for each window its item and its words (-1 beyond its end). Sent as the items' word hashes; the windows are made where they are used."""

    def __reduce__(self):
        return Phrases, (self.items, self.window)

    def __init__(self, items: list[tuple[str, np.ndarray]], window: int = WINDOW):
        self.items, self.window = items, window
        self.names = [name for name, _ in items]
        words = [w for _, w in items]
        self.vocabulary = np.unique(np.concatenate(words)) if words else np.zeros(0, dtype=np.uint64)
        rows, owner, size = [], [], []
        for i, w in enumerate(words):
            ids = np.searchsorted(self.vocabulary, w).astype(np.int32)
            n = min(window, len(ids))
            if n:
                own = np.full((len(ids) - n + 1, window), -1, dtype=np.int32)
                own[:, :n] = np.lib.stride_tricks.sliding_window_view(ids, n)
                rows.append(own)
                owner.append(np.full(len(own), i))
                size.append(np.full(len(own), n))
        self.words = np.concatenate(rows) if rows else np.zeros((0, window), dtype=np.int32)
        self.owner, self.size = (np.concatenate(x).astype(np.int64) if x else np.zeros(0, dtype=np.int64) for x in (owner, size))

    def occurrences(self, index: Postings) -> tuple[np.ndarray, np.ndarray]:
        """(window, position of its first word) of all occurrences, by intersection from the rarest term on."""
        none = np.zeros(0, dtype=np.int64)
        if not len(self.words):
            return none, none
        place = np.append(index.find(self.vocabulary), -2)  # for the padding, last
        at = place[self.words]
        alive = np.flatnonzero((at != -1).all(axis=1))
        if not len(alive):
            return none, none
        at = at[alive]
        counts = np.diff(index.starts.astype(np.int64))
        often = np.where(at >= 0, counts[np.maximum(at, 0)], np.iinfo(np.int64).max)
        turn = np.argsort(often, axis=1, kind="stable")
        pick = np.arange(len(alive))
        first = turn[:, 0]
        term = at[pick, first]
        reps = counts[term]
        row = np.repeat(pick, reps)
        step = np.arange(len(row)) - np.repeat(np.cumsum(reps) - reps, reps)
        start = index.positions[index.starts[term].astype(np.int64)[row] + step].astype(np.int64) - first[row]
        # postings as one ascending list of term << 32 | position
        keys = (np.repeat(np.arange(len(counts)), counts).astype(np.int64) << 32) | index.positions.astype(np.int64)
        fits = start >= 0
        row, start = row[fits], start[fits]
        for k in range(1, turn.shape[1]):
            offset = turn[row, k]
            other = at[row, offset]
            wanted = (np.maximum(other, 0) << 32) | (start + offset)
            spot = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            fits = (other < 0) | (keys[spot] == wanted)
            row, start = row[fits], start[fits]
        within = index.doc_of(start) == index.doc_of(start + self.size[alive[row]] - 1)
        return alive[row[within]], start[within]

    def hits(self, index: Postings) -> tuple[np.ndarray, list[list[int]], list[list[str]]]:
        """For each document of the block: its number of words, the words hit, the items that occur."""
        n = len(index.bounds) - 1
        n_words, hit, items = np.diff(index.bounds), [[]] * n, [[]] * n
        window, start = self.occurrences(index)
        if len(window):
            marks = np.zeros(index.bounds[-1] + 1, dtype=np.int64)
            np.add.at(marks, start, 1)
            np.add.at(marks, start + self.size[window], -1)
            covered = np.flatnonzero(np.cumsum(marks[:-1]) > 0)
            docs = index.doc_of(covered)
            for d in np.unique(docs):
                hit[d] = (covered[docs == d] - index.bounds[d]).tolist()
            pairs = np.unique(np.stack([index.doc_of(start), self.owner[window]]), axis=1)
            for d in np.unique(pairs[0]):
                items[d] = sorted({self.names[i] for i in pairs[1][pairs[0] == d]})
        return n_words, hit, items


def proximity(index: Postings, terms: Iterable[str], span: int) -> list[tuple[int, int]]:
    """(document of the block, position of the rarest term) wherever every term has a posting less than span words away, in the same document."""
    found = index.find(np.concatenate([word_hashes(t) for t in terms]))
    if (found < 0).any():
        return []
    lists = sorted((index.positions[index.starts[t] : index.starts[t + 1]].astype(np.int64) for t in found), key=len)
    at = lists[0]
    doc = index.doc_of(at)
    keep = np.ones(len(at), dtype=bool)
    for other in lists[1:]:
        right = np.searchsorted(other, at)
        near = np.zeros(len(at), dtype=bool)
        for side in (right - 1, right):
            ok = (side >= 0) & (side < len(other))
            spot = other[np.clip(side, 0, len(other) - 1)]
            near |= ok & (np.abs(spot - at) < span) & (index.doc_of(spot) == doc)
        keep &= near
    return list(zip(doc[keep].tolist(), (at[keep] - index.bounds[doc[keep]]).tolist(), strict=True))


def item_groups(benchmark: DataFrame, key: str = "item_id", text: str = "text", limit: int = ITEM_WORDS) -> Iterator[list[tuple[str, np.ndarray]]]:
    """Items with their word hashes, in groups of at most limit words (a longer item in parts that overlap by a window but a word); one partition of items and one group are held at a time."""
    group, size = [], 0
    rows = benchmark.select(F.coalesce(F.col(key).cast("string"), F.lit("")), F.coalesce(F.col(text), F.lit(""))).distinct()
    for name, body in rows.toLocalIterator():
        words = word_hashes(body)
        part = max(limit, 2 * WINDOW)
        for lo in range(0, max(len(words) - WINDOW + 1, 1) if len(words) > part else min(len(words), 1), part - WINDOW + 1):
            own = words[lo : lo + part]
            if size and size + len(own) > limit:
                yield group
                group, size = [], 0
            group.append((name, own))
            size += len(own)
    if group:
        yield group


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """The stored positional index of all documents, a row for each block of about a megabyte."""

    def indexed(batches):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            keys = batch.column("key")
            for w in words_of(batch.column("text")):
                parts = [pa.array([x], pa.binary()) for x in Postings.of(w).row()]
                own = keys.slice(w.first, w.n)
                held = pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), own)
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), held, *parts], names=["block", "keys", "bounds", "terms", "starts", "positions"])
                number += 1

    shaped = small_batches(docs).select(F.col(key).alias("key"), F.col(text).alias("text"))
    made = shaped.mapInArrow(indexed, INDEX.format(kind=shaped.schema["key"].dataType.simpleString()))
    if path is None:
        path = shared_path(docs.sparkSession, "positional-index")
    made.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(made.schema).parquet(path)


def _of_blocks(index: DataFrame, phrases: Phrases) -> DataFrame:
    """block, place, key, n_words, hits and items of every indexed document."""

    def matched(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                postings = Postings.read(*(batch.column(c)[i] for c in ("bounds", "terms", "starts", "positions")))
                n_words, hit, items = phrases.hits(postings)
                n = len(n_words)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, batch.column("block")[i].as_py()), pa.int64()),
                        pa.array(np.arange(n), pa.int32()),
                        batch.column("keys")[i].values,
                        pa.array(n_words, pa.int64()),
                        pa.array(hit, pa.list_(pa.int32())),
                        pa.array(items, pa.list_(pa.string())),
                    ],
                    names=["block", "place", "key", "n_words", "hits", "items"],
                )

    kind = index.schema["keys"].dataType.elementType.simpleString()
    return small_batches(index).mapInArrow(matched, f"block long, place int, key {kind}, n_words long, hits array<int>, items array<string>")


def phrase_matches(index: DataFrame, groups: Iterable[list[tuple[str, np.ndarray]]], window: int = WINDOW) -> DataFrame:
    """Per indexed document: key, n_words, hits (positions of the words hit), items (those that occur). Where there are several groups, each one's hits are stored before the next group is taken."""
    groups = iter(groups)
    group, after = next(groups, []), next(groups, None)
    if after is None:
        return _of_blocks(index, Phrases(group, window)).drop("block", "place")
    passes = [stored(_of_blocks(index, Phrases(group, window)), "phrase-hits")]
    while after is not None:
        passes.append(stored(_of_blocks(index, Phrases(after, window)).filter(F.size("hits") > 0), "phrase-hits"))
        after = next(groups, None)
    every = passes[0]
    for more in passes[1:]:
        every = every.unionByName(more)
    together = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c)
    return every.groupBy("block", "place").agg(F.first("key").alias("key"), F.first("n_words").alias("n_words"), together("hits"), together("items")).drop("block", "place")


def proximity_matches(index: DataFrame, items: list[tuple[str, list[str]]], span: int) -> DataFrame:
    """item, key and position wherever a document of the stored index holds all of an item's terms near each other: for each posting of the block's rarest of them, whether every other term has one less than span words away in the same document. items: at most ITEM_WORDS terms."""
    if sum(len(terms) for _, terms in items) > ITEM_WORDS:
        raise ValueError(f"more than {ITEM_WORDS} terms: take the items in groups")

    def near(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                postings = Postings.read(*(batch.column(c)[i] for c in ("bounds", "terms", "starts", "positions")))
                for name, terms in items:
                    if found := proximity(postings, terms, span):
                        place, at = zip(*found, strict=True)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([name] * len(place), pa.string()), batch.column("keys")[i].values.take(pa.array(place, pa.int64())), pa.array(at, pa.int64())], names=["item", "key", "position"]
                        )

    kind = index.schema["keys"].dataType.elementType.simpleString()
    return small_batches(index).mapInArrow(near, f"item string, key {kind}, position long")


def contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: key, n_words, hits, items, through the stored index."""
    return phrase_matches(build_index(docs, key, text), item_groups(benchmark))


def clean_documents(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents of which no word lies in an occurrence of an item's window; rows as they came, in one pass for each group of items, stored between passes."""
    kept, before = small_batches(docs), None
    for group in item_groups(benchmark):
        if before is not None:
            kept = stored(kept, "clean-documents")
        before = group
        phrases = Phrases(group)

        def untouched(batches, phrases=phrases):
            for batch in batches:
                keep = np.ones(batch.num_rows, dtype=bool)
                for w in words_of(batch.column(text)):
                    postings = Postings.of(w)
                    _, start = phrases.occurrences(postings)
                    keep[w.first + np.unique(postings.doc_of(start))] = False
                yield batch.filter(pa.array(keep))

        kept = kept.mapInArrow(untouched, docs.schema)
    return kept


__all__ = ["Postings", "Phrases", "build_index", "clean_documents", "contamination", "item_groups", "phrase_matches", "proximity", "proximity_matches"]
