"""Near-duplicates by DartMinHash: weighted signatures, banded joining, exact check, components.

A document is a weighted set: its five-word shingles with their counts. Every unit of weight of a
shingle has a strip of the plane (weight x rank); hashed darts fall on the strip at rate one per unit
of rank, the same ones wherever the shingle occurs. A dart lies in the document's region if its weight
is below the shingle's count and its rank below the bound t / total weight, t = k (ln k + 3). Each dart
has a coordinate, by hash; the earliest dart of each of the k coordinates makes the signature, whose
coordinates agree between two documents with the probability of their weighted Jaccard similarity.
Documents with a coordinate still empty are thrown again with twice the bound. Work is in proportion
to the number of words plus t.

Joining: bands of ROWS coordinates are bucket keys; two texts at the threshold miss each other in all of them
with a probability of 3e-6. Documents with equal texts are one node. In every bucket the members are compared
with one leader, the member whose buckets are the fullest (the text that the others were made from, where
there is one); pairs whose signatures agree on too few coordinates for the threshold (by more than six
standard deviations) are put aside, all others are checked on the whole shingle multisets. Buckets that are
one component then are done. In the others, members are dealt by hash to blocks of about BLOCK, and each pair of
blocks is compared by a task of its own, on the whole multisets, which gives only links that join components.
No bucket is capped, none meets in one task, and copies of one text are never paired with one another.

Buckets with the same members are compared once, in whichever band, and a block holds at most about BLOCK members
and BLOCK_BYTES of their multisets.

Edges: null texts and texts without words are near-duplicates of nothing, but equal word-less texts
are one class; fewer than five words make one shingle; repeated rows are copies of each other, of which one is
kept; ties go to the least key; an empty table gives an empty result. A very long text is one node with its whole
multiset (4 bytes a word). Columns named class_id or kept are replaced, others are carried along whatever
their names; null keys are least.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulith.llm.byte_words import U64, Words, mix64, shingles, words_of
from tabulith.llm.common import boxed, discard, small_batches, stored, unboxed

WIDTH, THRESHOLD = 5, 0.8
BANDS, ROWS = 32, 5
K = BANDS * ROWS
#: Members of a block, and bytes of their multisets; a task compares two blocks.
BLOCK, BLOCK_BYTES = 256, 64 << 20
#: Rows alike in all columns that one task counts, about.
ALIKE = 10_000
EMPTY = U64(0xFFFFFFFFFFFFFFFF)
#: Cumulative Poisson(1) probabilities: how many darts a unit cell holds, by a uniform 32-bit number.
POISSON = np.array([math.floor(sum(math.exp(-1) / math.factorial(i) for i in range(n + 1)) * 2**32) for n in range(12)], dtype=np.uint64)


def weighted(words: Words, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """(strip, document): a strip for every unit of weight, the j-th copy of a shingle in a document being a strip of its own."""
    h, docs = shingles(words, width)
    if not len(h):
        return h, docs
    order = np.lexsort((h, docs))
    h, docs = h[order], docs[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (docs[1:] != docs[:-1])
    at = np.arange(len(h))
    copy = at - np.maximum.accumulate(np.where(new, at, 0))
    return mix64(h + U64(0x9E3779B97F4A7C15) * copy.astype(U64)), docs


def darts(strips: np.ndarray, docs: np.ndarray, n: int, k: int = K) -> np.ndarray:
    """n x k signatures; EMPTY rows for documents without strips."""
    best = np.full(n * k, EMPTY, dtype=U64)
    names = np.full(n * k, EMPTY, dtype=U64)
    weight = np.bincount(docs, minlength=n).astype(np.float64)
    bound = np.where(weight > 0, k * (math.log(k) + 3) / np.maximum(weight, 1), 0.0)
    low = np.zeros(n)
    todo = weight > 0
    while todo.any():
        use = todo[docs]
        s, d = strips[use], docs[use]
        first, last = np.floor(low[d]).astype(np.int64), np.ceil(bound[d]).astype(np.int64)
        for lo in range(0, len(s), 1 << 17):  # cells at once: bounded memory however large the bound is
            part = slice(lo, lo + (1 << 17))
            _throw(s[part], d[part], first[part], last[part], bound, best, names, k)
        todo = todo & (best.reshape(n, k) == EMPTY).any(axis=1)
        low[todo] = np.floor(bound[todo])
        bound[todo] *= 2
    return names.reshape(n, k)


def _throw(s, d, first, last, bound, best, names, k):
    """All darts of the strips' cells of ranks first ... last - 1 that lie below the bound."""
    cells = last - first
    for lo, hi in _slices(cells, 1 << 18):
        reps = cells[lo:hi]
        strip, doc = np.repeat(s[lo:hi], reps), np.repeat(d[lo:hi], reps)
        step = np.arange(len(strip)) - np.repeat(np.cumsum(reps) - reps, reps)
        rank = np.repeat(first[lo:hi], reps) + step
        cell = mix64(strip + U64(0xD6E8FEB86659FD93) * (rank.astype(U64) + U64(1)))
        count = np.searchsorted(POISSON, cell >> U64(32), side="right")
        most = int(count.max()) if len(count) else 0
        for j in range(most):
            has = count > j
            dart = mix64(cell[has] + U64((0xA0761D6478BD642F * (j + 1)) % (1 << 64)))
            # the rank in 2^-24 units within the cell, so that ranks compare as integers
            exact = (rank[has].astype(U64) << U64(24)) | (dart >> U64(40))
            dd = doc[has]
            ok = exact.astype(np.float64) < bound[dd] * 2.0**24
            dart, exact, dd = dart[ok], exact[ok], dd[ok]
            slot = dd * k + (mix64(dart ^ U64(0x5851F42D4C957F2D)) % U64(k)).astype(np.int64)
            was = best[slot]
            np.minimum.at(best, slot, exact)
            hit = exact == best[slot]
            names[slot[hit & (exact < was)]] = EMPTY
            np.minimum.at(names, slot[hit], dart[hit])


def _slices(cells: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    ends = np.cumsum(cells)
    at = 0
    while at < len(cells):
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield at, to
        at = to


def signatures(words: Words, k: int = K) -> np.ndarray:
    strips, docs = weighted(words)
    return darts(strips, docs, words.n, k)


def band_keys(sig: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """n x bands int64; the band's number is part of the key."""
    out = np.zeros((len(sig), bands), dtype=U64)
    for b in range(bands):
        acc = np.full(len(sig), U64(b + 1))
        for r in range(rows):
            acc = mix64(acc * U64(0x2545F4914F6CDD1D) + sig[:, b * rows + r])
        out[:, b] = acc
    return out.view(np.int64)


def _list(values: np.ndarray, type_: pa.DataType) -> pa.ListArray:
    n, k = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, n * k + 1, k, dtype=np.int32)), pa.array(values.reshape(-1), type_))


def _binary(rows: list[bytes]) -> pa.Array:
    return pa.array(rows, pa.binary())


def _signed(batches):
    for batch in batches:
        for w in words_of(batch.column("text")):
            sig = signatures(w)
            some = np.diff(w.bounds) > 0
            keys = band_keys(sig)
            small = (sig >> U64(56)).astype(np.uint8)
            at = np.flatnonzero(some)
            yield pa.RecordBatch.from_arrays(
                [batch.column("node").slice(w.first, w.n).take(pa.array(at)), _list(keys[at], pa.int64()), _binary([small[i].tobytes() for i in at])],
                names=["node", "bands", "sig"],
            )


def _measured(batches):
    for batch in batches:
        for w in words_of(batch.column("text")):
            strips, docs = weighted(w)
            cut = np.searchsorted(docs, np.arange(w.n + 1))
            short = (strips >> U64(32)).astype(np.uint32)
            blobs = [np.sort(short[cut[i] : cut[i + 1]]).tobytes() for i in range(w.n)]
            yield pa.RecordBatch.from_arrays([batch.column("node").slice(w.first, w.n), _binary(blobs)], names=["node", "strips"])


def _agreeing(batches):
    """Pairs whose signatures don't exclude the threshold."""
    floor = K * (THRESHOLD - 6 * math.sqrt(THRESHOLD * (1 - THRESHOLD) / K))
    for batch in batches:
        a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint8).reshape(-1, K) for c in ("sig_a", "sig_b"))
        keep = pa.array((a == b).sum(axis=1) >= floor)
        yield batch.select(["a", "b"]).filter(keep)


def _checked(batches):
    """Pairs whose weighted Jaccard similarity is THRESHOLD or more."""
    for batch in batches:
        good = []
        for x, y in zip(batch.column("strips_a"), batch.column("strips_b"), strict=True):
            a, b = np.frombuffer(x.as_buffer(), dtype=np.uint32), np.frombuffer(y.as_buffer(), dtype=np.uint32)
            if min(len(a), len(b)) < THRESHOLD * max(len(a), len(b)):
                good.append(False)
                continue
            both = np.sort(np.concatenate([a, b]), kind="stable")
            shared = int((both[1:] == both[:-1]).sum())
            good.append(shared >= THRESHOLD * (len(a) + len(b) - shared))
        yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))


def components(edges: DataFrame, name: str) -> DataFrame:
    """node, label (the least node of its component) of all nodes that edges (a, b) touch.

    Labels sink along edges and by pointer jumping until nothing changes; each turn is a stored table.
    """
    both = stored(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), f"{name}-edges")
    labels = stored(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label")), f"{name}-labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("label").alias("m"))
        sunk = labels.join(near.withColumnRenamed("a", "node"), "node", "left").select("node", F.col("label").alias("was"), F.least("label", "m").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("up"))
        after = stored(sunk.join(jump, "label", "left").select("node", "was", F.least("label", "up").alias("label")), f"{name}-labels")
        changed = after.filter(F.col("was") != F.col("label")).limit(1).count()
        discard(labels)
        labels = after
        if not changed:
            discard(both)
            out = labels.select("node", "label")
            out._stored_at = labels._stored_at
            return out
        labels = after.select("node", "label")
        labels._stored_at = after._stored_at


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with class_id, the least key of the document's class (its own where it is alone), and kept, true for one row of each class."""
    node, whole = F.xxhash64(F.col(text)), F.unhex(F.md5(F.col(text)))
    texts = small_batches(docs).filter(F.col(text).isNotNull()).select(node.alias("node"), F.col(text).alias("text"))
    signed = texts.mapInArrow(_signed, "node long, bands array<long>, sig binary")
    one = stored(signed.groupBy("node").agg(F.first("bands").alias("bands"), F.first("sig").alias("sig")), "dart-nodes")
    sigs = one.select("node", "sig")
    labels = _linked(texts, sigs, one.select("node", F.explode("bands").alias("band")))
    discard(one)
    # a row is known by its key and the hash of its columns, which stay as they are when a lost scan is read again
    columns = docs.columns
    others = [c for c in columns if c not in ("class_id", "kept")]
    row = F.struct(F.col(key).alias("key"), F.xxhash64(*[F.col(f"`{c}`") for c in others]).alias("hash"))
    base = boxed(docs, _null=F.col(text).isNull(), _node=node, _whole=whole, _least=row)
    copies = base.filter(~F.col("_null")).groupBy("_node", "_whole", "_least").agg(F.count(F.lit(1)).alias("n"))
    nodes = copies.groupBy("_node", "_whole").agg(F.min(F.struct("_least", "n")).alias("_first"))
    made = [] if labels is None else [labels]
    if labels is not None:
        made.append(nodes := stored(nodes, "dart-least"))
        nodes = nodes.join(labels.withColumnRenamed("node", "_node"), "_node", "left")
    else:
        nodes = nodes.withColumn("label", F.lit(None).cast("long"))
    # a text without links is its own class, under its whole digest
    made.append(nodes := stored(nodes.withColumn("_class", F.coalesce(F.col("label").cast("string"), F.hex("_whole"))).select("_whole", "_first", "_class"), "dart-labelled"))
    made.append(classes := stored(nodes.groupBy("_class").agg(F.min("_first").alias("_head")), "dart-classes"))
    repeated = classes.filter("_head.n > 1").limit(1).count()
    named = stored(nodes.join(classes, "_class").select(F.col("_whole").alias("_of"), "_head"), "dart-named")
    discard(*made)
    found = base.join(named, F.col("_whole") == F.col("_of"), "left").withColumn("_head", F.coalesce("_head", F.struct("_least", F.lit(1).cast("long").alias("n"))))
    found = found.select("_row", "_head", (F.col("_head._least") == F.col("_least")).alias("_kept"))
    out = lambda df: unboxed(df, columns, class_id=F.col("_head._least.key"), kept=F.col("_kept"))
    if not repeated:
        return out(found)
    # of rows that are alike in all columns one is kept: counted in parts, so that many of them never meet in one task, and of the least part's one is set apart
    alike = F.col("_kept") & (F.col("_head.n") > 1)
    part = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.ceil(F.col("_head.n") / ALIKE))
    parts = stored(found.filter(alike).withColumn("_part", part).groupBy("_head", "_part").agg(F.count(F.lit(1)).alias("_n"), F.first("_row").alias("_row")), "dart-alike")
    least = parts.groupBy("_head").agg(F.min("_part").alias("_least_part"))
    marked = parts.join(least, "_head").withColumn("_kept", F.explode(F.transform(F.sequence(F.lit(1), F.col("_n")), lambda i: (F.col("_part") == F.col("_least_part")) & (i == 1))))
    return out(found.filter(~alike).unionByName(marked.select("_row", "_head", "_kept")))


def _linked(texts: DataFrame, sigs: DataFrame, members: DataFrame) -> DataFrame | None:
    """node, label of all nodes with links; None if there are none."""
    rest = stored(members.join(members.groupBy("band").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "band"), "dart-buckets")
    if not rest.limit(1).count():
        return None
    crowded = stored(rest.groupBy("node").agg(F.sum("n").alias("crowd")), "dart-crowded")
    sets = stored(texts.join(crowded, "node", "left_semi").mapInArrow(_measured, "node long, strips binary").groupBy("node").agg(F.first("strips").alias("strips")), "dart-sets")

    def of(side: str, table: DataFrame, column: str) -> DataFrame:
        return table.select(F.col("node").alias(side), F.col(column).alias(f"{column}_{side}"))

    leaders = stored(rest.join(crowded, "node").groupBy("band").agg(F.max(F.struct("crowd", "node")).alias("l")).select("band", F.col("l.node").alias("leader")), "dart-leaders")
    pairs = stored(rest.join(leaders, "band").filter("leader <> node").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct(), "dart-pairs")
    likely = stored(pairs.join(of("a", sigs, "sig"), "a").join(of("b", sigs, "sig"), "b").mapInArrow(_agreeing, "a long, b long"), "dart-likely")
    links = stored(likely.join(of("a", sets, "strips"), "a").join(of("b", sets, "strips"), "b").mapInArrow(_checked, "a long, b long"), "dart-links")
    labels = components(links, "dart")
    # the buckets in several components, by blocks of members
    placed = stored(rest.join(labels, "node", "left").select("band", "node", "n", F.coalesce("label", "node").alias("mine")), "dart-placed")
    sized = sets.select("node", F.octet_length("strips").alias("bytes"))
    # buckets with the same members, by their number and two 64-bit sums (without carry) of their hashes, are compared once
    same = [F.bit_xor(F.xxhash64(F.lit(k), "node")).alias(f"s{k}") for k in (1, 2)]
    several = placed.join(sized, "node").groupBy("band").agg(F.min("mine").alias("x"), F.max("mine").alias("y"), F.count(F.lit(1)).alias("m"), F.sum("bytes").alias("bytes"), *same).filter("x <> y")
    several = several.groupBy("m", "s1", "s2").agg(F.min("band").alias("band"), F.first("bytes").alias("bytes")).select("band", "bytes")
    apart = stored(placed.join(several, "band"), "dart-apart")
    discard(rest, crowded, leaders, pairs, likely, placed)
    if apart.limit(1).count():
        blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("bytes") / BLOCK_BYTES)).cast("int")
        own = F.pmod(F.hash("node", "band"), blocks)
        dealt = apart.withColumns({"_own": own, "_other": F.explode(F.sequence(F.lit(0), blocks - 1))}).select("band", "node", "mine", F.least("_own", "_other").alias("low"), F.greatest("_own", "_other").alias("high"))
        more = dealt.join(sets, "node").groupBy("band", "low", "high").applyInArrow(_joined, "a long, b long")
        every = stored(links.unionByName(more), "dart-links")
        discard(labels)
        labels = components(every, "dart")
        discard(every)
    discard(sets, links, apart)
    return labels


def _joined(table: pa.Table) -> pa.Table:
    """Links between the members of two blocks: of all pairs at the threshold, those that join components (a spanning forest)."""
    nodes, mine = (table.column(c).to_numpy() for c in ("node", "mine"))
    sets = [np.frombuffer(x.as_buffer(), dtype=np.uint32) for x in table.column("strips")]
    size = np.array([len(x) for x in sets])
    m = len(nodes)
    near = np.equal.outer(mine, mine)
    if not near.all():
        owner = np.repeat(np.arange(m), size)
        values, which, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        shared = counts[which] > 1  # the others can't be common to two members
        place = (np.cumsum(counts > 1) - 1)[which[shared]]
        owner = owner[shared]
        common = np.zeros((m, m), dtype=np.float32)
        for lo in range(0, int(place.max()) + 1 if len(place) else 0, 4096):
            use = (place >= lo) & (place < lo + 4096)
            held = np.zeros((m, 4096), dtype=np.float32)
            held[owner[use], place[use] - lo] = 1
            common += held @ held.T
        near |= common >= THRESHOLD * (np.add.outer(size, size) - common)
    a, b = [], []
    fresh = np.ones(m, dtype=bool)
    for start in range(m):
        todo = [start] if fresh[start] else []
        fresh[start] = False
        while todo:
            u = todo.pop()
            found = np.flatnonzero(near[u] & fresh)
            fresh[found] = False
            todo.extend(found.tolist())
            for v in found[mine[found] != mine[u]]:
                a.append(nodes[u])
                b.append(nodes[v])
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
