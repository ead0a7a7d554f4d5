"""Token ids in training order: fixed-stride binary shards, addressed by a keyed Feistel permutation.

Texts are tokenised, closed with the end-of-text id and cut into sequences of at most LENGTH ids, which
are stored and numbered 0 ... n - 1 in the stored order (partition offsets and ordinals; a count for each
partition reaches the driver). A keyed four-round Feistel network over the smallest even number of bits that
holds n, walked on while its value is n or more, gives each number a global slot: a permutation that needs
no shuffle buffer and no sort of random keys, and that can be inverted to find what a slot holds. Sequences
are dealt by ranges of slots to shards of a fixed number of slots, padded to a fixed stride and written in
slot order, so that slot s is row s mod SLOTS of shard s div SLOTS: readers go on from any slot.

Edges: a null text has no sequences, an empty one has one with only the end-of-text id; repeated rows are
tokenised each; an empty table writes no shard; keys keep their type and may be null; other columns are left out,
whatever their names. A very long text is tokenised as a whole, and cut.

Two forms of shards. Parquet (the default): a row a slot, tokens of one fixed length. Raw: bare bytes, one file a
shard, a record a slot: LENGTH 16-bit ids and a separator of two zero bytes, 2 * LENGTH + 2 bytes each, so that slot s is
at byte (s mod SLOTS) * (2 * LENGTH + 2) of its shard's file (read_slots seeks there), and an index of Parquet beside
them. Both are written by the executors, through Spark's committed writers.
"""

from __future__ import annotations

import base64
import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulith.llm.byte_words import U64, mix64
from tabulith.llm.common import discard, shared_path, small_batches, stored

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
END = 50256
LENGTH, SLOTS, ROUNDS, KEY = 1024, 8192, 4, 20_240_607
#: The pre-tokenisation pattern that belongs to the vocabulary (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Partitions that write shards, at most; each writes a range of whole shards.
WRITERS = 10_000
SEPARATOR = b"\0\0"

_encoders: dict[str, object] = {}


def encoder(path: str = VOCABULARY):
    """The tokenizer of a ranks file; loaded once a worker."""
    if path not in _encoders:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _encoders[path] = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encoders[path]


class Permutation:
    """A keyed bijection of 0 ... n - 1."""

    def __init__(self, n: int, key: int = KEY, rounds: int = ROUNDS):
        self.n, self.half = n, max(1, -(-max(1, n - 1).bit_length() // 2))
        self.keys = mix64(np.arange(1, rounds + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(key))

    def _once(self, x: np.ndarray, keys: np.ndarray, back: bool) -> np.ndarray:
        h, mask = U64(self.half), U64((1 << self.half) - 1)
        left, right = x >> h, x & mask
        for k in keys:
            if back:
                left, right = right ^ (mix64(left + k) & mask), left
            else:
                left, right = right, left ^ (mix64(right + k) & mask)
        return left << h | right

    def _walk(self, x: np.ndarray, keys: np.ndarray, back: bool) -> np.ndarray:
        out = self._once(np.asarray(x).astype(U64), keys, back)
        while (far := out >= U64(self.n)).any():
            out[far] = self._once(out[far], keys, back)
        return out.astype(np.int64)

    def slot(self, index: np.ndarray) -> np.ndarray:
        return self._walk(index, self.keys, False)

    def index(self, slot: np.ndarray) -> np.ndarray:
        return self._walk(slot, self.keys[::-1], True)


def sequences(docs: DataFrame, text: str = "text", key: str = "doc_id", length: int = LENGTH, vocabulary: str = VOCABULARY, end: int = END) -> DataFrame:
    """key, seq, n_tokens and tokens (little-endian 16-bit ids, not padded) of each text's sequences."""

    name = os.path.basename(vocabulary)
    docs.sparkSession.sparkContext.addFile(vocabulary)

    def cut(batches):
        from pyspark import SparkFiles

        own = encoder(SparkFiles.get(name))
        for batch in batches:
            keys, bodies = batch.column("key"), batch.column("text").to_pylist()
            for lo in range(0, len(bodies), 256):
                row, seq, size, blobs = [], [], [], []
                for i in range(lo, min(lo + 256, len(bodies))):
                    if bodies[i] is None:
                        continue
                    ids = np.append(own.encode_to_numpy(bodies[i], disallowed_special=()) if bodies[i] else [], end).astype("<u2")
                    for s in range(-(-len(ids) // length)):
                        part = ids[s * length : (s + 1) * length]
                        row.append(i)
                        seq.append(s)
                        size.append(len(part))
                        blobs.append(part.tobytes())
                yield pa.RecordBatch.from_arrays([keys.take(pa.array(row, pa.int64())), pa.array(seq, pa.int32()), pa.array(size, pa.int32()), pa.array(blobs, pa.binary())], names=["key", "seq", "n_tokens", "tokens"])

    shaped = small_batches(docs).select(F.col(key).alias("key"), F.col(text).alias("text"))
    return shaped.mapInArrow(cut, f"key {shaped.schema['key'].dataType.simpleString()}, seq int, n_tokens int, tokens binary")


def with_slots(numbered: DataFrame, offsets: dict[int, int], permutation: Permutation) -> DataFrame:
    """Slots for rows with _mid = partition << 33 | ordinal."""

    def placed(batches):
        for batch in batches:
            mid = batch.column("_mid").to_numpy()
            parts, which = np.unique(mid >> 33, return_inverse=True)
            index = np.array([offsets[p] for p in parts.tolist()], dtype=np.int64)[which] + (mid & ((1 << 33) - 1)) if len(mid) else mid
            yield batch.set_column(batch.schema.get_field_index("_mid"), "slot", pa.array(permutation.slot(index), pa.int64()))

    kinds = ", ".join(f"{'slot' if f.name == '_mid' else f.name} {f.dataType.simpleString()}" for f in numbered.schema)
    return small_batches(numbered).mapInArrow(placed, kinds)


def write_shards(docs: DataFrame, path: str | None = None, text: str = "text", key: str = "doc_id", length: int = LENGTH, slots: int = SLOTS, seed: int = KEY, vocabulary: str = VOCABULARY, end: int = END, raw: bool = False) -> str:
    """Tokenise docs and write their shards. Returns path.

    Parquet: path/shard=N, rows slot, key, seq, n_tokens, tokens of 2 * length bytes, in slot order.
    raw: path/raw/shard=N, one file of records, and path/index, rows slot, key, seq, n_tokens, shard."""
    spark = docs.sparkSession
    rows = stored(sequences(docs, text, key, length, vocabulary, end).withColumn("_mid", F.monotonically_increasing_id()), "token-sequences")
    offsets, total = {}, 0
    for r in sorted(rows.groupBy(F.shiftrightunsigned("_mid", 33).alias("p")).count().collect()):
        offsets[r["p"]] = total
        total += r["count"]
    path = path or shared_path(spark, "token-shards")
    shards = max(1, -(-total // slots))
    writers = min(shards, WRITERS)

    def dealt(numbered: DataFrame) -> DataFrame:
        placed = with_slots(numbered, offsets, Permutation(total, seed)).withColumn("shard", F.floor(F.col("slot") / slots).cast("int"))
        # a partition is a range of shards, by its number: none is sampled, and each holds at most slots * ceil(shards / writers) rows
        return placed.repartitionById(writers, F.floor(F.col("shard") * F.lit(writers) / F.lit(shards)).cast("int")).sortWithinPartitions("shard", "slot")

    stride = F.rpad(F.col("tokens"), F.lit(2 * length), F.unhex(F.lit("00")))
    if raw:
        # a string of any bytes: Spark's text writer puts a value's bytes and the separator, nothing else
        dealt(rows.select("tokens", "_mid")).select("shard", stride.cast("string").alias("value")).write.option("lineSep", SEPARATOR.decode()).partitionBy("shard").text(f"{path}/raw")
        with_slots(rows.drop("tokens"), offsets, Permutation(total, seed)).withColumn("shard", F.floor(F.col("slot") / slots).cast("int")).write.option("compression", "zstd").parquet(f"{path}/index")
    else:
        dealt(rows).withColumn("tokens", stride).write.option("compression", "zstd").partitionBy("shard").parquet(path)
    discard(rows)
    return path


def read_shards(spark: SparkSession, path: str, start: int = 0, slots: int = SLOTS, key: str = "long") -> DataFrame:
    """The sequences from slot start on; shards before it are not read. key: its type."""
    schema = f"slot long, key {key}, seq int, n_tokens int, tokens binary, shard int"
    return spark.read.schema(schema).parquet(path).filter((F.col("shard") >= start // slots) & (F.col("slot") >= start))


def read_slots(spark: SparkSession, path: str, start: int, count: int, length: int = LENGTH, slots: int = SLOTS) -> np.ndarray:
    """count x length ids (0 beyond a sequence's end) of raw shards from slot start on: a seek to its byte, then reads in order. Fewer rows at the end of the last shard."""
    jvm = spark.sparkContext._jvm
    fs = None
    stride, out = 2 * length + len(SEPARATOR), []
    while count > 0:
        glob = jvm.org.apache.hadoop.fs.Path(f"{path}/raw/shard={start // slots}/part-*")
        fs = fs or glob.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        found = fs.globStatus(glob)
        if not found:
            break
        held = found[0].getLen() // stride - start % slots
        n = min(count, held)
        if n <= 0:
            break
        stream = fs.open(found[0].getPath())
        try:
            stream.seek(start % slots * stride)
            body = bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream, n * stride))
        finally:
            stream.close()
        out.append(np.frombuffer(body, dtype="<u2").reshape(n, -1)[:, :length])
        start, count = start + n, count - n
    return np.concatenate(out) if out else np.zeros((0, length), dtype="<u2")


def export_raw(spark: SparkSession, path: str, shard: int, to) -> int:
    """Write a shard as raw fixed-stride bytes to a binary file object; returns the rows written. Rows are streamed in slot order."""
    n = 0
    for r in read_shards(spark, path).filter(F.col("shard") == shard).sort("slot").select("tokens").toLocalIterator():
        to.write(bytes(r["tokens"]))
        n += 1
    return n
