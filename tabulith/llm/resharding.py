"""Minimum-cost-flow resharding.

The sizes of the old shards supply bytes, the new capacities demand them; keeping a byte where it is
costs nothing, moving it costs its route's price. The cheapest flow says how many bytes leave each
old shard for each new one. Every old shard is a folder of hash blocks, a fixed number of
them, and whole blocks are dealt to the routes so that the routes' bytes are met as closely as blocks allow; only
blocks that change their shard are rewritten, all other files stay as they are. The graph has one node a shard, so
it is solved on the driver; blocks are sums by hash, at most BLOCKS a shard whatever the input's size. A row's slot is
its place in its shard's files, in their order, so that nothing is sorted.

The law is `bytes`: documents with equal ids or texts lie in blocks like any others, each by a hash of its own row,
so that a text that a third of all rows share is spread over all shards.

Edges: a null text has 0 bytes (size 1); repeated rows are placed one by one; ties don't matter; an empty table
gives an empty result; keys keep their type and may be null. A very long text is a row like others: shards are as near to
equal as the largest block, which it is part of, allows. Columns of docs, whatever their names, go with their rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructType

from tabulith.llm.common import boxed, bounded_broadcast, shared_path, stored

BLOCKS = 128


def min_cost_flow(supply: list[int], demand: list[int], cost: list[list[int]] | None = None) -> list[list[int]]:
    """Cheapest integer flow from supply to demand (equal sums); cost[i][j] a unit, 0 on the diagonal and 1 elsewhere if not given.

    Successive shortest paths with potentials (Dijkstra), on the residual bipartite graph.
    """
    n, m = len(supply), len(demand)
    if sum(supply) != sum(demand):
        raise ValueError("supply and demand differ")
    price = cost or [[int(i != j) for j in range(m)] for i in range(n)]
    flow = [[0] * m for _ in range(n)]
    left, want = list(supply), list(demand)
    pot = [0] * (n + m)
    while any(left):
        dist, back, heap = [float("inf")] * (n + m), [-1] * (n + m), []
        for i in range(n):
            if left[i]:
                dist[i] = 0
                heapq.heappush(heap, (0, i))
        while heap:
            d, u = heapq.heappop(heap)
            if d > dist[u]:
                continue
            edges = [(n + j, price[u][j]) for j in range(m)] if u < n else [(i, -price[i][u - n]) for i in range(n) if flow[i][u - n]]
            for v, w in edges:
                e = d + w + pot[u] - pot[v]
                if e < dist[v]:
                    dist[v], back[v] = e, u
                    heapq.heappush(heap, (e, v))
        ends = [j for j in range(m) if want[j]]
        end = min(ends, key=lambda j: dist[n + j] + pot[n + j])
        reach = max(d for d in dist if d < float("inf"))
        pot = [p + min(d, reach) for p, d in zip(pot, dist, strict=True)]
        path, v = [n + end], n + end
        while back[v] >= 0:
            v = back[v]
            path.append(v)
        path.reverse()
        amount = min([left[path[0]], want[end], *(flow[b][a - n] for a, b in zip(path, path[1:]) if a >= n)])
        for a, b in zip(path, path[1:]):
            if a < n:
                flow[a][b - n] += amount
            else:
                flow[b][a - n] -= amount
        left[path[0]] -= amount
        want[end] -= amount
    return flow


def even_capacities(total: int, shards: int) -> list[int]:
    return [total // shards + (j < total % shards) for j in range(shards)]


def deal_blocks(blocks: dict[tuple[int, int], int], capacities: list[int]) -> dict[tuple[int, int], int]:
    """(old shard, block) -> new shard: the cheapest flow, met by whole blocks, largest first; then the totals are evened out with small blocks."""
    shards = len(capacities)
    old = max([shards, *(s + 1 for s, _ in blocks)])
    supply = [sum(n for (s, _), n in blocks.items() if s == i) for i in range(old)]
    flow = min_cost_flow(supply, capacities)
    placed, load = {}, [0] * shards
    for i in range(old):
        quota = list(flow[i])
        for (s, b), n in sorted(((k, n) for k, n in blocks.items() if k[0] == i), key=lambda x: (-x[1], x[0])):
            # a block stays if its own route still has room for it; else the route with the most room takes it
            j = i if i < shards and quota[i] >= n else max(range(shards), key=lambda j: (quota[j], -j))
            quota[j] -= n
            placed[s, b] = j
            load[j] += n
    for _ in range(len(blocks)):
        over = [load[j] - capacities[j] for j in range(shards)]
        hi, lo = max(range(shards), key=lambda j: over[j]), min(range(shards), key=lambda j: over[j])
        gap = over[hi] - over[lo]
        fits = [(abs(gap - 2 * n), s == hi, s, b) for (s, b), n in blocks.items() if placed[s, b] == hi and 0 < n < gap]
        if not fits:
            break
        _, _, s, b = min(fits)
        placed[s, b] = lo
        load[hi] -= blocks[s, b]
        load[lo] += blocks[s, b]
    return placed


def old_layout(docs: DataFrame, old_shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """_key, _size, _crc, _row, and the hash layout that is to be changed: _old shard, _block. Rows that are alike have hashes of their own."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = boxed(docs, _key=F.col(key), _size=(F.octet_length(body) + 1).cast("long"), _crc=F.crc32(body).cast("long"), _place=F.monotonically_increasing_id())
    spread = F.xxhash64("_key", "_crc", "_place")
    return rows.withColumns({"_hash": spread, "_old": F.pmod(spread, F.lit(old_shards)).cast("int"), "_block": F.shiftrightunsigned(spread, 57).cast("int")}).drop("_place")


def write_store(docs: DataFrame, shards: int, path: str, key: str = "doc_id", text: str = "text") -> None:
    """Write docs to path/shard=N/block=M: the hash layout, as a store that is there before it is resharded."""
    laid = old_layout(docs, shards, key, text).select("_row", "_size", F.col("_old").alias("shard"), F.col("_block").alias("block"))
    laid.hint("rebalance", "shard", "block").write.option("compression", "zstd").partitionBy("shard", "block").parquet(path)


def read_store(spark: SparkSession, path: str, row: StructType) -> DataFrame:
    """_row, shard, block, and _slot: the row's place (0, 1, 2, ...) among its shard's rows, by block, file and place in the file."""
    schema = StructType().add("_row", row).add("_size", LongType()).add("shard", IntegerType()).add("block", IntegerType())
    rows = spark.read.schema(schema).parquet(path).select("_row", "shard", "block", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_index"))
    files = rows.groupBy("shard", "block", "_file").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("shard").orderBy("block", "_file"))
    starts = stored(files.select("shard", "block", "_file", (before - F.col("_n")).alias("_start")), "reshard-starts")
    return rows.join(bounded_broadcast(starts), ["shard", "block", "_file"]).select("_row", "shard", "block", (F.col("_start") + F.col("_index")).alias("_slot"))


def reshard_store(spark: SparkSession, path: str, capacities: Callable[[int], list[int]]) -> dict[tuple[int, int], int]:
    """Move the fewest bytes of a store so that its shards have the capacities (a function of its bytes); returns the plan."""
    sizes = spark.read.schema("_size long, shard int, block int").parquet(path).groupBy("shard", "block").agg(F.sum("_size").alias("n"))
    blocks = {(r["shard"], r["block"]): r["n"] for r in sizes.collect()}
    plan = deal_blocks(blocks, capacities(sum(blocks.values())))
    rewrite_affected(spark, path, plan)
    return plan


def reshard(docs: DataFrame, old_shards: int = 6, shards: int = 8, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Lay docs out in old_shards, reshard that store to shards of even bytes, and read it back. Per document: _row, _key, _size, _crc (of the text that was read back), _old, _shard and _slot (0, 1, 2, ... in its shard)."""
    spark = docs.sparkSession
    path = shared_path(spark, "reshard-store")
    write_store(docs, old_shards, path, key, text)
    reshard_store(spark, path, lambda total: even_capacities(total, shards))
    body = F.coalesce(F.col(f"_row.`{text}`"), F.lit(""))
    return read_store(spark, path, boxed(docs).schema["_row"].dataType).select(
        "_row",
        F.col(f"_row.`{key}`").alias("_key"),
        (F.octet_length(body) + 1).cast("long").alias("_size"),
        F.crc32(body).cast("long").alias("_crc"),
        F.when(F.col("block") < BLOCKS, F.col("shard")).otherwise(F.floor(F.col("block") / BLOCKS).cast("int") - 1).alias("_old"),
        F.col("shard").alias("_shard"),
        "_slot",
    )


def rewrite_affected(spark, path: str, plan: dict[tuple[int, int], int]) -> list[str]:
    """Apply a plan to a store written with partitionBy('shard', 'block'): one job reads the blocks that change their shard and writes them at their new places, then the old places are deleted; all other files stay as they are. Returns the folders it rewrote.

    A moved block gets the number BLOCKS * (old shard + 1) + block, so that no two blocks of a shard share a folder.
    """
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    moved = [(s, b, j) for (s, b), j in sorted(plan.items()) if s != j]
    old = {f"{path}/shard={s}/block={b}": (s, b, j) for s, b, j in moved}
    old = {at: move for at, move in old.items() if fs.exists(jvm.org.apache.hadoop.fs.Path(at))}
    if old:
        places = F.broadcast(spark.createDataFrame(list(old.values()), "shard int, block int, _to int"))
        rows = spark.read.option("basePath", path).parquet(*old).join(places, ["shard", "block"])
        placed = rows.withColumns({"block": (F.col("shard") + 1) * BLOCKS + F.col("block"), "shard": F.col("_to")}).drop("_to")
        placed.hint("rebalance", "shard", "block").write.mode("append").option("compression", "zstd").partitionBy("shard", "block").parquet(path)
        for at in old:
            fs.delete(jvm.org.apache.hadoop.fs.Path(at), True)
    return sorted(old)
