"""Approximate nearest neighbours by largest inner product over sharded robust-pruned graphs.

Equal vectors are one node, which keeps its smallest ids only: ties go to smaller ids, so no larger one can
be among the nearest.  Nodes are dealt by a hash of the vector into shards of about ``shard_rows``.  In a shard, one more
coordinate makes all vectors equally long, which turns the largest inner product into the smallest distance.
The graph starts random; in two passes a greedy search from the middle node proposes neighbours for each
node, and relaxed pruning keeps a candidate only if no kept one is ``alpha`` times nearer to it.  Edges are
made both ways and pruned alike.  A beam search answers each block of queries in each shard, and the shards'
answers are merged.

Defined results: vectors that are null, zero, of another length than most, or hold a null or a non-finite
number take no part, nor do null ids; of several rows with one id the smallest vector counts; an empty table
gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedloom.session import work_path

K = 20
SHARD_ROWS = 4096
BLOCK_ROWS = 4096  # queries that meet a shard together
DEGREE = 32
BEAM = 64
SEARCH_BEAM = 64
ALPHA = 1.2
BATCH = 256
STEP = 4  # nodes a search opens at a time


def usable(vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``id, vector`` of the rows that take part, one per id."""
    v = F.col("vector")
    whole = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    rows = rows.where(F.col("id").isNotNull() & v.isNotNull() & whole & F.exists(v, lambda x: x != 0))
    sizes = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").first()
    return rows.where(F.size("vector") == (sizes["size"] if sizes else 0)).groupBy("id").agg(F.min("vector").alias("vector"))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def nodes(rows: DataFrame, k: int) -> DataFrame:
    """``vector, ids``: each distinct vector with its ``k + 1`` smallest ids."""

    def shrink(batches):
        for batch in batches:
            table = pa.table(batch).sort_by("id")
            seen: dict[bytes, list[int]] = {}
            for i, x in zip(table["id"].to_pylist(), _matrix(table["vector"].combine_chunks())):
                own = seen.setdefault(x.tobytes(), [])
                if len(own) <= k:
                    own.append(i)
            yield pa.record_batch([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.list_(pa.int64()))], names=["vector", "ids"])

    shrunk = rows.select("id", "vector").mapInArrow(shrink, "vector binary, ids array<bigint>")
    merged = F.flatten(F.collect_list("ids"))
    return shrunk.groupBy("vector").agg(F.slice(F.array_sort(merged), 1, k + 1).alias("ids"))


def _level(x: np.ndarray) -> np.ndarray:
    """One more coordinate, so that all rows have the largest norm among them."""
    square = (x * x).sum(1)
    return np.c_[x, np.sqrt(np.maximum(square.max(initial=0.0) - square, 0))].astype(np.float32)


def _distance(x: np.ndarray, centres: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Squared distances of a row of centres to the nodes of each row of ids; infinite where the id is -1."""
    gap = x[ids] - centres[:, None, :]
    return np.where(ids < 0, np.inf, np.einsum("bcd,bcd->bc", gap, gap))


def beam_search(x: np.ndarray, graph: np.ndarray, start: int, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Nearest nodes found for each query, nearest first, and the nodes that were opened on the way."""
    n, rows = len(queries), np.arange(len(queries))[:, None]
    met = np.zeros((n, len(x) + 1), bool)  # the last column stands for no node
    met[:, [start, len(x)]] = True
    ids = np.full((n, beam), -1)
    ids[:, 0] = start
    far = np.full((n, beam), np.inf, np.float32)
    far[:, 0] = _distance(x, queries, ids[:, :1])[:, 0]
    opened = np.isinf(far)
    path = []
    while not opened.all():
        pick = np.argsort(np.where(opened, np.inf, far), axis=1)[:, :STEP]
        chosen = np.where(opened[rows, pick], -1, ids[rows, pick])
        opened[rows, pick] = True
        path.append(chosen)
        near = np.where(chosen[:, :, None] < 0, -1, graph[chosen]).reshape(n, -1)
        near = np.where(met[rows, near], -1, near)
        met[rows, near] = True
        met[:, len(x)] = True
        order = np.sort(near, axis=1)  # nodes that two of the opened ones share are taken once
        order[:, 1:][order[:, 1:] == order[:, :-1]] = -1
        all_ids, all_far = np.c_[ids, order], np.c_[far, _distance(x, queries, order)]
        best = np.argsort(all_far, axis=1)[:, :beam]
        opened = np.c_[opened, np.zeros_like(order, bool)][rows, best] | np.isinf(all_far[rows, best])
        ids, far = all_ids[rows, best], all_far[rows, best]
    return np.where(np.isinf(far), -1, ids), np.concatenate(path, axis=1)


def robust_prune(x: np.ndarray, points: np.ndarray, candidates: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """For each point, up to ``degree`` candidates, nearest first, none of which a kept one is ``alpha`` times nearer to."""
    rows = np.arange(len(points))
    candidates = np.sort(np.where(candidates == points[:, None], -1, candidates), axis=1)
    candidates[:, 1:][candidates[:, 1:] == candidates[:, :-1]] = -1
    vectors = x[candidates]
    gap = vectors - x[points][:, None, :]
    own = np.where(candidates < 0, np.inf, np.einsum("bcd,bcd->bc", gap, gap))
    products, square = vectors @ vectors.transpose(0, 2, 1), np.einsum("bcd,bcd->bc", vectors, vectors)
    left = own.copy()
    kept = np.full((len(points), degree), -1)
    for slot in range(degree):
        best = left.argmin(1)
        alive = np.isfinite(left[rows, best])
        if not alive.any():
            break
        kept[:, slot] = np.where(alive, candidates[rows, best], -1)
        between = square[rows, best][:, None] + square - 2 * products[rows, best]
        left[(alpha * alpha * between <= own) & alive[:, None]] = np.inf
        left[rows, best] = np.inf
    return kept


def build_graph(x: np.ndarray, degree: int = DEGREE, beam: int = BEAM, alpha: float = ALPHA, seed: int = 0) -> tuple[np.ndarray, int]:
    """Neighbours of each node (-1 for none) and the node that searches start from."""
    n, random = len(x), np.random.default_rng(seed)
    start = int(((x - x.mean(0)) ** 2).sum(1).argmin())
    graph = random.integers(0, n, (n, degree))
    graph[graph == np.arange(n)[:, None]] = -1
    for relax in (1.0, alpha):
        order = random.permutation(n)
        for first in range(0, n, BATCH):
            points = order[first:first + BATCH]
            found, path = beam_search(x, graph, start, x[points], beam)
            graph[points] = robust_prune(x, points, np.c_[found, path, graph[points]], degree, relax)
            to, source = graph[points].ravel(), np.repeat(points, degree)
            to, source = to[to >= 0], source[to >= 0]
            by = np.argsort(to, kind="stable")
            to, source = to[by], source[by]
            heads = np.flatnonzero(np.r_[True, to[1:] != to[:-1]])
            sizes = np.diff(np.r_[heads, len(to)])
            added = np.full((len(heads), sizes.max(initial=0)), -1)
            added[np.repeat(np.arange(len(heads)), sizes), np.arange(len(to)) - np.repeat(heads, sizes)] = source
            targets = to[heads]
            for a in range(0, len(targets), BATCH):
                part = targets[a:a + BATCH]
                both = np.c_[graph[part], added[a:a + BATCH]]
                room = (both >= 0).sum(1) <= degree
                graph[part] = np.where(room[:, None], _first(both, degree), robust_prune(x, part, both, degree, relax))
    return graph, start


def _first(ids: np.ndarray, degree: int) -> np.ndarray:
    """The ids of each row that are set, to the front."""
    return np.take_along_axis(ids, np.argsort(ids < 0, axis=1, kind="stable"), 1)[:, :degree]


def build_index(rows: DataFrame, k: int = K, shard_rows: int = SHARD_ROWS, degree: int = DEGREE, beam: int = BEAM, alpha: float = ALPHA) -> DataFrame:
    """One row per shard: nodes, their ids and the graph, written to the shared folder and read from there."""
    spark = rows.sparkSession
    at = work_path(spark, "nodes")
    nodes(rows, k).write.parquet(at)
    found = spark.read.parquet(at)
    shards = -(-found.count() // shard_rows) or 1

    def build(group: pa.Table) -> pa.Table:
        group = group.sort_by("vector")
        x = np.frombuffer(b"".join(group["vector"].to_pylist()), np.float64).reshape(group.num_rows, -1)
        graph, start = build_graph(_level(x), degree, beam, alpha)
        ids = group["ids"].combine_chunks()
        blobs = (x, graph.astype(np.int32), pc.list_value_length(ids).to_numpy().astype(np.int32), ids.flatten().to_numpy())
        return pa.table([group["shard"][:1], pa.array([start], pa.int32()), pa.array([group.num_rows], pa.int32()), *(pa.array([np.ascontiguousarray(b).tobytes()], pa.binary()) for b in blobs)], names=names)

    names = ["shard", "start", "n", "vectors", "graph", "sizes", "ids"]
    dealt = found.withColumn("shard", F.pmod(F.xxhash64("vector"), F.lit(shards)).cast("int"))
    index = work_path(spark, "index")
    dealt.groupBy("shard").applyInArrow(build, "shard int, start int, n int, vectors binary, graph binary, sizes binary, ids binary").write.parquet(index)
    return spark.read.parquet(index).withColumn("shards", F.lit(shards))


def _answers(row: dict, ids: np.ndarray, queries: np.ndarray, k: int, beam: int):
    """Per block of queries: query ids, candidate ids and scores of the shard's nearest."""
    x = np.frombuffer(row["vectors"], np.float64).reshape(row["n"], -1)
    graph = np.frombuffer(row["graph"], np.int32).reshape(row["n"], -1)
    sizes = np.frombuffer(row["sizes"], np.int32)
    members, first = np.frombuffer(row["ids"], np.int64), np.r_[0, np.cumsum(sizes)]
    level = _level(x)
    for a in range(0, len(ids), BATCH):
        own, block = ids[a:a + BATCH], queries[a:a + BATCH]
        found, _ = beam_search(level, graph, row["start"], np.c_[block, np.zeros(len(block))].astype(np.float32), max(beam, k + 1))
        query, slot = np.nonzero(found >= 0)
        node = found[query, slot]
        score = np.einsum("id,id->i", block[query], x[node])
        repeat = sizes[node]
        query, score = np.repeat(query, repeat), np.repeat(score, repeat)
        member = members[np.repeat(first[node], repeat) + np.arange(len(score)) - np.repeat(np.cumsum(repeat) - repeat, repeat)]
        other = member != own[query]
        query, score, member = query[other], score[other], member[other]
        order = np.lexsort((member, -score, query))
        query, score, member = query[order], score[order], member[order]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        near = place < k
        yield own[query[near]], member[near], score[near]


def search(index: DataFrame, queries: DataFrame, k: int = K, beam: int = SEARCH_BEAM, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score`` of each query's ``k`` nearest, its own id left out.

    Blocks of queries meet each shard once, a pair of them at a time in memory.
    """
    count = queries.count()
    shards = (index.select("shards").first() or [1])[0]
    blocks = -(-count // block_rows) or 1
    asked = queries.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    held = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        if right.num_rows and left.num_rows:
            right = right.sort_by("id")
            for part in _answers(left.to_pylist()[0], right["id"].to_numpy(), _matrix(right["vector"].combine_chunks()), k, beam):
                for column, value in zip(found, part):
                    column.append(value)
        return pa.table([np.concatenate(c) for c in found], names=["query_id", "vec_id", "score"])

    pairs = held.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInArrow(answer, "query_id long, vec_id long, score double")
    ranked = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
