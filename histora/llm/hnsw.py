"""Approximate nearest neighbours: one navigable small-world graph per shard, results merged (operator 5).

Equal vectors are one node, which keeps its smallest ids, as a graph of copies would not be navigable. Nodes are dealt over
shards of about `shard_rows`. Each shard is indexed by one task and stored as one row of flat arrays: vectors, the
neighbours of every level as a matrix of node numbers (-1: none), and the nodes of every level. Queries are broadcast in
blocks of bounded size; for a block every task reads its shards where they are stored, one at a time. So the index is neither copied
nor exchanged, nothing larger than a shard and a block is in memory at once, and a shard is loaded once for `block_rows` queries.
Nodes found are measured anew with the original vectors in double precision, and the best of all shards are kept.
"""

from __future__ import annotations

from functools import reduce
from heapq import heappop, heappush, heapreplace
from types import SimpleNamespace

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from histora.llm.common import Scratch, saved, ship


class Graph:
    """A graph over unit vectors. Level 0 holds all nodes; each level above about 1/m of the one below."""

    def __init__(self, unit, m: int, seed: int = 0):
        import numpy as np

        self.unit, self.m, n = unit, m, len(unit)
        tops = np.floor(-np.log(1 - np.random.default_rng(seed).random(n)) / np.log(m)).astype(np.int64)
        self.tops = np.minimum(tops, 30)
        self.nodes = [np.flatnonzero(self.tops >= level) for level in range(int(self.tops.max(initial=0)) + 1)]
        self.links = [np.full((len(x), self.width(level)), -1, np.int32) for level, x in enumerate(self.nodes)]
        self.rows = []
        self.entry = -1
        self.prepare()

    def prepare(self):
        import numpy as np

        self.seen, self.turn = np.zeros(len(self.unit), np.int64), 0
        for x in self.nodes:
            row = np.full(len(self.unit), -1, np.int32)
            row[x] = np.arange(len(x), dtype=np.int32)
            self.rows.append(row)

    def width(self, level: int) -> int:
        return 2 * self.m if level == 0 else self.m

    @classmethod
    def stored(cls, unit, m: int, entry: int, nodes: list, links: list) -> Graph:
        g = cls.__new__(cls)
        g.unit, g.m, g.entry, g.nodes, g.links, g.rows = unit, m, entry, nodes, links, []
        g.prepare()
        return g

    def around(self, q, starts: list[tuple[float, int]], ef: int, level: int) -> list[tuple[float, int]]:
        """Up to ef nodes near q on a level, nearest first, reached from (similarity, node) starts."""
        links, row, unit, seen = self.links[level], self.rows[level], self.unit, self.seen
        self.turn += 1
        turn = self.turn
        open_, best = [], []
        for s, x in starts:
            seen[x] = turn
            heappush(open_, (-s, x))
            heappush(best, (s, x))
        while len(best) > ef:
            heappop(best)
        while open_:
            s, x = heappop(open_)
            if len(best) >= ef and -s < best[0][0]:
                break
            near = links[row[x]]
            near = near[near >= 0]
            near = near[seen[near] != turn]
            if not len(near):
                continue
            seen[near] = turn
            sims = unit[near] @ q
            if len(best) >= ef:
                better = sims > best[0][0]
                near, sims = near[better], sims[better]
            for s, x in zip(sims.tolist(), near.tolist(), strict=True):
                if len(best) < ef:
                    heappush(open_, (-s, x))
                    heappush(best, (s, x))
                elif s > best[0][0]:
                    heappush(open_, (-s, x))
                    heapreplace(best, (s, x))
        return sorted(best, reverse=True)

    def spread(self, found: list[tuple[float, int]], most: int) -> list[int]:
        """Neighbours that are nearer to the node than to a chosen neighbour, filled up with the nearest others."""
        import numpy as np

        if len(found) <= most:
            return [x for _, x in found]
        ids = np.array([x for _, x in found])
        own = np.array([s for s, _ in found])
        among = self.unit[ids] @ self.unit[ids].T
        covered = np.full(len(ids), -2.0)
        chosen = []
        for i in range(len(ids)):
            if own[i] >= covered[i]:
                chosen.append(i)
                if len(chosen) == most:
                    break
                np.maximum(covered, among[i], out=covered)
        if len(chosen) < most:
            rest = [i for i in range(len(ids)) if i not in set(chosen)]
            chosen += rest[: most - len(chosen)]
        return ids[chosen].tolist()

    def add(self, x: int, ef: int) -> None:
        import numpy as np

        q, top = self.unit[x], int(self.tops[x])
        if self.entry < 0:
            self.entry = x
            return
        high = int(self.tops[self.entry])
        found = [(float(self.unit[self.entry] @ q), self.entry)]
        for level in range(high, top, -1):
            found = self.around(q, found, 1, level)
        for level in range(min(high, top), -1, -1):
            found = self.around(q, found, ef, level)
            links, row, width = self.links[level], self.rows[level], self.width(level)
            chosen = self.spread(found, self.m)
            links[row[x], : len(chosen)] = chosen
            for y in chosen:
                r = links[row[y]]
                free = np.flatnonzero(r < 0)
                if len(free):
                    r[free[0]] = x
                else:
                    ids = np.append(r, x)
                    sims = self.unit[ids] @ self.unit[y]
                    order = np.argsort(-sims, kind="stable")
                    kept = self.spread(list(zip(sims[order].tolist(), ids[order].tolist(), strict=True)), width)
                    r[:] = -1
                    r[: len(kept)] = kept
        if top > high:
            self.entry = x

    def nearest(self, q, ef: int) -> list[int]:
        if self.entry < 0:
            return []
        found = [(float(self.unit[self.entry] @ q), self.entry)]
        for level in range(len(self.nodes) - 1, 0, -1):
            if self.rows[level][self.entry] >= 0:
                found = self.around(q, found, 1, level)
        return [x for _, x in self.around(q, found, ef, 0)]


def unit_vectors(vectors):
    import numpy as np

    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True, initial=1e-300)
    return np.ascontiguousarray(scaled / np.linalg.norm(scaled, axis=1, keepdims=True), dtype=np.float32)


def cosines(q, vectors):
    """Cosine of q and each vector, in double precision."""
    import numpy as np

    return (vectors @ q) / (np.sqrt((vectors * vectors).sum(axis=1)) * np.sqrt((q * q).sum()))


INDEX = "dim int, shard int, m int, entry int, vectors binary, ids binary, id_ends binary, level_sizes binary, level_nodes binary, links binary"


def build_index(vectors: DataFrame, keep: int, shard_rows: int, m: int, ef: int) -> DataFrame:
    """The stored index, one row per shard. vectors: id, v (double array), dim; equal vectors share a node with `keep` ids."""
    import numpy as np

    nth = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    few = vectors.withColumn("nth", nth).where(F.col("nth") <= keep)
    nodes = saved(few.groupBy("dim", "v").agg(F.sort_array(F.collect_list("id")).alias("ids")), "nodes")
    shards = -(-nodes.count() // shard_rows) or 1
    nodes = nodes.withColumn("shard", F.pmod(F.xxhash64("v"), F.lit(shards)).cast("int"))

    def index(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.iloc[np.argsort([x[0] for x in pdf.ids], kind="stable")]
        v = np.stack(pdf.v.to_numpy()).astype(np.float64)
        g = Graph(unit_vectors(v), m)
        for x in range(len(v)):
            g.add(x, ef)
        row = {
            "dim": key[0], "shard": key[1], "m": m, "entry": g.entry, "vectors": v.tobytes(),
            "ids": np.concatenate(list(pdf.ids)).astype(np.int64).tobytes(),
            "id_ends": np.cumsum([len(x) for x in pdf.ids]).astype(np.int64).tobytes(),
            "level_sizes": np.array([len(x) for x in g.nodes], np.int64).tobytes(),
            "level_nodes": np.concatenate(g.nodes).astype(np.int64).tobytes(),
            "links": np.concatenate([x.ravel() for x in g.links]).astype(np.int32).tobytes(),
        }
        return pd.DataFrame([row])

    parts = nodes.repartition(4 * shards, "dim", "shard")
    return saved(parts.groupBy("dim", "shard").applyInPandas(index, INDEX), "index")


def load(row) -> tuple:
    """The graph, original vectors and ids of a stored shard."""
    import numpy as np

    v = np.frombuffer(row.vectors, np.float64).reshape(-1, row.dim)
    ids, ends = np.frombuffer(row.ids, np.int64), np.frombuffer(row.id_ends, np.int64)
    all_nodes, all_links = np.frombuffer(row.level_nodes, np.int64), np.frombuffer(row.links, np.int32)
    nodes, links, a, b = [], [], 0, 0
    for level, size in enumerate(np.frombuffer(row.level_sizes, np.int64).tolist()):
        width = 2 * row.m if level == 0 else row.m
        nodes.append(all_nodes[a : a + size])
        links.append(all_links[b : b + size * width].reshape(size, width))
        a, b = a + size, b + size * width
    return Graph.stored(unit_vectors(v), int(row.m), int(row.entry), nodes, links), v, np.split(ids, ends[:-1])


def blocks_of(queries: DataFrame, block_rows: int):
    """The queries (id, v, dim) in blocks of about `block_rows`: dimension -> ids and vectors."""
    import numpy as np

    blocks = -(-queries.count() // block_rows)
    block = F.pmod(F.xxhash64("id", "v"), F.lit(max(blocks, 1)))
    for b in range(blocks):
        rows = queries.where(block == b).select("dim", "id", "v").toArrow()
        dims, ids, v = (rows.column(c).combine_chunks() for c in ("dim", "id", "v"))
        dims = dims.to_numpy()
        yield {
            int(d): (ids.to_numpy()[dims == d], v.filter(dims == d).flatten().to_numpy().reshape(-1, d).astype(np.float64))
            for d in np.unique(dims)
        }


def search(index: DataFrame, queries: DataFrame, k: int, ef: int, block_rows: int, scratch: Scratch) -> DataFrame:
    """The k nearest of each query (id, v, dim): query_id, vec_id, score, from every shard, not merged yet."""
    import numpy as np
    import pyarrow as pa

    spark, schema, found = queries.sparkSession, "query_id long, vec_id long, score double", []
    for block in blocks_of(queries, block_rows):
        shared = spark.sparkContext.broadcast(block)

        def run(batches, shared=shared):
            for batch in batches:
                for i in range(batch.num_rows):
                    row = SimpleNamespace(**batch.slice(i, 1).to_pylist()[0])
                    ids_asked, wanted = shared.value.get(row.dim, ((), None))
                    if not len(ids_asked):
                        continue
                    out: list[tuple[int, int, float]] = []
                    g, v, ids = load(row)
                    for own, q, u in zip(ids_asked.tolist(), wanted, unit_vectors(wanted), strict=True):
                        near = np.array(g.nearest(u, ef), np.int64)
                        scores = cosines(q, v[near])
                        order = sorted(zip((-scores).tolist(), [int(ids[x][0]) for x in near], near.tolist(), strict=True))
                        best = sorted((s, int(i)) for s, _, x in order[: k + 1] for i in ids[x] if i != own)[:k]
                        out += [(own, i, -s) for s, i in best]
                    columns = list(zip(*out, strict=True)) or [(), (), ()]
                    kinds = (pa.int64(), pa.int64(), pa.float64())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["query_id", "vec_id", "score"])

        found.append(scratch.save(index.mapInArrow(run, schema), f"found-{len(found)}"))
        shared.unpersist()
    return reduce(DataFrame.unionAll, found) if found else spark.createDataFrame([], schema)


def nearest_neighbours(
    vectors: DataFrame,
    queries: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 5,
    shard_rows: int = 8192,
    m: int = 12,
    ef_build: int = 48,
    ef_search: int = 160,
    block_rows: int = 1 << 16,
) -> DataFrame:
    """The k rows of `vectors` nearest to each row of `queries` by cosine, without the query's own id.

    Returns query_id, rank (from 1), vec_id and score: nearest first, ties to the smaller id; all candidates if there are
    fewer than k. Null or zero vectors, vectors with null, infinite or NaN components and rows with a null id take no part.
    Only vectors of equal length are compared. Rows that repeat both id and vector count once. Other columns are not read.
    An empty table gives no rows.
    """
    ship(vectors.sparkSession)

    def usable(df: DataFrame) -> DataFrame:
        v = F.col("v")
        good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
        df = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
        return df.where(F.col("id").isNotNull() & v.isNotNull() & good).withColumn("dim", F.size("v")).distinct()

    scratch = Scratch(vectors.sparkSession)
    index = build_index(usable(vectors), k + 1, shard_rows, m, ef_build)
    found = search(index, scratch.save(usable(queries), "queries"), k, ef_search, block_rows, scratch)
    scratch.drop("queries")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = found.dropDuplicates(["query_id", "vec_id"]).withColumn("rank", F.row_number().over(best))
    return found.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
