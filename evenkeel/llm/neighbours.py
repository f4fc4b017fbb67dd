"""Approximate nearest neighbours: a robust-pruned directed graph per shard, searched by beams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from evenkeel.llm.common import cut, ship

#: Vectors of a shard, on average: what one task holds.
SHARD_VECTORS = 4096
#: Queries that one task runs against one shard, on average.
QUERY_BLOCK = 4096
#: Vectors of a shard differ in length by a factor of this power of two at most.
NORM_BITS = 2
DEGREE, BEAM, BUILD_BEAM = 32, 96, 64
#: A neighbour hides what it is nearer to, by this factor, than the vector itself.
RELAXED = 1.2
BATCH = 256


class Graph:
    """A directed graph over vectors in which greedy search by distance finds neighbours."""

    def __init__(self, vectors: np.ndarray, neighbours: np.ndarray | None = None):
        self.x = np.ascontiguousarray(vectors, np.float32)
        self.square = np.einsum("ij,ij->i", self.x, self.x)
        self.n = len(self.x)
        centre = self.x.mean(axis=0, dtype=np.float64).astype(np.float32) if self.n else self.x.sum(axis=0)
        self.start = int(np.argmin(self.square - 2 * self.x @ centre)) if self.n else 0
        self.out = np.full((self.n, DEGREE), -1, np.int32) if neighbours is None else neighbours

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Beam search of many queries at once → (ids, distances less the query's own
        square), nearest first; -1 where fewer were met."""
        q = np.ascontiguousarray(queries, np.float32)
        m, beam = len(q), min(beam, self.n)
        ids = np.full((m, beam), -1, np.int32)
        far = np.full((m, beam), np.inf, np.float32)
        done = np.ones((m, beam), bool)
        seen = np.zeros((m, self.n), bool)
        ids[:, 0], done[:, 0], seen[:, self.start] = self.start, False, True
        far[:, 0] = self.square[self.start] - 2 * q @ self.x[self.start]
        live = np.arange(m)
        while len(live):
            at = np.argmin(np.where(done[live], np.inf, far[live]), axis=1)
            open_ = ~done[live, at]
            live, at = live[open_], at[open_]
            if not len(live):
                break
            done[live, at] = True
            near = self.out[ids[live, at]]
            fresh = (near >= 0) & ~seen[live[:, None], near]
            seen[live[:, None], np.where(near >= 0, near, self.start)] = True
            d = np.where(fresh, self.square[near] - 2 * np.einsum("ijk,ik->ij", self.x[near], q[live]), np.inf)
            all_d = np.concatenate([far[live], d], axis=1)
            keep = np.argpartition(all_d, beam - 1, axis=1)[:, :beam]
            rows = np.arange(len(live))[:, None]
            far[live] = all_d[rows, keep]
            ids[live] = np.concatenate([ids[live], near], axis=1)[rows, keep]
            done[live] = np.concatenate([done[live], ~fresh], axis=1)[rows, keep]
        order = np.argsort(far, axis=1, kind="stable")
        rows = np.arange(m)[:, None]
        far = far[rows, order]
        return np.where(np.isfinite(far), ids[rows, order], -1), far

    def prune(self, nodes: np.ndarray, candidates: np.ndarray) -> np.ndarray:
        """Neighbours for each node: the nearest candidate is kept and hides those that
        are ``RELAXED`` times nearer to it than to the node, and so on."""
        c = np.where(candidates == nodes[:, None], -1, candidates)
        own = self.x[nodes]
        d = np.where(c >= 0, self.square[c] - 2 * np.einsum("ijk,ik->ij", self.x[c], own), np.inf) + self.square[nodes][:, None]
        order = np.argsort(d, axis=1, kind="stable")
        rows = np.arange(len(nodes))[:, None]
        c, d = c[rows, order], d[rows, order]
        again = np.zeros_like(c, bool)  # the same candidate, met twice
        by_id = np.argsort(c, axis=1, kind="stable")
        sorted_ids = c[rows, by_id]
        np.put_along_axis(again, by_id[:, 1:], sorted_ids[:, 1:] == sorted_ids[:, :-1], axis=1)
        free = (c >= 0) & ~again
        x = self.x[c]
        between = np.maximum(0, self.square[c][:, :, None] + self.square[c][:, None, :] - 2 * x @ x.transpose(0, 2, 1))
        out = np.full((len(nodes), DEGREE), -1, np.int32)
        every = np.arange(len(nodes))
        for k in range(DEGREE):
            best = np.argmax(free, axis=1)
            some = free[every, best]
            if not some.any():
                break
            out[some, k] = c[every, best][some]
            hidden = RELAXED ** 2 * between[every, best] <= d
            free &= ~(hidden & some[:, None])
            free[every, best] = False
        return out

    def build(self, seed: int) -> "Graph":
        """Insert all vectors in random order, in batches: search, prune, link back."""
        order = np.random.Generator(np.random.PCG64(seed)).permutation(self.n)
        if self.n:
            order = np.concatenate([[self.start], order[order != self.start]]).astype(np.int32)
        at, step = 1, 1
        while at < self.n:
            nodes = order[at:at + step]
            found, _ = self.search(self.x[nodes], BUILD_BEAM)
            # members of a batch may be each other's neighbours
            mates = self._mates(nodes)
            self.out[nodes] = self.prune(nodes, np.concatenate([found, mates], axis=1))
            self._link_back(nodes)
            at += step
            step = min(BATCH, 2 * step)
        return self

    def _mates(self, nodes: np.ndarray, most: int = 16) -> np.ndarray:
        x = self.x[nodes]
        d = self.square[nodes][None, :] - 2 * x @ x.T
        np.fill_diagonal(d, np.inf)
        k = min(most, len(nodes) - 1)
        return nodes[np.argpartition(d, k - 1, axis=1)[:, :k]] if k > 0 else np.zeros((len(nodes), 0), np.int32)

    def _link_back(self, nodes: np.ndarray) -> None:
        source = np.repeat(nodes, DEGREE)
        target = self.out[nodes].ravel()
        source, target = source[target >= 0], target[target >= 0]
        new = ~(self.out[target] == source[:, None]).any(axis=1)
        source, target = source[new], target[new]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        names, first, counts = np.unique(target, return_index=True, return_counts=True)
        for start in range(0, len(names), BATCH):
            some = slice(start, start + BATCH)
            width = int(counts[some].max())
            new = np.full((len(names[some]), width), -1, np.int32)
            for i, (f, n) in enumerate(zip(first[some], counts[some])):
                new[i, :n] = source[f:f + n]
            both = np.concatenate([self.out[names[some]], new], axis=1)
            room = (both >= 0).sum(axis=1) <= DEGREE
            packed = np.take_along_axis(both, np.argsort(both < 0, axis=1, kind="stable"), axis=1)[:, :DEGREE]
            if not room.all():
                packed[~room] = self.prune(names[some][~room], both[~room])
            self.out[names[some]] = packed


def lifted(vectors: np.ndarray, largest: float) -> np.ndarray:
    """One coordinate more, so that all have length ``largest``: the nearest by distance
    to a query (with 0 there) is then the largest inner product."""
    rest = np.sqrt(np.maximum(0.0, largest ** 2 - np.einsum("ij,ij->i", vectors, vectors)))
    return np.concatenate([vectors, rest[:, None]], axis=1)


def norm_band(v: Column) -> Column:
    """Number of the band of lengths that a vector belongs to; band 0 reaches from half
    to twice the unit. Nothing overflows, however long or short the vector is."""
    largest = F.array_max(F.transform(v, lambda x: F.abs(x)))
    scaled = F.aggregate(v, F.lit(0.0), lambda a, x: a + (x / largest) * (x / largest))
    return F.round((F.log2(largest) + F.log2(scaled) / 2) / NORM_BITS).cast("int")


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length 1 in the same directions (zero stays zero)."""
    tiny = np.finfo(np.float64).smallest_subnormal
    scaled = vectors / np.maximum(np.abs(vectors).max(axis=1, initial=0.0), tiny)[:, None]
    return scaled / np.maximum(np.sqrt(np.einsum("ij,ij->i", scaled, scaled)), tiny)[:, None]


def _graph_vectors(vectors: np.ndarray, band: int) -> np.ndarray:
    """A shard's vectors by the unit of their band, lifted to its longest vector."""
    scaled = np.ldexp(vectors, -NORM_BITS * band)
    return lifted(scaled, float(np.sqrt(np.einsum("ij,ij->i", scaled, scaled).max())))


def valid_vectors(df: DataFrame, identifier: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, v): vectors that are not null, not zero, and hold only finite numbers."""
    rows = df.select(F.col(identifier).cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & F.coalesce(good, F.lit(False))
                      & F.exists("v", lambda x: x != 0))


def nearest_neighbours(vectors: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): of each query row its ``k`` nearest by inner
    product, its own row apart; fewer if there are no more.

    ``vectors`` and ``queries`` are (vec_id, v) as ``valid_vectors`` gives them. Vectors
    that are equal are one entry of the index with its ``k`` + 1 smallest ids (no query
    can get more of them), so copies neither crowd a graph nor a task. Entries are dealt
    to shards by length (``norm_band``: a few very long vectors would drown the
    differences of all others), then by hash. Each shard builds its graph once and stores it; each is searched
    by all queries, in blocks, and a shard hands on ``k`` + 1 entries a query. Scores are
    computed again in double precision on the original vectors; ties: smaller id first.
    Vectors of other lengths than a query's are never its candidates. Repeated ids
    are rows of their own: a row is a candidate of another one with its id, and each row
    of ``queries`` gets a list with ranks from 1 (equal rows equal lists). Empty tables
    give no rows.
    """
    ship(vectors.sparkSession)
    by_value = W.partitionBy("v").orderBy("vec_id")
    ranked = vectors.select("vec_id", "v").withColumn("n", F.row_number().over(by_value)).where(F.col("n") <= k + 1)
    entries = cut(ranked.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).withColumn(
        "width", F.size("v")).withColumn("band", norm_band(F.col("v"))), "entries")
    stats = entries.groupBy("width", "band").agg(F.count(F.lit(1)).alias("n"))
    stats = stats.withColumn("shards", F.ceil(F.col("n") / SHARD_VECTORS))
    dealt = entries.join(stats.select("width", "band", "shards"), ["width", "band"]).withColumn(
        "shard", F.pmod(F.xxhash64("v"), F.col("shards")).cast("int"))
    built = "width int, band int, shard int, v array<double>, ids array<bigint>, number int, out array<int>"
    # numbers of partitions are stated: shards are small in bytes, not in work
    shards = _total(stats, "shards")
    place = ["width", "band", "shard"]
    index = cut(dealt.repartition(shards, *place).groupBy(*place).applyInPandas(_build, built), "graph")

    asked = queries.groupBy("vec_id", "v").agg(F.count(F.lit(1)).alias("times")).select(
        "vec_id", F.xxhash64("v").alias("row"), "times", "v", F.size("v").alias("width"))
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("vec_id", "row"), F.lit(blocks)).cast("int"))
    bands = stats.groupBy("width").agg(F.collect_list(F.struct("band", "shards")).alias("bands"))  # 140 bands at most
    placed = asked.join(bands, "width").select(*asked.columns, F.inline("bands")).select(
        *asked.columns, "band", F.explode(F.sequence(F.lit(0), (F.col("shards") - 1).cast("int"))).alias("shard"))
    every_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    left, right = (side.repartition(shards * blocks, *place, "block").groupBy(*place, "block")
                   for side in (index.select("*", every_block), placed))
    found = left.cogroup(right).applyInPandas(
        _search(k), "query_id bigint, row bigint, times bigint, vec_id bigint, score double")
    order = W.partitionBy("query_id", "row").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score", F.explode(F.sequence(F.lit(1), F.col("times")))).drop("col")


def _total(stats: DataFrame, column: str) -> int:
    return int(stats.agg(F.sum(column)).first()[0] or 1)


def _build(rows):
    import pandas as pd

    rows = rows.assign(first=[int(i[0]) for i in rows["ids"]]).sort_values("first", kind="stable").drop(columns="first")
    x = _graph_vectors(np.stack(rows["v"].to_list()), int(rows["band"].iloc[0]))
    graph = Graph(x).build(int(rows["shard"].iloc[0]))
    return pd.DataFrame({
        "width": rows["width"].astype("int32"), "band": rows["band"].astype("int32"),
        "shard": rows["shard"].astype("int32"), "v": rows["v"], "ids": rows["ids"], "number": np.arange(len(rows), dtype=np.int32), "out": list(graph.out)})


def _search(k: int):
    def run(entries, queries):
        import pandas as pd

        longs = ("query_id", "row", "times", "vec_id")
        nothing = pd.DataFrame({**{c: np.zeros(0, np.int64) for c in longs}, "score": np.zeros(0)})
        if not len(entries) or not len(queries):
            return nothing
        entries = entries.sort_values("number")
        exact = np.stack(entries["v"].to_list())
        graph = Graph(_graph_vectors(exact, int(entries["band"].iloc[0])), np.stack(entries["out"].to_list()).astype(np.int32))
        ids = entries["ids"].to_list()
        asked = np.stack(queries["v"].to_list())
        names = list(zip(queries["vec_id"].tolist(), queries["row"].tolist(), queries["times"].tolist()))
        out: dict[str, list] = {**{c: [] for c in longs}, "score": []}
        for start in range(0, len(asked), BATCH):
            q = asked[start:start + BATCH]
            near, _ = graph.search(np.concatenate([unit(q), np.zeros((len(q), 1))], axis=1), max(BEAM, 2 * k))
            for (name, row, times), vector, found in zip(names[start:start + BATCH], q, near):
                found = found[found >= 0]
                # summed in one order, so that a score is the same in every shard
                scores = np.array([float(np.dot(exact[i], vector)) for i in found])
                best = found[np.lexsort((found, -scores))[:k + 1]]  # numbers ascend with smallest ids
                for i in best:
                    mine = list(ids[i])
                    if name in mine and np.array_equal(exact[i], vector):
                        mine.remove(name)  # the query's own row, once
                    mine = mine[:k]
                    out["vec_id"] += mine
                    for c, value in (("query_id", name), ("row", row), ("times", times)):
                        out[c] += [value] * len(mine)
                    out["score"] += [float(np.dot(exact[i], vector))] * len(mine)
        return pd.DataFrame({**{c: np.array(out[c], np.int64) for c in longs}, "score": np.array(out["score"], np.float64)})
    return run
