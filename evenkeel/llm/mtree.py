"""Exact top-k by inner product: M-trees of paged metric nodes, searched best first.

The metric: vectors of a tree get one coordinate more, so that all have the length
``top`` of its longest; queries get 0 there. Then ``distance² = |q|² + top² - 2 score``,
so the largest inner products are the nearest vectors, and the triangle inequality over
covering radii and stored distances to the parent tells which pages and entries cannot
hold one of them. Bounds are in floating point with a margin; scores are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from evenkeel.llm.common import cut, ship

#: Vectors of a tree, on average: what one task holds.
TREE_VECTORS = 16_384
#: Queries that one task runs against one tree, on average.
QUERY_BLOCK = 4096
#: Vectors around which regions are formed, at most: a table every task may hold.
PIVOTS = 1024
LEAF, FANOUT = 256, 32
#: Share of the lengths involved by which a computed distance may be wrong.
MARGIN = 1e-9
LARGEST = 2 ** 63 - 1

TREE = "width int, region int, shard int"


def quantised(df: DataFrame, scale: float = 1024.0, identifier: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, v): components as ``floor(scale * x)``, whole numbers in doubles.

    Rows take no part whose id or vector is null or whose vector holds a null or a
    component that is not finite (times ``scale``)."""
    rows = df.select(F.col(identifier).cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>").alias("x"))
    good = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * scale) < float("inf")))
    whole = lambda y: F.when(F.abs(y) < 2.0 ** 53, F.floor(y).cast("double")).otherwise(y)
    return rows.where(F.col("vec_id").isNotNull() & F.coalesce(good, F.lit(False))).select(
        "vec_id", F.transform("x", lambda x: whole(x * scale)).alias("v"))


def exact_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows of whole numbers, as 64-bit integers; beyond their range the
    largest (or smallest) of them."""
    reach = float(np.abs(a).max(initial=0.0)) * float(np.abs(b).max(initial=0.0)) * max(1, a.shape[1])
    if reach < 2.0 ** 53:
        return (a @ b.T).astype(np.int64)
    if reach < 2.0 ** 62 and max(np.abs(a).max(), np.abs(b).max()) < 2.0 ** 62:
        return a.astype(np.int64) @ b.astype(np.int64).T
    left, right = ([[int(x) for x in row] for row in m.tolist()] for m in (a, b))
    return np.array([[max(-LARGEST, min(LARGEST, sum(map(int.__mul__, x, y)))) for y in right] for x in left], np.int64)


def exact_top_k(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score): of each query its ``k`` largest inner products,
    the query's own row apart; fewer if there are no more. Ties: smaller id first.

    ``vectors`` and ``queries`` are (vec_id, v) as ``quantised`` gives them; a query is a
    row of ``vectors``. Equal vectors are one entry with its ``k`` + 1 smallest ids, and
    equal query vectors are asked once, so copies crowd neither a tree nor a task. Up to
    ``PIVOTS`` vectors (those of smallest hash) form regions of nearest vectors; a
    region's entries are dealt by hash to trees of about ``TREE_VECTORS``, whose pages
    are stored. A query first searches the tree of its own place, then, in blocks and
    with the k-th score found there as its limit, the trees of all regions whose covering
    radius does not rule them out. The result is exact.

    Rows that repeat an id are candidates of their own, also to the row they repeat;
    repeated queries get lists of their own. Vectors of other lengths than a query's are
    never its candidates. Scores beyond 64 bits count as the largest (or smallest) long.
    Empty tables give no rows.
    """
    spark = vectors.sparkSession
    ship(spark)
    ranked = vectors.select("vec_id", "v").withColumn("n", F.row_number().over(W.partitionBy("v").orderBy("vec_id")))
    entries = cut(ranked.where(F.col("n") <= k + 1).groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).select(
        "v", "ids", F.size("v").alias("width")), "entries")
    pivots = spark.sparkContext.broadcast(_pivots(entries))
    placed = cut(entries.mapInArrow(_place(pivots), "v array<double>, ids array<bigint>, width int, region int, away double"), "placed")
    regions = placed.groupBy("width", "region").agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("radius")).withColumn(
        "shards", F.ceil(F.col("n") / TREE_VECTORS).cast("int"))
    home = F.pmod(F.xxhash64("v"), F.col("shards")).cast("int")
    sizes = regions.select("width", "region", "shards")
    dealt = placed.join(sizes, ["width", "region"]).select("width", "region", home.alias("shard"), "v", "ids")
    index = cut(dealt.groupBy("width", "region", "shard").applyInPandas(
        _build, f"{TREE}, page int, parent int, pivot binary, radius double, away double, "
                "vectors binary, aways binary, ids array<array<bigint>>"), "m-trees")

    asked = cut(queries.select("v").distinct().select(
        F.monotonically_increasing_id().alias("query"), "v", F.size("v").alias("width")), "asked")
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    own = asked.mapInArrow(_place(pivots), "query bigint, v array<double>, width int, region int, away double").join(
        sizes, ["width", "region"]).select("query", "v", "width", "region", home.alias("shard"), F.lit(-LARGEST).alias("least"))
    near = cut(_search(index, own, k, blocks), "near")
    least = near.groupBy("query").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least")).select(
        "query", F.when(F.col("n") > k, F.col("least")).alias("least"))
    known = spark.sparkContext.broadcast({(r["width"], r["region"]): r["radius"] for r in regions.where(
        F.col("width").isin(list(pivots.value))).collect()})  # at most PIVOTS rows
    limited = asked.join(least, "query", "left").select("query", "v", "width", F.coalesce("least", F.lit(-LARGEST)).alias("least"))
    open_ = limited.mapInArrow(_open_regions(pivots, known), "query bigint, v array<double>, width int, region int, least bigint")
    other = open_.join(sizes, ["width", "region"]).withColumn(
        "shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1))).drop("shards").join(
        own.select("query", "width", "region", "shard"), ["query", "width", "region", "shard"], "left_anti")
    far = _search(index, other.select("query", "v", "width", "region", "shard", "least"), k, blocks)

    order = W.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    best = near.unionByName(far).withColumn("at", F.row_number().over(order)).where(F.col("at") <= k + 1)
    lists = best.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("at", "vec_id", "score"))).alias("found"))
    lists = asked.join(lists, "query").mapInArrow(_with_norm, "v array<double>, norm bigint, found array<struct<at: int, vec_id: bigint, score: bigint>>")
    mine = lambda x: (x["vec_id"] == F.col("query_id")) & (x["score"] == F.col("norm"))
    joined = queries.select(F.col("vec_id").alias("query_id"), "v").join(lists, "v").withColumn(
        "own", F.coalesce(F.get(F.filter("found", mine), F.lit(0))["at"], F.lit(k + 1)))  # one row of the query's id and score: itself
    rest = F.slice(F.filter("found", lambda x: x["at"] != F.col("own")), 1, k)
    return joined.select("query_id", F.posexplode(rest).alias("rank", "x")).select(
        "query_id", (F.col("rank") + 1).alias("rank"), "x.vec_id", "x.score")


def _pivots(entries: DataFrame) -> dict[int, np.ndarray]:
    """Vectors around which regions form, by width: at most ``PIVOTS`` altogether. Widths
    with few vectors have one region and need none."""
    counts = entries.groupBy("width").agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    wanted = F.least(F.ceil(F.col("n") / TREE_VECTORS), F.floor(F.col("n") * PIVOTS / F.lit(max(1, total))))
    many = counts.select("width", wanted.alias("regions")).where("regions > 1")
    order = W.partitionBy("width").orderBy(F.xxhash64("v"), "v")
    rows = entries.join(F.broadcast(many), "width").withColumn("place", F.row_number().over(order)).where(
        F.col("place") <= PIVOTS).where("place <= regions").select("width", "v").collect()
    found: dict[int, list] = {}
    for r in rows:
        found.setdefault(r["width"], []).append(r["v"])
    return {w: np.array(sorted(v), np.float64) for w, v in found.items()}


def _matrix(column, width: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), width)


def _unit(*arrays: np.ndarray) -> float:
    """A power of two not far from the largest component: squares stay finite."""
    largest = max(float(np.abs(a).max(initial=0.0)) for a in arrays)
    return float(2.0 ** np.frexp(largest)[1]) if largest > 2.0 ** 200 else 1.0


def _between(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Plain distances of all rows of ``a`` to all rows of ``b``."""
    unit = _unit(a, b)
    a, b = a / unit, b / unit
    square = np.einsum("ij,ij->i", a, a)[:, None] + np.einsum("ij,ij->i", b, b)[None, :] - 2 * a @ b.T
    return unit * np.sqrt(np.maximum(0.0, square))


def _by_width(batch) -> Iterator:
    """(width, rows, their vectors) for each width in a batch."""
    import pyarrow as pa

    widths = batch.column(batch.schema.get_field_index("width")).to_numpy()
    for width in np.unique(widths).tolist():
        rows = np.flatnonzero(widths == width)
        part = batch.take(pa.array(rows))
        yield width, part, _matrix(part.column(part.schema.get_field_index("v")), width)


def _place(pivots):
    """Each vector's region (its nearest pivot) and its distance to that pivot."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for width, part, x in _by_width(batch):
                region, away = np.zeros(len(x), np.int32), np.zeros(len(x))
                if width in pivots.value:
                    far = _between(x, pivots.value[width])
                    region = np.argmin(far, axis=1).astype(np.int32)
                    away = far[np.arange(len(x)), region]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(region), pa.array(away)],
                                                 names=[*part.schema.names, "region", "away"])
    return run


def _open_regions(pivots, radii):
    """Regions that can hold a score of at least ``least``: a vector within ``radius`` of
    a pivot scores at most ``|query| * radius`` more than the pivot."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for width, part, q in _by_width(batch):
                least = part.column(part.schema.get_field_index("least"))
                if width in pivots.value:
                    p = pivots.value[width]
                    radius = np.array([radii.value.get((width, i), -1.0) for i in range(len(p))])
                    length = np.sqrt(np.einsum("ij,ij->i", q / _unit(q), q / _unit(q))) * _unit(q)
                    slack = MARGIN * length[:, None] * (radius + np.sqrt(np.einsum("ij,ij->i", p / _unit(p), p / _unit(p))) * _unit(p))[None, :]
                    with np.errstate(over="ignore", invalid="ignore"):
                        most = q @ p.T + length[:, None] * radius[None, :] + slack
                        limit = least.to_numpy().astype(np.float64)
                        shut = most < (limit - MARGIN * np.abs(limit))[:, None]
                    row, region = np.nonzero(~shut & (radius >= 0)[None, :])
                else:
                    row, region = np.arange(len(q)), np.zeros(len(q), np.int64)
                some = part.take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), some.column(1), some.column(2), pa.array(region.astype(np.int32)), some.column(3)],
                    names=["query", "v", "width", "region", "least"])
    return run


def _with_norm(batches: Iterator) -> Iterator:
    import pyarrow as pa

    for batch in batches:
        for width, part, q in _by_width(batch):
            norms = [int(exact_scores(x[None, :], x[None, :])[0, 0]) for x in q]
            names = part.schema
            yield pa.RecordBatch.from_arrays([part.column(names.get_field_index("v")), pa.array(norms, pa.int64()),
                                              part.column(names.get_field_index("found"))], names=["v", "norm", "found"])


def _search(index: DataFrame, pairs: DataFrame, k: int, blocks: int) -> DataFrame:
    """(query, vec_id, score): of each pair of query and tree the ``k`` + 1 best rows; a
    tree's pages travel to the blocks of queries that ask it."""
    tree = ["width", "region", "shard"]
    pairs = pairs.withColumn("block", F.pmod(F.xxhash64("query"), F.lit(blocks)).cast("int"))
    wanted = index.join(pairs.select(*tree, F.col("block").alias("part")).distinct(), tree)
    return wanted.groupBy(*tree, "part").cogroup(pairs.groupBy(*tree, "block")).applyInPandas(
        _searcher(k), "query bigint, vec_id bigint, score bigint")


class Tree:
    """Pages: a routing vector each with covering radius and distance to the parent's;
    leaves hold vectors with their distances to the page's routing vector."""

    def __init__(self, x: np.ndarray, pivots: np.ndarray, parent: np.ndarray, radius: np.ndarray, away: np.ndarray,
                 leaves: list[np.ndarray], aways: list[np.ndarray]):
        self.x, self.pivots, self.parent, self.radius, self.away = x, pivots, parent, radius, away
        self.leaves, self.aways = leaves, aways
        self.below = [np.flatnonzero(parent == i) for i in range(len(parent))]
        self.unit = _unit(x)
        lengths = np.einsum("ij,ij->i", x / self.unit, x / self.unit)
        self.top = float(lengths.max(initial=0.0))

    @staticmethod
    def lifted(x: np.ndarray, unit: float, top: float) -> np.ndarray:
        x = x / unit
        rest = np.sqrt(np.maximum(0.0, top - np.einsum("ij,ij->i", x, x)))
        return np.concatenate([x, rest[:, None]], axis=1)

    @classmethod
    def build(cls, x: np.ndarray, seed: int) -> "Tree":
        """Bulk load from the top: vectors go to the nearest of ``FANOUT`` of them, until
        ``LEAF`` fit on a page."""
        draw = np.random.Generator(np.random.PCG64(seed))
        unit = _unit(x)
        y = cls.lifted(x, unit, float(np.einsum("ij,ij->i", x / unit, x / unit).max(initial=0.0)))
        centre = int(np.argmin(_between(y, y.mean(axis=0)[None, :])[:, 0]))
        pivot, parent, away, members, leaves = [centre], [-1], [0.0], [np.arange(len(x))], []
        at = 0
        while at < len(pivot):
            rows = members[at]
            if len(rows) > LEAF:
                seeds = draw.choice(rows, min(FANOUT, -(-len(rows) // LEAF) + 1), replace=False)
                nearest = np.argmin(_between(y[rows], y[seeds]), axis=1)
                parts = [rows[nearest == i] for i in range(len(seeds))]
                if max(map(len, parts)) > 0.9 * len(rows):  # nearly all are nearest to one: any split will do
                    parts = np.array_split(rows, len(seeds))
                for part in parts:
                    if len(part):
                        middle = int(part[np.argmin(_between(y[part], y[part].mean(axis=0)[None, :])[:, 0])])
                        pivot.append(middle)
                        parent.append(at)
                        away.append(float(np.linalg.norm(y[middle] - y[pivot[at]])))
                        members.append(part)
                leaves.append(np.zeros(0, np.int64))
            else:
                leaves.append(rows)
            at += 1
        far = [_between(y[m], y[p][None, :])[:, 0] for m, p in zip(members, pivot)]
        aways = [f if len(leaf) else np.zeros(0) for f, leaf in zip(far, leaves)]
        return cls(x, x[pivot], np.array(parent), np.array([f.max(initial=0.0) for f in far]), np.array(away), leaves, aways)

    def search(self, q: np.ndarray, k: int, least: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, entry, score) of each query's ``k`` best entries with a score of at
        least ``least``; ``order`` breaks ties. Each query opens its pages nearest first
        and stops when the nearest page left is too far; the queries that open a page in
        the same round share the computation of distances on it."""
        m, pages = len(q), len(self.pivots)
        unit = max(self.unit, _unit(q))
        top = self.top * (self.unit / unit) ** 2
        scaled, pivots = q / unit, self.pivots / unit
        square = np.einsum("ij,ij->i", scaled, scaled) + top
        slack = MARGIN * (np.sqrt(square) + 1e-300)
        shrink = self.unit / unit
        reach = np.full(m, np.inf)  # how far a vector of the k best may be
        least = least.copy()

        def limit(rows):
            known = least[rows] > -LARGEST
            with np.errstate(invalid="ignore"):
                far = np.sqrt(np.maximum(0.0, square[rows] - 2 * least[rows].astype(np.float64) / unit / unit))
            reach[rows] = np.where(known, far + slack[rows] + 1e-8 * np.sqrt(square[rows]), np.inf)

        every = np.arange(m)
        limit(every)
        far = np.full((m, pages), np.inf)  # distances to routing vectors, where computed
        low = np.full((m, pages), np.inf)  # least distance to anything below an open page
        far[:, 0] = np.sqrt(np.maximum(0.0, square - 2 * scaled @ pivots[0]))
        low[:, 0] = np.maximum(0.0, far[:, 0] - self.radius[0] * shrink)
        held = [np.zeros(0, np.int64)] * 3
        live = every
        while len(live):
            page = np.argmin(low[live], axis=1)
            near = np.isfinite(low[live, page]) & (low[live, page] <= reach[live])
            live, page = live[near], page[near]
            low[live, page] = np.inf
            hits = [held]
            for p in np.unique(page).tolist():
                rows = live[page == p]
                if len(self.leaves[p]):
                    here = self.leaves[p]
                    apart = np.abs(far[rows, p][:, None] - self.aways[p][None, :] * shrink)
                    may = apart <= (reach[rows] + slack[rows])[:, None]
                    some = np.flatnonzero(may.any(axis=0))
                    scores = exact_scores(q[rows], self.x[here[some]])
                    row, col = np.nonzero(may[:, some] & (scores >= least[rows][:, None]))
                    hits.append([rows[row], here[some][col], scores[row, col]])
                else:
                    below = self.below[p]
                    apart = np.abs(far[rows, p][:, None] - self.away[below][None, :] * shrink) - self.radius[below][None, :] * shrink
                    may = apart <= (reach[rows] + slack[rows])[:, None]
                    some = below[may.any(axis=0)]
                    d = np.sqrt(np.maximum(0.0, square[rows][:, None] - 2 * scaled[rows] @ pivots[some].T))
                    far[np.ix_(rows, some)] = d
                    low[np.ix_(rows, some)] = np.where(may[:, may.any(axis=0)], np.maximum(0.0, d - self.radius[some][None, :] * shrink), np.inf)
            if len(hits) > 1:
                row, entry, score = (np.concatenate(x) for x in zip(*hits))
                by = np.lexsort((order[entry], -score, row))
                row, entry, score = row[by], entry[by], score[by]
                first = np.searchsorted(row, row)
                keep = np.arange(len(row)) - first < k
                held = [row[keep], entry[keep], score[keep]]
                full = np.flatnonzero(np.arange(len(row)) - first == k - 1)
                least[row[full]] = score[full]
                limit(row[full])
        return held[0], held[1], held[2]


def _build(key, rows):
    import pandas as pd

    width, region, shard = (int(x) for x in key)
    rows = rows.assign(first=[int(i[0]) for i in rows["ids"]]).sort_values("first", kind="stable")
    x = np.stack(rows["v"].to_list()).astype(np.float64).reshape(len(rows), width)
    tree, ids = Tree.build(x, 1 + shard), rows["ids"].to_list()
    pages = range(len(tree.pivots))
    return pd.DataFrame({
        "width": pd.Series([width] * len(pages), dtype="int32"), "region": pd.Series([region] * len(pages), dtype="int32"),
        "shard": pd.Series([shard] * len(pages), dtype="int32"), "page": pd.Series(list(pages), dtype="int32"),
        "parent": pd.Series(tree.parent, dtype="int32"), "pivot": [p.tobytes() for p in tree.pivots],
        "radius": tree.radius, "away": tree.away, "vectors": [x[leaf].tobytes() for leaf in tree.leaves],
        "aways": [a.tobytes() for a in tree.aways], "ids": [[list(ids[i]) for i in leaf] for leaf in tree.leaves]})


def _searcher(k: int):
    def run(pages, queries):
        import pandas as pd

        nothing = pd.DataFrame({n: np.zeros(0, np.int64) for n in ("query", "vec_id", "score")})
        if not len(pages) or not len(queries):
            return nothing
        pages = pages.sort_values("page")
        width = int(pages["width"].iloc[0])
        matrix = lambda blobs: np.frombuffer(b"".join(blobs), np.float64)
        aways = [np.frombuffer(b, np.float64) for b in pages["aways"]]
        ends = np.cumsum([len(a) for a in aways])
        leaves = [np.arange(e - len(a), e) for e, a in zip(ends, aways)]
        ids = [i for page in pages["ids"] for i in page]
        tree = Tree(matrix(pages["vectors"]).reshape(len(ids), width), matrix(pages["pivot"]).reshape(len(pages), width),
                    pages["parent"].to_numpy(), pages["radius"].to_numpy(), pages["away"].to_numpy(), leaves, aways)
        order = np.empty(len(ids), np.int64)
        order[np.argsort([int(i[0]) for i in ids], kind="stable")] = np.arange(len(ids))
        names = queries["query"].to_numpy()
        q = np.stack(queries["v"].to_list()).astype(np.float64).reshape(len(names), width)
        row, entry, score = tree.search(q, k + 1, queries["least"].to_numpy(), order)
        times = np.array([len(ids[e]) for e in entry.tolist()], np.int64)
        row, score = np.repeat(row, times), np.repeat(score, times)
        vec = np.array([i for e in entry.tolist() for i in ids[e]], np.int64)
        by = np.lexsort((vec, -score, row))
        row, score, vec = row[by], score[by], vec[by]
        keep = np.arange(len(row)) - np.searchsorted(row, row) <= k
        return pd.DataFrame({"query": names[row[keep]], "vec_id": vec[keep], "score": score[keep]})
    return run
