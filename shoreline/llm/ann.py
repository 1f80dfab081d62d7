"""Approximate nearest neighbours by inner product: a robust-pruned directed graph per shard.

Build: distinct vectors are dealt to shards of about ``SHARD`` by the range of their norm (each spans
``2**RANGE``) and a hash, so shards are bounded and no long vector sets the scale for short ones. In a
shard, vectors are divided by its longest norm, and one more coordinate makes the largest inner
product the least distance. In each shard,
points are taken in blocks: a greedy beam search over the graph so far proposes neighbours, and
relaxed pruning keeps a proposal only if no kept neighbour is ``RELAX`` times nearer to it than the
point is. Kept edges are also entered in reverse, and lists that grow too long are pruned again.

Search: every block of queries meets every shard of its dimension once. A beam of ``BEAM`` points
walks the graph from ``ENTRIES`` points that lie far apart; all points of the final beam are scored exactly, in double precision on the
original vectors, and the best of all shards are ranked.

Equal vectors are one point that carries its least ids, as many as a result can show. Vectors that
are NULL, empty, all zero or hold NULL or non-finite components take no part, nor do rows without
an id. Vectors of different lengths live in separate graphs. Rows repeated in full count once; of
different vectors under one id only the least (as arrays compare) counts. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shoreline.llm.common import written

SHARD = 8192
DEGREE = 40
BUILD_BEAM = 80
BEAM = 128
RELAX = 1.5
ENTRIES = 64
RANGE = 6
BLOCK = 512
QUERIES = 1024
EXPAND = 4


def distances(points: np.ndarray, squares: np.ndarray, queries: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Squared distance of each query to its row of points, up to the query's own square."""
    return squares[ids] - 2 * np.einsum("bkd,bd->bk", points[ids], queries)


def beam_search(
    points: np.ndarray, squares: np.ndarray, edges: np.ndarray, start: np.ndarray, queries: np.ndarray, beam: int
) -> tuple[np.ndarray, np.ndarray]:
    """Ids and distances of each query's final beam, nearest first; -1 and inf where it is short.

    ``edges`` has one row of neighbours per point, filled up with the point itself. All queries
    advance together: the nearest ``EXPAND`` unexpanded points of each beam are expanded at a time.
    """
    n, many = len(points), len(queries)
    rows = np.arange(many)[:, None]
    seen = np.zeros((many, n), bool)
    ids = np.broadcast_to(start, (many, len(start))).copy()
    seen[rows, ids] = True
    found = distances(points, squares, queries, ids)
    order = np.argsort(found, axis=1, kind="stable")[:, :beam]
    ids, found = ids[rows, order], found[rows, order]
    done = np.zeros(ids.shape, bool)
    active = np.arange(many)
    while len(active):
        at = np.arange(len(active))[:, None]
        open_ = np.where(done[active] | np.isinf(found[active]), np.inf, found[active])
        step = min(EXPAND, open_.shape[1])
        chosen = np.argpartition(open_, step - 1, axis=1)[:, :step] if step < open_.shape[1] else np.argsort(open_, axis=1)
        real = np.isfinite(open_[at, chosen])
        expanded = np.where(real, ids[active[:, None], chosen], -1)
        mark = done[active]
        mark[at, chosen] = True
        done[active] = mark
        nearby = edges[np.maximum(expanded, 0)].reshape(len(active), -1)
        fresh = ~seen[active[:, None], nearby] & np.repeat(expanded >= 0, edges.shape[1], axis=1)
        # the same neighbour may come from two of the expanded points: keep it once
        nearby = np.where(fresh, nearby, -1)
        nearby.sort(axis=1)
        fresh = nearby >= 0
        again = np.zeros(nearby.shape, bool)
        again[:, 1:] = nearby[:, 1:] == nearby[:, :-1]
        fresh &= ~again
        row, column = np.nonzero(fresh)
        seen[active[row], nearby[row, column]] = True
        near = np.where(fresh, distances(points, squares, queries[active], nearby), np.inf)
        all_ids = np.concatenate([ids[active], nearby], axis=1)
        all_found = np.concatenate([found[active], near], axis=1)
        all_done = np.concatenate([done[active], ~fresh], axis=1)
        keep = min(beam, all_found.shape[1])
        order = np.argpartition(all_found, keep - 1, axis=1)[:, :keep]
        width = ids.shape[1]
        if keep > width:
            ids = np.pad(ids, ((0, 0), (0, keep - width)), constant_values=-1)
            found = np.pad(found, ((0, 0), (0, keep - width)), constant_values=np.inf)
            done = np.pad(done, ((0, 0), (0, keep - width)), constant_values=True)
        ids[active], found[active], done[active] = all_ids[at, order], all_found[at, order], all_done[at, order]
        active = active[(~done[active] & np.isfinite(found[active])).any(1)]
    order = np.argsort(found, axis=1, kind="stable")
    ids, found = ids[rows, order], found[rows, order]
    return np.where(np.isinf(found), -1, ids), found


def prune(points: np.ndarray, own: np.ndarray, ids: np.ndarray, degree: int, relax: float) -> np.ndarray:
    """At most ``degree`` diverse neighbours for each of ``own`` among its row of ``ids`` (-1: none).

    The nearest candidate is kept and all candidates that it is ``relax`` times nearer to than the
    point itself go, until none is left. Rows are filled up with the point itself.
    """
    at = np.arange(len(own))
    wide = points[np.maximum(ids, 0)]
    to_own = ((wide - points[own][:, None, :]) ** 2).sum(2)
    to_own = np.where((ids < 0) | (ids == own[:, None]), np.inf, to_own)
    squares = (wide**2).sum(2)
    out = np.repeat(own[:, None], degree, axis=1)
    left = to_own.copy()
    for k in range(degree):
        best = left.argmin(1)
        real = np.isfinite(left[at, best])
        if not real.any():
            break
        out[:, k] = np.where(real, ids[at, best], own)
        kept = wide[at, best]
        between = squares + squares[at, best][:, None] - 2 * np.einsum("bkd,bd->bk", wide, kept)
        left[(relax**2 * between <= to_own) & real[:, None]] = np.inf
        left[at, best] = np.inf
    return out


def entries(points: np.ndarray, first: int) -> np.ndarray:
    """Points to begin searches at: each next one is the farthest from those before, so that a
    dense cluster is not all that a search gets to see."""
    chosen = [first]
    far = ((points - points[first]) ** 2).sum(1)
    while len(chosen) < min(ENTRIES, len(points)):
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((points - points[chosen[-1]]) ** 2).sum(1))
    return np.unique(chosen)


def build(points: np.ndarray, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Neighbour lists of all points, and the points where searches start."""
    n = len(points)
    points = points.astype(np.float32)
    squares = (points**2).sum(1)
    medoid = int(((points - points.mean(0)) ** 2).sum(1).argmin())
    rng = np.random.default_rng(seed)
    degree = min(DEGREE, max(1, n - 1))
    edges = rng.integers(0, n, (n, degree))
    for relax in (1.0, RELAX):
        order = rng.permutation(n)
        for begin in range(0, n, BLOCK):
            own = order[begin : begin + BLOCK]
            near, _ = beam_search(points, squares, edges, np.array([medoid]), points[own], BUILD_BEAM)
            kept = prune(points, own, np.concatenate([near, edges[own]], axis=1) if relax > 1 else near, degree, relax)
            edges[own] = kept
            _reverse(points, edges, own, kept, degree, relax)
    return edges.astype(np.int32), entries(points, medoid)


def _reverse(points: np.ndarray, edges: np.ndarray, own: np.ndarray, kept: np.ndarray, degree: int, relax: float) -> None:
    """Enter ``own`` into the lists of its kept neighbours, pruning those that were full."""
    target, source = kept.ravel(), np.repeat(own, degree)
    real = target != source
    target, source = target[real], source[real]
    order = np.argsort(target, kind="stable")
    target, source = target[order], source[order]
    nodes, first, counts = np.unique(target, return_index=True, return_counts=True)
    for begin in range(0, len(nodes), BLOCK):
        some = slice(begin, begin + BLOCK)
        wide = np.full((len(nodes[some]), counts[some].max()), -1)
        row = np.repeat(np.arange(len(nodes[some])), counts[some])
        column = np.arange(len(row)) - np.repeat(np.cumsum(counts[some]) - counts[some], counts[some])
        wide[row, column] = source[np.repeat(first[some], counts[some]) + column]
        all_ = np.sort(np.concatenate([edges[nodes[some]], wide], axis=1), axis=1)
        all_[:, 1:][all_[:, 1:] == all_[:, :-1]] = -1
        all_[all_ == nodes[some][:, None]] = -1
        few = (all_ >= 0).sum(1) <= degree
        filled = np.sort(all_, axis=1)[:, ::-1][:, :degree]
        filled = np.where(filled < 0, nodes[some][:, None], filled)
        lists = filled
        if not few.all():
            full = np.flatnonzero(~few)
            lists[full] = prune(points, nodes[some][full], all_[full], degree, relax)
        edges[nodes[some]] = lists


def usable(vector: Column) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0)


def norm_range(vector: Column) -> Column:
    """Number of the range of norms; a norm of 1 lies in the middle of range 0. Divided by the largest
    component first, no square overflows or vanishes."""
    most = F.array_max(F.transform(vector, F.abs))
    square = F.aggregate(vector, F.lit(0.0), lambda a, x: a + (x / most) * (x / most))
    return F.floor((F.log2(most) + F.log2(square) / 2) / RANGE + 0.5).cast("int")


def scaled(whole: np.ndarray) -> np.ndarray:
    """The vectors over their longest norm, each padded to length 1."""
    unit = whole / np.abs(whole).max()
    square = (unit**2).sum(1)
    extra = np.sqrt(np.maximum(square.max() - square, 0))
    return np.concatenate([unit, extra[:, None]], axis=1) / np.sqrt(square.max())


def vectors(rows: DataFrame) -> DataFrame:
    """``vec_id, vector`` of the rows that take part."""
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    return rows.where(F.col("vec_id").isNotNull() & usable(F.col("vector")))


def nearest(spark: SparkSession, rows: DataFrame, every: int = 20, top: int = 20) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``top`` nearest other rows of each row whose id is
    divisible by ``every``."""
    good = vectors(rows)
    ids = good.groupBy("vec_id").count().where("count > 1")
    if not ids.isEmpty():
        good = good.groupBy("vec_id").agg(F.min("vector").alias("vector"))
    good = written(good.select("*", F.size("vector").alias("dim")), "vectors")

    # one point per distinct vector, with as many ids as may be shown besides the query's own
    hashed = good.select("*", F.xxhash64("vector").alias("high"), F.xxhash64("vector", F.lit(1)).alias("low"))
    least = Window.partitionBy("high", "low").orderBy("vec_id")
    points = (
        hashed.withColumn("place", F.row_number().over(least))
        .where(F.col("place") <= top + 1)
        .groupBy("dim", "high", "low")
        .agg(F.array_sort(F.collect_list("vec_id")).alias("ids"), F.first("vector").alias("vector"))
    )
    points = written(points.withColumn("range", norm_range(F.col("vector"))), "points")
    sizes = points.groupBy("dim", "range").agg(F.count("*").alias("n"))
    sizes = written(sizes.withColumn("shards", F.ceil(F.col("n") / SHARD)), "sizes")
    dealt = points.join(sizes, ["dim", "range"]).select(
        "dim", "range", F.pmod(F.col("high"), F.col("shards")).alias("shard"), "ids", "vector"
    )

    def index(shard: pd.DataFrame) -> pd.DataFrame:
        # the order decides the graph: sorted, so that a lost task builds the same one again
        shard = shard.assign(first=shard["ids"].str[0]).sort_values("first")
        whole = np.stack(shard["vector"].to_numpy()).astype(np.float64)
        edges, start = build(scaled(whole))
        ids = shard["ids"].to_list()
        return pd.DataFrame(
            {
                "dim": [whole.shape[1]],
                "shard": [int(shard["shard"].iloc[0])],
                "range": [int(shard["range"].iloc[0])],
                "start": [start.tolist()],
                "whole": [whole.tobytes()],
                "edges": [edges.tobytes()],
                "ids": [np.concatenate(ids).astype(np.int64).tobytes()],
                "counts": [np.array([len(i) for i in ids], np.int32).tobytes()],
            }
        )

    graph = "dim int, shard long, range int, start array<int>, whole binary, edges binary, ids binary, counts binary"
    shards = written(dealt.groupBy("dim", "range", "shard").applyInPandas(index, graph), "graphs")

    asked = good.where(F.col("vec_id") % every == 0)
    blocks = max(1, -(-asked.count() // QUERIES))
    block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block")
    asked = asked.select("dim", block, F.struct("vec_id", "vector").alias("query"))
    asked = asked.groupBy("dim", "block").agg(F.array_sort(F.collect_list("query")).alias("queries"))
    meets = shards.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).join(asked, ["dim", "block"])

    def search(pair: pd.DataFrame) -> pd.DataFrame:
        row = pair.iloc[0]
        dim = int(row["dim"])
        whole = np.frombuffer(row["whole"], np.float64).reshape(-1, dim)
        edges = np.frombuffer(row["edges"], np.int32).reshape(len(whole), -1)
        counts = np.frombuffer(row["counts"], np.int32)
        ids = np.frombuffer(row["ids"], np.int64)
        first = np.cumsum(counts) - counts
        points = scaled(whole).astype(np.float32)
        squares = np.zeros(len(points), np.float32)  # all are equal: only the products count
        start = np.arange(len(whole)) if len(whole) <= BEAM else np.array(row["start"])
        out = []
        queries = row["queries"]
        for begin in range(0, len(queries), BLOCK // 2):
            some = queries[begin : begin + BLOCK // 2]
            exact = np.array([list(q["vector"]) for q in some], np.float64)
            asked_ids = np.array([q["vec_id"] for q in some], np.int64)
            unit = exact / np.abs(exact).max(1, keepdims=True)
            unit /= np.linalg.norm(unit, axis=1, keepdims=True)
            padded = np.concatenate([unit, np.zeros((len(some), 1))], axis=1).astype(np.float32)
            near, _ = beam_search(points, squares, edges, start, padded, max(BEAM, top + 1))
            scores = np.einsum("bkd,bd->bk", whole[np.maximum(near, 0)], exact)
            for q, (found, score) in enumerate(zip(near, scores, strict=True)):
                real = found >= 0
                found, score = found[real], score[real]
                many = counts[found]
                at = np.repeat(first[found] - (np.cumsum(many) - many), many) + np.arange(many.sum())
                each, value = ids[at], np.repeat(score, many)
                other = each != asked_ids[q]
                each, value = each[other], value[other]
                best = np.lexsort((each, -value))[:top]
                out.append(pd.DataFrame({"query_id": asked_ids[q], "vec_id": each[best], "score": value[best]}))
        return pd.concat(out, ignore_index=True)

    found = meets.groupBy("dim", "range", "shard", "block").applyInPandas(search, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")
