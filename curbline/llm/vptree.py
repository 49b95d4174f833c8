"""Nearest neighbours by largest inner product, with a vantage-point tree in every shard.

Vectors v get one more component, sqrt(M^2 - |v|^2) with M the largest norm, and queries get 0: the Euclidean
distance to a query then falls as the inner product grows, and the triangle inequality holds. Each shard,
a hash of the id, builds its tree over its distinct vectors; a subtree is skipped if the inequality puts it at
``factor`` times the distance of the worst neighbour kept so far or farther. Factor one is exact search,
smaller ones skip more. A shard is one row of bytes, and so is a block of queries: a task reads its shard,
builds the tree once, and lets block after block visit it. The neighbours found in all shards are ranked together.

Defined results: vectors that are null, zero, empty, or hold null or non-finite components take no part,
neither as queries nor as candidates; equal vectors tie, and smaller ids go first; a query meets only
vectors of its own length, and never its own id; with fewer candidates than ``k`` all are returned. Rows equal in id and
vector are one; rows that share an id but not the vector are a candidate and a query each, so that id may be
named for each of its vectors, and its queries are ranked apart. Only ``vec_id`` and ``embedding`` are read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from .runtime import ship, stored

K = 20
FACTOR = 0.95
#: Vectors of a shard and queries of a block, about: what one task holds at a time.
SHARD_ROWS = 12_000
BLOCK_ROWS = 1_500
#: Blocks that visit one copy of a shard: beyond, another task gets a copy.
VISITS = 64
LEAF = 96
#: Distinct vectors kept beyond k, so that exact scores decide the order.
SPARE = 8


class Tree:
    """Vantage-point tree over the rows of ``vectors`` (distinct), for inner products."""

    def __init__(self, vectors: np.ndarray, most_norm: float, seed: int = 1):
        self.vectors = vectors
        self.squared = most_norm * most_norm
        self.extra = np.sqrt(np.maximum(self.squared - (vectors * vectors).sum(1), 0))
        self.rng = np.random.default_rng(seed)
        self.root = self._build(np.arange(len(vectors)))

    def _build(self, rows: np.ndarray):
        """A leaf is its rows; a node is (vantage row, radius, inside, outside)."""
        if len(rows) <= LEAF:
            return rows
        point = int(rows[self.rng.integers(len(rows))])
        away = self._between(rows, point)
        radius = float(np.median(away))
        inside = away <= radius
        if inside.all():  # half or more at one distance
            inside = np.arange(len(rows)) < len(rows) // 2
            radius = float(away[inside].max())
        return point, radius, float(away[~inside].min()), self._build(rows[inside]), self._build(rows[~inside])

    def _between(self, rows: np.ndarray, point: int) -> np.ndarray:
        gap = self.vectors[rows] - self.vectors[point]
        return np.sqrt((gap * gap).sum(1) + (self.extra[rows] - self.extra[point]) ** 2)

    def search(self, queries: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """Inner products and rows of the best ``k`` found for each query, unordered; -inf and -1 where fewer."""
        self.q, self.k, self.factor = queries, k, factor
        self.q_squared = (queries * queries).sum(1)
        self.best = np.full((len(queries), k), -np.inf)
        self.rows = np.full((len(queries), k), -1)
        self.worst = np.full(len(queries), np.inf)
        self._visit(self.root, np.arange(len(queries)))
        return self.best, self.rows

    def _distance(self, which: np.ndarray, products: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(self.q_squared[which] + self.squared - 2 * products, 0))

    def _visit(self, node, which: np.ndarray) -> None:
        if not len(which):
            return
        if isinstance(node, np.ndarray):
            products = self.q[which] @ self.vectors[node].T
            every = np.hstack([self.best[which], products])
            names = np.hstack([self.rows[which], np.broadcast_to(node, products.shape)])
            top = np.argpartition(-every, self.k - 1, axis=1)[:, :self.k]
            self.best[which] = np.take_along_axis(every, top, 1)
            self.rows[which] = np.take_along_axis(names, top, 1)
            least = self.best[which].min(1)
            self.worst[which] = np.where(np.isfinite(least), self._distance(which, np.where(np.isfinite(least), least, 0)), np.inf)
            return
        point, radius, beyond, inside, outside = node
        d = self._distance(which, self.q[which] @ self.vectors[point])
        near = d <= (radius + beyond) / 2
        self._visit(inside, which[near])
        self._visit(outside, which[~near])
        # Rounding must not skip what lies exactly on the border.
        slack = 1e-9 * (1 + d)
        self._visit(outside, which[near][(beyond - d - slack)[near] < self.factor * self.worst[which[near]]])
        self._visit(inside, which[~near][(d - radius - slack)[~near] < self.factor * self.worst[which[~near]]])


class Shard:
    """The tree of a shard's distinct vectors, and the ids of each, ascending."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, most_norm: float):
        self.distinct, where = np.unique(vectors, axis=0, return_inverse=True)
        order = np.lexsort((ids, where.ravel()))
        self.ids, self.first = ids[order], np.searchsorted(where.ravel()[order], np.arange(len(self.distinct) + 1))
        self.tree = Tree(self.distinct, most_norm)

    def neighbours(self, q_ids: np.ndarray, queries: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """place of the query, candidate id, score: up to ``k`` of each query, its own id left out.

        An id may stand for several vectors: the tree returns as many more as the query's own id has, so that k are left.
        """
        named, times = np.unique(self.ids, return_counts=True)
        at = np.minimum(np.searchsorted(named, q_ids), max(len(named) - 1, 0))
        own_rows = int(times[at][named[at] == q_ids].max(initial=1))
        _, rows = self.tree.search(queries, k + own_rows + SPARE, factor)
        out_q, out_v, out_s = [], [], []
        for i, own in enumerate(rows):
            own = own[own >= 0]
            score = (self.distinct[own] * queries[i]).sum(1)  # summed alike wherever a vector stands
            # Of equal vectors the k + 1 smallest ids suffice: one of them may be the query's own.
            found = [(self.ids[self.first[r]:min(self.first[r + 1], self.first[r] + k + 1)], s) for r, s in zip(own, score)]
            v = np.concatenate([f for f, _ in found]) if found else self.ids[:0]
            s = np.concatenate([np.full(len(f), s) for f, s in found]) if found else score
            v, s = v[v != q_ids[i]], s[v != q_ids[i]]
            best = np.lexsort((v, -s))[:k]
            out_q.append(np.full(len(best), i))
            out_v.append(v[best])
            out_s.append(s[best])
        return tuple(np.concatenate(x) for x in (out_q, out_v, out_s))


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, v (array of doubles), dim, norm of the vectors that take part."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (vectors.select(F.col("vec_id").cast("bigint"), v.alias("v")).where(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
            .where(good).withColumn("dim", F.size("v"))
            .withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))).where("norm > 0"))


def _packed(rows: DataFrame, *group: str) -> DataFrame:
    """One row for each group: its rows' places, ids and vectors as bytes."""
    def run(own):
        import pandas as pd
        return pd.DataFrame({**{c: [own[c].iloc[0]] for c in group}, "most": [own["most"].iloc[0]], "rows": [own["row"].to_numpy("<i8").tobytes()],
                             "ids": [own["vec_id"].to_numpy("<i8").tobytes()], "vectors": [np.stack(own["v"].to_numpy()).astype("<f8").tobytes()]})

    schema = ", ".join(f"{c} int" for c in group) + ", most double, rows binary, ids binary, vectors binary"
    return rows.groupBy(*group).applyInPandas(run, schema)


def search(vectors: DataFrame, query_ids, k: int = K, factor: float = FACTOR) -> DataFrame:
    """query_id, rank, vec_id, score; ``query_ids`` is a condition on vec_id that names the queries."""
    ship(vectors.sparkSession)
    rows = stored(usable(vectors).dropDuplicates(["vec_id", "v"]).withColumn("row", F.monotonically_increasing_id()), "vectors")
    counted = rows.agg(F.count("*").alias("n"), F.count(F.when(query_ids, 1)).alias("q")).first()
    shards, blocks = max(1, -(-counted["n"] // SHARD_ROWS)), max(1, -(-counted["q"] // BLOCK_ROWS))
    norms = rows.groupBy("dim").agg(F.max("norm").alias("most"))  # a row per vector length
    with_most = rows.join(norms, "dim")
    # Rows, not ids, are dealt, so that an id with many vectors fills no shard.
    own_shards = _packed(with_most.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int")), "dim", "shard")
    own_blocks = _packed(with_most.where(query_ids).withColumn("block", F.pmod(F.xxhash64("row", F.lit("block")), F.lit(blocks)).cast("int")), "dim", "block")
    columns = ["most", "rows", "ids", "vectors"]
    met = own_shards.select("dim", "shard", F.explode(F.sequence(F.lit(0), F.lit((blocks - 1) // VISITS))).alias("visit"), F.lit(-1).alias("block"), *columns).unionByName(
        own_blocks.select("dim", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.floor(F.col("block") / VISITS).cast("int").alias("visit"), "block", *columns))
    met = met.repartition("dim", "shard", "visit").sortWithinPartitions("dim", "shard", "visit", "block")

    def run(batches):
        import pyarrow as pa
        shard, at = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                dim, number, visit, block, most = (batch.column(c)[i].as_py() for c in range(5))
                place, ids, own = (np.frombuffer(batch.column(c)[i].as_buffer(), kind) for c, kind in ((5, "<i8"), (6, "<i8"), (7, "<f8")))
                own = own.reshape(len(ids), dim)
                if block < 0:
                    shard, at = Shard(ids, own, most), (dim, number, visit)
                elif at == (dim, number, visit):
                    q, v, s = shard.neighbours(ids, own, k, factor)
                    yield pa.RecordBatch.from_arrays([pa.array(place[q]), pa.array(ids[q]), pa.array(v.astype(np.int64)), pa.array(s.astype(float))],
                                                     names=["row", "query_id", "vec_id", "score"])

    found = met.mapInArrow(run, "row bigint, query_id bigint, vec_id bigint, score double")
    rank = F.row_number().over(Window.partitionBy("row").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")
