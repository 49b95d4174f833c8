"""Near-duplicate embeddings by tiled comparison in the order of principal components.

Vectors are turned into the basis of their principal components, which gathers their length in the leading dimensions.
Tiles of a label are compared pair by pair: the products of the leading dimensions are summed first, what the remaining
ones can add is at most the product of the two vectors' suffix norms, and a pair is given up as soon as its
cosine cannot reach the threshold any more. Few pairs see more than a fraction of the dimensions; those that do
and end within rounding of the threshold are computed again from the original vectors.

Before that, whole pairs of tiles are given up: unit vectors whose cosine reaches the threshold differ by a bounded amount
in each dimension. Large labels are cut into cells that wide by one to three leading dimensions, so that only neighbouring
cells meet, on a join key, and of those only the tiles whose boxes in eight dimensions come close enough.
Equal vectors are folded first. A pair of tiles yields, for each of its vectors, the number of links and one link
into a spanning forest, never the pairs themselves: a group of near copies costs rows in proportion to its size.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components, and rows without a
label, link with nothing; only vectors of equal length meet. Rows that repeat, or share an id, are vectors each, linked
like any other. A null id is larger than any other; a component without ids has a null ``component_id``, and rows without an id
are never ``kept``. A table without rows gives no rows. Only ``vec_id``, ``label`` and ``embedding`` are read. What the driver
holds is one square matrix for each length of vectors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import product

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from .components import components
from .ordering import numbered
from .runtime import ship, stored

THRESHOLD = 0.93
#: Vectors of a tile; a task holds two tiles and a block of their products.
TILE = 2_048
#: Tiles of a label from which one, two and three leading dimensions cut it into cells.
CELLS = (16, 256, 4_096)
#: Leading dimensions of a tile's box, and of the first sums.
LEAD = 8
#: Far above the rounding of a product of unit vectors.
SLACK = 1e-9
#: Rows of a tile that are compared at a time.
_ROWS = 512


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, label, dim, key (digest of the vector), v (its doubles in bytes); dim, key and v are null where it takes no part."""
    ship(vectors.sparkSession)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            lists = batch.column(2)
            values = lists.values.fill_null(float("nan")).to_numpy(zero_copy_only=False).astype("<f8") + 0.0  # no negative zero
            ends, valid = lists.offsets.to_numpy(), lists.is_valid().to_pylist()
            raw = []
            for i, ok in enumerate(valid):
                v = values[ends[i]:ends[i + 1]]
                raw.append(v.tobytes() if ok and v.any() and np.isfinite(v).all() else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([None if r is None else len(r) // 8 for r in raw], pa.int32()),
                 pa.array([None if r is None else hashlib.md5(r).hexdigest() for r in raw], pa.string()), pa.array(raw, pa.binary())],
                names=["vec_id", "label", "dim", "key", "v"])

    rows = vectors.select(F.col("vec_id").cast("bigint"), F.col("label").cast("string"), F.col("embedding").cast("array<double>"))
    return rows.mapInArrow(run, "vec_id bigint, label string, dim int, key string, v binary")


def units(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vectors scaled by a power of two (which changes no cosine), their lengths, and unit vectors."""
    x = np.frombuffer(b"".join(raw), "<f8").reshape(len(raw), -1)
    x = np.ldexp(x, -np.frexp(np.abs(x).max(1))[1][:, None])
    length = np.sqrt((x * x).sum(1))
    return x, length, x / length[:, None]


def bases(nodes: DataFrame) -> dict[int, np.ndarray]:
    """For each length of vectors an orthonormal basis, the directions that hold most first."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            dims = batch.column(0).to_numpy()
            for dim in np.unique(dims).tolist():
                u = units([batch.column(1)[int(i)].as_py() for i in np.flatnonzero(dims == dim)])[2]
                sums[dim] = sums.get(dim, 0) + u.T @ u
        for dim, square in sums.items():
            for at in range(0, dim * dim, 100_000):
                part = square.ravel()[at:at + 100_000]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), dim, np.int32)), pa.array(np.arange(at, at + len(part))), pa.array(part)],
                                                 names=["dim", "at", "value"])

    sums = nodes.select("dim", "v").mapInArrow(run, "dim int, at bigint, value double").groupBy("dim", "at").agg(F.sum("value").alias("value")).toPandas()
    out = {}
    for dim, own in sums.groupby("dim"):
        square = own.sort_values("at")["value"].to_numpy().reshape(dim, dim)
        out[int(dim)] = np.linalg.eigh(square)[1][:, ::-1].copy()
    return out


def reach(threshold: float) -> float:
    """Distance of unit vectors whose cosine is the threshold."""
    return float(np.sqrt(2 - 2 * threshold)) + SLACK


def tiled(nodes: DataFrame, turn, threshold: float, tile: int, cells: tuple[int, ...]) -> DataFrame:
    """``nodes`` with lead (leading coordinates), grid (dimensions that cut), cell and part: label, dim, cell and part name a tile."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            lead, dims = np.zeros((batch.num_rows, LEAD)), batch.column(2).to_numpy()
            for dim in np.unique(dims).tolist():
                rows = np.flatnonzero(dims == dim)
                y = units([batch.column(3)[int(i)].as_py() for i in rows])[2] @ turn.value[dim][:, :LEAD]
                lead[rows, :y.shape[1]] = y
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(lead), pa.list_(pa.float64()))],
                                             names=["node", "label", "dim", "v", "n", "lead"])

    turned = nodes.select("node", "label", "dim", "v", "n").mapInArrow(run, "node bigint, label string, dim int, v binary, n bigint, lead array<double>")
    sizes = nodes.groupBy("label", "dim").agg(F.count("*").alias("size"))
    sizes = sizes.select("label", "dim", sum((F.when(F.col("size") > c * tile, 1).otherwise(0) for c in cells), F.lit(0)).alias("grid"))
    width = reach(threshold)
    cell = F.lit(0)
    for i in range(3):  # coordinates lie between -1 and 1; a shift keeps cell numbers apart from their neighbours'
        cell = cell * 4096 + F.when(F.col("grid") > i, F.floor(F.col("lead")[i] / width) + 2048).otherwise(0)
    placed = turned.join(sizes, ["label", "dim"]).withColumn("cell", cell.cast("bigint")).withColumn("along", F.get("lead", F.col("grid")))
    name = ["label", "dim", "cell"]
    ordered = numbered(placed, *name, "along", "node", label="tiles")
    # Places in a cell count on from range to range.
    inside = ordered.groupBy("chunk", *name).agg(F.count("*").alias("rows"), F.min("nth").alias("first"))
    earlier = Window.partitionBy(*name).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    inside = inside.select("chunk", *name, (F.coalesce(F.sum("rows").over(earlier), F.lit(0)) - F.col("first")).alias("shift"))
    return stored(ordered.join(inside, ["chunk", *name]).withColumn("part", F.floor((F.col("nth") + F.col("shift")) / tile))
                  .drop("chunk", "nth", "shift", "along"), "tiles")


def tile_pairs(rows: DataFrame, threshold: float) -> DataFrame:
    """pair, label, dim, and cell and part of both tiles: the pairs that may hold a link, each tile with itself too."""
    name = ["label", "dim", "cell", "part"]
    box = [f(F.col("lead")[i]).alias(f"{side}{i}") for i in range(LEAD) for side, f in (("low", F.min), ("high", F.max))]
    tiles = rows.groupBy(*name).agg(F.first("grid").alias("grid"), *box)
    near = F.lit(None).cast("array<bigint>")
    for grid in range(4):
        steps = [sum(d * 4096 ** (2 - i) for i, d in enumerate(step)) for step in product(*[(-1, 0, 1) if i < grid else (0,) for i in range(3)])]
        near = F.coalesce(near, F.when(F.col("grid") == grid, F.array(*[F.col("cell") + F.lit(s) for s in steps])))
    a, b = tiles.withColumn("met", F.explode(near)).alias("a"), tiles.alias("b")
    place = [F.struct(F.col(f"{t}.cell").alias("cell"), F.col(f"{t}.part").alias("part")) for t in "ab"]
    apart = sum((F.pow(F.greatest(F.lit(0.0), F.col(f"a.low{i}") - F.col(f"b.high{i}"), F.col(f"b.low{i}") - F.col(f"a.high{i}")), 2) for i in range(LEAD)), F.lit(0.0))
    met = a.join(b, (F.col("a.label") == F.col("b.label")) & (F.col("a.dim") == F.col("b.dim")) & (F.col("a.met") == F.col("b.cell"))
                 & (place[0] <= place[1]) & (apart <= reach(threshold) ** 2))
    return stored(met.select(F.monotonically_increasing_id().alias("pair"), "a.label", "a.dim", F.col("a.cell").alias("cell_a"), F.col("a.part").alias("part_a"),
                             F.col("b.cell").alias("cell_b"), F.col("b.part").alias("part_b")), "tile-pairs")


class Tile:
    """Vectors turned into ``basis``, with the norms of what lies beyond each dimension."""

    def __init__(self, raw: list[bytes], basis: np.ndarray):
        self.x, self.length, unit = units(raw)
        self.y = unit @ basis
        self.beyond = np.zeros((len(raw), basis.shape[1] + 1))
        self.beyond[:, :-1] = np.sqrt(np.cumsum((self.y * self.y)[:, ::-1], axis=1)[:, ::-1])

    def __len__(self) -> int:
        return len(self.x)


def linked(a: Tile, b: Tile, threshold: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of ``a`` and ``b`` whose cosine reaches the threshold, block by block; of one tile each pair once."""
    dims, cuts = a.y.shape[1], []
    while not cuts or cuts[-1] < dims:
        cuts.append(min(dims, 2 * cuts[-1] if cuts else LEAD))
    for first in range(0, len(a), _ROWS):
        rows = slice(first, min(first + _ROWS, len(a)))
        sums, i, start = None, None, 0
        for cut in cuts:
            if i is None:  # all products at once, as long as many pairs are left
                more = a.y[rows, start:cut] @ b.y[:, start:cut].T
                sums = more if sums is None else sums + more
                alive = sums + np.outer(a.beyond[rows, cut], b.beyond[:, cut]) >= threshold - SLACK
                if same:
                    alive &= np.arange(len(b)) > np.arange(rows.start, rows.stop)[:, None]
                if cut == dims or np.count_nonzero(alive) * 8 < alive.size:
                    i, j = np.nonzero(alive)
                    s = sums[i, j]
                    i = i + first
            else:
                kept = []
                for at in range(0, len(i), 1 << 15):
                    p, q = i[at:at + (1 << 15)], j[at:at + (1 << 15)]
                    s[at:at + (1 << 15)] += np.einsum("ij,ij->i", a.y[p, start:cut], b.y[q, start:cut])
                    kept.append(s[at:at + (1 << 15)] + a.beyond[p, cut] * b.beyond[q, cut] >= threshold - SLACK)
                kept = np.concatenate(kept) if kept else np.zeros(0, bool)
                i, j, s = i[kept], j[kept], s[kept]
            start = cut
            if i is not None and not len(i):
                break
        if i is not None and len(i):
            sure = s >= threshold + SLACK
            for at in np.array_split(np.flatnonzero(~sure), max(1, int((~sure).sum()) >> 15)):
                p, q = i[at], j[at]
                sure[at] = (a.x[p] * b.x[q]).sum(1) / (a.length[p] * b.length[q]) >= threshold
            yield i[sure], j[sure]


def joined(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """``labels`` (each row's smallest known companion) with the links (i, j) taken in."""
    while len(i):
        a, b = labels[i], labels[j]
        low = np.minimum(a, b)
        np.minimum.at(labels, a, low)
        np.minimum.at(labels, b, low)
        while True:
            after = labels[labels]
            if np.array_equal(after, labels):
                break
            labels = after
        open_ = labels[i] != labels[j]
        i, j = i[open_], j[open_]
    return labels


def compare(a_nodes, a_n, a: Tile, b_nodes, b_n, b: Tile, threshold: float, same: bool):
    """node, links (copies counted), root (a companion in the pair's spanning forest) of every vector with links."""
    off = 0 if same else len(a)
    nodes = a_nodes if same else np.concatenate([a_nodes, b_nodes])
    links, labels = np.zeros(len(nodes)), np.arange(len(nodes))
    for i, j in linked(a, b, threshold, same):
        links += np.bincount(i, weights=b_n[j], minlength=len(nodes))
        links += np.bincount(j + off, weights=a_n[i], minlength=len(nodes))
        labels = joined(labels, i, j + off)
    rows = np.flatnonzero(links)
    return nodes[rows], links[rows].astype(np.int64), nodes[labels[rows]]


def found(rows: DataFrame, pairs: DataFrame, turn, threshold: float) -> DataFrame:
    """node, links, root of every vector with links, for each pair of tiles."""
    sides = []
    for side in "ab":
        own = pairs.select("pair", "label", "dim", F.col(f"cell_{side}").alias("cell"), F.col(f"part_{side}").alias("part"), F.lit(side).alias("side"),
                           ((F.col("cell_a") == F.col("cell_b")) & (F.col("part_a") == F.col("part_b"))).alias("same"))
        sides.append(own if side == "a" else own.where("not same"))
    members = rows.select("label", "dim", "cell", "part", "node", "n", "v").join(sides[0].unionByName(sides[1]), ["label", "dim", "cell", "part"])

    def run(own):
        import pandas as pd
        basis, same = turn.value[int(own["dim"].iloc[0])], bool(own["same"].iloc[0])
        parts = []
        for side in "a" if same else "ab":
            part = own[own["side"] == side]
            parts.append((part["node"].to_numpy(), part["n"].to_numpy(), Tile(part["v"].tolist(), basis)))
        node, links, root = compare(*parts[0], *parts[-1], threshold, same)
        return pd.DataFrame({"node": node, "links": links, "root": root})

    return members.select("pair", "dim", "same", "side", "node", "n", "v").groupBy("pair").applyInPandas(run, "node bigint, links bigint, root bigint")


def near_copies(vectors: DataFrame, threshold: float = THRESHOLD, tile: int = TILE, cells: tuple[int, ...] = CELLS) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``vectors`` (vec_id, label, embedding)."""
    spark = vectors.sparkSession
    rows = stored(usable(vectors), "vectors")
    nodes = rows.where("key is not null and label is not null").groupBy("label", "dim", "key").agg(
        F.count("*").alias("n"), F.min("vec_id").alias("least"), F.first("v").alias("v"))
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    turn = spark.sparkContext.broadcast(bases(nodes))
    places = tiled(nodes, turn, threshold, tile, cells)
    links = stored(found(places, tile_pairs(places, threshold), turn, threshold), "vector-links")
    degrees = links.groupBy("node").agg(F.sum("links").alias("links"))
    forest = components(links.select(F.col("node").alias("a"), F.col("root").alias("b")))
    named = nodes.select("node", "label", "dim", "key", "n", "least").join(degrees, "node", "left").join(forest, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(smallest, "component").select("label", "dim", "key", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("own_links"), "component_id", F.lit(True).alias("met"))
    out = rows.select("vec_id", "label", "dim", "key").join(named, ["label", "dim", "key"], "left")
    component = F.when(F.col("met"), F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select("vec_id", F.coalesce("own_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
