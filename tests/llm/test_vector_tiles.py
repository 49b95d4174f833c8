from collections import Counter

import numpy as np
import pytest

from curbline.llm import queries, vector_tiles
from odd_rows import SMALL
import oracle

VECTORS = "vec_id bigint, embedding array<float>, label int, key string, node int, part string"


def plain(rows, threshold=0.93):
    """The contract over all pairs."""
    kept = [(i, np.array(v, float), label) for i, (_, v, label) in enumerate(rows)
            if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    parent, links = list(range(len(rows))), Counter()

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for n, (i, x, label) in enumerate(kept):
        for j, y, other in kept[n + 1:]:
            if label == other and len(x) == len(y) and (x * y).sum() / (np.sqrt((x * x).sum()) * np.sqrt((y * y).sum())) >= threshold:
                links[i] += 1
                links[j] += 1
                parent[root(j)] = root(i)
    least = {}
    for i, (vec, _, _) in enumerate(rows):
        if vec is not None:
            least[root(i)] = min(vec, least.get(root(i), vec))
    return Counter((vec, links[i], least.get(root(i)), vec is not None and vec == least.get(root(i))) for i, (vec, _, _) in enumerate(rows))


def found(df, **kw):
    return Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in vector_tiles.near_copies(df, **kw).collect())


def table(spark, rows):
    return spark.createDataFrame([(i, v, label, "k", 1, "p") for i, v, label in rows], VECTORS).repartition(4)


def clustered(n, dims, seed, spread=0.35):
    """Near copies around some centres, with chains and copies."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(max(2, n // 15), dims))
    v = centres[rng.integers(0, len(centres), n)] + rng.normal(size=(n, dims)) * spread * rng.random((n, 1))
    return [(i, np.float32(x).tolist(), int(rng.integers(0, 2))) for i, x in enumerate(v)]


@pytest.mark.parametrize("tile, cells", [(2_048, (16, 256, 4_096)), (16, (0, 2, 4)), (7, (2, 3, 1_000)), (5, (1_000, 1_000, 1_000))])
def test_links_equal_all_pairs_in_any_tiles(spark, tile, cells):
    rows = clustered(500, 24, 3) + [(1_000 + i, [1.0, 2.0, 0.5], 1) for i in range(150)] + [(2_000, [0.0] * 23 + [1.0], 1)]
    assert found(table(spark, rows), tile=tile, cells=cells) == plain(rows)


def test_odd_rows(spark):
    v, w = [1.0, 0.5, -2.0, 0.25], [1.0, 0.5, -2.0, 0.26]
    rows = [(5, v, 1), (3, w, 1), (3, w, 1), (4, v, 2), (None, v, 1), (None, v, 3), (None, v, 3), (6, None, 1), (7, [], 1), (8, [0.0, -0.0, 0.0, 0.0], 1),
            (9, [1.0, None, 1.0, 1.0], 1), (10, [1.0, float("nan"), 1.0, 1.0], 1), (11, [float("inf"), 1.0, 1.0, 1.0], 1), (12, v, None), (13, v[:3], 1),
            (14, [1e-30 * x for x in v], 1), (15, [-x for x in v], 1), (16, [1e30 * x for x in v], 1)]
    assert found(table(spark, rows)) == plain(rows)
    assert found(table(spark, [])) == Counter()


def test_whole_table_equals_all_pairs(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    assert found(df, tile=20, cells=(1, 2, 3)) == plain(rows)


def test_pairs_are_given_up_early_and_none_is_lost():
    rng = np.random.default_rng(8)
    x = rng.normal(size=(700, 64)) * np.linspace(2, 0.2, 64)
    x[300:600] = x[:300] + rng.normal(size=(300, 64)) * 0.12
    raw = [r.tobytes() for r in x]
    basis = np.linalg.eigh(x.T @ x)[1][:, ::-1]
    a = vector_tiles.Tile(raw, basis)
    got = {(i, j) for p, q in vector_tiles.linked(a, a, 0.93, True) for i, j in zip(p.tolist(), q.tolist())}
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    cos = unit @ unit.T
    assert got == {(i, j) for i, j in zip(*np.nonzero(cos >= 0.93)) if i < j}
    lead = a.y[:, :16] @ a.y[:, :16].T + np.outer(a.beyond[:, 16], a.beyond[:, 16])
    assert (lead >= 0.93).mean() < 0.2


def test_a_group_of_near_copies_costs_rows_in_proportion(spark):
    rng = np.random.default_rng(9)
    rows = [(i, np.float32(np.ones(16) + rng.normal(size=16) * 0.01).tolist(), 1) for i in range(600)]
    got = found(table(spark, rows), tile=100)
    assert got == Counter((i, 599, 0, i == 0) for i in range(600))
    tile = vector_tiles.Tile([np.array(v, float).tobytes() for _, v, _ in rows], np.eye(16))
    node, links, root = vector_tiles.compare(np.arange(600), np.ones(600), tile, np.arange(600), np.ones(600), tile, 0.93, True)
    assert len(node) == 600 and set(links) == {599} and set(root) == {0}


def test_oracle_gives_the_same_rows(spark):
    con = oracle.connect(SMALL)
    df = queries.op13_vector_tiles(spark, SMALL)
    assert oracle.spark_rows(df) == oracle.duck_rows(con, queries.ORACLES["op13_vector_tiles"])
    assert not oracle.type_mismatches(df, con, queries.ORACLES["op13_vector_tiles"])
