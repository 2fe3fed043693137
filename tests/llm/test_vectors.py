from types import SimpleNamespace

import numpy as np
import pytest

from tidewatt.llm import vectors as op

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, cosine=0.9):
    ok = {}
    for k, (_, v, _) in enumerate(rows):
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array(v, np.float32).astype(float)
            ok[k] = x / np.linalg.norm(x)
    links = {k: {j for j, y in ok.items() if j != k and len(x) == len(y) and x @ y >= cosine} for k, x in ok.items()}
    out = {}
    for k in range(len(rows)):
        seen, todo = {k}, [k]
        while todo:
            for j in links.get(todo.pop(), ()):
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        out[rows[k][0]] = len(links.get(k, ())), min(rows[j][0] for j in seen)
    return out


def made(seed, dim, groups, each, noise):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(groups):
        centre = rng.normal(size=dim)
        centre /= np.linalg.norm(centre)
        for _ in range(rng.integers(1, each)):
            rows.append((centre + rng.normal(size=dim) * noise * rng.random()) * rng.uniform(0.1, 9))
    return [[float(x) for x in v] for v in rows]


ODD = [None, [], [0.0] * 8, [float("nan")] + [1.0] * 7, [None] + [1.0] * 7, [float("inf")] * 8, [1.0] * 8, [2.0] * 8, [1.0] * 8,
       [1.0, 1.0], [1.0, 1.0], [-1.0] * 8, [1e-30] * 8, [-0.0, 1.0] + [0.0] * 6, [0.0, 1.0] + [0.0] * 6]


@pytest.mark.parametrize("block", [8192, 60])
def test_same_as_all_pairs(spark, block):
    vectors = made(1, 8, 60, 8, 0.35) + ODD
    rows = [(k * 3 + 1, v, k % 4) for k, v in enumerate(vectors)]
    found = op.near_vectors(spark.createDataFrame(rows, SCHEMA), block=block).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in found} == brute(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)


def test_registered_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [tuple(r) for r in table.select("vec_id", "embedding", "label").collect()]
    found = op.near_vectors(table).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in found} == brute(rows)


def test_no_rows_no_usable_rows_and_further_columns(spark):
    assert op.near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0
    odd = spark.createDataFrame([(1, None, 0), (2, [0.0, 0.0], 0), (None, [1.0, 0.0], 0), (None, None, 1)], SCHEMA)
    clash = odd.selectExpr("*", "1 AS rep", "'x' AS x", "2 AS size", "3 AS label_2")
    found = op.near_vectors(clash).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in found if r.vec_id) == [(1, 0, 1, True), (2, 0, 2, True)]
    assert [r.kept for r in found if r.vec_id is None] == [True, True]


def test_null_and_shared_ids_lose_no_link(spark):
    rows = [(1, [1.0, 0.0], 0), (None, [1.0, 0.01], 0),  # a neighbour that no id names
            (5, [0.0, 1.0], 0), (None, [-0.4, 1.0], 0), (6, [-0.8, 1.0], 0),  # 5 and 6 meet by it alone
            (8, [-1.0, 0.0], 0), (8, [0.0, -1.0], 0), (9, [0.0, -2.0], 0), (7, [-1.0, 0.1], 0),  # two rows of one id
            (None, [-1.0, -1.0], 0), (None, [-1.0, -1.0], 0)]
    found = op.near_vectors(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in found if r.vec_id)) == [
        (1, 1, 1), (5, 1, 5), (6, 1, 5), (7, 1, 7), (8, 1, 7), (8, 1, 8), (9, 1, 8)]
    nameless = [r for r in found if r.vec_id is None]
    assert sorted(r.n_links for r in nameless) == [1, 1, 1, 2]
    assert all(r.component_id is None and r.kept for r in nameless)


def test_tree_covers_its_points():
    points = op.unit_vectors(np.array(made(2, 6, 40, 9, 0.3)))
    nodes, cover = op.cover_tree(points)
    below = {}
    for k in range(len(nodes) - 1, -1, -1):
        centre, first, end = nodes[k]
        below[k] = [centre] if first == end else [p for c in range(first, end) for p in below[c]]
        gap = np.sqrt(((points[below[k]] - points[centre]) ** 2).sum(1)).max()
        assert gap <= cover[k] + 1e-6
    assert sorted(below[0]) == list(range(len(points)))


def test_small_nodes_go_on_together(monkeypatch):
    """The steps of a traversal follow the points, not the pairs of small nodes; the links are those of all pairs."""
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(300, 24))
    points = np.repeat(centres, 3, axis=0) + rng.normal(size=(900, 24)) * 0.2 * rng.random((900, 1))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    nodes, cover = op.cover_tree(points)
    row = SimpleNamespace(
        ids_a=np.arange(900).tobytes(), sizes_a=np.ones(900, np.int64).tobytes(), points_a=points.tobytes(),
        nodes_a=nodes.tobytes(), cover_a=cover.tobytes())
    calls, children = [], op.Block.children
    monkeypatch.setattr(op.Block, "children", lambda block, nodes: calls.append(len(nodes)) or children(block, nodes))
    one = op.Block(row, "a")
    found = op.Found(one, one, True, 0.9)
    found.visit(np.zeros(1, np.int64), np.zeros(1, np.int64))
    assert found.count_one.tolist() == ((points @ points.T >= 0.9).sum(1) - 1).tolist()
    assert len(calls) < (cover > 0).sum() / 3
