"""Graph search over several shards: recall, the share of points visited, ties among many multiples of a vector."""

import collections

import numpy as np

from grantlens.llm import graph_search
from grantlens.llm.vectors import unit


def test_several_shards_find_the_nearest(spark):
    frame = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding")
    rows = frame.orderBy("vec_id").collect()
    ids, units = np.array([r.vec_id for r in rows]), unit(np.array([r.embedding for r in rows]))
    got = collections.defaultdict(set)
    for r in graph_search.nearest(frame, frame.filter("vec_id % 50 = 0"), shard_rows=300).collect():
        got[r.query_id].add(r.vec_id)
    hits = 0
    for at in np.flatnonzero(ids % 50 == 0):
        cosines = units @ units[at]
        cosines[at] = -2
        hits += len(got[ids[at]] & set(ids[np.lexsort((ids, -cosines))[:5]].tolist()))
    assert hits >= 0.95 * 5 * (ids % 50 == 0).sum()


def test_searches_visit_a_small_share():
    random = np.random.default_rng(3)
    centers = random.standard_normal((400, 32))
    units = unit(centers[random.integers(0, 400, 6000)] + 0.6 * random.standard_normal((6000, 32)))
    graph = graph_search.PrunedGraph(units)
    graph.visited = 0
    asked = units[::60]
    found, _ = graph.search(asked.astype(np.float32), graph_search.SEARCH_BEAM)
    best = np.argsort(-(asked @ units.T), axis=1)[:, :6]
    assert np.mean([len(set(f) & set(b)) for f, b in zip(found.tolist(), best.tolist())]) >= 0.9 * 6
    assert graph.visited / len(asked) < 0.2 * len(units)


def test_many_multiples_of_a_vector_tie_by_id(spark):
    random = np.random.default_rng(4)
    base = random.standard_normal(8)
    rows = [(int(i), (base * s).tolist()) for i, s in zip(random.permutation(300), random.uniform(0.1, 50, 300))]
    rows += [(1000 + i, random.standard_normal(8).tolist()) for i in range(50)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = graph_search.nearest(frame, frame.filter("vec_id IN (3, 200)")).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.vec_id) for r in got] == [(3, i) for i in (0, 1, 2, 4, 5)] + [(200, i) for i in range(5)]


def test_queries_pass_in_batches():
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"a": [1, 1, 2], "b": [0, 1, 1]})
    assert [(key, rows.num_rows) for key, rows in graph_search.runs([batch, batch.slice(2)], 2)] == [
        ((1, 0), 1), ((1, 1), 1), ((2, 1), 1), ((2, 1), 1),
    ]


def _recall(rows: np.ndarray, step: int = 20, k: int = 5) -> float:
    ids, units = np.arange(len(rows)), unit(rows)
    got = collections.defaultdict(set)
    for query, found, _ in graph_search.Shard(ids, rows, k + 1).ask(ids[::step], units[::step], k, graph_search.SEARCH_BEAM):
        got[query].add(found)
    cosines = units[::step] @ units.T
    cosines[np.arange(len(cosines)), ids[::step]] = -2
    best = np.argsort(-cosines, axis=1)[:, :k].tolist()
    return np.mean([len(got[q] & set(b)) / k for q, b in zip(ids[::step].tolist(), best)])


def test_groups_far_apart_are_found():
    random = np.random.default_rng(1)
    centers = random.standard_normal((10, 64))
    assert _recall(centers[random.integers(0, 10, 2000)] + 0.3 * random.standard_normal((2000, 64))) >= 0.95


def test_rows_about_a_common_direction_are_told_apart():
    random = np.random.default_rng(2)
    assert _recall(100 + 0.05 * random.standard_normal((2000, 64))) >= 0.95


def test_every_point_is_reached():
    random = np.random.default_rng(3)
    rows = np.repeat(random.standard_normal((40, 16)), 50, axis=0) + 1e-4 * random.standard_normal((2000, 16))
    graph = graph_search.PrunedGraph(unit(rows))
    found, far = graph.find(unit(rows[:4]), len(rows))
    assert np.isfinite(far).all() and (np.sort(found, axis=1) == np.arange(len(rows))).all()
