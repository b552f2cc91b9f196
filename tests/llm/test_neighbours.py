import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm.neighbours import nearest_neighbours

SCHEMA = "vec_id long, embedding array<float>, rank int, score string, block string, query string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "s", "b", "q") for i, v in rows], SCHEMA)


def exact(rows, query_id, k):
    rows = [(i, np.array(v, np.float32).astype(float)) for i, v in rows]
    query = next(v for i, v in rows if i == query_id)
    near = sorted((float(np.sqrt(((v - query) ** 2).sum())), i) for i, v in rows if i != query_id and len(v) == len(query))
    return [(i, d) for d, i in near[:k]]


def test_unusable_vectors_and_ties(spark):
    good = [(i, [float(i % 7), 1.0, -2.0]) for i in range(0, 40, 5)] + [(100, [1.0, 1.0, 1.0])] * 1
    bad = [
        (200, None), (201, []), (202, [0.0, 0.0, 0.0]), (203, [1.0, None, 2.0]), (300, [float("nan"), 1.0, 1.0]),
        (204, [float("inf"), 1.0, 1.0]), (None, [1.0, 2.0, 3.0]), (205, [1.0, 2.0]),
    ]
    found = nearest_neighbours(frame(spark, good + bad), F.col("vec_id") % 100 == 0).collect()
    for query in (0, 100):
        rows = sorted((x for x in found if x.query_id == query), key=lambda x: x["rank"])
        want = exact(good, query, 10)
        assert [x["rank"] for x in rows] == list(range(1, len(want) + 1))
        assert [(x.vec_id, x.score) for x in rows] == want
    assert {x.query_id for x in found} == {0, 100}


def test_many_copies_go_to_the_smaller_ids(spark):
    rows = [(i, [1.0, 2.0]) for i in range(1, 900)] + [(1000, [1.0, 2.0]), (2000, [5.0, 5.0])]
    found = nearest_neighbours(frame(spark, rows).repartition(5), F.col("vec_id") == 1000, k=4)
    assert [(x.vec_id, x.score) for x in found.orderBy("rank").collect()] == [(i, 0.0) for i in (1, 2, 3, 4)]


def test_empty_table(spark):
    assert nearest_neighbours(frame(spark, []), F.col("vec_id") % 100 == 0).count() == 0
    assert nearest_neighbours(frame(spark, [(1, [1.0])]), F.col("vec_id") % 100 == 0).count() == 0


@pytest.mark.parametrize("query_block", [3, 1000])
def test_recall_against_brute_force(spark, query_block):
    rng = np.random.default_rng(4)
    centers = rng.normal(size=(20, 32))
    rows = [(i, (centers[i % 20] + rng.normal(size=32)).tolist()) for i in range(4000)]
    found = nearest_neighbours(
        frame(spark, rows).repartition(4), F.col("vec_id") % 400 == 0, query_block=query_block, chunk_vectors=1500
    ).collect()
    hits = 0
    for query in range(0, 4000, 400):
        want = dict(exact(rows, query, 10))
        mine = {x.vec_id: x.score for x in found if x.query_id == query}
        assert len(mine) == 10
        hits += len(want.keys() & mine.keys())
        assert all(abs(mine[i] - want[i]) < 1e-12 for i in want.keys() & mine.keys())
    assert hits >= 0.9 * 100


def test_a_full_chunk_with_the_registered_settings():
    from strata.llm.collision_search import Chunk, Settings
    from strata.llm.neighbours import CHUNK_VECTORS

    rng = np.random.default_rng(6)
    vectors = rng.normal(size=(200, 64))[rng.integers(200, size=CHUNK_VECTORS)] + 0.7 * rng.normal(size=(CHUNK_VECTORS, 64))
    ids = np.arange(CHUNK_VECTORS)
    chunk, hits, verified = Chunk(ids, vectors, Settings()), 0, 0
    for query in range(0, CHUNK_VECTORS, 400):
        distance = np.sqrt(((vectors - vectors[query]) ** 2).sum(1))
        distance[query] = np.inf
        near, score = chunk.nearest(query, vectors[query], 10)
        hits += len({*near} & {*np.argsort(distance)[:10]})
        verified += len(chunk.candidates(vectors[query]))
        assert np.allclose(score, distance[near])
    n = len(range(0, CHUNK_VECTORS, 400))
    assert hits >= 0.9 * 10 * n
    assert verified <= 0.35 * n * CHUNK_VECTORS


def test_a_query_far_from_all_vectors():
    from strata.llm.collision_search import Chunk, Settings

    rng = np.random.default_rng(7)
    vectors = rng.normal(size=(3000, 8))
    near, score = Chunk(np.arange(3000), vectors, Settings()).nearest(-1, np.full(8, 1e6), 5)
    distance = np.sqrt(((vectors - 1e6) ** 2).sum(1))
    assert len(near) == 5 and np.allclose(score, distance[near])
