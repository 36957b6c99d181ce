import os

import numpy as np
import pytest

from txrisk.llm import ann
from txrisk.llm.ann import hundredth, nearest

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
KINDS = "vec_id long, embedding array<float>, v string, leaf int"


def frame(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    return spark.createDataFrame(
        [(int(i), None if v is None else [None if x is None else float(x) for x in v], "x", 1) for i, v in zip(ids, vectors, strict=True)],
        KINDS,
    )


def plain(vectors, k=10, every=100):
    """{query: [(id, distance)]} by looking at all rows."""
    ids = np.array(sorted(vectors))
    points = np.array([vectors[i] for i in ids], np.float32).astype(float)
    found = {}
    for i in ids[ids % every == 0]:
        far = np.sqrt(((points - np.array(vectors[i], np.float32).astype(float)) ** 2).sum(1))
        order = [j for j in np.lexsort((ids, far)) if ids[j] != i][:k]
        found[int(i)] = [(int(ids[j]), float(far[j])) for j in order]
    return found


def result(rows):
    found = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(found[r.query_id])
    return found


def recall(found, expected):
    hits = [len({i for i, _ in found[q]} & {i for i, _ in near}) / len(near) for q, near in expected.items()]
    return float(np.mean(hits))


def test_recall_on_the_largest_test_table(spark):
    """Isotropic vectors, the hardest case."""
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    vectors = {r.vec_id: r.embedding for r in rows.collect()}
    found, expected = result(nearest(rows, hundredth(rows)).collect()), plain(vectors)
    assert found.keys() == expected.keys()
    assert recall(found, expected) >= 0.9
    for q, near in found.items():
        far = np.sqrt(((np.array([vectors[i] for i, _ in near]) - np.array(vectors[q])) ** 2).sum(1))
        assert np.allclose([s for _, s in near], far, rtol=1e-12)
        assert near == sorted(near, key=lambda x: (x[1], x[0]))


@pytest.mark.parametrize("clusters", [2, 4, 8, 16])
def test_all_ten_are_found_among_small_clusters(spark, clusters):
    """Clusters of eight rows hold fewer than ten neighbours: the search has to go on beyond its own."""
    draw = np.random.default_rng(clusters)
    centres = draw.standard_normal((clusters, 16)) * 50
    vectors = {i * 100: centres[i % clusters] + 1e-3 * draw.standard_normal(16) for i in range(8 * clusters)}
    rows = frame(spark, list(vectors.values()), list(vectors))
    found = result(nearest(rows, hundredth(rows)).collect())
    assert all(len(near) == min(10, 8 * clusters - 1) for near in found.values()) and len(found) == 8 * clusters
    assert recall(found, plain(vectors)) >= 0.9


def test_rows_with_the_query_s_id_do_not_count(spark):
    draw = np.random.default_rng(1)
    vectors = [draw.standard_normal(8) * 1e-3 for _ in range(60)] + [draw.standard_normal(8) + 9 for _ in range(30)]
    rows = frame(spark, vectors, [100] * 60 + list(range(1, 31)))
    found = result(nearest(rows, hundredth(rows), share=0.01).collect())
    assert len(found[100]) == 10 and not {100} & {i for i, _ in found[100]}


def test_no_group_holds_more_than_a_block(spark, monkeypatch):
    """Many queries and many rows in one leaf are dealt out, and the result is the same."""
    draw = np.random.default_rng(2)
    vectors = {i * 100: draw.standard_normal(4) for i in range(300)}
    rows = frame(spark, list(vectors.values()), list(vectors))
    whole = result(nearest(rows, hundredth(rows), depth=0).collect())
    groups = spark.sparkContext.accumulator(0)
    rank = ann.rank_block

    def watched(k):
        inner = rank(k)

        def run(queries, points):
            groups.add(int(len(queries) > 64 or len(points) > 64))
            return inner(queries, points)
        return run

    monkeypatch.setattr(ann, "rank_block", watched)
    dealt = result(nearest(rows, hundredth(rows), depth=0, block=40, sample_rows=8).collect())
    assert groups.value == 0 and dealt == whole


def test_clusters_end_the_search_early(spark):
    draw = np.random.default_rng(3)
    centres = draw.standard_normal((40, 32)) * 10
    points = {i: centres[i % 40] + draw.standard_normal(32) * 0.05 for i in range(4000)}
    rows = frame(spark, list(points.values()))
    found, expected = result(nearest(rows, hundredth(rows)).collect()), plain(points)
    assert recall(found, expected) >= 0.97


def test_copies_and_ties(spark, monkeypatch):
    draw = np.random.default_rng(4)
    points = [draw.standard_normal(8) if i % 3 else np.ones(8) for i in range(900)]
    rows = frame(spark, points).repartition(5)
    found = result(nearest(rows, hundredth(rows), share=1.1, block=64).collect())
    expected = plain(dict(enumerate(points)))
    for q in expected:
        assert [i for i, _ in found[q]] == [i for i, _ in expected[q]]


def test_unusable_vectors(spark):
    good = [[1.0, 2.0], [2.0, 1.0], [3.0, 3.0]]
    bad = [None, [0.0, 0.0], [None, 1.0], [float("nan"), 1.0], [float("inf"), 1.0], [1.0], [], [1.0, 2.0, 3.0]]
    rows = frame(spark, good + bad, [0, 1, 2, 100, 200, 300, 400, 500, 600, 700, 800])
    found = result(nearest(rows, hundredth(rows)).collect())
    assert {q: [i for i, _ in near] for q, near in found.items()} == {0: [1, 2]}


def test_empty_and_alone(spark):
    rows = frame(spark, [[1.0, 2.0]], [100])
    assert nearest(rows, hundredth(rows)).count() == 0
    assert nearest(rows.limit(0), rows.limit(0)).count() == 0
    rows = frame(spark, [[1.0, 2.0], [1.0, 2.0], [2.0, 2.0]], [100, 100, 3])
    assert {(r.query_id, r.rank, r.vec_id) for r in nearest(rows, hundredth(rows)).collect()} == {(100, 1, 3)}


def test_repeated_ids(spark):
    draw = np.random.default_rng(6)
    same = np.ones(8)
    # One id on eleven rows of one vector, on others of its own near it, and on two vectors equally far from it.
    vectors = [same] * 11 + [same + 0.001 * draw.standard_normal(8) for _ in range(40)] + [same] * 12
    ids = [100] * 51 + list(range(101, 113))
    side = np.eye(8)[0]
    vectors += [5 * same + side, 5 * same - side, 5 * same, 5 * same]
    ids += [21, 21, 200, 200]
    vectors += [draw.standard_normal(8) * 50 for _ in range(300)]
    ids += list(range(1001, 1600, 2))[:300]
    rows = frame(spark, vectors, ids).repartition(5)
    queries = rows.filter("vec_id = 200 or (vec_id = 100 and embedding[0] = 1 and embedding[1] = 1)")
    # With this share only the bound ends the search.
    found = result(nearest(rows, queries, share=1.1).collect())
    assert found[100] == [(i, 0.0) for i in range(101, 111)]
    assert found[200][:2] == [(21, 1.0), (21, 1.0)] and len(found[200]) == 10
