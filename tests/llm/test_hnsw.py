import numpy as np
import pytest

from histora.llm.hnsw import nearest_neighbours


def brute(vectors, queries, k=5):
    """{(query, rank): (vec_id, score)} by all pairs."""
    ids = sorted(vectors)
    v = np.array([vectors[i] for i in ids], float)
    n = np.sqrt((v * v).sum(axis=1))
    out = {}
    for q in queries:
        s = v @ np.array(vectors[q], float) / (n * np.linalg.norm(vectors[q]))
        order = [i for i in sorted(range(len(ids)), key=lambda i: (-s[i], ids[i])) if ids[i] != q][:k]
        out |= {(q, r): (ids[i], s[i]) for r, i in enumerate(order, 1)}
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, score double, rank int")


def as_rows(vectors):
    return [(i, [float(x) for x in v], 0, 0.0, 0) for i, v in vectors.items()]


@pytest.mark.parametrize("kind", ["random", "clusters"])
def test_recall_over_several_shards(spark, kind):
    rng = np.random.default_rng(1)
    v = rng.normal(size=(3000, 24))
    if kind == "clusters":
        v = rng.normal(size=(12, 24))[rng.integers(0, 12, 3000)] + 0.15 * v
    vectors = {i: x.astype(np.float32).tolist() for i, x in enumerate(v)}
    df = frame(spark, as_rows(vectors))
    rows = nearest_neighbours(df, df.where("vec_id % 50 = 0"), shard_rows=800, block_rows=16).collect()
    want = brute(vectors, range(0, 3000, 50))
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in rows}
    assert set(got) == set(want)
    sets = lambda x: {(q, i) for (q, _), (i, _) in x.items()}
    assert len(sets(got) & sets(want)) >= 0.95 * len(want)
    scores = {(q, i): s for (q, _), (i, s) in want.items()}
    assert all(abs(s - scores[q, i]) < 1e-12 for (q, _), (i, s) in got.items() if (q, i) in scores)


def test_copies_and_ties(spark):
    rng = np.random.default_rng(2)
    vectors = {i: [1.0, 2.0, 3.0] for i in range(300)}
    vectors |= {300 + i: rng.normal(size=3).astype(np.float32).tolist() for i in range(100)}
    df = frame(spark, as_rows(vectors))
    rows = nearest_neighbours(df, df.where("vec_id in (0, 7, 250)")).collect()
    got = {(r.query_id, r["rank"]): r.vec_id for r in rows}
    assert [got[0, r] for r in range(1, 6)] == [1, 2, 3, 4, 5]
    assert [got[7, r] for r in range(1, 6)] == [0, 1, 2, 3, 4]
    assert [got[250, r] for r in range(1, 6)] == [0, 1, 2, 3, 4]


def test_odd_vectors(spark):
    rows = [
        (0, [1.0, 0.0], 0, 0.0, 0), (1, None, 0, 0.0, 0), (2, [0.0, 0.0], 0, 0.0, 0), (3, [1.0, None], 0, 0.0, 0),
        (4, [float("nan"), 1.0], 0, 0.0, 0), (5, [float("inf"), 1.0], 0, 0.0, 0), (6, [], 0, 0.0, 0), (None, [1.0, 1.0], 0, 0.0, 0),
        (7, [1.0, 1.0], 0, 0.0, 0), (7, [1.0, 1.0], 0, 0.0, 0), (8, [1.0, 0.0, 0.0], 0, 0.0, 0), (9, [-1.0, 0.0], None, None, None),
        (50, [1e-30, 1e-30], 0, 0.0, 0), (100, [0.0, 0.0], 0, 0.0, 0),
    ]
    df = frame(spark, rows)
    got = nearest_neighbours(df, df.where("vec_id % 50 = 0")).collect()
    assert [(r["rank"], r.vec_id) for r in got if r.query_id == 0][2:] == [(3, 9)]
    assert {r.vec_id for r in got if r.query_id == 0} == {7, 50, 9}
    assert [r.vec_id for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == 50] == [7, 0, 9]
    assert {r.query_id for r in got} == {0, 50}


def test_empty_tables(spark):
    df = frame(spark, [(0, [1.0, 0.0], 0, 0.0, 0), (1, [1.0, 1.0], 0, 0.0, 0)])
    assert nearest_neighbours(df.limit(0), df.limit(0)).collect() == []
    assert nearest_neighbours(df, df.limit(0)).collect() == []
    assert nearest_neighbours(df.limit(0), df).collect() == []
