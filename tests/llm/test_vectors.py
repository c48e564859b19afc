"""Both vector searches against brute force."""

from collections import defaultdict

import duckdb
import numpy as np
import pytest

from tidemark.llm import ann, maxscore, queries
from tools.check_oracle import _norm

SF = "/root/testdata/sf0.01"


def given():
    t = duckdb.connect().execute(f"SELECT vec_id, embedding FROM '{SF}/embeddings.parquet' ORDER BY vec_id").fetchnumpy()
    return t["vec_id"], np.stack(t["embedding"]).astype(float)


def by_query(df):
    out = defaultdict(list)
    for r in df.collect():
        out[r.query_id].append((r.rank, r.vec_id, r.score))
    return {q: sorted(rows) for q, rows in out.items()}


def odd_rows():
    nan, inf = float("nan"), float("inf")
    return [(900, None), (901, [1.0, None, 0.0]), (902, [nan, 0.0, 0.0]), (903, [inf, 0.0, 0.0]), (904, []), (905, [1.0, 2.0]),
            (None, [1.0, 0.0, 0.0])]


def test_ann_recall_and_scores(spark):
    ids, x = given()
    got = by_query(queries.op5_ann_search(spark, SF))
    assert set(got) == {int(i) for i in ids if i % 20 == 0}
    hits = 0
    for q, rows in got.items():
        scores = x @ x[ids == q][0]
        assert [r for r, _, _ in rows] == list(range(1, 21))
        assert [(-s, v) for _, v, s in rows] == sorted((-s, v) for _, v, s in rows)
        assert q not in {v for _, v, _ in rows}
        for _, v, s in rows:
            assert abs(scores[ids == v][0] - s) < 1e-12
        scores[ids == q] = -9
        hits += len({v for _, v, _ in rows} & set(ids[np.argsort(-scores)[:20]].tolist()))
    assert hits >= 0.9 * 20 * len(got)


@pytest.mark.parametrize("n", [1, 2, 15, 60])
def test_ann_small_tables_repeated_vectors_and_odd_rows(spark, n):
    """With so few rows every one of a query's best must be found; vectors repeat and norms differ."""
    rnd = np.random.default_rng(n)
    kinds = rnd.integers(-3, 4, (max(1, n // 3), 3)).astype(float)
    kinds[(kinds == 0).all(axis=1)] = 1.0
    x = kinds[rnd.integers(0, len(kinds), n)]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + odd_rows() + [(0, x[0].tolist()), (950, [0.0, -0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS score", "2 AS bucket")
    got = by_query(ann.nearest(df, lambda i: i % 2 == 0, k=7, probes=27))
    for q in range(0, n, 2):
        scores = x @ x[q]
        expect = [j for j in np.lexsort((np.arange(n), -scores)) if j != q][:7]
        assert got.get(q, []) == [(k + 1, j, scores[j]) for k, j in enumerate(expect)], (q, n)
    assert 950 not in got


def test_ann_of_nothing(spark):
    df = spark.createDataFrame(odd_rows(), "vec_id long, embedding array<double>")
    assert ann.nearest(df.filter("embedding IS NULL"), lambda i: i % 2 == 0).collect() == []
    assert ann.nearest(df.limit(0), lambda i: i % 2 == 0).collect() == []
    assert maxscore.top_k(df.limit(0), lambda i: i % 2 == 0).collect() == []


def test_probe_order_is_by_boundary_distance():
    f = np.array([[0.1, 0.5]])
    keys = ann.probe_keys(f, 1.0, 9)[0]
    own = ann.bucket_key(np.array([[0, 0]]))[0]
    left = ann.bucket_key(np.array([[-1, 0]]))[0]
    far = ann.bucket_key(np.array([[1, 1]]))[0]
    assert keys[0] == own and keys[1] == left and far in keys[-3:] and len(set(keys.tolist())) == 9


@pytest.mark.parametrize("shard_rows", [8192, 7])
def test_maxscore_is_exact(spark, shard_rows):
    rnd = np.random.default_rng(5)
    x = np.round(rnd.normal(size=(120, 6)), 1)
    x[:30] = x[0]
    x[100] = 0
    x[40:50] = -np.abs(x[40:50])
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(900, None), (902, [float("nan")] * 6), (905, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "'q' AS query_id", "0 AS slot")
    got = by_query(maxscore.top_k(df, lambda i: i % 3 == 0, k=5, shard_rows=shard_rows))
    z = np.floor(256 * x).astype(int)
    for q in range(0, 120, 3):
        scores = z @ z[q]
        expect = [j for j in np.lexsort((np.arange(120), -scores)) if j != q][:5]
        assert got[q] == [(k + 1, j, scores[j]) for k, j in enumerate(expect)]


def test_maxscore_fewer_rows_than_k(spark):
    df = spark.createDataFrame([(0, [1.0, 0.5]), (1, [0.5, -1.0]), (0, [1.0, 0.5])], "vec_id long, embedding array<float>")
    assert by_query(maxscore.top_k(df, lambda i: i % 50 == 0)) == {0: [(1, 1, 256 * 128 - 128 * 256)]}


def test_maxscore_skips_rows():
    """The bounds do prune: a far query row reads few rows' later terms, with the same answer."""
    rnd = np.random.default_rng(2)
    x = rnd.integers(-50, 50, (3000, 16))
    x[:20] *= 20
    shard = maxscore.Shard(np.arange(3000), x)
    ids, scores = shard.top(-1, x[0], 5)
    every = x @ x[0]
    best = np.lexsort((np.arange(3000), -every))[:5]
    assert ids.tolist() == best.tolist() and scores.tolist() == every[best].tolist()


def test_maxscore_query_matches_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    rel = con.execute(queries.ORACLE_SQL["op8_maxscore_topk"])
    names = [d[0] for d in rel.description]
    df = queries.op8_maxscore_topk(spark, SF)
    assert df.columns == names
    assert sorted(tuple(map(_norm, r)) for r in df.collect()) == sorted(rel.fetchall())


def brute(rows, is_query, k, measure):
    """Each query row's answers among the other rows of its length; repeated rows count once."""
    rows = sorted({(i, tuple(v)) for i, v in rows})
    out = []
    for r, (q, v) in enumerate(rows):
        if is_query(q):
            found = sorted((-measure(v, w), j) for s, (j, w) in enumerate(rows) if s != r and len(w) == len(v))[:k]
            out += [(q, n, j, -c) for n, (c, j) in enumerate(found, 1)]
    return sorted(out)


def test_lengths_and_repeated_ids(spark):
    """Every length is searched; an id's different vectors are rows of their own."""
    rnd = np.random.default_rng(7)
    rows = [(int(i), rnd.integers(-4, 5, int(n)).astype(float).tolist()) for i, n in zip(rnd.integers(0, 40, 150), rnd.integers(1, 5, 150))]
    rows = [(i, v) for i, v in rows if any(v)] + rows[:5] + [(100, [1.0, 2.0, 0.0]), (3, [1.0, 1.0, 1.0]), (200, [5.0] * 9)]
    rows = [(i, v) for i, v in rows if any(v)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in maxscore.top_k(df, lambda i: i % 2 == 0, k=4, shard_rows=16).collect())
    assert got == brute(rows, lambda i: i % 2 == 0, 4, lambda a, b: sum(int(256 * x) * int(256 * y) for x, y in zip(a, b)))
    got = sorted(tuple(r) for r in ann.nearest(df, lambda i: i % 2 == 0, k=4, probes=27, tile_rows=16).collect())
    expect = brute(rows, lambda i: i % 2 == 0, 4, lambda a, b: sum(x * y for x, y in zip(a, b)))
    assert len(got) == len(expect) and len(set(got) & set(expect)) >= 0.9 * len(expect)
    assert {r[0] for r in got} == {r[0] for r in expect} and not any(r[0] == 200 for r in got)


def test_maxscore_shards_are_sent_once():
    """Building a shard and asking it with variants of one id."""
    x = np.array([[3, 0], [2, 1], [5, 5]])
    shard = maxscore.Shard(np.array([7, 7, 9]), x, np.array([1, 2, 3]))
    assert [a.tolist() for a in shard.top(7, x[0], 2, v=1)] == [[9, 7], [15, 6]]
