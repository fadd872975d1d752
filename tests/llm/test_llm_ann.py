import numpy as np
import pytest

from conftest import SF_SMALL
from lanekit.llm import ann
from lanekit.llm.queries import QUERIES


def brute(ids, rows, k=20, every=20):
    out = {}
    for q, v in zip(ids, rows):
        if q % every == 0:
            score = rows @ v
            order = [i for i in np.lexsort((ids, -score)) if ids[i] != q][:k]
            out[q] = [(int(ids[i]), float(score[i])) for i in order]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def recall(got, wanted):
    hit = sum(len({v for v, _ in got.get(q, [])} & {v for v, _ in w}) for q, w in wanted.items())
    return hit / sum(map(len, wanted.values()))


def test_recall_over_the_whole_table(spark):
    d = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{d}/embeddings.parquet").collect()
    wanted = brute(np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float))
    got = found(QUERIES["op6_nearest_neighbours"](spark, d))
    assert set(got) == set(wanted) and recall(got, wanted) >= 0.99
    for q, w in wanted.items():
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in w], abs=1e-9) or recall({q: got[q]}, {q: w}) < 1


@pytest.mark.parametrize("settings", [{}, {"chunk_rows": 7, "query_rows": 3}])
def test_lengths_ties_and_many_blocks(spark, settings):
    rng = np.random.default_rng(3)
    rows = rng.standard_normal((300, 24)) * rng.lognormal(0, 1, 300)[:, None]
    rows[50:90] = rows[49]                                       # one common vector: ties by id
    ids = rng.permutation(300)
    df = spark.createDataFrame([(int(i), r.tolist()) for i, r in zip(ids, rows)], "vec_id bigint, embedding array<double>")
    got, wanted = found(ann.nearest_in_table(df, **settings)), brute(ids, rows)
    assert {q: [v for v, _ in x] for q, x in got.items()} == {q: [v for v, _ in x] for q, x in wanted.items()}


def test_bounds_hold():
    rng = np.random.default_rng(0)
    for dims in (8, 64, 65):
        x, q = rng.standard_normal((500, dims)) * 3, rng.standard_normal((40, dims))
        turn = ann.rotation(dims)
        assert np.allclose(turn @ turn.T, np.eye(dims))
        guess, width = ann.estimates(q @ turn.T, np.linalg.norm(q, axis=1), *ann.encode(x, turn))
        assert (np.abs(guess - q @ x.T) <= width).mean() > 0.999


def test_edge_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 0.0]), (20, [0.5, 0.5]), (1, [0.0, 0.0]), (2, None), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]),
            (6, [1.0, 2.0, 3.0]), (7, [2.0, 1.0]), (None, [1.0, 1.0]), (8, []), (20, [0.5, 0.5]), (9, [1.0, 1.0])]
    df = spark.createDataFrame([r + (1,) for r in rows], "vec_id bigint, embedding array<double>, block bigint")
    got = ann.nearest_in_table(df)
    by = {}
    for r in got.collect():
        by.setdefault(r.query_id, []).append(r.vec_id)
    assert set(by) == {0, 20} and set(by[0]) == {20, 7, 9} and by[0][0] == 7
    assert ann.nearest_in_table(df.limit(0)).count() == 0
    assert ann.nearest_in_table(df.filter("vec_id = 1")).count() == 0


def test_longer_codes_bound_closer():
    rng = np.random.default_rng(1)
    assert [ann.code_length(d, 100) for d in (1, 30, 100, 101)] == [100, 120, 100, 101]
    x, q = rng.standard_normal((800, 24)) * 3, rng.standard_normal((40, 24))
    mean = []
    for bits in (24, 96, 384):
        turn = ann.rotation(24, bits=bits)
        assert turn.shape == (bits, 24) and np.allclose(turn.T @ turn, np.eye(24))
        packed = ann.encode(x, turn)
        assert packed[0].shape == (800, bits // 8)
        guess, width = ann.estimates(q @ turn.T, np.linalg.norm(q, axis=1), *packed)
        assert (np.abs(guess - q @ x.T) <= width).mean() > 0.999
        mean.append(width.mean())
    assert mean[1] < 0.6 * mean[0] and mean[2] < 0.6 * mean[1]
