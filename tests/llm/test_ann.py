import numpy as np
import pytest
from frames import SMALL
from pyspark.sql import functions as F

from ledgerkit.llm import ann, queries

SCHEMA = "vec_id long, embedding array<float>, rank int, score string"


def brute(ids, x, k=20, every=20):
    out = {}
    for i in [i for i in ids if i % every == 0]:
        score = x @ x[list(ids).index(i)]
        out[i] = sorted(((-s, j) for s, j in zip(score, ids, strict=True) if j != i))[:k]
    return out


def recall(found, expected):
    got = {}
    for r in found:
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    hits = 0
    for q, near in expected.items():
        own = sorted(got.get(q, []))
        assert [r for r, _, _ in own] == list(range(1, len(own) + 1))
        assert len(own) == len(near)
        assert own == [(r, v, s) for r, (v, s) in enumerate(sorted(((v, s) for _, v, s in own), key=lambda x: (-x[1], x[0])), 1)]
        hits += len({v for _, v, _ in own} & {j for _, j in near})
    assert set(got) == set(expected)
    return hits / sum(map(len, expected.values()))


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_op2_recall(spark, sf):
    folder = SMALL.replace("sf0.001", sf)
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").toPandas()
    x = np.array(rows.embedding.tolist(), float)
    found = queries.op2_cross_polytope(spark, folder).collect()
    assert recall(found, brute(rows.vec_id.tolist(), x)) >= 0.95
    place = {v: i for i, v in enumerate(rows.vec_id)}
    for r in found[:200]:
        assert abs(r.score - x[place[r.query_id]] @ x[place[r.vec_id]]) < 1e-12


def test_hadamard_is_a_rotation():
    x = np.random.default_rng(1).normal(size=(5, 16))
    r = ann.rotate(x, 3)
    assert np.allclose(x @ x.T, r @ r.T) and not np.allclose(r, ann.rotate(x, 4))


def test_lengths_copies_and_odd_vectors(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(700, 12)) * np.exp(rng.normal(size=(700, 1)))
    x[300:520] = x[299]  # a third of all rows are copies of one
    x = x.astype(np.float32).astype(float)
    rows = [(i, v.tolist(), i, "s") for i, v in enumerate(x)]
    odd = [(2000, None, 1, ""), (2020, [0.0] * 12, 1, ""), (2040, [float("nan")] + [1.0] * 11, 1, ""), (2060, [], 1, ""),
           (2080, [None] + [1.0] * 11, 1, ""), (2100, [float("inf")] * 12, 1, ""), (None, [1.0] * 12, 1, ""),
           (2120, [1.0, 2.0], 1, ""), (2121, [2.0, 1.0], 1, "")]
    frame = spark.createDataFrame([*rows, rows[5], *odd], SCHEMA)
    found = ann.nearest(frame, F.col("vec_id") % 20 == 0).collect()
    other = [(r.query_id, r.rank, r.vec_id, r.score) for r in found if r.query_id >= 2000]
    assert other == [(2120, 1, 2121, 4.0)]
    assert recall([r for r in found if r.query_id < 2000], brute(range(700), x)) >= 0.95
    hot = sorted((r.rank, r.vec_id) for r in found if r.query_id == 320)
    assert [v for _, v in hot][:5] == [v for _, v in sorted(brute(range(700), x)[320])][:5]


def test_few_and_no_rows(spark):
    frame = spark.createDataFrame([(20, [1.0, 0.0], 1, ""), (21, [0.5, 0.1], 1, ""), (22, [0.5, 0.1], 1, "")], SCHEMA)
    found = sorted(map(tuple, ann.nearest(frame, F.col("vec_id") % 20 == 0).collect()))
    assert found == [(20, 1, 21, 0.5), (20, 2, 22, 0.5)]
    empty = ann.nearest(frame.limit(0), F.lit(True))
    assert empty.count() == 0 and empty.columns == ["query_id", "rank", "vec_id", "score"]
