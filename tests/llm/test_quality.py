import zlib

import numpy as np
import pyarrow as pa
from frames import SMALL, docs  # noqa: F401
from pyspark.sql import functions as F

from ledgerkit.llm import quality, queries


def auc(score, label):
    rank = np.argsort(np.argsort(score, kind="stable"), kind="stable")
    good = label == 1
    return (rank[good].sum() - good.sum() * (good.sum() - 1) / 2) / (good.sum() * (~good).sum())


def test_features_of_a_text():
    x = dict(zip(quality.FEATURES, quality.features(pa.array(["One TWO two!!\n1/2 | é, two two", "", None]))[0], strict=True))
    assert np.isclose(x["log_words"], np.log1p(8)) and np.isclose(x["log_lines"], np.log1p(2))
    assert np.isclose(x["exclamations"], 2 / 8) and np.isclose(x["bars"], 1 / 8) and np.isclose(x["shouted_words"], 1 / 8)
    assert np.isclose(x["top_word"], 3 / 8) and np.isclose(x["distinct_words"], 6 / 8) and np.isclose(x["slashes"], 1 / 8)
    assert not quality.features(pa.array(["", None, " \n"]))[:2].any()


def test_features_do_not_depend_on_the_batch():
    texts = ["a b c", "", "SHOUT!! a a\nb b", None, "x" * 9000, "é | é\n\n", "  lead"]
    together = quality.features(pa.array(texts))
    assert np.allclose(together, np.concatenate([quality.features(pa.array([t], pa.string())) for t in texts]))


def test_scores_are_sums_of_table_entries():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)  # nothing but an interaction
    m = quality.fit(x, y)
    row = x[7]
    bins = [int(np.searchsorted(e, v, "right")) for e, v in zip(m.edges, row, strict=True)]
    total = m.intercept + sum(t[b] for t, b in zip(m.tables, bins, strict=True))
    total += sum(t[bins[f] // 4, bins[k] // 4] for f, k, t in m.pairs)
    assert np.isclose(quality.score(m, x)[7], 1 / (1 + np.exp(-total)))
    assert auc(quality.score(m, x), y) > 0.97


def test_op1_is_accurate_on_held_out_labels(spark):
    sf = SMALL.replace("sf0.001", "sf0.1")
    found = queries.op1_quality(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").toPandas()
    assert (found.held_out == [zlib.crc32(str(d).encode()) % 5 == 0 for d in found.doc_id]).all()
    assert (found.predicted == (found.score >= 0.3)).all() and found.score.between(0, 1).all()
    held = found[found.held_out]
    assert auc(held.score.to_numpy(), held.quality.to_numpy()) > 0.97
    assert (held[held.quality == 1].predicted == 1).mean() > 0.99


def test_labels_without_use(spark, docs):
    frame = docs([(1, "a b"), (1, None), (None, "x"), (3, "")]).withColumn("score", F.lit("s")).withColumn("label", F.lit(1))
    labels = spark.createDataFrame([(1, 0), (1, 1), (3, None), (3, 7), (None, 1)], "doc_id long, quality int")
    out = quality.classify(frame, labels)
    assert out.columns == [*[c for c in frame.columns if c != "score"], "score", "held_out", "predicted"]
    assert [r.score for r in out.collect()] == [0.5] * 4
    assert quality.classify(frame.limit(0), labels.limit(0)).count() == 0
