import numpy as np
from frames import SMALL, docs  # noqa: F401
from pyspark.sql import functions as F

from ledgerkit.llm import queries, toxicity
from ledgerkit.llm.quality import held_out


def test_op5_on_held_out_labels(spark):
    sf = SMALL.replace("sf0.001", "sf0.1")
    found = {r.doc_id: r for r in queries.op5_toxicity(spark, sf).collect()}
    labels = spark.read.parquet(f"{sf}/labels.parquet").withColumn("held", held_out("doc_id")).toPandas()
    held = labels[labels.held & (labels.quality == 1)]  # texts that are all junk have lost what made them toxic
    assert held[held.toxic == 1].doc_id.isin(found).mean() >= 0.95
    assert held[held.toxic == 0].doc_id.isin(found).mean() <= 0.01
    assert all(0.2 <= r.p_toxic <= 1 and 0 <= r.p_severe <= 1 for r in found.values())


def test_linear_fit_reaches_the_optimum():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 4))
    y = (rng.random(3000) < 1 / (1 + np.exp(-(x @ [2, -1, 0, 0.5] - 1)))).astype(float)
    m = toxicity.fit_linear(x, y)
    assert np.allclose(m.weights, [2, -1, 0, 0.5], atol=0.25) and abs(m.bias + 1) < 0.2
    gradient = x.T @ (m(x) - y) / len(y)
    assert np.abs(gradient).max() < 0.01


def test_later_links_see_earlier_probabilities():
    rng = np.random.default_rng(2)
    counts = rng.integers(0, 3, (2000, 2)).astype(float)
    first = (counts[:, 0] > 0).astype(float)
    chain = toxicity.fit_chain(("a", "b"), np.array([1, 2], np.uint64), counts, np.column_stack([first, first]))
    assert [len(link.weights) for link in chain.links] == [2, 3]
    assert chain.links[1].weights[2] > 0.5
    p = chain(counts)
    assert np.allclose(p[:, 0], chain.links[0](toxicity.inputs(counts)))
    assert ((p > 0.5) == first[:, None].astype(bool)).mean() > 0.98


def test_odd_rows(spark, docs):
    rows = [(i, f"good words {i}" + (" nasty nasty nasty" if i % 3 == 0 else "")) for i in range(120)]
    rows += [(200, None), (201, ""), (None, "nasty nasty"), (203, "nasty " * 5000), (5, "again"), (5, "again")]
    frame = docs(rows).withColumnsRenamed({"lang": "y", "source": "p_toxic", "n_chars": "label"})
    labels = [(i, int(i % 3 == 0)) for i in range(120)] + [(1, 1), (2, None), (4, 9), (None, 1), (7, 0)]
    labels = spark.createDataFrame(labels, "doc_id long, toxic int")
    chain = toxicity.train(frame, labels)
    out = toxicity.score_toxicity(frame, chain)
    assert out.columns == ["doc_id", "text", "y", "label", "p_toxic", "p_severe"] and out.count() == len(rows)
    flagged = {r.doc_id for r in out.filter("p_toxic >= 0.5").collect()}
    assert flagged == {i for i in range(0, 120, 3)} | {None, 203}
    none = toxicity.toxic_documents(frame, labels.filter(F.lit(False)))
    assert none.select("p_toxic").distinct().collect() == [(0.5,)]
    assert toxicity.toxic_documents(frame.limit(0), labels).count() == 0
