import os

import corpus_pipeline
import public_tokenizers
from frames import SMALL, docs  # noqa: F401
from pyspark.sql import functions as F
from test_linededup import brute as brute_lines
from test_neardup import brute as brute_groups
from test_token_output import check_packing

from ledgerkit.llm import decontaminate, quality
from ledgerkit.session import shared_folder

WORDS = public_tokenizers.path("word_bpe_49k.json")


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_every_stage_against_a_plain_version(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, schema = docs.columns, docs.schema
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "line_dedup", "near_duplicates", "decontamination", "packing"]
    at = {"documents": docs}
    for name, stage in stages.items():
        docs = stage(spark, docs, SMALL)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        at[name] = docs
        if name != "packing":
            assert docs.columns == columns and [f.dataType for f in docs.schema] == [f.dataType for f in schema]

    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    model = quality.train(at["documents"], labels)
    before = at["documents"].toPandas()
    import pyarrow as pa

    good = quality.score(model, quality.features(pa.array(before.text))) >= 0.3
    assert sorted(before[good].doc_id) == sorted(r.doc_id for r in at["quality"].collect())

    pairs = [(r.doc_id, r.text) for r in at["quality"].collect()]
    expected = [(d, t) for d, t, _, _ in brute_lines(pairs, 40, 5)]
    assert rows_of(at["line_dedup"].select("doc_id", "text")) == sorted(expected, key=str)
    assert at["line_dedup"].filter(F.length("text") != F.col("n_chars")).count() == 0

    kept = {d for d, _, _, k in brute_groups(expected, 5, 80) if k}
    assert {r.doc_id for r in at["near_duplicates"].collect()} == kept

    found = decontaminate.find_matches(at["near_duplicates"], spark.read.parquet(f"{SMALL}/benchmark.parquet"))
    clean = {r.doc_id for r in found.collect() if not r.matches}
    assert {r.doc_id for r in at["decontamination"].collect()} == clean

    last = [(r.doc_id, r.text, r.source) for r in at["decontamination"].collect()]
    check_packing(last, at["packing"].collect(), WORDS, 2, 4096, 512)


def test_stages_with_odd_tables(spark, docs):
    frame = docs([(None, "x"), (1, None), (1, ""), (2, "a b"), (2, "a b")]).withColumn("score", F.lit("s"))
    frame = frame.withColumnsRenamed({"lang": "matches", "n_chars": "n_lines"}).withColumn("row", F.lit(1))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, frame, SMALL)
        if name not in ("packing",):
            assert out.columns == frame.columns
            assert out.count() == frame.count()
        assert stage(spark, frame.limit(0), SMALL).count() == 0


def test_only_the_result_stays(spark):
    folder = f"{shared_folder(spark)}/llm"
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    out = corpus_pipeline.run(spark, SMALL)
    left = set(os.listdir(folder)) - before
    assert [name.rsplit("-", 1)[0] for name in left] == ["stage-packing"] and out.count() > 0
