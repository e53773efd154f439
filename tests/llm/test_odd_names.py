"""All operators on tables whose other columns clash with theirs: in another case, with backticks and dots."""

import public_tokenizers
import pytest
from frames import docs  # noqa: F401

from ledgerkit.llm import (
    ann,
    decontaminate,
    lexical,
    licenses,
    linededup,
    neardup,
    packing,
    pieces,
    quality,
    toxicity,
    urlrules,
    variants,
)

EXTRA = "`a``b` int, `c.d` string, Score int, Held_Out int, Matches int, P_toxic double, N_lines int, Rule string, Host string, IDS int"
FIELDS = "a`b c.d Score Held_Out Matches P_toxic N_lines Rule Host IDS".split()
WIDE = (1, "x", 2, 3, 4, 0.5, 5, "r", "h", 6)


@pytest.fixture
def frame(spark):
    texts = ["some plain words here and there", "", None, "the same old line of some forty characters or more\nand another"]
    rows = [(i, t, "s", *WIDE) for i, t in enumerate(texts * 3)]
    return spark.createDataFrame(rows, f"doc_id long, text string, source string, {EXTRA}")


@pytest.fixture
def labels(spark):
    return spark.createDataFrame([(i, i % 2, i % 2, 1) for i in range(12)], "doc_id long, quality int, toxic int, `a``b` int")


@pytest.fixture
def benchmark(spark):
    return spark.createDataFrame([(1, "words here and there. forty of them", 2)], "item_id long, text string, `x``y` int")


def kept(found, *replaced):
    return [c for c in FIELDS if c not in replaced and c in found.columns] == [c for c in FIELDS if c not in replaced]


def test_quality(frame, labels):
    found = quality.classify(frame, labels)
    assert kept(found, "Score", "Held_Out") and found.columns[-3:] == ["score", "held_out", "predicted"]
    assert found.count() == 12 and found.select("score", "`a``b`").first()[1] == 1


def test_toxicity(frame, labels):
    found = toxicity.toxic_documents(frame, labels)
    assert kept(found, "P_toxic") and "p_toxic" in found.columns
    found.collect()


def test_decontamination(frame, benchmark):
    found = decontaminate.find_matches(frame, benchmark)
    assert kept(found, "Matches") and found.select("matches", "`a``b`").count() == 12
    assert decontaminate.decontaminate(frame, benchmark).count() <= 12


def test_line_dedup(frame):
    found = linededup.dedup_lines(frame, min_docs=2)
    assert kept(found, "N_lines") and found.select("n_lines", "`c.d`").count() == 12


def test_url_rules(spark):
    pages = spark.createDataFrame([("x://a.org/b", "r", "h", 1)], "url string, Rule string, HOST string, `a``b` int")
    rules = spark.createDataFrame([("org", "/", "allow", 1)], "host string, path string, verdict string, `a``b` int")
    found = urlrules.judge_urls(pages, rules)
    assert found.columns == ["url", "a`b", "host", "path", "rule", "verdict"]
    assert tuple(found.first()) == ("x://a.org/b", 1, "a.org", "/b", "org/", "allow")


def test_a_host_of_very_many_labels(spark):
    pages = spark.createDataFrame([("x://" + "a." * 20000 + "org/",), ("x://b.org/",)], "url string")
    rules = urlrules.rules_frame(spark, [("org", "/", "allow"), ("a.org", "/", "block")])
    found = {len(r.host): (r.rule, r.verdict) for r in urlrules.judge_urls(pages, rules, default="none").collect()}
    assert found == {40003: ("a.org/", "block"), 5: ("org/", "allow")}
    none = urlrules.judge_urls(pages, rules.filter("false"), default="none").collect()
    assert {r.verdict for r in none} == {"none"}


def test_the_others(frame, benchmark):
    path = public_tokenizers.path("word_bpe_49k.json")
    assert neardup.near_duplicates(frame, size=4, percent=80).count() == 12
    assert packing.pack(frame, path).count() >= 12
    assert licenses.scan_licenses(frame.withColumnRenamed("source", "path")).count() == 12
    assert pieces.encode_pieces(frame, public_tokenizers.path("piece_bpe_32k.model")).count() == 12
    assert variants.spelling_variants(frame, min_chars=3).count() > 0
    assert lexical.ranked_search(frame, benchmark).count() > 0


def test_neighbours_of_extreme_lengths(spark):
    from pyspark.sql import functions as F

    rows = [(0, [1e-200, 0.0]), (1, [0.0, 1e-200]), (2, [1e150, 1e150]), (3, [1.0, 1.0]), (4, [0.0, 0.0]), (5, None)]
    found = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") >= 0, k=2)
    ranked = {(r.query_id, r.rank): (r.vec_id, r.score) for r in found.collect()}
    assert ranked[3, 1] == (2, 2e150) and {q for q, _ in ranked} == {0, 1, 2, 3}
