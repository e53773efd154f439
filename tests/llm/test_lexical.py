import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
from frames import SMALL, docs  # noqa: F401

from ledgerkit.llm import lexical, oracles, queries

MARKS = "[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+"


def terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in re.findall(MARKS, text or "")]


def brute(docs, items, k):
    bags = [(d, Counter(terms(t))) for d, t in docs]
    bags = [(d, b, sum(b.values())) for d, b in bags if b]
    n_docs, n_terms = len(bags), sum(n for _, _, n in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    out = []
    for item, text in items:
        asked = terms(text)
        scores = []
        for d, bag, n in bags:
            m = 100 - 25 + (25 * n * n_docs) // n_terms
            score = 0
            for t in asked:
                if t in bag:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((1000000000 * bag[t]) // (1000 * bag[t] + 12 * m))
            if score > 0:
                scores.append((-score, -1 if d is None else d, d))
        out += [(item, i + 1, d, -s) for i, (s, _, d) in enumerate(sorted(scores, key=lambda x: x[:2])[:k])]
    return out


def result(df):
    rows = [(r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()]
    return sorted(rows, key=lambda r: r[:2])


def test_op13_against_brute_force_and_sql(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    found = result(queries.op13_lexical(spark, SMALL))
    assert found == sorted(brute(rows, items, 20))
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"create view {name} as select * from '{SMALL}/{name}.parquet'")
    sql = con.execute(oracles.ORACLES["op13_lexical"])
    names = [c[0] for c in sql.description]
    rows = [dict(zip(names, r, strict=True)) for r in sql.fetchall()]
    assert sorted((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in rows) == found


def words_and_rows(seed, n):
    r = random.Random(seed)
    vocabulary = ["the", "of", "été", "naïve", *(f"w{i}" for i in range(60))]
    weights = [40, 30, 20, 10, *(1 + 30 // (i + 1) for i in range(60))]
    rows = [(i, " ".join(r.choices(vocabulary, weights, k=r.randint(0, 40)))) for i in range(n)]
    rows += [(n + i, rows[7][1]) for i in range(300)]  # one large group of copies
    items = [(i, " ".join(r.choices(vocabulary, weights, k=r.randint(1, 12)))) for i in range(25)]
    return rows, items


def test_random_texts_with_copies_ties_and_repeats(spark, docs, monkeypatch):
    rows, items = words_and_rows(1, 1500)
    items += [(100, None), (101, ""), (102, "unknown"), (103, "the the THE"), (104, rows[7][1])]
    asked = spark.createDataFrame(items, "item_id long, text string")
    expected = sorted(brute(rows, items, 20))
    assert result(lexical.ranked_search(docs(rows).repartition(3), asked, k=20)) == expected
    monkeypatch.setattr(lexical, "ITEM_TERMS", 40)  # several blocks of items
    assert result(lexical.ranked_search(docs(rows).repartition(3), asked, k=20)) == expected


def test_odd_rows_and_names(spark, docs):
    asked = spark.createDataFrame([(1, "Alpha beta"), (2, None)], "item_id long, text string")
    rows = [(5, "alpha"), (5, "alpha"), (None, "ALPHA"), (3, None), (4, ""), (6, "beta " * 20000 + "alpha"), (9, "-- !")]
    items = [(1, "Alpha beta"), (2, None)]
    assert result(lexical.ranked_search(docs(rows), asked)) == sorted(brute(rows, items, 20))
    assert result(lexical.ranked_search(docs([]), asked)) == []
    assert result(lexical.ranked_search(docs(rows), asked.filter("false"))) == []
    clash = spark.createDataFrame([(1, "alpha", 3, "x", 1)], "doc_id long, text string, Score int, `a``b` string, Terms int")
    assert [r[:3] for r in result(lexical.ranked_search(clash.union(clash), asked))] == [(1, 1, 1), (1, 2, 1)]


def test_bounds_hold_and_prune():
    r = np.random.default_rng(2)
    # each document has common terms and some of its subject's
    subject = r.integers(0, 19, 3000)
    vectors = [np.unique([*r.integers(0, 10, 5), *(10 + 10 * s + r.integers(0, 10, 6))]) for s in subject]
    vectors += [vectors[0]] * 500
    size = np.array([len(v) for v in vectors])
    terms_, counts = np.concatenate(vectors), r.integers(1, 9, size.sum())
    factor = r.integers(75, 400, len(vectors))
    tree = lexical.DocumentTree(
        np.arange(len(vectors)), factor, np.concatenate([[0], np.cumsum(size)]), terms_, counts
    )
    leaves = [i for i, c in enumerate(tree.children) if not c]
    covered = sorted((int(tree.first[i]), int(tree.last[i])) for i in leaves)
    assert covered[0][0] == 0 and covered[-1][1] == len(vectors)
    assert all(a[1] == b[0] for a, b in zip(covered, covered[1:], strict=False))
    assert max(b - a for a, b in covered) <= lexical.LEAF
    scored = 0
    for seed in range(20):
        own = np.unique([*r.integers(0, 10, 3), *(10 + 10 * (seed % 19) + r.integers(0, 10, 4))])
        weights = 50 * own + 1  # the rarer a term, the more it weighs
        weight_of = np.zeros(200, np.int64)
        weight_of[own] = weights
        exact = tree.scores(0, len(vectors), weight_of)
        bound = tree.bounds_for(own, weights)
        for i in range(len(tree.first)):
            assert bound[i] >= exact[tree.first[i] : tree.last[i]].max()
        best = lexical.Best(20)
        tree.search(own, weights, weight_of, best)
        order = np.lexsort((tree.ids, -exact))[:20]
        order = order[exact[order] > 0]
        assert best.ids.tolist() == tree.ids[order].tolist() and best.scores.tolist() == exact[order].tolist()
        scored += sum(1 for i in leaves if bound[i] >= best.floor)
    assert scored < 20 * len(leaves) / 2
