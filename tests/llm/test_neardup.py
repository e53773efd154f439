import random
import re

import numpy as np
import pyarrow as pa
from frames import SMALL, docs  # noqa: F401

from ledgerkit.llm import neardup, queries
from ledgerkit.llm.components import components
from ledgerkit.llm.words import buffers, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute(rows, size, percent):
    sets = []
    for _, text in rows:
        w = WORD.findall(low(text))
        sets.append({tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} - {()})
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    where = {}
    for i, s in enumerate(sets):
        for x in s:
            where.setdefault(x, []).append(i)
    for i, s in enumerate(sets):
        for j in {j for x in s for j in where[x] if j < i}:
            both = len(s & sets[j])
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        r = find(i)
        least[r] = min(least.get(r, doc_id), doc_id)
    return sorted((d, len(s), least[find(i)], d == least[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True)))


def test_words_are_told_apart():
    texts = ["Ab ab aB", " x\ty\x0bz ", "", None, "long" * 5000, "AB c ab c", "É é"]
    found = words(*buffers(pa.array(texts)))
    assert np.diff(found.bounds).tolist() == [3, 3, 0, 0, 1, 2, 2]
    h = found.hashes
    assert h[0] == h[1] == h[2] and h[7] == h[8] and h[9] != h[10] and len(set(h[[0, 3, 4, 5, 6, 7, 9, 10]])) == 8


def test_op3_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    found = queries.op3_near_duplicates(spark, SMALL)
    assert sorted(map(tuple, found.collect())) == brute(rows, 4, 80)


def test_planted_groups(spark, docs):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(900)]
    rows, passage = [], [rng.choice(vocabulary) for _ in range(60)]
    for g in range(25):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 8, 30, 200]))]
        for _ in range(rng.choice([1, 2, 12])):
            text = list(base)
            for _ in range(rng.randrange(1 + len(base) // 40)):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            if g % 3 == 0:
                text += passage
            rows.append((len(rows), " ".join(text)))
    rows += [(1000, None), (1001, ""), (1002, " \n"), (1003, "one"), (1004, "ONE"), (1005, "one two")]
    frame = docs(rows).withColumnsRenamed({"lang": "n", "source": "sketch", "n_chars": "node"})
    found = sorted(map(tuple, neardup.near_duplicates(frame).collect()))
    assert found == brute(rows, 5, 80)


def test_odd_tables(spark, docs):
    found = neardup.near_duplicates(docs([(None, "a b c d e f"), (None, "a b c d e f"), (7, "a b c d e f"), (7, "a b c d e f")]))
    assert sorted(map(str, (tuple(r) for r in found.collect()))) == [
        "(7, 2, 7, True)", "(7, 2, 7, True)", "(None, 2, None, True)", "(None, 2, None, True)",
    ]
    assert neardup.near_duplicates(docs([(1, "x")]).limit(0)).count() == 0


def test_components_of_chains_and_stars(spark):
    pairs = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 140)] + [(7, 7), (300, 200)]
    found = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 140)}, 200: 200, 300: 200}
