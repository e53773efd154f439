import random
import re

import numpy as np
import pyarrow as pa
import pytest
from frames import SMALL, docs  # noqa: F401

from ledgerkit.llm import decontaminate, queries


def norm(text):
    return re.findall(r"[a-z0-9\u0080-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def test_op4_against_brute_force(spark):
    texts = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    items = [(i, norm(t)) for i, t in map(tuple, spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect())]
    found = {(r.doc_id, r.item_id): r for r in queries.op4_decontamination(spark, SMALL).collect()}
    whole = {(d, i) for d, t in texts for i, w in items if f" {' '.join(w)} " in f" {' '.join(norm(t))} "}
    assert whole and set(found) >= whole
    words, of = {d: norm(t) for d, t in texts}, dict(items)
    for (d, i), r in found.items():  # nothing is reported that a plain comparison does not bear out
        assert r.words == len(of[i]) and r.common <= lcs(of[i], words[d]) and r.common >= 0.55 * r.words
        if (d, i) in whole:
            assert r.common == r.words


@pytest.fixture
def planted(spark, docs):
    rng = random.Random(4)
    vocabulary = [f"term{i}" for i in range(3000)]
    draw = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, draw(rng.randrange(15, 60))) for i in range(40)] + [(40, draw(150))]
    rows, expected = [], set()
    for d in range(300):
        text = draw(rng.choice([0, 5, 40, 300]))
        if d % 3 == 0:
            i, words = items[rng.randrange(len(items))]
            words = [w if rng.random() > 0.12 else rng.choice(vocabulary) for w in words]  # a paraphrase
            at = rng.randrange(len(text) + 1)
            text[at:at] = words
            expected.add((d, i))
        rows.append((d, ". ".join([" ".join(text[:9]).title(), " ".join(text[9:])])))
    rows += [(1000, None), (1001, ""), (1002, "?!"), (1000, " ".join(items[3][1]))]
    expected.add((1000, 3))
    frame = docs(rows).withColumnsRenamed({"lang": "matches", "source": "chunk", "n_chars": "part"})
    bench = [(i, " ".join(w)) for i, w in items] + [(41, None), (42, ""), (None, "...")]
    return frame, spark.createDataFrame(bench, "item_id long, text string"), expected


def test_paraphrases_are_found_and_clean_documents_kept(planted):
    frame, bench, expected = planted
    out = decontaminate.find_matches(frame, bench).collect()
    found = {(r.doc_id, m.item_id) for r in out for m in r.matches}
    assert len(found & expected) >= 0.97 * len(expected) and found <= expected
    kept = decontaminate.decontaminate(frame, bench)
    assert set(kept.columns) == set(frame.columns) - {"matches"}
    clean = sorted((r.doc_id, r.text or "") for r in out if not r.matches)
    assert sorted((r.doc_id, r.text or "") for r in kept.select("doc_id", "text").collect()) == clean


def test_empty_tables(spark, planted):
    frame, bench, _ = planted
    assert decontaminate.decontaminate(frame.limit(0), bench).count() == 0
    assert decontaminate.decontaminate(frame, bench.limit(0)).count() == frame.count()


def test_latent_space_keeps_cosines_of_low_rank_text():
    rng = np.random.default_rng(2)
    topics = [[f"w{t}x{i}" for i in range(40)] for t in range(12)]
    texts = [" ".join(rng.choice(topics[i % 12], 64)) for i in range(600)]
    part = next(decontaminate._sketch(iter([pa.RecordBatch.from_pydict({"text": texts})])))
    sums = np.concatenate([np.frombuffer(x, np.float32) for x in part.column("part").to_pylist()]).astype(float)
    space = decontaminate.decompose(sums.reshape(decontaminate.TERMS, -1))
    found = decontaminate._read(pa.array(texts))
    v = decontaminate._unit(decontaminate._fold(decontaminate.blocks_of(found), space.fold))[::2]
    same = np.arange(600) % 12
    near = v @ v.T
    alike = same[:, None] == same
    assert near[alike].mean() > near[~alike].mean() + 0.15


def test_paraphrases_that_keep_only_function_words(spark, docs):
    rng = random.Random(5)
    small, large = [f"fn{i}" for i in range(12)], [f"content{i}" for i in range(4000)]
    draw = lambda n: [rng.choice(small if k % 2 else large) for k in range(n)]
    items = [draw(40) for _ in range(20)]
    rows, expected = [], set()
    for d in range(200):
        text = draw(rng.randrange(0, 200))
        if d % 2:
            i = rng.randrange(len(items))
            words = list(items[i])
            for k in rng.sample(range(0, 40, 2), 14):  # SURE is still met: 26 of 40 in order, but 6 of 20 content words
                words[k] = "new" + words[k]
            at = rng.randrange(len(text) + 1)
            text[at:at] = words
            expected.add((d, i))
        rows.append((d, " ".join(text)))
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    out = decontaminate.find_matches(docs(rows), bench).collect()
    assert {(r.doc_id, m.item_id) for r in out for m in r.matches} >= expected


def test_no_match_is_lost_whatever_its_cosine():
    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(300)]
    items = [[rng.choice(vocabulary) for _ in range(rng.randrange(15, 21))] for _ in range(30)]
    texts = []
    for d in range(60):
        text, i = [rng.choice(vocabulary) for _ in range(rng.randrange(0, 300))], d % len(items)
        at = rng.randrange(len(text) + 1)
        text[at:at] = [w for k, w in enumerate(items[i]) if d % 3 or k % 4]  # whole, or three quarters
        texts.append(text)
    hashes = [decontaminate._read(pa.array([" ".join(w)])).hashes for w in items]
    found = decontaminate.Items(list(range(len(items))), hashes, [len(h) for h in hashes])
    space = decontaminate.Space(np.zeros((decontaminate.TERMS, 2), np.float32), np.zeros(decontaminate.TERMS, bool))  # all cosines 0
    out = decontaminate.Search(found, space).run(pa.array([" ".join(t) for t in texts]))
    step = decontaminate.BLOCK
    for text, matches in zip(texts, out, strict=True):
        spans = [text[max(0, a - step) : a + 3 * step] for a in range(0, max(1, len(text) - step), step)]
        expected = {i for i, w in enumerate(items) if max(lcs(w, x) for x in spans) >= decontaminate.SURE * len(w)}
        assert {m["item_id"] for m in matches} == expected


def test_long_items_are_searched_to_their_end_and_across_segments(spark, docs):
    words = [f"w{i}" for i in range(130)]
    answered = [f"v{i}" for i in range(80)]
    bench = [(1, " ".join(words)), (2, " ".join(answered[:70]) + ". " + " ".join(answered[70:]))]
    some = [w for k, w in enumerate(answered) if k >= 70 or (k >= 16 and k % 2)]  # 37 of the last 64, with the answer
    rows = [(1, " ".join(words[34:94])), (2, " ".join(some)), (3, " ".join(answered[:30]))]
    frame = spark.createDataFrame(bench, "item_id long, text string")
    out = decontaminate.find_matches(docs(rows), frame).collect()
    assert {(r.doc_id, m.item_id) for r in out for m in r.matches} == {(1, 1), (2, 2)}
