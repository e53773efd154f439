import random
import re
import zlib
from collections import Counter

from frames import SMALL, docs  # noqa: F401

from ledgerkit.llm import queries, variants


def counted(rows, min_chars=7):
    out = Counter()
    for name, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if name is None else name}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= min_chars:
                out[run] += 1
    return out


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def near_pairs(words):
    """Words one edit apart: those with a common result of deleting one place, compared outright."""
    holders = {}
    for w in words:
        for form in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            holders.setdefault(form, []).append(w)
    return {(a, b) for group in holders.values() for a in group for b in group if one_edit(a, b)}


def brute(rows, min_chars=7, min_count=2, times=10):
    counts = {w: n for w, n in counted(rows, min_chars).items() if n >= min_count}
    near = {w: [] for w in counts}
    for a, b in near_pairs(counts):
        near[a].append(b)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        if best and counts[best] >= times * counts[w]:
            form[w] = best
    out = []
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), counts[form[w]] if w in form else None))
    return sorted(out)


def result(df):
    return sorted((r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect())


def test_op12_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    found = result(queries.op12_variants(spark, SMALL))
    assert found == brute(rows)
    assert any(r[1] for r in found) and any(r[4] > 1 for r in found)


def test_chains_of_forms(docs):
    chain = "abcdefgh " * 2 + "abcdefgx " * 20 + "abcdefyx " * 200 + "abcdezyx " * 4000
    rows = [(i, chain + "ététété " * i + "x×y÷zabcd " * 3) for i in range(3)]
    found = result(variants.spelling_variants(docs(rows)))
    assert found == brute(rows)
    assert {r[2] for r in found if r[0] == "abcdefgh"} == {"abcdezyx"}


def test_random_words_with_edits_and_anagrams(docs):
    r = random.Random(3)
    alphabet = "abcàÿ"
    words = ["".join(r.choice(alphabet) for _ in range(r.randint(7, 9))) for _ in range(60)]
    for w in list(words):
        for _ in range(4):
            k = r.randrange(len(w))
            words.append(w[:k] + r.choice(["", r.choice(alphabet), w[k] + r.choice(alphabet)]) + w[k + 1 :])
        words.append("".join(r.sample(w, len(w))))
    rows = [(i, " ".join(r.choice(words) for _ in range(400))) for i in range(5)]
    found = result(variants.spelling_variants(docs(rows), times=2))
    assert found == brute(rows, times=2)
    assert sum(r[4] for r in found) > 100


def test_long_runs_and_odd_rows(spark, docs):
    long = "abcdefghij" * 3000
    rows = [
        (1, long), (2, long), (3, long[:-1]), (4, long[:-1]), (5, None), (None, "Zebraaaa zebraaaa"), (7, ""),
        (7, "stripes stripes"), (7, "stripes stripes"),
    ]
    found = result(variants.spelling_variants(docs(rows)))
    assert found == brute(rows)
    assert result(variants.spelling_variants(docs([]))) == []
    clash = spark.createDataFrame([(1, "stripes stripes", 5, "x")], "doc_id long, text string, Word int, `n`` ` string")
    assert [r[0] for r in result(variants.spelling_variants(clash))] == ["stripes"]


def test_checksums_equal_the_library():
    import numpy as np

    r = random.Random(5)
    runs = [bytes(r.choices(b"abcdefgh", k=r.choice([1, 7, 8, 63, 64, 65, 300]))) for _ in range(300)]
    size = np.array([len(x) for x in runs])
    seeds = np.array([zlib.crc32(str(i).encode()) for i in range(300)], np.uint32)
    data = np.frombuffer(b"".join(runs), np.uint8)
    found = variants.checksums(data, np.cumsum(size) - size, size, seeds)
    assert found.tolist() == [zlib.crc32(x, int(s)) for x, s in zip(runs, seeds, strict=True)]


def test_near_words_share_a_key_and_the_table_is_read_once(spark):
    words = spark.createDataFrame([("abcdefg", 2), ("abxdefg", 2), ("abcdefgh", 2), ("gfedcba", 2)], "word string, n long")
    rows = variants.signatures(words).collect()
    keys = {w: {r["key"] for r in rows if r["word"] == w} for w in ("abcdefg", "abxdefg", "abcdefgh")}
    assert len(rows) == 4 * 24
    assert keys["abcdefg"] & keys["abxdefg"] and keys["abcdefg"] & keys["abcdefgh"]
    found = {r["word"]: r["n_near"] for r in variants.near_words(words).collect()}
    assert found == {"abcdefg": 2, "abxdefg": 1, "abcdefgh": 1}
