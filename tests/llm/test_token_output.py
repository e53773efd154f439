import zlib
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from frames import SMALL, docs  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerkit.llm import grammar, packing, queries, tokens
from ledgerkit.llm.tokens import WordEncoder, encoder

BYTES, WORDS = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "word_bpe_49k.json"))
ODD = [
    "", None, " a", "a  b", "a\n\nb\t c", "don't x'll 12 3a", "a b", "x\x01 \x02y, a\x02", "<|endoftext|> hi", "a\n",
    "a <|endoftext|> b", "x<|ENDOFTEXT|><|startoftext|>y",
    "Ünï Straße,ok", "hé 中文 test", "—x “q” ɐ ǅ İstanbul ΑΣ Σ", "é, e", "a. b.\nC, d!! (e)", "\r\n", "x　, y", "ok,\x85no",
]


@lru_cache
def tokenizer(path):
    return Tokenizer.from_file(path)


def whole(path, texts):
    t = tokenizer(path)
    return [t.encode(x or "", add_special_tokens=False).ids for x in texts]


@pytest.mark.parametrize(("path", "space"), [(BYTES, True), (WORDS, False)])
def test_ids_are_those_of_whole_texts(path, space):
    found = WordEncoder(path, space).encode(pa.array(ODD))
    expected = whole(path, ODD)
    assert found.counts.tolist() == [len(x) for x in expected]
    assert found.ids.tolist() == [i for x in expected for i in x]


@pytest.mark.parametrize("shared", [0, 1])
def test_pieces_that_share_a_hash(monkeypatch, shared):
    """Any two hashes that meet only cost time."""
    real = tokens.piece_hashes

    def poor(pieces):
        first, second = real(pieces)
        return (first % np.uint64(7) if not shared else first * 0, second)

    monkeypatch.setattr(tokens, "piece_hashes", poor)
    enc = WordEncoder(BYTES, True)
    for texts in (["a b"], ["c d"], ODD):
        found, expected = enc.encode(pa.array(texts)), whole(BYTES, texts)
        assert found.ids.tolist() == [i for x in expected for i in x]


def test_a_full_cache_starts_anew(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_PIECES", 40)
    enc = WordEncoder(WORDS, False)
    for i in range(30):
        texts = [f"word{i} and w{j}" for j in range(10)]
        expected = whole(WORDS, texts)
        assert enc.encode(pa.array(texts)).ids.tolist() == [i for x in expected for i in x]
        assert len(enc.counts) <= 40


PARTS = st.sampled_from([*"ab'A.,! \n\té́ \x02<|1中", "<|endoftext|>", "<|startoftext|>"])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(PARTS, max_size=12).map("".join), min_size=1, max_size=4))
def test_ids_of_any_text(texts):
    for path, space in ((BYTES, True), (WORDS, False)):
        found = encoder(path, space).encode(pa.array(texts))
        expected = whole(path, texts)
        assert found.counts.tolist() == [len(x) for x in expected]
        assert found.ids.tolist() == [i for x in expected for i in x]


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 5000), st.integers(1, 40), st.randoms(use_true_random=False))
def test_grammar_round_trip(n, kinds, rng):
    ids = np.array([rng.randrange(kinds) for _ in range(n)], np.uint32)
    g = grammar.from_row(**grammar.to_row(grammar.compress(ids, 50)))
    assert (grammar.expand(g) == ids).all()
    a = rng.randrange(n + 1)
    k = rng.randrange(n + 1 - a)
    assert (grammar.read_range(g, a, k) == ids[a : a + k]).all()


def test_grammar_nests_and_shrinks():
    ids = np.tile(np.arange(16, dtype=np.uint32), 400)
    g = grammar.compress(ids, 16)
    assert len(g.symbols) < len(ids) // 8 and g.lengths.max() >= 8


def brute(rows, path, end_id):
    start, out = 0, []
    for doc_id, text in rows:
        ids = np.array([*whole(path, [text])[0], end_id], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_grammar_leaves_no_repeated_pair():
    rng = np.random.default_rng(3)
    many = rng.integers(0, 400, 2000).repeat(2)  # more pairs than were once replaced, of few occurrences each
    for ids in (many, np.tile(np.arange(20_000), 2), np.zeros(999, int), np.array([1, 2, 1, 2]), rng.integers(0, 3, 5000)):
        g = grammar.compress(ids, 1 << 15)
        seen, last = set(), None
        for pair in zip(g.symbols.tolist(), g.symbols[1:].tolist(), strict=False):
            if pair == last and pair[0] == pair[1]:
                last = None  # overlaps the one before
                continue
            assert pair not in seen
            seen.add(pair)
            last = pair
        assert (grammar.expand(g) == ids).all() and len(g.symbols) <= len(ids)


def test_op8_against_brute_force(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").select("doc_id", "text").collect()
    found = queries.op8_repair(spark, SMALL).orderBy("doc_id").collect()
    assert [tuple(r) for r in found] == brute(rows, BYTES, 0)


def test_shards_with_odd_rows(spark, docs, tmp_path):
    long = "some words again " * 3000
    rows = [(None, "none"), (3, long), (3, long), (5, None), (7, ""), (9, "x"), (9, "x y"), (12, long * 3)]
    frame = docs(rows).withColumnsRenamed({"lang": "part", "source": "ids"})  # names the operator uses itself
    grammar.write_shards(frame, str(tmp_path / "f"), BYTES, shard_ids=1000)
    found = grammar.read_documents(spark, str(tmp_path / "f")).orderBy("start").collect()
    expected = brute(rows, BYTES, 0)
    tied = brute([*rows[:5], rows[6], rows[5], rows[7]], BYTES, 0)
    assert [tuple(r) for r in found] in (expected, tied)
    grammar.write_shards(docs(rows).limit(0), str(tmp_path / "e"), BYTES)
    assert grammar.read_documents(spark, str(tmp_path / "e")).count() == 0


def check_packing(rows, pieces, path, end_id, window, quantum):
    ids = {i: np.array([*x, end_id], "<u4") for i, x in enumerate(whole(path, [r[1] for r in rows]))}
    by_doc = {}
    for p in pieces:
        by_doc.setdefault(p["doc_id"], []).append(p)
    assert set(by_doc) == {r[0] for r in rows}
    for i, row in enumerate(rows):
        own, at = sorted(by_doc[row[0]], key=lambda p: p["start"]), 0
        for p in own:
            assert p["start"] == at and p["length"] > 0 and p["doc_tokens"] == len(ids[i])
            assert p["ids_crc32"] == zlib.crc32(ids[i][at : at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(ids[i])
    windows = {}
    for p in pieces:
        windows.setdefault(p["sequence_id"], []).append(p)
    last, total = max(windows), sum(map(len, ids.values()))
    assert sorted(windows) == list(range(last + 1)) and last == (total - 1) // window
    sizes = {}
    for i, row in enumerate(rows):
        queue = row[2] if len(row) > 2 else "s"
        sizes[queue] = sizes.get(queue, 0) + len(ids[i])
    whole_turns = sum(s // quantum for s in sizes.values())
    served = dict.fromkeys(sizes, 0)
    for w in range(last + 1):
        at = 0
        for p in sorted(windows[w], key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
            served[p["queue"]] += p["length"]
        assert at == window or w == last
        if (w + 1) * window <= whole_turns * quantum:  # deficits stay small all the way
            turns = (w + 1) * window / quantum
            for q, s in sizes.items():
                share = max(1, s // quantum) / sum(max(1, n // quantum) for n in sizes.values())
                assert abs(served[q] / quantum - turns * share) <= 1 + len(sizes) * share


def test_op10_against_contract(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "source").collect()]
    check_packing(rows, queries.op10_packing(spark, SMALL).collect(), WORDS, 2, 4096, 512)


def test_packing_with_odd_rows(spark, docs):
    rows = [(None, "none", None), (3, "tok " * 3000, "a"), (4, "tok " * 900, "a"), (5, None, "b"), (7, "", "b")]
    rows += [(i, f"word {i} " * (i % 90), "hot" if i % 3 else f"s{i % 7}") for i in range(10, 300)]
    frame = docs(rows).withColumnsRenamed({"lang": "part", "n_chars": "queue"})
    pieces = packing.pack(frame.repartition(5), WORDS, window=256, quantum=32).collect()
    check_packing(rows, pieces, WORDS, 2, 256, 32)
    assert packing.pack(docs(rows).limit(0), WORDS).count() == 0


def test_packing_by_given_weights(spark, docs):
    rows = [(i, "tok " * 99, "ab"[i % 2]) for i in range(40)]
    pieces = packing.pack(docs(rows), WORDS, weights={"a": 3, "b": 1}, window=64, quantum=8).collect()
    first = [p for p in pieces if p["sequence_id"] < 20]
    assert sum(p["length"] for p in first if p["queue"] == "a") == 20 * 48


def test_packing_repeated_ids(spark, docs):
    pieces = packing.pack(docs([(1, "x y"), (1, "x y"), (1, "z")]), WORDS).collect()
    assert sum(p["length"] for p in pieces) == 3 + 3 + 2
