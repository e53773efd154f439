import hashlib
import random

import public_tokenizers
import pyarrow as pa
import pytest
from frames import SMALL, docs  # noqa: F401
from sentencepiece import SentencePieceProcessor

from ledgerkit.llm import pieces, queries

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=PATH)


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_op11_equals_the_library(spark, library):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    expected = []
    for doc_id, text in rows:
        ids = library.encode(text or "", add_eos=True)
        expected.append((doc_id, len(ids), digest(" ".join(map(str, ids))), digest(library.decode(ids))))
    found = queries.op11_pieces(spark, SMALL).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert sorted(map(tuple, found.collect())) == sorted(expected)


def agrees(library, texts):
    m = pieces.model(PATH)
    flat, counts = m.encode(pa.array(texts, pa.string()))
    lists, at = [], 0
    for n in counts.tolist():
        lists.append(flat[at : at + n].tolist())
        at += n
    assert lists == [library.encode(t or "") for t in texts]
    bounds = [0]
    for x in lists:
        bounds.append(bounds[-1] + len(x))
    import numpy as np

    assert m.decode(flat.astype(np.int64), np.array(bounds)).to_pylist() == [library.decode(x) for x in lists]


@pytest.mark.parametrize(
    "alphabet", ["ab e\n▁the<s>0x梦é\U0001f600", "aeionrst ", "ab ", " ", "ing th"], ids=range(5)
)
def test_random_texts(library, alphabet):
    r = random.Random(len(alphabet))
    agrees(library, ["".join(r.choices(alphabet, k=r.randint(0, 120))) for _ in range(1500)])


def test_texts_made_of_pieces(library):
    r = random.Random(9)
    spelled = [library.id_to_piece(i).replace("▁", " ") for i in range(259, 32000)]
    agrees(library, ["".join(r.choices(spelled, k=r.randint(0, 25))) for _ in range(3000)])


def test_odd_and_long_texts(library):
    r = random.Random(4)
    junk = "".join(r.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=20000))
    agrees(
        library,
        ["", None, " ", "  ", "\n\n", "a", " a  b   c", "\x00", "<s></s><unk>▁", " " * 5000 + "x" * 5000, junk, "​ "],
    )


def test_a_shared_hash_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(pieces, "mix", lambda h: h * 0)
    agrees(library, ["the cat sat on the mat", "dog", "a dog and the cat"])


def test_any_ids_decode_as_the_library_does(library):
    import numpy as np

    r = random.Random(6)
    m = pieces.model(PATH)
    for low, high in ((0, 32000), (259, 32000), (0, 300)):
        lists = [[r.randrange(low, high) for _ in range(r.randint(0, 12))] for _ in range(300)]
        lists += [[1, 1, 259], [2], [29871, 29871], [1, 0, 0]]
        bounds = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
        flat = np.array([i for x in lists for i in x], np.int64)
        assert m.decode(flat, bounds).to_pylist() == [library.decode(x) for x in lists]
    with pytest.raises(ValueError):
        m.decode(np.array([32000]), np.array([0, 1]))


def test_columns_and_empty_tables(spark, docs, library):
    frame = spark.createDataFrame([(1, "a b", 3, "x"), (2, None, 4, "y")], "doc_id long, text string, IDS int, `n`` ` string")
    coded = pieces.decode_pieces(pieces.encode_pieces(frame, PATH), PATH)
    assert coded.columns == ["doc_id", "text", "n` ", "ids", "decoded"]
    rows = sorted(coded.collect())
    assert [r["ids"] for r in rows] == [library.encode("a b", add_eos=True), [2]]
    assert [r["decoded"] for r in rows] == ["a b", ""]
    assert pieces.encode_pieces(docs([]), PATH).collect() == []
    bare = pieces.encode_pieces(frame, PATH, end=False).orderBy("doc_id").collect()
    assert [r["ids"] for r in bare] == [library.encode("a b"), []]
    none = spark.createDataFrame([(1, None), (2, [1])], "k int, ids array<int>")
    assert [r["decoded"] for r in pieces.decode_pieces(none, PATH).orderBy("k").collect()] == [None, ""]
