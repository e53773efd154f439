import hashlib
import random
import re

import duckdb
from frames import SMALL, docs  # noqa: F401

from ledgerkit.llm import linededup, oracles, queries

SPACE = " \t\n\x0b\x0c\r"


def brute(rows, min_chars, min_docs):
    def key(line):
        k = re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(SPACE))
        return k if len(k) >= min_chars else None

    holders = {}
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if doc_id is not None and key(line):
                holders.setdefault(key(line), set()).add(doc_id)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [
            x for x in lines if doc_id is None or len(holders.get(key(x), ())) < min_docs or max(holders[key(x)]) == doc_id
        ]
        out.append((doc_id, None if text is None else "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def test_op7_against_brute_force_and_sql(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    found = sorted(map(tuple, queries.op7_line_dedup(spark, SMALL).collect()))
    digest = lambda x: hashlib.sha256((x or "").encode()).hexdigest()
    assert found == sorted((d, n, k, digest(t)) for d, t, n, k in brute(rows, 40, 5))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SMALL}/documents.parquet'")
    assert sorted(con.execute(oracles.ORACLES["op7_line_dedup"]).fetchall()) == found


def test_odd_rows(spark, docs):
    rng = random.Random(3)
    common = ["A Common Line", " a common line\t", "short", "", "É common line", "é common line", "x" * 5000]
    rows = [(i, "\n".join(rng.choice([*common, f"own {i} {j}"]) for j in range(rng.randrange(9)))) for i in range(60)]
    rows += [(None, "a common line\na common line"), (70, None), (71, ""), (5, "a common line"), (5, "other words")]
    frame = docs(rows).withColumnsRenamed({"lang": "row", "source": "drop", "n_chars": "n_dropped"})
    out = linededup.dedup_lines(frame, min_chars=8, min_docs=3)
    assert out.columns == ["doc_id", "text", "row", "drop", "n_lines", "n_dropped"]
    found = sorted(map(tuple, out.select("doc_id", "text", "n_lines", "n_dropped").collect()), key=str)
    assert found == brute(rows, 8, 3)
    assert linededup.dedup_lines(docs(rows).limit(0)).count() == 0


def test_a_full_filter_loses_nothing(spark, docs):
    rows = [(i, f"line number {i % 40} of some\nline {i} of its own") for i in range(400)]
    found = linededup.dedup_lines(docs(rows), min_chars=8, min_docs=3, max_bits=1 << 10).select("doc_id", "text", "n_lines", "n_dropped")
    assert sorted(map(tuple, found.collect()), key=str) == brute(rows, 8, 3)
